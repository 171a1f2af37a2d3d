"""The registered queries of this subpackage and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole of
its table and derives digest columns from the operator's output.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.config import scratch_path
from strata.llm import backoff_lm, chat_trees, embedding_blocks, line_dedup, mixing, packing, pii_crf, quality_rules, queries_audit, simhash_index, token_records
from strata.llm.common import map_rows, stored, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def q_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_boilerplate(table(spark, sf_dir, "documents"), marks=True)
    return out.select(
        "doc_id", F.col("__n_lines").cast("long").alias("n_lines"), F.col("__n_removed").cast("long").alias("n_removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def q_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-records")
    index = token_records.write_records(table(spark, sf_dir, "documents"), folder, tokenizer_file("byte_bpe_50k.json"))
    schema = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def digests(rows: Iterator[tuple]) -> Iterator[tuple]:
        import numpy as np

        for part, before, doc_id, ids in rows:
            wide = np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()
            yield part, before, doc_id, len(wide) // 4, zlib.crc32(wide)

    read = token_records.read_records(index).mapInArrow(
        map_rows(digests, ["part", "tokens_before", "doc_id", "ids"], schema), "part int, before long, doc_id long, n_tokens long, ids_crc32 long"
    )
    return read.join(token_records.file_starts(index), "part").select(
        "doc_id", (F.col("ids_before_file") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )


TEST_CONVERSATION = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def q_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(TEST_CONVERSATION, rows.schema))
    output = stored(chat_trees.format_trees(chat_trees.chain_messages(rows)), "conversations")
    turns = chat_trees.parse(F.col("formatted"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat_trees.loss_text(F.col("formatted"), F.col("loss_spans"))
    return output.withColumn("turns", turns).withColumn("loss", loss).select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def q_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return judged.select("doc_id", *(F.col(f"__counts.{c}").alias(c) for c in quality_rules.COUNTS), F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"))


def q_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", F.monotonically_increasing_id().alias("__row"))
    told = ["doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target")]
    emitted = mixing.emit(mixing.plan_mix(docs))
    words = F.when(F.col("__copy").isNotNull(), F.col("__size")).otherwise(0)  # counted on the rows that the mix emits
    counted = emitted.select("__row", *told, words.alias("words")).groupBy("__row", "doc_id", "size", "source_size", "target")
    return counted.agg(F.sum("words").alias("taken")).drop("__row")


def q_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.document_scores(table(spark, sf_dir, "documents"))


def q_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii_crf.find(docs, pii_crf.fit(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, pii_crf.KINDS), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def q_simhash_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_index.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def q_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    length = F.octet_length("ids").cast("long") / 4
    return packed.select(
        "doc_id", "start", length.cast("long").alias("length"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def q_embedding_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_blocks.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


QUERIES = {
    "op1_line_dedup": q_line_dedup,
    "op2_token_records": q_token_records,
    "op3_chat_trees": q_chat_trees,
    "op4_quality_rules": q_quality_rules,
    "op5_mixing": q_mixing,
    "op6_backoff_lm": q_backoff_lm,
    "op7_pii_crf": q_pii_crf,
    "op8_simhash_index": q_simhash_index,
    "op9_packing": q_packing,
    "op10_embedding_blocks": q_embedding_blocks,
} | queries_audit.QUERIES

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE_SQL = {
    "op1_line_dedup": f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS ln, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents
), k AS (SELECT *, trim(ln, {_SPACE}) AS t FROM l),
b AS (
  SELECT t, arg_min(struct_pack(d := doc_id, p := pos), (doc_id, pos)) AS f FROM k WHERE t <> ''
  GROUP BY t HAVING count(DISTINCT coalesce('=' || source, '-')) >= 10
), m AS (
  SELECT k.*, b.t IS NOT NULL AND NOT (b.f.d = k.doc_id AND b.f.p = k.pos) AS gone FROM k LEFT JOIN b USING (t)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
       sha256(coalesce(string_agg(ln, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS text_sha256
FROM m GROUP BY doc_id
UNION ALL SELECT doc_id, 0, 0, sha256('') FROM documents WHERE text IS NULL
""",
    "op3_chat_trees": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
), s AS (
  SELECT *, len(regexp_extract_all(text, '[<\[]\\*(?:\|im_start\|>|\|im_end\|>|s>|/s>|INST\]|/INST\])')) AS escapes FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 1 + length(text) + escapes + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
""",
    "op4_quality_rules": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, lang, source, {_WORDS} AS ws FROM documents),
win AS (
  SELECT rid, i, array_to_string(ws[i : i + 4], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)
), dup AS (SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) >= 2),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM dup, (SELECT unnest(range(5)) AS k) GROUP BY rid),
lin AS (SELECT rid, unnest(string_split(text, chr(10))) AS ln FROM d),
dl AS (SELECT rid, count(*) - count(DISTINCT ln) AS n FROM lin WHERE trim(ln, {_SPACE}) <> '' GROUP BY rid),
f AS (
  SELECT d.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(dl.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN dl USING (rid)
), r AS (
  SELECT lang, source, 'symbols' AS ratio, n_symbols * 1000 // n_words AS v FROM f WHERE n_words > 0
  UNION ALL SELECT lang, source, 'word_length', word_chars * 1000 // n_words FROM f WHERE n_words > 0
  UNION ALL SELECT lang, source, 'dup_lines', n_dup_lines * 1000 // n_words FROM f WHERE n_words > 0
), c AS (SELECT lang, source, ratio, v - v % (1::BIGINT << greatest(length(bin(v)) - 8, 0)) AS cell FROM r),
o AS (
  SELECT lang, source, ratio, cell, row_number() OVER g AS k, count(*) OVER (PARTITION BY lang, source, ratio) AS n
  FROM c WINDOW g AS (PARTITION BY lang, source, ratio ORDER BY cell)
), own AS (
  SELECT lang, source, ratio, any_value(n) AS n, min(cell) FILTER (WHERE k >= ceil(n / 4)) AS lo, min(cell) FILTER (WHERE k >= ceil(3 * n / 4)) AS hi
  FROM o GROUP BY ALL
), w AS (
  SELECT lang, ratio, cell, row_number() OVER g AS k, count(*) OVER (PARTITION BY lang, ratio) AS n
  FROM c WINDOW g AS (PARTITION BY lang, ratio ORDER BY cell)
), wide AS (
  SELECT lang, ratio, min(cell) FILTER (WHERE k >= ceil(n / 4)) AS lo, min(cell) FILTER (WHERE k >= ceil(3 * n / 4)) AS hi FROM w GROUP BY ALL
), q AS (
  SELECT own.lang, own.source, own.ratio, CASE WHEN n < 100 THEN wide.lo ELSE own.lo END AS lo, CASE WHEN n < 100 THEN wide.hi ELSE own.hi END AS hi
  FROM own JOIN wide ON own.lang IS NOT DISTINCT FROM wide.lang AND own.ratio = wide.ratio
), t AS (
  SELECT lang, source, max(hi) FILTER (WHERE ratio = 'symbols') AS sy_hi, max(lo) FILTER (WHERE ratio = 'symbols') AS sy_lo,
         max(hi) FILTER (WHERE ratio = 'word_length') AS wl_hi, max(lo) FILTER (WHERE ratio = 'word_length') AS wl_lo,
         max(hi) FILTER (WHERE ratio = 'dup_lines') AS dl_hi, max(lo) FILTER (WHERE ratio = 'dup_lines') AS dl_lo
  FROM q GROUP BY ALL
), j AS (
  SELECT f.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_symbols * 1000 - sy_hi * n_words <= 3 * greatest(sy_hi - sy_lo, 33) * (n_words + 20)
         AND word_chars * 1000 - wl_hi * n_words <= 3 * greatest(wl_hi - wl_lo, 1000) * (n_words + 50)
         AND wl_lo * n_words - word_chars * 1000 <= 3 * greatest(wl_hi - wl_lo, 1000) * (n_words + 50)
         AND n_dup_lines * 1000 - dl_hi * n_words <= 3 * greatest(dl_hi - dl_lo, 10) * (n_words + 100) AS usual
  FROM f LEFT JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND f.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(usual, false) AS kept FROM j
""",
    "op5_mixing": rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS shares,
         coalesce(sum(source_size) OVER b, 0) AS size_before, coalesce(sum(w) OVER b, 0) AS w_before
  FROM s WINDOW b AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (SELECT *, w * (total - 3 * size_before) > 3 * source_size * (shares - w_before) AS stops FROM o),
l AS (SELECT (any_value(total) - 3 * coalesce(sum(source_size) FILTER (WHERE stops), 0))::DOUBLE AS rest, greatest(coalesce(sum(w) FILTER (WHERE NOT stops), 0), 1)::DOUBLE AS shares FROM c),
t AS (
  SELECT source, source_size, CASE WHEN stops THEN (3 * source_size)::DOUBLE ELSE w::DOUBLE * rest / l.shares END AS target FROM c, l
), r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 1.0 END AS rate FROM t)
SELECT doc_id, size, source_size, target,
       ((floor(rate) + CASE WHEN ('0x' || substr(md5('20:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
""",
    "op6_backoff_lm": rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS ws FROM documents),
t AS (SELECT rid, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM d),
g AS (SELECT *, lag(w) OVER (PARTITION BY rid ORDER BY i) AS v FROM t),
c AS (
  SELECT *, count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY rid, w) AS c1,
         CASE WHEN v IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY v, w) - count(*) OVER (PARTITION BY rid, v, w) END AS c2,
         count(*) OVER () - count(*) OVER (PARTITION BY rid) AS n
  FROM g
), x AS (SELECT *, lag(c1) OVER (PARTITION BY rid ORDER BY i) AS cv FROM c),
p AS (
  SELECT rid, c1, c2, CASE WHEN c2 > 0 THEN ln(c2 / cv) ELSE ln(CASE WHEN c1 > 0 THEN c1 ELSE 0.5 END / greatest(n, 1)) + ln(0.4) END AS s FROM x
), z AS (SELECT rid, sum(round(s * 1000000)::BIGINT)::BIGINT AS score_micro, count(*) FILTER (WHERE c2 > 0) AS n_longest, count(*) FILTER (WHERE c1 <= 0) AS n_unseen FROM p GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(score_micro, 0)::BIGINT AS score_micro, coalesce(n_longest, 0) AS n_longest, coalesce(n_unseen, 0) AS n_unseen
FROM d LEFT JOIN z USING (rid)
""",
    "op10_embedding_blocks": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_sum(list_transform(embedding, lambda x: (x * x)::DOUBLE)) > 0
), l AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), r(node, reach) AS (SELECT u, v FROM l UNION SELECT r.node, l.v FROM r JOIN l ON l.u = r.reach),
m AS (SELECT node, min(reach) AS low FROM r GROUP BY node), n AS (SELECT u, count(*) AS links FROM l GROUP BY u)
SELECT vec_id, coalesce(links, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id, vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN m ON node = vec_id LEFT JOIN n ON u = vec_id
""",
} | queries_audit.ORACLE_SQL
