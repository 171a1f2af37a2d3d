"""Registered queries that audit a corpus (manifest, decontamination, repair) and their DuckDB SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import conversation_repair, decontamination, merkle_manifest
from strata.llm.common import map_rows, same, table


def q_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2)) == 0
    received = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    columns = [received if c == "text" else F.col(c) for c in merkle_manifest.COLUMNS]
    leaves = merkle_manifest.build(table(spark, sf_dir, "documents"), carry={"received": merkle_manifest.leaf(columns)}).leaves
    folded = leaves.withColumn("folded_root", merkle_manifest.fold(F.col("received"), F.col("proof")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(merkle_manifest.siblings(F.col("proof")), 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def q_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontamination.mark(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"), F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"), (F.col("__n_hit") > 0).alias("contaminated"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The conversations with the damage that their repair is shown on."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.pmod(F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))), F.lit(20))
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), case.alias("case")).where("case != 0")
    said = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("case") == 4, "user").otherwise(F.col("role"))
    twice = F.array_repeat(F.lit(0), F.when(F.col("case") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), said.alias("text"), F.explode(twice).alias("copy")).drop("copy")


def _text_digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """A digest of each conversation's lines, which arrive in order."""
    for conv_id, turns in groupby(rows, key=lambda r: r[0]):
        digest = hashlib.sha256()
        for n, (_, role, text) in enumerate(turns):
            digest.update((("\n" if n else "") + f"{role}:{text}").encode())
        yield conv_id, digest.hexdigest()


def q_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    report, turns = conversation_repair.repair(damaged(conversations))
    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    schema = pa.schema([("__conv_id", pa.int64()), ("sha", pa.string())])
    digests = ordered.mapInArrow(map_rows(_text_digests, ["conv_id", "role", "text"], schema), "__conv_id long, sha string")
    every = conversations.select("conv_id").distinct()
    told = every.join(report.withColumnRenamed("conv_id", "__conv_id"), F.col("conv_id").eqNullSafe(F.col("__conv_id")), "left").drop("__conv_id")
    told = told.join(digests, same(told, digests, "conv_id"), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return told.select(
        "conv_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


QUERIES = {
    "op11_merkle_manifest": q_merkle_manifest,
    "op12_decontamination": q_decontamination,
    "op13_conversation_repair": q_conversation_repair,
}


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string in DuckDB: bit by bit, characters in turn."""
    bits = "list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda z: 0::UBIGINT)), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::UBIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda a, b: {bits}), 4294967295::UBIGINT)"


def _leaf(text: str) -> str:
    enc = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR) || ':' || {c}::VARCHAR END"
    return f"sha256({' || '.join(map(enc, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


ORACLE_SQL = {
    "op11_merkle_manifest": f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, {_leaf("text")} AS leaf,
         {_leaf(f"(CASE WHEN {_crc32('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END)")} AS received
  FROM documents
), p AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM d
), lv AS (
  SELECT 0 AS l, source, pos, n, leaf AS d FROM p
  UNION ALL
  SELECT l + 1, source, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM lv WHERE n > 1 GROUP BY l, source, pos // 3, n
), sub AS (SELECT source, l AS height, d AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM lv WHERE n = 1),
up AS (
  SELECT 0 AS l, pos, n, subroot AS d FROM sub
  UNION ALL
  SELECT l + 1, pos // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM up WHERE n > 1 GROUP BY l, pos // 3, n
), paths AS (
  SELECT p.rid, lv.l, lv.d, lv.pos AS place, p.pos // (3 ** lv.l)::BIGINT AS own
  FROM p JOIN lv ON p.source IS NOT DISTINCT FROM lv.source AND lv.n > 1 AND lv.pos // 3 = p.pos // (3 ** (lv.l + 1))::BIGINT
  UNION ALL
  SELECT p.rid, sub.height + up.l, up.d, up.pos, sub.pos // (3 ** up.l)::BIGINT
  FROM p JOIN sub ON p.source IS NOT DISTINCT FROM sub.source JOIN up ON up.n > 1 AND up.pos // 3 = sub.pos // (3 ** (up.l + 1))::BIGINT
), seg AS (
  SELECT rid, l, coalesce(string_agg(d, '' ORDER BY place) FILTER (WHERE place < own), '') AS lft, coalesce(string_agg(d, '' ORDER BY place) FILTER (WHERE place > own), '') AS rgt
  FROM paths GROUP BY rid, l
), f AS (
  SELECT rid, 0 AS l, received AS acc FROM p
  UNION ALL
  SELECT f.rid, f.l + 1, sha256(lft || acc || rgt) FROM f JOIN seg ON f.rid = seg.rid AND f.l = seg.l
), folded AS (SELECT rid, arg_max(acc, l) AS folded_root FROM f GROUP BY rid),
sib AS (SELECT rid, string_agg(lft || rgt, '' ORDER BY l) AS s FROM seg GROUP BY rid)
SELECT doc_id, leaf, subroot, root.d AS root, sha256(coalesce(s, '')) AS proof_sha256, folded_root, folded_root = root.d AS verified
FROM p JOIN sub ON p.source IS NOT DISTINCT FROM sub.source JOIN folded USING (rid) LEFT JOIN sib USING (rid), (SELECT d FROM up WHERE n = 1) AS root
""",
    "op12_decontamination": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), w AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS g
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)
), g AS (
  SELECT rid, n, i, array_to_string(ws[i : i + n - 1], ' ') AS g
  FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM w) WHERE len(ws) >= n)
), h AS (SELECT rid, i, g.n, item FROM g JOIN w ON g.n = w.n AND g.g = w.g),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM h) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
""",
    "op13_conversation_repair": rf"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS c
  FROM conversations
), m AS (
  SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role,
         CASE c WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM (SELECT *, unnest(range(CASE WHEN c = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE c <> 0)
), o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
         CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS r, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t
  FROM m
), f AS (
  SELECT *, lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS pair,
         CASE WHEN t = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(t, 1) NOT IN ('.', '!', '?') THEN 't' ELSE 'k' END AS fault
  FROM o
), ins(s, e, c, a, l) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
         (0, 2, 3, 'I', chr(10) || 'user:'), (1, 2, 3, 'I', chr(10) || 'user:'), (3, 2, 3, 'I', chr(10) || 'user:'), (2, 3, 3, 'I', chr(10) || 'assistant:'),
         (0, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
), act(e, x, r, c, a, role) AS (
  VALUES (0, 0, '*', 4, 'D', ''), (1, 1, '*', 4, 'D', ''), (2, 2, '*', 4, 'D', ''), (3, 3, '*', 4, 'D', ''),
         (0, 1, 's', 0, 'K', ''), (0, 2, 'u', 0, 'K', ''), (1, 2, 'u', 0, 'K', ''), (3, 2, 'u', 0, 'K', ''), (2, 3, 'a', 0, 'K', ''),
         (0, 2, '*', 3, 'R', 'user'), (1, 2, '*', 3, 'R', 'user'), (3, 2, '*', 3, 'R', 'user'), (2, 3, '*', 3, 'R', 'assistant')
), p(conv_id, i, s, b) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, {{'c': 0::BIGINT, 'a': '', 'l': ''}} FROM f
  UNION ALL
  SELECT conv_id, i, x, min(b) FROM (
    SELECT p.conv_id, f.i, act.x,
           {{'c': p.b.c + ins.c + act.c + CASE WHEN fault = 't' AND act.a <> 'D' THEN 3 ELSE 0 END, 'a': p.b.a || ins.a || act.a,
             'l': p.b.l || ins.l || CASE act.a WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text ELSE chr(10) || act.role || ':' || f.text END}} AS b
    FROM p JOIN f ON p.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = p.i + 1 JOIN ins ON ins.s = p.s
    JOIN act ON act.e = ins.e AND (act.r = '*' OR act.r = f.r) AND (act.a = 'D' OR fault NOT IN ('b', 'd'))
  ) GROUP BY conv_id, i, x
), w AS (
  SELECT p.conv_id, min({{'c': p.b.c + ins.c, 'a': p.b.a || ins.a, 'l': p.b.l || ins.l}}) AS b
  FROM p JOIN (SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id) z ON p.conv_id IS NOT DISTINCT FROM z.conv_id AND p.i = z.n JOIN ins ON ins.s = p.s AND ins.e IN (0, 3)
  GROUP BY p.conv_id
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
)
SELECT x.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(w.b.c, 0)::BIGINT AS cost, coalesce(w.b.a, '') AS audit, sha256(coalesce(substr(w.b.l, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) x LEFT JOIN c ON x.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN w ON x.conv_id IS NOT DISTINCT FROM w.conv_id
""",
}
