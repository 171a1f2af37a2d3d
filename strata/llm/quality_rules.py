"""Quality rules with thresholds learned from the corpus.

Fixed rules first: too few words, or too many words in repeated five-word
windows.  Then adaptive rules: for each (language, source) the quartiles of
three ratios come from mergeable quantile sketches and fence the usual range
of that group (Tukey's fences, with a least spread so that groups without any
variation don't reject the first document that differs).

The sketch of a ratio is a histogram whose cell edges keep ``SKETCH_BITS``
leading bits of an integer, so its relative error is below 2^-SKETCH_BITS, it
has at most a few thousand cells however many rows it covers, and two sketches
merge exactly by adding counts.  Cells are pre-aggregated in every map task, so
a source with a third of all rows sends only its cells.  Groups of fewer than
``MIN_GROUP`` documents use the merged sketch of their language.

The sketch pass leaves out the repeated windows, most of the counting work,
and returns no text.  The thresholds, one row
a (language, source), are stored and joined back null-safe: Spark broadcasts
them while their files are under its threshold, and no text is shuffled.

Cases: null text has no words and is rejected by the base rule; null language
or source is a group of its own; repeated rows are judged alike; an empty
table gives an empty result; ``drop_low_quality`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from strata.llm.common import ASCII_SPACE, stored

MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
SKETCH_BITS = 7
MIN_GROUP = 100
FENCE = 3
#: ratio -> (numerator, least spread in thousandths a word, words of slack for short texts, fenced on both sides)
RATIOS = {
    "symbols": ("n_symbols", 33, 20, False),
    "word_length": ("word_chars", 1000, 50, True),
    "dup_lines": ("n_dup_lines", 10, 100, False),
}

_ODD = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of consecutive words found twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    each = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    rolled = each[:n].copy()
    for i in range(1, window):
        rolled = rolled * _ODD ^ each[i : n + i]
    order = np.argsort(rolled, kind="stable")
    same = rolled[order][1:] == rolled[order][:-1]
    if not same.any():
        return 0  # equal windows have equal hashes
    suspects = np.zeros(n, dtype=bool)
    suspects[order[1:][same]] = suspects[order[:-1][same]] = True
    seen: dict[tuple, int] = {}
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for i in np.flatnonzero(suspects).tolist():  # compare the words themselves
        first = seen.setdefault(tuple(words[i : i + window]), i)
        if first != i:
            for at in (first, i):
                covered[at : at + window] = 1
    return int(covered[:-1].sum())


def ratio_counts(text: str | None) -> tuple[list[bytes], tuple[int, int, int, int]]:
    """The words, and n_words, word_chars, n_symbols, n_dup_lines."""
    text = text or ""
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, ASCII_SPACE))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.strip(ASCII_SPACE):
            seen.add(line)
    return words, (len(words), chars, sum(map(text.count, SYMBOLS)), dup)


def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words, counts = ratio_counts(text)
    return *counts, repeated_words(words)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def with_counts(docs: DataFrame, columns: list[str] | None = None, windows: bool = True) -> DataFrame:
    """``columns`` of ``docs`` (all) with a struct column ``__counts``; the text
    is not copied through Python's rows, only read.  Without ``windows``
    n_repeat_words is null."""
    struct = pa.struct([(c, pa.int64()) for c in COUNTS])
    names = columns or docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = (t.as_py() for t in batch.column("text"))
            rows = [dict(zip(COUNTS, base_counts(t) if windows else ratio_counts(t)[1])) for t in texts]
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(rows, struct)], names=[*names, "__counts"])

    counts = StructType([StructField(c, LongType()) for c in COUNTS])
    return docs.mapInArrow(run, StructType([*(docs.schema[n] for n in names), StructField("__counts", counts)]))


def ratio(name: str) -> Column:
    """The ratio in thousandths a word, rounded down."""
    return F.floor(F.col(f"__counts.{RATIOS[name][0]}") * 1000 / F.col("__counts.n_words")).cast("long")


def sketch_cell(value: Column, bits: int = SKETCH_BITS) -> Column:
    """The lower edge of the value's cell: all but ``bits`` leading bits cleared."""
    shift = F.greatest(F.length(F.bin(value)) - F.lit(bits + 1), F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("long")
    return value - F.pmod(value, step)


def sketches(counted: DataFrame) -> DataFrame:
    """``(lang, source, ratio, cell, n)`` over every document with words."""
    cells = F.array(*(F.struct(F.lit(r).alias("ratio"), sketch_cell(ratio(r)).alias("cell")) for r in RATIOS))
    rows = counted.where("__counts.n_words > 0").select("lang", "source", F.explode(cells).alias("c"))
    return rows.groupBy("lang", "source", "c.ratio", "c.cell").agg(F.count("*").alias("n"))


def quartiles(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Lower and upper quartile of each ratio in each group: the cells that
    hold the ranks ceil(n/4) and ceil(3n/4)."""
    merged = cells.groupBy(*keys, "ratio", "cell").agg(F.sum("n").alias("n"))
    held = merged.groupBy(*keys, "ratio").agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("cell", "n"))).alias("cells"))

    def at(quarter: int) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("below"), F.lit(None).cast("long").alias("found"))
        need = F.ceil(F.col("total") * quarter / 4)
        step = lambda a, c: F.struct(
            (a["below"] + c["n"]).alias("below"),
            F.coalesce(a["found"], F.when(a["below"] + c["n"] >= need, c["cell"])).alias("found"),
        )
        return F.aggregate("cells", start, step)["found"]

    return held.select(*keys, "ratio", "total", at(1).alias("low"), at(3).alias("high"))


def thresholds(cells: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row a (lang, source): the quartiles of each ratio, from the
    language's merged sketch where the group is small."""
    own, wide = quartiles(cells, ["lang", "source"]), quartiles(cells, ["lang"])
    wide = wide.select(F.col("lang").alias("l"), F.col("ratio").alias("r"), F.col("low").alias("wide_low"), F.col("high").alias("wide_high"))
    both = own.join(wide, own["lang"].eqNullSafe(wide["l"]) & (own["ratio"] == wide["r"]))
    small = F.col("total") < min_group
    return both.groupBy("lang", "source").agg(*(
        F.max(F.when(F.col("ratio") == r, F.when(small, F.col(f"wide_{q}")).otherwise(F.col(q)))).alias(f"__{r}_{q}")
        for r in RATIOS for q in ("low", "high")
    ))


def within_fences() -> Column:
    """True where every ratio lies within its group's fences; a short text has
    some words of slack."""
    ok = F.lit(True)
    words = F.col("__counts.n_words")
    for r, (count, spread, slack, both) in RATIOS.items():
        low, high = F.col(f"__{r}_low"), F.col(f"__{r}_high")
        room = FENCE * F.greatest(high - low, F.lit(spread)) * (words + slack)
        have = F.col(f"__counts.{count}") * 1000
        ok = ok & (have - high * words <= room)
        if both:
            ok = ok & (low * words - have <= room)
    return F.coalesce(ok, F.lit(False))


def judge(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """``docs`` with ``__counts``, ``__base_failed`` and ``__kept``."""
    counted = with_counts(docs)
    measured = with_counts(docs.select("lang", "source", "text"), ["lang", "source"], windows=False)
    limits = stored(thresholds(sketches(measured), min_group), "quality-thresholds")
    limits = limits.withColumnsRenamed({"lang": "__l", "source": "__s"})
    c = F.col("__counts")
    failed = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEATED_PERCENT * c["n_words"])
    joined = counted.join(limits, counted["lang"].eqNullSafe(limits["__l"]) & counted["source"].eqNullSafe(limits["__s"]), "left")
    return joined.withColumn("__base_failed", failed).withColumn("__kept", ~failed & within_fences()).select(
        *docs.columns, "__counts", "__base_failed", "__kept"
    )


def drop_low_quality(docs: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    return judge(docs, min_group).where("__kept").select(*docs.columns)
