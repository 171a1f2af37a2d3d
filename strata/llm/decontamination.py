"""Benchmark decontamination by winnowing.

A benchmark item is covered by windows of ``SPAN`` consecutive words (a shorter
item is one window).  A document is contaminated where it holds one of them.

Winnowing finds the candidates.  Of a text's k-grams the one with the smallest
hash in every window of w grams is kept; with ``k + w - 1`` equal to the
window's length, a passage that long has the same w grams in both texts and so
the same kept one: every shared window meets in a fingerprint, although only
about 2 of w + 1 grams are kept.  Documents' fingerprints are reduced by a
semi-join with the benchmark's, which keeps each once, however many windows or
documents share it.  What is left is extended to the full windows around the
fingerprint, which are joined by their words with the benchmark's distinct
windows: that join is exact, each candidate meets one window at most, and
passages that many items share multiply nothing before items are named.

The lengths below ``SPAN`` that items really have are winnowed in the same way,
each with its own k and w.

Everything is DataFrame functions.  A text's grams, minima and fingerprints
are arrays of its own row, linear in its words; only fingerprints, with the
words around them, are joined.

Cases: null and empty texts have no words, such items no windows and such
documents no hits; repeated items or rows count by their id and are found each;
rows that share doc_id and text are treated alike; a null item_id is the item
``null``; a null doc_id is kept; tables may be empty; all columns of the
documents stay, names that clash included.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored

SPAN = 10
_PLACE_BITS = 30  # a text has less than 2^30 words: each takes a byte and a separator
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SEPARATORS_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class Found(NamedTuple):
    """``spans``: doc_id, text_key, start, end of each window found (in words,
    end exclusive); ``items``: doc_id, text_key, item_id, each pair once."""

    spans: DataFrame
    items: DataFrame


def words(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _SEPARATORS, -1), "")


def count_words(text: Column) -> Column:
    """The number of ``words``, which doesn't depend on their case."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATORS_ANY_CASE, -1), "")).cast("long")


def gram_and_window(span: int) -> tuple[int, int]:
    """k and w with ``k + w - 1 == span``."""
    k = (span + 1) // 2
    return k, span - k + 1


def _minima(df: DataFrame, span: int) -> DataFrame:
    """Column ``minima`` from column ``words``: of each window of ``span``
    words, the smallest gram hash with the gram's place in its low bits."""
    k, w = gram_and_window(span)
    n = F.size("words")
    mask = F.lit(-(1 << _PLACE_BITS)).cast("long")
    grams = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(F.slice("words", i + 1, k)).bitwiseAND(mask) + i)
    df = df.withColumn("grams", F.when(n >= span, grams))
    if w == 1:
        return df.withColumnRenamed("grams", "minima")
    # ``grams`` is named twice, so that the optimizer doesn't move its computation into the function over the windows
    lowest = F.transform(F.sequence(F.lit(1), F.size("grams") - w + 1), lambda s: F.array_min(F.slice("grams", s, w)))
    return df.withColumn("minima", F.when(n >= span, lowest)).drop("grams")


def _print(minimum: Column) -> Column:
    return F.shiftright(minimum, _PLACE_BITS)


def _windows(span: int, of: str) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size(of) - span), lambda i: F.array_join(F.slice(of, i + 1, span), " "))


def benchmark_windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``span, window, print, item_id`` of every item, each once, stored."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), words(F.col("text")).alias("words"))
    items = items.where(F.size("words") > 0).withColumn("span", F.least(F.size("words"), F.lit(span)))
    lengths = sorted(r[0] for r in items.select("span").distinct().collect())  # span values at most
    parts = []
    for length in lengths or [span]:
        own = _minima(items.where(F.col("span") == length), length)
        both = own.select("item_id", F.explode_outer(F.arrays_zip(_windows(length, "words").alias("window"), F.col("minima").alias("minimum"))).alias("z"))
        parts.append(both.select(F.lit(length).alias("span"), F.col("z.window").alias("window"), _print(F.col("z.minimum")).alias("print"), "item_id"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return stored(whole.distinct(), "benchmark-windows")


def _fingerprints(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """``doc_id, text_key, span, print, start, around``: every fingerprint with
    the words of all windows it can be in, the first being word ``start``.
    The outer explode gives a text without fingerprints a row of nulls, which
    joins with nothing; the inner one would compute all arrays twice, for a
    filter that the optimizer derives from it."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words"))
    out = None
    for span in lengths:
        _, w = gram_and_window(span)

        def mark(v: Column) -> Column:
            place = v.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)).cast("int")
            start = F.greatest(place - (w - 1), F.lit(0))
            return F.struct(_print(v).alias("print"), start.alias("start"), F.slice("words", start + 1, place - start + span).alias("around"))

        kept = _minima(texts, span).withColumn("marks", F.transform(F.array_distinct("minima"), mark))
        rows = kept.select("doc_id", "text_key", F.lit(span).alias("span"), F.explode_outer("marks").alias("m")).select("doc_id", "text_key", "span", "m.*")
        out = rows if out is None else out.unionByName(rows)
    return out


def find(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> Found:
    """The windows of ``benchmark`` (item_id, text) in ``docs`` (doc_id, text)."""
    postings = benchmark_windows(benchmark, span)
    lengths = sorted(r[0] for r in postings.select("span").distinct().collect())
    prints = stored(postings.select("span", "print").distinct(), "benchmark-prints")
    known = postings.select("span", "window").distinct().withColumn("window_id", F.monotonically_increasing_id())
    known = stored(known, "benchmark-distinct")

    marks = _fingerprints(docs, lengths or [span]).join(prints, ["span", "print"], "left_semi")
    inner = F.transform(F.sequence(F.lit(0), F.size("around") - F.col("span")), lambda i: F.array_join(F.slice("around", i + 1, F.col("span")), " "))
    candidates = marks.select("doc_id", "text_key", "span", "start", F.posexplode_outer(inner).alias("at", "window"))
    hits = candidates.join(known, ["span", "window"]).select(
        "doc_id", "text_key", (F.col("start") + F.col("at")).alias("start"), (F.col("start") + F.col("at") + F.col("span")).alias("end"), "window_id"
    )
    hits = stored(hits.distinct(), "contaminated-windows")

    named = postings.join(known, ["span", "window"]).select("window_id", "item_id")
    named = stored(named, "benchmark-items")
    met = hits.select("doc_id", "text_key", "window_id").distinct()
    return Found(hits.drop("window_id"), met.join(named, "window_id").select("doc_id", "text_key", "item_id").distinct())


def covered(spans: DataFrame) -> DataFrame:
    """``doc_id, text_key, n_hit``: the words of each document inside any window."""
    ordered = F.sort_array(F.collect_set(F.struct("start", "end")))
    first = F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n"))

    def add(a: Column, s: Column) -> Column:
        fresh = F.greatest(s["end"] - F.greatest(s["start"], a["to"]), F.lit(0))
        return F.struct(F.greatest(a["to"], s["end"]).alias("to"), (a["n"] + fresh).alias("n"))

    return spans.groupBy("doc_id", "text_key").agg(F.aggregate(ordered, first, add)["n"].alias("n_hit"))


def mark(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` with ``__n_words``, ``__n_hit`` and ``__items``, the sorted ids
    of the items found (empty: not contaminated)."""
    found = find(docs, benchmark, span)
    items = found.items.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_set("item_id")).alias("__items"))
    both = covered(found.spans).withColumnsRenamed({"doc_id": "i", "text_key": "k"}).join(items, F.col("i").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("text_key")))
    both = both.select(F.col("i").alias("__id"), F.col("k").alias("__key"), F.col("n_hit").alias("__n_hit"), "__items")
    keyed = docs.withColumn("__text_key", F.xxhash64("text")).withColumn("__n_words", count_words(F.col("text"))).withColumn("__own_id", F.col("doc_id"))
    joined = keyed.join(both, keyed["__own_id"].eqNullSafe(both["__id"]) & (keyed["__text_key"] == both["__key"]), "left")
    none = F.array().cast("array<string>")
    return joined.select(*(keyed[c] for c in docs.columns), "__n_words", F.coalesce("__n_hit", F.lit(0)).alias("__n_hit"), F.coalesce("__items", none).alias("__items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """The documents that hold no window of the benchmark."""
    return mark(docs, benchmark, span).where(F.size("__items") == 0).select(*docs.columns)
