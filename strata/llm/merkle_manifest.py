"""A Merkle manifest of a table: one digest a row, one root a source, one root.

Every row is a leaf, the SHA-256 of its columns written as ``-`` for null, else
as the length in UTF-8 bytes, a colon and the value.  A source's leaves ascend
by doc_id; each run of three consecutive nodes becomes its parent, the hash of
the run's hex digests, until one node is left, the source's subroot.  The
subroots, ordered by source, become the root in the same way.

A tree of any size is built from aligned blocks of 3^5 nodes.  A block keeps
each of its levels as one hex string: fixed-width substrings are the runs whose
hashes form the next level's string, and what flanks a node inside its run is
that level's segment of the node's proof.  The blocks' last digests are the
nodes of the next round, so a round is one grouping of bounded blocks and a
hundred thousand million leaves take five.  On the way back each block hands
its members the segments of its own levels and those of the rounds above.

Positions come from a sort by ranges (``common.dealt``), so a source with a third
of all rows is spread over tasks, and texts never leave the task that reads
them: only digests and ids are shuffled.

Cases: null columns are written as above, an empty text as ``0:``; null
doc_ids come first in their source and null is a source of its own, before
all others; rows equal in doc_id are ordered by leaf, so repeated rows are
leaves of their own whose order changes nothing; a lone leaf is its subroot
and a lone subroot the root; an empty table gives an empty manifest; columns
that are not named are neither hashed nor returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import dealt, positions, same, stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 64  # hex digits of a digest
ARITY = 3
LEVELS = 5
BLOCK = ARITY**LEVELS
PROOF = "array<struct<left:string,right:string>>"


class Manifest(NamedTuple):
    """``leaves``: doc_id, source, position, leaf, proof, subroot, root and the
    carried columns; ``sources``: source, documents, subroot, proof, root."""

    leaves: DataFrame
    sources: DataFrame


def leaf(values: Sequence[Column]) -> Column:
    """The digest of a row from its columns."""
    text = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t), F.lit(":"), t)) for t in text)), 256)


def fold(node: Column, proof: Column) -> Column:
    """The root that a leaf leads to with its proof."""
    return F.aggregate(proof, node, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def _parents(level: Column) -> Column:
    run = WIDTH * ARITY
    runs = F.sequence(F.lit(0), F.floor((F.length(level) - 1) / run).cast("int"))
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substr(level, i * run + 1, F.lit(run)), 256)), "")


def _blocks(nodes: DataFrame, group: list[str]) -> DataFrame:
    """One row a block: its members, its levels ``l0``, ``l1`` ... as hex
    strings, as many as it climbs, and the digest on top."""
    member = F.struct("position", "node", "carried")
    blocks = nodes.groupBy(*group, "total", F.floor(F.col("position") / BLOCK).alias("block")).agg(F.sort_array(F.collect_list(member)).alias("members"))
    climbs = sum((F.col("total") > ARITY**j).cast("int") for j in range(LEVELS))
    blocks = blocks.withColumn("climbs", climbs).withColumn("l0", F.array_join(F.col("members.node"), ""))
    for j in range(LEVELS):
        blocks = blocks.withColumn(f"l{j + 1}", F.when(F.col("climbs") > j, _parents(F.col(f"l{j}"))))
    top = F.coalesce(*(F.col(f"l{j}") for j in reversed(range(LEVELS + 1))))
    return blocks.withColumn("top", top).withColumn("members", F.transform("members", lambda m: m.dropFields("node")))


def _climb(nodes: DataFrame, group: list[str], name: str) -> list[DataFrame]:
    """The blocks of each round, up to the one where every group has one block."""
    rounds = []
    while True:
        blocks = stored(_blocks(nodes, group), f"{name}-{len(rounds)}", compression="zstd")
        rounds.append(blocks)
        if (blocks.agg(F.max("total")).first()[0] or 0) <= BLOCK:
            return rounds
        total = F.ceil(F.col("total") / BLOCK)
        nodes = blocks.where(F.col("total") > BLOCK).select(
            *group, F.col("block").alias("position"), total.alias("total"), F.col("top").alias("node"), F.struct(F.lit(True).alias("inner")).alias("carried")
        )


def _segments(at: Column) -> Column:
    """The segments of a member, by its place in the block: what flanks it, and
    then its ancestors, in their runs."""
    levels = []
    for j in range(LEVELS):
        place = F.floor(at / ARITY**j)
        run = F.substr(F.col(f"l{j}"), (F.floor(place / ARITY) * ARITY * WIDTH + 1).cast("int"), F.lit(ARITY * WIDTH))
        own = (F.pmod(place, F.lit(ARITY)) * WIDTH).cast("int")
        levels.append(F.struct(F.substr(run, F.lit(1), own).alias("left"), F.substr(run, own + WIDTH + 1).alias("right")))
    return F.slice(F.array(*levels), F.lit(1), F.col("climbs"))


def _descend(rounds: list[DataFrame], group: list[str], ends: DataFrame | None) -> DataFrame:
    """Every node of the first round with ``carried``, ``node``, its whole
    ``proof``, ``subroot`` (of its group) and ``root``.  ``ends`` (group,
    proof, root) continues the groups' own trees."""
    above: DataFrame | None = None
    for blocks in reversed(rounds):
        tops = blocks.where(F.col("total") <= BLOCK).select(*group, F.lit(0).cast("long").alias("position"), F.col("top").alias("subroot"))
        if ends is None:
            tops = tops.select("*", F.array().cast(PROOF).alias("proof"), F.col("subroot").alias("root"))
        else:
            more = ends.select(*(F.col(g).alias(f"__{g}") for g in group), "proof", "root")
            tops = tops.join(more, same(tops, more, *group)).select(*group, "position", "subroot", "proof", "root")
        upper = tops if above is None else tops.unionByName(above.select(tops.columns))
        upper = upper.select(*(F.col(g).alias(f"__{g}") for g in group), "position", "subroot", F.col("proof").alias("rest"), "root")
        met = blocks.join(upper, same(blocks, upper, *group) & (blocks["block"] == upper["position"])).drop("position")
        one = met.select("*", F.posexplode("members").alias("at", "member"))
        above = one.select(
            *group, F.col("member.position").alias("position"), F.col("member.carried").alias("carried"),
            F.substr("l0", F.col("at") * WIDTH + 1, F.lit(WIDTH)).alias("node"),
            F.concat(_segments(F.col("at")), F.col("rest")).alias("proof"), "subroot", "root",
        )
    return above


def build(docs: DataFrame, columns: Sequence[str] = COLUMNS, key: str = "doc_id", source: str = "source", carry: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``; ``carry`` names further columns, as
    expressions over ``docs``, that go along with the leaves."""
    carried = F.struct(F.col(key).alias("doc_id"), *(c.alias(n) for n, c in (carry or {}).items()))
    leaves = docs.select(F.col(source).alias("source"), leaf([F.col(c) for c in columns]).alias("node"), carried.alias("carried"))
    placed = positions(dealt(leaves, ["source"], [F.col("carried.doc_id").asc_nulls_first(), F.col("node").asc()], "merkle-leaves"), ["source"])
    rounds = _climb(placed, ["source"], "merkle")

    last = [b.where(F.col("total") <= BLOCK).select("source", F.col("top").alias("node")) for b in rounds]
    subroots = last[0]
    for more in last[1:]:
        subroots = subroots.unionByName(more)
    subroots = subroots.select("source", "node", F.struct("source").alias("carried"))
    above = _climb(positions(dealt(subroots, [], [F.col("source").asc_nulls_first()], "merkle-sources"), []), [], "merkle-root")
    ends = stored(_descend(above, [], None).select("carried.source", F.col("node").alias("subroot"), "proof", "root"), "merkle-ends")

    out = _descend(rounds, ["source"], ends).select("carried.*", "source", "position", F.col("node").alias("leaf"), "proof", "subroot", "root")
    counts = placed.groupBy("source").agg(F.count("*").alias("documents")).withColumnRenamed("source", "__source")
    return Manifest(out, ends.join(counts, same(ends, counts, "source")).select("source", "documents", "subroot", "proof", "root"))
