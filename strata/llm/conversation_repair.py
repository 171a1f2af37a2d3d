"""Repair of conversations whose turns were lost, doubled, blanked or cut.

A conversation is well formed if its role initials match ``(s?(ua)+)?``.  The
repair is the cheapest list of edits: Keep a row (0), Rerole it to user or
assistant (3), Delete it (4; blank and duplicate rows must go), Insert an empty
turn (3); a truncated row that stays costs 3 more.  Equal costs go to the
ASCII-least list of initials.

The rows are parsed by a generalised LR parser for

    C -> empty | D      D -> E u a | D u a      E -> empty | s

Every edit is an action of the parser: Keep and Rerole shift a symbol, Insert
shifts one that no row has, Delete shifts none.  All alternatives live in one
graph-structured stack; stacks with equal tops are merged and the minimum of
(cost, audit) stays.  That loses nothing: with this grammar a top fixes what is
below it, and of two lists of edits for the same rows neither is the beginning
of the other at equal cost, so their order is not changed by what follows.

A long conversation is parsed in segments of ``SEGMENT`` rows, each from every
top that it could begin with; a last pass joins the segments' results.  Rows
are numbered by a sort by ranges and only their role initials and faults, one
character each, are gathered; texts meet their edits again by row id.  So the
rows of one conversation never meet in one task; only its list of edits does,
which is one value of the result.

Cases: a null role or text counts as one space; a null turn comes first, rows
of one turn are ordered by role, then text; a null conv_id is a conversation;
a role with another initial can't be kept; conversations without rows have an
empty report; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ASCII_SPACE, dealt, map_rows, positions, rows_of, same, stored, to_batch

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SEGMENT = 1024
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")

# The parser's tables.  Rules: D -> E u a, D -> D u a, E -> empty, E -> s, with the length of their right side.
_RULES = {"ended_pair": ("D", 3), "ended_more": ("D", 3), "no_system": ("E", 0), "system": ("E", 1)}
_SHIFT = {(0, "s"): 1, (2, "u"): 3, (3, "a"): 4, (5, "u"): 6, (6, "a"): 7}
_GOTO = {(0, "E"): 2, (0, "D"): 5}
#: Rules that need no look-ahead, and the one that waits for a user.
_REDUCE, _REDUCE_BEFORE = {1: "system", 4: "ended_pair", 7: "ended_more"}, {(0, "u"): "no_system"}
ACCEPT = (0, 5)

#: A node of the graph-structured stack: its state and the node below.
Node = tuple


def _reduced(node: Node, rule: str) -> Node:
    left, length = _RULES[rule]
    for _ in range(length):
        node = node[1]
    return (_GOTO[node[0], left], node)


def shifted(node: Node, symbol: str) -> Node | None:
    """The stack after ``symbol``, with all reductions done, or None."""
    if (node[0], symbol) in _REDUCE_BEFORE:
        node = _reduced(node, _REDUCE_BEFORE[node[0], symbol])
    state = _SHIFT.get((node[0], symbol))
    if state is None:
        return None
    node = (state, node)
    while node[0] in _REDUCE:
        node = _reduced(node, _REDUCE[node[0]])
    return node


def _stacks() -> dict[int, Node]:
    """The stack below every top that can stand between two rows."""
    found, open_ = {}, [(0, None)]
    while open_:
        node = open_.pop()
        if node[0] not in found:
            found[node[0]] = node
            open_ += [n for n in (shifted(node, s) for s in "sua") if n]
    return found


STACKS = _stacks()

#: The tops of the stack at one place: state -> (cost, audit).  The top names its stack.
Tops = dict


def _merge(tops: Tops, node: Node, cost: int, audit: str) -> bool:
    """Merge a stack with the one of equal top; True if it is the better."""
    old = tops.get(node[0])
    if old is None or (cost, audit) < old:
        tops[node[0]] = (cost, audit)
        return True
    return False


def inserted(tops: Tops) -> Tops:
    """``tops`` with all that Insert can make of them."""
    tops, open_ = dict(tops), list(tops)
    while open_:
        state = open_.pop()
        cost, audit = tops[state]
        for symbol in ROLES:
            node = shifted(STACKS[state], symbol)
            if node and _merge(tops, node, cost + INSERT, audit + "I"):
                open_.append(node[0])
    return tops


def parse(tops: Tops, initials: str, faults: str) -> Tops:
    """The tops after a row for each character; faults: b blank, d duplicate, t truncated, k none."""
    for initial, fault in zip(initials, faults):
        after: Tops = {}
        extra = TRUNCATED if fault == "t" else 0
        for state, (cost, audit) in inserted(tops).items():
            stack = STACKS[state]
            _merge(after, stack, cost + DELETE, audit + "D")
            if fault in "bd":
                continue
            if kept := shifted(stack, initial):
                _merge(after, kept, cost + KEEP + extra, audit + "K")
            for symbol in ROLES:
                if changed := shifted(stack, symbol):
                    _merge(after, changed, cost + REROLE + extra, audit + "R")
        tops = after
    return tops


def best(tops: Tops) -> tuple[int, str]:
    """The cheapest whole parse."""
    return min(t for state, t in inserted(tops).items() if state in ACCEPT)


class Repair(NamedTuple):
    """``report``: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit; ``turns``: the repaired rows, conv_id, place (from 0), role, text."""

    report: DataFrame
    turns: DataFrame


_PARSED = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("initials", pa.string()), ("row_ids", pa.list_(pa.int64())),
    ("ways", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))),
])
_EDITED = pa.schema([
    ("conv_id", pa.int64()), ("segment", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()),
    ("edits", pa.list_(pa.struct([("place", pa.int64()), ("row_id", pa.int64()), ("role", pa.string())]))),
])


def _parse_segments(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv_id, segment, alone, initials, faults, row_ids in rows:
        ways = []
        for first in (0,) if alone else STACKS:
            ways += [{"first": first, "last": t, "cost": c, "audit": a} for t, (c, a) in parse({first: (0, "")}, initials, faults).items()]
        yield conv_id, segment, initials, row_ids, ways


def _join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chosen edits, a row for each segment; segments of a conversation arrive in order."""
    rows = rows_of(batches, "conv_id", "segment", "initials", "row_ids", "ways")
    for conv_id, group in groupby(rows, key=lambda r: r[0]):
        tops, segments, illegal, before = {0: (0, "")}, [], 0, ""
        for _, segment, initials, row_ids, ways in group:
            after: Tops = {}
            for w in ways:
                if w["first"] in tops:
                    cost, audit = tops[w["first"]]
                    _merge(after, STACKS[w["last"]], cost + w["cost"], audit + w["audit"])
            tops = after
            pair = before + initials
            illegal += sum(pair[i : i + 2] not in LEGAL for i in range(len(pair) - 1))
            before = initials[-1]
            segments.append((segment, initials, row_ids))
        cost, audit = best(tops)
        at, place, stack, out = 0, 0, STACKS[0], []
        for n, (segment, initials, row_ids) in enumerate(segments):
            edits, row = [], 0
            while at < len(audit) and (row < len(row_ids) or audit[at] == "I") and (row < len(row_ids) or n == len(segments) - 1):
                act = audit[at]
                at += 1
                if act != "D":
                    symbol = initials[row] if act == "K" else next(s for s in ROLES if shifted(stack, s))
                    stack = shifted(stack, symbol)
                    edits.append({"place": place, "row_id": None if act == "I" else row_ids[row], "role": None if act == "K" else ROLES[symbol]})
                    place += 1
                row += act != "I"
            out.append((conv_id, segment, illegal, cost, audit if n == 0 else None, edits))
        yield to_batch(out, _EDITED)


def repair(conversations: DataFrame, segment: int = SEGMENT) -> Repair:
    """Reports and repaired turns of a table ``conv_id, turn, role, text``."""
    space = F.lit(" ")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    placed = dealt(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()], "conversation-rows")

    visible = F.rtrim("text", F.lit(ASCII_SPACE))
    own = F.when(visible == "", "b").when(~F.right(visible, F.lit(1)).isin(".", "!", "?"), "t").otherwise("k")
    initial = F.left("role", F.lit(1))
    narrow = positions(placed.select(
        "conv_id", "turn", "row_id", F.md5(F.concat("role", F.lit("\n"), "text")).alias("said"), own.alias("own"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
    ), ["conv_id"])
    narrow = stored(narrow, "conversation-marks", compression="zstd")
    first = narrow.groupBy("conv_id", "said").agg(F.min("position").alias("__position"))
    first = first.select(F.col("conv_id").alias("__conv_id"), "__position")
    judged = narrow.join(first, same(narrow, first, "conv_id", "position"), "left").select(
        *narrow.columns, F.when((F.col("own") != "b") & F.col("__position").isNull(), "d").otherwise(F.col("own")).alias("fault")
    )
    judged = stored(judged.drop("said", "own"), "conversation-faults", compression="zstd")

    member = F.struct("position", "initial", "fault", "row_id")
    segments = judged.groupBy("conv_id", "total", F.floor(F.col("position") / segment).alias("segment")).agg(F.sort_array(F.collect_list(member)).alias("m"))
    segments = segments.select(
        "conv_id", "segment", (F.col("total") <= segment).alias("alone"), F.array_join("m.initial", "").alias("initials"), F.array_join("m.fault", "").alias("faults"), F.col("m.row_id").alias("row_ids")
    )
    names = ["conv_id", "segment", "alone", "initials", "faults", "row_ids"]
    parsed = segments.mapInArrow(
        map_rows(_parse_segments, names, _PARSED, 256),
        "conv_id long, segment long, initials string, row_ids array<long>, ways array<struct<first:int,last:int,cost:long,audit:string>>",
    )
    ordered = parsed.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    edited = stored(ordered.mapInArrow(
        _join_segments, "conv_id long, segment long, illegal long, cost long, audit string, edits array<struct<place:long,row_id:long,role:string>>"
    ), "conversation-edits", compression="zstd")

    is_ = lambda f: F.count_if(F.col("fault") == f)
    by_turn = judged.groupBy("conv_id", "turn").agg(is_("b").alias("b"), is_("d").alias("d"), is_("t").alias("t"))
    gap = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    counts = by_turn.groupBy(F.col("conv_id").alias("__conv_id")).agg(
        gap.alias("gaps"), F.sum("b").alias("blank"), F.sum("d").alias("duplicate"), F.sum("t").alias("truncated")
    )
    heads = edited.where(F.col("segment") == 0)
    report = heads.join(counts, same(heads, counts, "conv_id")).select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = edited.select("conv_id", F.explode("edits").alias("e")).select("conv_id", "e.place", F.col("e.row_id").alias("__row_id"), F.col("e.role").alias("new_role"))
    said = placed.select("row_id", "role", "text")
    kept = edits.join(said, edits["__row_id"] == said["row_id"]).select("conv_id", "place", F.coalesce("new_role", "role").alias("role"), "text")
    added = edits.where(F.col("__row_id").isNull()).select("conv_id", "place", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return Repair(report, kept.unionByName(added))
