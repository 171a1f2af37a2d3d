"""Chat formatting of reply trees.

Messages name their parent; a conversation is a path from a root to a leaf.
Paths are enumerated by iterative self-joins that double their reach: the jump
table of round k leads from a message to its ancestor 2^k levels up and is the
self-join of the table before it, so a path of depth d takes log2(d) rounds and
no row ever holds a growing array.  From the leaves, the tables applied in turn
give every (leaf, ancestor) pair once, which is the size of the output.
Branches are ranked by the mean score of their messages within their tree, and
each chosen path is formatted as one conversation.

Template: ``<|im_start|>role\\ntext<|im_end|>\\n`` a turn.  A control string
inside a text gets a backslash after its first character, one that already has
backslashes there gets one more, so the template's marks are unambiguous and
unescaping restores every text.  Line feeds and backslashes in a role are
written ``\\n`` and ``\\\\``.

Cases: null role or text counts as empty; a null score counts as 0; a parent
that does not exist in the tree, or is the message itself, makes its message a
root; messages on or below a cycle belong to no root and are left out;
repeated message ids count once (the smallest of their rows); ties between
branches go to the longer, then to the smaller leaf id; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored

START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<s>", "</s>", "[INST]", "[/INST]")
_FIRST = "([" + re.escape("".join(sorted({c[0] for c in CONTROL}))) + "])"
_REST = "(?:" + "|".join(re.escape(c[1:]) for c in CONTROL) + ")"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_FIRST}(?=\\*{_REST})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_FIRST}\\(?=\\*{_REST})", "$1")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(role: Column) -> Column:
    lines = F.regexp_replace(unescape(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(lines, F.lit("\\\\"), F.lit("\\"))


def messages_of(df: DataFrame) -> DataFrame:
    """``tree_id, msg_id`` unique, with ``parent_id, role, text, score``."""
    body = F.struct("parent_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "score")
    return df.groupBy("tree_id", "msg_id").agg(F.min(body).alias("m")).select("tree_id", "msg_id", "m.*")


def _on_node(a: DataFrame, b: DataFrame, left: str, right: str) -> Column:
    return a["tree_id"].eqNullSafe(b["t"]) & (a[left] == b[right])


def jump_tables(messages: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """``(tree_id, node, up)`` for 1, 2, 4, ... levels, and the nodes that reach
    no root because of a cycle (None without one)."""
    nodes = messages.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("id"))
    child = messages.where(F.col("parent_id") != F.col("msg_id")).select("tree_id", F.col("msg_id").alias("node"), F.col("parent_id").alias("up"))
    table = stored(child.join(nodes, _on_node(child, nodes, "up", "id"), "left_semi"), "jump")
    tables, most = [], messages.count()
    while not table.isEmpty():
        if 1 << len(tables) > most:
            return tables, table.select("tree_id", "node")
        tables.append(table)
        upper = table.select(F.col("tree_id").alias("t"), F.col("node").alias("middle"), F.col("up").alias("top"))
        table = stored(table.join(upper, _on_node(table, upper, "up", "middle")).select("tree_id", "node", F.col("top").alias("up")), "jump")
    return tables, None


def paths(messages: DataFrame) -> DataFrame:
    """``(tree_id, leaf, msg_id, height)``: every leaf with each message of its
    path, ``height`` levels above the leaf."""
    tables, unrooted = jump_tables(messages)
    nodes = messages.select("tree_id", F.col("msg_id").alias("leaf"))
    if tables:
        inner = tables[0].select(F.col("tree_id").alias("t"), "up").distinct()
        nodes = nodes.join(inner, _on_node(nodes, inner, "leaf", "up"), "left_anti")
    if unrooted is not None:
        lost = unrooted.select(F.col("tree_id").alias("t"), "node")
        nodes = nodes.join(lost, _on_node(nodes, lost, "leaf", "node"), "left_anti")
    found = nodes.select("tree_id", "leaf", F.col("leaf").alias("msg_id"), F.lit(0).cast("long").alias("height"))
    for k, table in enumerate(tables):
        jump = table.select(F.col("tree_id").alias("t"), "node", "up")
        higher = found.join(jump, _on_node(found, jump, "msg_id", "node")).select("tree_id", "leaf", F.col("up").alias("msg_id"), (F.col("height") + (1 << k)).alias("height"))
        found = stored(found.unionByName(higher), "paths")
    return found


def chosen_paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """The turns ``(tree_id, leaf, rank, height, role, text)`` of the ``best`` branches of each tree."""
    found = paths(messages)
    body = messages.select(F.col("tree_id").alias("t"), F.col("msg_id").alias("id"), "role", "text", F.coalesce(F.col("score").cast("decimal(28,9)"), F.lit(0)).alias("score"))
    scores = found.join(body.select("t", "id", "score"), _on_node(found, body, "msg_id", "id"))
    branches = scores.groupBy("tree_id", "leaf").agg(F.avg("score").alias("mean"), F.count("*").alias("turns"))
    order = Window.partitionBy("tree_id").orderBy(F.col("mean").desc(), F.col("turns").desc(), "leaf")
    top = branches.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    top = top.select(F.col("tree_id").alias("t"), F.col("leaf").alias("l"), "rank")
    turns = found.join(top, _on_node(found, top, "leaf", "l")).drop("t", "l")
    return turns.join(body.drop("score"), _on_node(turns, body, "msg_id", "id")).select("tree_id", "leaf", "rank", "height", "role", "text")


def format_paths(turns: DataFrame) -> DataFrame:
    """One row a conversation: ``tree_id, leaf, rank, formatted, loss_spans``,
    the spans being the code points [start, end) of each assistant text."""
    head = F.concat(F.lit(START), _escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    turn = F.struct(
        (-F.col("height")).alias("at"), F.concat(head, body, F.lit(END + "\n")).alias("formatted"),
        F.length(head).cast("long").alias("lead"), F.length(body).cast("long").alias("size"), (F.col("role") == ASSISTANT).alias("loss"),
    )
    whole = turns.groupBy("tree_id", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    tail = len(END) + 1
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def add(a: Column, t: Column) -> Column:
        first = a["at"] + t["lead"]
        span = F.struct(first.alias("start"), (first + t["size"]).alias("end"))
        return F.struct((first + t["size"] + tail).alias("at"), F.when(t["loss"], F.array_append(a["spans"], span)).otherwise(a["spans"]).alias("spans"))

    return whole.select(
        "tree_id", "leaf", "rank",
        F.array_join(F.transform("turns", lambda t: t["formatted"]), "").alias("formatted"),
        F.aggregate("turns", start, add)["spans"].alias("loss_spans"),
    )


def format_trees(df: DataFrame, best: int = 1) -> DataFrame:
    """Conversations of a table ``tree_id, msg_id, parent_id, role, text, score``."""
    return format_paths(chosen_paths(stored(messages_of(df), "messages"), best))


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation as ``array<struct<role, text>>``."""
    parts = F.filter(F.split(formatted, re.escape(END) + "\n", -1), lambda p: p != "")
    cut = len(START) + 1

    def turn(p: Column) -> Column:
        end = F.instr(p, "\n")
        role = F.substr(p, F.lit(cut), end - cut)
        return F.struct(_unescape_role(role).alias("role"), unescape(F.substr(p, end + 1)).alias("text"))

    return F.transform(parts, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")


def chain_messages(conversations: DataFrame) -> DataFrame:
    """Turn-ordered conversations as trees of one branch: each turn replies to
    the one before it (ties: by role, then text)."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = conversations.withColumn("n", F.row_number().over(order).cast("long"))
    return placed.select(
        F.col("conv_id").alias("tree_id"), F.col("n").alias("msg_id"), F.when(F.col("n") > 1, F.col("n") - 1).alias("parent_id"),
        "role", "text", F.lit(1.0).alias("score"),
    )
