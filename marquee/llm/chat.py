"""Operator 10: reply trees to conversations, in DataFrame functions only.

Nodes point to their parents.  Pointer-jumping self-joins (the pointer of
round k spans 2^k replies) give every node its depth and path score in
logarithmically many rounds; leaves are ranked per tree by path score; the
chosen leaves' paths are unfolded by the same pointers, longest first; and
each path is formatted as one conversation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import written

# The marks of the template.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Control strings are broken by a backslash after their first character; a
#: backslash is doubled.  Both are undone by dropping the first of any pair.
_CONTROL = r"(\\)|([<\[])(?=\||/?s>|/?INST\]|<?/?SYS>)"
_MARK_SPLIT = r"<\|turn\|>"


def escape(col):
    return F.regexp_replace(col, _CONTROL, r"$1$2\\")


def unescape(col):
    return F.regexp_replace(col, r"(?s)\\(.)", "$1")


def _keyed(nodes: DataFrame) -> DataFrame:
    """Tree and node keys as text without nulls, so that equi-joins hold them."""
    key = lambda c: F.coalesce(F.concat(F.lit("k"), F.col(c).cast("string")), F.lit(""))
    return nodes.select(key("tree_id").alias("tree"), key("node_id").alias("node"),
                        F.when(F.col("parent_id").isNotNull(), key("parent_id")).alias("up"),
                        F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))


def best_paths(nodes: DataFrame, branches: int = 1) -> DataFrame:
    """The ``branches`` best root-to-leaf paths per tree.

    ``nodes``: tree_id, node_id (unique in its tree), parent_id (null or
    absent from the tree: a root), score (null: 0).  Returns tree, path (the
    leaf), branch (rank from 1: higher summed score first, then the smaller
    node text), node, back (replies between the node and the leaf).  Nodes
    on a cycle hang from no root and take part in no path.
    """
    slim = written(_keyed(nodes), "chat-nodes")
    known = slim.select("tree", F.col("node").alias("up"), F.lit(True).alias("known"))
    state = (slim.join(known, ["tree", "up"], "left")
             .select("tree", "node", F.when(F.col("known"), F.col("up")).alias("ptr"), F.col("score").alias("total")))
    state = written(state, "chat-state")
    levels, done, pending = [], state.where("ptr is null"), state.where("ptr is not null")
    left = pending.count()
    while left:
        levels.append(pending.select("tree", "node", "ptr"))
        # only nodes that have not met their root are joined again
        far = done.unionByName(pending).select("tree", F.col("node").alias("ptr"), F.col("ptr").alias("next"), F.col("total").alias("more"))
        state = written(pending.join(far, ["tree", "ptr"]).select(
            "tree", "node", F.col("next").alias("ptr"), (F.col("total") + F.col("more")).alias("total")), "chat-state")
        done, pending = done.unionByName(state.where("ptr is null")), state.where("ptr is not null")
        before, left = left, pending.count()
        if left == before:  # only nodes above which a cycle runs
            break
    parents = slim.where(F.col("up").isNotNull()).select("tree", F.col("up").alias("node")).distinct()
    leaves = done.join(parents, ["tree", "node"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("total").desc(), "node"))
    paths = (leaves.withColumn("branch", rank).where(F.col("branch") <= branches)
             .select("tree", F.col("node").alias("path"), "branch", "node", F.lit(0).cast("long").alias("back")))
    for k, level in reversed(list(enumerate(levels))):
        jump = paths.join(level, ["tree", "node"]).select(
            "tree", "path", "branch", F.col("ptr").alias("node"), (F.col("back") + (1 << k)).alias("back"))
        paths = written(paths.unionByName(jump), "chat-paths")
    return paths


def format_paths(nodes: DataFrame, branches: int = 1, loss_role: str = "assistant") -> DataFrame:
    """One conversation per chosen path: tree_id, branch, n_nodes, formatted,
    loss_spans (array of start and length in code points of ``formatted``:
    the texts of ``loss_role``).

    ``nodes`` as in ``best_paths`` plus role and text (null: empty).  Roles
    and texts are escaped, so the marks in ``formatted`` are the template's
    alone.  Repeated (tree, node) rows must be numbered apart beforehand; an
    empty table gives no rows; other columns are not read.
    """
    paths = best_paths(nodes, branches)
    keys = _keyed(nodes).columns[:2]
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    parts = nodes.select("tree_id", F.coalesce(F.concat(F.lit("k"), F.col("tree_id").cast("string")), F.lit("")).alias(keys[0]),
                         F.coalesce(F.concat(F.lit("k"), F.col("node_id").cast("string")), F.lit("")).alias(keys[1]),
                         F.concat(F.lit(TURN), escape(role), F.lit(TEXT)).alias("head"), escape(text).alias("body"),
                         (role == loss_role).alias("loss"))
    turns = (paths.join(parts, keys).groupBy("tree", "path", "branch")
             .agg(F.min("tree_id").alias("tree_id"), F.count("*").alias("n_nodes"),
                  F.array_sort(F.collect_list(F.struct((-F.col("back")).alias("at"), "head", "body", "loss"))).alias("turns")))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    # a turn's place: the lengths of the turns before it, carried along in one pass
    spans = F.aggregate(
        "turns", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).cast("long").alias("at"),
            F.when(t["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(t["head"])).cast("long").alias("start"),
                                                                      F.length(t["body"]).cast("long").alias("length")))))
            .otherwise(acc["spans"]).alias("spans")))["spans"]
    return turns.select("tree_id", "branch", "n_nodes", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Roles, texts and loss text parsed out of ``formatted`` alone: adds
    turns (array of role, text) and loss_texts (unescaped, in order)."""
    turns = F.transform(F.slice(F.split("formatted", _MARK_SPLIT, -1), 2, 2_000_000_000), lambda t: F.struct(
        unescape(F.substring_index(t, TEXT, 1)).alias("role"),
        unescape(F.substring(t, F.length(F.substring_index(t, TEXT, 1)) + len(TEXT) + 1,
                             F.length(t) - F.length(F.substring_index(t, TEXT, 1)) - len(TEXT) - len(END))).alias("text")))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.select("*", turns.alias("turns"), loss.alias("loss_texts"))


def chain_nodes(rows: DataFrame) -> DataFrame:
    """Nodes of ``conversations`` rows (conv_id, turn, role, text): each turn
    replies to the one before; null turns come first, repeated turns stand
    by role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return (rows.select("conv_id", "turn", "role", "text").withColumn("n", F.row_number().over(order))
            .select(F.col("conv_id").alias("tree_id"), F.col("n").alias("node_id"),
                    F.when(F.col("n") > 1, F.col("n") - 1).alias("parent_id"), F.lit(0.0).alias("score"), "role", "text"))
