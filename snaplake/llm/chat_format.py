"""Chat formatting of reply trees (DataFrame functions only).

Nodes (tree, node, parent, role, text, score) form trees.  Self-joins on doubling jump pointers
find each node's depth and the score of its path from the root in about log2(depth) rounds;
leaves are ranked by the score of their branch, and the jump pointers are walked back from the
chosen leaves only, so a path is enumerated in as many rounds.  Each chosen path becomes one
conversation: a string, and the spans of it (code points) that the loss is taken on.

The template: ``<s>`` role ``\\n`` text ``</s>`` for each turn, a user's text as
``[INST] text [/INST]``.  In texts and roles a backslash stands before every backslash and
inside every control string, so no text can pass for a mark and ``unescape`` gives it back.

Defined cases: a null parent, or one that is no node of the tree, makes a root; null roles and
texts are empty; a null score counts 0; equal branch scores are ranked by the leaf's node;
rows that repeat a node id of their tree are refused, as are cycles (no root reaches them); an
empty table gives an empty result.  One conversation becomes one string, so the rows of a
single path meet in one task by the nature of the result; everything before that is spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaplake.llm.common import cut, release

# Fixed values of the template.
START, END = "<s>", "</s>"
USER_OPEN, USER_CLOSE = "[INST] ", " [/INST]"
USER, ASSISTANT = "user", "assistant"
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def escape_role(role: Column) -> Column:
    """As ``escape``; a line feed ends the role, so inside it becomes ``\\n``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    lines = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return unescape(lines)


def branches(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree, node, parent, score) -> tree, branch (rank from 1), depth (from 1), node."""
    n = cut(nodes.select("tree", "node", "parent",
                         F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")),
            "chat-nodes")
    rows, keys = n.count(), n.select("tree", "node").distinct().count()
    if rows != keys:
        raise ValueError("a node id occurs twice in a tree")
    known = n.select(F.col("tree").alias("k_tree"), F.col("node").alias("k_node"))
    up = n.join(known, n["tree"].eqNullSafe(known["k_tree"])
                & (n["parent"] == known["k_node"]), "left")
    up = cut(up.select("tree", "node", F.col("k_node").alias("jump"), F.col("score").alias("sum"),
                       F.lit(1).cast("long").alias("depth")), "chat-up")
    # Round k: ``jump`` is the node 2**k steps up (null: the root is nearer), ``sum`` and
    # ``depth`` cover the nodes from here to just below it.
    levels = [up]
    while levels[-1].filter(F.col("jump").isNotNull()).limit(1).count():
        if 2 ** (len(levels) - 1) > max(rows, 1):
            raise ValueError("nodes in a cycle reach no root")
        a = levels[-1]
        b = a.select(F.col("tree").alias("b_tree"), F.col("node").alias("b_node"),
                     F.col("jump").alias("b_jump"), F.col("sum").alias("b_sum"),
                     F.col("depth").alias("b_depth"))
        # Only nodes that still have somewhere to go are joined; the others are done.
        go = a.filter(F.col("jump").isNotNull())
        moved = go.join(b, go["tree"].eqNullSafe(b["b_tree"]) & (go["jump"] == b["b_node"])) \
            .select("tree", "node", F.col("b_jump").alias("jump"),
                    (F.col("sum") + F.col("b_sum")).alias("sum"),
                    (F.col("depth") + F.col("b_depth")).alias("depth"))
        levels.append(cut(moved.unionByName(a.filter(F.col("jump").isNull())), "chat-jump"))
    done = levels[-1]
    inner = n.filter(F.col("parent").isNotNull()) \
        .select(F.col("tree").alias("i_tree"), F.col("parent").alias("i_node")).distinct()
    leaves = done.join(inner, done["tree"].eqNullSafe(inner["i_tree"])
                       & (done["node"] == inner["i_node"]), "left_anti")
    # The best branches of each tree: ranked inside salted parts first, so that a tree with
    # very many leaves is not one group.
    part = F.pmod(F.xxhash64("node"), F.lit(64))
    order = [(F.col("sum") / F.col("depth")).desc(), F.col("node")]
    for by in (["tree", part], ["tree"]):
        leaves = leaves.withColumn("branch", F.row_number().over(
            Window.partitionBy(*by).orderBy(*order))).filter(F.col("branch") <= top)
    found = leaves.select("tree", "branch", "node", "depth")
    for level in reversed(levels[:-1]):
        step = level.filter(F.col("jump").isNotNull()).select(
            F.col("tree").alias("s_tree"), F.col("node").alias("s_node"), "jump",
            F.col("depth").alias("steps"))
        more = found.join(step, found["tree"].eqNullSafe(step["s_tree"])
                          & (found["node"] == step["s_node"])) \
            .select("tree", "branch", F.col("jump").alias("node"),
                    (F.col("depth") - F.col("steps")).alias("depth"))
        found = cut(found.unionByName(more), "chat-path")
    for level in levels[:-1]:
        release(level)
    return found


def conversations(nodes: DataFrame, top: int = 1) -> DataFrame:
    """tree, branch, formatted (string), loss (array of (start, length), code points from 0)."""
    path = branches(nodes, top)
    turn = nodes.select(F.col("tree").alias("t_tree"), F.col("node").alias("t_node"),
                        F.coalesce("role", F.lit("")).alias("role"),
                        escape(F.coalesce("text", F.lit(""))).alias("body"))
    p = path.join(turn, path["tree"].eqNullSafe(turn["t_tree"])
                  & (path["node"] == turn["t_node"]))
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    user = F.col("role") == USER
    p = p.select("tree", "branch", "depth", head.alias("head"), "body",
                 F.when(user, USER_OPEN).otherwise("").alias("opens"),
                 F.when(user, USER_CLOSE).otherwise("").alias("closes"),
                 (F.col("role") == ASSISTANT).alias("learn"))
    p = p.withColumn("turn", F.concat("head", "opens", "body", "closes", F.lit(END)))
    order = Window.partitionBy("tree", "branch").orderBy("depth")
    begin = F.coalesce(F.sum(F.length("turn")).over(
        order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = begin + F.length(F.concat("head", "opens"))
    p = p.select("tree", "branch", "depth", "turn", F.when(F.col("learn"), F.struct(
        start.cast("long").alias("start"), F.length("body").cast("long").alias("length")))
        .alias("span"))
    g = p.groupBy("tree", "branch").agg(
        F.sort_array(F.collect_list(F.struct("depth", "turn", "span"))).alias("turns"))
    return g.select("tree", "branch", F.array_join("turns.turn", "").alias("formatted"),
                    F.filter("turns.span", lambda s: s.isNotNull()).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What a reader finds in ``conversations``' output: tree, branch, formatted, turns (array
    of (role, text)), learned (the text under the loss mask)."""
    pieces = F.split(F.col("formatted"), END, -1)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        line = F.instr(piece, "\n")
        role = unescape_role(F.substr(piece, F.lit(len(START) + 1), line - len(START) - 1))
        body = F.substr(piece, line + 1)
        inner = F.substr(body, F.lit(len(USER_OPEN) + 1),
                         F.length(body) - len(USER_OPEN) - len(USER_CLOSE))
        return F.struct(role.alias("role"), unescape(
            F.when(role == USER, inner).otherwise(body)).alias("text"))

    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substr(
        F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
    return formatted.select("tree", "branch", "formatted",
                            F.transform(pieces, turn).alias("turns"), learned.alias("learned"))


def linear_nodes(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as nodes: each row answers the one before it by
    (turn, role, text), null roles and texts being empty, so a conversation is a tree with one
    branch."""
    empty = F.lit("")
    order = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), F.coalesce("role", empty), F.coalesce("text", empty))
    r = rows.select("conv_id", "turn", "role", "text")
    r = r.withColumn("node", F.row_number().over(order).cast("long"))
    return r.select(F.col("conv_id").alias("tree"), "node",
                    F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                    "role", "text", F.lit(0.0).alias("score"))
