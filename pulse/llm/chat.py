"""Chat formatting from reply trees, in Spark SQL.

Messages name the message they reply to. Iterative self-joins by pointer
doubling give every message its distance to the root and the score of its path
in log2(depth) joins over narrow rows (ids and numbers, no texts). The
branches, one for each leaf, are ranked by score; the jump tables then mark all
messages of the chosen branches, again in log2(depth) joins, and each branch is
written as one conversation.

Template: ``<|im_start|>role<|im_sep|>text<|im_end|>`` for each turn. Texts and
roles are escaped, so a control string in a message can't end its turn: a
backslash goes before every backslash and inside every control string. Taking
the backslash from each escaped character restores the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulse.llm.common import stash

# --- fixed values: control strings of common chat templates, and this one's marks ---
CONTROL = r"(<)(?=\||/?s>|</?SYS>>)|(\|)(?=>)|(\[)(?=/?INST\])"     # <| |> <s> </s> <<SYS>> <</SYS>> [INST] [/INST]
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# ------------------------------------------------------------------------------------

ROUNDS = 6      # doubling rounds (paths of 32 messages) before the trees' messages are counted, to notice cycles


def escape(text: Column) -> Column:
    """Reversible: ``\\`` before every backslash, and after the first character of each control string."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$1$2$3\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear_tree(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """A table of turns as reply trees in which each turn answers the one before.

    Turns are numbered by (turn, role, text), nulls first; equal rows are turns
    of their own. A conversation is written as one row in the end, so it is
    numbered as one group here.
    """
    order = Window.partitionBy(conv).orderBy(F.col(turn).asc_nulls_first(), F.col(role).asc_nulls_first(), F.col(text).asc_nulls_first())
    at = F.row_number().over(order).cast("long")
    return (turns.select(F.col(conv).alias("tree"), F.col(role).alias("role"), F.col(text).alias("text"), at.alias("node"))
            .withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(1.0)))


def one_per_node(messages: DataFrame) -> DataFrame:
    """``messages`` with one row for each (tree, node): the least by score, parent, role and text (those it has), nulls first."""
    order = [F.col(c).asc_nulls_first() for c in ("score", "parent", "role", "text") if c in messages.columns]
    at = F.row_number().over(Window.partitionBy("tree", "node").orderBy(*order))
    return messages.withColumn("_at", at).where(F.col("_at") == 1).drop("_at")


def branches(messages: DataFrame, best: int = 1, unique: bool = False) -> DataFrame:
    """(tree, leaf, rank, node, depth) of the ``best`` highest-scored branches of each tree.

    ``messages``: tree, node, parent, score. A branch's score is the sum over its
    messages (null: 0); ties go to the smaller leaf. A message whose parent is
    missing is a root; of several rows of one (tree, node) the least counts
    (:func:`one_per_node`; ``unique`` says that there are none). Parents that
    form a cycle raise ``ValueError``.
    """
    messages = messages if unique else one_per_node(messages)
    m = stash(messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    jump = m.select("tree", "node", F.col("parent").alias("to"))
    known = m.select(F.col("tree").alias("_t"), F.col("node").alias("_n"))
    jump = stash(jump.join(known, jump["tree"].eqNullSafe(known["_t"]) & (jump["to"] == known["_n"]), "left")
                 .select("tree", "node", F.col("_n").alias("to")))
    reach = m.join(jump.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "to"),
                   m["tree"].eqNullSafe(F.col("_t")) & (m["node"] == F.col("_n"))) \
        .select("tree", "node", "to", F.col("score").alias("sum"), F.lit(1).cast("long").alias("hops"))
    reach, tables = stash(reach), []
    while True:
        climbing = reach.where(F.col("to").isNotNull())     # messages at their root are done and join no more
        tables.append(climbing.select("tree", "node", "to"))
        if not tables[-1].take(1):
            break
        if len(tables) == ROUNDS:       # a path of so many messages is rare: is there a tree that large?
            largest = m.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if len(tables) >= ROUNDS and 1 << (len(tables) - 1) >= largest:
            raise ValueError("the messages' parents form a cycle")
        up = reach.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("to").alias("_to"),
                          F.col("sum").alias("_sum"), F.col("hops").alias("_hops"))
        step = climbing.join(up, climbing["tree"].eqNullSafe(up["_t"]) & (climbing["to"] == up["_n"]))
        step = step.select("tree", "node", F.col("_to").alias("to"), (F.col("sum") + F.col("_sum")).alias("sum"), (F.col("hops") + F.col("_hops")).alias("hops"))
        reach = stash(reach.where(F.col("to").isNull()).union(step))
    parents = jump.where(F.col("to").isNotNull()).select(F.col("tree").alias("_t"), F.col("to").alias("_n")).distinct()
    leaves = reach.join(parents, reach["tree"].eqNullSafe(parents["_t"]) & (reach["node"] == parents["_n"]), "left_anti")
    ranked = leaves.withColumn("rank", F.row_number().over(Window.partitionBy("tree").orderBy(F.col("sum").desc(), "node")))
    path = ranked.where(F.col("rank") <= best).select("tree", F.col("node").alias("leaf"), "rank", "node")
    for t in reversed(tables[:-1]):     # the longest jumps first: every distance is a sum of powers of two
        t = t.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "to")
        above = path.join(t, path["tree"].eqNullSafe(t["_t"]) & (path["node"] == t["_n"])).select("tree", "leaf", "rank", F.col("to").alias("node"))
        path = stash(path.union(above))
    depth = reach.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), F.col("hops").alias("depth"))
    return path.join(depth, path["tree"].eqNullSafe(depth["_t"]) & (path["node"] == depth["_n"])).select("tree", "leaf", "rank", "node", "depth")


def format_chats(messages: DataFrame, best: int = 1, loss_role: str = "assistant", unique: bool = False) -> DataFrame:
    """(tree, leaf, formatted, loss_spans): one conversation for each chosen branch.

    ``messages``: tree, node, parent, role, text, score. ``loss_spans`` are the
    (start, end) code points, from 0, of the texts of ``loss_role`` in
    ``formatted``. Null roles and texts are empty; equal texts, long texts and
    control strings pass through unchanged; repeated (tree, node) and cycles as
    in :func:`branches`; no messages give no rows. A conversation is one string,
    so its turns meet in one task.
    """
    messages = messages if unique else one_per_node(messages)
    m = stash(messages.select("tree", "node", "parent", "score", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    path = branches(m, best, unique=True)
    p = path.select(F.col("tree").alias("_t"), F.col("node").alias("_n"), "leaf", "depth")
    turns = m.join(p, m["tree"].eqNullSafe(p["_t"]) & (m["node"] == p["_n"]))
    role, text = escape(F.col("role")), escape(F.col("text"))
    turns = turns.select("tree", "leaf", "depth", (F.col("role") == loss_role).alias("loss"), role.alias("r"), text.alias("x"))
    lead = len(START) + len(SEP) + F.length("r")
    piece = F.concat(F.lit(START), "r", F.lit(SEP), "x", F.lit(END))
    order = Window.partitionBy("tree", "leaf").orderBy("depth")
    earlier = F.coalesce(F.sum(lead + F.length("x") + len(END)).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    turns = turns.withColumn("at", earlier)
    span = F.struct((F.col("at") + lead).alias("start"), (F.col("at") + lead + F.length("x")).alias("end"))
    turns = turns.select("tree", "leaf", F.struct("depth", piece.alias("piece"), F.when(F.col("loss"), span).alias("span")).alias("turn"))
    chats = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return chats.select("tree", "leaf", F.array_join(F.col("turns.piece"), "").alias("formatted"),
                        F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation, unescaped."""
    pieces = F.filter(F.split(formatted, r"<\|im_end\|>", -1), lambda x: x != "")
    return F.transform(pieces, lambda x: F.struct(
        unescape(F.regexp_extract(x, r"(?s)\A<\|im_start\|>(.*?)<\|im_sep\|>", 1)).alias("role"),
        unescape(F.regexp_extract(x, r"(?s)\A<\|im_start\|>.*?<\|im_sep\|>(.*)\z", 1)).alias("text")))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, spans joined in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
