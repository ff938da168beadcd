"""Chat formatting: root-to-leaf paths of reply trees, ranked by score, each as one conversation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomstep.llm.common import cut_out, discard, materialize, running

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
#: Strings that control a chat model in the usual templates: fixed values, escaped wherever a text or role has them.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>")
_QUOTED = lambda s: "".join("\\" + c if c in "|[]<>/" else c for c in s)
#: The first character of a control string, the backslashes that stand behind it, and the rest.
_PLAIN = r"([<\[])(\\*)(" + "|".join(_QUOTED(s[1:]) for s in CONTROL) + ")"
_ESCAPED = r"([<\[])\\(\\*)(" + "|".join(_QUOTED(s[1:]) for s in CONTROL) + ")"


def escape(text: Column) -> Column:
    """One more backslash behind the first character of each control string; unescape() takes it away again."""
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def paths(messages: DataFrame, *, best: int | None = None) -> DataFrame:
    """(tree, leaf, node, depth, score): the nodes of each chosen root-to-leaf path, depth 0 at the root.

    messages: tree, node, parent, score. A node whose parent is null or missing is a root. Jumps of doubled length are
    joined to themselves and carry the sum of what they pass, so a tree of depth d takes log2(d) rounds over its nodes,
    and every leaf then has its path's score (null scores: 0). With best, a tree keeps that many leaves of the highest
    score, of equal ones the smallest; only the paths of leaves that are kept are enumerated, again by the jumps. Nodes
    on or below a cycle have no root and are left out, and so are rows of a null tree or node. Repeated (tree, node)
    rows must have been made unique. No rows give none.
    """
    nodes = messages.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score"))
    here = nodes.select("tree", F.col("node").alias("parent"), F.lit(1).alias("there"))
    nodes = nodes.join(here, ["tree", "parent"], "left").select("tree", "node", F.when(F.col("there") == 1, F.col("parent")).alias("to"), F.col("score").alias("sum"), F.lit(1).cast("long").alias("n"))
    up = materialize(nodes, "jumps")
    inner = up.select("tree", F.col("to").alias("node")).where("node is not null").distinct()
    leaves = materialize(up.join(inner, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf")), "leaves")
    largest = up.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    jumps = [up]
    while 2 ** (len(jumps) - 1) < largest and not up.where("to is not null").isEmpty():
        on = up.select("tree", F.col("node").alias("to"), F.col("to").alias("next"), F.col("sum").alias("more"), F.col("n").alias("passed"))
        open_, done = up.where("to is not null"), up.where("to is null")
        further = open_.join(on, ["tree", "to"]).select("tree", "node", F.col("next").alias("to"), (F.col("sum") + F.col("more")).alias("sum"), (F.col("n") + F.col("passed")).alias("n"))
        up = materialize(further.unionByName(done), "jumps")
        jumps.append(up)
    rooted = up.where("to is null").select("tree", F.col("node").alias("leaf"), F.col("sum").alias("score"), (F.col("n") - 1).alias("top"))
    branch = leaves.join(rooted, ["tree", "leaf"])
    if best is not None:
        rank = F.row_number().over(W.partitionBy("tree").orderBy(F.desc("score"), "leaf"))
        branch = branch.withColumn("rank", rank).where(F.col("rank") <= best).drop("rank")
    found = materialize(branch.select("tree", "leaf", "score", "top", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up")), "paths")
    for k, jump in enumerate(jumps):
        on = jump.where("to is not null").select("tree", "node", "to")
        more = found.where(F.col("up") + 2**k <= F.col("top")).join(on, ["tree", "node"]).select("tree", "leaf", "score", "top", F.col("to").alias("node"), (F.col("up") + 2**k).alias("up"))
        grown = materialize(found.union(more), "paths")
        discard(found, jump)
        found = grown
    discard(leaves)
    return found.select("tree", "leaf", "node", (F.col("top") - F.col("up")).alias("depth"), "score")


def format_chats(messages: DataFrame, *, best: int | None = None, learn: str = "assistant") -> DataFrame:
    """(tree, leaf, score, n_turns, formatted, loss): one row for each chosen path.

    messages: tree, node, parent, score, role, text; other columns are not read. Null roles and texts are
    empty. formatted: for each turn BEGIN, role, newline, text, END, with control strings escaped and
    a newline in a role as ~1 and ~ as ~0. loss: array of struct(start, length) in code points of formatted, the texts of turns
    of role learn. Rows with equal (tree, node) count once, the one with the smallest role and text. A null tree
    is a tree like any other; rows of a null node are left out. An empty table gives no rows.
    """
    rows = messages.groupBy("tree", "node").agg(F.min(F.struct("role", "text", "parent", "score")).alias("m"))
    rows = rows.select(F.struct("tree").alias("tree"), "node", "m.*")  # a struct that holds null is not null, so joins keep it
    rows = materialize(rows, "messages")
    chosen = paths(rows, best=best)
    role = escape(F.replace(F.replace(F.coalesce("role", F.lit("")), F.lit("~"), F.lit("~0")), F.lit("\n"), F.lit("~1")))
    text = escape(F.coalesce("text", F.lit("")))
    turn = chosen.join(rows.select("tree", "node", role.alias("role"), text.alias("text"), (F.col("role") == learn).alias("own")), ["tree", "node"])
    turns = F.sort_array(F.collect_list(F.struct("depth", F.concat(F.lit(BEGIN), "role", F.lit("\n")).alias("head"), "text", F.coalesce("own", F.lit(False)).alias("own"))))
    whole = turn.groupBy("tree", "leaf").agg(F.max("score").alias("score"), turns.alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(END))), "")
    size = lambda t: F.length(t["head"]) + F.length(t["text"]) + len(END)
    ends = running(F.transform("turns", size), lambda a, b: a + b)
    placed = F.zip_with("turns", ends, lambda t, end: F.struct((end - len(END) - F.length(t["text"])).alias("start"), F.length(t["text"]).alias("length"), t["own"].alias("own")))
    loss = F.transform(F.filter(placed, lambda s: s["own"]), lambda s: F.struct(s["start"].alias("start"), s["length"].alias("length")))
    return whole.select("tree.tree", "leaf", "score", F.size("turns").cast("long").alias("n_turns"), formatted.alias("formatted"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """Array of struct(role, text): what format_chats() put into one string."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: F.startswith(p, F.lit(BEGIN)))
    body = lambda p: F.substring(p, len(BEGIN) + 1, F.length(p))
    plain = lambda r: F.replace(F.replace(r, F.lit("~1"), F.lit("\n")), F.lit("~0"), F.lit("~"))
    return F.transform(
        parts,
        lambda p: F.struct(
            plain(unescape(F.substring_index(body(p), "\n", 1))).alias("role"),
            unescape(F.substring(body(p), F.instr(body(p), F.lit("\n")) + 1, F.length(p))).alias("text"),
        ),
    )


def masked(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(cut_out(formatted, loss), unescape), "")
