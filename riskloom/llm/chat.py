"""Reply trees: choose the best root-to-leaf path of each tree and format it as one conversation.

Paths are enumerated by self-joins that double their reach: after round k every node knows its
ancestor 2^k steps up and the sum of scores on the way. The rounds needed are the logarithm of the
deepest path, so a long conversation costs a few joins, not one per turn.
"""

from __future__ import annotations

import re
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.store import materialise

#: A turn is OPEN role CLOSE text END.
OPEN, CLOSE, END = "[INST]", "[/INST]", "</s>"
#: Texts that control a chat format; inside turns each has a backslash behind its first character.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ESCAPE = "|".join(re.escape(c[0]) + r"(?=(?:\\)*" + re.escape(c[1:]) + ")" for c in CONTROLS)
_UNESCAPE = "|".join(re.escape(c[0]) + r"\\(?=(?:\\)*" + re.escape(c[1:]) + ")" for c in CONTROLS)


def escape(text: str) -> str:
    """Add one backslash behind the first character of every control text, also of one that has backslashes there already."""
    return re.sub(_ESCAPE, lambda m: m.group() + "\\", text)


def unescape(text: str) -> str:
    """Undo ``escape``: take one backslash from behind the first character of every control text that has some."""
    return re.sub(_UNESCAPE, lambda m: m.group()[0], text)


def escape_column(text: Column) -> Column:
    return F.regexp_replace(text, f"({_ESCAPE})", r"$1\\")


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Doubling tables of rows (node, parent, score), and (node, depth, total, root) sums of scores from the root down.

    A missing parent is null. Every round is one self-join of the nodes that have an ancestor that far up; it ends when there is none. Nodes on a cycle, which has no root, would never end: a reach beyond the number of nodes is an error.
    """
    step = materialise(nodes.select("node", F.col("parent").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("depth")), "chat_step")
    size, tables, done = step.count(), [], step.where("up is null")
    while not (step := step.where("up is not null")).isEmpty():
        if 2 ** len(tables) > size:
            raise ValueError("the replies form a cycle")
        tables.append(step.select("node", "up"))
        far = done.unionByName(step).select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("total").alias("total2"), F.col("depth").alias("depth2"))
        joined = step.join(far, "up").select("node", F.col("up2").alias("up"), (F.col("total") + F.col("total2")).alias("total"), (F.col("depth") + F.col("depth2")).alias("depth"))
        step = materialise(joined, "chat_step")
        done = done.unionByName(step.where("up is null"))
    return tables, done.select("node", "depth", "total")


def best_paths(nodes: DataFrame, paths: int = 1) -> DataFrame:
    """Rows (tree, rank, depth, node) of the ``paths`` best root-to-leaf paths of each tree, from rows (tree, node, parent, score).

    Node ids are unique over all trees. A path scores the mean of its nodes' scores (null counts 0); ties go to the longer
    path, then to the smaller leaf. A parent that is not there makes its child a root.
    """
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    clean = nodes.join(known, "parent", "left").select(
        "tree", "node", F.when(F.col("there"), F.col("parent")).alias("parent"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")
    )
    clean = materialise(clean, "chat_nodes")
    tables, reach = climb(clean)
    leaves = clean.join(clean.select(F.col("parent").alias("node")).where("node is not null").distinct(), "node", "left_anti").join(reach, "node")
    order = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), F.desc("depth"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= paths).select("tree", "rank", "node")
    found = materialise(chosen, "chat_paths")
    for table in reversed(tables):
        found = materialise(found.unionByName(found.join(table, "node").select("tree", "rank", F.col("up").alias("node"))).distinct(), "chat_paths")
    return found.join(reach.select("node", "depth"), "node").select("tree", "rank", "depth", "node")


def turns_as_tree(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Linear conversations as trees: rows (tree, node, parent, score, role, text, conv), each turn a reply to the one before it.

    Turns are in the order of the turn number, nulls first; equal numbers by role, then text. Repeated rows are turns of their own.
    A null conversation id is one conversation.
    """
    stored = materialise(
        turns.select(
            F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("node")
        ), "chat_turns",
    )
    order = Window.partitionBy("conv").orderBy("turn", "role", "text", "node")
    first = F.min("node").over(Window.partitionBy("conv"))
    return stored.select(first.alias("tree"), "node", F.lag("node").over(order).alias("parent"), F.lit(0.0).alias("score"), "conv", "role", "text")


def format_paths(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """One row (tree, rank, formatted) per chosen path.

    A turn is written ``[INST]role[/INST]text</s>`` with control texts inside role and text escaped. Null roles and texts are empty.
    """
    part = lambda c: escape_column(F.coalesce(F.col(c), F.lit("")))
    said = nodes.select("node", F.concat(F.lit(OPEN), part("role"), F.lit(CLOSE), part("text"), F.lit(END)).alias("turn"))
    lines = paths.join(said, "node").groupBy("tree", "rank").agg(F.array_sort(F.collect_list(F.struct("depth", "node", "turn"))).alias("turns"))
    return lines.select("tree", "rank", F.array_join(F.transform("turns", lambda t: t.turn), "").alias("formatted"))


def read_back(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn of a formatted conversation; the offsets are of the text as it is written there."""
    out, at = [], 0
    while at < len(formatted):
        middle = formatted.index(CLOSE, at)
        end = formatted.index(END, middle + len(CLOSE))
        start = middle + len(CLOSE)
        out.append((unescape(formatted[at + len(OPEN) : middle]), unescape(formatted[start:end]), start, end))
        at = end + len(END)
    return out


def loss_spans(formatted: str, role: str = "assistant") -> list[tuple[int, int]]:
    """Where the texts of one role stand: what a loss mask covers."""
    return [(a, b) for who, _, a, b in read_back(formatted) if who == role]


def format_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id, ``formatted`` and ``loss``, the spans (start, end) of assistant texts in it.

    Each conversation is a reply tree with one path. Null texts and roles are empty, ties and repeated rows stay, an
    empty table has no conversations, and other columns are ignored whatever their names.
    """
    nodes = materialise(turns_as_tree(turns, conv, turn, role, text), "chat_tree")
    lines = format_paths(best_paths(nodes.select("tree", "node", "parent", "score")), nodes)
    ids = nodes.where("tree = node").select("tree", "conv")
    spans = F.pandas_udf(lambda f: pd.Series([[{"start": a, "end": b} for a, b in loss_spans(x)] for x in f], dtype=object), "array<struct<start:int,end:int>>")
    return lines.join(ids, "tree").select(F.col("conv").alias(conv), "formatted").withColumn("loss", spans("formatted"))


def _digest(formatted: pd.Series, loss: pd.Series) -> pd.DataFrame:
    rows = []
    for text, spans in zip(formatted, loss):
        turns = read_back(text)
        said = "".join(f"{who}\n{what}\n" for who, what, _, _ in turns)
        learned = "".join(unescape(text[s["start"] : s["end"]]) for s in spans)
        rows.append((len(turns), sha256(said.encode()).hexdigest(), len(learned), sha256(learned.encode()).hexdigest(), len(text)))
    return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])


def digests(formatted: Column, loss: Column) -> Column:
    """A struct of what can be read back from a formatted conversation: counts and hashes of its turns and of the text under the loss mask."""
    kind = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return F.pandas_udf(_digest, kind)(formatted, loss)
