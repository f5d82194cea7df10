"""Reply trees as chat training texts.

Iterative self-joins double the known stretch of every node's way to its root,
branches are ranked by their summed score, and each chosen root-to-leaf path
is formatted as one conversation under a template whose control strings are
escaped, reversibly, inside texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .runtime import stored, write

#: Opening and closing control strings of a role's turn.
TURNS = {"user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER_CLOSE = "<</ROLE>>"
#: A control string inside a text, with the backslashes that escape it after its first character.
_CONTROL = re.compile(r"([<\[])(\\*)(/?s>|/?INST\]|</?SYS>>|<ROLE [^<>]*>>|</ROLE>>)")
_ESCAPED = re.compile(r"([<\[])(\\*)\\(/?s>|/?INST\]|</?SYS>>|<ROLE [^<>]*>>|</ROLE>>)")
_OPEN = re.compile(r"\[INST\] |<s>|<<SYS>>|<<ROLE ([^<>]*)>>")
_ROLE_OF = {v[0]: k for k, v in TURNS.items()}


def escape(text: str) -> str:
    """Put one more backslash into every control string."""
    return _CONTROL.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    """Undo ``escape``."""
    return _ESCAPED.sub(r"\1\2\3", text)


def _role_name(role: str) -> str:
    return re.sub(r"[%<>]", lambda m: f"%{ord(m[0]):02X}", role)


def format_turns(turns: list[tuple[str, str]], learn: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans in it, in code points, that are learnt."""
    out, spans, at = [], [], 0
    for role, text in turns:
        opening, closing = TURNS.get(role) or (f"<<ROLE {_role_name(role)}>>", OTHER_CLOSE)
        body = escape(text)
        if role == learn:
            spans.append((at + len(opening), at + len(opening) + len(body)))
        out += [opening, body, closing]
        at += len(opening) + len(body) + len(closing)
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _OPEN.match(formatted, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        role = _ROLE_OF.get(m[0])
        if role is None:
            role, closing = re.sub(r"%([0-9A-F]{2})", lambda x: chr(int(x[1], 16)), m[1]), OTHER_CLOSE
        else:
            closing = TURNS[role][1]
        end = formatted.index(closing, m.end())
        out.append((role, unescape(formatted[m.end() : end])))
        at = end + len(closing)
    return out


def paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """The ``best`` root-to-leaf paths of every tree, as rows (tree, leaf, depth, node).

    nodes: tree, node, parent (null, or a node that isn't there: a root) and
    score.  Each round joins the jump table with itself and doubles its reach,
    until no node has further to go; a path's score is the sum of its nodes'
    scores, ties go to the smallest leaf.  Nodes whose way is known take no part
    in later rounds.  Nodes on a cycle reach no root and are on no path, nor are
    null nodes; the nodes of a null tree are one tree.  Every join has (tree,
    node) as its key, so one large tree is still dealt evenly.  An empty table
    gives an empty one.
    """
    # inside a struct, nulls are equal to each other
    own = nodes.where(F.col("node").isNotNull()).select(F.struct("tree").alias("tree"), "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    there = own.select("tree", F.col("node").alias("parent"), F.lit(True).alias("found"))
    start = own.join(there.hint("merge"), ["tree", "parent"], "left").select("tree", "node", F.when(F.col("found"), F.col("parent")).alias("up"), "score", F.lit(1).cast("long").alias("n"))
    spark, tables = nodes.sparkSession, [write(start, "reply-jumps")]
    read = lambda *which: spark.read.schema(start.schema).parquet(*which)
    levels = [read(tables[0])]
    rounds = max(1, levels[0].count()).bit_length() + 1
    while len(levels) <= rounds and not levels[-1].where(F.col("up").isNotNull()).isEmpty():
        # nodes whose way is known are read from all tables in one scan
        known = levels[-1] if len(tables) == 1 else levels[-1].unionByName(read(*tables[:-1]).where(F.col("up").isNull()))
        high = known.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"), F.col("n").alias("n2"))
        joined = levels[-1].where(F.col("up").isNotNull()).join(high.hint("merge"), ["tree", "up"])
        tables.append(write(joined.select("tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score"), (F.col("n") + F.col("n2")).alias("n")), "reply-jumps"))
        levels.append(read(tables[-1]))
    whole = read(*tables).where(F.col("up").isNull())
    parents = levels[0].where(F.col("up").isNotNull()).select("tree", F.col("up").alias("node")).distinct()
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("score").desc(), "node"))
    leaves = whole.join(parents.hint("merge"), ["tree", "node"], "left_anti").withColumn("rank", rank).where(F.col("rank") <= best)
    chosen = leaves.select("tree", F.col("node").alias("leaf"), "node", F.col("n").alias("depth"))
    for k in range(len(levels) - 2, -1, -1):
        jump = levels[k].where(F.col("up").isNotNull()).select("tree", "node", "up").hint("merge")
        own, above = F.struct("node", "depth"), F.struct(F.col("up").alias("node"), (F.col("depth") - F.lit(1 << k)).alias("depth"))
        both = F.when(F.col("up").isNull(), F.array(own)).otherwise(F.array(own, above))
        chosen = chosen.join(jump, ["tree", "node"], "left").select("tree", "leaf", F.inline(both))
        if k % 3 == 1:
            chosen = stored(chosen, "reply-ways")  # keeps the plans of long ways small
    return chosen.select("tree.tree", "leaf", "depth", "node")


def format_trees(nodes: DataFrame, best: int = 1, learn: str = "assistant") -> DataFrame:
    """(tree, leaf, formatted, loss): each chosen path as one conversation.

    nodes: tree, node, parent, score, role, text; (tree, node) is unique.
    loss: the spans of ``formatted`` that are learnt.  Null texts and roles
    are empty, a null tree is a tree like others.  A conversation's turns meet in
    one row, which is its result.
    """
    found = paths(nodes, best).withColumn("tree", F.struct("tree"))
    turns = nodes.select(F.struct("tree").alias("tree"), "node", "role", "text").join(found.hint("merge"), ["tree", "node"])
    turn = F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(turn)).alias("turns")).select("tree.tree", "leaf", "turns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            made = [format_turns([(t["role"], t["text"]) for t in turns], learn) for turns in batch.column(2).to_pylist()]
            loss = [[{"start": a, "end": b} for a, b in spans] for _, spans in made]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([m[0] for m in made], pa.string()), pa.array(loss, span)], ["tree", "leaf", "formatted", "loss"])

    return rows.mapInArrow(run, "tree long, leaf long, formatted string, loss array<struct<start: bigint, end: bigint>>")


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """Rows by turn as a tree without branches: each row replies to the one before.

    Rows of one conversation with the same turn follow each other by role and
    text, so repeated rows stay; null turns come first, and rows without a
    conv_id are one conversation.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = conversations.select(F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from them alone: one row
    a conversation, a null one too."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            rows = []
            for tree, text, loss in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                turns = read_turns(text)
                learnt = "".join(unescape(text[s["start"] : s["end"]]) for s in loss)
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((tree, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), len(text)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i in (2, 4) else pa.array(c, pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], names)

    return formatted.select("tree", "formatted", "loss").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
