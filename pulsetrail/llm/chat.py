"""Conversations from reply trees, formatted with a template and a loss mask.

Messages form trees by their parents. Self-joins double the reach of every message's link towards the
root until all arrive, so a path of any length takes as many joins as its length has binary digits. That
gives each message its depth and the score of its path; the paths that end in a leaf are ranked by
score, and the same links in turn list the messages of every chosen path.

A turn is written as ``### role: text</turn>`` and a line end. A backslash, the marks ``###`` (and more
of them) and ``</turn>`` inside a text, and a colon in a role, get backslashes, which can be undone. A
formatted conversation comes in segments of whole turns, one unless it is very long, with the spans of
code points that count for the loss: the texts of assistant turns, as escaped.

A NULL text or role is empty. A NULL conversation is one of its own. A message whose parent is not there
is a root; messages that are their own ancestors raise an error. An empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsetrail.llm.common import partitions, pieces
from pulsetrail.llm.ranks import ranked
from pulsetrail.workspace import stage

TRAINED = "assistant"
END = "</turn>\n"
SEGMENT_CHARS = 1 << 20

_TEXT = re.compile(r"\\|#{3,}|</turn>")
_ROLE = re.compile(r"\\|#{3,}|</turn>|:")
_TURN = re.compile(r"### ((?:[^\\:]++|\\.)*+): ((?:[^\\<]++|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


def escape(text: str, control: re.Pattern = _TEXT) -> str:
    return control.sub(lambda m: "".join("\\" + c for c in m[0]) if m[0][0] == "#" else "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turns_as_tree(df: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations as trees of one branch: tree, conv_id, node, parent, score, role, text.

    Turns with the same number follow each other by role and text.
    """
    key = F.coalesce(F.col(conversation).cast("string"), F.lit("none"))
    rows = df.select(
        key.alias("tree"),
        F.col(conversation).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    placed = ranked(rows, ["tree"], ["turn", "role", "text"], "chat-turns").withColumnRenamed("place", "node")
    parent = F.when(F.col("node") > 0, F.col("node") - 1)
    return placed.select("tree", "conv_id", "node", parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def reply_paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """Messages of the chosen root-to-leaf paths: tree, leaf, depth, node.

    ``nodes`` has tree, node (unique in its tree), parent and score. With a number of ``branches`` only
    as many paths of a tree are chosen, those of the highest sum of scores; of equals the smaller leaf.
    """
    links = nodes.select("tree", "node", "parent", "score")
    known = links.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    links = links.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "score"
    )
    start = stage(links.withColumn("depth", F.when(F.col("up").isNull(), 0).otherwise(1).cast("bigint")), "chat-links")
    rows = start.count()
    # Only messages that have not arrived at their root are joined again.
    arrived, under_way, steps = start.filter("up IS NULL"), start.filter("up IS NOT NULL"), []
    while not under_way.isEmpty():
        if 1 << len(steps) > rows:
            raise ValueError("messages are their own ancestors")
        steps.append(under_way)
        above = arrived.unionByName(under_way).select(
            "tree",
            F.col("node").alias("up"),
            F.col("up").alias("next"),
            F.col("score").alias("more"),
            F.col("depth").alias("further"),
        )
        further = under_way.join(above, ["tree", "up"]).select(
            "tree",
            "node",
            F.col("next").alias("up"),
            (F.col("score") + F.col("more")).alias("score"),
            (F.col("depth") + F.col("further")).alias("depth"),
        )
        further = stage(further, "chat-links")
        arrived = arrived.unionByName(further.filter("up IS NULL"))
        under_way = further.filter("up IS NOT NULL")
    inner = start.filter("up IS NOT NULL").select("tree", F.col("up").alias("node")).distinct()
    leaves = arrived.join(inner, ["tree", "node"], "left_anti")
    if branches is not None:
        best = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
        leaves = leaves.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= branches)
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", "depth")
    # Each message of a path also brings the one 2^k links above it; from the longest links down, every
    # distance comes up once.
    for k, step in reversed(list(enumerate(steps))):
        higher = paths.join(step.select("tree", "node", "up"), ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        paths = stage(paths.select("tree", "leaf", "node", "depth").unionByName(higher), "chat-paths")
    return paths


def format_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Each path as one formatted conversation: tree, conv_id, leaf, segment, formatted, loss (spans).

    Tasks go through sorted turns and hold one segment at a time.
    """
    spark = nodes.sparkSession
    turns = paths.join(nodes.select("tree", "node", "conv_id", "role", "text"), ["tree", "node"])
    order = ["tree", "leaf", "depth"]
    in_order = turns.repartition(partitions(spark), "tree", "leaf").sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, segment = [], None
        for batch in pieces(batches, "text", 1 << 20):
            columns = [batch.column(c).to_pylist() for c in ("tree", "leaf", "conv_id", "role", "text")]
            for tree, leaf, conv, role, text in zip(*columns):
                new = segment is None or segment.of[:2] != (tree, leaf)
                if new or segment.chars > SEGMENT_CHARS:
                    made += [segment.row()] if segment else []
                    segment = Segment(tree, leaf, conv, 0 if new else segment.of[3] + 1)
                segment.add(role, text)
            if len(made) >= 256:
                yield _segments(made)
                made = []
        if segment:
            yield _segments([*made, segment.row()])

    return in_order.mapInArrow(write, _SEGMENT)


def read_formatted(conversations: DataFrame) -> DataFrame:
    """What the formatted text and its loss mask say: conv_id, leaf, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars."""
    spark = conversations.sparkSession
    order = ["tree", "leaf", "segment"]
    in_order = conversations.repartition(partitions(spark), "tree", "leaf").sortWithinPartitions(*order)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, one, rows = None, None, []
        for batch in batches:
            for tree, conv, leaf, formatted, loss in zip(*[batch.column(c).to_pylist() for c in ("tree", "conv_id", "leaf", "formatted", "loss")]):
                if (tree, leaf) != key:
                    if one:
                        rows.append(one.row())
                    key, one = (tree, leaf), Digest(conv, leaf)
                one.add(formatted, [(x["start"], x["end"]) for x in loss])
            if rows:
                yield _digests(rows)
                rows = []
        if one:
            yield _digests([one.row()])

    return in_order.mapInArrow(read, _DIGEST)


class Segment:
    """Whole turns of one conversation, formatted."""

    def __init__(self, tree: str, leaf: int, conv: int | None, number: int):
        self.of, self.parts, self.loss, self.chars = (tree, leaf, conv, number), [], [], 0

    def add(self, role: str, text: str) -> None:
        head, body = f"### {escape(role, _ROLE)}: ", escape(text)
        start = self.chars + len(head)
        if role == TRAINED:
            self.loss.append({"start": start, "end": start + len(body)})
        self.parts += [head, body, END]
        self.chars = start + len(body) + len(END)

    def row(self) -> tuple:
        return (*self.of, "".join(self.parts), self.loss)


class Digest:
    """Sums over the segments of one formatted conversation."""

    def __init__(self, conv: int | None, leaf: int):
        self.of, self.turns, self.loss_chars, self.chars = (conv, leaf), 0, 0, 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, loss: list[tuple[int, int]]) -> None:
        at = 0
        while at < len(formatted):
            turn = _TURN.match(formatted, at)
            if not turn:
                raise ValueError("this is no formatted conversation")
            self.turns += 1
            self.said.update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
            at = turn.end()
        for start, end in loss:
            text = unescape(formatted[start:end])
            self.loss_chars += len(text)
            self.loss.update(text.encode())
        self.chars += len(formatted)

    def row(self) -> tuple:
        return (*self.of, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars)


_SEGMENT = "tree string, leaf bigint, conv_id bigint, segment bigint, formatted string, loss array<struct<start: bigint, end: bigint>>"
_DIGEST = "conv_id bigint, leaf bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def _segments(rows: list[tuple]) -> pa.RecordBatch:
    tree, leaf, conv, number, text, loss = zip(*rows)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    arrays = [pa.array(tree), pa.array(leaf, pa.int64()), pa.array(conv, pa.int64()), pa.array(number, pa.int64()), pa.array(text), pa.array(loss, span)]
    return pa.RecordBatch.from_arrays(arrays, ["tree", "leaf", "conv_id", "segment", "formatted", "loss"])


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split()[0] for c in _DIGEST.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
