"""Short codes for vectors: each is cut into parts, and of each part the number of the nearest entry of a
codebook is kept. Codebooks are found by Lloyd's rounds over cover trees.

Vectors stay where they lie: every ``BLOCK`` rows of an input partition become a block with one tree for each
part. A tree's points are stored in the order of a walk through it, its nodes as stretches of that order with
the first point as centre and the distance of the farthest as radius. Running sums over the points give the
sum of any stretch by one subtraction. In a round every task walks the trees of its blocks level by level: where
the second nearest entry is farther from the centre than the nearest by more than twice the radius, all of the
stretch belongs to the nearest; only nodes for which this fails are opened, and the points of open leaves are
compared one by one. Equal points are one point with a weight. What leaves a task is one row per entry.

Components are whole numbers, ``floor(scale * x)``, and distances between them exact; ties go to the lower index.
The rows of ``entries`` smallest ids are the first codebook (equal ids: by vector, NULL ids last); with fewer rows
there are fewer entries. Rows whose vector is NULL or has NULL, NaN or infinite components are left out.
Vectors that are not as long as that of the smallest id can not be compared and get NULL as code and error;
lengths that can not be cut into equal parts, and components whose distances pass 64 bits, are errors. Repeated
rows get the same code. Of an empty table nothing comes back. Memory: a task holds a block; the codebooks, of
``entries`` times the length of a vector, go through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import keep_row
from pulsetrail.workspace import stage

# Rows that share a tree.
BLOCK = 4096
# A node of so few points is not divided; one that needs more children does not cluster at its scale.
LEAF = 16
CHILDREN = 64
NODE = np.dtype([("start", "<i4"), ("end", "<i4"), ("child", "<i4"), ("children", "<i4"), ("radius", "<f8")])


@dataclass(frozen=True)
class VectorCodes:
    """``codes`` has _row, code and error; ``codebooks`` an array (entry, component) for each part."""

    codes: DataFrame
    codebooks: list[np.ndarray]

    def digest(self) -> str:
        """SHA-256 of all components in decimal, by part, entry and position, joined by commas."""
        numbers = ",".join(str(x) for book in self.codebooks for x in book.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def vector_codes(
    df: DataFrame,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    scale: int = 1024,
    carry: Sequence[str] | None = None,
) -> VectorCodes:
    """Codes of all vectors, two hex digits or more per part, and their summed squared distances."""
    values = F.col(f"`{vector}`").cast("array<double>")
    rows = keep_row(df, F.col(f"`{id}`").alias("id"), values.alias("x"), carry=carry)
    rows = rows.filter(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    first = _first(rows, entries)
    schema = rows.select("_row", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")).schema
    if not first:
        return VectorCodes(df.sparkSession.createDataFrame([], schema), [])
    length = len(first[0])
    if length % parts:
        raise ValueError(f"vectors of {length} components can not be cut into {parts} equal parts")
    books = np.split(_whole(np.array(first).reshape(len(first), length), scale, parts), parts, axis=1)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _blocks(batches):
            x = held.column("x").flatten().to_numpy(zero_copy_only=False).reshape(held.num_rows, length)
            trees = [_stored_tree(part) for part in np.split(_whole(x, scale, parts), parts, axis=1)]
            bounds = pa.array([0, held.num_rows], pa.int32())
            kept = pa.ListArray.from_arrays(bounds, held.column("_row"))
            yield pa.RecordBatch.from_arrays(
                [kept, *[pa.array([list(c)], pa.list_(pa.binary())) for c in zip(*trees)]],
                ["rows", "points", "weights", "nodes", "places"],
            )

    alike = rows.filter(F.size("x") == length).select("x", "_row")
    # The type of the rows comes from Spark itself; an empty select gives it without a job.
    shape = rows.select(F.array("_row").alias("rows"), *[F.array(F.lit(b"")).alias(c) for c in _TREE]).schema
    blocks = stage(alike.mapInArrow(build, shape), "cover-trees")
    for _ in range(rounds):
        books = _round(blocks, books)

    width = max(2, len(f"{entries - 1:x}"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                kept = batch.column("rows")[i].values
                codes, error = np.zeros((len(kept), parts), np.int64), np.zeros(len(kept), np.int64)
                for part, (tree, book) in enumerate(zip(_trees(batch, i, length // parts), books)):
                    code = nearest(tree, book)
                    codes[:, part] = code[tree.places]
                    error += ((tree.points - book[code]) ** 2).sum(1)[tree.places]
                digits = ["".join(f"{c:0{width}x}" for c in row) for row in codes.tolist()]
                yield pa.RecordBatch.from_arrays([kept, pa.array(digits), pa.array(error)], ["_row", "code", "error"])

    codes = blocks.mapInArrow(encode, schema)
    others = rows.filter(F.size("x") != length)
    unlike = others.select("_row", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    return VectorCodes(stage(codes.union(unlike), "vector-codes"), books)


_TREE = ("points", "weights", "nodes", "places")


@dataclass(frozen=True)
class CoverTree:
    """Distinct points in the order of a walk, how often each occurs, the nodes, and the point of each row."""

    points: np.ndarray
    weights: np.ndarray
    nodes: np.ndarray
    places: np.ndarray


def cover_tree(points: np.ndarray) -> CoverTree:
    """The tree of some points, given as rows of whole numbers.

    A node's points lie within its radius of its centre. Its children's centres lie more than half of the radius
    apart, and every point is below the first child that has it within half of the radius.
    """
    distinct, which, weights = np.unique(points, axis=0, return_inverse=True, return_counts=True)
    nodes = np.zeros(max(1, 2 * len(distinct)), NODE)
    order = np.arange(len(distinct))
    nodes[0], made, at = (0, len(distinct), 0, 0, 0.0), 1, 0
    while at < made:
        node = nodes[at]
        span = order[node["start"] : node["end"]]
        from_centre = squared(distinct[span], distinct[span[:1]])[:, 0]
        node["radius"] = np.sqrt(float(from_centre.max()))
        groups = _cover(distinct, span, node["radius"] / 2) if len(span) > LEAF else []
        if groups:
            span[:] = np.concatenate(groups)
            node["child"], node["children"] = made, len(groups)
            ends = node["start"] + np.cumsum([len(g) for g in groups])
            for start, end in zip([node["start"], *ends[:-1]], ends):
                nodes[made] = (start, end, 0, 0, 0.0)
                made += 1
        at += 1
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return CoverTree(distinct[order], weights[order], nodes[:made], place[which.ravel()])


def _cover(points: np.ndarray, left: np.ndarray, reach: float) -> list[np.ndarray]:
    """The points numbered ``left`` in groups around centres, each its group's first; none if there were many."""
    groups = []
    while len(left):
        if len(groups) == CHILDREN:
            return []
        near = squared(points[left], points[left[:1]])[:, 0] <= reach * reach
        groups.append(left[near])
        left = left[~near]
    return groups


def nearest(tree: CoverTree, book: np.ndarray) -> np.ndarray:
    """The nearest entry of each point of the tree."""
    found = np.empty(len(tree.points), np.int64)
    front = np.zeros(1, np.int64)
    while len(front):
        nodes = tree.nodes[front]
        far = squared(tree.points[nodes["start"]], book)
        best = far.argmin(1)
        close = np.sqrt(np.partition(far, min(1, len(book) - 1), axis=1)[:, :2].astype(float))
        second = close[:, 1] if len(book) > 1 else np.full(len(front), np.inf)
        # A little more than twice the radius, as roots are rounded.
        sure = (nodes["radius"] == 0) | (second - close[:, 0] > 2 * nodes["radius"] + 1e-9 * close[:, -1])
        closed = nodes[sure]
        found[_spans(closed)] = np.repeat(best[sure], closed["end"] - closed["start"])
        open_ = nodes[~sure]
        single = _spans(open_[open_["children"] == 0])
        found[single] = squared(tree.points[single], book).argmin(1)
        inner = open_[open_["children"] > 0]
        front = _spans(inner, "child", "children")
    return found


def _spans(nodes: np.ndarray, start: str = "start", length: str | None = None) -> np.ndarray:
    """All places in the nodes' stretches."""
    sizes = (nodes[length] if length else nodes["end"] - nodes["start"]).astype(np.int64)
    first = np.repeat(nodes[start] - np.cumsum(sizes) + sizes, sizes)
    return first + np.arange(sizes.sum())


def squared(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Exact squared distances of points to entries."""
    top = max(np.abs(points).max(initial=0), np.abs(book).max(initial=0))
    if 4 * points.shape[1] * int(top) ** 2 < 1 << 53:
        # All terms are whole numbers that floating point holds exactly.
        a, b = points.astype(float), book.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)
    out = np.zeros((len(points), len(book)), np.int64)
    for i, entry in enumerate(book):
        out[:, i] = ((points - entry) ** 2).sum(1)
    return out


def _first(rows: DataFrame, entries: int) -> list[list[float]]:
    """The vectors of the smallest ids."""
    order = [F.col("id").asc_nulls_last(), "x"]

    def smallest(given: DataFrame) -> list[list[float]]:
        return [r.x for r in stage(given.orderBy(*order).limit(entries), "first-codebook").orderBy(*order).collect()]

    first = smallest(rows.select("id", "x"))
    if any(len(x) != len(first[0]) for x in first):
        first = smallest(rows.filter(F.size("x") == len(first[0])).select("id", "x"))
    return first


def _whole(x: np.ndarray, scale: int, parts: int) -> np.ndarray:
    scaled = np.floor(x * scale)
    if len(x) and 4 * max(1, x.shape[1]) * float(np.abs(scaled).max(initial=0)) ** 2 >= 2.0**62:
        raise ValueError("squared distances of these vectors do not fit into 64 bits")
    return scaled.astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= BLOCK:
            yield pa.concat_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.concat_batches(held)


def _stored_tree(points: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    tree = cover_tree(points)
    return (_packed(tree.points), tree.weights.astype("<i4").tobytes(), tree.nodes.tobytes(), tree.places.astype("<i4").tobytes())


def _packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as all of them fit into, behind that number."""
    top = int(np.abs(numbers).max(initial=0))
    size = next(s for s in (2, 4, 8) if top < 1 << (8 * s - 1))
    return bytes([size]) + numbers.astype(f"<i{size}").tobytes()


def _trees(batch: pa.RecordBatch, row: int, width: int) -> Iterator[CoverTree]:
    """The trees of a stored block, one for each part."""
    columns = [batch.column(c)[row].as_py() if c in batch.schema.names else None for c in _TREE]
    for part, points in enumerate(columns[0]):
        weights = np.frombuffer(columns[1][part], "<i4")
        numbers = np.frombuffer(points[1:], f"<i{points[0]}").astype(np.int64).reshape(len(weights), width)
        places = np.frombuffer(columns[3][part], "<i4") if columns[3] else np.zeros(0, np.int32)
        yield CoverTree(numbers, weights, np.frombuffer(columns[2][part], NODE), places)


def _round(blocks: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after one round; entries that no part is nearest to stay."""
    width = books[0].shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(b.shape, np.int64) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        for batch in batches:
            for i in range(batch.num_rows):
                for part, tree in enumerate(_trees(batch, i, width)):
                    code = nearest(tree, books[part])
                    # Points with one entry lie together in stretches; running sums give the sum of each.
                    starts = np.append(0, np.flatnonzero(np.diff(code)) + 1)
                    ends = np.append(starts[1:], len(code))
                    weights = tree.weights.astype(np.int64)
                    upto = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(tree.points * weights[:, None], axis=0)])
                    held = np.append(0, np.cumsum(weights))
                    np.add.at(total[part], code[starts], upto[ends] - upto[starts])
                    np.add.at(count[part], code[starts], held[ends] - held[starts])
        for part in range(len(books)):
            used = np.flatnonzero(count[part])
            yield pa.RecordBatch.from_pydict(
                {
                    "part": pa.array(np.full(len(used), part), pa.int32()),
                    "entry": pa.array(used, pa.int32()),
                    "n": pa.array(count[part][used]),
                    "total": pa.array(list(total[part][used]), pa.list_(pa.int64())),
                }
            )

    of_task = blocks.select(*_TREE[:3]).mapInArrow(sums, "part int, entry int, n bigint, total array<bigint>")
    found = of_task.select("part", "entry", "n", F.posexplode("total").alias("place", "value"))
    # At most one row per component of the codebooks.
    added = found.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("value").alias("value")).collect()
    moved = [b.copy() for b in books]
    for r in added:
        moved[r.part][r.entry, r.place] = r.value // r.n
    return moved
