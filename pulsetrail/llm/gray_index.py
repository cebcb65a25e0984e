"""Pairs of 64-bit fingerprints that differ in few bits, by hierarchical indexes in Gray order.

An index holds fingerprints sorted by their rank in the Gray code, where neighbours differ in few bits.
Neighbours form a node that stores the bits all of them share as a pattern with a mask; eight nodes form
the next one, up to a single node. A child counts only the masked bits its parent does not have, so
going down adds up the differences between a fingerprint and ever smaller groups, and a group is left
out as a whole once they exceed the limit. When even the bits a group does not share can not exceed it,
all of the group belong, and one link to its first member stands for them.

The top of the hierarchy is dealt out to tasks. For ``bits`` differences the 64 bits are cut into
``bits + 2`` pieces; two of them are the same in any pair. For each choice of two pieces there is an
index with those bits in front, and the upper nodes that share them are independent of each other: a
difference in their pattern prunes every other one. An upper node of more than ``BLOCK`` members is
dealt out again, as pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import lean, partitions
from pulsetrail.workspace import stage

BLOCK = 4096
FAN_OUT = 8
# So many rows of upper nodes are searched at once, and so many candidates.
GATHER = 1 << 16
FRONTIER = 1 << 20

ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def gray_links(entries: DataFrame, bits: int = 4, *, forest: bool = True, every: bool = True) -> DataFrame:
    """Links (a, b) between the ids of ``entries`` (id, fp) whose fingerprints differ in at most ``bits``.

    With ``forest`` every task returns the fewest links that connect what it found, else all it found
    with one link standing for groups that belong as a whole. If ``entries`` have a ``root``, it is every
    pair with different roots instead, or, unless ``every``, as few of these pairs as connect the roots that all do.
    Ids are distinct, fingerprints need not be.
    """
    spark = entries.sparkSession
    root = ["root"] if "root" in entries.columns else []
    orders = list(combinations(range(bits + 2), 2))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            codes = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for number, order in enumerate(orders):
                rest = np.uint64(64 - _lead(order, bits))
                code = permute(codes, order, bits)
                group = (np.uint64(number) << np.uint64(40)) | (code >> rest)
                low = gray_rank(code) & ((np.uint64(1) << rest) - np.uint64(1))
                arrays = [ids, pa.array(group.view(np.int64)), pa.array(low.view(np.int64)), batch.column("fp")]
                yield pa.RecordBatch.from_arrays(arrays + [batch.column(c) for c in root], ["id", "node", "rank", "fp", *root])

    placed = entries.mapInArrow(lean(spread), "id bigint, node bigint, rank bigint, fp bigint" + ", root bigint" * len(root))
    sizes = placed.groupBy("node").count().filter(F.col("count") > BLOCK)
    large = stage(sizes.select("node", F.ceil(F.col("count") / BLOCK).alias("blocks")), "gray-large")
    own = F.pmod(F.xxhash64("id"), F.col("blocks"))
    other = F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(None).cast("bigint"))).otherwise(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = placed.join(large, "node", "left").withColumn("own", own).withColumn("other", other)
    dealt = dealt.select(
        "node", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "rank", "id", "fp", *root
    )
    key = ["node", "x", "y"]
    in_order = dealt.repartition(partitions(spark), *key).sortWithinPartitions(*key, "rank")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if root:
            for starts, ids, codes, roots, node in groups(batches, "root", "node"):
                if not every:
                    a, b = _between(roots, search(starts, codes, bits, roots, every=False))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])
                    continue
                order = node >> 40
                for a, b in search(starts, codes, bits, roots):
                    # An index has the pairs that share no earlier pieces than its own.
                    own = order[a] == _first_order(codes[a] ^ codes[b], bits)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[a[own]]), pa.array(ids[b[own]])], ["a", "b"])
            return
        for starts, ids, codes in groups(batches):
            found = search(starts, codes, bits)
            for a, b in [fewest(len(codes), found)] if forest else found:
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    links = in_order.mapInArrow(lean(link), "a bigint, b bigint")
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def groups(batches: Iterator[pa.RecordBatch], *more: str) -> Iterator[tuple[np.ndarray, ...]]:
    """Whole upper nodes of two or more members from rows in order: where each starts, ids, fingerprints and ``more``."""
    held: list[tuple[np.ndarray, ...]] = []
    waiting = 0

    def take(last: bool) -> tuple[np.ndarray, ...] | None:
        nonlocal held, waiting
        node, x, y, ids, fp, *rest = (np.concatenate(c) for c in zip(*held))
        new = np.ones(len(node), bool)
        new[1:] = (node[1:] != node[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        starts = np.flatnonzero(new)
        stop = len(node) if last else starts[-1]
        held, waiting = [tuple(c[stop:] for c in (node, x, y, ids, fp, *rest))], 0
        bounds = np.append(starts[starts < stop], stop)
        size = np.repeat(np.diff(bounds), np.diff(bounds))
        shared = np.flatnonzero(size > 1)
        if not len(shared):
            return None
        counts = np.diff(bounds)
        counts = counts[counts > 1]
        return np.concatenate([[0], np.cumsum(counts)]), ids[shared], fp[shared].view(np.uint64), *[c[shared] for c in rest]

    for batch in batches:
        columns = [pa.compute.fill_null(batch.column(c), -1).to_numpy(zero_copy_only=False) for c in ("node", "x", "y", "id", "fp", *more)]
        held.append(tuple(columns))
        waiting += batch.num_rows
        if waiting >= GATHER and (found := take(False)):
            yield found
    if held and sum(len(h[0]) for h in held) and (found := take(True)):
        yield found


def search(starts: np.ndarray, codes: np.ndarray, bits: int, label: np.ndarray | None = None, *, every: bool = True) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of linked fingerprints in ``codes``, which hold one index after another, each in Gray order
    from ``starts[i]`` to ``starts[i + 1]``. With a ``label`` for each, all pairs of different labels, or,
    unless ``every``, enough of them to connect the same labels."""
    levels = build(starts, codes)
    if label is not None:
        for level in levels:
            level["low"], level["high"] = (f.reduceat(label, level["start"]) for f in (np.minimum, np.maximum))
    top = len(levels) - 1
    queries = np.arange(len(codes))
    roots = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    apart = np.bitwise_count((codes ^ levels[top]["pattern"][roots]) & levels[top]["mask"][roots]).astype(np.int8)
    waiting = [(top, queries, roots, apart)]
    while waiting:
        level, query, node, apart = waiting.pop()
        if level == 0:
            other = query != node
            yield query[other], node[other]
            continue
        here, below = levels[level], levels[level - 1]
        count = here["children"][node]
        if len(query) > 1 and count.sum() > FRONTIER:
            half = len(query) // 2
            waiting += [(level, query[:half], node[:half], apart[:half]), (level, query[half:], node[half:], apart[half:])]
            continue
        child = np.repeat(here["child"][node] - np.cumsum(count) + count, count) + np.arange(count.sum())
        query, apart = np.repeat(query, count), np.repeat(apart, count)
        # Links go to later places, so each pair comes up once; the last of a group still meets its group.
        ahead = below["stop"][child] > query
        if label is not None:
            ahead &= (below["low"][child] != label[query]) | (below["high"][child] != label[query])
        child, query, apart = child[ahead], query[ahead], apart[ahead]
        apart = apart + np.bitwise_count((codes[query] ^ below["pattern"][child]) & below["fresh"][child]).astype(np.int8)
        near = apart <= bits
        child, query, apart = child[near], query[near], apart[near]
        if level > 1 and (label is None or not every):
            whole = apart + below["open"][child] <= bits
            first = below["start"][child]
            other = whole & (query != first)
            yield query[other], first[other]
            child, query, apart = child[~whole], query[~whole], apart[~whole]
        if len(query):
            waiting.append((level - 1, query, child, apart))


def fewest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """At most a link for each of ``n`` places that connects what ``links`` do."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def shorten() -> tuple[np.ndarray, np.ndarray]:
        a, b = (np.concatenate(x) for x in zip(*held)) if held else (np.empty(0, np.int64),) * 2
        label = spanning(n, a, b)
        a = np.flatnonzero(label != np.arange(n))
        return a, label[a]

    for link in links:
        held.append(link)
        if sum(len(a) for a, _ in held) > n + FRONTIER:
            held = [shorten()]
    return shorten()


def _between(label: np.ndarray, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """As few of the ``links`` as connect the labels that all of them do."""
    names, label = np.unique(label, return_inverse=True)
    a = b = np.empty(0, np.int64)
    for x, y in links:
        a, b = np.concatenate([a, x]), np.concatenate([b, y])
        kept = forest(len(names), label[a], label[b])
        a, b = a[kept], b[kept]
    return a, b


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which links between ``n`` places connect what all do, without a circle."""
    group = np.arange(n)
    open_ = np.flatnonzero(a != b)
    kept = []
    while len(open_):
        # The first link out of each group; its other end's may be the same.
        first = np.full(n, len(a))
        np.minimum.at(first, group[a[open_]], open_)
        np.minimum.at(first, group[b[open_]], open_)
        kept.append(np.unique(first[first < len(a)]))
        group = spanning(n, group[a[kept[-1]]], group[b[kept[-1]]])[group]
        open_ = open_[group[a[open_]] != group[b[open_]]]
    return np.concatenate(kept) if kept else open_


def build(starts: np.ndarray, codes: np.ndarray) -> list[dict[str, np.ndarray]]:
    """The nodes of the indexes, level by level from the fingerprints to one node for each index."""
    n = len(codes)
    every, some = codes, codes
    first, stop = np.arange(n), np.arange(1, n + 1)
    levels = [{"every": every, "some": some, "start": first, "stop": stop, "children": np.zeros(n, np.int64), "child": first}]
    while (np.diff(starts) > 1).any():
        counts = np.diff(starts)
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], counts)
        child = np.flatnonzero(place % FAN_OUT == 0)
        starts = np.concatenate([[0], np.cumsum(-(-counts // FAN_OUT))])
        under = levels[-1]
        children = np.diff(np.append(child, len(place)))
        levels.append(
            {
                "every": np.bitwise_and.reduceat(under["every"], child),
                "some": np.bitwise_or.reduceat(under["some"], child),
                "start": under["start"][child],
                "stop": under["stop"][child + children - 1],
                "children": children,
                "child": child,
            }
        )
    for level in levels:
        level["mask"] = ~(level["every"] ^ level["some"])
        level["pattern"] = level["every"]
        level["open"] = np.bitwise_count(~level["mask"]).astype(np.int8)
    for upper, level in zip(levels[1:], levels):
        level["fresh"] = level["mask"] & ~np.repeat(upper["mask"], upper["children"])
    return levels


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` places the smallest one it is linked to, through any number of links."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code ^ (code >> np.uint64(shift))
    return code


def permute(codes: np.ndarray, order: tuple[int, ...], bits: int) -> np.ndarray:
    """``codes`` with the pieces of ``order`` in front."""
    widths = _widths(bits)
    ends = np.cumsum(widths)
    out = np.zeros_like(codes)
    for piece in (*order, *[p for p in range(bits + 2) if p not in order]):
        width = np.uint64(widths[piece])
        value = (codes >> np.uint64(64 - ends[piece])) & ((np.uint64(1) << width) - np.uint64(1))
        out = (out << width) | value
    return out


def _first_order(apart: np.ndarray, bits: int) -> np.ndarray:
    """Number of the first order whose two pieces have none of the bits ``apart``."""
    ends = np.cumsum(_widths(bits))
    same = []
    for width, end in zip(_widths(bits), ends):
        mask = ((1 << width) - 1) << int(64 - end)
        same.append((apart & np.uint64(mask)) == 0)
    out = np.full(len(apart), -1, np.int64)
    for number, (p, q) in enumerate(combinations(range(bits + 2), 2)):
        out[(out < 0) & same[p] & same[q]] = number
    return out


def _widths(bits: int) -> list[int]:
    n = bits + 2
    return [64 // n + (p < 64 % n) for p in range(n)]


def _lead(order: tuple[int, ...], bits: int) -> int:
    return sum(_widths(bits)[p] for p in order)
