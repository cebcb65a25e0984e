"""Bytes of documents covered by strings of ``LENGTH`` bytes that start anywhere else too.

1. Texts that occur more than once, as a whole, are covered; one of each goes on.
2. Screen. Every window of ``LENGTH`` bytes has an anchor: of the ``GRAM``-byte grams in it the first of
   the smallest hash. Equal windows have equal anchors in the same place. A window reaches a certain
   stretch beyond its anchor, to the left or to the right, and the hash of anchor and stretch is its key.
   Keys, two per anchor, are counted in buckets, each text's once per batch; a window whose key no other
   text or place has is unique.
3. Suffixes. Windows of shared keys go, with their bytes, to the task of their key. Tasks hold one block of
   keys at a time and sort its suffixes by ``suffix_sort``, equal stretches once; neighbours decide. Blocks are
   laid out so that anchors fall on the same place of the difference cover's period, so most ties meet the
   sample at once.
4. A key of more than ``HOT`` texts is dealt out again by the windows themselves: each is counted by a
   128-bit hash, so a string that a third of all texts share is a row per task.

Nothing is dropped by the screen that has an equal; what it lets through is compared byte for byte, but for
hot keys. NULL is the empty text; windows never cross documents. Repeated rows are documents of their
own, and so copies of each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import bound_batches, flat, mix64, partitions, pieces, texts
from pulsetrail.llm.shared_keys import shared_keys, sized, text_id
from pulsetrail.llm.suffix_sort import PERIOD, repeated
from pulsetrail.workspace import stage

LENGTH = 200
GRAM = 56
GRAMS = LENGTH - GRAM + 1  # in a window
# A window whose anchor starts up to here in it has its stretch to the right of the anchor, else to the left.
HALF = GRAMS // 2
HOT = 20_000
# Texts are taken in pieces of this many windows, and this many bytes of context sorted at once.
PIECE = 2 << 20
PLACE_BITS = 22  # PIECE + LENGTH is below 2 ** 22
BLOCK = 4 << 20

BASE = 0x9E3779B97F4A7C15
CONTEXT, SPAN, WINDOW = range(3)


def cut_repeats(df: DataFrame, *, id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each of ``df``: doc_id, n_bytes, n_removed, n_spans (runs of removed bytes) and
    kept_sha256 of what is left."""
    body = F.coalesce(F.col(text), F.lit(""))
    docs = bound_batches(df).select(
        F.col(id).cast("bigint").alias("id"),
        text_id(body).alias("t"),
        F.xxhash64(F.lit("second"), body).alias("u"),
        body.alias("text"),
    )
    found = stage(_spans(docs), "repeats-spans")
    per_text = found.groupBy("t", "u").agg(
        F.max("copies").alias("copies"),
        F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", "stop"))).alias("spans"),
    )
    per_text = stage(per_text, "repeats")
    known = docs.join(sized(per_text, 48), ["t", "u"], "left").select("id", "text", "copies", "spans")
    return known.mapInArrow(_cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        rows = []
        for raw, copies, spans in zip(texts(batch.column("text")), batch.column("copies").to_pylist(), batch.column("spans").to_pylist()):
            if copies and len(raw) >= LENGTH:
                runs = [(0, len(raw))]
            else:
                runs = merged([(s["start"], s["stop"]) for s in spans or []])
            kept, at = hashlib.sha256(), 0
            for start, stop in runs:
                kept.update(raw[at:start])
                at = stop
            kept.update(raw[at:])
            rows.append((len(raw), sum(b - a for a, b in runs), len(runs), kept.hexdigest()))
        columns = [pa.array(c) for c in zip(*rows)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs that ``spans`` cover; those that touch are one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _spans(docs: DataFrame) -> DataFrame:
    """Rows (t, u, copies, start, stop): covered stretches of texts, and texts that occur more than once."""
    long = docs.filter(F.octet_length("text") >= LENGTH)
    counted = long.groupBy("t", "u").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep"))
    copies = stage(counted.filter("n > 1"), "repeats-copies")
    shared = stage(shared_keys(long.select("t", "text"), anchors, PIECE, HOT), "repeats-keys")
    one_each = long.join(sized(copies, 40), ["t", "u"], "left").filter(F.col("n").isNull() | F.col("id").eqNullSafe(F.col("rep")))
    wanted = one_each.select("t", "u", "text").join(sized(shared, 40, "n"), "t").select("t", "u", "text", "keys", "hot")
    sent = stage(wanted.mapInArrow(_send_windows, _SENT), "repeats-windows")
    spark = docs.sparkSession
    contexts = sent.filter(F.col("kind") == CONTEXT).repartition(partitions(spark), "key").sortWithinPartitions("key")
    sorted_out = contexts.mapInArrow(_sort_blocks, "t bigint, u bigint, start bigint, stop bigint")
    own = sent.filter(F.col("kind") == SPAN).select("t", "u", "start", (F.col("start") + F.col("windows") + (LENGTH - 1)).alias("stop"))
    windows = sent.filter(F.col("kind") == WINDOW)
    # Every window of a text is there once, so a second row is another place.
    several = windows.groupBy("key", "second").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("key", "second")
    hot = windows.join(several, ["key", "second"]).select("t", "u", "start", (F.col("start") + LENGTH).alias("stop"))
    spans = sorted_out.unionByName(own).unionByName(hot).withColumn("copies", F.lit(False))
    whole = copies.select("t", "u", F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("stop"), F.lit(True).alias("copies"))
    return spans.unionByName(whole)


# --- windows ------------------------------------------------------------------------------------

_SENT = "kind int, key bigint, second bigint, t bigint, u bigint, start bigint, windows int, anchor int, context binary"


def _send_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text", PIECE):
        t, u = (batch.column(c).to_numpy() for c in ("t", "u"))
        keys, hot = batch.column("keys").to_pylist(), batch.column("hot").to_pylist()
        data, offsets = flat(batch.column("text"))
        for found in anchors(batch.column("text")):
            rows = _Rows()
            short = (found["key"] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            ends = np.searchsorted(found["row"], np.arange(batch.num_rows + 1))
            for row in range(batch.num_rows):
                part = slice(ends[row], ends[row + 1])
                if part.start == part.stop:
                    continue
                chosen = np.flatnonzero(np.isin(short[part], np.array(keys[row], np.int32))) + part.start
                _contexts(rows, found, chosen, data, int(offsets[row]), int(t[row]), int(u[row]))
                if hot[row]:
                    chosen = np.flatnonzero(np.isin(short[part], np.array(hot[row], np.int32))) + part.start
                    _windows(rows, found, chosen, data, int(offsets[row]), int(t[row]), int(u[row]))
            if rows.columns[0]:
                yield rows.batch()


class _Rows:
    """Rows on their way to the next step."""

    def __init__(self):
        self.columns: list[list] = [[] for _ in range(9)]

    def add(self, *values) -> None:
        for column, value in zip(self.columns, values):
            column.append(value)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.int32(), pa.binary()]
        names = [c.split()[0] for c in _SENT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(self.columns, kinds)], names)


def _contexts(rows: _Rows, found: dict, chosen: np.ndarray, data: np.ndarray, base: int, t: int, u: int) -> None:
    """The bytes around shared anchors; what a text has several times goes out once, as covered."""
    columns = [found[c][chosen].tolist() for c in ("first", "count", "anchor")]
    keys = found["key"][chosen].view(np.int64).tolist()
    seen: dict[bytes, int] = {}
    covered: list[tuple[int, int]] = []
    for first, count, anchor, key in zip(*columns, keys):
        context = data[base + first : base + first + count + LENGTH - 1].tobytes()
        if context in seen:
            covered += [(first, first + count), (seen[context], seen[context] + count)]
        else:
            seen[context] = first
            rows.add(CONTEXT, key, None, t, u, first, count, anchor - first, context)
    for start, stop in merged(covered):
        rows.add(SPAN, None, None, t, u, start, stop - start, None, None)


def _windows(rows: _Rows, found: dict, chosen: np.ndarray, data: np.ndarray, base: int, t: int, u: int) -> None:
    """Every window of very common anchors by two hashes of its own."""
    for first, count in zip(found["first"][chosen].tolist(), found["count"][chosen].tolist()):
        for start in range(first, first + count):
            digest = hashlib.blake2b(data[base + start : base + start + LENGTH].tobytes(), digest_size=16).digest()
            one, two = np.frombuffer(digest, np.int64).tolist()
            rows.add(WINDOW, one, two, t, u, start, 1, None, None)


def anchors(column: pa.Array) -> Iterator[dict[str, np.ndarray]]:
    """Runs of windows that share an anchor and a side of it: row, first (place of the first window in the
    text), count, anchor (its place in the text), key."""
    data, offsets = flat(column)
    row = 0
    while row < len(column):
        # Many texts at once, or a piece of a long one at a time.
        if offsets[row + 1] - offsets[row] > PIECE:
            for at in range(int(offsets[row]), int(offsets[row + 1]) - LENGTH + 1, PIECE):
                stop = min(at + PIECE + LENGTH - 1, int(offsets[row + 1]))
                yield _anchors(data[at:stop], np.array([0, stop - at]), np.array([at - offsets[row]]), row)
            row += 1
            continue
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1)
        yield _anchors(data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row], np.zeros(last - row, np.int64), row)
        row = last


def _anchors(data: np.ndarray, offsets: np.ndarray, skipped: np.ndarray, first_row: int) -> dict[str, np.ndarray]:
    n = len(data)
    if n < LENGTH:
        return {c: np.empty(0, np.uint64 if c == "key" else np.int64) for c in ("row", "first", "count", "anchor", "key")}
    power, inverse = _powers()
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])

    def gram(start: np.ndarray, length: int) -> np.ndarray:
        return (sums[start + length] - sums[start]) * inverse[start]

    grams = mix64((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    # The place in the low bits makes the first of equal grams the smallest, the same way in every piece.
    bits = np.uint64(PLACE_BITS)
    least = ((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64)
    width = 1
    while 2 * width <= GRAMS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = GRAMS - width
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    lengths = np.diff(offsets)
    windows = np.maximum(lengths - LENGTH + 1, 0)
    row = np.repeat(np.arange(len(lengths)), windows)
    place = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows) + offsets[row]
    anchor = (least[place] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    right = anchor - place <= HALF
    new = np.ones(len(place), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (right[1:] != right[:-1]) | (row[1:] != row[:-1])
    runs = np.flatnonzero(new)
    count = np.diff(np.append(runs, len(place)))
    row, first, anchor, right = row[runs], place[runs], anchor[runs], right[runs]
    # What all windows of a side have in common.
    key = np.empty(len(runs), np.uint64)
    key[right] = mix64(gram(anchor[right], LENGTH - HALF))
    key[~right] = mix64(gram(anchor[~right] - HALF - 1, LENGTH - GRAMS + 1 + HALF + 1) + np.uint64(1))
    start = offsets[row] - skipped[row]
    return {"row": row + first_row, "first": first - start, "count": count, "anchor": anchor - start, "key": key}


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""

    def powers(of: int) -> np.ndarray:
        out = np.full(PIECE + LENGTH, of, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return powers(BASE), powers(pow(BASE, -1, 1 << 64))


# --- suffixes -----------------------------------------------------------------------------------


def _sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size, last = 0, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("key", "t", "u", "start", "windows", "anchor", "context")]
        for row in zip(*columns):
            if size >= BLOCK and row[0] != last:
                yield from _sort_block(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
            last = row[0]
    if held:
        yield from _sort_block(held)


def _sort_block(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """Covered stretches of the contexts of whole keys. Equal ones are sorted once, as all their windows are there again."""
    first: dict[bytes, int] = {}
    same = np.array([first.setdefault(row[6], i) for i, row in enumerate(rows)])
    copied = np.bincount(same, minlength=len(rows))[same] > 1
    if copied.any():
        t, u, start, windows = (np.array([row[c] for row in rows], np.int64)[copied] for c in (1, 2, 3, 4))
        yield _covered(t, u, start, start + windows + (LENGTH - 1))
    alone = ~copied[list(first.values())]
    rows = [rows[i] for i in first.values()]
    parts, begins, at = [], [], 0
    for row in rows:
        # Anchors all fall on the same place of the period.
        gap = -(at + row[5]) % PERIOD
        parts += [bytes(gap), row[6]]
        begins.append(at + gap)
        at += gap + len(row[6])
    data = np.frombuffer(b"".join(parts), np.uint8)
    counts = np.array([row[4] for row in rows])
    of = np.repeat(np.arange(len(rows)), counts)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    again = repeated(data, np.array(begins)[of] + inside, LENGTH)
    hit = np.flatnonzero(again & alone[of])
    if not len(hit):
        return
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) != 1) | (of[hit[1:]] != of[hit[:-1]])
    begin, last = hit[new], hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
    t, u, start = (np.array([row[c] for row in rows], np.int64)[of[begin]] for c in (1, 2, 3))
    yield _covered(t, u, start + inside[begin], start + inside[last] + LENGTH)


def _covered(*columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["t", "u", "start", "stop"])
