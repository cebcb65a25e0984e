"""Which keys of texts other texts have too, without moving the texts.

Every text has many 64-bit keys. Tasks send each key of a text once, in one array of 16 bytes per key for
each bucket of keys, so a row is thousands of keys. Copies of a text, and a key that a text has many
times, shrink to one entry per task before anything moves; a bucket holds a bounded number of keys, as
their number follows the partitions, whatever one key is worth.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import partitions, pieces

# Keys are sent off when a task has this many.
SEND = 1 << 20
# Tables up to this size are sent to all tasks; larger ones are joined by shuffle.
BROADCAST_BYTES = 16 << 20
_UNIT = (1 << 64) - 1

Keys = Callable[[pa.Array], Iterator[dict[str, np.ndarray]]]


def text_id(text: Column) -> Column:
    """A 64-bit number of a text. Its lowest bit is left free, see KEY."""
    return F.xxhash64(text).bitwiseAND(F.lit(-2).cast("bigint"))


def sized(table: DataFrame, row_bytes: int, inner: str | None = None) -> DataFrame:
    """``table``, sent to all tasks if its rows, and 8 bytes for each of ``inner``, are few enough."""
    rows, held = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(inner) if inner else F.lit(0), F.lit(0))).first()
    return F.broadcast(table) if rows * row_bytes + 8 * held <= BROADCAST_BYTES else table


def shared_keys(docs: DataFrame, keys_of: Keys, piece: int, hot: int, *, own: bool = True) -> DataFrame:
    """For texts with shared keys: t, keys (the upper half of each), hot (those that more than ``hot`` texts
    share) and n, how many there are.

    ``docs`` has t and text; ``keys_of`` gives row and key of some texts at a time, of at most ``piece`` bytes
    or a single one. With ``own`` a text's key that only it has, but twice, is shared too."""
    spark = docs.sparkSession
    buckets = 4 * partitions(spark)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        waiting = 0
        for batch in pieces(batches, "text", piece):
            of = batch.column("t").to_numpy().view(np.uint64)
            for found in keys_of(batch.column("text")):
                held.append(_once(found["key"], of[found["row"]]))
                waiting += len(held[-1])
            if waiting >= SEND:
                yield _buckets(np.concatenate(held), buckets)
                held, waiting = [], 0
        if waiting:
            yield _buckets(np.concatenate(held), buckets)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = [], None
        for batch in batches:
            for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
                if bucket != at and held:
                    yield _shared(held, hot, own)
                    held = []
                at = bucket
                held.append(np.frombuffer(data, KEY))
        if held:
            yield _shared(held, hot, own)

    sent = docs.mapInArrow(send, "bucket int, data binary")
    together = sent.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket")
    keys = together.mapInArrow(count, "t bigint, key int, hot boolean")
    return keys.groupBy("t").agg(
        F.collect_list(F.when(~F.col("hot"), F.col("key"))).alias("keys"),
        F.collect_list(F.when(F.col("hot"), F.col("key"))).alias("hot"),
        F.count(F.lit(1)).alias("n"),
    )


# A key and its text, in the lowest bit of which stands whether the text has the key twice.
KEY = np.dtype([("key", "<u8"), ("text", "<u8")])
_TEXT = np.uint64(_UNIT - 1)


def _once(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Each key of a text once."""
    of = of & _TEXT
    order = np.lexsort([of, keys])
    keys, of = keys[order], of[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (of[1:] != of[:-1])
    first = np.flatnonzero(new)
    twice = np.diff(np.append(first, len(keys))) > 1
    out = np.empty(len(first), KEY)
    out["key"], out["text"] = keys[first], of[first] | twice.astype(np.uint64)
    return out


def _buckets(rows: np.ndarray, buckets: int) -> pa.RecordBatch:
    bucket = (rows["key"] % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows, bucket = rows[order], bucket[order]
    names, first = np.unique(bucket, return_index=True)
    ends = np.append(first[1:], len(rows))
    data = [rows[a:b].tobytes() for a, b in zip(first, ends)]
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array(data, pa.binary())], ["bucket", "data"])


def _shared(held: list[np.ndarray], most: int, own: bool) -> pa.RecordBatch:
    """The rows of one bucket whose key another text has too, or, with ``own``, the text itself twice."""
    rows = np.concatenate(held)
    twice = (rows["text"] & ~_TEXT) > 0
    key, text = rows["key"], rows["text"] & _TEXT
    order = np.lexsort([text, key])
    key, text, twice = key[order], text[order], twice[order]
    new_key = np.ones(len(key), bool)
    new_key[1:] = key[1:] != key[:-1]
    new = new_key.copy()
    new[1:] |= text[1:] != text[:-1]
    row = np.flatnonzero(new)
    group = np.cumsum(new_key[row]) - 1
    members = np.bincount(group)
    twice = np.bitwise_or.reduceat(twice, row) if len(row) else twice
    self_shared = np.bincount(group, twice) > 0
    chosen = (members[group] > 1) | (own & self_shared[group])
    row, hot = row[chosen], members[group][chosen] > most
    short = (key[row] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(text[row].view(np.int64)), pa.array(short), pa.array(hot)], ["t", "key", "hot"])
