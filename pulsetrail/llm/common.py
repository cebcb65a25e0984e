"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Batches = Iterator[pa.RecordBatch]

# The ASCII white space between words: space, tab, line feed, vertical tab, form feed, return.
SPACES = b" \t\n\x0b\x0c\r"
# Rows handed to Python at once; some megabytes of text as a rule.
BATCH_ROWS = 500
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(df: DataFrame) -> DataFrame:
    """``df``, with few rows at a time handed to Python, as a row may be a long text."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, giving the memory it took back to the machine at the end of each task.

    Spark keeps its Python workers for later tasks, and these keep what they once took unless told otherwise.
    """

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return task


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def keep_row(df: DataFrame, *columns: Column, carry: Sequence[str] | None = None) -> DataFrame:
    """``columns`` and the row as ``_row``, so that no name of the input can clash with a name in use.

    ``carry`` names what of the row is needed; by default all of it.
    """
    return bound_batches(df).select(*columns, F.struct(*[F.col(f"`{c}`") for c in carry or df.columns]).alias("_row"))


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that the texts of each take at most ``limit`` bytes, or hold a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(sizes(batch.column(text)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def gathered(batches: Iterator[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Record batches put together and cut so that the texts of each take about ``limit`` bytes."""
    held: list[pa.RecordBatch] = []
    waiting = 0
    for batch in pieces(batches, text, limit):
        size = int(sizes(batch.column(text)).sum())
        if held and waiting + size > limit:
            yield pa.concat_batches(held)
            held, waiting = [], 0
        held.append(batch)
        waiting += size
    if held:
        yield pa.concat_batches(held)


def sizes(column: pa.Array) -> np.ndarray:
    """Bytes of each text, 0 for NULL."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0)
    return lengths.to_numpy(zero_copy_only=False).astype(np.int64)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another and the offsets of its rows; NULL is empty."""
    column = pa.compute.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def texts(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; NULL is empty."""
    return [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def count_words(column: pa.Array) -> np.ndarray:
    """Words of each text: runs of characters other than ASCII white space."""
    data, offsets = flat(column)
    word = ~is_space(data)
    starts = word.copy()
    starts[1:] &= ~word[:-1]
    # A text begins anew, whatever stands before it.
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = word[first]
    upto = np.concatenate([[0], np.cumsum(starts)])
    return upto[offsets[1:]] - upto[offsets[:-1]]


def with_word_count(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` without the column ``text`` and with the number of its words as ``name``."""
    kept = [c for c in bound_batches(df).columns if c != text]
    schema = df.select(*kept).withColumn(name, F.lit(0).cast("bigint")).schema

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text, 8 << 20):
            arrays = [batch.column(c) for c in kept] + [pa.array(count_words(batch.column(text)), pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, name])

    return df.mapInArrow(lean(count), schema)


def mix64(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))
