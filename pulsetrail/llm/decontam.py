"""Benchmark items inside documents, by MinHash containment search over size classes.

An item is the set of its runs of ``SHINGLE`` words; a document contains it if it has at least
``threshold`` of them. Items are sorted into classes by the number of their shingles, each up to twice
the last. A class has a sketch size that is enough for its largest items: the sketch of an item is the
smallest ``2 m + 1`` of its shingle hashes, where ``m`` is how many shingles a document may lack. A
document with enough of the item lacks no more than ``m`` of the sketch, so it holds ``m + 1`` at least;
documents that do are candidates, whatever their length, and no match is lost. Candidates are
verified by the shingles themselves.

Items go out to the tasks in blocks of a bounded number of bytes, and all documents are read once for
each block; documents are never shuffled. An item of fewer words than a shingle is the one run of all
its words. Words are separated by ASCII white space, A-Z in lower case.

Items and texts that are NULL or have no words match nothing. Repeated rows match as often as they are
given. Empty tables give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import keep_row, lean, mix64, pieces, texts
from pulsetrail.llm.simhash import words_of

SHINGLE = 5
THRESHOLD = 0.8
# Texts of items sent to the tasks at once.
BLOCK_BYTES = 8 << 20
# A worker forgets the words it has seen when there are more of them than this.
CACHED_WORDS = 200_000
FILTER_BITS = 22


def find_items(
    df: DataFrame,
    items: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    shingle: int = SHINGLE,
    carry: list[str] | None = None,
) -> DataFrame:
    """A row for each row of ``df`` (as ``_row``) and item it contains: item_id, n_shared, n_shingles,
    containment."""
    rows = keep_row(df, F.col(text).alias("text"), carry=carry)
    out = "item_id bigint, n_shared bigint, n_shingles bigint, containment double"
    schema = f"{out}, _row {rows.schema['_row'].dataType.simpleString()}"
    found = df.sparkSession.createDataFrame([], schema)
    for block in _blocks(items.select(F.col(item_id).cast("bigint").alias("item_id"), F.col(item_text).alias("text"))):
        found = found.unionByName(rows.mapInArrow(lean(_finder(block, threshold, shingle)), schema))
    return found


def without_items(
    df: DataFrame, items: DataFrame, *, text: str = "text", threshold: float = THRESHOLD, shingle: int = SHINGLE
) -> DataFrame:
    """The rows of ``df`` that contain no item of ``items`` (item_id, text)."""
    rows = keep_row(df, F.col(text).alias("text")).withColumn("hit", F.lit(False))
    for block in _blocks(items.select("item_id", "text")):
        rows = rows.mapInArrow(lean(_flagger(block, threshold, shingle)), rows.schema)
    return rows.filter(~F.col("hit")).select("_row.*")


def _blocks(items: DataFrame) -> Iterator[list[tuple[int | None, bytes]]]:
    """All items, so many at a time that their texts take about ``BLOCK_BYTES``."""
    given = items.filter(F.col("text").isNotNull())
    size = given.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, blocks)))
    for block in range(blocks):
        yield [(r.item_id, r.text.encode()) for r in given.filter(number == block).collect()]


def _finder(items: list[tuple[int | None, bytes]], threshold: float, shingle: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(items, threshold, shingle)
        for batch in pieces(batches, "text"):
            at, item, shared = [], [], []
            for row, found in enumerate(index.search([words_of(t) for t in texts(batch.column("text"))])):
                for number, count in found:
                    at.append(row)
                    item.append(number)
                    shared.append(count)
            if at:
                sizes = np.array([index.sizes[i] for i in item], np.int64)
                n = np.array(shared, np.int64)
                keys = pa.array([index.ids[i] for i in item], pa.int64())
                row = batch.column("_row").take(pa.array(at, pa.int64()))
                arrays = [keys, pa.array(n), pa.array(sizes), pa.array(n / sizes), row]
                yield pa.RecordBatch.from_arrays(arrays, ["item_id", "n_shared", "n_shingles", "containment", "_row"])

    return find


def _flagger(items: list[tuple[int | None, bytes]], threshold: float, shingle: int):
    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = ItemIndex(items, threshold, shingle)
        for batch in pieces(batches, "text"):
            found = index.search([words_of(t) for t in texts(batch.column("text"))])
            hit = pa.compute.or_(batch.column("hit"), pa.array([bool(f) for f in found]))
            yield batch.set_column(batch.schema.get_field_index("hit"), "hit", hit)

    return flag


class WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


class ItemIndex:
    """Sketches of one block of items by size class."""

    def __init__(self, items: list[tuple[int | None, bytes]], threshold: float, shingle: int):
        self.threshold, self.known = threshold, WordHashes()
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.sets: list[tuple[int, frozenset[bytes]]] = []
        sketches: dict[int, list[tuple[int, int]]] = {}
        self.need: list[int] = []
        for key, text in items:
            words = words_of(text)
            if not words:
                continue
            n = min(shingle, len(words))
            own = frozenset(_runs(words, n))
            number = len(self.ids)
            self.ids.append(key)
            self.sizes.append(len(own))
            self.sets.append((n, own))
            # The class holds sizes up to the next power of two; its sketch size serves the largest.
            largest = 1 << (len(own) - 1).bit_length()
            length = 2 * self._lacking(largest) + 1
            sketch = sorted({int(h) for h in self._hashes([words], n)[0]})[:length]
            self.need.append(max(1, len(sketch) - self._lacking(len(own))))
            sketches.setdefault(n, []).extend((h, number) for h in sketch)
        self.probes = {n: Probe(pairs) for n, pairs in sketches.items()}

    def _lacking(self, size: int) -> int:
        """How many of ``size`` shingles a document may lack."""
        return size - int(np.ceil(self.threshold * size - 1e-9))

    def search(self, documents: list[list[bytes]]) -> list[list[tuple[int, int]]]:
        """For each document the items it contains and how many of their shingles it has."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        found: list[dict[int, int]] = [{} for _ in documents]
        for n, probe in self.probes.items():
            hashes = self._hashes(documents, n)
            ends = np.cumsum([len(h) for h in hashes])
            if not len(ends) or not ends[-1]:
                continue
            whole = np.concatenate(hashes)
            place, entry = probe.hits(whole)
            row = np.searchsorted(ends, place, side="right")
            # A shingle counts once, however often a document has it.
            seen = np.unique(np.stack([row, entry]), axis=1)
            pairs = [(int(r), int(i)) for r, e in seen.T for i in probe.items(int(e))]
            hits: dict[tuple[int, int], int] = {}
            for pair in pairs:
                hits[pair] = hits.get(pair, 0) + 1
            sets: dict[int, set[bytes]] = {}
            for (r, i), count in hits.items():
                if count < self.need[i]:
                    continue
                if r not in sets:
                    sets = {r: set(_runs(documents[r], n))}
                own = self.sets[i][1]
                shared = len(own & sets[r])
                if shared >= self.threshold * len(own) - 1e-9:
                    found[r][i] = shared
        return [sorted(f.items()) for f in found]

    def _hashes(self, documents: list[list[bytes]], n: int) -> list[np.ndarray]:
        """Hashes of each document's runs of ``n`` words, from those of its words."""
        out = []
        for words in documents:
            h = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
            count = max(0, len(words) - n + 1)
            run = np.zeros(count, np.uint64)
            for k in range(n):
                run = mix64(run * np.uint64(0x9E3779B97F4A7C15) + h[k : k + count]) if k else h[:count]
            out.append(run)
        return out


class Probe:
    """Sketch hashes to look up, and the items each belongs to."""

    def __init__(self, pairs: list[tuple[int, int]]):
        pairs.sort()
        hashes = np.array([h for h, _ in pairs], np.uint64)
        self.numbers = [i for _, i in pairs]
        self.hashes, first = np.unique(hashes, return_index=True)
        self.bounds = np.append(first, len(pairs))
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[hashes >> np.uint64(64 - FILTER_BITS)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``hashes`` that are in a sketch, and which entry it is."""
        place = np.flatnonzero(self.filter[hashes >> np.uint64(64 - FILTER_BITS)])
        entry = np.minimum(np.searchsorted(self.hashes, hashes[place]), len(self.hashes) - 1)
        same = self.hashes[entry] == hashes[place]
        return place[same], entry[same]

    def items(self, entry: int) -> list[int]:
        return self.numbers[self.bounds[entry] : self.bounds[entry + 1]]


def _runs(words: list[bytes], n: int) -> list[bytes]:
    return [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
