"""Near copies by SimHash.

A fingerprint has a bit set where more than half of a text's shingles have it in their 64-bit hash.
``near_groups`` links fingerprints that differ in few bits, by ``gray_index``, and follows the links.
``near_copies`` goes on to texts: it looks candidates up under several fingerprints of single words,
which change little when a few words do, and checks each by the words themselves.

A NULL or empty text has fingerprint zero, linked like any other. Equal texts are one entry of the index,
however many there are. Repeated rows come back as often as they are given; a NULL id never is the
smallest of its group unless all are NULL. Texts are taken whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import LOWER, bound_batches, keep_row, lean, mix64, partitions, pieces, texts
from pulsetrail.llm.components import components
from pulsetrail.llm.gray_index import gray_links
from pulsetrail.llm.shared_keys import sized
from pulsetrail.workspace import stage

SEED = 42
BITS = 4
# For candidates by distinct single words. Of the pairs of given documents with a similarity of 0.8 to 0.95
# each seed finds nine in ten within six bits; of pairs taken at random one in a thousand differs in 17
# bits or fewer. A tenth of a text added in one place moves a fingerprint more than words changed here and
# there; ``band_keys`` find what they miss.
COPY_BITS = 6
SEEDS = (0x1234567, 0x89ABCDE, 0xF012345, 0x6789ABC)
# Smallest hashes of a text's runs of words, in bands: a pair with a similarity of 0.8 has one of the bands in
# common with a chance of 0.996, wherever its words differ, and one of 0.5 with a chance of 0.36.
BANDS = 14
ROWS = 5
# Of a text's shingle hashes so many are taken under all functions at once.
COLUMNS = 1 << 12
# Texts of a group are compared in pairs of blocks of about so many, with so many bytes of word runs.
BLOCK_TEXTS = 1024
BLOCK_BYTES = 1 << 24
# Of a text's shingle hashes so many are unpacked to bits at once.
UNPACK = 1 << 16


def near_groups(
    df: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 4, bits: int = BITS
) -> DataFrame:
    """Every row's doc_id, fingerprint (16 hex digits) and component_id, the smallest id reachable by
    links between fingerprints of at most ``bits`` differing bits."""
    rows = stage(fingerprints(df, id=id, text=text, shingle=shingle), "simhash")
    distinct = rows.groupBy("fp").agg(F.min("id").alias("low"))
    links = gray_links(distinct.select(F.col("fp").alias("id"), "fp"), bits)
    roots = components(links, "simhash")
    # Fingerprints without links are their own root.
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    named = stage(named, "simhash-roots")
    lows = named.groupBy("root").agg(F.min("low").alias("component_id"))
    groups = named.join(lows, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return rows.join(groups, "fp").select(F.col("id").alias("doc_id"), hexed, "component_id")


def fingerprints(df: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 4, seed: int = SEED) -> DataFrame:
    """Rows (id, fp) with the SimHash of each text's word shingles, repeats included."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [simhash(shingle_hashes(words_of(t), shingle, seed)) for t in texts(batch.column("text"))]
            fps = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fps)], ["id", "fp"])

    rows = bound_batches(df).select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(lean(hashed), "id bigint, fp bigint")


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.translate(LOWER).split()


def shingle_hashes(words: Sequence[bytes], n: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of each run of ``n`` words, joined by spaces; of all words if there are fewer."""
    if len(words) <= n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed)] if words else [], np.uint64)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-n] + 1]).tolist()
    shingles = [whole[s:e] for s, e in zip(starts, ends[n - 1 :].tolist())]
    return np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(shingles))


def simhash(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), UNPACK):
        part = hashes[at : at + UNPACK].astype("<u8", copy=False)
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def band_keys(hashes: np.ndarray) -> list[int]:
    """A key for each band of ``ROWS`` smallest hashes; none without hashes."""
    if not len(hashes):
        return []
    by = mix64(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64))[:, None] | np.uint64(1)
    own = by >> np.uint64(7)
    parts = [((hashes[at : at + COLUMNS] ^ own) * by).min(axis=1) for at in range(0, len(hashes), COLUMNS)]
    least = np.min(parts, axis=0).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in range(ROWS):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + least[:, row])
    return key.view(np.int64).tolist()


def near_copies(
    df: DataFrame,
    *,
    id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    shingle: int = 5,
    bits: int = COPY_BITS,
    seeds: Sequence[int] = SEEDS,
) -> DataFrame:
    """Near copies of texts that share at least ``threshold`` of their distinct ``shingle``-word runs
    (Jaccard), followed through any number of them: id, text_key and the ``keeper_id``, ``keeper_key`` of
    the group's smallest id.

    Texts with the same words are one entry. A candidate is a pair whose SimHash over distinct single
    words differs in at most ``bits`` bits for one of the ``seeds``; a word or two in a hundred changed
    moves these little. So is a pair with one of its ``band_keys`` in common, as where words were added in
    one place. Every candidate is checked by its runs of words, or its two texts are connected by
    others that were. First each key links its members by as few candidates as connect them, and each index what
    these leave apart; where some of these are refuted, all candidates between texts that are still apart are checked too, in tasks that get
    two blocks of a group's texts and return at most a link per text. So a group of copies is never expanded into
    its pairs, and no candidate is left out.
    """
    rows = bound_batches(df).select(F.col(id).cast("bigint").alias("id"), _text_key(text).alias("text_key"), F.col(text).alias("text"))
    names = [f"fp{s}" for s in range(len(seeds))]

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            keys, fps, bands = [], [], []
            for t in texts(batch.column("text")):
                words = words_of(t)
                keys.append(xxhash.xxh64_intdigest(b" ".join(words)))
                own = np.array([xxhash.xxh64_intdigest(w) for w in set(words)], np.uint64)
                fps.append([simhash(mix64(own + np.uint64(seed))) for seed in seeds])
                bands.append(band_keys(shingle_hashes(words, shingle)))
            signed = lambda v: pa.array(np.array(v, np.uint64).view(np.int64))
            arrays = [batch.column("id"), batch.column("text_key"), signed(keys), *map(signed, zip(*fps)), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "text_key", "words_key", *names, "bands"])

    schema = "id bigint, text_key bigint, words_key bigint" + "".join(f", {name} bigint" for name in names) + ", bands array<bigint>"
    known = stage(rows.mapInArrow(lean(describe), schema), "copies")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("first")
    entries = stage(known.groupBy("words_key").agg(first, *[F.min(n).alias(n) for n in [*names, "bands"]]), "copies-entries")

    # What bands connect needs no links of the indexes among itself.
    pairs = stage(_band_links(entries.select("words_key", F.explode("bands").alias("key"))), "copies-bands")
    banded = components(pairs, "copies-banded").select(F.col("node").alias("words_key"), "root")
    placed = entries.join(banded, "words_key", "left").select("words_key", *names, F.coalesce("root", "words_key").alias("root"))
    placed = stage(placed, "copies-placed")
    for name in names:
        pairs = pairs.unionByName(gray_links(placed.select(F.col("words_key").alias("id"), F.col(name).alias("fp"), "root"), bits, every=False))
    pairs = stage(pairs.distinct(), "copies-pairs")
    runs = _word_runs(rows, entries, pairs, shingle)
    links = stage(_alike(pairs, runs, threshold), "copies-links")
    open_ = stage(_still_apart(entries, pairs, links), "copies-open")
    if not open_.isEmpty():
        links = stage(links.unionByName(_alike_in_blocks(open_, runs, names, bits, threshold)), "copies-links")
    roots = components(links, "copies")
    named = entries.join(roots, entries["words_key"] == roots["node"], "left")
    named = stage(named.select("words_key", "first", F.coalesce("root", "words_key").alias("root")), "copies-roots")
    keepers = named.groupBy("root").agg(F.min("first").alias("keeper"))
    groups = named.join(keepers, "root").select("words_key", "keeper")
    found = known.join(groups, "words_key")
    return found.select("id", "text_key", F.col("keeper.id").alias("keeper_id"), F.col("keeper.text_key").alias("keeper_key"))


def without_near_copies(df: DataFrame, *, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``df`` without those that are near copies of another; of each group that of the
    smallest id stays, of rows that agree in id and text one."""
    copies = stage(near_copies(df, id=id, text=text, **settings), "copies-found")
    keeper = F.col("id").eqNullSafe(F.col("keeper_id")) & (F.col("text_key") == F.col("keeper_key"))
    gone = stage(copies.filter(~keeper).select("id", "text_key").distinct(), "copies-gone")
    again = copies.filter(keeper).groupBy("id", "text_key").count().filter("count > 1")
    again = stage(again.select("id", "text_key"), "copies-again")
    rows = keep_row(df, F.col(id).cast("bigint").alias("id"), _text_key(text).alias("text_key"))

    gone, again = sized(gone, 32), sized(again, 32)

    def same(listed: DataFrame):
        return rows["id"].eqNullSafe(listed["id"]) & (rows["text_key"] == listed["text_key"])

    kept = rows.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return kept.select("_row.*")
    once = kept.join(again, same(again), "left_anti").select("_row")
    more = kept.join(again, same(again), "left_semi").dropDuplicates(["id", "text_key"]).select("_row")
    return once.unionByName(more).select("_row.*")


def _text_key(text: str):
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _band_links(keyed: DataFrame) -> DataFrame:
    """Links (a, b) of each key's members to the smallest of them."""
    low = keyed.groupBy("key").agg(F.min("words_key").alias("b"), F.max("words_key").alias("high")).filter("b < high")
    return keyed.join(low, "key").select(F.col("words_key").alias("a"), "b").filter("a <> b").distinct()


def _still_apart(entries: DataFrame, pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The ``entries``, with the ``root`` that ``links`` give each, of groups that ``pairs`` connect and ``links`` do not."""
    loose = components(pairs, "copies-loose").select(F.col("node").alias("words_key"), F.col("root").alias("group"))
    sure = components(links, "copies-sure").select(F.col("node").alias("words_key"), "root")
    both = stage(loose.join(sure, "words_key", "left").withColumn("root", F.coalesce("root", "words_key")), "copies-groups")
    open_ = both.groupBy("group").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return entries.join(both.join(open_, "group", "left_semi").select("words_key", "root", "group"), "words_key")


def _word_runs(rows: DataFrame, entries: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """The sorted hashes of the word runs of every entry in ``pairs``: words_key, runs."""
    wanted = pairs.select(F.col("a").alias("words_key")).unionByName(pairs.select(F.col("b").alias("words_key"))).distinct()
    first = entries.join(wanted, "words_key", "left_semi").select("words_key", "first.id", "first.text_key")
    first = sized(stage(first, "copies-wanted"), 40)
    same = rows["id"].eqNullSafe(first["id"]) & (rows["text_key"] == first["text_key"])
    # Of rows that agree in id and text any does.
    chosen = rows.join(first, same).select("words_key", "text")

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text"):
            found = [np.unique(shingle_hashes(words_of(t), shingle)).tobytes() for t in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("words_key"), pa.array(found, pa.binary())], ["words_key", "runs"])

    return stage(chosen.mapInArrow(lean(runs), "words_key bigint, runs binary").dropDuplicates(["words_key"]), "copies-runs")


def _alike_in_blocks(members: DataFrame, runs: DataFrame, names: Sequence[str], bits: int, threshold: float) -> DataFrame:
    """Links between ``members`` with different roots that are candidates and alike enough, as few as connect them.

    A group is cut into blocks by number and bytes of its texts, and a text goes to the tasks of its block with
    each block. There candidates are found and checked; a pair is never a row.
    """
    known = stage(members.drop("first").join(runs, "words_key"), "copies-apart")
    count = F.greatest(F.count(F.lit(1)) / BLOCK_TEXTS, F.sum(F.octet_length("runs")) / BLOCK_BYTES)
    sizes = known.groupBy("group").agg(F.ceil(count).alias("blocks"))
    placed = known.join(sizes, "group").withColumn("own", F.pmod(F.xxhash64("words_key"), F.col("blocks")))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"x": F.least("own", "other"), "y": F.greatest("own", "other")}).drop("other", "blocks")
    key = ["group", "x", "y"]
    in_order = dealt.repartition(partitions(members.sparkSession), *key).sortWithinPartitions(*key, "words_key")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None
        for batch in batches:
            for *tile, own, node, root, bands, runs_, fps in zip(
                *[batch.column(c).to_pylist() for c in (*key, "own", "words_key", "root", "bands", "runs")],
                zip(*[batch.column(c).to_pylist() for c in names]),
            ):
                if tile != at:
                    yield from found(held, at)
                    held, at = [], tile
                held.append((own, node, root, bands, np.frombuffer(runs_, np.uint64), fps))
        yield from found(held, at)

    def found(held: list[tuple], tile: list | None) -> Iterator[pa.RecordBatch]:
        if len(held) > 1:
            own, nodes, root, bands, runs_, fps = zip(*held)
            nodes = np.array(nodes)
            side = None if tile[1] == tile[2] else np.array(own) == tile[1]
            a, b = tile_links(np.array(root), list(bands), list(runs_), np.array(fps).view(np.uint64), side, bits, threshold)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(nodes[a], nodes[b])), pa.array(np.minimum(nodes[a], nodes[b]))], ["a", "b"])

    return in_order.mapInArrow(lean(check), "a bigint, b bigint")


def tile_links(
    root: np.ndarray, bands: list[list[int]], runs: list[np.ndarray], fps: np.ndarray, side: np.ndarray | None, bits: int, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Places of texts, at most a link each, that connect what is alike: of different roots, with one of ``fps`` within
    ``bits`` or one of ``bands`` in common, and ``threshold`` of their ``runs``. With a ``side`` only pairs of both sides."""
    label = np.unique(root, return_inverse=True)[1]
    # Texts without runs have no bands; a number of their own makes these differ.
    keys = np.array([b or [i] * BANDS for i, b in enumerate(bands)], np.int64)
    none = np.array([not b for b in bands])
    size = np.array([len(r) for r in runs])
    code = np.unique(np.concatenate(runs), return_inverse=True)[1]
    starts = np.concatenate([[0], np.cumsum(size)])
    # For each run of words the texts that have it.
    having = np.repeat(np.arange(len(runs)), size)[np.argsort(code, kind="stable")]
    upto = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=1))])
    links: list[tuple[int, int]] = []
    for i in range(len(runs)):
        others = label != label[i]
        others[: i + 1] = False
        if side is not None:
            others &= side != side[i]
        j = np.flatnonzero(others)
        near = (np.bitwise_count(fps[j] ^ fps[i]) <= bits).any(axis=1)
        near |= (keys[j] == keys[i]).any(axis=1) & ~none[j] & ~none[i]
        j = j[near]
        if not len(j):
            continue
        own = code[starts[i] : starts[i + 1]]
        many = upto[own + 1] - upto[own]
        place = np.repeat(upto[own] - np.cumsum(many) + many, many) + np.arange(many.sum())
        shared = np.bincount(having[place], minlength=len(runs))[j]
        least, most = np.minimum(size[j], size[i]), np.maximum(size[j], size[i])
        alike = (least >= threshold * most - 1e-9) & (shared >= threshold * (size[j] + size[i] - shared) - 1e-9)
        for k in j[alike].tolist():
            if label[k] != label[i]:
                links.append((i, k))
                label[label == label[k]] = label[i]
    a, b = np.array(links, np.int64).reshape(-1, 2).T
    return a, b


def _similar(x: np.ndarray, y: np.ndarray, threshold: float) -> bool:
    if min(len(x), len(y)) < threshold * max(len(x), len(y)) - 1e-9:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return shared >= threshold * (len(x) + len(y) - shared) - 1e-9


def _alike(pairs: DataFrame, runs: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` whose sets of word runs are alike enough."""
    sides = [runs.select(F.col("words_key").alias(c), F.col("runs").alias(f"runs_{c}")) for c in ("a", "b")]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column("runs_a").to_pylist(), batch.column("runs_b").to_pylist()):
                near.append(_similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), threshold))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "runs_a", "runs_b").mapInArrow(lean(check), "a bigint, b bigint")
