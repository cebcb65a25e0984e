"""Token ids in binary files, each document compressed on its own with a dictionary all files share.

A store is a folder with ``dictionary`` (a zstandard dictionary trained on serialised id arrays of a
sample) and files of documents in ascending order of their id. A file:

    MAGIC, length of the header (u4), header as JSON (version, width, dictionary: SHA-256)
    one zstandard frame per document: its ids, little-endian, ``width`` bytes each
    the index: arrays of id (i8), whether it has one (u1), offset (i8), bytes (i8), tokens (i8)
    number of documents (u8), offset of the index (u8), MAGIC

The index gives each document's place, so a short one is read without its neighbours. A file is valid
once the manifest, the result of the writing job, names it; what a lost task left is never looked at.

A NULL text is empty: its document holds the end id alone. A NULL id comes first. Repeated rows are
documents of their own. An empty table gives an empty store.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsetrail.llm.common import bound_batches, flat, gathered, is_space, lean, partitions, pieces
from pulsetrail.llm.files import make_folder, resolve
from pulsetrail.workspace import new_path, stage

MAGIC = b"PTTOKEN1"
INDEX = (("id", "<i8"), ("has_id", "u1"), ("offset", "<i8"), ("bytes", "<i8"), ("tokens", "<i8"))
# The dictionary is trained on about so many documents, of each at most so many ids.
SAMPLE_DOCUMENTS = 1000
SAMPLE_IDS = 2048
DICTIONARY_BYTES = 64 << 10
LEVEL = 3
FILE_BYTES = 256 << 20
# Texts encoded at once.
ENCODE_BYTES = 8 << 20
# A task forgets the words it has seen when they and their ids take about so many bytes.
REMEMBERED_BYTES = 96 << 20

# White space as the tokenizers library's patterns see it.
_WS = r"\t-\r \x85\xa0  -     　"
_RUNS = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_TANGLED = re.compile(f"  |[{_WS}] (?:[{_WS}]|$)")


@dataclass(frozen=True)
class TokenStore:
    folder: str
    manifest: DataFrame
    dictionary: bytes


class WordEncoder:
    """Ids of texts by a byte-level BPE tokenizer, encoding every distinct word once.

    Its pattern never joins a character with white space after it, so a text may be cut before white
    space that follows anything else, and the ids of the pieces make up those of the whole. Letters, digits and
    other signs of ASCII are not joined either. What it has seen is forgotten with ``forget``.
    """

    def __init__(self, path: str):
        # A task has one core; threads of the library would only get in each other's way.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = "H" if self.width == 2 else "I"
        self.known: dict[str, bytes] = {}
        self.bytes = 0
        special = {c for t in self.tokenizer.get_added_tokens_decoder().values() for c in t.content}
        # 1 for letters, 2 for digits, 3 for signs but those that begin a word or occur in special tokens.
        signs = [chr(b) for b in range(33, 127)]
        self.kinds = np.zeros(256, np.int8)
        self.kinds[33:127] = [1 if c.isalpha() else 2 if c.isdigit() else 0 if c == "'" or c in special else 3 for c in signs]

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of each text, serialised."""
        column = pa.compute.fill_null(column.cast(pa.large_string()), "")
        found: list[bytes] = [b""] * len(column)
        odd = [row for row in np.flatnonzero(_space_runs(column)).tolist() if _TANGLED.search(column[row].as_py())]
        for row in odd:
            words = _RUNS.findall(column[row].as_py())
            found[row] = b"".join(self._learn(words))
        rows = np.setdiff1d(np.arange(len(column)), odd)
        if len(rows):
            plain = column.take(pa.array(rows)) if odd else column
            for row, ids in zip(rows.tolist(), self._spaced(plain)):
                found[row] = ids
        return found

    def forget(self) -> None:
        self.known, self.bytes = {}, 0

    def _spaced(self, column: pa.Array) -> Iterator[bytes]:
        """Ids of texts that may be cut before every space. Arrow numbers the pieces and lines up their ids."""
        data, offsets = flat(column)
        pieces = self._cut(data, offsets)
        coded = pa.LargeStringArray.from_buffers(
            len(pieces), pa.py_buffer(np.append(pieces, len(data)).tobytes()), pa.py_buffer(data.tobytes())
        ).dictionary_encode()
        lined_up = pa.array(self._learn(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        ids = lined_up.buffers()[2].to_pybytes() if lined_up.buffers()[2] else b""
        ends = np.frombuffer(lined_up.buffers()[1], np.int64)[np.searchsorted(pieces, offsets)].tolist()
        return (ids[start:end] for start, end in zip(ends, ends[1:]))

    def _cut(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces start: texts, spaces, other kinds of ASCII signs, and a single line end and what follows it."""
        kind, start = self.kinds[data], data == 32
        if not len(data):
            return np.zeros(0, np.int64)
        start[1:] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        solid = (data > 32) & (data < 127)
        lone = np.flatnonzero(solid[:-2] & (data[1:-1] == 10) & solid[2:]) + 1
        start[lone] = True
        start[lone + 1] = True
        start[offsets[:-1][offsets[:-1] < len(data)]] = True
        return np.flatnonzero(start)

    def _learn(self, words: list[str]) -> list[bytes]:
        """The ids of words, each different one encoded once."""
        if self.bytes > REMEMBERED_BYTES:
            self.forget()
        known = self.known
        new = list({w for w in words if w not in known})
        made = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        known.update(zip(new, [array(self.kind, x.ids).tobytes() for x in made]))
        # About what an entry takes beside its texts.
        self.bytes += 150 * len(new) + 2 * sum(map(len, new))
        return [known[w] for w in words]


def _space_runs(column: pa.Array) -> np.ndarray:
    """Texts in which a space comes last or before a byte that other white space may begin with."""
    data, offsets = flat(column)
    after = np.append(data[1:], 0)
    odd = (data == 32) & (is_space(after) | (after == 0xC2) | ((after >= 0xE1) & (after <= 0xE3)))
    ends = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    odd[ends] |= data[ends] == 32
    upto = np.concatenate([[0], np.cumsum(odd)])
    return upto[offsets[1:]] > upto[offsets[:-1]]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def train_dictionary(df: DataFrame, tokenizer: str, *, text: str = "text") -> bytes:
    """A dictionary from the ids of about ``SAMPLE_DOCUMENTS`` rows; empty when there is too little."""
    rows = df.count()
    if not rows:
        return b""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        for batch in pieces(batches, "text"):
            found = coder.encode(batch.column("text"))
            yield pa.RecordBatch.from_pydict({"ids": [x[: SAMPLE_IDS * coder.width] for x in found]})

    seen = df.select(F.col(text).alias("text")).sample(min(1.0, SAMPLE_DOCUMENTS / rows), 11)
    ids = [r.ids for r in seen.mapInArrow(lean(encode), "ids binary").limit(2 * SAMPLE_DOCUMENTS).collect() if r.ids]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, ids).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def write_tokens(
    df: DataFrame,
    tokenizer: str,
    *,
    id: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    folder: str | None = None,
) -> TokenStore:
    """Encode whole texts and write them in ascending order of ``id``, a file or more per task."""
    spark = df.sparkSession
    folder = folder or new_path(spark, "tokens")
    make_folder(folder)
    dictionary = train_dictionary(df, tokenizer, text=text)
    system, place = resolve(folder)
    with system.open_output_stream(f"{place}/dictionary", compression=None) as out:
        out.write(dictionary)
    rows = bound_batches(df).select(F.col(id).cast("bigint").alias("id"), F.col(text).alias("text"))
    in_order = rows.repartitionByRange(partitions(spark), "id").sortWithinPartitions("id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part, file, made = encoder(tokenizer), TaskContext.get().partitionId(), None, 0
        end = end_id.to_bytes(coder.width, "little")
        for batch in gathered(batches, "text", ENCODE_BYTES):
            ids = batch.column("id").to_pylist()
            for key, found in zip(ids, coder.encode(batch.column("text"))):
                if file is None:
                    file = TokenFile(folder, part, made, coder.width, dictionary)
                file.add(key, found + end)
            if file and file.place >= FILE_BYTES:
                yield file.close()
                file, made = None, made + 1
        if file:
            yield file.close()
        coder.forget()

    schema = "part int, number int, path string, documents bigint, tokens bigint"
    return TokenStore(folder, stage(in_order.mapInArrow(lean(write), schema), "token-manifest"), dictionary)


class TokenFile:
    """One file of a store being written."""

    def __init__(self, folder: str, part: int, number: int, width: int, dictionary: bytes):
        self.part, self.number, self.width = part, number, width
        self.path = f"{folder}/part-{part:06d}-{number:03d}-{uuid.uuid4().hex}.ids"
        system, place = resolve(self.path)
        self.out = system.open_output_stream(place, compression=None)
        shared = _dictionary(dictionary)
        if shared:
            shared.precompute_compress(level=LEVEL)
        self.compressor = zstandard.ZstdCompressor(dict_data=shared, level=LEVEL)
        self.index: dict[str, list[int]] = {name: [] for name, _ in INDEX}
        header = json.dumps({"version": 1, "width": width, "dictionary": hashlib.sha256(dictionary).hexdigest()}).encode()
        self.place = self.out.write(MAGIC + struct.pack("<I", len(header)) + header)

    def add(self, key: int | None, ids: bytes) -> None:
        frame = self.compressor.compress(ids)
        row = (key or 0, key is not None, self.place, len(frame), len(ids) // self.width)
        for (name, _), value in zip(INDEX, row):
            self.index[name].append(value)
        self.place += self.out.write(frame)

    def close(self) -> pa.RecordBatch:
        """Finish the file; its row of the manifest."""
        for name, kind in INDEX:
            self.out.write(np.array(self.index[name], kind).tobytes())
        self.out.write(struct.pack("<QQ", len(self.index["id"]), self.place) + MAGIC)
        self.out.close()
        row = (self.part, self.number, self.path, len(self.index["id"]), sum(self.index["tokens"]))
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        names = ["part", "number", "path", "documents", "tokens"]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)


class TokenReader:
    """One finished file; holds its index, reads documents one at a time."""

    def __init__(self, path: str, dictionary: bytes):
        system, place = resolve(path)
        self.file = system.open_input_file(place)
        tail = self.file.size() - 16 - len(MAGIC)
        n, at, magic = struct.unpack(f"<QQ{len(MAGIC)}s", self._read(tail, 16 + len(MAGIC)))
        first, length = struct.unpack(f"<{len(MAGIC)}sI", self._read(0, len(MAGIC) + 4))
        if magic != MAGIC or first != MAGIC:
            raise ValueError(f"{path} is no token file")
        header = json.loads(self._read(len(MAGIC) + 4, length))
        if header["dictionary"] != hashlib.sha256(dictionary).hexdigest():
            raise ValueError(f"{path} was written with another dictionary")
        self.kind, self.index = f"<u{header['width']}", {}
        for name, kind in INDEX:
            size = n * np.dtype(kind).itemsize
            self.index[name] = np.frombuffer(self._read(at, size), kind)
            at += size
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))

    def __len__(self) -> int:
        return len(self.index["id"])

    def ids(self, row: int) -> np.ndarray:
        """The ids of the document in this row of the index."""
        frame = self._read(int(self.index["offset"][row]), int(self.index["bytes"][row]))
        return np.frombuffer(self.decompressor.decompress(frame), self.kind)

    def find(self, key: int) -> list[int]:
        """Rows of the index that hold this document."""
        return np.flatnonzero((self.index["id"] == key) & (self.index["has_id"] == 1)).tolist()

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)


def read_tokens(spark: SparkSession, store: TokenStore, *, with_ids: bool = True) -> DataFrame:
    """The documents of a store: doc_id, start, n_tokens, ids_crc32 and, unless left out, ids.

    ``start`` is the number of ids in all documents before it. Only the manifest, a row per file, is
    added up in one task.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = store.manifest.select("path", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    dictionary = store.dictionary
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, base in zip(*[batch.column(c).to_pylist() for c in ("path", "base")]):
                reader = TokenReader(path, dictionary)
                tokens = reader.index["tokens"]
                starts = base + np.cumsum(tokens) - tokens
                step = 4096
                for row in range(0, len(reader), step):
                    rows = range(row, min(row + step, len(reader)))
                    ids = [reader.ids(r).astype("<u4") for r in rows]
                    cut = slice(rows.start, rows.stop)
                    out = [
                        pa.array(reader.index["id"][cut], mask=reader.index["has_id"][cut] == 0),
                        pa.array(starts[cut]),
                        pa.array(np.array([len(x) for x in ids], np.int64)),
                        pa.array(np.array([zlib.crc32(x.tobytes()) for x in ids], np.int64)),
                    ]
                    if with_ids:
                        out.append(pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64())))
                    yield pa.RecordBatch.from_arrays(out, names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return files.repartition(partitions(spark), "path").mapInArrow(lean(read), schema)


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None
