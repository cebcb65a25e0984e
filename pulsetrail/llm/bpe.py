"""Texts to ids of a BPE vocabulary with word ends, and back, by proposing tokens and checking them.

Merging a word pair by pair is slow. Here the longest tokens that fit are proposed from left to right, and a
sequence is right exactly if every two neighbours are: the first merge that crossed a border between tokens would
also cross it with only these two tokens in view. Whether two neighbours hold is looked up for all pairs of a
batch at once, by undoing the merges on both sides of the border, the later one first, and asking each time
whether the two ends would have merged. Only words with a pair that fails are merged exactly. Words that are a
token as a whole need none of this.

Proposals come from tokens that merging itself gives back, and merges have to be listed after those that made
their parts, one for each token, which is checked when the vocabulary is read. White space must carry no ids
of its own. Texts are cut at ASCII white space, where neither normaliser nor pattern looks across, and between ASCII
letters, digits and signs if the tokenizer's pattern ends words there. Each different piece is worked on once per
batch; what is remembered is bounded in bytes and gone with the task.

A NULL or empty text has no ids. Special tokens that stand in a text are single ids, as the library has it. Ids
are one binary value per row, little-endian in 4 bytes each, and decode to the tokens' names with spaces
between them, as a tokenizer without a decoder gives; ids without a token are left out, NULL ids decode to ''.
Repeated rows and any other columns stay as they are, an empty table stays empty. Texts are taken whole; a task
holds one batch or one text.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.llm.common import flat, gathered, keep_row, pieces

# Bytes of text encoded at once, and of pieces of text remembered by a task.
ENCODE_BYTES = 8 << 20
REMEMBERED_BYTES = 48 << 20
_NEVER = 1 << 40
# Words of up to so many symbols are merged side by side.
TOGETHER = 64
# Symbols that end a word are moved out of the way of those that do not.
_LAST = 0x10000
_LETTER, _DIGIT, _SIGN = 1, 2, 3


def encode(df: DataFrame, path: str, *, text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """_row and ids of each row of ``df`` by the tokenizer in the file ``path``."""
    rows = keep_row(df, F.col(f"`{text}`").cast("string").alias("text"), carry=carry)
    schema = rows.select("_row", F.lit(b"").alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Encoder(path)
        for batch in gathered(batches, "text", ENCODE_BYTES):
            ids = pa.array(coder.encode(batch.column("text")), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("_row"), ids], ["_row", "ids"])

    return rows.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, *, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids as ``name``."""
    schema = df.withColumn(name, F.lit("")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = token_names(path)
        for batch in pieces(batches, ids):
            out = dict(zip(batch.schema.names, batch.columns))
            out[name] = pa.array(_joined(batch.column(ids), names), pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([out[c] for c in schema.names], schema.names)

    return df.mapInArrow(run, schema)


class Merges:
    """A BPE vocabulary as arrays: what each token was merged from, and when."""

    def __init__(self, model: dict):
        kept = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(k) for k in kept):
            raise ValueError("only plain BPE is supported")
        vocabulary, end = model["vocab"], model.get("end_of_word_suffix") or ""
        rules = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.width = max(vocabulary.values()) + 1
        self.left, self.right, self.made = (
            np.array([vocabulary[x] for x in names], np.int64)
            for names in ([a for a, _ in rules], [b for _, b in rules], [a + b for a, b in rules])
        )
        # When a token was merged; -1 for single symbols.
        self.born = np.full(self.width, -1, np.int64)
        self.born[self.made] = np.arange(len(rules))
        late = np.maximum(self.born[self.left], self.born[self.right]) >= np.arange(len(rules))
        if len(np.unique(self.made)) < len(rules) or late.any():
            raise ValueError("each token needs one merge, listed after those of its parts")
        keys = self.left * self.width + self.right
        by_key = np.argsort(keys)
        self.keys, self.ranks = keys[by_key], by_key
        self.rank: dict[int, int] = {}
        spelled: list[str | None] = [None] * self.width
        for symbol, number in vocabulary.items():
            if self.born[number] < 0 and end and len(symbol) == 1 + len(end) and symbol.endswith(end):
                spelled[number] = chr(_LAST + ord(symbol[0]))
            elif self.born[number] < 0 and len(symbol) == 1:
                spelled[number] = symbol
        self.symbol = {s: i for i, s in enumerate(spelled) if s}
        self.last = _LAST if end else 0
        holds = ~self._crossed(self.left, self.right, np.arange(len(rules)))
        stable = np.ones(self.width, bool)
        for rank, (a, b, t) in enumerate(zip(self.left.tolist(), self.right.tolist(), self.made.tolist())):
            stable[t] = holds[rank] and stable[a] and stable[b]
            spelled[t] = spelled[a] + spelled[b]
        #: Tokens that merging gives back as they are, by their symbols.
        self.token = {s: i for i, s in enumerate(spelled) if s and stable[i]}
        self._grow()

    def _grow(self) -> None:
        """The tokens as a tree of symbols: edges by node and symbol, and the token that ends at a node."""
        node_of, edges = {"": 0}, {}
        for spelled in self.token:
            for i, s in enumerate(spelled):
                below = node_of.setdefault(spelled[: i + 1], len(node_of))
                edges[node_of[spelled[:i]] * self.width + self.symbol[s]] = below
        self.edges = np.array(sorted(edges), np.int64)
        self.below = np.array([edges[e] for e in self.edges.tolist()], np.int64)
        self.ends = np.full(len(node_of), -1, np.int64)
        for spelled, number in self.token.items():
            self.ends[node_of[spelled]] = number

    def symbols(self, word: str) -> str:
        return word[:-1] + chr(self.last + ord(word[-1]))

    def propose(self, flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest tokens of each word from left to right: word and token, in order of both.

        ``flat`` holds the symbols of all words. All words go ahead together, a token at a time.
        """
        word, at = np.arange(len(starts)), starts.copy()
        words, tokens = [], []
        while len(word):
            token, size = flat[at].copy(), np.ones(len(at), np.int64)
            row, node, depth = np.arange(len(at)), np.zeros(len(at), np.int64), 0
            while len(row):
                keys = node * self.width + flat[at[row] + depth]
                edge = np.minimum(np.searchsorted(self.edges, keys), len(self.edges) - 1)
                hit = self.edges[edge] == keys
                row, node, depth = row[hit], self.below[edge[hit]], depth + 1
                found = self.ends[node] >= 0
                token[row[found]], size[row[found]] = self.ends[node[found]], depth
                more = at[row] + depth < ends[word[row]]
                row, node = row[more], node[more]
            words.append(word)
            tokens.append(token)
            at = at + size
            left = at < ends[word]
            word, at = word[left], at[left]
        words, tokens = np.concatenate(words), np.concatenate(tokens)
        in_order = np.argsort(words, kind="stable")
        return words[in_order], tokens[in_order]

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the symbols of two tokens gives back the two, for each pair."""
        keys, which = np.unique(left * self.width + right, return_inverse=True)
        return ~self._crossed(keys // self.width, keys % self.width, np.full(len(keys), _NEVER))[which]

    def merge_all(self, words: list[np.ndarray]) -> list[list[int]]:
        """The tokens of words by exact merging, short ones all together."""
        found = [self.merge(w.tolist()) if len(w) > TOGETHER else [] for w in words]
        rows = [i for i, w in enumerate(words) if len(w) <= TOGETHER]
        sizes = [len(words[i]) for i in rows]
        ids = np.concatenate([words[i] for i in rows]) if rows else np.zeros(0, np.int64)
        of = np.repeat(np.array(rows, np.int64), sizes)
        while len(ids):
            rank = np.full(len(ids), _NEVER)
            inner = np.flatnonzero(of[1:] == of[:-1])
            rank[inner] = self._rank(ids[inner], ids[inner + 1])
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(ids))))
            # The first of each word's best pairs is merged; words without any are done.
            best = np.flatnonzero((rank == lowest) & (rank < _NEVER))
            done = np.flatnonzero(lowest == _NEVER)
            for row, token in zip(of[done].tolist(), ids[done].tolist()):
                found[row].append(token)
            best = best[np.append(True, of[best][1:] != of[best][:-1])] if len(best) else best
            ids[best] = self.made[rank[best]]
            stay = lowest < _NEVER
            stay[best + 1] = False
            ids, of = ids[stay], of[stay]
        return found

    def merge(self, ids: list[int]) -> list[int]:
        """The tokens of one word of any length: the first listed rule first, from left to right."""
        if not self.rank:
            self.rank = dict(zip((self.left * self.width + self.right).tolist(), range(len(self.left))))
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank, width = self.rank, self.width

        def pair(at: int) -> tuple[int, int, int] | None:
            if at < 0 or after[at] >= len(ids):
                return None
            key = ids[at] * width + ids[after[at]]
            found = rank.get(key)
            return None if found is None else (found, at, key)

        heap = [p for p in map(pair, range(len(ids))) if p]
        heapify(heap)
        while heap:
            found, at, key = heappop(heap)
            if ids[at] < 0 or pair(at) != (found, at, key):
                continue
            gone = after[at]
            ids[at], ids[gone], after[at] = int(self.made[found]), -1, after[gone]
            if after[at] < len(ids):
                before[after[at]] = at
            for new in (pair(before[at]), pair(at)):
                if new:
                    heappush(heap, new)
        return [i for i in ids if i >= 0]

    def _crossed(self, left: np.ndarray, right: np.ndarray, until: np.ndarray) -> np.ndarray:
        """Pairs with a merge across their border before ``until``."""
        crossed = np.zeros(len(left), bool)
        which = np.arange(len(left))
        a, b = left.copy(), right.copy()
        # When each end is merged into the next larger part of its side.
        a_ends, b_ends = (np.full(len(left), _NEVER) for _ in range(2))
        while len(which):
            rank = self._rank(a, b)
            # Of two equal merges the left one comes first.
            now = (rank < until[which]) & (rank < a_ends) & (rank <= b_ends)
            crossed[which[now]] = True
            a_born, b_born = self.born[a], self.born[b]
            go = ~now & ((a_born >= 0) | (b_born >= 0))
            back = a_born >= b_born
            a_ends, b_ends = np.where(back, a_born, a_ends), np.where(back, b_ends, b_born)
            a, b = np.where(back, self._part(self.right, a_born, a), a), np.where(back, b, self._part(self.left, b_born, b))
            which, a, b, a_ends, b_ends = which[go], a[go], b[go], a_ends[go], b_ends[go]
        return crossed

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(left), _NEVER)
        keys = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NEVER)

    @staticmethod
    def _part(of: np.ndarray, born: np.ndarray, token: np.ndarray) -> np.ndarray:
        return np.where(born >= 0, of[np.maximum(born, 0)], token) if len(of) else token


@lru_cache(maxsize=1)
def _read(path: str) -> tuple[dict, Merges]:
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    merges = Merges(rules.pop("model"))
    return rules, merges


class Encoder:
    """Ids of texts; remembers the pieces it has seen."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        rules, self.merges = _read(path)
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        if [w for w, _ in self.split(" a  b ")] != ["a", "b"]:
            raise ValueError("white space must carry no ids")
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in rules["added_tokens"]):
            raise ValueError("added tokens must stand for themselves")
        self.special = {t["content"]: t["id"] for t in rules["added_tokens"]}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.special else None
        self.kinds = self._kinds()
        self.seen: dict[str, bytes] = {}
        self.bytes = 0

    def encode(self, column: pa.Array) -> list[bytes]:
        """The ids of each text, little-endian in 4 bytes."""
        split = pa.compute.ascii_split_whitespace(self._spaced(column))
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_pylist()
        ids = pa.array(self._learn(names), pa.large_binary())
        lined_up = ids.take(coded.indices)
        data = lined_up.buffers()[2].to_pybytes() if lined_up.buffers()[2] else b""
        ends = np.frombuffer(lined_up.buffers()[1], np.int64)[split.offsets.to_numpy()].tolist()
        return [data[start:end] for start, end in zip(ends, ends[1:])]

    def _spaced(self, column: pa.Array) -> pa.Array:
        """The texts with spaces put in where words end between ASCII characters, so that fewer pieces differ."""
        data, offsets = flat(column)
        kind = self.kinds[data]
        ends = (kind[1:] > 0) & (kind[:-1] > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        places = np.flatnonzero(ends) + 1
        spaced = np.insert(data, places, 32)
        bounds = offsets + np.searchsorted(places, offsets, side="left")
        buffers = pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(spaced.tobytes())
        return pa.LargeStringArray.from_buffers(len(column), *buffers)

    def _learn(self, names: list[str]) -> list[bytes]:
        """The ids of pieces without white space."""
        if self.bytes > REMEMBERED_BYTES:
            self.seen, self.bytes = {}, 0
        seen = self.seen
        new = [n for n in names if n not in seen]
        plain = [n for n in new if n.isascii() and n.isalpha()] if self.kinds.any() else []
        small = [n.lower() for n in plain]
        others = [n for n in new if not (n.isascii() and n.isalpha())] if plain else new
        words = [self._words(n) for n in others]
        of_word = self._ids({*small, *(w for x in words for w in x if isinstance(w, str))})
        seen.update(zip(plain, map(of_word.__getitem__, small)))
        for name, parts in zip(others, words):
            seen[name] = b"".join([of_word[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in parts])
        found = [seen[n] for n in names]
        # About what an entry takes beside its texts.
        self.bytes += 150 * len(new) + sum(map(len, new)) + sum(len(seen[n]) for n in others)
        return found

    def _words(self, piece: str) -> list[str | int]:
        """The words of a piece, and ids of special tokens between them."""
        parts = self.cut.split(piece) if self.cut else [piece]
        found: list[str | int] = []
        for part in parts:
            if part in self.special:
                found.append(self.special[part])
            elif part:
                found += [w for w, _ in self.split(self.normalize(part))]
        return found

    def _ids(self, words: Iterable[str]) -> dict[str, bytes]:
        """The ids of words: whole tokens, then proposals that hold, then the rest by merging."""
        merges, found, names, spelled = self.merges, {}, [], []
        for word in words:
            symbols = merges.symbols(word)
            whole = merges.token.get(symbols)
            if whole is None:
                names.append(word)
                spelled.append(symbols)
            else:
                found[word] = whole.to_bytes(4, "little")
        if names:
            codes = np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4")
            kinds, which = np.unique(codes, return_inverse=True)
            flat = np.array([merges.symbol[chr(k)] for k in kinds.tolist()], np.int64)[which]
            ends = np.cumsum([len(x) for x in spelled])
            starts = np.append(0, ends[:-1])
            of, ids = merges.propose(flat, starts, ends)
            pair = np.flatnonzero(of[1:] == of[:-1])
            failed = np.unique(of[pair[~merges.compatible(ids[pair], ids[pair + 1])]])
            merged = merges.merge_all([flat[starts[r] : ends[r]] for r in failed.tolist()])
            data, bounds = ids.astype("<u4").tobytes(), (4 * np.searchsorted(of, np.arange(len(names) + 1))).tolist()
            found.update((n, data[a:b]) for n, a, b in zip(names, bounds, bounds[1:]))
            found.update((names[r], array("I", m).tobytes()) for r, m in zip(failed.tolist(), merged))
        return found

    def _kinds(self) -> np.ndarray:
        """For each byte: letter, digit or sign of ASCII if words end between these kinds and between digits, else 0.

        That is so for patterns that take letters together, digits one by one and other signs together. The
        apostrophe, which may begin a word, and all that occurs in special tokens are left out.
        """
        kinds = np.zeros(256, np.int8)
        sample = "aZ3,x12..q[7-A"
        found = [w for w, _ in self.split(self.normalize(sample))]
        if found != ["az", "3", ",", "x", "1", "2", "..", "q", "[", "7", "-", "a"]:
            return kinds
        special = set("".join(self.special))
        for byte in range(33, 127):
            sign = chr(byte)
            if sign.isalpha():
                kinds[byte] = _LETTER
            elif sign.isdigit():
                kinds[byte] = _DIGIT
            elif sign != "'" and sign not in special:
                kinds[byte] = _SIGN
        return kinds


def token_names(path: str) -> pa.Array:
    """The name of each token and a space, by id, and an empty one for all other ids."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    if rules.get("decoder"):
        raise ValueError("tokenizers with a decoder are not supported")
    ids = rules["model"]["vocab"] | {t["content"]: t["id"] for t in rules["added_tokens"]}
    names = [""] * (max(ids.values(), default=-1) + 2)
    for name, number in ids.items():
        names[number] = name + " "
    return pa.array(names, pa.large_string())


def _joined(column: pa.Array, names: pa.Array) -> list[bytes]:
    column = pa.compute.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    ids = np.frombuffer(data[int(offsets[0]) : int(offsets[-1])] if data else b"", "<u4")
    lined_up = names.take(pa.array(np.minimum(ids, len(names) - 1).astype(np.int64)))
    text = lined_up.buffers()[2].to_pybytes() if lined_up.buffers()[2] else b""
    places = np.frombuffer(lined_up.buffers()[1], np.int64) if len(ids) else np.zeros(1, np.int64)
    ends = places[(offsets - offsets[0]) // 4].tolist()
    # Each name has a space behind it, the last one does not keep it.
    return [text[start : max(start, end - 1)] for start, end in zip(ends, ends[1:])]
