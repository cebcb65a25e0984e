import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pulsetrail.llm import shared_keys, substrings, suffix_sort
from pulsetrail.llm.queries import all_queries
from pulsetrail.llm.substrings import LENGTH
from pulsetrail.llm.suffix_sort import COVER, MEET, PERIOD, Buffer, repeated, sort_bucket

SF = "/root/testdata/sf0.01"


def expected(rows):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(hash(r[i : i + 200]) for r in raw for i in range(len(r) - 199))
    out = []
    for (key, _), r in zip(rows, raw):
        gone = bytearray(len(r))
        upto = 0
        for i in range(len(r) - 199):
            if seen[hash(r[i : i + 200])] > 1:
                start = max(i, upto)
                gone[start : i + 200] = b"\1" * (i + 200 - start)
                upto = i + 200
        kept = bytes(c for c, g in zip(r, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key, len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, folder):
    return sorted([tuple(r) for r in all_queries()["op2_suffix_array"](spark, folder).collect()], key=str)


def test_cover_meets_for_any_two_places():
    inside = set(COVER.tolist())
    for a in range(PERIOD):
        for b in range(PERIOD):
            assert (a + MEET[a, b]) % PERIOD in inside and (b + MEET[a, b]) % PERIOD in inside


@pytest.mark.parametrize("letters", [b"a", b"ab", b"abcdefgh"])
def test_sort_agrees_with_slices(letters):
    rng = random.Random(7)
    base = bytes(rng.choices(letters, k=700))
    data = base + bytes(rng.choices(letters, k=300)) + base[:450] + b"x" + base[3:400] * 2
    places = np.arange(len(data) - 250)
    order = sort_bucket(Buffer(np.frombuffer(data, np.uint8)), places)
    prefixes = [data[i : i + 200] for i in order]
    assert prefixes == sorted(prefixes)
    counts = Counter(prefixes)
    flags = repeated(np.frombuffer(data, np.uint8), places, 200)
    assert flags.tolist() == [counts[data[i : i + 200]] > 1 for i in places]


def test_small_buckets(monkeypatch):
    monkeypatch.setattr(suffix_sort, "BUCKET", 10)
    test_sort_agrees_with_slices(b"ab")


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = run(spark, SF)
    assert found == expected(rows)
    assert any(0 < r[2] < r[1] for r in found)


def cases():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choices("abcdé \n", k=n))
    passages = [text(n) for n in (60, 130, 150, 190, 199, 200, 201, 230, 400, 1500)]
    rows = []
    for i in range(120):
        parts = [text(rng.choice([0, 3, 50, 300, 900]))]
        for _ in range(rng.choice([0, 1, 3])):
            parts += [rng.choice(passages), text(rng.choice([0, 1, 40, 500]))]
        rows.append((i, "".join(parts)))
    rows += [(200, None), (201, ""), (202, "z" * 199), (203, "y" * 200), (204, "y" * 201), (205, "x" * 5000), (206, "pq" * 400)]
    rows += [(207, "0123456789abcdefghijklmnopqrstuvwxyz~~" * 60), (208, rows[5][1]), (208, rows[5][1]), (None, rows[6][1]), (None, "n" + text(400))]
    rows += [(210, passages[9]), (211, passages[9]), (212, passages[9][:-1]), (213, "ß" * 101)]
    return rows


def test_odd_rows(spark, documents):
    rows = cases()
    assert run(spark, documents(rows)) == expected(rows)


def test_pieces_give_the_same_anchors(monkeypatch):
    rows = pa.array([t for _, t in cases()])
    whole = found_windows(rows)
    monkeypatch.setattr(substrings, "PIECE", 700)
    assert found_windows(rows) == whole


def found_windows(rows):
    out = {}
    for found in substrings.anchors(rows):
        for row, first, count, anchor, key in zip(*[found[c].tolist() for c in ("row", "first", "count", "anchor", "key")]):
            for place in range(first, first + count):
                assert (row, place) not in out and 0 <= anchor - place < substrings.GRAMS
                out[row, place] = (anchor - place, key)
    assert len(out) == sum(max(0, len((t or "").encode()) - 199) for t in rows.to_pylist())
    return out


def test_hot_keys(spark, documents):
    # More texts than HOT share a line that is longer than a stretch; some of them go on alike.
    rng = random.Random(8)
    line = "".join(rng.choices("abcdefghij", k=180))
    ends = ["".join(rng.choices("klmnopqrst", k=400)) for _ in range(50)]
    rows = [(i, f"{i:06d}".translate(str.maketrans("0123456789", "uvwxyzUVWX")) * 9 + line + (ends[i // 100 % 50] if i % 100 < 2 else f"{i:07d}" * 3)) for i in range(substrings.HOT + 500)]
    assert run(spark, documents(rows)) == expected(rows)


def test_shuffled_joins(spark, documents, monkeypatch):
    monkeypatch.setattr(shared_keys, "BROADCAST_BYTES", -1)
    rows = cases()[:40]
    assert run(spark, documents(rows)) == expected(rows)


def test_empty_table(spark, documents):
    assert run(spark, documents([])) == []


def test_equal_stretches_are_sorted_once(monkeypatch):
    rng = np.random.default_rng(7)
    plain, other = (rng.integers(97, 123, 320, np.uint8).tobytes() for _ in range(2))
    # Two equal ones, one that shares a part with these, one that shares nothing.
    contexts = [plain, plain, plain[:250] + other[250:], other]
    rows = [(5, t, t, 10 * t, len(c) - LENGTH + 1, 100, c) for t, c in enumerate(contexts)]
    sorted_bytes = []
    plainly = substrings.repeated
    monkeypatch.setattr(substrings, "repeated", lambda data, places, length: sorted_bytes.append(len(places)) or plainly(data, places, length))
    found = [tuple(r.values()) for b in substrings._sort_block(rows) for r in b.to_pylist()]
    assert sorted(found) == [(0, 0, 0, 320), (1, 1, 10, 330), (2, 2, 20, 270)]
    assert sorted_bytes == [3 * (320 - LENGTH + 1)]
