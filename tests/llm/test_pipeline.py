import shutil
import zlib
from collections import Counter

import numpy as np
from test_decontam import expected as matches
from test_simhash import union
from tokenizers import Tokenizer

import corpus_pipeline
from pulsetrail.llm.queries import all_queries, tokenizer_path
from pulsetrail.llm.quality import RULES, base_failed, measure
from pulsetrail.workspace import stage

SF = "/root/testdata/sf0.01"


def runs(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(texts):
    """Pairs with a similarity of 0.8 or more."""
    sets = [runs(t) for t in texts]
    return [
        (i, j) for i in range(len(sets)) for j in range(i)
        if 0.8 * min(len(sets[i]), len(sets[j])) <= len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])
    ]


def distinct(spark, rows, schema="doc_id bigint, text string"):
    df = spark.createDataFrame(rows, schema)
    found = corpus_pipeline.distinct_documents(spark, df, "")
    assert found.columns == df.columns
    return sorted([tuple(r) for r in found.collect()], key=str)


def test_stages_against_a_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def good(r):
        text, raw = r[1] or "", (r[1] or "").encode()
        m = measure(text, raw)
        return not base_failed(m) and not any(rule(text, raw, m) for rule in RULES.values())

    rows = [r for r in rows if good(r)]
    docs = corpus_pipeline.good_documents(spark, docs, SF)
    assert sorted(map(tuple, docs.collect())) == sorted(rows)

    rows.sort()
    group = union(range(len(rows)), alike([r[1] for r in rows]))
    expected = {r for i, r in enumerate(rows) if group[i] == i}
    found = stage(corpus_pipeline.distinct_documents(spark, docs, SF), "test")
    kept = sorted(map(tuple, found.collect()))
    assert expected <= set(kept)  # nothing goes that has no near copy
    assert len(kept) - len(expected) <= 0.03 * (len(rows) - len(expected))
    rows = kept

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hit = {m[0] for m in matches([r[:2] for r in rows], items)}
    rows = [r for r in rows if r[0] not in hit]
    found = corpus_pipeline.clean_documents(spark, found, SF)
    assert hit and sorted(map(tuple, found.collect())) == rows

    mixed = corpus_pipeline.mixed_documents(spark, found, SF)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    counts = Counter(map(tuple, mixed.collect()))
    assert set(counts) <= set(rows) and max(counts.values()) <= 3

    encode = Tokenizer.from_file(tokenizer_path()).encode
    start, expected = 0, []
    for r in sorted(counts.elements()):
        ids = encode(r[1], add_special_tokens=False).ids + [2]
        expected.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == expected


def test_copies_of_any_kind(spark):
    rng = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(5000)])
    rows, number = [], 0
    for n in (8, 60, 400, 3000):
        for _ in range(12):
            base = rng.choice(words, n)
            for change in (0, 0, 1, 2, max(1, n // 100), n // 60):
                own = base.copy()
                own[rng.integers(0, n, change)] = rng.choice(words, change)
                rows.append((number, rng.choice([" ", "  ", "\n"]).join(own)))
                number += 1
    group = union(range(len(rows)), alike([t for _, t in rows]))
    expected = {i for i in range(len(rows)) if group[i] == i}
    found = {r[0] for r in distinct(spark, rows)}
    assert expected <= found  # nothing goes that has no near copy
    assert len(found - expected) <= 0.02 * (len(rows) - len(expected))


def test_odd_rows_of_copies(spark):
    rows = [(4, None, "a"), (3, "", "b"), (9, "One  two", "c"), (8, "one two", "d"), (8, "one two", "d"), (None, "ONE TWO", "e"), (7, "x y z", "f"), (7, "p q", "g"), (7, "x y z", "h")]
    found = distinct(spark, rows, "doc_id bigint, text string, keeper_id string")
    assert [r[:2] for r in found] == [(3, ""), (7, "p q"), (7, "x y z"), (8, "one two")]
    assert distinct(spark, [(None, "a b", "x"), (None, "a b", "x")], "doc_id bigint, text string, fp0 string") == [(None, "a b", "x")]


def test_empty_table(spark, documents):
    folder = documents([])
    shutil.copytree(f"{folder}/documents.parquet", f"{folder}/benchmark.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    benchmark = docs.withColumnRenamed("doc_id", "item_id")
    benchmark.write.mode("ignore").parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.distinct_documents(spark, docs, folder).count() == 0
    assert all_queries()  # the pipeline's operators are all registered on their own too
    assert corpus_pipeline.mixed_documents(spark, docs, folder).count() == 0
    assert corpus_pipeline.token_files(spark, docs, folder).count() == 0


def test_copies_that_only_meet_under_a_text_unlike_both(spark):
    # All texts have the same distinct words and so the same fingerprints; only two and two are alike.
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(100)])
    rows = []
    for i in range(150):
        own = rng.permutation(words)
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(np.roll(own, 3)))]
    assert [r[0] for r in sorted(distinct(spark, rows))] == list(range(0, 300, 2))


def test_copies_with_words_added_in_one_place(spark):
    rng = np.random.default_rng(7)
    words = np.array([f"w{i}" for i in range(50_000)])
    rows = []
    for i in range(200):
        base, more = rng.choice(words, 200), rng.choice(words, 40)
        at = rng.choice([0, 200])
        rows += [(2 * i, " ".join(base)), (2 * i + 1, " ".join([*base[:at], *more, *base[at:]]))]
    # A similarity of 0.83.
    gone = 400 - len(distinct(spark, rows))
    assert gone >= 0.97 * 200
