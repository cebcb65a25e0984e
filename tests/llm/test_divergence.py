import re
from collections import Counter, defaultdict

import pytest

from pulsetrail.llm import divergence
from pulsetrail.llm.divergence import source_divergence
from pulsetrail.llm.queries import all_queries

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute(rows, at_least=10):
    """Rows of (text, lang, source); everything counted in plain Python."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(SMALL))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang in docs.keys() | {g[0] for g in counts}:
        kept = sorted((t for t, n in docs[lang].items() if n >= at_least), key=str.encode)
        sources = [g for g in counts if g[0] == lang]
        whole = Counter()
        for g in sources:
            whole += counts[g]

        def shares(count):
            size = sum(count[t] for t in kept)
            return [1 + 10**9 * (count[t] + 2) // (size + 2 * len(kept)) for t in kept]

        q = shares(whole)
        of = {g: shares(counts[g]) for g in sources}
        for g in sources:
            pairs = [(h[1], sum((a - b) ** 2 // (a + b) for a, b in zip(of[g], of[h]))) for h in sources if h != g]
            terms = [(t, (a - b) ** 2 // (a + b)) for t, a, b in zip(kept, of[g], q) if counts[g][t] and a > b]
            for part, found, top in (("pair", pairs, None), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, g[1], part, i, v, r) for r, (i, v) in enumerate(found[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.select("lang", "source", "part", "item", "value", "rank").collect()))


@pytest.fixture
def check(spark):
    def run(rows):
        full = [(i, t, x, s, 0) for i, (t, x, s) in enumerate(rows)]
        assert rows_of(source_divergence(spark.createDataFrame(full, SCHEMA))) == brute(rows)

    return run


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.text, r.lang, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = all_queries()["op11_source_divergence"](spark, sf)
    assert dict(found.dtypes)["value"] == "bigint" and dict(found.dtypes)["rank"] == "int"
    assert rows_of(found) == brute(rows)


def test_odd_rows(check):
    text = "Ab ab AB\x7f é|É ﬁ　x 'tis \x00nul [b]ab"
    check([(text, "en", "a")] * 12 + [("ab cd " * 40000, "en", "b")] * 10 + [(None, None, None), ("ab", None, "a"), ("", "en", "c")])


def test_groups_without_terms_and_ties(check):
    # No term of "xx" is kept; in "en" two sources have the same counts, and values and items tie.
    rows = [("one", "xx", "p"), ("!!", "xx", "q"), (None, "xx", "r")]
    rows += [("b a c", "en", s) for s in ("é", "z", "Z") for _ in range(5)] + [("d " * 3 + "a", "en", "y")] * 10
    check(rows)


def test_blocks_add_up(check, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 3)
    words = [f"w{chr(97 + i // 20)}{chr(97 + i % 20)}" for i in range(120)]
    check([(" ".join(words[k % 7 :: k % 5 + 1]), "en", f"s{k % 6}") for k in range(90)])


def test_extra_columns_and_empty_table(spark):
    rows = [("a b", "en", "x", 1, 2, 3)] * 11 + [("b", "en", "y", 1, 2, 3)]
    df = spark.createDataFrame(rows, "body string, `the lang` string, source string, term int, block int, n int")
    found = source_divergence(df, text="body", lang="the lang")
    assert rows_of(found) == brute([r[:3] for r in rows])
    assert source_divergence(df.limit(0), text="body", lang="the lang").count() == 0


def test_equal_counts_are_one_run():
    import numpy as np

    starts, p = divergence._runs(np.array([0, 0, 3, 3, 3, 0]), 20)
    assert starts.tolist() == [0, 2, 5] and p[0] == p[2] == 1 + 10**9 * 2 // 20
