import hashlib
import math

import numpy as np
import pytest

from pulsetrail.llm import vector_codes as module
from pulsetrail.llm.queries import all_queries
from pulsetrail.llm.vector_codes import cover_tree, nearest, squared, vector_codes

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(vectors, parts=4, entries=256, rounds=4, scale=1024):
    """Codes, errors and codebooks of the rows of a list of vectors, already in order of id."""
    x = np.array([[math.floor(scale * v) for v in row] for row in vectors], dtype=object)
    codes, error, books = [], np.zeros(len(x), object), []
    for p in np.split(x, parts, axis=1):
        book = p[:entries].copy()
        for turn in range(rounds + 1):
            far = ((p[:, None, :] - book[None]) ** 2).sum(-1)
            code = np.array([min(range(len(book)), key=lambda e, r=r: (r[e], e)) for r in far])
            if turn < rounds:
                for e in range(len(book)):
                    if (code == e).any():
                        book[e] = p[code == e].sum(0) // int((code == e).sum())
        books.append(book)
        codes.append(code)
        error += far[np.arange(len(p)), code]
    return ["".join(f"{c[i]:02x}" for c in codes) for i in range(len(x))], error.tolist(), books


def expected(rows):
    """The query's rows for rows of (id, vector, label) with good vectors and different ids."""
    rows = sorted(rows, key=lambda r: r[0])
    codes, error, books = brute([[float(np.float32(v)) for v in r[1]] for r in rows])
    digest = hashlib.sha256(",".join(str(v) for b in books for v in b.ravel()).encode()).hexdigest()
    of_label = {}
    for r, e in zip(rows, error):
        of_label[r[2]] = of_label.get(r[2], 0) + e
    return [(r[0], c, e, of_label[r[2]], digest) for r, c, e in zip(rows, codes, error)]


def run(spark, folder):
    found = all_queries()["op12_vector_codes"](spark, folder)
    return sorted(map(tuple, found.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert run(spark, sf) == expected(rows)


def test_clustered_vectors_and_copies(spark, write, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 200)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(9, 8))
    rows = [(i, (centres[i % 9] + rng.normal(size=8) * 10.0 ** -(i % 5)).tolist(), i % 4 or None) for i in range(700)]
    rows += [(1000 + i, rows[5][1], 1) for i in range(300)]
    assert run(spark, write("embeddings", rows, SCHEMA)) == expected(rows)


def test_odd_rows(spark, write):
    nan, inf = float("nan"), float("inf")
    good = [(3, [0.5, -0.5, 0.25, 1.0], None), (9, [0.0, 0.0, -0.0001, 2.5], 7), (4, [0.5, -0.5, 0.25, 1.0], 7)]
    bad = [(1, None, 1), (2, [0.1, None, 0.1, 0.1], 1), (5, [nan] * 4, 1), (6, [0.0, inf, 0.0, 0.0], 1), (7, [-inf] * 4, 7)]
    assert run(spark, write("embeddings", good + bad, SCHEMA)) == expected(good)
    # A vector of another length has no distance to the others.
    other = run(spark, write("embeddings", [*good, (20, [1.0] * 8, 7), (21, [], 7)], SCHEMA))
    assert other[:3] == expected(good) and [r[:3] for r in other[3:]] == [(20, None, None), (21, None, None)]


@pytest.mark.parametrize("rows", [[], [(1, None, 1), (2, [float("nan")] * 4, 1)]])
def test_nothing_to_code(spark, write, rows):
    assert run(spark, write("embeddings", rows, SCHEMA)) == []


def test_repeated_and_null_ids(spark):
    vectors = [[1.0, 0.0], [0.0, 1.0], [1.0, 0.0], [3.0, 3.0]]
    rows = [(5, vectors[0], "a"), (5, vectors[1], "b"), (5, vectors[0], "a"), (None, vectors[3], "c")]
    df = spark.createDataFrame(rows, "vec_id bigint, x array<double>, code string")
    found = vector_codes(df, vector="x", parts=2, entries=3)
    # Equal ids go by vector and NULL comes last, so the start is (0, 1), (1, 0), (1, 0).
    codes, error, books = brute([vectors[i] for i in (1, 0, 0, 3)], parts=2, entries=3)
    got = sorted((r._row.x, r._row.code, r.code, r.error) for r in found.codes.collect())
    assert got == sorted(zip([vectors[i] for i in (1, 0, 0, 3)], "baac", codes, error))
    assert all((a == b).all() for a, b in zip(found.codebooks, books))
    assert vector_codes(df.drop("code"), vector="x", parts=2).codes.columns == ["_row", "code", "error"]


def test_refusals(spark):
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id int, embedding array<float>"))
    with pytest.raises(ValueError):
        vector_codes(spark.createDataFrame([(1, [1e30] * 4)], "vec_id int, embedding array<float>"))


def test_large_components_stay_exact():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-(2**29), 2**29, (50, 3)), rng.integers(-(2**29), 2**29, (4, 3))
    exact = [[sum(int(x - y) ** 2 for x, y in zip(p, q)) for q in b] for p in a]
    assert squared(a, b).tolist() == exact


def test_trees_assign_whole_nodes():
    rng = np.random.default_rng(2)
    centres = rng.integers(-4000, 4000, (12, 6))
    points = np.repeat(centres, 80, axis=0) + rng.integers(-20, 20, (960, 6))
    tree = cover_tree(points)
    assert (tree.points[tree.places] == points).all() and tree.weights.sum() == len(points)
    for node in tree.nodes:
        held = tree.points[node["start"] : node["end"]]
        assert np.sqrt(squared(held, held[:1]).max()) <= node["radius"]
        if node["children"]:
            below = tree.nodes[node["child"] : node["child"] + node["children"]]
            assert below["start"][0] == node["start"] and below["end"][-1] == node["end"]
    compared = []
    count = module.squared
    module.squared = lambda p, book: compared.append(len(p)) or count(p, book)
    try:
        found = nearest(tree, centres)
    finally:
        module.squared = count
    assert (found == count(tree.points, centres).argmin(1)).all()
    # Far fewer comparisons than points: clusters are decided as a whole.
    assert sum(compared) < 200
