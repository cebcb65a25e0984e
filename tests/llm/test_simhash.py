import numpy as np
import xxhash

from pulsetrail.llm.components import components
from pulsetrail.llm.gray_index import _between, build, fewest, gray_links, gray_rank, search, spanning
from pulsetrail.llm.queries import all_queries
from pulsetrail.llm.simhash import band_keys, shingle_hashes

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def pairs_within(codes, bits):
    codes = np.array(codes, np.uint64)
    out = []
    for i in range(len(codes)):
        near = np.flatnonzero(np.bitwise_count(codes[i] ^ codes[i + 1 :]) <= bits)
        out += [(i, i + 1 + int(j)) for j in near]
    return out


def expected(rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    groups = union(range(len(rows)), pairs_within(fps, 4))
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[groups[i]] = min(key, low.get(groups[i], key))
    return sorted([(key, f"{fps[i]:016x}", low.get(groups[i])) for i, (key, _) in enumerate(rows)], key=str)


def run(spark, folder):
    return sorted([tuple(r) for r in all_queries()["op1_simhash"](spark, folder).collect()], key=str)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = run(spark, SF)
    assert found == expected(rows)
    assert any(r[0] != r[2] for r in found)


def test_odd_rows(spark, documents):
    rows = [(5, None), (3, ""), (9, " \n"), (7, "One two"), (8, "one\x0btwo"), (None, "one two three four five"), (2, "one two three four five")]
    rows += [(20, "w " * 70_000), (21, "É é"), (22, "é É"), (8, "one\x0btwo"), (30, "a b c d")]
    assert run(spark, documents(rows)) == expected(rows)


def test_empty_table(spark, documents):
    assert run(spark, documents([])) == []


def test_spark_hash_is_the_same(spark):
    row = spark.sql("SELECT hex(xxhash64('one two three four')) h").first()
    assert int(row.h, 16) == int(shingle_hashes([b"one", b"two", b"three", b"four"], 4)[0])


def near(rng, centres, copies, most):
    out = []
    for c in rng.integers(0, 1 << 63, centres, dtype=np.int64).astype(np.uint64) * np.uint64(2):
        for _ in range(copies):
            flips = rng.choice(64, rng.integers(0, most + 1), replace=False)
            out.append(int(c) ^ sum(1 << int(b) for b in flips))
    return sorted(set(out))


def test_links_are_complete(spark):
    rng = np.random.default_rng(1)
    codes = near(rng, 30, 40, 4) + [int(x) for x in rng.integers(0, 1 << 62, 2000)]
    codes = sorted(set(codes))
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    entries = spark.createDataFrame([(i, f) for i, f in enumerate(signed)], "id bigint, fp bigint")
    for bits in (2, 4):
        pairs = set(pairs_within(codes, bits))
        links = [(r.a, r.b) for r in gray_links(entries, bits).collect()]
        assert union(range(len(codes)), links) == union(range(len(codes)), pairs)
        assert {(b, a) for a, b in links} <= set(union_pairs(codes, pairs))


def union_pairs(codes, pairs):
    group = union(range(len(codes)), pairs)
    return [(i, j) for i in range(len(codes)) for j in range(i + 1, len(codes)) if group[i] == group[j]]


def test_large_upper_nodes_are_cut_into_blocks(spark, monkeypatch):
    from pulsetrail.llm import gray_index

    monkeypatch.setattr(gray_index, "BLOCK", 16)
    rng = np.random.default_rng(2)
    codes = near(rng, 3, 300, 7)
    signed = np.array(codes, np.uint64).view(np.int64).tolist()
    links = gray_links(spark.createDataFrame(list(enumerate(signed)), "id bigint, fp bigint"), 4)
    found = [(r.a, r.b) for r in links.collect()]
    assert union(range(len(codes)), found) == union(range(len(codes)), pairs_within(codes, 4))


def test_search_in_one_index(monkeypatch):
    from pulsetrail.llm import gray_index

    monkeypatch.setattr(gray_index, "FRONTIER", 500)
    rng = np.random.default_rng(3)
    codes = np.array(near(rng, 20, 30, 3), np.uint64)
    codes = codes[np.argsort(gray_index.gray_rank(codes))]
    codes = np.concatenate([codes, codes[:5]])
    bounds = np.array([0, len(codes) - 5, len(codes)])
    assert len(build(bounds, codes)[-1]["mask"]) == 2
    a, b = (np.concatenate(x) for x in zip(*search(bounds, codes, 4)))
    assert (np.bitwise_count(codes[a] ^ codes[b]) <= 4).all()
    label = spanning(len(codes), *fewest(len(codes), search(bounds, codes, 4)))
    assert (label == spanning(len(codes), a, b)).all()
    for part in (slice(0, len(codes) - 5), slice(len(codes) - 5, None)):
        group = union(range(len(codes[part])), pairs_within(codes[part], 4))
        assert (label[part] - part.start == [group[i] for i in range(len(codes[part]))]).all()


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), "t").collect()}
    assert found == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1200)}


def test_keys_find_words_added_in_one_place():
    rng = np.random.default_rng(6)
    for n, added in ((100, 15), (200, 40), (200, 34), (1000, 200)):
        found = 0
        for number in range(200):
            words = [b"w%d" % w for w in rng.integers(0, 50_000, n)]
            at = rng.choice([0, n // 2, n])
            more = words[:at] + [b"v%d" % w for w in rng.integers(0, 50_000, added)] + words[at:]
            a, b = (shingle_hashes(w, 5) for w in (words, more))
            assert 0.79 < len(np.intersect1d(a, b)) / len(np.union1d(a, b)) < 0.87
            found += bool(set(band_keys(a)) & set(band_keys(b)))
        assert found >= 0.97 * 200


def test_blocks_of_a_group_are_compared_without_rows_of_pairs(spark, documents, monkeypatch):
    """Texts that are candidates of each other and mostly refuted, in blocks: the same groups as by brute force."""
    from pulsetrail.llm import simhash

    rng = np.random.default_rng(8)
    rows = []
    for number in range(60):
        words = [f"w{w}" for w in range(120)]
        for at in rng.choice(115, rng.integers(1, 7), replace=False).tolist():
            words[at : at + 2] = words[at : at + 2][::-1]
        rows.append((number, " ".join(words)))
    sets = [set(shingle_hashes(simhash.words_of(t.encode()), 5).tolist()) for _, t in rows]
    alike = [(i, j) for i in range(60) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    wanted = union(range(60), alike)
    assert 1 < len(set(wanted[i] for i in range(60))) < 60
    for block in (7, 1024):
        monkeypatch.setattr(simhash, "BLOCK_TEXTS", block)
        df = spark.read.parquet(documents(rows) + "/documents.parquet")
        found = {r.id: r.keeper_id for r in simhash.near_copies(df).collect()}
        assert all((found[i] == found[j]) == (wanted[i] == wanted[j]) for i in range(60) for j in range(60))
    members = spark.createDataFrame([(i, i, [i], i, 1) for i in range(300)], "words_key bigint, fp0 bigint, bands array<bigint>, root bigint, group bigint")
    runs = spark.createDataFrame([(i, bytes(8)) for i in range(300)], "words_key bigint, runs binary")
    links = simhash._alike_in_blocks(members.withColumn("first", members.root), runs, ["fp0"], 64, 0.8)
    # All pairs are candidates and alike; what leaves the task is a link per text.
    assert links.count() == 299


def test_few_links_connect_the_same_roots():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 12).astype(np.uint64)
    codes = base[rng.integers(0, 12, 900)] ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 900).astype(np.uint64))
    codes = codes[np.argsort(gray_rank(codes))]
    for labels in (1, 5, 40, 900):
        label = rng.integers(0, labels, 900)
        starts = np.array([0, 900])
        a, b = (np.concatenate(c) for c in zip(*[(label[:0], label[:0]), *search(starts, codes, 4, label)]))
        x, y = _between(label, search(starts, codes, 4, label, every=False))
        assert (label[x] != label[y]).all() and len(x) < labels
        assert spanning(labels, label[a], label[b]).tolist() == spanning(labels, label[x], label[y]).tolist()
