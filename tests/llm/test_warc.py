import base64
import hashlib
import zlib
from urllib.parse import unquote

from pulsetrail.llm.queries import all_queries
from pulsetrail.llm.warc import read_warc, record, resolve_revisits, write_warc

SF = "/root/testdata/sf0.001"


def expected(rows):
    smallest = {}
    for key, _, html in rows:
        if key is not None:
            smallest[html or ""] = min(key, smallest.get(html or "", key))
    out = []
    for key, _, html in rows:
        raw, first = (html or "").encode(), smallest.get(html or "")
        visit = first is not None and key != first
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((key, len(raw), digest, "revisit" if visit else "response", first if visit else None))
    return sorted(out, key=str)


def run(spark, folder):
    return sorted([tuple(r) for r in all_queries()["op3_warc"](spark, folder).collect()], key=str)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    assert run(spark, SF) == expected(rows)


def test_odd_rows(spark, pages):
    rows = [(4, "http://x/\r\nA: b", "same"), (2, None, "same"), (9, "", None), (11, "u", ""), (None, "u", "same"), (6, "ü", "ü" * 300_000), (7, "u", "WARC/1.1\r\n\r\n\x1f\u008b\b")]
    assert run(spark, pages(rows)) == expected(rows)


def test_empty_table(spark, pages):
    assert run(spark, pages([])) == []


def test_ranges_of_any_size_give_every_record_once(spark, pages):
    rows = [(i, f"http://h/{i}", f"<p>{i * 7919}</p>" * (i % 50)) for i in range(300)]
    df = spark.read.parquet(pages(rows) + "/pages.parquet")
    files = write_warc(df, min_bytes=1)
    for size in (97, 1000, 1 << 20):
        found = read_warc(spark, files, range_bytes=size).collect()
        assert sorted((r.page_id, r.target_uri, r.payload.decode()) for r in found) == rows


def test_small_payloads_are_responses(spark, pages):
    df = spark.read.parquet(pages([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]) + "/pages.parquet")
    found = resolve_revisits(read_warc(spark, write_warc(df, min_bytes=3), with_payload=False))
    assert {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in found.collect()} == {
        1: ("response", None, 2), 2: ("response", None, 2), 3: ("response", None, 3), 4: ("revisit", 3, 3),
    }


def test_files_are_gzip(spark, pages):
    df = spark.read.parquet(pages([(1, "u", "<p>x</p>"), (2, "u", "y")]) + "/pages.parquet")
    data = b""
    for file in write_warc(df.coalesce(1)).collect():
        rest = open(file.path.removeprefix("file:"), "rb").read()
        while rest:
            one = zlib.decompressobj(31)
            data += one.decompress(rest)
            rest = one.unused_data
    assert data == b"".join(record(i, "u", h, None) for i, h in ((1, b"<p>x</p>"), (2, b"y")))


def test_headers_of_any_length(spark, pages):
    rows = [(1, "http://h/" + "a" * 100_000, "<p>long"), (2, "http://h/2", "<p>short"), (3, "http://h/" + "ü" * 100_000, "<p>long too")]
    found = read_warc(spark, write_warc(spark.read.parquet(pages(rows) + "/pages.parquet"))).collect()
    assert sorted((r.page_id, unquote(r.target_uri), r.payload.decode()) for r in found) == rows
