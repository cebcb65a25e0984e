"""Web pages as WARC records and back.

Writing: a record per page, each a gzip member of its own. Of records with equal payloads the one with
the smallest page id is a ``response`` and carries the payload; the others are ``revisit`` records that
refer to it. Payloads under ``min_bytes`` are always responses. Digests are compared, never payloads,
and pages stay in their tasks; where many pages repeat, the list of repeats is joined by shuffle.

Reading: files are cut into byte ranges. A task looks for gzip's magic number in its range, takes a
place for the start of a record only if the data inflates to WARC headers, and owns the records that
start in its range, reading past its end for the last one. A payload that itself holds a WARC archive
in gzip could be taken for records where a range begins inside it.

A NULL payload is empty, a NULL url gives no target. Rows that repeat the smallest page id of their
payload are all responses; a NULL page id counts as larger than any other. An empty table gives no files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.llm.common import bound_batches, partitions, pieces, texts
from pulsetrail.llm.files import make_folder, resolve
from pulsetrail.workspace import new_path, stage

GZIP = b"\x1f\x8b\x08"
FILE_BYTES = 256 << 20
RANGE_BYTES = 8 << 20
FIRST_BYTES = 64 << 10
CHUNK = 256 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"


def write_warc(
    df: DataFrame,
    *,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    folder: str | None = None,
) -> DataFrame:
    """Write the records of ``df``; returns the files that make up the archive: path, bytes, records."""
    spark = df.sparkSession
    folder = folder or new_path(spark, "warc")
    make_folder(folder)
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = bound_batches(df).select(F.col(id).cast("bigint").alias("id"), F.col(url).alias("url"), body.alias("payload"))
    digest = F.sha2("payload", 256)
    same = (
        rows.filter(F.octet_length("payload") >= min_bytes)
        .groupBy(digest.alias("digest"))
        .agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
    )
    repeated = stage(same.select("digest", "first"), "warc-repeats")
    marked = rows.join(repeated, (digest == repeated["digest"]) & (F.octet_length("payload") >= min_bytes), "left")
    marked = marked.select("id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out, path, size, records = TaskContext.get().partitionId(), None, "", 0, 0
        for batch in pieces(batches, "payload"):
            columns = [batch.column(c).to_pylist() for c in ("id", "url", "refers_to")]
            for key, link, first, data in zip(*columns, texts(batch.column("payload"))):
                if out is None:
                    path, size, records = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.warc.gz", 0, 0
                    system, place = resolve(path)
                    out = system.open_output_stream(place, compression=None)
                size += out.write(_member(record(key, link, data, first)))
                records += 1
            if size >= FILE_BYTES:
                out.close()
                yield _file(path, size, records)
                out = None
                size = 0
        if out:
            out.close()
            yield _file(path, size, records)

    return stage(marked.mapInArrow(write, "path string, bytes bigint, records bigint"), "warc-files")


def record(key: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A WARC record; a revisit when it refers to another."""
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    head = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>" if key is None else _record_id(kind, key)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(body))),
    ]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if key is not None:
        head.append(("Page-Id", str(key)))
    if refers_to is not None:
        head += [("WARC-Refers-To", _record_id("response", refers_to)), ("Refers-To-Page", str(refers_to)), ("WARC-Profile", PROFILE)]
    lines = "".join(f"{name}: {value}\r\n" for name, value in head)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def read_warc(spark: SparkSession, files: DataFrame, *, with_payload: bool = True, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The records of ``files`` (path, bytes): page_id, target_uri, record_type, refers_to, payload_digest,
    payload_bytes and, unless left out, payload.

    Digest and length are those of the bytes read. A revisit has the digest of its header and no length;
    ``resolve_revisits`` adds that of the record it refers to.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(range_bytes).cast("bigint")))
    ranges = files.filter("bytes > 0").select("path", "bytes", starts.alias("start"))
    names = ["page_id", "target_uri", "record_type", "refers_to", "payload_digest", "payload_bytes"] + ["payload"] * with_payload
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*[batch.column(c).to_pylist() for c in ("path", "bytes", "start")]):
                rows: list[tuple] = []
                held = 0
                for head, payload in members(path, start, min(start + range_bytes, size)):
                    rows.append(_row(head, payload)[: len(names)])
                    held += len(payload) if with_payload else 200
                    if held > 4 << 20:
                        yield _batch(rows, names, kinds)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows, names, kinds)

    schema = "page_id bigint, target_uri string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint"
    # Dealt out by place, so that a range read again after a loss is the same range.
    dealt = ranges.repartition(partitions(spark), "path", "start")
    return dealt.mapInArrow(read, schema + ", payload binary" * with_payload)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with the payload length of each revisit taken from the record it refers to."""
    records = records.select("page_id", "record_type", "refers_to", "payload_digest", "payload_bytes")
    full = records.filter("record_type = 'response'").groupBy("page_id", "payload_digest").agg(F.max("payload_bytes").alias("_bytes"))
    full = full.withColumnRenamed("page_id", "_page").withColumnRenamed("payload_digest", "_digest")
    visits = records.filter("record_type = 'revisit'")
    found = visits.join(full, (F.col("refers_to") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest")), "left")
    found = found.withColumn("payload_bytes", F.col("_bytes")).drop("_page", "_digest", "_bytes")
    return records.filter("record_type = 'response'").unionByName(found)


def members(path: str, start: int, stop: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of the records whose gzip member starts in the bytes from ``start`` to ``stop``."""
    system, place = resolve(path)
    with system.open_input_file(place) as file:
        at = start
        while (at := _find(file, at, stop)) is not None:
            found = _decode(file, at)
            if found is None:
                at += 1
                continue
            at, data = found
            if data:
                yield _split(data)


def _find(file: pa.NativeFile, at: int, stop: int) -> int | None:
    """The next place in ``at`` to ``stop`` with gzip's magic number."""
    while at < stop:
        file.seek(at)
        data = file.read(min(CHUNK, stop - at) + len(GZIP) - 1)
        found = data.find(GZIP)
        if found >= 0:
            return at + found
        at += max(1, len(data) - len(GZIP) + 1)
    return None


def _decode(file: pa.NativeFile, at: int) -> tuple[int, bytes] | None:
    """End and content of the member at this place, None if it is not one of a WARC record."""
    inflate, data, checked = zlib.decompressobj(31), [], False
    file.seek(at)
    end = at
    try:
        while not inflate.eof:
            chunk = file.read(CHUNK)
            if not chunk:
                return None
            if not checked:
                # The first line decides; a wrong place is given up before much of it is inflated.
                head = inflate.decompress(chunk, FIRST_BYTES)
                if head[:7] != b"WARC/1.":
                    return None
                data += [head, inflate.decompress(inflate.unconsumed_tail)]
                checked = True
            else:
                data.append(inflate.decompress(chunk))
            end += len(chunk)
        whole = b"".join(data)
        # Headers are as long as their texts are.
        return (end - len(inflate.unused_data), whole) if b"\r\n\r\n" in whole else None
    except zlib.error:
        return None


def _split(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = [line.partition(": ") for line in head.decode().split("\r\n")[1:]]
    headers = {name.lower(): value for name, _, value in lines}
    return headers, rest[: int(headers["content-length"])]


def _row(head: dict[str, str], payload: bytes) -> tuple:
    kind, page, first = head["warc-type"], head.get("page-id"), head.get("refers-to-page")
    revisit = kind == "revisit"
    digest = head["warc-payload-digest"].removeprefix("sha1:") if revisit else digest_of(payload)
    number = lambda v: None if v is None else int(v)
    return number(page), head.get("warc-target-uri"), kind, number(first), digest, None if revisit else len(payload), payload


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _file(path: str, size: int, records: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [records]})


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def _record_id(kind: str, key: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}:{key}')}>"
