"""WARC archives: a writer with identical-payload revisits and a splittable reader.

Writer: records are dealt to tasks, each task writes one ``.warc.gz`` with one gzip member per record into the
shared folder and reports it in a manifest row; files of failed attempts never get into the manifest. Of records
with equal payloads the one with the largest id is the response, the others revisit it.

Reader: files are cut into byte ranges, one row each, dealt to tasks. A task looks for gzip magic in its range,
takes a candidate as a member only if it inflates to a WARC header, owns every record that starts inside its
range (and reads past the end to finish the last), and holds one record at a time.

A very long payload is one record, read and inflated in blocks; a task holds it once, beside its row (up to the 2 GB of a
JVM string). Null html is an empty payload; null urls are written as an empty target. Rows repeated with the same id are
each written; those with the largest id of their payload are all responses. A null id is written as no id and
read back as null; it never is a response that others refer to unless no row of the payload has an id, when all
are responses. Empty tables give no file and no row. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.llm.common import Scratch, settings, shuffle_partitions, table

MAGIC = b"\x1f\x8b\x08"
BLOCK = 1 << 18
SPLIT_BYTES = 4 << 20
MANIFEST = "path string, bytes long, records long"
RECORD = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary"
PREFIX = "urn:page:"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _name(page_id: int | None) -> str:
    return "" if page_id is None else f"<{PREFIX}{page_id}>"


def _number(name: str | None) -> int | None:
    return int(name[len(PREFIX) + 1 : -1]) if name else None


def encode_record(page_id: int | None, url: str, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member holding one response, or one revisit (HTTP header only) if ``refers_to`` is given."""
    digest = sha1_base32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http if refers_to is not None else http + payload
    url = url.replace("\r", "%0D").replace("\n", "%0A")
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_name(page_id)}", "WARC-Date: 2024-01-01T00:00:00Z", f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


def decode_record(record: bytes) -> tuple:
    """A RECORD row from an inflated member; a payload that does not match its digest is an error."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = dict(line.partition(": ")[::2] for line in head.decode().split("\r\n")[1:])
    body = rest[: int(fields["Content-Length"])]
    http, _, payload = body.partition(b"\r\n\r\n")
    size = next(int(line.partition(b":")[2]) for line in http.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return _number(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], kind, size, digest, _number(fields.get("WARC-Refers-To")), payload if kind == "response" else None


class _Window:
    """Reads a file forward by blocks and keeps only what lies at or after a position."""

    def __init__(self, file, begin: int) -> None:
        self.file, self.at, self.data, self.ended = file, begin, bytearray(), False
        file.seek(begin)

    def more(self) -> bool:
        got = b"" if self.ended else self.file.read(BLOCK)
        self.data += got  # in place: a long record is not copied for each of its blocks
        self.ended = not got
        return bool(got)

    def skip(self, to: int) -> None:
        del self.data[: to - self.at]
        self.at = to


def scan_range(file, begin: int, end: int) -> Iterator[bytes]:
    """The inflated records whose members start in [begin, end)."""
    w, at = _Window(file, begin), begin
    while at < end:
        w.skip(at)
        found = w.data.find(MAGIC)
        if found < 0:
            at = max(w.at, w.at + len(w.data) - len(MAGIC) + 1)
            if not w.more():
                return
            continue
        at = w.at + found
        if at >= end:
            return
        w.skip(at)
        got = _member(w)
        if got is None:
            at += 1
        else:
            record, used = got
            at += used
            yield record


def _member(w: _Window) -> tuple[bytes, int] | None:
    """The member at the window's start, inflated, and its length; None if none with a WARC header starts there.

    Once a WARC header is seen, a member that breaks or ends early is an error, and what is read of it is let go.
    """
    unpack, out, begin, at = zlib.decompressobj(31), [], w.at, w.at
    checked = False
    while not unpack.eof:
        if at >= w.at + len(w.data) and not w.more():
            if checked:
                raise ValueError(f"record at byte {begin} is truncated")
            return None
        part = w.data[at - w.at : at - w.at + BLOCK]
        try:
            out.append(unpack.decompress(part))
        except zlib.error as e:
            # What a part inflates to before it breaks is lost with the error, so the header is looked for anew.
            if checked or _begins(w.data[:BLOCK]):
                raise ValueError(f"record at byte {begin} is damaged: {e}") from e
            return None
        at += len(part) - len(unpack.unused_data)
        if checked:
            w.skip(at)
        if not checked and (unpack.eof or sum(map(len, out)) >= 5):
            if not b"".join(out).startswith(b"WARC/"):
                return None
            checked = True
    return b"".join(out), at - begin


def _begins(data: bytes) -> bool:
    """Whether the member at the start of ``data``, whole or not, inflates to a WARC header."""
    try:
        return zlib.decompressobj(31).decompress(data, 5) == b"WARC/"
    except zlib.error:
        return False


def write_archives(pages: DataFrame, scratch: Scratch, dedupe_from: int = 0) -> DataFrame:
    """Writes every row (page_id, url, html) as a record and returns the manifest of the files.

    Payloads of at least ``dedupe_from`` bytes are stored once. Only digests that occur more than once are joined
    back, with a plain equi-join that adaptive execution splits where one digest has many rows.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    same = rows.where(F.octet_length("payload") >= dedupe_from).groupBy("digest").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    same = scratch.save(same, "same")  # so that the join is one of two plain shuffles
    # By a shuffle at every size: a broadcast would only fit while few payloads repeat.
    joined = rows.join(same.hint("merge"), "digest", "left").select("page_id", "url", "payload", F.when(F.col("page_id").eqNullSafe(F.col("first")), None).otherwise(F.col("first")).alias("refers_to"))
    folder = scratch.path("archives")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        path, out, n = f"{root}/{uuid.uuid4().hex}.warc.gz", None, 0
        for batch in batches:
            for page_id, url, data, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(path, compression=None)
                out.write(encode_record(page_id, url, data, refers_to))
                n += 1
        if out is not None:
            size = out.tell()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [n]})

    with settings(pages.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch=500):
        return scratch.save(joined.mapInArrow(write, MANIFEST), "manifest")


def read_archives(manifest: DataFrame, root: str, split_bytes: int = SPLIT_BYTES, with_payload: bool = True) -> DataFrame:
    """RECORD rows of the archives that ``manifest`` (path, bytes, records) lists; ``root`` names their file system.

    Each byte range is a row; ranges are dealt evenly to tasks, so one large file is read by many. The rows are
    written once; a file of fewer or more records than the manifest says is an error.
    """
    begin = F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes))).alias("begin")
    ranges = manifest.select("path", "bytes", begin).select("path", "begin", F.least(F.col("begin") + split_bytes, F.col("bytes")).alias("end"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(root)
        names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "path"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]

        def pack(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for path, first, last in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(path) as file:
                    rows, held = [], 0
                    for record in scan_range(file, first, last):
                        row = decode_record(record)
                        rows.append((*(row if with_payload else (*row[:-1], None)), path))
                        held += len(record)
                        if held > 4 << 20:
                            yield pack(rows)
                            rows, held = [], 0
                    if rows:
                        yield pack(rows)

    spark = manifest.sparkSession
    rows = ranges.repartition(max(shuffle_partitions(spark), 8)).mapInArrow(read, RECORD + ", path string")
    rows = Scratch(spark, "warc-rows").save(rows, "rows")
    found = manifest.select("path", "records").join(rows.groupBy("path").agg(F.count("*").alias("found")), "path", "left")
    wrong = found.where(F.coalesce("found", F.lit(0)) != F.col("records")).limit(3).collect()
    if wrong:
        raise ValueError("records found and in the manifest differ: " + ", ".join(f"{r['path']} {r['found'] or 0} of {r['records']}" for r in wrong))
    return rows.drop("path")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), scratch)
    return read_archives(manifest, scratch.root, with_payload=False).drop("payload", "url")


#: DuckDB has no SHA-1 in base32; the digits are taken from the hexadecimal digest, five bits each.
ORACLE = """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS x FROM p),
m AS (SELECT x, max(page_id) AS first FROM d GROUP BY x),
b AS (SELECT x, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(('0b' || substr(bits, 1 + 5 * k, 5)) AS INTEGER), 1), '' ORDER BY k) AS digest
  FROM (SELECT x, k, CAST(CAST(unhex(x) AS BIT) AS VARCHAR) AS bits FROM (SELECT DISTINCT x FROM d), range(32) t(k)) GROUP BY x)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to FROM d JOIN m USING (x) JOIN b USING (x)"""
