"""WARC archives with a two-level capture index (operator 3).

Each task writes the pages of its partition to one archive, a gzip member per record. A payload is stored once: the page with the
largest id has the response, pages of equal payload are revisits that name it. The index sorts captures by URL key (host
labels reversed, then the path) into compressed blocks; each index file ends with a sparse directory of the first key of
each block. A lookup finds the index file by the first keys of all files, the block by binary search in the file's directory, the
line by binary search in the block, and reads only that record's range of the archive.

Archives and index are in the shared folder, under names of their own for each attempt of a task; only files named in the manifest count.

Defined results: null html is an empty payload; a null url has the empty key; a null page_id is smaller than all others, so it refers to one that has an
id; repeated rows with the id of the response are responses; other columns are ignored; an empty table has no archive.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gustline.llm.text import bounded_batches
from gustline.session import shared_dir, write_stage

LINES, DATE, LEVEL = 300, "2024-01-01T00:00:00Z", 4
END = "<QQ"
NONE = -2 ** 63  # place of records without page_id in the order of pages; the record itself tells them apart


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def url_key(url: str | None) -> str:
    """Reversed host, port if any, then path and query: com,example,www)/path?query."""
    if not url:
        return ""
    try:
        parts = urlsplit(url if re.match(r"[A-Za-z][\w+.-]*:|//", url) else "//" + url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    rest = parts.path or "/"
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest + (f"?{parts.query}" if parts.query else "")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, sum_: str) -> bytes:
    """One record as a gzip member. A revisit keeps the HTTP head with the payload's length and no body."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or "")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if refers_to is not None else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{sum_}", "Content-Type: application/http; msgtype=response"]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers, payload and full payload length of a record; a stored payload must match its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    length = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response" and (len(payload) != length or "sha1:" + digest(payload) != fields["WARC-Payload-Digest"]):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return fields, payload, length


def write_archives(pages: DataFrame) -> DataFrame:
    """Writes all pages; the manifest: key, page_id, file, offset, length of each record."""
    spark = pages.sparkSession
    bounded_batches(spark)
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    same = plain.groupBy(F.sha1("html").alias("sum_")).agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where("n > 1 and last is not null")
    same = spark.read.parquet(write_stage(same, "copies")).select("sum_", "last")
    light = plain.select("page_id", F.sha1("html").alias("sum_of")).join(same, F.col("sum_of") == F.col("sum_")).where("page_id is null or page_id <> last")
    again = spark.read.parquet(write_stage(light.select(F.col("page_id").alias("id"), "sum_", "last").distinct(), "revisits"))
    rows = plain.join(again, F.col("page_id").eqNullSafe(F.col("id")) & (F.sha1("html") == F.col("sum_")), "left").select("page_id", "url", "html", "last")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        out, file, at = None, f"{uuid.uuid4().hex}.warc.gz", 0
        for batch in batches:
            keys, places = [], []
            if out is None and batch.num_rows:
                store.create_dir(top, recursive=True)
                out = store.open_output_stream(f"{top}/{file}", compression=None)
            for page, url, html, last in zip(*(c.to_pylist() for c in batch.columns)):
                payload = html.encode()
                data = record(page, url, payload, last, digest(payload))
                out.write(data)
                keys.append(url_key(url))
                places.append((at, len(data)))
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), batch.column(0), pa.array([file] * len(keys), pa.string()), pa.array([p[0] for p in places], pa.int64()),
                 pa.array([p[1] for p in places], pa.int64())], ["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    manifest = rows.mapInArrow(run, "key string, page_id long, file string, offset long, length long")
    return spark.read.parquet(write_stage(manifest, "manifest")).withColumn("folder", F.lit(folder))


class Captures:
    """Reader of one index file."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        at, length = struct.unpack(END, self.file.read_at(struct.calcsize(END), size - struct.calcsize(END)))
        self.directory = json.loads(zlib.decompress(self.file.read_at(length, at)))
        self.firsts = [tuple(d[0]) for d in self.directory]
        self.block, self.lines = -1, []

    def find(self, key: str, page: int) -> list[list]:
        """Lines [key, page, file, offset, length] of a capture; page is NONE for none."""
        at = max(bisect.bisect_left(self.firsts, (key, page)) - 1, 0)
        found: list[list] = []
        while at < len(self.firsts) and (self.firsts[at] <= (key, page) or not found and at == 0):
            if at != self.block:
                _, offset, length = self.directory[at]
                self.block, self.lines = at, json.loads(zlib.decompress(self.file.read_at(length, offset)))
            low = bisect.bisect_left(self.lines, [key, page])
            while low < len(self.lines) and self.lines[low][:2] == [key, page]:
                found.append(self.lines[low])
                low += 1
            at += 1
        return found


def build_index(manifest: DataFrame) -> DataFrame:
    """Writes the index; (index, first_key, first_page) of each index file."""
    spark = manifest.sparkSession
    folder = f"{shared_dir(spark)}/cdx-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        name, out, lines, directory, at = f"{uuid.uuid4().hex}.cdx", None, [], [], 0

        def flush() -> None:
            nonlocal lines, at
            data = zlib.compress(json.dumps(lines, ensure_ascii=False).encode("utf-8", "surrogatepass"), LEVEL)
            out.write(data)
            directory.append([lines[0][:2], at, len(data)])
            at, lines = at + len(data), []

        for batch in batches:
            if out is None and batch.num_rows:
                store.create_dir(top, recursive=True)
                out = store.open_output_stream(f"{top}/{name}", compression=None)
            for line in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(list(line))
                if len(lines) == LINES:
                    flush()
        if out is None:
            return
        if lines:
            flush()
        data = zlib.compress(json.dumps(directory, ensure_ascii=False).encode(), LEVEL)
        out.write(data)
        out.write(struct.pack(END, at, len(data)))
        out.close()
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([directory[0][0][0]]), pa.array([directory[0][0][1]], pa.int64())],
                                         ["index", "first_key", "first_page"])

    lines = manifest.select("key", F.coalesce("page_id", F.lit(NONE)).alias("page"), "file", "offset", "length")
    parts = max(1, manifest.rdd.getNumPartitions())
    ordered = lines.repartitionByRange(parts, "key", "page").sortWithinPartitions("key", "page", "file", "offset")
    return spark.read.parquet(write_stage(ordered.mapInArrow(run, "index string, first_key string, first_page long"), "cdx"))


def read_captures(captures: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """page_id, url, record_type, refers_to, payload_bytes, payload_digest and html (null for revisits) of each capture (url, page_id) asked for.

    The first keys of the index files, one entry a file, go to every task; captures are then dealt by index file."""
    spark = captures.sparkSession
    tops = sorted((r["first_key"], r["first_page"], r["index"]) for r in index.collect())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [t[:2] for t in tops]
        for batch in batches:
            ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys = [url_key(u) for u in urls]
            files = [max(bisect.bisect_right(firsts, (k, NONE if i is None else i)) - 1, 0) for k, i in zip(keys, ids)]
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.int32()), pa.array(keys, pa.string()), pa.array([NONE if i is None else i for i in ids], pa.int64())],
                                             ["file", "key", "page"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        opened, archives = (-1, None), {}
        for batch in batches:
            rows = []
            for at, key, page in zip(*(c.to_pylist() for c in batch.columns)):
                if opened[0] != at:
                    opened = at, Captures(store, fs.FileSystem.from_uri(tops[at][2])[1])
                for _, _, file, offset, length in opened[1].find(key, page):
                    if file not in archives:
                        if len(archives) >= 64:
                            archives.pop(next(iter(archives))).close()
                        archives[file] = store.open_input_file(f"{top}/{file}")
                    fields, payload, size = parse(archives[file].read_at(length, offset))
                    refers = re.search(r"page:(-?\d+)", fields.get("WARC-Refers-To", ""))
                    stored = fields["WARC-Type"] == "response"
                    own = fields["WARC-Record-ID"].removeprefix("<urn:page:").removesuffix(">")
                    rows.append((int(own) if own else None, fields["WARC-Target-URI"], fields["WARC-Type"], int(refers[1]) if refers else None, size,
                                 fields["WARC-Payload-Digest"].removeprefix("sha1:"), payload.decode() if stored else None))
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                             ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "html"])

    schema = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, html string"
    if not tops:
        return spark.createDataFrame([], schema)
    asked = captures.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url")).distinct()
    routed = asked.mapInArrow(route, "file int, key string, page long").distinct()
    return routed.repartitionByRange(len(tops), "file", "key", "page").sortWithinPartitions("file", "key", "page").mapInArrow(run, schema)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    manifest = write_archives(pages)
    index = build_index(manifest)
    found = read_captures(pages, index, manifest.select("folder").first()["folder"] if index.head(1) else "")
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {"op3_warc": op3_warc}
ORACLE: dict[str, str] = {}
