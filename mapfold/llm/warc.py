"""Deterministic sharded WARC writer and reader.

Records are range-partitioned and sorted by their id; each range writes gzip
members one record at a time and rolls to a new file when the compressed size
reaches ``roll_bytes``.  Headers are made anew from the record alone (record ids come
from the id and every date is the epoch, so a rerun writes the same bytes),
digests from the payload.  A payload that occurs more than once is stored once, with the greatest
id; the other records are revisits that refer to it.  Who refers to whom is worked
out on ids and digests alone; payloads are shuffled once, by the range sort.

A file is written under a temporary name with the attempt's number and renamed
when it is complete; the task returns one manifest row per file, and the
manifest is written last.  Readers read only files in the manifest, so a lost
executor's half-written or repeated files are never seen.

Files go to the shared folder through pyarrow's file systems (local or object
store URIs) and are read back with Spark's binary reader, a file (at most
``roll_bytes`` plus one record) at a time.

Defined cases: null html is an empty payload; a null url is the empty target; a
payload smaller than ``min_revisit`` bytes is always a response; rows that
repeat an id with the same payload are one response and then revisits of it; rows
with a null id are named by nothing, so each of equal ones is a response unless an
id has that payload;
very long payloads are one record; an empty table gives no files and no rows;
further columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mapfold.llm.common import ship, stored, table
from mapfold.session import shared_dir

ROLL_BYTES = 16 << 20
MANIFEST = "file string, records long, bytes long, first_id long, last_id long, sha1 string"


def digest32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{page_id}')}>"


def record(page_id: int | None, url: str, payload: bytes, size: int, digest: str, refers_to: int | None, refers_url: str) -> bytes:
    """One record, uncompressed; a revisit (``refers_to`` given) has no payload."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {size}",
    ]
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers_to)}",
            f"WARC-Refers-To-Target-URI: {_line(refers_url)}",
            f"X-Refers-To-Page: {refers_to}",
        ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload if refers_to is None else b"")
    head += [f"WARC-Block-Digest: sha1:{digest32(body)}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _line(text: str) -> str:
    """A header value: line breaks would end it, so they are percent-encoded."""
    return text.replace("\r", "%0D").replace("\n", "%0A")


class _Files:
    """Rolling files of one range of records."""

    def __init__(self, folder: str, part: int, attempt: int, roll_bytes: int):
        from pyarrow import fs

        self.fs, self.root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        self.part, self.attempt, self.roll = part, attempt, roll_bytes
        self.count, self.out = 0, None

    def add(self, page_id: int | None, raw: bytes) -> dict | None:
        if self.out is None:
            self.name = f"part-{self.part:05d}-{self.count:05d}.warc.gz"
            self.temp = f"{self.root}/_temporary/{self.name}.{self.attempt}"
            self.fs.create_dir(f"{self.root}/_temporary", recursive=True)
            self.out, self.sha = self.fs.open_output_stream(self.temp), hashlib.sha1()
            self.size, self.records, self.first = 0, 0, page_id
            self.count += 1
        member = gzip.compress(raw, 6, mtime=0)
        self.out.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1
        self.last = page_id
        return self.close() if self.size >= self.roll else None

    def close(self) -> dict | None:
        if self.out is None:
            return None
        self.out.close()
        self.fs.move(self.temp, f"{self.root}/{self.name}")
        self.out = None
        return {"file": self.name, "records": self.records, "bytes": self.size, "first_id": self.first, "last_id": self.last, "sha1": self.sha.hexdigest()}


def write(pages: DataFrame, folder: str, ranges: int | None = None, roll_bytes: int = ROLL_BYTES, min_revisit: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write all records under ``folder``; returns the committed manifest."""
    spark = pages.sparkSession
    ship(spark)
    html = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(F.col(url_col), F.lit("")).alias("url"), html.alias("payload"))
    light = rows.select("page_id", "url", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size"))
    groups = light.where(F.col("size") >= min_revisit).groupBy("sha", "size").agg(F.max(F.struct("page_id", "url")).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
    notes = light.join(groups, ["sha", "size"]).select("page_id", F.col("sha").alias("note_sha"), F.col("top.page_id").alias("refers_to"), F.col("top.url").alias("refers_url"))
    # a note and its record share the id, so one range partitioning brings them together
    notes = notes.distinct().select("page_id", F.lit(0).alias("kind"), "note_sha", "refers_to", "refers_url", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    records = rows.select("page_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("note_sha"), F.lit(None).cast("long").alias("refers_to"), F.lit(None).cast("string").alias("refers_url"), "url", "payload")
    both = notes.union(records)
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = both.repartitionByRange(ranges, "page_id").sortWithinPartitions("page_id", "kind", "note_sha", "url", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        files = _Files(folder, task.partitionId(), task.taskAttemptId(), roll_bytes)
        at, known, done = object(), {}, set()
        for b in batches:
            made = []
            for r in b.to_pylist():
                if r["page_id"] != at:
                    at, known, done = r["page_id"], {}, set()
                if r["kind"] == 0:
                    known[r["note_sha"]] = (r["refers_to"], r["refers_url"])
                    continue
                payload = r["payload"]
                sha = hashlib.sha1(payload).hexdigest()
                to, url = known.get(sha, (None, ""))
                if to == at and sha not in done:  # the one that stays
                    done.add(sha)
                    to = None
                made.append(files.add(at, record(at, r["url"], payload, len(payload), digest32(payload), to, url or "")))
            yield _manifest([m for m in made if m])
        yield _manifest([m for m in [files.close()] if m])

    placed.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/_manifest")  # the commit
    return spark.read.schema(MANIFEST).parquet(f"{folder}/_manifest")


def _manifest(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in MANIFEST.split(", ")]))


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of each record of an archive."""
    stream = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(data)))
    while line := stream.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a record: {line[:40]!r}")
        head = {}
        while (line := stream.readline().rstrip(b"\r\n")) != b"":
            k, _, v = line.decode().partition(": ")
            head[k.rstrip(":")] = v
        body = stream.read(int(head["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n" or f"sha1:{digest32(body)}" != head["WARC-Block-Digest"]:
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
        yield head, body.partition(b"\r\n\r\n")[2]


RECORDS = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(manifest: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the files in the manifest; payload digests are checked."""
    spark = manifest.sparkSession
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    files = files.join(F.broadcast(manifest.select("file")), "file", "left_semi").select("content")  # one short name per 16 MB of archive
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                rows, held = [], 0
                for head, payload in parse(data.as_py()):
                    kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and digest32(payload) != digest:
                        raise ValueError(f"damaged payload {head['WARC-Record-ID']}")
                    to = head.get("X-Refers-To-Page")
                    rows.append((int(head["X-Page-ID"]) if head["X-Page-ID"] else None, head["WARC-Target-URI"], payload if with_payload and kind == "response" else None, int(head["X-Payload-Length"]), digest, kind, int(to) if to else None))
                    held += len(payload) if with_payload else 0
                    if len(rows) >= 10_000 or held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return files.mapInArrow(run, RECORDS)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written as archives and read back."""
    folder = shared_dir(spark, "warc")
    manifest = write(table(spark, sf_dir, "pages"), folder)
    back = read(manifest, folder, with_payload=False)
    return stored(back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), "warc-index")
