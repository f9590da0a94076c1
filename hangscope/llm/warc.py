"""WARC: normaliser of monolithic gzip archives, with a sidecar offset index.

``write_monolithic`` writes records as archives whose whole file is one gzip
stream, the form that can't be read at an offset.  ``normalise`` inflates each
archive once, as a stream, writes every record as its own gzip member and a
sidecar index (JSON lines: offset and length of each member, type, id, digest).
``read_records`` reads members at the index's offsets.

Scale: tasks write their own archives, rolled at ``roll_bytes`` of records;
an inflated archive is never held, only ``CHUNK`` bytes of it and one record
header.  Files appear under their final name by a rename when complete, so the
task of a lost executor writes them again.

Payload copies: of records with equal payloads of at least ``min_bytes``
bytes, the one with the largest id is the response and the others are
``revisit`` records (HTTP header only) that refer to it.  Smaller payloads are
always responses.

Edge cases: null payload is empty; null url is an empty target URI; white space
and control characters of a url are percent-encoded in its header.  A null id
revisits like any other copy and is never referred to; copies whose ids are all
null are all responses.  Repeated rows with the largest id are all responses.
An empty table writes no archive.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_arrow, open_shared, scratch_dir

CHUNK = 1 << 20
ROLL_BYTES = 64 << 20
DATE = "2020-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_CONTROL = re.compile(r"[\x00-\x20\x7f]")


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 1000) -> DataFrame:
    """``id, url, payload, n_bytes, digest, type, refers_to`` of each row."""
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{url}`").alias("url"), body.alias("payload"),
                        F.octet_length(body).cast("long").alias("n_bytes"), F.sha1(body.cast("binary")).alias("digest"))
    target = (rows.filter(F.col("n_bytes") >= min_bytes).groupBy("digest").agg(F.max("id").alias("target"), F.count("*").alias("n"))
              .filter("n > 1 AND target IS NOT NULL").select("digest", "target"))
    revisit = F.col("target").isNotNull() & ~F.col("id").eqNullSafe(F.col("target"))
    return rows.join(target, "digest", "left").select(
        "id", "url", F.when(~revisit, F.col("payload")).alias("payload"), "n_bytes", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("type"), F.when(revisit, F.col("target")).alias("refers_to"))


def record_bytes(r: dict) -> bytes:
    body = (r["payload"] or "").encode("utf-8") if r["type"] == "response" else b""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['n_bytes']}\r\n\r\n".encode()
    uri = _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", r["url"] or "")
    head = ["WARC/1.1", f"WARC-Type: {r['type']}", f"WARC-Record-ID: <urn:page:{'' if r['id'] is None else r['id']}>",
            f"WARC-Target-URI: {uri}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{r['digest']}",
            "Content-Type: application/http; msgtype=response"]
    if r["type"] == "revisit":
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{r['refers_to']}>"]
    head.append(f"Content-Length: {len(http) + len(body)}")
    return "\r\n".join(head).encode("utf-8") + b"\r\n\r\n" + http + body + b"\r\n\r\n"


class _Out:
    """A file that gets its name when it is closed."""

    def __init__(self, uri: str):
        self.fs, self.path = open_shared(uri)
        folder, _, name = self.path.rpartition("/")
        self.fs.create_dir(folder, recursive=True)
        self.tmp, self.at = f"{folder}/.{name}.{uuid.uuid4().hex}", 0  # readers of the folder skip it
        self.f = self.fs.open_output_stream(self.tmp)

    def write(self, data: bytes) -> None:
        self.f.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.f.close()
        self.fs.move(self.tmp, self.path)


def write_monolithic(records: DataFrame, root: str, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``records`` (of ``mark_revisits``) as whole-file gzip streams; returns ``archive, n_records``."""
    names = ["id", "url", "payload", "n_bytes", "digest", "type", "refers_to"]

    def write(batches):
        part, k, out, z, n, size = TaskContext.get().partitionId(), 0, None, None, 0, 0
        done = []

        def finish():
            out.write(z.flush())
            out.close()
            done.append((name, n))

        for b in batches:
            for r in pa.RecordBatch.from_arrays(b.columns, names=names).to_pylist():
                if out is None:
                    name = f"{part:06d}-{k:04d}.warc.gz"
                    out, z, n, size = _Out(f"{root}/monolithic/{name}"), zlib.compressobj(6, zlib.DEFLATED, 31), 0, 0
                data = record_bytes(r)
                out.write(z.compress(data))
                n, size = n + 1, size + len(data)
                if size >= roll_bytes:
                    finish()
                    out, k = None, k + 1
        if out is not None:
            finish()
        yield [pa.array([x[0] for x in done], pa.string()), pa.array([x[1] for x in done], pa.int64())]

    schema = T.StructType([T.StructField("archive", T.StringType()), T.StructField("n_records", T.LongType())])
    map_arrow(records.select(*names), write, schema).write.parquet(f"{root}/monolithic-list")
    return records.sparkSession.read.schema(schema).parquet(f"{root}/monolithic-list")


class Inflated:
    """Bytes of a gzip file (one or more members), inflated as they are asked for."""

    def __init__(self, f):
        self.f, self.z, self.buf = f, zlib.decompressobj(31), bytearray()

    def _more(self) -> bool:
        data = self.z.unconsumed_tail
        if not data and self.z.eof:
            data, self.z = self.z.unused_data, zlib.decompressobj(31)
        data = data or self.f.read(CHUNK)
        if not data:
            return False
        self.buf += self.z.decompress(data, CHUNK)
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Up to and with the mark; None at the end of the file."""
        seen = 0
        while (at := self.buf.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.buf)
            if not self._more():
                if self.buf.strip():
                    raise ValueError("archive ends inside a record header")
                return None
        return self._take(at + len(mark))

    def chunks(self, n: int):
        while n:
            if not self.buf and not self._more():
                raise ValueError("archive ends inside a record")
            part = self._take(min(n, len(self.buf)))
            n -= len(part)
            yield part

    def _take(self, n: int) -> bytes:
        out = bytes(self.buf[:n])
        del self.buf[:n]
        return out


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8").strip().split("\r\n")
    return {"": lines[0]} | {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def normalise_file(src: str, archive: str, sidecar: str) -> int:
    """Rewrite one monolithic archive; returns the number of its records."""
    fs, path = open_shared(src)
    out, index, n = _Out(archive), _Out(sidecar), 0
    with fs.open_input_stream(path, compression=None) as f:
        stream = Inflated(f)
        while (head := stream.until(b"\r\n\r\n")) is not None:
            head = head.lstrip(b"\r\n")
            fields, start, z = parse_head(head), out.at, zlib.compressobj(6, zlib.DEFLATED, 31)
            out.write(z.compress(head))
            for part in stream.chunks(int(fields["content-length"]) + 4):
                out.write(z.compress(part))
            out.write(z.flush())
            index.write(json.dumps({"archive": archive.rpartition("/")[2], "offset": start, "length": out.at - start, "type": fields["warc-type"],
                                    "id": fields["warc-record-id"], "digest": fields.get("warc-payload-digest")}).encode() + b"\n")
            n += 1
    out.close()
    index.close()
    return n


INDEX = T.StructType([T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
                      T.StructField("type", T.StringType()), T.StructField("id", T.StringType()), T.StructField("digest", T.StringType())])


def normalise(archives: DataFrame, root: str) -> DataFrame:
    """Rewrite each listed archive of ``root``; returns the sidecar index, a row per record."""
    spark = archives.sparkSession

    def run(batches):
        for b in batches:
            names = b.column(0).to_pylist()
            n = [normalise_file(f"{root}/monolithic/{x}", f"{root}/archives/{x}", f"{root}/index/{x}.jsonl") for x in names]
            yield [b.column(0), pa.array(n, pa.int64())]

    done = T.StructType([T.StructField("archive", T.StringType()), T.StructField("n_records", T.LongType())])
    map_arrow(archives.select("archive").repartition("archive"), run, done).write.parquet(f"{root}/list")
    if spark.read.schema(done).parquet(f"{root}/list").isEmpty():
        return spark.createDataFrame([], INDEX)
    return spark.read.schema(INDEX).json(f"{root}/index")


def read_record(f, offset: int, length: int) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of the member at ``offset``."""
    f.seek(offset)
    data = zlib.decompress(f.read(length), 31)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = parse_head(head)
    http, _, payload = block[:int(fields["content-length"])].partition(b"\r\n\r\n")
    return fields, parse_head(http), payload


def read_records(index: DataFrame, root: str, id_type: str = "long") -> DataFrame:
    """Each indexed record, read at its offset; a response whose payload does not have its digest is an error."""
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("page", T.StringType()), ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("record_type", T.StringType()),
        ("refers", T.StringType()), ("url", T.StringType()), ("archive", T.StringType()), ("offset", T.LongType()), ("length", T.LongType()))])
    page_of = re.compile(r"<urn:page:(.+)>")

    def run(batches):
        opened, f = None, None
        for b in batches:
            rows = []
            for archive, offset, length in zip(*(b.column(i).to_pylist() for i in range(3))):
                if archive != opened:
                    if f is not None:
                        f.close()
                    fs, path = open_shared(f"{root}/archives/{archive}")
                    f, opened = fs.open_input_file(path), archive
                head, http, payload = read_record(f, offset, length)
                kind, digest, n = head["warc-type"], head["warc-payload-digest"].removeprefix("sha1:"), int(http["content-length"])
                if kind == "response":
                    n, was = len(payload), digest
                    if (digest := hashlib.sha1(payload).hexdigest()) != was:
                        raise ValueError(f"payload of {head['warc-record-id']} does not have its digest")
                ids = [m and m[1] for m in (page_of.fullmatch(head.get(k, "")) for k in ("warc-record-id", "warc-refers-to"))]
                rows.append((ids[0], n, digest, kind, ids[1], head.get("warc-target-uri"), archive, offset, length))
            yield [pa.array([r[i] for r in rows], pa.int64() if i in (1, 7, 8) else pa.string()) for i in range(9)]
        if f is not None:
            f.close()

    dealt = index.select("archive", "offset", "length").withColumn("blk", F.floor(F.col("offset") / ROLL_BYTES)).repartition(
        "archive", "blk").sortWithinPartitions("archive", "offset").drop("blk")
    return map_arrow(dealt, run, schema).select(F.col("page").cast(id_type).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                                                 F.col("refers").cast(id_type).alias("refers_to"), "url", "archive", "offset", "length")


def archive_round_trip(pages: DataFrame, root: str | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` as monolithic archives, normalise them and read every record back."""
    root = root or scratch_dir(pages.sparkSession, "warc")
    index = normalise(write_monolithic(mark_revisits(pages), root, roll_bytes), root)
    return read_records(index, root, pages.schema["page_id"].dataType.simpleString())


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
g AS (SELECT sha1(body) AS d, max(page_id) AS target FROM p WHERE n >= 1000 GROUP BY 1 HAVING count(*) > 1)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN target IS NOT NULL AND page_id IS DISTINCT FROM target THEN target END AS refers_to
FROM p LEFT JOIN g ON d = sha1(body) AND n >= 1000
"""
