"""Web pages as WARC archives: a deterministic sharded writer and a reader."""

from __future__ import annotations

import base64
import contextlib
import hashlib
import re
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riverglass.llm.common import stored

ROLL_BYTES = 8 << 20  # a file is closed after the record that takes it past this compressed size
SHARD_BYTES = 32 << 20  # payload of a shard, more where that would give over MAX_SHARDS
MAX_SHARDS = 20_000  # their first keys travel to every task
MIN_REVISIT = 1000
NO_ID = -(1 << 63)
DATE = "1970-01-01T00:00:00Z"  # fixed, so that reruns write the same bytes

MANIFEST = "shard long, file string, records long, bytes long, sha256 string"
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, url string, payload binary")


def _marked(pages: DataFrame) -> DataFrame:
    """(page, url, payload, digest, size)"""
    payload = F.coalesce(F.encode(F.col("html").cast("string"), "UTF-8"), F.lit(b""))
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(NO_ID)).alias("page"),
                        F.col("url").cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})


def _decisions(light: DataFrame) -> DataFrame:
    """(page, digest, response) of the rows whose payload is shared, from `light` rows without payloads."""
    shared = light.where(F.col("size") >= MIN_REVISIT).groupBy("digest").agg(
        F.max("page").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n")
    return light.select("page", "digest").distinct().join(shared, "digest").select("page", "digest", "response")


def _shards(light: DataFrame) -> list[tuple[int, str]]:
    """The first (page, digest) of each shard: about equal bytes, fixed by the data alone.

    Rows are range-sorted and their sizes added up task by task, so neither null ids, which all sort
    as one, nor outliers crowd a shard: equal ids are cut between digests.
    """
    order = ["page", "digest"]
    rows = stored(light.select("page", "digest", "size").repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("slot", F.monotonically_increasing_id()), "page-sizes")
    rows = rows.withColumn("task", F.shiftright("slot", 33))
    tasks = rows.groupBy("task").agg(F.sum("size").alias("bytes")).withColumn("before", F.expr(
        "coalesce(sum(bytes) over (order by task rows between unbounded preceding and 1 preceding), 0)"))
    total = tasks.agg(F.sum("bytes")).first()[0] or 0
    shard = max(SHARD_BYTES, -(-total // MAX_SHARDS))
    within = F.expr("sum(size) over (partition by task order by slot) - size")
    at = rows.withColumn("within", within).join(tasks.select("task", "before"), "task").select(
        F.floor((F.col("before") + F.col("within")) / shard).alias("shard"), "page", "digest")
    firsts = at.groupBy("shard").agg(F.min(F.struct("page", "digest")).alias("first")).orderBy("shard").collect()
    return [(r["first"].page, r["first"].digest) for r in firsts]


def _shard_of(firsts: list[tuple[int, str]]) -> Column:
    @F.pandas_udf("long")
    def place(page: pd.Series, digest: pd.Series) -> pd.Series:
        return pd.Series([max(0, bisect_right(firsts, key) - 1) for key in zip(page, digest)], dtype="int64")

    return place("page", "digest")


def _record(row: dict) -> bytes:
    """One gzip member with a WARC response or revisit record."""
    page, response = ("" if p in (None, NO_ID) else str(p) for p in (row["page"], row["response"]))
    revisit = row["kind"] == "revisit"
    body = b"" if revisit else row["payload"]
    ident = lambda p: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{p}:{row['digest']}')}>"
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"
    block = http + body
    headers = [("WARC-Type", row["kind"]), ("WARC-Record-ID", ident(page)), ("WARC-Date", DATE),
               ("WARC-Target-URI", (row["url"] or "").replace("\r", "%0D").replace("\n", "%0A")),
               ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", f"sha1:{digest}"),
               ("WARC-Block-Digest", f"sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}"),
               ("X-Page-Id", page), ("X-Payload-Length", str(row["size"])),
               ("Content-Length", str(len(block)))]
    if revisit:
        headers[5:5] = [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ("WARC-Refers-To", ident(response)), ("X-Refers-To-Page-Id", response)]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if re.match(r"\w+:", folder) else (fs.LocalFileSystem(), folder)


class _Roller:
    """Writes one shard's records to files that are renamed when they are whole."""

    def __init__(self, folder: str, roll: int):
        self.files, self.path = _file_system(folder)
        self.roll, self.attempt = roll, uuid.uuid4().hex
        self.files.create_dir(f"{self.path}/_temporary", recursive=True)
        self.shard, self.number, self.out = None, 0, None

    def add(self, shard: int, record: bytes) -> Iterator[tuple]:
        if shard != self.shard:
            yield from self.close()
            self.shard, self.number = shard, 0
        if self.out is None:
            self.name = f"shard-{shard:06d}-{self.number:05d}.warc.gz"
            self.temporary = f"{self.path}/_temporary/{self.attempt}-{self.name}"
            self.out = self.files.open_output_stream(self.temporary, compression=None)
            self.records, self.bytes, self.sum = 0, 0, hashlib.sha256()
        self.out.write(record)
        self.records += 1
        self.bytes += len(record)
        self.sum.update(record)
        if self.bytes >= self.roll:
            yield from self.close()

    def close(self) -> Iterator[tuple]:
        if self.out is not None:
            self.out.close()
            self.files.move(self.temporary, f"{self.path}/{self.name}")
            yield self.shard, self.name, self.records, self.bytes, self.sum.hexdigest()
            self.number, self.out = self.number + 1, None


def write(pages: DataFrame, folder: str, roll: int = ROLL_BYTES) -> DataFrame:
    """Write `pages` (page_id, url, html) as WARC files into `folder`; returns the manifest.

    Records are sorted by page id and digest within shards, which are ranges of these that hold about equal
    bytes; both are fixed by the data, so a rerun or a repeated task writes the same bytes under the same
    names. A file appears by a rename when it is whole. The manifest is written last, by all tasks, and
    committed as one; files it does not list do not count.
    Of equal payloads of MIN_REVISIT bytes or more the largest page id is the response, the others
    revisit it; among rows that repeat both id and payload one is the response. Which they are is found on ids,
    digests and sizes alone and sent along as short rows, so payloads are shuffled once.
    A null html is an empty payload, a null id is written as an empty page id and sorts first. An empty table gives
    an empty manifest. Other columns are not read. A long html is one record, in memory as a whole.
    `folder` must be a place that pyarrow's file systems and Spark both reach.
    """
    rows = _marked(pages)
    light = stored(rows.select("page", "digest", "size"), "page-digests")
    heavy = rows.select("page", "digest", F.lit(1).alias("kind"), "url", "size", "payload", F.lit(None).cast("long").alias("response"))
    told = _decisions(light).select("page", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"),
                                    F.lit(None).cast("long").alias("size"), F.lit(None).cast("binary").alias("payload"), "response")
    firsts = _shards(light)
    joined = heavy.unionByName(told).withColumn("shard", _shard_of(firsts))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, last, shared = _Roller(folder, roll), None, (None, None, None)
        found: list[tuple] = []
        for batch in batches:
            for row in batch.to_pylist():
                key = row["page"], row["digest"]
                if row["kind"] == 0:  # what was decided for the rows of this key, which follow
                    shared = *key, row["response"]
                    continue
                row["response"] = shared[2] if key == shared[:2] else None
                # Rows that repeat the response itself come right after it.
                revisit = row["response"] is not None and (row["response"] != row["page"] or key == last)
                last = key
                found.extend(roller.add(row["shard"], _record(row | {"kind": "revisit" if revisit else "response"})))
        found.extend(roller.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[i] for f in found], t) for i, t in enumerate(
                (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
            names=["shard", "file", "records", "bytes", "sha256"])

    done = joined.repartition(max(1, len(firsts)), "shard").sortWithinPartitions("shard", "page", "digest", "kind", "url").mapInArrow(emit, MANIFEST)
    done.write.mode("overwrite").json(f"{folder}/_manifest")
    files, path = _file_system(folder)
    with contextlib.suppress(FileNotFoundError):  # what attempts that failed have left
        files.delete_dir(f"{path}/_temporary")
    return pages.sparkSession.read.schema(MANIFEST).json(f"{folder}/_manifest")


def _members(stream, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The gzip members of a stream, unpacked one after the other."""
    data, reader, out = b"", zlib.decompressobj(31), []
    while data or (data := stream.read(chunk)):
        out.append(reader.decompress(data))
        data = reader.unused_data
        if reader.eof:
            yield b"".join(out)
            reader, out = zlib.decompressobj(31), []
    if out:
        raise ValueError("the file ends inside a record")


def parse(stream) -> Iterator[dict]:
    """The records of one archive file, responses checked against their payload digests."""
    for record in _members(stream):
        head, _, rest = record.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
        wanted = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
        kind = fields["WARC-Type"]
        if kind == "response" and hashlib.sha1(payload).hexdigest() != wanted:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
        number = lambda name: int(fields[name]) if fields.get(name) else None
        yield {"page_id": number("X-Page-Id"), "payload_bytes": int(fields["X-Payload-Length"]),
               "payload_digest": wanted, "record_type": kind, "refers_to": number("X-Refers-To-Page-Id"),
               "url": fields["WARC-Target-URI"], "payload": payload if kind == "response" else None}


def read(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files in the manifest of `folder`; a revisit has no payload of its own.

    Files are streamed, one task each. One that is missing or damaged ends the job.
    """
    manifest = spark.read.schema(MANIFEST).json(f"{folder}/_manifest")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                            ("payload", pa.binary())])
        files, base = _file_system(folder)
        for batch in batches:
            for row in batch.to_pylist():
                held, size, seen = [], 0, 0
                with files.open_input_stream(f"{base}/{row['file']}", compression=None) as stream:
                    for record in parse(stream):
                        seen += 1
                        if not payloads:
                            record["payload"] = None
                        held.append(record)
                        size += len(record["payload"] or b"") + 500
                        if size > 4 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if seen != row["records"]:
                    raise ValueError(f"{row['file']} has {seen} of {row['records']} records")
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    # A number of partitions is given so that adaptive execution doesn't merge the short list.
    return manifest.select("file", "records").repartition(max(1, manifest.count()), "file").mapInArrow(records, RECORD)


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """`pages` written to `folder` and read back, without payloads."""
    write(pages, folder)
    return read(pages.sparkSession, folder, payloads=False).drop("url", "payload")
