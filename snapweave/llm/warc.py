"""WARC archives as a chunked record table.

Payloads move as rows of (record, chunk number, bytes): a payload of any size is
many bounded rows, a writer task streams them into a gzip member, and a reader
task streams them out again, each chunk with the running digest and length so
far.  No step after the source row holds a whole record.

Of records with equal payloads of at least ``min_revisit`` bytes, those with the
largest page id are responses and the others are revisits that refer to it.
Payloads move in one shuffle by record; the decision travels in front of the
chunks as chunk -1, so no join carries payloads and a hot payload is spread over
its records.

Defined results: a null payload is empty; a null page id is smaller than any
other; repeated rows of the largest page id are all responses; a null URL has no
target header; an empty table writes no archive and reads as an empty table;
other columns do not matter.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import quoted, staged
from .files import committed, new_folder, open_folder, partition_number


@dataclass(frozen=True)
class WarcParams:
    min_revisit: int = 0
    chunk_bytes: int = 1 << 20
    max_file_bytes: int = 1 << 30   # of packed bytes, at record ends
    level: int = 1


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode("ascii")


def _records(pages: DataFrame, page_id: str, url: str, payload: str) -> DataFrame:
    body = F.coalesce(F.col(quoted(payload)).cast("binary"), F.lit(b""))
    # numbered at the scan, before any shuffle, so a repeated task numbers alike
    return pages.select(F.monotonically_increasing_id().alias("record"), F.col(quoted(page_id)).cast("long").alias("page_id"),
                        F.col(quoted(url)).alias("url"), body.alias("body"))


def _decisions(records: DataFrame, p: WarcParams) -> DataFrame:
    """``record, page_id, url, digest, bytes, refers_to``: a revisit has ``refers_to``."""
    narrow = records.select("record", "page_id", "url", F.sha1("body").alias("digest"),
                            F.octet_length("body").cast("long").alias("bytes"))
    # staged, so that the join reads two plain exchanges and a hot payload's rows can be split
    keeper = staged(narrow.groupBy("digest", "bytes").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
                    .where("n > 1").drop("n"), "warc-keepers")
    decided = narrow.join(keeper, ["digest", "bytes"], "left")
    revisit = (F.col("bytes") >= p.min_revisit) & ~F.col("page_id").eqNullSafe(F.col("keeper"))
    return decided.withColumn("refers_to", F.when(revisit, F.col("keeper")))


def chunk_rows(records: DataFrame, p: WarcParams) -> DataFrame:
    """``record, chunk, data`` of every payload."""
    last = F.floor(F.greatest(F.octet_length("body") - 1, F.lit(0)) / p.chunk_bytes).cast("int")
    numbered = records.select("record", "body", F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    return numbered.select("record", "chunk", F.substring("body", F.col("chunk") * p.chunk_bytes + 1,
                                                          F.lit(p.chunk_bytes)).alias("data"))


def _header(row: dict) -> bytes:
    revisit = row["refers_to"] is not None
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <urn:record:{row['record']}>", "WARC-Date: 1970-01-01T00:00:00Z"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + row["url"].replace("\r", "%0D").replace("\n", "%0A"))
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    lines += [f"WARC-Payload-Digest: sha1:{base32(bytes.fromhex(row['digest']))}", f"X-Payload-Length: {row['bytes']}"]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page: {row['refers_to']}"]
    lines.append(f"Content-Length: {0 if revisit else row['bytes']}")
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n"


def _writer(folder: str, p: WarcParams):
    class Member:
        """One record as one gzip member."""

        def __init__(self, out, row):
            self.out, self.row = out, row
            self.pack = zlib.compressobj(p.level, zlib.DEFLATED, 31)
            self.keep = row["refers_to"] is None
            out.write(self.pack.compress(_header(row)))

        def add(self, data):
            if self.keep:
                self.out.write(self.pack.compress(data))

        def end(self):
            self.out.write(self.pack.compress(b"\r\n\r\n"))
            self.out.write(self.pack.flush())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({k: batch.column(k)[i].as_py() for k in batch.schema.names}
                for batch in batches for i in range(batch.num_rows))
        row, number = next(rows, None), 0
        while row is not None:
            name, n = f"part-{partition_number():06d}-{number:04d}.warc.gz", 0
            with committed(folder, name) as out:
                while row is not None and (n == 0 or out.tell() < p.max_file_bytes):
                    member, record = Member(out, row), row["record"]
                    row = next(rows, None)
                    while row is not None and row["record"] == record:
                        member.add(row["data"])
                        row = next(rows, None)
                    member.end()
                    n += 1
            yield pa.RecordBatch.from_pydict({"file": [name], "records": pa.array([n], pa.int64())})
            number += 1
    return run


def write_archives(pages: DataFrame, params: WarcParams = WarcParams(), page_id: str = "page_id", url: str = "url",
                   payload: str = "html", folder: str | None = None) -> tuple[str, DataFrame]:
    """(folder, table of ``file, records``)."""
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    records = _records(pages, page_id, url, payload)
    heads = _decisions(records, params).select("record", F.lit(-1).alias("chunk"), F.lit(None).cast("binary").alias("data"),
                                               "page_id", "url", "digest", "bytes", "refers_to")
    bodies = chunk_rows(records, params)
    both = heads.unionByName(bodies, allowMissingColumns=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    streams = both.repartition(n, "record").sortWithinPartitions("record", "chunk")
    return folder, staged(streams.mapInArrow(_writer(folder, params), "file string, records long"), "warc-files")


READ = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()),
                  ("chunk", pa.int32()), ("data", pa.binary()), ("bytes_so_far", pa.int64()),
                  ("digest_so_far", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                  ("last", pa.bool_())])
BATCH = 1024


def read_records(source, chunk_bytes: int, with_data: bool) -> Iterator[tuple]:
    """Chunk rows of one archive, in file order; raises on a payload that differs from its digest."""
    while True:
        line = source.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        head = {}
        while (line := source.readline().rstrip(b"\r\n")):
            key, _, value = line.decode("utf-8").partition(": ")
            head[key] = value
        number = lambda key: int(head[key]) if key in head else None
        left, chunk, done, digest = int(head["Content-Length"]), 0, 0, hashlib.sha1()
        revisit = head["WARC-Type"] == "revisit"
        stated, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), number("X-Payload-Length")
        fixed = (number("X-Page-ID"), head["WARC-Type"], number("X-Refers-To-Page"), head.get("WARC-Target-URI"))
        while True:
            data = source.read(min(left, chunk_bytes))
            left -= len(data)
            done += len(data)
            digest.update(data)
            ends = left == 0
            if not data and not ends:
                raise ValueError("a record ends early")
            if ends and not revisit and (base32(digest.digest()) != stated or done != size):
                raise ValueError(f"payload of {head['WARC-Record-ID']} differs from its digest")
            if with_data or ends:
                yield (*fixed, chunk, data if with_data else None, done, base32(digest.copy().digest()), size, stated, ends)
            chunk += 1
            if ends:
                break
        if source.read(4) != b"\r\n\r\n":
            raise ValueError("a record does not end in two line ends")


def _reader(folder: str, p: WarcParams, with_data: bool):
    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), READ, strict=True)],
                                          schema=READ)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(folder)
        held, size = [], 0
        for batch in batches:
            for file in batch.column(0).to_pylist():
                with fs.open_input_stream(f"{path}/{file}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as source:
                    for row in read_records(source, p.chunk_bytes, with_data):
                        held.append(row)
                        size += len(row[5] or b"")
                        if len(held) >= BATCH or size >= 4 * p.chunk_bytes:
                            yield batch_of(held)
                            held, size = [], 0
        if held:
            yield batch_of(held)
    return run


def read_archives(spark: SparkSession, folder: str, files: DataFrame, params: WarcParams = WarcParams(),
                  with_data: bool = True) -> DataFrame:
    """The chunk table of the archives; without data only each record's last row."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = ("page_id long, record_type string, refers_to long, url string, chunk int, data binary, bytes_so_far long, "
             "digest_so_far string, payload_bytes long, payload_digest string, last boolean")
    return files.select("file").repartition(n, "file").mapInArrow(_reader(folder, params, with_data), kinds)


def round_trip(pages: DataFrame, params: WarcParams = WarcParams(), page_id: str = "page_id", url: str = "url",
               payload: str = "html") -> DataFrame:
    """Write the archives, read them back: one row per page."""
    folder, files = write_archives(pages, params, page_id, url, payload)
    rows = read_archives(pages.sparkSession, folder, files, params, with_data=False)
    return rows.where("last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
