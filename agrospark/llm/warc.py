"""WARC (10), index first: records at known places, then coalesced range reads.

Writing: every page becomes one record.  The first row (by page id) of a payload
of at least ``least`` bytes is a ``response``, equal ones are ``revisit`` records
without a payload; smaller payloads are always ``response``.  Records go to
archives by a hash of the page id.  Each record is a gzip member of its own, and an
archive is one output file of Spark's text writer: the writer's line separator is
the zero byte in which every member ends, so the file is a plain gzipped WARC file
(every record can be read alone) and a lost task is written again by the committer.
The place of each record is known before anything is written: compression is
deterministic, and an offset is the running sum of lengths within the archive.  The index (archive, offset,
length, URL, digest, page) is a table of its own and is written first.

Reading: the index rows of the selected records are sorted by archive and offset,
neighbours at most ``gap`` bytes apart become one byte-range read of at most
``most`` bytes (a longer record alone), and the records are cut out of it,
parsed and checked against their digest.

Defined results: null html is an empty payload; a null URL is an empty header
field; rows that repeat a page id with the same payload are the response and
revisits of it; a null id comes after all others; further columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import gzip
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import kept_in_table, scratch_path

END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"       # fixed, so that reruns write the same bytes
INDEX = ("archive", "offset", "length", "url", "digest", "page_id", "record_type", "refers_to")


def decided(pages: DataFrame, least: int) -> DataFrame:
    """One row per (page_id, digest): whether it holds the payload, or whose it is."""
    rows = pages.select("page_id", "digest", "payload_bytes")
    rows = kept_in_table(rows.groupBy("page_id", "digest", "payload_bytes").agg(F.count("*").alias("n")), "payloads")
    first = (rows.where(F.col("payload_bytes") >= least).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("rows")).where("rows > 1"))
    first = kept_in_table(first.select("digest", "first"), "first")
    # both sides are plain tables: a digest of very many pages is split by the skew join
    return rows.join(first, "digest", "left").select(
        "page_id", "digest", (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("again"),
        F.coalesce("first", "page_id").alias("first"))


def records(pages: DataFrame, archives: int, least: int) -> DataFrame:
    """Record text and index columns of each page."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
                        html.alias("html"), F.sha2(html.cast("binary"), 256).alias("digest"),
                        F.octet_length(html).cast("long").alias("payload_bytes"))
    told = kept_in_table(decided(rows, least), "decided")
    id_ = F.coalesce("page_id", F.lit(-1))
    archive = F.pmod(F.xxhash64(id_), F.lit(archives)).cast("int")
    # decisions travel as rows of their own, so that the pages are shuffled once, to
    # their archive, where a window hands them over
    # a null id is told from every number by a flag of its own
    no_id = F.col("page_id").isNull().alias("no_id")
    left = rows.withColumn("archive", archive).withColumn("k", id_).withColumn("no_id", no_id).withColumn("page", F.lit(1))
    right = told.select(F.pmod(F.xxhash64(id_), F.lit(archives)).cast("int").alias("archive"), id_.alias("k"), no_id,
                        "digest", "again", "first", F.lit(0).alias("page"))
    both = left.unionByName(right, allowMissingColumns=True).repartition(archives, "archive")
    same = Window.partitionBy("archive", "k", "no_id", "digest")
    # equal digests are equal payloads, so the order needs no html
    nth = F.row_number().over(same.orderBy(F.desc("page"), "url"))
    both = (both.withColumn("again", F.max("again").over(same) | ((nth > 1) & (F.col("payload_bytes") >= least)))
            .withColumn("first", F.max("first").over(same)).where("page = 1"))
    kind = F.when(F.col("again"), "revisit").otherwise("response")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", " ")), line("WARC-Date", F.lit(DATE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(F.col("again"), line("WARC-Refers-To", F.concat(
            F.lit("<urn:page:"), F.coalesce(F.col("first").cast("string"), F.lit("")), F.lit(">")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(F.col("again"), F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit("\r\n"))
    text = F.concat(header, F.when(F.col("again"), F.lit("")).otherwise(F.col("html")), F.lit(END))
    both = both.withColumn("record_type", kind).withColumn("refers_to", F.when(F.col("again"), F.col("first")))
    return both.select("archive", "k", "no_id", "again", *[c for c in INDEX if c not in ("archive", "offset", "length")], text.alias("text")).mapInArrow(
        _compressed, "archive int, k long, no_id boolean, again boolean, url string, digest string, page_id long, record_type string, "
                     "refers_to long, record binary, length long")


def member(record: bytes) -> bytes:
    """The record as gzip members that end in a zero byte: the last byte of a
    member is the top byte of its length, and an empty member follows a long one."""
    out = gzip.compress(record, 3, mtime=0)
    return out if not out[-1] else out + gzip.compress(b"", 3, mtime=0)


def _compressed(batches):
    for batch in batches:
        done = [member(x.as_py().encode("utf-8")) for x in batch.column("text")]
        at = batch.schema.get_field_index("text")
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:at], pa.array([x[:-1] for x in done], pa.binary()), pa.array([len(x) for x in done], pa.int64())],
            [*batch.schema.names[:at], "record", "length"])


def write_archives(pages: DataFrame, folder: str, target: int = 32 << 20, least: int = 100) -> DataFrame:
    """Writes ``folder/index`` and ``folder/archives``; returns the index."""
    size = pages.agg(F.sum(F.octet_length("html") + 600)).first()[0] or 0
    archives = max(16, -(-size // target))
    rows = records(pages, archives, least)
    # the order within an archive, the same for the index and the file
    order = ["k", "no_id", "digest", "again", "url"]
    at = Window.partitionBy("archive").orderBy(*order)
    offset = F.sum("length").over(at.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    placed = rows.withColumn("offset", offset)
    placed.select(*INDEX).write.parquet(f"{folder}/index")
    # each archive goes to one task, sorted as the offsets were; the writer keeps that order
    (rows.sortWithinPartitions("archive", *order).select("archive", F.col("record").cast("string").alias("text"))
     .write.partitionBy("archive").option("lineSep", "\0").text(f"{folder}/archives"))
    return pages.sparkSession.read.parquet(f"{folder}/index")


def archive_files(spark, folder: str) -> dict[int, str]:
    """The file of each archive (one row an archive, not a record)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/archives")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    out = {}
    for status in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/archives/archive=*/part-*")) or []:
        p = status.getPath()
        out[int(p.getParent().getName().split("=")[1])] = p.toString()
    return out


def parse(record: bytes) -> dict:
    """Header fields and payload of one record; the payload is checked."""
    head, _, rest = gzip.decompress(record).partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record starts here: {lines[0][:40]!r}")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    payload = rest[:int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].split(":")[1]
    if rest[len(payload):] != END.encode() or fields["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    number = lambda x: int(x[10:-1]) if len(x) > 11 else None  # noqa: E731  <urn:page:N>
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"],
            "payload_bytes": int(fields["X-Payload-Length"]), "payload_digest": digest, "record_type": fields["WARC-Type"],
            "refers_to": number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None,
            "payload": payload if fields["WARC-Type"] == "response" else None}


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def ranges(offsets, lengths, gap: int, most: int):
    """(first, last + 1) of the index rows that one read serves, in order."""
    i = 0
    while i < len(offsets):
        j, end = i + 1, offsets[i] + lengths[i]
        while j < len(offsets) and offsets[j] - end <= gap and offsets[j] + lengths[j] - offsets[i] <= most:
            end = max(end, offsets[j] + lengths[j])
            j += 1
        yield i, j
        i = j


def read_records(index: DataFrame, folder: str, gap: int = 64 << 10, most: int = 4 << 20, payload: bool = True) -> DataFrame:
    """The records of the given index rows, read by coalesced byte ranges."""
    spark = index.sparkSession
    files = archive_files(spark, folder)
    schema = READ if payload else READ.rpartition(",")[0]
    arrow = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:7 if payload else 6]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        from pyarrow import fs
        for batch in batches:
            archive = batch.column("archive").to_pylist()
            offset, length = batch.column("offset").to_pylist(), batch.column("length").to_pylist()
            lo = 0
            while lo < len(archive):
                hi = lo
                while hi < len(archive) and archive[hi] == archive[lo]:
                    hi += 1
                system, path = fs.FileSystem.from_uri(files[archive[lo]])
                with system.open_input_file(path) as f:
                    for i, j in ranges(offset[lo:hi], length[lo:hi], gap, most):
                        start = offset[lo + i]
                        blob = f.read_at(max(offset[x] + length[x] for x in range(lo + i, lo + j)) - start, start)
                        rows = [parse(blob[offset[x] - start:offset[x] - start + length[x]]) for x in range(lo + i, lo + j)]
                        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, arrow)], names)
                lo = hi

    parts = max(1, min(len(files), 10_000))
    sorted_ = index.select("archive", "offset", "length").repartition(parts, "archive").sortWithinPartitions("archive", "offset")
    return sorted_.mapInArrow(run, schema)


def round_trip(pages: DataFrame, least: int = 100) -> DataFrame:
    """Writes the archives of ``pages`` and reads every record back."""
    folder = scratch_path(pages.sparkSession, "warc")
    if folder.startswith("/"):
        folder = f"file://{folder}"
    index = write_archives(pages, folder, least=least)
    return read_records(index, folder, payload=False)
