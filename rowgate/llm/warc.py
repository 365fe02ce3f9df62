"""WARC archives, dictionary-compressed, written and read by Spark tasks.

A Zstandard dictionary is built from a bounded random sample of records over the whole table.  Every archive
begins with a skippable frame that holds it, and each record is a frame of its
own, so any record can be read with the dictionary alone.

Of pages with equal payloads the one with the largest page_id is a ``response``
record and the others ``revisit`` records that refer to it (pages that are equal in
id as well are all responses).  Payloads below ``min_bytes`` are always responses.

Tasks write an archive under a name of their own and rename it when it is
complete, to a name that follows from the partition, so a task that runs again
replaces its archives.  The folder may be any that Spark and pyarrow both reach
(file, hdfs, s3, gs); it must be shared by all executors.

Null html is an empty payload.  A null page_id counts as smaller than any other; a
null url is written as ``urn:page``; white space in one is written, and read back, as ``%20``.
Ids are read back as ``read_archives``' ``id_type``.  An empty table writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The dictionary frame's magic number, and names of the WARC format.
MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

LEVEL = 3
ARCHIVE_BYTES = 16 << 20
SAMPLE_RECORDS, SAMPLE_BYTES, SAMPLE_SEED, DICTIONARY_BYTES = 1000, 8 << 20, 6, 64 << 10


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, revisit: bool, date: str) -> bytes:
    """One record with its header, HTTP block and trailing line ends."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = re.sub(r"\s", "%20", url) if url else "urn:page"
    head = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        head.append(("X-Page-Id", str(page_id)))
    if revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-Id", str(refers_to))]
    head.append(("Content-Length", str(len(block))))
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def dictionary(pages: DataFrame, date: str) -> bytes:
    """A dictionary from a random sample of all pages of up to SAMPLE_BYTES / 128: about
    SAMPLE_RECORDS records or SAMPLE_BYTES, whichever is less (all, if they are fewer)."""
    import zstandard

    length = F.coalesce(F.octet_length("html"), F.lit(0))
    small = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).where(length <= SAMPLE_BYTES // 128)
    n, size = small.agg(F.count(F.lit(1)), F.sum(length)).first()
    share = min(1.0, SAMPLE_RECORDS / max(n, 1), SAMPLE_BYTES / max(size or 0, 1))
    drawn = small.where(F.rand(SAMPLE_SEED) < share) if share < 1 else small
    payloads = [(r, (r[2] or "").encode()) for r in drawn.collect()]
    samples = [record(r[0], r[1], payload, base32_sha1(payload), None, False, date) for r, payload in payloads]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few records to train on: their bytes are the dictionary
        return b"".join(samples)[-DICTIONARY_BYTES:]


class _Writer:
    def __init__(self, folder: str, words: bytes, date: str, most: int):
        self.folder, self.words, self.date, self.most = folder, words, date, most

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyarrow import fs
        from pyspark import TaskContext

        where, root = fs.FileSystem.from_uri(self.folder)
        context = TaskContext.get()
        kind = zstandard.ZstdCompressionDict(self.words) if self.words else None
        if kind is not None:
            kind.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=kind)
        lead = struct.pack("<II", MAGIC, len(self.words)) + self.words
        held, size, number, done = [], 0, 0, []

        def flush():
            nonlocal held, size, number
            name = f"{context.partitionId():06d}-{number:05d}.warc.zst"
            temporary = f"{root}/{name}.{context.taskAttemptId()}.open"
            with where.open_output_stream(temporary) as f:
                f.write(lead)
                for h in held:
                    f.write(h)
            where.move(temporary, f"{root}/{name}")
            done.append((name, len(held), size + len(lead)))
            held, size, number = [], 0, number + 1

        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("page_id", "url", "digest", "keep", "revisit")}
            payloads = batch.column("html").cast(pa.binary()).to_pylist()
            for i, payload in enumerate(payloads):
                digest = base64.b32encode(bytes.fromhex(cols["digest"][i])).decode()
                frame = press.compress(record(cols["page_id"][i], cols["url"][i], payload or b"", digest, cols["keep"][i], cols["revisit"][i], self.date))
                held.append(frame)
                size += len(frame)
                if size >= self.most:
                    flush()
        if held:
            flush()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.string(), pa.int64(), pa.int64()))], names=["archive", "records", "bytes"])


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives into ``folder``; returns the
    manifest (archive, records, bytes)."""
    from pyarrow import fs

    spark = pages.sparkSession
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("digest", F.sha1("html"))
    shared = (
        rows.where(F.octet_length("html") >= min_bytes).groupBy("digest").agg(F.max("page_id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("digest", "keep", F.lit(True).alias("shared"))
    )
    marked = rows.join(shared, "digest", "left").withColumn("revisit", F.coalesce(F.col("shared") & ~F.col("page_id").eqNullSafe(F.col("keep")), F.lit(False)))
    where, root = fs.FileSystem.from_uri(f"{folder}/archives")
    where.create_dir(root, recursive=True)
    writer = _Writer(f"{folder}/archives", dictionary(pages, date), date, archive_bytes)
    made = marked.select("page_id", "url", "html", "digest", "keep", "revisit").mapInArrow(writer, "archive string, records long, bytes long")
    made.write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema("archive string, records long, bytes long").parquet(f"{folder}/manifest")


def records(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, payload) of each record of one archive; the payload's digest is checked."""
    import zstandard

    magic, size = struct.unpack_from("<II", archive)
    if magic != MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    words = archive[8: 8 + size]
    press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)
    source = io.BytesIO(archive)
    source.seek(8 + size)
    stream = io.BufferedReader(press.stream_reader(source, read_across_frames=True), 1 << 20)
    while True:
        line = stream.readline()
        if not line:
            return
        if line != VERSION:
            raise ValueError(f"no record where one should begin: {line[:40]!r}")
        head = {}
        while (line := stream.readline()) != b"\r\n":
            name, _, value = line.decode().partition(":")
            head[name] = value.strip()
        block = stream.read(int(head["Content-Length"]))
        stream.read(4)
        payload = block.partition(b"\r\n\r\n")[2]
        if head["WARC-Type"] == "response" and head["WARC-Payload-Digest"] != f"sha1:{base32_sha1(payload)}":
            raise ValueError(f"digest of {head['WARC-Record-ID']} does not fit")
        yield head, payload


class _Reader:
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = []
                for head, payload in records(content):
                    response = head["WARC-Type"] == "response"
                    rows.append((
                        head.get("X-Page-Id"), head["WARC-Target-URI"], head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:"),
                        len(payload) if response else int(head["X-Payload-Length"]), head.get("X-Refers-To-Page-Id"), payload.decode() if response else None,
                    ))
                    if len(rows) == 1000:
                        yield self._rows(rows)
                        rows = []
                if rows:
                    yield self._rows(rows)

    @staticmethod
    def _rows(rows):
        kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "html"])


def read_archives(spark: SparkSession, folder: str, id_type: str = "long") -> DataFrame:
    """Records of the archives in ``folder``: page_id, url, record_type, payload_digest,
    payload_bytes, refers_to, html (null for revisits)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(f"{folder}/archives").select("content")
    schema = "page_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string, html string"
    back = files.mapInArrow(_Reader(), schema)
    return back.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
