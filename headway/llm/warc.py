"""WARC archives: one gzip member per record, written and read back in Spark tasks.

Archives lie below the shared folder and are written through pyarrow's file systems, so
the folder may be local in tests and remote on a cluster. An archive is written under a
name of its own attempt, and the records of an attempt that Spark has accepted are those
of the manifest it returns, so lost or repeated tasks leave no record twice.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import keep
from headway.session import shared_folder

ARCHIVE_BYTES = 32 << 20
READ_BYTES = 256 << 10
NAMED = "<urn:page:"
DATE = "1970-01-01T00:00:00Z"  # records are dated alike, so equal input gives equal bytes
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary, archive string"
)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, kind: str, size: int, digest: str, refers: int | None, block: bytes) -> bytes:
    """One record as a gzip member of its own. A revisit carries no payload, but its size and digest."""
    # a page without an id has a name of its own, which says nothing of its page
    name = lambda i: f"<urn:uuid:{uuid.uuid4()}>" if i is None else f"{NAMED}{i}>"
    target = "".join(c for c in url or "" if c > " ")
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{payload_digest(block)}",
        f"X-Payload-Length: {size}", f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {target}")
    if refers is not None:
        head += [f"WARC-Refers-To: {name(refers)}", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    return packer.compress(raw) + packer.flush()


class RecordReader:
    """Records of one archive from its bytes, chunk by chunk."""

    def __init__(self) -> None:
        self._start()

    def _start(self) -> None:
        self.unzip, self.plain = zlib.decompressobj(31), bytearray()

    def feed(self, chunk: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        while chunk:
            self.plain += self.unzip.decompress(chunk)
            if not self.unzip.eof:
                return
            chunk = self.unzip.unused_data
            yield parsed(bytes(self.plain))
            self._start()

    def close(self) -> None:
        if self.plain:
            raise ValueError("the archive ends within a record")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record, framed by its content length and checked by its digests."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != "WARC/1.1":
        raise ValueError("no record header")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError("the block differs from its content length")
    if fields["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError("the block differs from its digest")
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != f"sha1:{payload_digest(block)}":
        raise ValueError("the payload differs from its digest")
    return fields, block


def with_roles(pages: DataFrame, html: str = "html", least: int = 0) -> DataFrame:
    """Payload, size, digest and the page that each page revisits, if any.

    Of equal payloads of at least `least` bytes the largest page id is the response. Only
    digests are grouped: equal ones count as equal payloads. Rows that repeat a page id and
    its payload are records of the same page, and all of them responses or revisits alike.
    """
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    sized = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")}
    )
    equal = sized.filter(F.col("payload_bytes") >= least).groupBy("sha1").agg(
        F.max("page_id").alias("response"), F.count("*").alias("n")
    )
    # kept first, so the join sees its true size: sent to all if small, else a plain join
    # of two shuffled sides, whose large partitions Spark splits
    equal = keep(equal.filter("n > 1").drop("n"), "equal-payloads")
    joined = sized.join(equal, "sha1", "left")
    # a page without an id is no response while one with an id is
    other = F.col("page_id").isNull() | (F.col("response") != F.col("page_id"))
    refers = F.when(other, F.col("response"))
    return joined.withColumn("refers_to", refers).drop("response", "sha1")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives below `folder`; returns their manifest, kept: path and number of records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, path, n, size = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.record_batch([[path], pa.array([n], pa.int64())], names=["archive", "records"])

        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    path, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{path}", compression=None)
                payload, refers = row["payload"], row["refers_to"]
                packed = record(
                    row["page_id"], row["url"], "response" if refers is None else "revisit",
                    len(payload), payload_digest(payload), refers, payload if refers is None else b"",
                )
                out.write(packed)
                n, size = n + 1, size + len(packed)
                if size >= archive_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    rows = pages.select("page_id", "url", "refers_to", "payload")
    return keep(rows.mapInArrow(run, "archive string, records long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives in `manifest`, each archive read in order by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload", pa.binary()), ("archive", pa.string()),
        ])
        number = lambda text: int(text[len(NAMED) : -1]) if text and text.startswith(NAMED) else None
        for batch in batches:
            for row in batch.to_pylist():
                reader, records = RecordReader(), 0
                with store.open_input_stream(f"{root}/{row['archive']}", compression=None) as file:
                    while chunk := file.read(READ_BYTES):
                        for fields, block in reader.feed(chunk):
                            records += 1
                            found = {
                                "page_id": number(fields["WARC-Record-ID"]),
                                "url": fields.get("WARC-Target-URI"),
                                "payload_bytes": int(fields["X-Payload-Length"]),
                                "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                "record_type": fields["WARC-Type"],
                                "refers_to": number(fields.get("WARC-Refers-To")),
                                "payload": block,
                                "archive": row["archive"],
                            }
                            yield pa.RecordBatch.from_pylist([found], schema)
                reader.close()
                if records != row["records"]:
                    raise ValueError(f"{row['archive']} holds {records} records, not {row['records']}")

    archives = manifest.repartition(max(1, manifest.count()), "archive")
    return archives.mapInArrow(run, RECORDS)


def archived(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record for every page and read all of them back.

    A null html is an empty payload, equal to every other empty one. A page without an id is
    a revisit of the largest id with its payload, or a response if no page with an id has it.
    Repeated rows give one record each; an empty table gives none.
    """
    spark = pages.sparkSession
    folder = shared_folder(spark, "warc")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    return read_archives(write_archives(with_roles(pages), folder, archive_bytes), folder)
