"""Web archives: writing pages as WARC records, and reading archives record by record.

Archives are real `.warc` data: one gzip member per record, an empty member between records (the
line separator of Spark's text writer, which writes the files). Files are cut by size, so a reader
never holds more than one archive. The reader inflates a member in bounded steps, frames the record
by its Content-Length and checks its digests.

Equal payloads are found on digests alone: one row per digest after a map-side count, joined back to
the pages, where a hot payload's rows can be split by adaptive execution.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerbench.session import shared_dir

VERSION = b"WARC/1.1"
SHORT_PAYLOAD = 100  # bytes below which a payload is written again rather than referred to
ARCHIVE_BYTES = 32 << 20
STEP = 1 << 16
PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"  # pages carry no date
ID_PREFIX = "urn:x-page:"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
READ_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record. The block is an HTTP response; a revisit's has the headers only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    own = "" if page_id is None else page_id
    head = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<{ID_PREFIX}{own}>",
        "WARC-Date": DATE,
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "Content-Length": str(len(block)),
    }
    if url is not None:
        head["WARC-Target-URI"] = quote(url, safe="!#$&'()*+,/:;=?@[]~%")
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<{ID_PREFIX}{refers_to}>", "WARC-Profile": PROFILE}
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in head.items())]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


class RecordReader:
    """Records of one archive in their order: (headers, block) of each gzip member."""

    def __init__(self, data: bytes):
        self.data = memoryview(data)

    def members(self) -> Iterator[bytes]:
        at = 0
        while at < len(self.data):
            inflate, out = zlib.decompressobj(31), bytearray()
            while not inflate.eof:
                if at >= len(self.data):
                    raise ValueError("an archive ends inside a member")
                step = self.data[at : at + STEP]
                out += inflate.decompress(step)
                at += len(step) - len(inflate.unused_data)
            if out:
                yield bytes(out)

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes]]:
        for member in self.members():
            head, gap, rest = member.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            if not gap or lines[0] != VERSION:
                raise ValueError("a member is no record of this version")
            fields = dict(x.decode().split(": ", 1) for x in lines[1:])
            n = int(fields["Content-Length"])
            if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
                raise ValueError(f"a record's block isn't {n} bytes long")
            block = rest[:n]
            if fields["WARC-Block-Digest"] != f"sha256:{hashlib.sha256(block).hexdigest()}":
                raise ValueError("a block doesn't match its digest")
            yield fields, block


def _page(field: str | None) -> int | None:
    own = field.removeprefix(f"<{ID_PREFIX}").removesuffix(">") if field else ""
    return int(own) if own else None


def read_record(fields: dict[str, str], block: bytes) -> tuple:
    """The row of a record; a response's payload is checked against its digest."""
    http, _, payload = block.partition(b"\r\n\r\n")
    n = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    whole = fields["WARC-Type"] == "response"
    if whole and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError("a payload doesn't match its digest")
    return (
        _page(fields["WARC-Record-ID"]),
        fields.get("WARC-Target-URI"),
        n,
        digest,
        fields["WARC-Type"],
        _page(fields.get("WARC-Refers-To")),
        payload if whole else None,
    )


def with_originals(pages: DataFrame) -> DataFrame:
    """Adds digest, and first_id: the smallest page id with the same payload, where that is long enough.

    A row with that id is a response, so rows that repeat it are responses too; a null id never is
    the first.
    """
    hashed = pages.withColumn("digest", F.sha2(F.col("html"), 256))
    groups = (
        pages.filter(F.octet_length("html") >= SHORT_PAYLOAD)
        .select(F.sha2("html", 256).alias("_digest"), "page_id")
        .groupBy("_digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    return hashed.join(groups, F.col("digest") == F.col("_digest"), "left").drop("_digest")


def write_archives(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """A record per row, in archives of about `archive_bytes` (one record more at most).

    Null html is an empty payload, a null url has no target, a null id an empty record id. An empty
    table writes no record. Other columns are ignored.
    """
    rows = with_originals(
        pages.select(
            F.col(id_col).cast("long").alias("page_id"),
            F.col(url_col).alias("url"),
            F.coalesce(F.col(html_col), F.lit("")).alias("html"),
        )
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    # Ids travel as text: pandas has no integer column with nulls.
    rows = rows.select(
        F.col("page_id").cast("string").alias("page_id"),
        "url",
        "html",
        "digest",
        F.when(revisit, F.col("first_id")).cast("string").alias("refers_to"),
    )

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, k, filled = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            names, out = [], []
            for page_id, url, html, digest, refers_to in batch.itertuples(index=False, name=None):
                ids = [None if x is None else int(x) for x in (page_id, refers_to)]
                data = gzip.compress(record(ids[0], url, html.encode(), digest, ids[1]), 6, mtime=0)
                if filled + len(data) > archive_bytes and filled:
                    k, filled = k + 1, 0
                filled += len(data)
                names.append(f"{part:06d}-{k:06d}")
                out.append(data)
            yield pd.DataFrame({"archive": names, "member": out})

    (
        rows.mapInPandas(members, "archive string, member binary")
        .withColumn("member", F.col("member").cast("string"))
        .write.partitionBy("archive")
        .option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .text(path)
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: the columns of READ_SCHEMA; payload is null for a revisit.

    A record that fails its framing or a digest ends the run with an error.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        for batch in batches:
            for content in batch["content"]:
                out, held = [], 0
                for fields, block in RecordReader(content):
                    out.append(read_record(fields, block))
                    held += len(block)
                    if held > ARCHIVE_BYTES // 4:
                        yield _frame(out, names)
                        out, held = [], 0
                yield _frame(out, names)

    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "part-*")
        .load(path)
        .select("content")
        .mapInPandas(rows, READ_SCHEMA)
    )


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names, dtype=object)
    return out.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})


def round_trip(pages: DataFrame, **columns: str) -> DataFrame:
    """Writes archives to a fresh folder of the shared folder, and reads them."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc/{uuid.uuid4().hex}"
    write_archives(pages, path, **columns)
    return read_archives(spark, path)
