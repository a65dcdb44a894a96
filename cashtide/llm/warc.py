"""WARC archives: written as one gzip member per record, read back by byte ranges.

The reader is splittable although gzip is not.  A task gets a byte range of an archive and looks for
the gzip magic; a candidate counts only if it decompresses to a WARC record header, so chance
occurrences inside compressed data are passed over.  A task owns the records that start inside its
range and reads past its end to finish the last one.  A record that was found is decompressed to its
end (which checks its CRC), and the search goes on behind it.

Storage is reached with pyarrow file systems, which open local, HDFS and object-store addresses on
the executors.  Every attempt of a writing task makes files of its own name, and only files that a
finished task has listed are read, so lost executors and repeated attempts leave no half archives in
the result.

Defined cases: a null payload is an empty one; rows that share the largest id of their group are all
responses; a null id comes before every other; control characters and blanks in addresses are
percent-encoded; an empty table gives no archive and an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashtide.sources.workspace import materialize, new_path

MAGIC = b"\x1f\x8b\x08"
READ_BYTES = 1 << 18
ARCHIVE_BYTES = 256_000_000
SPLIT_BYTES = 8_000_000
REVISIT_FROM = 1_000  # payload bytes from which an equal payload is stored only once
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
WRITTEN = "path string, bytes long, records long"
READ = (
    "path string, offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def classified(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """Adds payload_digest, payload_bytes, record_type and refers_to to every row.

    Only digests that occur more than once among the large payloads are joined back; the join is an
    equi-join without a hint, so the planner picks its kind and splits a hot digest.
    """
    whole = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(key).alias("page_id"),
        F.col("url") if "url" in pages.columns else F.lit(None).cast("string").alias("url"),
        whole.alias("payload"),
        F.sha1(whole.cast("binary")).alias("payload_digest"),
        F.octet_length(whole).cast("long").alias("payload_bytes"),
    )
    shared = (
        rows.where(F.col("payload_bytes") >= REVISIT_FROM)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.count(F.lit(1)).alias("_copies"), F.max("page_id").alias("_first"))
        .where("_copies > 1")
    )
    joined = rows.join(shared, F.col("payload_digest") == F.col("_digest"), "left")
    is_revisit = F.col("_digest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        "payload_digest",
        "payload_bytes",
        F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(is_revisit, F.col("_first")).alias("refers_to"),
    )


def record(row, date: str) -> bytes:
    """One WARC record as a gzip member."""
    revisit = row.record_type == "revisit"
    block = b"" if revisit else HTTP + row.payload.encode()
    digest = base64.b32encode(bytes.fromhex(row.payload_digest)).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {row.record_type}",
        f"WARC-Record-ID: <urn:page:{row.page_id or ''}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {row.payload_bytes}",
    ]
    if row.url:
        head.append("WARC-Target-URI: " + quote(row.url, safe="".join(map(chr, range(0x21, 0x7F)))))
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{row.refers_to or ''}>", f"WARC-Profile: {PROFILE}"]
    else:
        head.append("Content-Type: application/http;msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def write_archives(
    records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Writes the rows of ``classified``; returns the stored list of archives (path, bytes, records)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        done, out, size, count, name = [], None, 0, 0, ""

        def close():
            out.close()
            done.append((f"{folder}/{name}", size, count))

        for batch in batches:
            batch["page_id"] = batch["page_id"].astype(object).where(batch["page_id"].notna(), None)
            for row in batch.itertuples(index=False):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                member = record(row, date)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= archive_bytes:
                    close()
                    out = None
        if out is not None:
            close()
        yield pd.DataFrame(done, columns=["path", "bytes", "records"])

    text = records.withColumns({c: F.col(c).cast("string") for c in ("page_id", "refers_to")})
    return materialize(text.mapInPandas(write, WRITTEN), "archives")


class _Window:
    """The bytes of a file from a moving position on."""

    def __init__(self, file, start: int):
        self.file, self.base, self.data = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        block = self.file.read(READ_BYTES)
        self.data += block
        return bool(block)

    def drop(self, to: int) -> None:
        self.data = self.data[to - self.base :]
        self.base = to


def scan(file, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of the gzip members with a WARC header that start in [start, end)."""
    window, at = _Window(file, start), start
    while at < end:
        found = window.data.find(MAGIC, at - window.base)
        if found < 0:
            window.drop(max(at, window.base + len(window.data) - len(MAGIC) + 1))
            at = window.base
            if not window.more():
                return
            continue
        at = window.base + found
        if at >= end:
            return
        window.drop(at)
        member = _member(window)
        if member is None:
            at += 1
        else:
            yield at, member[0]
            at += member[1]


def _member(window: _Window) -> tuple[bytes, int] | None:
    """The record at the window's start and its compressed size; None if no record starts here."""
    unpack, parts, used, got = zlib.decompressobj(31), [], 0, 0
    while True:
        block = window.data[used : used + READ_BYTES]
        if not block and not window.more():
            if got >= 5:
                raise ValueError("an archive ends inside a record")
            return None
        if not block:
            continue
        try:
            parts.append(unpack.decompress(block))
        except zlib.error:
            if got >= 5:
                raise
            return None
        got += len(parts[-1])
        if got >= 5 and got - len(parts[-1]) < 5 and not b"".join(parts).startswith(b"WARC/"):
            return None
        used += len(block) - len(unpack.unused_data)
        if unpack.eof:
            return (b"".join(parts), used) if got >= 5 else None


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (lower-case names) and payload; the HTTP header of a response is taken off."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    length = int(fields["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the record {fields.get('warc-record-id')} has another length than its header says")
    block = rest[:length]
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return fields, block


def read_archives(spark: SparkSession, archives: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """One row per record of the listed archives (path, bytes), read by byte ranges.

    A response whose payload does not have the digest of its header stops the job.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for batch in batches:
            for part in batch.itertuples(index=False):
                fs, path = _open(part.path)
                rows, size = [], 0
                with fs.open_input_file(path) as file:
                    for offset, member in scan(file, part.start, part.start + split_bytes):
                        fields, payload = parse(member)
                        kind, said = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                        digest = base64.b32decode(said).hex()
                        if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"{part.path} at {offset}: the payload has another digest")
                        number = len(payload) if kind == "response" else int(fields["x-payload-length"])
                        rows.append(
                            (part.path, offset, kind, fields["warc-record-id"], fields.get("warc-target-uri"),
                             fields.get("warc-refers-to"), digest, number, None if kind == "revisit" else payload)
                        )
                        size += len(payload)
                        if size >= split_bytes:
                            yield pd.DataFrame(rows, columns=names)
                            rows, size = [], 0
                yield pd.DataFrame(rows, columns=names)

    names = [x.strip().split(" ")[0] for x in READ.split(",")]
    ranges = archives.where("bytes > 0").select(
        "path", F.explode(F.expr(f"sequence(0L, bytes - 1, {split_bytes}L)")).alias("start")
    )
    count = archives.agg(F.sum(F.ceil(F.col("bytes") / split_bytes))).first()[0] or 1
    return ranges.repartition(int(min(count, 100_000))).mapInPandas(read, READ)


def page_number(record_id: str):
    """The id of the page in a record id; null where the page had none."""
    text = F.regexp_extract(F.col(record_id), "^<urn:page:(.*)>$", 1)
    return F.when(text != "", text)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Writes every page to archives and reads them back: one row per page."""
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType
    archives = write_archives(classified(pages), new_path(spark, "warc"))
    return read_archives(spark, archives).select(
        page_number("record_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_number("refers_to").cast(kind).alias("refers_to"),
    )


ARCHIVED_SQL = f"""
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), shared AS (
    SELECT payload_digest, max(page_id) AS first FROM p WHERE payload_bytes >= {REVISIT_FROM} GROUP BY 1 HAVING count(*) > 1
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN shared USING (payload_digest)
"""
