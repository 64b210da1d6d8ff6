"""WARC archives: written as one gzip stream each, normalised to a member per record, and read back."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.tables import written
from tickloom.session import work_folder

#: Records of an archive are bounded by this many, and archives are sized for about so many bytes.
FILE_RECORDS, FILE_BYTES = 20_000, 8 << 20
READ_BYTES = 1 << 18
PAGE_URN = "urn:page:"
#: Digits of base 32 as Spark writes them, and those of the standard alphabet.
DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
END = b"\r\n\r\n"


def base32_sha1(value: Column) -> Column:
    """SHA-1 as bare upper-case base 32: 20 bits are five hexadecimal and four base-32 digits."""
    digits = F.sha1(value)
    groups = [F.lpad(F.conv(F.substring(digits, i, 5), 16, 32), 4, "0") for i in range(1, 41, 5)]
    return F.translate(F.concat(*groups), DIGITS, BASE32)


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)`` for every row.

    Of pages with equal payloads of at least ``least_bytes`` the one of the largest ``page_id`` is a
    response and the others revisit it; a smaller payload is always a response. A null ``html`` is an
    empty payload. A row without ``page_id`` is a response that nothing refers to, and rows that repeat
    the largest ``page_id`` are all responses.
    """
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        base32_sha1(payload.cast("binary")).alias("payload_digest"),
        F.sha2(payload.cast("binary"), 256).alias("__same"),
    )
    equal = rows.filter(F.col("payload_bytes") >= least_bytes).groupBy("__same")
    last = equal.agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    joined = rows.join(written(last, "repeated"), "__same", "left")
    revisits = F.col("page_id") < F.col("refers_to")
    return joined.select(
        *[c for c in rows.columns if c != "__same"],
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("refers_to")).alias("refers_to"),
    )


def warc_records(pages: DataFrame) -> DataFrame:
    """One WARC/1.1 record per row of ``with_revisits`` as text, without its last line feed.

    A revisit has the HTTP header alone; the header's length field keeps the size of the payload. A URL
    is cut at its first line break.
    """
    line = "\r\n"
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{line}Content-Type: text/html; charset=utf-8{line}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(line * 2),
    )
    is_revisit = F.col("record_type") == "revisit"
    block = F.concat(http, F.when(is_revisit, F.lit("")).otherwise(F.col("payload")))
    none = F.lit("")
    refers = F.concat(
        F.lit(f"WARC-Refers-To: <{PAGE_URN}"),
        F.col("refers_to").cast("string"),
        F.lit(f">{line}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{line}"),
    )
    header = F.concat(
        F.lit(f"WARC/1.1{line}WARC-Type: "),
        F.col("record_type"),
        F.lit(f"{line}WARC-Record-ID: <{PAGE_URN}"),
        F.coalesce(F.col("page_id").cast("string"), none),
        F.lit(f">{line}WARC-Target-URI: "),
        F.regexp_replace("url", "[\r\n].*", ""),
        F.lit(f"{line}WARC-Date: 2024-01-01T00:00:00Z{line}"),
        F.lit("WARC-Payload-Digest: sha1:"),
        F.col("payload_digest"),
        F.lit(line),
        F.coalesce(F.when(is_revisit, refers), none),
        F.lit(f"Content-Type: application/http;msgtype=response{line}Content-Length: "),
        F.octet_length(block).cast("string"),
        F.lit(line * 2),
    )
    return pages.select(F.concat(header, block, F.lit("\r\n\r")).alias("value"))


def write_monolithic(pages: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Write records as archives that are one gzip stream each, of as many as have ``FILE_BYTES`` on average.

    Records are written where they are read: every task has its own archives, and no payload is shuffled
    for them. The text writer ends each record with the line feed that it lacks and compresses a file as a
    whole.
    """
    average = pages.agg(F.avg(F.col("payload_bytes") + 600)).first()[0] or 1
    writer = warc_records(pages).write.option("compression", "gzip").option("lineSep", "\n")
    writer.option("maxRecordsPerFile", max(1, min(file_records, int(FILE_BYTES / average)))).text(path)


# --- normalising ------------------------------------------------------------------------


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a gzip stream of one or more members, inflated once from front to back."""
    wrapped = zlib.decompressobj(wbits=31)
    kept = b""
    for chunk in chunks:
        while chunk:
            kept += wrapped.decompress(chunk, READ_BYTES)
            records, kept = _whole_records(kept)
            yield from records
            if wrapped.eof:
                chunk, wrapped = wrapped.unused_data, zlib.decompressobj(wbits=31)
            else:
                chunk = wrapped.unconsumed_tail
    while more := wrapped.decompress(wrapped.unconsumed_tail, READ_BYTES):
        records, kept = _whole_records(kept + more)
        yield from records
    if kept:
        raise ValueError("the stream ends inside a record")


def _whole_records(data: bytes) -> tuple[list[bytes], bytes]:
    records, at = [], 0
    while (head := data.find(END, at)) >= 0:
        end = head + len(END) + int(_field(data[at:head], "Content-Length")) + len(END)
        if end > len(data):
            break
        records.append(data[at:end])
        at = end
    return records, data[at:]


def _field(head: bytes, name: str) -> str:
    found = re.search(rf"^{name}: ?(.*?)\r?$".encode(), head, re.M)
    return found[1].decode() if found else ""


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own; the same bytes each time."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def normalise(spark: SparkSession, archives: str, path: str) -> DataFrame:
    """Rewrite every archive below ``archives`` with a member per record; returns the sidecar index.

    Each ``<name>.warc.gz`` in ``path`` has ``<name>.idx`` beside it: record id, offset and length of
    each member, tab-separated. Both are written under another name and moved when whole, so a task
    that runs again replaces them. The index comes back as ``(file, record_id, offset, length)``.
    """
    local, root = _store(path)
    local.create_dir(root, recursive=True)

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(path)
        for batch in batches:
            for source, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                name = re.sub(r"[^A-Za-z0-9-]", "_", source.rsplit("/", 1)[-1])
                view = memoryview(content.as_buffer())
                parts = (bytes(view[i : i + READ_BYTES]) for i in range(0, len(view), READ_BYTES))
                ids, offsets, lengths, offset = [], [], [], 0
                with store.open_output_stream(f"{folder}/.{name}.new", compression=None) as out:
                    for record in inflated(parts):
                        packed = member(record)
                        out.write(packed)
                        ids.append(_field(record.partition(END)[0], "WARC-Record-ID").strip("<>"))
                        offsets.append(offset)
                        lengths.append(len(packed))
                        offset += len(packed)
                with store.open_output_stream(f"{folder}/.{name}.idx.new", compression=None) as out:
                    out.write("".join(f"{i}\t{o}\t{n}\n" for i, o, n in zip(ids, offsets, lengths)).encode())
                store.move(f"{folder}/.{name}.new", f"{folder}/{name}.warc.gz")
                store.move(f"{folder}/.{name}.idx.new", f"{folder}/{name}.idx")
                yield pa.record_batch(
                    [pa.array([f"{name}.warc.gz"] * len(ids), pa.string()), pa.array(ids, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    ["file", "record_id", "offset", "length"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(archives).select("path", "content")
    index = files.mapInArrow(rewrite, "file string, record_id string, offset long, length long")
    return written(index, "warc-index")


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


# --- reading ----------------------------------------------------------------------------

READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the normalised archives in ``path``, each inflated by itself at its indexed place.

    The task that has an archive opens the sidecar beside it. Either without the other is an error, and so
    is a response whose payload does not have the length and digest its header states.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = _store(path)
        for batch in batches:
            for source, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                name = re.sub(r"\.(warc\.gz|idx)$", "", source.rsplit("/", 1)[-1])
                if source.endswith(".idx"):
                    store.open_input_file(f"{folder}/{name}.warc.gz").close()
                    continue
                with store.open_input_stream(f"{folder}/{name}.idx", compression=None) as beside:
                    places = [line.split("\t") for line in beside.read().decode().splitlines()]
                view = memoryview(content.as_buffer())
                rows = [_parsed(zlib.decompress(view[int(o) : int(o) + int(n)], wbits=31)) for _, o, n in places]
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in rows], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{warc.gz,idx}").load(path)
    return files.select("path", "content").mapInArrow(members, READ)


def _parsed(record: bytes) -> tuple:
    head, _, block = record.partition(END)
    http, _, rest = block.partition(END)
    payload, kind = rest[: -len(END)], _field(head, "WARC-Type")
    size, digest = int(_field(http, "Content-Length")), _field(head, "WARC-Payload-Digest").removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of {_field(head, 'WARC-Record-ID')} is not the one that was written")
    numbers = [_field(head, name).strip("<>").removeprefix(PAGE_URN) for name in ("WARC-Record-ID", "WARC-Refers-To")]
    page_id, refers_to = (int(n) if n else None for n in numbers)
    return page_id, size, digest, kind, refers_to


def through_archives(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages (page_id, url, html)`` as archives, normalise them, and read every record back.

    Gives ``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per row; an empty table
    gives no rows, other columns are ignored.
    """
    spark = pages.sparkSession
    archives, path = work_folder(spark, "warc"), work_folder(spark, "warc-members")
    write_monolithic(with_revisits(pages, least_bytes), archives)
    normalise(spark, archives, path)
    return read_archives(spark, path)
