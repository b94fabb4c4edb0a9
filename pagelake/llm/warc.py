"""WARC archives with an index that comes first.

Writing: every page becomes a gzip member of its own.  The task that writes a file
returns, for each record, its file, offset, length, URL and digest, and this index is
a written table before anything is read.  File names are new for every attempt, so
a repeated task never touches a file that the index may name.

Reading: the selected index rows are dealt out by ranges of (file, offset) and sorted;
a task joins neighbouring byte ranges into one read, then opens the members.

Of pages with equal payloads of at least :data:`LEAST_BYTES` bytes, the one with the
smallest id is a response and the others revisit it.  Repeated rows of that smallest
id are responses too.  A null html is an empty payload.  A null id never leads a
page that has one.  Payloads are stored and read whole.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.llm.common import on_workers, slices, staged
from pagelake.session import qualified, resolve_filesystem, scratch_folder

LEAST_BYTES = 100
#: Bytes after which a task begins another file.
FILE_BYTES = 256 << 20
#: Byte ranges closer than GAP are read at once, up to READ bytes.
GAP, READ = 64 << 10, 8 << 20
_DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture


def with_revisits(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The pages with ``_bytes``, ``_digest`` (SHA-256) and ``_leads`` (null for a response, else a struct of its page).

    Groups of equal payloads are found on narrow rows with map-side combining; the
    pages themselves are only joined by their own id, so a payload that a third of
    all pages share never gathers those pages in one task.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    pages = pages.withColumns({"_bytes": F.octet_length(payload).cast("long"), "_digest": F.sha2(payload, 256)})
    narrow = pages.filter(F.col("_bytes") >= LEAST_BYTES).select(F.col(id_col).alias("_id"), "_digest")
    leaders = (narrow.groupBy("_digest").agg(F.min("_id").alias("_leader"), F.count("*").alias("_n"))
               .filter("_n > 1").drop("_n"))
    revisits = (narrow.join(leaders, "_digest").filter("not (_id <=> _leader)").distinct()
                .select("_id", F.col("_digest").alias("_same"), F.struct("_leader").alias("_leads")))
    return (pages.join(revisits, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_same")), "left")
            .drop("_id", "_same"))


def record_bytes(url: str | None, digest: str, payload: bytes, page: str, leader: str | None, revisit: bool) -> bytes:
    """One WARC record as a gzip member."""
    if revisit:
        block = b""
    else:
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                 % len(payload)) + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Date: {_DATE}",
            f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page}:{digest}')}>",
            *([f"WARC-Target-URI: {target}"] if url is not None else []),
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{leader}:{digest}')}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n",
                         compresslevel=1, mtime=0)


def parse_record(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and HTTP payload of a record."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
    block = rest[:int(headers["content-length"])]
    return headers, block.partition(b"\r\n\r\n")[2] if block else b""


def write_archives(pages: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html") -> DataFrame:
    """Write every page to WARC files and return the index, a written table.

    Index columns: the page's id, ``file``, ``offset``, ``length``, ``url``, ``digest``, ``revisit``, ``refers_to``.
    """
    spark = pages.sparkSession
    on_workers(spark)
    folder = qualified(spark, folder) if folder else scratch_folder(spark, "warc")
    ready = with_revisits(pages.select(id_col, url_col, html_col), id_col, html_col)
    kind = ready.schema[id_col].dataType
    rows_in = ready.select(id_col, url_col, html_col, "_digest", F.col("_leads").isNotNull().alias("_revisit"),
                           F.col("_leads._leader").alias("_leader"))
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("file", T.StringType()),
                           T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("url", T.StringType()), T.StructField("digest", T.StringType()),
                           T.StructField("revisit", T.BooleanType()), T.StructField("refers_to", kind)])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = resolve_filesystem(folder)
        out, name, at = None, "", 0
        try:
            for batch in slices(batches, html_col):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    filesystem.create_dir(inner, recursive=True)
                    out = filesystem.open_output_stream(f"{inner}/{name}", compression=None)  # members are compressed
                columns = [batch.column(i).to_pylist() for i in range(6)]
                offsets, lengths = [], []
                for page, url, html, digest, revisit, leader in zip(*columns, strict=True):
                    member = record_bytes(url, digest, (html or "").encode("utf-8", "surrogatepass"), str(page),
                                          str(leader), revisit)
                    out.write(member)
                    offsets.append(at)
                    lengths.append(len(member))
                    at += len(member)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([name] * batch.num_rows, pa.string()), pa.array(offsets, pa.int64()),
                     pa.array(lengths, pa.int64()), batch.column(1).cast(pa.string()),
                     batch.column(3).cast(pa.string()), batch.column(4), batch.column(5)], names=schema.names)
        finally:
            if out is not None:
                out.close()

    index = staged(rows_in.mapInArrow(rows, schema), "warc-index")
    return index.withColumn("file", F.concat(F.lit(folder.rstrip("/") + "/"), "file"))


def coalesced(ranges: list[tuple[int, int]], gap: int = GAP, most: int = READ) -> list[tuple[int, int, int]]:
    """Sorted (offset, length) ranges as (begin, end, number of ranges) of the reads that cover them."""
    reads: list[list[int]] = []
    for offset, length in ranges:
        if reads and offset - reads[-1][1] <= gap and max(reads[-1][1], offset + length) - reads[-1][0] <= most:
            reads[-1][1] = max(reads[-1][1], offset + length)
            reads[-1][2] += 1
        else:
            reads.append([offset, offset + length, 1])
    return [tuple(r) for r in reads]


def read_records(selected: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The records that index rows name: id, ``url``, ``record_type``, ``refers_to``, ``payload_bytes``, ``payload_digest``, ``payload``.

    ``payload`` is the stored one, checked against its digest; a revisit stores none, its
    bytes and digest are those of the full payload.
    """
    on_workers(selected.sparkSession)
    kind = selected.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("url", T.StringType()),
                           T.StructField("record_type", T.StringType()), T.StructField("refers_to", kind),
                           T.StructField("payload_bytes", T.LongType()),
                           T.StructField("payload_digest", T.StringType()),
                           T.StructField("payload", T.BinaryType())])
    ordered = (selected.select(id_col, "url", "refers_to", "file", "offset", "length")
               .repartitionByRange("file", "offset").sortWithinPartitions("file", "offset"))

    def members(files: list[str], ranges: list[tuple[int, int]], opened: dict) -> Iterator[bytes]:
        at = 0
        while at < len(files):
            to = at
            while to < len(files) and files[to] == files[at]:
                to += 1
            if files[at] not in opened:
                for stream in opened.values():
                    stream.close()
                opened.clear()
                filesystem, inner = resolve_filesystem(files[at])
                opened[files[at]] = filesystem.open_input_file(inner)
            for begin, end, n in coalesced(ranges[at:to]):
                opened[files[at]].seek(begin)
                block = opened[files[at]].read(end - begin)
                for offset, length in ranges[at:at + n]:
                    yield block[offset - begin:offset - begin + length]
                at += n

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict[str, io.IOBase] = {}
        for big in batches:
            for start in range(0, big.num_rows, 512):
                batch = big.slice(start, 512)
                files, offsets, lengths = (batch.column(i).to_pylist() for i in (3, 4, 5))
                kinds, sizes, digests, payloads = [], [], [], []
                for member in members(files, list(zip(offsets, lengths, strict=True)), opened):
                    headers, payload = parse_record(member)
                    digest, size = headers["warc-payload-digest"].split(":")[1], int(headers["x-payload-length"])
                    if headers["warc-type"] == "response":
                        size, found = len(payload), hashlib.sha256(payload).hexdigest()
                        if found != digest:
                            raise ValueError(f"a payload of {headers.get('warc-target-uri')} does not match its digest")
                    kinds.append(headers["warc-type"])
                    sizes.append(size)
                    digests.append(digest)
                    payloads.append(payload if headers["warc-type"] == "response" else None)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(kinds, pa.string()), batch.column(2),
                     pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(payloads, pa.binary())],
                    names=schema.names)

    return ordered.mapInArrow(rows, schema)
