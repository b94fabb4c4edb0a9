"""Landed responses in packs: many pages in one file, with an index of where each one lies.

``<folder>/packs-<id>/`` holds files of joined bodies, ``<folder>/index/`` a Parquet table
``page, status, file, offset, length`` (a length of null: no body).  Tasks write
packs of their own and return index rows only for finished ones; the index is written by
Spark's committer, so the pages of a lost or repeated task are in it once.  Readers go by the
index: whole packs are never listed per page, and neighbouring pages are read at once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.operators.pages import BODY, PAGE, STATUS
from pagelake.session import hadoop_path, qualified, remove_folder, resolve_filesystem, ship_package

INDEX, PACKS = "index", "packs-"
INDEX_SCHEMA = T.StructType([T.StructField(PAGE, T.LongType()), T.StructField(STATUS, T.IntegerType()),
                             T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
                             T.StructField("length", T.LongType())])
_INDEX_DDL = "page long, status int, file string, offset long, length long"
_PAGE_DDL = "page long, status int, body string"
#: Bytes after which a task begins a new pack, and bytes that a reader fetches at once.
PACK_BYTES, READ_BYTES = 128 << 20, 8 << 20
#: Least bytes of a reading task, as for Spark's own file sources.
LEAST_TASK_BYTES = 4 << 20


def index_rows(batches: Iterable[pa.RecordBatch], root: str, packs: str, pack_bytes: int) -> Iterator[pa.RecordBatch]:
    """Write the pages of a task as packs; yields the index of each finished pack."""
    filesystem, inner = resolve_filesystem(root)
    names = [f.name for f in INDEX_SCHEMA]
    file, name, at, held = None, "", 0, []

    def finished() -> pa.RecordBatch:
        file.close()
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in held], kind) for k, kind in enumerate(kinds)], names=names)

    for batch in batches:
        rows = zip(batch.column(PAGE).to_pylist(), batch.column(STATUS).to_pylist(),
                   batch.column(BODY).cast(pa.binary()).to_pylist(), strict=True)
        for page, status, body in rows:
            if file is None:
                name, at, held = f"{packs}/{uuid.uuid4().hex}.pack", 0, []
                filesystem.create_dir(f"{inner}/{packs}", recursive=True)
                file = filesystem.open_output_stream(f"{inner}/{name}", compression=None)
            if body:
                file.write(body)
            held.append((page, status, name, at, None if body is None else len(body)))
            at += len(body or b"")
            if at >= pack_bytes:
                yield finished()
                file = None
    if file is not None:
        yield finished()


def land_page_packs(pages: DataFrame, path: str, mode: str = "overwrite", pack_bytes: int = PACK_BYTES) -> str:
    """Write pages with their status into packs; ``mode="append"`` adds to those that are there."""
    spark = pages.sparkSession
    ship_package(spark)
    root, packs = qualified(spark, path), f"{PACKS}{uuid.uuid4().hex}"
    rows = pages.select(F.col(PAGE).cast("long"), F.col(STATUS).cast("int"), F.col(BODY))
    try:
        rows.mapInArrow(lambda batches: index_rows(batches, root, packs, pack_bytes), _INDEX_DDL).write.mode(mode).parquet(
            f"{root}/{INDEX}")
    except Exception:
        remove_folder(spark, f"{root}/{packs}")
        raise
    if mode == "overwrite":
        fs, where = hadoop_path(spark, root)
        for status in fs.listStatus(where):  # packs that the new index does not name
            name = status.getPath().getName()
            if name.startswith(PACKS) and name != packs:
                remove_folder(spark, f"{root}/{name}")
    return path


def is_packed(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop_path(spark, f"{path.rstrip('/')}/{INDEX}")
    return fs.exists(where)


def read_ranges(filesystem, root: str, rows: list[tuple]) -> Iterator[tuple[int, int, bytes | None]]:
    """(page, status, body) of index rows (page, status, file, offset, length); neighbours in a pack are read at once."""
    rows = sorted(rows, key=lambda r: (r[2], r[3]))
    start = 0
    while start < len(rows):
        first = rows[start]
        stop, end = start + 1, first[3] + (first[4] or 0)
        while (stop < len(rows) and rows[stop][2] == first[2] and rows[stop][3] == end
               and end + (rows[stop][4] or 0) - first[3] <= READ_BYTES):
            end += rows[stop][4] or 0
            stop += 1
        data = b""
        if end > first[3]:
            with filesystem.open_input_file(f"{root}/{first[2]}") as file:
                data = file.read_at(end - first[3], first[3])
            if len(data) != end - first[3]:
                raise OSError(f"{root}/{first[2]} ends before offset {end}")
        for page, status, _, offset, length in rows[start:stop]:
            yield page, status, None if length is None else data[offset - first[3]:offset - first[3] + length]
        start = stop


def _bodies(index: DataFrame, root: str) -> DataFrame:
    def pages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = resolve_filesystem(root)

        def out(held: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in held], pa.int64()), pa.array([r[1] for r in held], pa.int32()),
                 pa.array([None if r[2] is None else r[2].decode("utf-8") for r in held], pa.string())],
                names=[PAGE, STATUS, BODY])

        for batch in batches:
            held, size = [], 0
            for row in read_ranges(filesystem, inner, list(zip(*(c.to_pylist() for c in batch.columns), strict=True))):
                held.append(row)
                size += len(row[2] or b"")
                if size >= READ_BYTES:
                    yield out(held)
                    held, size = [], 0
            yield out(held)

    return index.select(*INDEX_SCHEMA.names).mapInArrow(pages, _PAGE_DDL)


def read_page_packs(spark: SparkSession, path: str) -> DataFrame:
    """The pages of packs as ``page, status, body`` rows; the index is dealt so that tasks read runs of similar size."""
    ship_package(spark)
    root = qualified(spark, path)
    index = spark.read.schema(INDEX_SCHEMA).parquet(f"{root}/{INDEX}")
    total = index.agg(F.sum("length")).first()[0] or 0
    most = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes", "128MB"))
    size = max(1, min(most, max(LEAST_TASK_BYTES, total // spark.sparkContext.defaultParallelism)))
    dealt = index.repartitionByRange(max(1, -(-total // size)), "file", "offset").sortWithinPartitions("file", "offset")
    return _bodies(dealt, root)


def _bytes(text: str) -> int:
    number = text.lower().rstrip("b")
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    return int(number[:-1]) << units[number[-1]] if number[-1] in units else int(number)


def page_pack_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``page, status, body`` rows of packs, as index files are added."""
    ship_package(spark)
    root = qualified(spark, path)
    reader = spark.readStream.schema(INDEX_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return _bodies(reader.parquet(f"{root}/{INDEX}"), root)
