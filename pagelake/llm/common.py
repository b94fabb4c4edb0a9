"""Helpers shared by the operators: tables, worker code, staged tables, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.session import remove_folder, scratch_folder, ship_package, write_bytes

#: The white space that separates words in every contract: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"
#: Bytes of text that one step inside a task handles at a time (a longer text is handled alone).
SLICE_BYTES = 4 << 20
#: Rows of a few numbers up to which a table may be sent to all executors (some 30 MB); beyond, joins shuffle.
SENT_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def on_workers(spark: SparkSession) -> None:
    """Make this package importable by the executors' Python workers."""
    ship_package(spark)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written to a scratch folder on shared storage and read again.

    Cuts the lineage: a lost executor never repeats what came before.  The
    folder goes when the application ends, or with :func:`forget`.
    """
    folder = scratch_folder(df.sparkSession, purpose)
    df.write.parquet(f"{folder}/table")
    out = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/table")
    out.staged_folder = folder
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables of :func:`staged` once what was made of them is written itself."""
    for table_ in tables:
        folder = getattr(table_, "staged_folder", None)
        if isinstance(folder, str):
            remove_folder(table_.sparkSession, folder)


def small(df: DataFrame, most: int = SENT_ROWS) -> DataFrame:
    """A written table of a few numbers a row, marked for broadcasting if its counted rows allow it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def shared_file(spark: SparkSession, purpose: str, data: bytes, name: str) -> str:
    """Bytes as a file that Spark gives to every executor; the name to ask ``SparkFiles`` for."""
    folder = scratch_folder(spark, purpose)
    name = f"{folder.rsplit('-', 1)[-1]}-{name}"  # Spark knows such files by name, so each gets its own
    write_bytes(spark, f"{folder}/{name}", data)
    spark.sparkContext.addFile(f"{folder}/{name}")
    return name


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into runs of rows whose text column holds about ``limit`` bytes."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def joined_spans(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
