"""Incremental landing of responses with Structured Streaming (an addition).

Responses that keep arriving in a folder (one JSON file per page, or packs with their index)
are parsed as they land and appended to a staging folder by a streaming query: file source ->
the same ``parse_pages`` projection -> Parquet file sink.  The file sink and the checkpoint make
every response land exactly once, across restarts and lost executors.

:func:`ingest_landed` then checks (end page, failures, gaps) and refreshes the target.  The check
keeps a **summary** of all staged pages beside the staging folder: per 32,768 page numbers the
bitmap of those that have come, how many rows they had, the first empty and the first bad page, and
the lowest and highest number.  A run reads the flags of the newly staged files only, merges their summary with
the kept one, and decides from the result alone what
:func:`pagelake.operators.check_pages` decides from all flags.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pagelake.functions.audit import with_audit_columns
from pagelake.functions.schema import DatasetSpec
from pagelake.operators.pages import (
    BAD,
    EMPTY,
    PAGE,
    PAGE_SCHEMA,
    PROBLEM,
    PageError,
    cap_pages,
    page_records,
    page_set,
    parse_pages,
)
from pagelake.plans.ingest import IngestResult
from pagelake.plans.sinks import DEFAULT_LAYER, CatalogTarget, table_name
from pagelake.session import hadoop_path, remove_folder, shared_dir
from pagelake.sources.landed import file_pages
from pagelake.sources.packs import is_packed, page_pack_stream

SUMMARY_SCHEMA = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("seen", T.BinaryType()),
                               *(T.StructField(c, T.LongType()) for c in ("n", "lo", "hi", "stop", "first_bad"))])
#: Page numbers of one bitmap (as Spark's bitmap functions deal them).
BUCKET_PAGES = 32768


def page_file_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``page, status, body`` rows, one per new file in ``folder`` (see :func:`file_pages`)."""
    reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return file_pages(reader.option("recursiveFileLookup", "true").load(folder))


def stream_locations(spark: SparkSession, spec: DatasetSpec, root: str | None = None) -> tuple[str, str]:
    """(staging folder, checkpoint folder) of a dataset's landing stream, in the shared folder."""
    base = root or f"{shared_dir(spark)}/pagelake-stream/{spec.source}_{spec.name}"
    return f"{base}/staged", f"{base}/checkpoint"


def start_landing(spark: SparkSession, folder: str, spec: DatasetSpec, root: str | None = None,
                  available_now: bool = True, processing_time: str | None = None,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream that parses new responses of ``folder`` into the staging folder.

    A folder that has a pack index is read by it, any other one as a file per page.
    ``available_now``: process what is there, then stop; otherwise run with a
    ``processing_time`` trigger until stopped.
    """
    staged, checkpoint = stream_locations(spark, spec, root)
    pages = page_pack_stream if is_packed(spark, folder) else page_file_stream
    parsed = parse_pages(cap_pages(pages(spark, folder, max_files_per_trigger), spec), spec)
    writer = (parsed.writeStream.format("parquet").option("path", staged)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.queryName(f"landing_{spec.source}_{spec.name}").start()


# ---------------------------------------------------------------------------
# The kept summary
# ---------------------------------------------------------------------------


def summary_of(flags: DataFrame) -> DataFrame:
    """The summary of some pages (``page, bad, empty``)."""
    return page_set(flags, F.min(PAGE).alias("lo"), F.max(PAGE).alias("hi"),
                    F.min(F.when(F.col(EMPTY), F.col(PAGE))).alias("stop"),
                    F.min(F.when(F.col(BAD), F.col(PAGE))).alias("first_bad")).select(SUMMARY_SCHEMA.names)


def merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """The summary of the pages of two summaries."""
    return one.unionByName(other).groupBy("bucket").agg(
        F.bitmap_or_agg("seen").alias("seen"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.min("stop").alias("stop"), F.min("first_bad").alias("first_bad"))


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the finished ``version=<n>`` folders, ascending."""
    fs, where = hadoop_path(spark, folder)
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version=")
                  and fs.exists(hadoop_path(spark, f"{folder}/{n}/_SUCCESS")[1]))


def keep_summary(spark: SparkSession, staged: DataFrame, folder: str) -> DataFrame:
    """The summary of all staged pages, from the kept one and the files it does not cover yet.

    ``folder`` holds versions: the bitmaps of the last two, and the names of the files that each one added.
    A version counts when its file names are written, so a run that breaks off in between leaves the one before.
    """
    buckets, files = f"{folder}/buckets", f"{folder}/files"
    done = _versions(spark, files)
    covered = {r.file for n in done for r in spark.read.parquet(f"{files}/version={n}").collect()}  # names, no pages
    new = sorted(set(staged.inputFiles()) - covered)
    kept = spark.read.schema(SUMMARY_SCHEMA).parquet(f"{buckets}/version={done[-1]}") if done else None
    if not new:
        return spark.createDataFrame([], SUMMARY_SCHEMA) if kept is None else kept
    now = summary_of(spark.read.schema(staged.schema).parquet(*new).select(PAGE, BAD, EMPTY))
    version = done[-1] + 1 if done else 0
    (now if kept is None else merged(kept, now)).write.mode("overwrite").parquet(f"{buckets}/version={version}")
    spark.createDataFrame([(f,) for f in new], "file string").coalesce(1).write.mode("overwrite").parquet(
        f"{files}/version={version}")
    if len(done) > 1:
        remove_folder(spark, f"{buckets}/version={done[-2]}")
    return spark.read.schema(SUMMARY_SCHEMA).parquet(f"{buckets}/version={version}")


def _seen_below(stop: int) -> Column:
    """How many of a bucket's pages lie below ``stop``: all, none, or the bitmap's first bytes and some bits of the next."""
    bucket, bits = 1 + (stop - 1) // BUCKET_PAGES, (stop - 1) % BUCKET_PAGES
    byte = F.conv(F.hex(F.substring("seen", bits // 8 + 1, 1)), 16, 10).cast("int")
    part = F.bitmap_count(F.substring("seen", 1, bits // 8)) + F.bit_count(byte.bitwiseAND((1 << bits % 8) - 1))
    return F.when(F.col("bucket") < bucket, F.bitmap_count("seen")).when(F.col("bucket") == bucket, part).otherwise(0)


def check_summary(summary: DataFrame, staged: DataFrame, spec: DatasetSpec) -> tuple[int | None, int]:
    """End page and number of pages before it; raises :class:`PageError` as :func:`check_pages` does.

    Staged pages are read in two cases only: for the text of a bad page, and when the bucket of the end page had
    a page twice, to see whether that one lies before the end.
    """
    name, paged = spec.qualified_name, spec.paging.enabled
    stop = summary.agg(F.min("stop")).first()[0] if paged else None
    twice = F.col("n") > F.bitmap_count("seen")
    if stop is None:
        inside, at_end, n = F.lit(True), F.lit(False), F.bitmap_count("seen")
    else:
        last = 1 + (stop - 1) // BUCKET_PAGES if stop > 0 else 0
        inside, at_end, n = F.col("bucket") < last, F.col("bucket") == last, _seen_below(stop) if stop > 0 else F.lit(0)
    row = summary.agg(
        F.min("first_bad").alias("first_bad"), F.coalesce(F.sum(n), F.lit(0)).alias("n"), F.min("lo").alias("lo"),
        F.max("hi").alias("hi"), F.coalesce(F.bool_or(inside & twice), F.lit(False)).alias("twice"),
        F.coalesce(F.bool_or(at_end & twice), F.lit(False)).alias("maybe_twice")).first()
    if row.first_bad is not None and (stop is None or row.first_bad < stop):
        problem = staged.where(F.col(BAD) & (F.col(PAGE) == F.lit(row.first_bad))).select(PROBLEM).first()[0]
        raise PageError(f"{name}: {problem}")
    repeated = row.twice
    if not repeated and row.maybe_twice:
        near = staged.where((F.col(PAGE) < F.lit(stop)) & (F.col(PAGE) >= F.lit(stop - BUCKET_PAGES))).select(PAGE)
        repeated = page_set(near).agg(F.bool_or(twice)).first()[0] or False
    if repeated:
        raise PageError(f"{name}: repeated page numbers before the end of data")
    if paged:
        whole = row.n == (row.hi or 0) if stop is None else row.n == max(0, stop - 1)
        below = row.lo is not None and row.lo < 1 and (stop is None or row.lo < stop)
        if below or not whole:
            raise PageError(f"{name}: page numbers before the end of data are not 1..{row.n} without gaps")
    return stop, row.n


def ingest_landed(spark: SparkSession, folder: str, spec: DatasetSpec, target=None, layer: str = DEFAULT_LAYER,
                  root: str | None = None, timeout: float | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> IngestResult:
    """Land new responses of ``folder`` (stream, available-now), then check and replace the target.

    ``transform`` is applied to the typed records before the audit columns, as in
    :func:`pagelake.plans.ingest.ingest`.
    """
    target = target or CatalogTarget()
    target.ensure_namespace(spark, layer)
    query = start_landing(spark, folder, spec, root=root)
    query.awaitTermination(timeout)
    if query.exception() is not None:
        raise query.exception()
    if query.isActive:
        query.stop()
        raise TimeoutError(f"landing of {spec.qualified_name} did not finish in {timeout}s")
    staged_path, _ = stream_locations(spark, spec, root)
    schema = parse_pages(spark.createDataFrame([], PAGE_SCHEMA), spec).schema
    staged = spark.read.schema(schema).parquet(staged_path)  # a known schema: nothing may have landed yet
    summary = keep_summary(spark, staged, staged_path.removesuffix("/staged") + "/summary")
    stop, pages = check_summary(summary, staged, spec)
    written = Observation(f"pagelake_landed_{uuid.uuid4().hex}")
    records = page_records(staged, stop).observe(written, F.count(F.lit(1)).alias("records"))
    rows = with_audit_columns(transform(records) if transform else records)
    name = target.overwrite(rows, layer, table_name(spec.source, spec.name))
    return IngestResult(spec.qualified_name, name, pages, written.get["records"], stop)
