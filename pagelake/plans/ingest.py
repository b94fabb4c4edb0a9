"""The ingest job: pages -> staged parse -> check -> audit columns -> full refresh.

Order matters for the target: the namespace is created first, pages are parsed
once and written to the shared checkpoint folder, one small aggregate over the
staged flag columns decides the end page and fails on a bad page.  The rows are
then written aside, and only a finished write takes the target's place: neither a
failed read nor a failed write touches the old table.

Every step is a Spark job on executors; the driver sees one summary row per
dataset.  Executor loss is covered by task retry: the staged pages live in the
shared folder, and the processing timestamp is fixed when the final write is
planned, so retried tasks write the same values.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession

from pagelake.functions.audit import with_audit_columns
from pagelake.functions.schema import DatasetSpec
from pagelake.operators.pages import (
    PAGE_SCHEMA,
    check_pages,
    page_records,
    stage_pages,
    staging_path,
)
from pagelake.plans.registry import SourceSpec, select_datasets
from pagelake.plans.sinks import DEFAULT_LAYER, CatalogTarget, table_name
from pagelake.session import qualified, remove_folder
from pagelake.sources.paged_json import endpoint_url, is_http, pushdown_enabled, register
from pagelake.sources.requests import asked_pages

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class IngestResult:
    dataset: str
    table: str
    pages: int
    records: int
    stop: int | None


def api_pages(spark: SparkSession, source: SourceSpec, spec: DatasetSpec, first: int = 1, last: int | None = None,
              pages_per_partition: int = 1) -> DataFrame:
    """Responses of ``source``/``spec`` fetched on executors by the ``paged_json`` data source, or by the source's transport."""
    if spec.paging.enabled and last is not None and last < first:
        return spark.createDataFrame([], PAGE_SCHEMA)
    if source.transport:
        return asked_pages(spark, source, spec, first, last, pages_per_partition)
    register(spark)
    url = endpoint_url(source.base_url, spec.endpoint)
    options = {
        "url": url if is_http(url) else qualified(spark, url),
        "params": json.dumps(dict(spec.params)),
        "headers": json.dumps(dict(source.headers)),
        "timeout": str(source.timeout),
        "retries": str(source.retries),
        "paginate": str(spec.paging.enabled).lower(),
        "firstPage": str(first),
        "lastPage": str(first if last is None else last),
        "pagesPerPartition": str(pages_per_partition),
        "singleTasks": str(2 * spark.sparkContext.defaultParallelism),
    }
    if source.key_env:
        options["apiKeyEnv"] = source.key_env
    if pushdown_enabled(spark):
        options["prunePages"] = "true"
    return spark.read.format("paged_json").options(**options).load()


def _per_task(spark: SparkSession, pages: int, pages_per_partition: int | None) -> int:
    """Pages per fetch task: given, or enough to give every core about two tasks."""
    if pages_per_partition:
        return pages_per_partition
    return max(1, -(-pages // (2 * spark.sparkContext.defaultParallelism)))


def stage_api_pages(spark: SparkSession, source: SourceSpec, spec: DatasetSpec, path: str | None = None) -> DataFrame:
    """Fetch and stage a dataset's pages.

    Pages are requested in waves that double in size, from the source's ``first_wave``
    up to its ``max_wave``, and never pass ``maxPages``.  Each wave is fetched in parallel, parsed and appended to the
    staging folder; the next wave is requested only when the last one had
    neither an empty nor a bad page.  Over-fetch stays below one
    wave, so a dataset that ends early costs few requests whatever its cap.
    A single-request dataset is one request.
    """
    path = path or staging_path(spark, spec)
    if not spec.paging.enabled:
        return stage_pages(api_pages(spark, source, spec, 1, None, 1), spec, path=path)
    cap = spec.paging.max_pages
    if cap == 0:
        return stage_pages(api_pages(spark, source, spec, 1, 0, 1), spec, path=path)
    start, size = 1, source.first_wave
    while True:
        last = start + size - 1 if cap is None else min(start + size - 1, cap)
        per_task = _per_task(spark, last - start + 1, source.pages_per_task)
        wave = api_pages(spark, source, spec, start, last, per_task)
        seen = Observation(f"pagelake_wave_{uuid.uuid4().hex}")  # unique: runs may share a session
        staged = stage_pages(wave, spec, path=path, mode="append", observation=seen)
        if seen.get["ended"] or (cap is not None and last >= cap):
            return staged
        start, size = last + 1, min(size * 2, source.max_wave)


def ingest(
    spark: SparkSession,
    spec: DatasetSpec,
    pages: DataFrame | None = None,
    target=None,
    layer: str = DEFAULT_LAYER,
    source: SourceSpec | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> IngestResult:
    """Ingest one dataset into ``<layer>.<source>_<dataset>`` of ``target``.

    ``pages``: responses as ``page, status, body`` rows (any page source).  When
    absent, pages are requested from ``source``.  ``transform``: a DataFrame ->
    DataFrame step applied to the typed records before the audit columns (the
    extension point for dataset-specific processing; the hash covers its output).
    """
    target = target or CatalogTarget()
    target.ensure_namespace(spark, layer)
    if pages is None and source is None:
        raise ValueError("ingest needs pages or a source to request them from")
    path = staging_path(spark, spec)
    try:
        if pages is not None:
            staged = stage_pages(pages, spec, path=path)
        else:
            staged = stage_api_pages(spark, source, spec, path=path)
        check = check_pages(staged, spec)
        records = page_records(staged, check.stop)
        rows = with_audit_columns(transform(records) if transform else records)
        name = target.overwrite(rows, layer, table_name(spec.source, spec.name))
    except Exception:
        remove_folder(spark, path)
        raise
    remove_folder(spark, path)  # staged pages are scratch once the target holds the rows
    log.info("Ingested %s into %s: %d pages, %d records", spec.qualified_name, name, check.pages, check.records)
    return IngestResult(spec.qualified_name, name, check.pages, check.records, check.stop)


def run(
    spark: SparkSession,
    sources: Iterable[SourceSpec],
    run_config: Mapping[str, Any] | str,
    selector: str | None = None,
    target=None,
    layer: str = DEFAULT_LAYER,
    pages_for: Callable[[SourceSpec, DatasetSpec], DataFrame] | None = None,
    transforms: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> list[IngestResult]:
    """Ingest every selected dataset, one after another; the first failure stops the run.

    Datasets finished before a failure stay written.  ``pages_for`` supplies the
    responses of a dataset (default: request them from the source's API).
    ``transforms`` maps ``"<source>.<dataset>"`` to its records step (see :func:`ingest`).
    """
    selected = select_datasets(sources, run_config, selector)
    if not selected:
        log.warning("No sources found for the specified dataset.")
        return []
    results = []
    for src in selected:
        for spec in src.datasets:
            log.info("Ingesting %s", spec.qualified_name)
            pages = pages_for(src, spec) if pages_for else None
            step = (transforms or {}).get(spec.qualified_name)
            results.append(ingest(spark, spec, pages=pages, target=target, layer=layer, source=src, transform=step))
    return results
