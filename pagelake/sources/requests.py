"""Requests as rows, and the transports that answer them.

:func:`shape_requests` makes one row for each request of a dataset: URL, parameters, headers,
timeout, attempts, and the whole ``request`` text as it goes over the wire.  A transport turns
such rows into ``page, status, body`` rows.  A source names its transport:

* nothing - the ``paged_json`` data source (HTTP, or a folder of responses);
* ``table:<name>`` - :class:`TableTransport`, a table of recorded answers;
* ``<module>:<function>`` - whatever ``function(spark, source)`` returns, an object with ``answer(requests)``.
  :class:`CallTransport` makes one of a Python function that answers a single request.

A request is sent again, up to its ``attempts``, while the answer is transient (no answer, 429, 502-504).
API keys stay a placeholder in the rows; :class:`CallTransport` fills them in where it sends.
"""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions.schema import DatasetSpec
from pagelake.operators.pages import BODY, PAGE, STATUS
from pagelake.sources.paged_json import (
    BACKOFF_SECONDS,
    PAGE_PARAM,
    TRANSIENT_STATUS,
    endpoint_url,
    retried,
    with_api_key,
)

TABLE = "table:"
NOT_FOUND, REFUSED = 404, 401


def _encoded(text: Column) -> Column:
    """Form encoding as HTTP clients write it: all but letters, digits and ``_.-~`` as bytes, a space as ``+``."""
    return F.replace(F.replace(F.url_encode(text), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _map(values: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for pair in values.items() for x in pair]
    return F.create_map(*pairs) if pairs else F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))


def shape_requests(spark: SparkSession, source, spec: DatasetSpec, first: int = 1, last: int | None = None) -> DataFrame:
    """``page, request, url, params, headers, timeout, attempts``: the requests of pages ``first..last``.

    A paged dataset sends ``page=<n>`` in place of any ``page`` among its parameters, behind the others; a single
    request sends its own parameters only.
    """
    paged = spec.paging.enabled
    rows = spark.range(first, (first if last is None else last) + 1) if paged else spark.range(1, 2)
    params = {k: str(v) for k, v in spec.params.items() if not (paged and k == PAGE_PARAM)}
    number = F.col("id").cast("string")
    query = [F.concat(_encoded(F.lit(k)), F.lit("="), _encoded(F.lit(v))) for k, v in params.items()]
    sent = _map(params)
    if paged:
        query.append(F.concat(F.lit(f"{PAGE_PARAM}="), number))
        sent = F.map_concat(sent, F.create_map(F.lit(PAGE_PARAM), number))
    url = endpoint_url(source.base_url, spec.endpoint)
    request = F.concat(F.lit(f"{url}?"), F.concat_ws("&", *query)) if query else F.lit(url)
    return rows.select(F.col("id").alias(PAGE), request.alias("request"), F.lit(url).alias("url"), sent.alias("params"),
                       _map(source.headers).alias("headers"), F.lit(float(source.timeout)).alias("timeout"),
                       F.lit(max(0, int(source.retries)) + 1).alias("attempts"))


def _transient(status: Column) -> Column:
    return (status < 0) | status.isin(*sorted(TRANSIENT_STATUS))


@dataclass(frozen=True)
class TableTransport:
    """Answers from a table ``request, attempt, status, body``: what the service says to each attempt (from 0).

    With a ``headers`` column, a map, a request must carry these headers, else it is refused (401).  A request that
    the table does not know is not found (404).  Answers to other requests are left out where they are read, before the
    equi-join in which requests and answers meet.
    """

    answers: DataFrame

    def attempts(self, requests: DataFrame) -> DataFrame:
        """One row for each request that is sent: the request's columns, ``attempt``, ``status`` and ``body``.

        The attempts of a request end with its first answer that is not transient.
        """
        columns = requests.columns
        known = self.answers.select(F.col("request").alias("_request"), F.col("attempt").cast("int").alias("attempt"),
                                    F.col("status").cast("int").alias(STATUS), F.col("body").alias(BODY),
                                    *([F.col("headers").alias("_needs")] if "headers" in self.answers.columns else []))
        # a wave asks for a bounded part of the table: its requests go to the answers, the rest of the answers never moves
        known = known.join(requests.select(F.col("request").alias("_asked")), F.col("_request") == F.col("_asked"), "left_semi")
        met = requests.join(known, (F.col("request") == F.col("_request")) & (F.col("attempt") < F.col("attempts")), "left")
        status = F.when(F.col("_request").isNull(), F.lit(NOT_FOUND))
        body = F.when(F.col("_request").isNull(), F.lit(""))
        if "_needs" in met.columns:
            carried = F.forall(F.map_entries("_needs"), lambda e: F.coalesce(
                F.try_element_at(F.col("headers"), e["key"]) == e["value"], F.lit(False)))
            lacks = F.col("_needs").isNotNull() & ~carried
            status, body = status.when(lacks, F.lit(REFUSED)), body.when(lacks, F.lit(""))
        met = met.select(*columns, F.coalesce("attempt", F.lit(0)).alias("attempt"), status.otherwise(F.col(STATUS)).alias(STATUS),
                         body.otherwise(F.col(BODY)).alias(BODY))
        settled = (met.filter(~_transient(F.col(STATUS))).groupBy(PAGE).agg(F.min("attempt").alias("_last")))
        return (met.join(settled, PAGE, "left").filter("_last is null or attempt <= _last").select(met.columns))

    def answer(self, requests: DataFrame) -> DataFrame:
        """``page, status, body``: the last answer to each request."""
        last = F.max_by(F.struct(STATUS, BODY), "attempt").alias("last")
        return self.attempts(requests).groupBy(PAGE).agg(last).select(PAGE, f"last.{STATUS}", f"last.{BODY}")


@dataclass(frozen=True)
class CallTransport:
    """Answers from ``call(url, params, headers, timeout) -> (status, text)``, called by the tasks that hold the requests."""

    call: Callable[[str, Mapping[str, str], Mapping[str, str], float], tuple[int, str]]
    key_env: str | None = None
    backoff: float = BACKOFF_SECONDS

    def answer(self, requests: DataFrame) -> DataFrame:
        from pagelake.session import ship_package

        ship_package(requests.sparkSession)
        call, backoff = self.call, self.backoff
        key = os.environ.get(self.key_env) if self.key_env else None
        if self.key_env and not key:
            raise ValueError(f"the environment has no {self.key_env}, which the request headers need")

        def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for r in batch.to_pylist():
                    headers = dict(r["headers"])
                    headers = with_api_key(headers, key) if key else headers
                    args = (r["url"], dict(r["params"]), headers, r["timeout"])
                    out.append((r[PAGE], *retried(lambda args=args: call(*args), r["attempts"], backoff)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int32()),
                     pa.array([o[2] for o in out], pa.string())], names=[PAGE, STATUS, BODY])

        return requests.mapInArrow(rows, f"{PAGE} long, {STATUS} int, {BODY} string")


def transport_of(spark: SparkSession, source):
    """The transport that a source names."""
    name = source.transport
    if name.startswith(TABLE):
        return TableTransport(spark.table(name.removeprefix(TABLE)))
    module, _, function = name.partition(":")
    if not function:
        raise ValueError(f"source {source.name}: a transport is table:<name> or <module>:<function>, not {name!r}")
    return getattr(importlib.import_module(module), function)(spark, source)


def asked_pages(spark: SparkSession, source, spec: DatasetSpec, first: int, last: int | None, pages_per_partition: int) -> DataFrame:
    """Pages ``first..last`` through the source's transport, shaped in parallel."""
    requests = shape_requests(spark, source, spec, first, last)
    transport = transport_of(spark, source)
    if isinstance(transport, CallTransport) and spec.paging.enabled and last is not None:
        requests = requests.repartition(max(1, -(-(last - first + 1) // pages_per_partition)))
    return transport.answer(requests)


__all__ = ["CallTransport", "TableTransport", "asked_pages", "shape_requests", "transport_of"]
