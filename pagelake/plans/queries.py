"""Queries over the driver tables, one per operator, each with a DuckDB oracle.

Every query reads whole tables.  Tables are replayed as API pages of 100
records (:func:`records_as_pages`), then go through the operator under test.
The oracles compute the same result in plain SQL; column names match.
``_processedTimestamp`` is never compared (it is "now"): queries expose
``has_ts`` instead.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.functions.audit import PROCESSED_TIMESTAMP, ROW_HASH, with_audit_columns, with_row_hash
from pagelake.functions.schema import DatasetSpec, dataset_spec
from pagelake.operators.pages import BODY, PAGE, STATUS, parse_pages, read_records
from pagelake.plans.ingest import ingest, run, stage_api_pages
from pagelake.plans.registry import SourceSpec
from pagelake.plans.sinks import CatalogTarget, table_name
from pagelake.session import remove_folder, scratch_folder
from pagelake.sources.landed import land_pages, read_landed_pages
from pagelake.sources.packs import land_page_packs, read_page_packs
from pagelake.sources.requests import TABLE, shape_requests, transport_of
from pagelake.sources.table_pages import records_as_pages

PAGE_SIZE = 100
LAYER = "bronze"
SOURCE = "replay"
KEY = "body"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _cols(*pairs: tuple[str, str]) -> list[dict]:
    return [{"name": n, "type": t} for n, t in pairs]


# Declared record schemas of the replayed tables.
EVENTS = _cols(("event_id", "integer"), ("ts", "timestamp"), ("user_id", "integer"), ("event_type", "string"),
               ("value", "float"), ("props", "string"))
CUSTOMER_FALLBACK = _cols(("c_custkey", "long"), ("c_name", "string"), ("c_nationkey", "integer"),
                          ("c_acctbal", "double"), ("c_mktsegment", "varchar"))
ORDERS_PARTIAL = _cols(("o_orderkey", "integer"), ("o_custkey", "integer"), ("o_orderstatus", "string"),
                       ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_clerk", "string"))
DOCUMENTS = _cols(("doc_id", "integer"), ("text", "string"), ("lang", "string"), ("source", "string"),
                 ("n_chars", "integer"))
CUSTOMER_AUDITED = _cols(("c_custkey", "integer"), ("c_name", "string"), ("_rowHash", "string"),
                         ("_processedTimestamp", "timestamp"), ("c_nationkey", "integer"), ("c_acctbal", "float"),
                         ("c_mktsegment", "string"))
CUSTOMER_AMOUNT = _cols(("c_custkey", "integer"), ("amount", "double"))
LINEITEM_NESTED = _cols(("l_orderkey", "integer"), ("l_linenumber", "integer")) + [
    {"name": "flags", "type": "dict", "columns": _cols(("returnflag", "string"), ("linestatus", "string"),
                                                       ("shipdate", "timestamp"), ("note", "string"))},
    {"name": "amounts", "type": "list", "columns": _cols(("kind", "string"), ("value", "float"))},
]


def spec(name: str, columns: list[dict], paged: bool = True, max_pages: int | None = None) -> DatasetSpec:
    doc = {"responsePath": KEY, "pagination": {"enabled": paged, "maxPages": max_pages}, "columns": columns}
    return dataset_spec(doc, source=SOURCE, name=name)


def event_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_as_pages(table(spark, sf_dir, "events"), KEY, PAGE_SIZE, index="event_id")


def _audited_view(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c) for c in df.columns if c != PROCESSED_TIMESTAMP],
                     F.col(PROCESSED_TIMESTAMP).isNotNull().alias("has_ts"))


def _middle_page(pages: DataFrame):
    """The middle page number, as a scalar subquery over the pages."""
    return pages.agg(F.floor(F.max(PAGE) / 2) + 1).scalar()


def _with_middle_stop(pages: DataFrame) -> DataFrame:
    """Empty the middle page; break the two pages after it (status 500, truncated JSON)."""
    stop = _middle_page(pages)
    return pages.select(
        PAGE,
        F.when(F.col(PAGE) == stop + 1, F.lit(500)).otherwise(F.col(STATUS)).alias(STATUS),
        F.when(F.col(PAGE) == stop, F.lit('{"body":[]}'))
        .when(F.col(PAGE) == stop + 2, F.substring(F.col(BODY), 1, 20))
        .otherwise(F.col(BODY)).alias(BODY),
    )


# ---------------------------------------------------------------------------
# A1: row hash of whole tables
# ---------------------------------------------------------------------------


def _row_hash_query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: with_row_hash(table(spark, sf_dir, name))


def row_hash_null_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    nulled = c.select("c_custkey", F.nullif("c_name", F.lit("Customer#000000001")).alias("c_name"),
                      F.nullif("c_nationkey", F.lit(0)).alias("c_nationkey"), "c_acctbal",
                      F.nullif("c_mktsegment", F.lit("BUILDING")).alias("c_mktsegment"))
    return with_row_hash(nulled)


# ---------------------------------------------------------------------------
# S1-S6, P1-P4: pages -> typed records
# ---------------------------------------------------------------------------


def pages_parse_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_records(event_pages(spark, sf_dir), spec("events_parse", EVENTS))


def pages_stop_at_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_records(_with_middle_stop(event_pages(spark, sf_dir)), spec("events_stop", EVENTS))


def pages_checked_lazy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end page also holds when the pages come back from their landed copy, in no order."""
    folder = scratch_folder(spark, "landed") + "/pages"
    pages = read_landed_pages(spark, land_pages(_with_middle_stop(event_pages(spark, sf_dir)), folder))
    records = read_records(pages, spec("events_lazy", EVENTS))
    remove_folder(spark, folder)  # the result reads the staged pages only
    return records


def pages_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each kind of page is found to be: every tenth page of each kind, the others whole."""
    number = F.col(PAGE).cast("string")
    kind = F.col(PAGE) % 10
    body = (F.when(kind == 2, F.concat(F.lit("down "), number))
            .when(kind == 3, F.concat(F.lit('{"body":[{"event_id":'), number, F.lit(",")))
            .when(kind == 4, F.concat(F.lit('{"body":[]} garbage '), number))
            .when(kind == 5, F.lit('{"body":[]}{"body":[]}'))
            .when(kind == 6, F.lit('{"body":{}}'))
            .when(kind == 7, F.concat(F.lit('{"other":'), number, F.lit("}")))
            .when(kind == 8, F.lit("{'body':[{'event_id':1}]}"))
            .when(kind == 9, F.lit('{"body":[null]}'))
            .when(kind == 0, F.concat(F.lit(" \n"), F.col(BODY), F.lit("\n ")))
            .otherwise(F.col(BODY)))
    status = F.when(kind == 2, F.lit(500)).otherwise(F.col(STATUS))
    pages = event_pages(spark, sf_dir).select(PAGE, status.alias(STATUS), body.alias(BODY))
    return parse_pages(pages, spec("events_flags", EVENTS)).drop("records")


def pages_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    n_pages = -(-events.count() // PAGE_SIZE)
    cap = n_pages - n_pages // 4
    pages = event_pages(spark, sf_dir)
    # the last page fails, but lies beyond the cap
    pages = pages.withColumn(STATUS, F.when(F.col(PAGE) == n_pages, F.lit(503)).otherwise(F.col(STATUS)))
    return read_records(pages, spec("events_cap", EVENTS, max_pages=cap))


def single_request_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page is a separate single-request response; an empty one is an empty result, not the end."""
    pages = event_pages(spark, sf_dir)
    middle = _middle_page(pages)
    pages = pages.select(PAGE, STATUS, F.when(F.col(PAGE) == middle, F.lit('{"body":[]}')).otherwise(F.col(BODY))
                         .alias(BODY))
    return read_records(pages, spec("events_single", EVENTS, paged=False))


def schema_fallback_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = records_as_pages(table(spark, sf_dir, "customer"), KEY, PAGE_SIZE, index="c_custkey")
    return read_records(pages, spec("customer_fallback", CUSTOMER_FALLBACK))


def schema_missing_and_extra(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = records_as_pages(table(spark, sf_dir, "orders"), KEY, PAGE_SIZE, index="o_orderkey")
    return read_records(pages, spec("orders_partial", ORDERS_PARTIAL))


NUMBER_POWERS = range(-8, 19)


def schema_number_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from 1e-8 to 1e23 in a text column, and the row hash over their texts."""
    c = table(spark, sf_dir, "customer")
    power = F.get(F.array(*[F.lit(float(f"1e{k}")) for k in NUMBER_POWERS]),
                  (F.col("c_custkey") % len(NUMBER_POWERS)).cast("int"))
    pages = records_as_pages(c, KEY, PAGE_SIZE, index="c_custkey",
                             record=F.struct("c_custkey", (F.col("c_acctbal") * power).alias("amount")))
    return with_row_hash(read_records(pages, spec("customer_amounts", CUSTOMER_AMOUNT)))


def lineitem_nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    amounts = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"l_{k}").alias("value"))
                        for k in ("quantity", "extendedprice", "discount", "tax")])
    record = F.struct(
        "l_orderkey", "l_linenumber",
        F.struct(F.col("l_returnflag").alias("returnflag"), F.col("l_linestatus").alias("linestatus"),
                 F.col("l_shipdate").cast("string").alias("shipdate")).alias("flags"),
        amounts.alias("amounts"),
    )
    return records_as_pages(li, KEY, PAGE_SIZE, record=record)


def schema_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_records(lineitem_nested_pages(spark, sf_dir), spec("lineitem_nested", LINEITEM_NESTED))
    return rows.selectExpr("l_orderkey", "l_linenumber", "flags.returnflag", "flags.linestatus", "flags.shipdate",
                           "flags.note", "inline(amounts)")


# ---------------------------------------------------------------------------
# P5, A1, A2: audit columns declared in the schema keep their place
# ---------------------------------------------------------------------------


def audit_replace_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = records_as_pages(table(spark, sf_dir, "customer"), KEY, PAGE_SIZE, index="c_custkey")
    return _audited_view(with_audit_columns(read_records(pages, spec("customer_audited", CUSTOMER_AUDITED))))


# ---------------------------------------------------------------------------
# S1 file-backed and data-source page readers
# ---------------------------------------------------------------------------


def _landed_packs(spark: SparkSession, sf_dir: str) -> str:
    return land_page_packs(event_pages(spark, sf_dir), scratch_folder(spark, "landed") + "/packs")


def pages_landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _landed_packs(spark, sf_dir)
    records = read_records(read_page_packs(spark, folder), spec("events_landed", EVENTS))
    remove_folder(spark, folder)  # the result reads the staged pages only
    return records


def stream_landed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed packs parsed by a streaming query (available-now), then checked and written."""
    from pagelake.streaming.landing import ingest_landed

    folder, root = _landed_packs(spark, sf_dir), scratch_folder(spark, "stream")
    result = ingest_landed(spark, folder, spec("events_stream", EVENTS), layer=LAYER, root=root)
    remove_folder(spark, folder)
    remove_folder(spark, root)
    return _audited_view(spark.table(result.table))


def pages_data_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages requested by the ``paged_json`` data source (folder transport), in waves of 16 pages and twice as many each time."""
    folder = _landed_packs(spark, sf_dir)
    src = SourceSpec(name=SOURCE, base_url=folder, first_wave=16)
    ds = spec("events_api", EVENTS)
    result = ingest(spark, ds, source=src, target=CatalogTarget(), layer=LAYER)
    remove_folder(spark, folder)
    return _audited_view(spark.table(result.table))


def single_request_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as single responses, one for each range of 100 keys, through both readers of such responses."""
    ranges = records_as_pages(table(spark, sf_dir, "orders"), KEY, PAGE_SIZE, index="o_orderkey")
    folder = land_page_packs(ranges, scratch_folder(spark, "response") + "/packs")
    ds = spec("order_ranges", ORDERS_PARTIAL, paged=False)
    requested = ingest(spark, ds, source=SourceSpec(name=SOURCE, base_url=folder), layer=LAYER)
    read = read_records(read_page_packs(spark, folder), ds)
    remove_folder(spark, folder)
    names = ds.schema.names
    named = spark.table(requested.table).select(F.lit("request").alias("reader"), *names)
    return named.unionByName(read.select(F.lit("file").alias("reader"), *names))


# ---------------------------------------------------------------------------
# S5: requests as rows, answered by a table
# ---------------------------------------------------------------------------

SERVICE = "https://api.example.test/v2/"
SERVICE_HEADERS = {"x-client": "pagelake", "accept": "application/json"}
ORDERS_FEED = dataset_spec(
    {"responsePath": KEY, "pagination": {"enabled": True}, "columns": ORDERS_PARTIAL}, source=SOURCE, name="orders_feed",
    endpoint="/orders", params={"type": "ORDERS & returns", "sort": "key*~", "page": "0"})


def _orders_service(spark: SparkSession, sf_dir: str, name: str) -> SourceSpec:
    """A source whose transport is a table of what a service of all orders says to each attempt of each request.

    Pages 3, 10, 17 .. answer 503 at first, pages 5, 16, 27 .. answer 429 and then nothing at all before they succeed.
    The page after the last one is empty; requests without the client's header are refused.
    """
    pages = records_as_pages(table(spark, sf_dir, "orders"), KEY, PAGE_SIZE, index="o_orderkey")
    end = pages.agg((F.max(PAGE) + 1).alias(PAGE)).select(PAGE, F.lit(200).alias(STATUS), F.lit('{"body":[]}').alias(BODY))
    first = (F.when(F.col(PAGE) % 11 == 5, F.array(F.lit(429), F.lit(-1))).when(F.col(PAGE) % 7 == 3, F.array(F.lit(503)))
             .otherwise(F.array().cast("array<int>")))
    said = pages.unionByName(end).select(PAGE, BODY, F.posexplode(F.concat(first, F.array(F.lit(200)))).alias("attempt", STATUS))
    request = F.concat(F.lit(f"{SERVICE}orders?type=ORDERS+%26+returns&sort=key%2A~&page="), F.col(PAGE).cast("string"))
    answers = said.select(request.alias("request"), "attempt", STATUS,
                          F.when(F.col(STATUS) == 200, F.col(BODY)).otherwise(F.lit("later")).alias(BODY),
                          F.create_map(F.lit("x-client"), F.lit(SERVICE_HEADERS["x-client"])).alias("headers"))
    target = CatalogTarget()
    target.ensure_namespace(spark, LAYER)
    recorded = target.overwrite(answers, LAYER, name)
    return SourceSpec(SOURCE, base_url=SERVICE, headers=SERVICE_HEADERS, timeout=12.5, retries=2,
                      transport=f"{TABLE}{recorded}")


def requests_shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request that a load of all orders sends, transient failures and the empty last page included."""
    source = _orders_service(spark, sf_dir, "orders_said")
    last = -(-table(spark, sf_dir, "orders").count() // PAGE_SIZE) + 1
    sent = transport_of(spark, source).attempts(shape_requests(spark, source, ORDERS_FEED, 1, last))
    params, headers = F.col("params"), F.col("headers")
    return sent.select(PAGE, "attempt", "request", "url", params["type"].alias("type"), params["page"].alias("page_param"),
                       F.size(params).cast("int").alias("n_params"), headers["x-client"].alias("client"),
                       headers["accept"].alias("accept"), "timeout", "attempts", STATUS)


def requests_answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders loaded through the transport, in waves that end with the empty page."""
    result = ingest(spark, ORDERS_FEED, source=_orders_service(spark, sf_dir, "orders_answered"), layer=LAYER)
    return _audited_view(spark.table(result.table))


# ---------------------------------------------------------------------------
# W1-W4, C1, C2: ingest into catalog tables
# ---------------------------------------------------------------------------


def ingest_end_to_end(spark: SparkSession, sf_dir: str, dataset: str = "events") -> DataFrame:
    result = ingest(spark, spec(dataset, EVENTS), pages=event_pages(spark, sf_dir), layer=LAYER)
    return _audited_view(spark.table(result.table))


def ingest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents (up to 20,000 words each) through pages, typing, hashing and the sink."""
    pages = records_as_pages(table(spark, sf_dir, "documents"), KEY, PAGE_SIZE, index="doc_id")
    result = ingest(spark, spec("documents", DOCUMENTS), pages=pages, layer=LAYER)
    return _audited_view(spark.table(result.table))


def sink_failed_load_keeps_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load customer, then let a load of orders fail while its rows are written: the customer load stays."""
    first = records_as_pages(table(spark, sf_dir, "customer"), KEY, PAGE_SIZE, index="c_custkey")
    result = ingest(spark, spec("kept_accounts", CUSTOMER_FALLBACK), pages=first, layer=LAYER)
    second = records_as_pages(table(spark, sf_dir, "orders"), KEY, PAGE_SIZE, index="o_orderkey")
    try:
        ingest(spark, spec("kept_accounts", ORDERS_PARTIAL), pages=second, layer=LAYER,
               transform=lambda df: df.withColumn("o_clerk", F.raise_error(F.lit("this load fails")).cast("string")))
    except Exception as failure:
        if "this load fails" not in str(failure):
            raise
    else:
        raise AssertionError("the second load was to fail")
    return _audited_view(spark.table(result.table))


def sql_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A statement with bound parameters, run against the catalog target; its effect is read back."""
    target = CatalogTarget()
    pages = records_as_pages(table(spark, sf_dir, "customer"), KEY, PAGE_SIZE, index="c_custkey")
    loaded = ingest(spark, spec("customers", CUSTOMER_AUDITED), pages=pages, target=target, layer=LAYER)
    source = spark.table(loaded.table).select("c_custkey", "c_name", "c_nationkey")
    chosen = target.overwrite(source.limit(0), LAYER, table_name(SOURCE, "chosen_customers"))
    target.execute(spark, f"INSERT INTO {chosen} SELECT c_custkey, c_name, c_nationkey FROM {loaded.table} "
                          "WHERE c_mktsegment = ? AND c_nationkey < ?", "BUILDING", 10)
    return spark.table(chosen)


def sink_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load ``replay.accounts`` from customer, then again from orders: the table holds the orders load only."""
    first = records_as_pages(table(spark, sf_dir, "customer"), KEY, PAGE_SIZE, index="c_custkey")
    ingest(spark, spec("accounts", CUSTOMER_FALLBACK), pages=first, layer=LAYER)
    second = records_as_pages(table(spark, sf_dir, "orders"), KEY, PAGE_SIZE, index="o_orderkey")
    result = ingest(spark, spec("accounts", ORDERS_PARTIAL), pages=second, layer=LAYER)
    return _audited_view(spark.table(result.table))


def sink_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same dataset loaded twice: the second load has other rows, and the table is pointed at them."""
    ds = spec("loaded_twice", EVENTS)
    ingest(spark, ds, pages=event_pages(spark, sf_dir), layer=LAYER)
    result = ingest(spark, ds, pages=_with_middle_stop(event_pages(spark, sf_dir)), layer=LAYER)
    return _audited_view(spark.table(result.table))


class _SwitchFails(CatalogTarget):
    """A target that looks for a finished load in the wrong place when it makes its table."""

    def _create(self, spark: SparkSession, name: str, folder: str) -> None:
        super()._create(spark, name, folder + "/gone")


def sink_failed_switch_keeps_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load customer, then let the switch to a finished load of orders (other columns) fail: the customer load stays."""
    first = records_as_pages(table(spark, sf_dir, "customer"), KEY, PAGE_SIZE, index="c_custkey")
    result = ingest(spark, spec("switched_accounts", CUSTOMER_FALLBACK), pages=first, layer=LAYER)
    second = records_as_pages(table(spark, sf_dir, "orders"), KEY, PAGE_SIZE, index="o_orderkey")
    try:
        ingest(spark, spec("switched_accounts", ORDERS_PARTIAL), pages=second, layer=LAYER, target=_SwitchFails())
    except Exception as failure:
        if "UNABLE_TO_INFER_SCHEMA" not in str(failure):
            raise
    else:
        raise AssertionError("the switch was to fail")
    return _audited_view(spark.table(result.table))


RUN_CONFIG = {
    "sources": {
        SOURCE: {
            "enabled": True,
            "datasets": {"run_customers": {"enabled": True}, "run_orders": {"enabled": False},
                         "run_events": {"enabled": True}},
        },
        "other": {"enabled": False, "datasets": {"x": {"enabled": True}}},
    }
}


def multi_dataset_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"run_customers": ("customer", "c_custkey", CUSTOMER_FALLBACK),
              "run_orders": ("orders", "o_orderkey", ORDERS_PARTIAL),
              "run_events": ("events", "event_id", EVENTS)}
    src = SourceSpec(name=SOURCE, datasets=tuple(spec(n, cols) for n, (_, _, cols) in tables.items()))
    other = SourceSpec(name="other", datasets=(spec("x", EVENTS),))

    def pages_for(source: SourceSpec, ds: DatasetSpec) -> DataFrame:
        name, index, _ = tables[ds.name]
        return records_as_pages(table(spark, sf_dir, name), KEY, PAGE_SIZE, index=index)

    results = run(spark, [src, other], RUN_CONFIG, selector=SOURCE, layer=LAYER, pages_for=pages_for)
    parts = [spark.table(r.table).select(F.lit(r.dataset).alias("dataset"), ROW_HASH) for r in results]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "row_hash_customer": _row_hash_query("customer"),
    "row_hash_orders": _row_hash_query("orders"),
    "row_hash_lineitem": _row_hash_query("lineitem"),
    "row_hash_events": _row_hash_query("events"),
    "row_hash_documents": _row_hash_query("documents"),
    "row_hash_null_skip": row_hash_null_skip,
    "pages_parse_events": pages_parse_events,
    "pages_stop_at_empty": pages_stop_at_empty,
    "pages_checked_lazy": pages_checked_lazy,
    "pages_cap": pages_cap,
    "pages_flags": pages_flags,
    "single_request_api": single_request_api,
    "single_request_events": single_request_events,
    "requests_shaped": requests_shaped,
    "requests_answered": requests_answered,
    "schema_fallback_string": schema_fallback_string,
    "schema_missing_and_extra": schema_missing_and_extra,
    "schema_number_text": schema_number_text,
    "schema_nested": schema_nested,
    "audit_replace_in_place": audit_replace_in_place,
    "pages_landed_files": pages_landed_files,
    "pages_data_source": pages_data_source,
    "stream_landed_ingest": stream_landed_ingest,
    "ingest_end_to_end": ingest_end_to_end,
    "ingest_documents": ingest_documents,
    "sink_overwrite": sink_overwrite,
    "sink_failed_load_keeps_table": sink_failed_load_keeps_table,
    "sink_load_twice": sink_load_twice,
    "sink_failed_switch_keeps_table": sink_failed_switch_keeps_table,
    "sql_parameters": sql_parameters,
    "multi_dataset_run": multi_dataset_run,
}


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------

_EVENTS_TYPED = ("CAST(event_id AS INTEGER) AS event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, "
                 "CAST(value AS FLOAT) AS value, props")
_EVENTS_HASH = ("sha256(concat_ws('||', CAST(event_id AS INTEGER), ts, CAST(user_id AS INTEGER), event_type, "
                "CAST(value AS FLOAT), props))")
_HALF = "(SELECT floor((max(event_id) // 100 + 1) / 2) + 1 FROM events)"
_CUSTOMER_FALLBACK = ("CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey, "
                      "CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment")
_CUSTOMER_FALLBACK_HASH = ("sha256(concat_ws('||', CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS INTEGER), "
                           "CAST(c_acctbal AS VARCHAR), c_mktsegment))")
_ORDERS_PARTIAL = ("CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus, "
                   "CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_clerk")
_ORDERS_PARTIAL_HASH = ("sha256(concat_ws('||', CAST(o_orderkey AS INTEGER), CAST(o_custkey AS INTEGER), o_orderstatus, "
                        "CAST(o_totalprice AS VARCHAR), o_orderdate))")


def _hash_all(t: str, cols: str) -> str:
    return f"SELECT *, sha256(concat_ws('||', {cols})) AS _rowHash FROM {t}"


_FLAGS = """
WITH p AS (SELECT event_id // 100 + 1 AS page, count(*) AS n FROM events GROUP BY 1),
k AS (SELECT *, page % 10 AS kind FROM p)
SELECT page, CAST(CASE WHEN kind = 2 THEN 500 ELSE 200 END AS INTEGER) AS status,
       CAST(CASE WHEN kind IN (0, 1) THEN n ELSE 0 END AS INTEGER) AS n_records,
       kind IN (2, 3, 4, 5, 8, 9) AS bad, kind IN (6, 7) AS empty,
       'page ' || page || CASE kind
         WHEN 2 THEN ' answered 500: down ' || page
         WHEN 3 THEN ' is not one JSON document: {"body":[{"event_id":' || page || ','
         WHEN 4 THEN ' is not one JSON document: {"body":[]} garbage ' || page
         WHEN 5 THEN ' is not one JSON document: {"body":[]}{"body":[]}'
         WHEN 8 THEN ' is not one JSON document: {''body'':[{''event_id'':1}]}'
         WHEN 9 THEN ' has a null record: {"body":[null]}' END AS problem
FROM k"""

_NUMBER_TEXT = f"""
SELECT c_custkey, amount, sha256(concat_ws('||', c_custkey, amount)) AS _rowHash
FROM (SELECT CAST(c_custkey AS INTEGER) AS c_custkey, CAST(c_acctbal * CAST(
        [{", ".join(f"'1e{k}'" for k in NUMBER_POWERS)}][c_custkey % {len(NUMBER_POWERS)} + 1] AS DOUBLE) AS VARCHAR) AS amount
      FROM customer)"""

_REQUESTS = """
WITH p AS (SELECT unnest(range(1, (SELECT max(o_orderkey) // 100 + 3 FROM orders))) AS page),
said AS (SELECT page, CASE WHEN page % 11 = 5 THEN [429, -1, 200] WHEN page % 7 = 3 THEN [503, 200] ELSE [200] END AS s FROM p),
sent AS (SELECT page, s, unnest(range(len(s))) AS attempt FROM said)
SELECT page, CAST(attempt AS INTEGER) AS attempt,
       'https://api.example.test/v2/orders?type=ORDERS+%26+returns&sort=key%2A~&page=' || page AS request,
       'https://api.example.test/v2/orders' AS url, 'ORDERS & returns' AS type, CAST(page AS VARCHAR) AS page_param,
       3 AS n_params, 'pagelake' AS client, 'application/json' AS accept, CAST(12.5 AS DOUBLE) AS timeout, 3 AS attempts,
       s[attempt + 1] AS status
FROM sent"""

ORACLES: dict[str, str] = {
    "requests_shaped": _REQUESTS,
    "requests_answered": f"SELECT {_ORDERS_PARTIAL}, {_ORDERS_PARTIAL_HASH} AS _rowHash, true AS has_ts FROM orders",
    "pages_flags": _FLAGS,
    "schema_number_text": _NUMBER_TEXT,
    "single_request_api": " UNION ALL ".join(
        f"SELECT '{r}' AS reader, {_ORDERS_PARTIAL} FROM orders" for r in ("request", "file")),
    "sink_failed_load_keeps_table": f"SELECT {_CUSTOMER_FALLBACK}, {_CUSTOMER_FALLBACK_HASH} AS _rowHash, "
                                    "true AS has_ts FROM customer",
    "sink_failed_switch_keeps_table": f"SELECT {_CUSTOMER_FALLBACK}, {_CUSTOMER_FALLBACK_HASH} AS _rowHash, "
                                      "true AS has_ts FROM customer",
    "sink_load_twice": f"SELECT {_EVENTS_TYPED}, {_EVENTS_HASH} AS _rowHash, true AS has_ts FROM events "
                       f"WHERE event_id // 100 + 1 < {_HALF}",
    "sql_parameters": "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS "
                      "c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 10",
    "row_hash_customer": _hash_all("customer", "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"),
    "row_hash_orders": _hash_all("orders", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, "
                                           "o_orderpriority"),
    "row_hash_lineitem": _hash_all("lineitem", "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
                                               "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, "
                                               "l_shipdate"),
    "row_hash_events": _hash_all("events", "event_id, ts, user_id, event_type, value, props"),
    "row_hash_documents": _hash_all("documents", "doc_id, text, lang, source, n_chars"),
    "row_hash_null_skip": (
        "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, "
        "sha256(concat_ws('||', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)) AS _rowHash FROM ("
        "SELECT c_custkey, nullif(c_name, 'Customer#000000001') AS c_name, nullif(c_nationkey, 0) AS c_nationkey, "
        "c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer)"
    ),
    "pages_parse_events": f"SELECT {_EVENTS_TYPED} FROM events",
    "pages_stop_at_empty": f"SELECT {_EVENTS_TYPED} FROM events WHERE event_id // 100 + 1 < {_HALF}",
    "pages_checked_lazy": f"SELECT {_EVENTS_TYPED} FROM events WHERE event_id // 100 + 1 < {_HALF}",
    "pages_cap": (
        f"SELECT {_EVENTS_TYPED} FROM events WHERE event_id // 100 + 1 <= "
        "(SELECT ceil(count(*) / 100) - floor(ceil(count(*) / 100) / 4) FROM events)"
    ),
    "single_request_events": f"SELECT {_EVENTS_TYPED} FROM events WHERE event_id // 100 + 1 <> {_HALF}",
    "schema_fallback_string": f"SELECT {_CUSTOMER_FALLBACK} FROM customer",
    "schema_missing_and_extra": f"SELECT {_ORDERS_PARTIAL} FROM orders",
    "schema_nested": " UNION ALL ".join(
        "SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, "
        "l_returnflag AS returnflag, l_linestatus AS linestatus, l_shipdate AS shipdate, CAST(NULL AS VARCHAR) AS note, "
        f"'{k}' AS kind, CAST(l_{k} AS FLOAT) AS value FROM lineitem"
        for k in ("quantity", "extendedprice", "discount", "tax")
    ),
    "audit_replace_in_place": (
        "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, "
        "sha256(concat_ws('||', CAST(c_custkey AS INTEGER), c_name, CAST(c_nationkey AS INTEGER), "
        "CAST(c_acctbal AS FLOAT), c_mktsegment)) AS _rowHash, true AS has_ts, "
        "CAST(c_nationkey AS INTEGER) AS c_nationkey, CAST(c_acctbal AS FLOAT) AS c_acctbal, c_mktsegment FROM customer"
    ),
    "pages_landed_files": f"SELECT {_EVENTS_TYPED} FROM events",
    "pages_data_source": f"SELECT {_EVENTS_TYPED}, {_EVENTS_HASH} AS _rowHash, true AS has_ts FROM events",
    "stream_landed_ingest": f"SELECT {_EVENTS_TYPED}, {_EVENTS_HASH} AS _rowHash, true AS has_ts FROM events",
    "ingest_end_to_end": f"SELECT {_EVENTS_TYPED}, {_EVENTS_HASH} AS _rowHash, true AS has_ts FROM events",
    "ingest_documents": (
        "SELECT CAST(doc_id AS INTEGER) AS doc_id, text, lang, source, CAST(n_chars AS INTEGER) AS n_chars, "
        "sha256(concat_ws('||', CAST(doc_id AS INTEGER), text, lang, source, CAST(n_chars AS INTEGER))) AS _rowHash, "
        "true AS has_ts FROM documents"
    ),
    "sink_overwrite": f"SELECT {_ORDERS_PARTIAL}, {_ORDERS_PARTIAL_HASH} AS _rowHash, true AS has_ts FROM orders",
    "multi_dataset_run": (
        f"SELECT 'replay.run_customers' AS dataset, {_CUSTOMER_FALLBACK_HASH} AS _rowHash FROM customer "
        f"UNION ALL SELECT 'replay.run_events' AS dataset, {_EVENTS_HASH} AS _rowHash FROM events"
    ),
}
