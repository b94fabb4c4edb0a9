"""Paged JSON responses -> typed record rows.

Input rows are responses: ``page BIGINT, status INT, body STRING`` - one row per
requested page (paged endpoints) or per request (single-request endpoints).

Paged semantics (what a sequential client that requests page=1,2,... sees):

* ``maxPages`` caps the pages read (``page <= maxPages``; 0 reads nothing).
* The first page whose value under the response key is missing, null or falsy
  (``[]``, ``{}``, ``""``, ``0``, ``false``) ends the scan; later pages are
  ignored, even when they hold records or failed.
* A page before the end that failed (HTTP status >= 400, body not a JSON
  object, records that do not fit the declared schema, a null record) fails the
  whole dataset.  So does a missing or repeated page number before the end.

Single-request semantics: every response must hold an array under the key (an
empty array is an empty result); there is no end-of-data rule.

Because pages can be fetched in parallel, pages past the end may have been
fetched and may be broken.  Every page is therefore parsed PERMISSIVE with a
corrupt-record column into flags (``bad``/``empty``); the decision to fail is
taken only after the end page is known: :func:`stage_pages` parses once and writes
the parsed pages next to the other shared job data, :func:`check_pages` decides on
the narrow flag columns, then records of pages ``< stop`` are read (a pushed-down
Parquet filter).

A body is one JSON document: text behind it, a second document, single quotes, and
``NaN`` or ``Infinity`` in quotes are failures.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.functions.numbers import kinds_schema, with_number_texts
from pagelake.functions.schema import DatasetSpec
from pagelake.session import remove_folder, scratch_folder

PAGE, STATUS, BODY = "page", "status", "body"
RECORDS, BAD, EMPTY, PROBLEM, N_RECORDS = "records", "bad", "empty", "problem", "n_records"
PAGE_SCHEMA = T.StructType(
    [T.StructField(PAGE, T.LongType()), T.StructField(STATUS, T.IntegerType()), T.StructField(BODY, T.StringType())]
)
_JSON = "_json"
_STOP = "_stop"
# A body is parsed as the only element of a list that a mark follows: whatever stands behind a
# document either adds elements or keeps the parser from reaching the mark.
_DOCUMENT, _MARK = "_document", "_mark"
_JSON_OPTIONS = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


class PageError(ValueError):
    """A page before the end of data failed; nothing may be written."""


def _corrupt_name(key: str) -> str:
    return "_corrupt_page"


def _falsy(value: Column) -> Column:
    """Python truthiness of a JSON value held as VARIANT (null when not falsy-checkable)."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "OBJECT<>", F.lit(True))
        .when(kind == "STRING", F.variant_get(value, "$", "string") == "")
        .when(kind == "BOOLEAN", ~F.variant_get(value, "$", "boolean"))
        .when(kind.rlike("^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"), F.variant_get(value, "$", "double") == 0)
        .otherwise(F.lit(False))
    )


def _enclosed(document: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(_DOCUMENT, T.ArrayType(document)), T.StructField(_MARK, T.BooleanType())])


def cap_pages(pages: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Keep pages ``<= maxPages`` (paged endpoints with a cap); pushed into the scan."""
    if spec.paging.enabled and spec.paging.max_pages is not None:
        return pages.where(F.col(PAGE) <= F.lit(int(spec.paging.max_pages)))
    return pages


def parse_pages(pages: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row per response: ``page, status, records ARRAY<record>, n_records, bad, empty, problem``.

    The body is parsed once with the declared record schema (PERMISSIVE, corrupt
    column).  Only corrupt bodies are parsed a second time, into a VARIANT, to
    tell a falsy value (end of data) from a malformed one.  Each step is its own
    projection so the parsed values are computed once and referenced by name.
    """
    key = spec.response_path
    paged = spec.paging.enabled
    corrupt = _corrupt_name(key)
    envelope = _enclosed(T.StructType([T.StructField(key, T.ArrayType(spec.schema))])).add(corrupt, T.StringType())
    probe_schema = _enclosed(T.StructType([T.StructField(key, T.VariantType())]))
    c = F.col
    enclosed = F.concat(F.lit(f'{{"{_DOCUMENT}":['), F.coalesce(BODY, F.lit("")), F.lit(f'],"{_MARK}":true}}'))
    parsed = pages.select(
        c(PAGE).cast("long").alias(PAGE),
        c(STATUS).cast("int").alias(STATUS),
        BODY,
        F.from_json(enclosed, envelope, _JSON_OPTIONS | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt})
        .alias(_JSON),
    )
    parsed = parsed.select(
        PAGE, STATUS, BODY,
        F.get(c(_JSON).getField(_DOCUMENT), F.lit(0)).alias("_doc"),
        F.size(c(_JSON).getField(_DOCUMENT)).alias("_documents"),
        c(_JSON).getField(_MARK).alias("_ended"),
        (c(_JSON).isNull() | c(_JSON).getField(corrupt).isNotNull()).alias("_corrupt"),
    )
    parsed = parsed.select(
        "*", F.when(c("_corrupt"), F.from_json(enclosed, probe_schema, _JSON_OPTIONS)).alias("_probe"))
    one = F.size(c("_probe").getField(_DOCUMENT)) == 1
    value = F.get(c("_probe").getField(_DOCUMENT), F.lit(0)).getField(key)
    parsed = parsed.select(
        PAGE, STATUS, BODY, "_corrupt", c("_doc").getField(key).alias("_arr"),
        # one whole document: decided by the second parse where the declared schema does not fit
        F.coalesce(F.when(c("_corrupt"), c("_probe").getField(_MARK) & one)
                   .otherwise(c("_ended") & (c("_documents") == 1)), F.lit(False)).alias("_whole"),
        F.coalesce(F.when(c("_corrupt"), F.get(c("_probe").getField(_DOCUMENT), F.lit(0)).isNotNull())
                   .otherwise(c("_doc").isNotNull()), F.lit(False)).alias("_object"),
        F.when(c("_corrupt"), value).alias("_value"),
    )
    kinds_of = kinds_schema(spec.schema)
    if kinds_of is not None:  # numbers in string columns: a third parse, of pages that have some
        kinds = F.get(F.from_json(enclosed, _enclosed(T.StructType([T.StructField(key, T.ArrayType(kinds_of))])), _JSON_OPTIONS)
                      .getField(_DOCUMENT), F.lit(0)).getField(key)
        texts = with_number_texts(c("_arr"), T.ArrayType(spec.schema), kinds)
        parsed = parsed.withColumn("_arr", F.when(c("_corrupt"), c("_arr")).otherwise(texts))
    parsed = parsed.select("*", (c("_whole") & F.coalesce(_falsy(c("_value")), F.lit(False))).alias("_falsy"))
    parsed = parsed.select("*", (~c("_whole") | ~c("_object")).alias("_unparsed"))
    http_error = (F.coalesce(c(STATUS), F.lit(200)) >= 400) | (c(STATUS) < 0)
    if paged:
        unreadable = c("_unparsed") | (c("_corrupt") & ~c("_falsy"))
        missing = F.lit(False)
    else:
        unreadable = c("_unparsed") | c("_corrupt")
        missing = c("_arr").isNull() & ~c("_unparsed") & ~c("_corrupt")
    null_record = F.coalesce(F.exists(c("_arr"), lambda r: r.isNull()), F.lit(False))
    parsed = parsed.select(
        PAGE, STATUS, BODY, "_arr", "_corrupt", "_falsy", "_whole", "_object",
        http_error.alias("_http"), unreadable.alias("_unreadable"), null_record.alias("_null_record"),
        missing.alias("_missing"),
    )
    bad = c("_http") | c("_unreadable") | c("_null_record") | c("_missing")
    parsed = parsed.select("*", bad.alias(BAD))
    if paged:
        empty = ~c(BAD) & (c("_arr").isNull() | (F.size(c("_arr")) == 0) | (c("_corrupt") & c("_falsy")))
    else:
        empty = F.lit(False)
    parsed = parsed.select("*", empty.alias(EMPTY))
    problem = F.concat(
        F.lit("page "), c(PAGE).cast("string"),
        F.when(c("_http"), F.concat(F.lit(" answered "), c(STATUS).cast("string")))
        .when(~c("_whole"), F.lit(" is not one JSON document"))
        .when(~c("_object"), F.lit(" is not a JSON object"))
        .when(c("_unreadable"), F.lit(f" has values under '{key}' that do not fit the declared columns"))
        .when(c("_null_record"), F.lit(" has a null record"))
        .when(c("_missing"), F.lit(f" has no list under '{key}'")),
        F.lit(": "), F.coalesce(BODY, F.lit("")),
    )
    keep = ~c(BAD) & ~c(EMPTY)
    return parsed.select(
        PAGE,
        STATUS,
        F.when(keep, c("_arr")).alias(RECORDS),
        F.when(keep, F.size(c("_arr"))).otherwise(F.lit(0)).alias(N_RECORDS),
        BAD,
        EMPTY,
        F.when(c(BAD), problem).alias(PROBLEM),
    )


# ---------------------------------------------------------------------------
# Deciding: end page, failures before it, page-number gaps
# ---------------------------------------------------------------------------


def _flags(parsed: DataFrame) -> DataFrame:
    return parsed.select(PAGE, BAD, EMPTY, N_RECORDS)


def _end_page(flags: DataFrame) -> DataFrame:
    """One row, one column: the first empty page (null when there is none)."""
    return flags.agg(F.min(F.when(F.col(EMPTY), F.col(PAGE))).alias(_STOP))


def page_set(flags: DataFrame, *more: Column) -> DataFrame:
    """Page numbers as a set that merges: one row per ``bucket`` of 32,768 numbers, with the bitmap ``seen`` of those
    that occur, how many rows have one (``n``), and the ``more`` aggregates.

    Tasks send a bitmap of 4 KB for each bucket they meet, never the numbers.
    """
    bucket = F.bitmap_bucket_number(F.col(PAGE)).alias("bucket")
    return flags.groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(PAGE))).alias("seen"),
                                     F.count(F.lit(1)).alias("n"), *more)


def _summary(kept: DataFrame) -> DataFrame:
    """One row over the pages before the end: counts, page range, records, first bad page."""
    buckets = page_set(kept, F.min(PAGE).alias("lo"), F.max(PAGE).alias("hi"), F.sum(N_RECORDS).alias("records"),
                       F.min(F.when(F.col(BAD), F.col(PAGE))).alias("first_bad"))
    return buckets.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        # a page without number has no place in a bitmap, so it counts as a repeated one
        F.coalesce(F.sum(F.bitmap_count("seen")), F.lit(0)).alias("n_distinct"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
        F.min("first_bad").alias("first_bad"),
    )


@dataclass(frozen=True)
class PageCheck:
    stop: int | None
    pages: int
    records: int


def check_pages(parsed: DataFrame, spec: DatasetSpec) -> PageCheck:
    """Decide on the flag columns; raise :class:`PageError` on a failure.

    Two small aggregates read only ``page, empty, bad, n_records``: the end page,
    then a summary of the pages before it (``page < stop`` is a literal, pushed
    into the Parquet scan).  One row comes back from each.  The problem text of
    a failed page is fetched only when there is one.
    Returns the end page (``None``: no empty page) and the number of pages and records kept.
    """
    paged = spec.paging.enabled
    flags = _flags(parsed)
    stop = _end_page(flags).first()[0] if paged else None
    row = _summary(flags if stop is None else flags.where(F.col(PAGE) < F.lit(stop))).first()
    if row["first_bad"] is not None:
        problem = parsed.where(F.col(BAD) & (F.col(PAGE) == F.lit(row["first_bad"]))).select(PROBLEM).first()[0]
        raise PageError(f"{spec.qualified_name}: {problem}")
    n = row["n"]
    if row["n_distinct"] != n:
        raise PageError(f"{spec.qualified_name}: repeated page numbers before the end of data")
    expected = n if stop is None else max(0, stop - 1)
    if paged and (n != expected or (n and (row["lo"] != 1 or row["hi"] != n))):
        raise PageError(f"{spec.qualified_name}: page numbers before the end of data are not 1..{n} without gaps")
    return PageCheck(stop=stop, pages=n, records=row["records"])


def page_records(parsed: DataFrame, stop: int | None = None, with_page: bool = False) -> DataFrame:
    """Records of the pages before ``stop`` as rows, typed by the declared schema."""
    kept = parsed if stop is None else parsed.where(F.col(PAGE) < F.lit(int(stop)))
    cols = [PAGE, "inline(records)"] if with_page else ["inline(records)"]
    return kept.selectExpr(*cols)


def staging_path(spark, spec: DatasetSpec) -> str:
    """A fresh folder for one run's parsed pages, under the session's shared checkpoint folder."""
    return scratch_folder(spark, f"staging/{spec.source}_{spec.name}")


def stage_pages(pages: DataFrame, spec: DatasetSpec, path: str | None = None, mode: str = "overwrite",
                observation: Observation | None = None) -> DataFrame:
    """Parse (once) and write the pages as Parquet; return the staged pages read back.

    ``mode="append"`` lets paged readers land one wave of pages at a time.
    ``observation`` collects, during the same write, ``ended`` (1 when a staged
    page is empty or bad) and ``pages``.
    """
    spark = pages.sparkSession
    path = path or staging_path(spark, spec)
    parsed = parse_pages(cap_pages(pages, spec), spec)
    if observation is not None:
        parsed = parsed.observe(
            observation,
            F.coalesce(F.max(F.when(F.col(EMPTY) | F.col(BAD), 1).otherwise(0)), F.lit(0)).alias("ended"),
            F.count(F.lit(1)).alias("pages"),
        )
    parsed.write.mode(mode).parquet(path)
    return spark.read.schema(parsed.schema).parquet(path)  # known schema: no footer inference


def read_records(pages: DataFrame, spec: DatasetSpec, with_page: bool = False, path: str | None = None) -> DataFrame:
    """Stage, check, and return the typed records (raises :class:`PageError` before returning).

    The returned DataFrame reads a scratch folder, which goes when the application
    ends or with :func:`pagelake.session.release_scratch`; after a failed check it goes
    at once.  A folder given as ``path`` is the caller's.
    """
    folder = path or staging_path(pages.sparkSession, spec)
    try:
        staged = stage_pages(pages, spec, path=folder)
        result = check_pages(staged, spec)
    except Exception:
        if path is None:
            remove_folder(pages.sparkSession, folder)
        raise
    return page_records(staged, result.stop, with_page=with_page)
