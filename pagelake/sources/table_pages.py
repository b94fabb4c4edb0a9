"""Serve a table as JSON response pages (``page, status, body``).

Replays a table the way a paged API would return it: records are numbered
densely, cut into pages of ``page_size`` and each page becomes the JSON object
``{"<response_path>": [record, ...]}``.  Used to land test and benchmark input
from the driver tables, and to replay an existing table through an ingest.

Every page holds at most ``page_size`` records, whatever the key distribution,
so no page (group) grows with the data.  Timestamps are written as text
(``to_json`` would cut them to milliseconds).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.operators.index import with_row_index
from pagelake.operators.pages import BODY, PAGE, STATUS

_IDX, _REC = "_tp_idx", "_tp_rec"


def _json_ready(df: DataFrame, name: str) -> Column:
    col = F.col("`" + name.replace("`", "``") + "`")
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return col.cast("string").alias(name)
    return col.alias(name)


def records_as_pages(
    df: DataFrame,
    response_path: str,
    page_size: int = 100,
    index: str | Column | None = None,
    record: Column | None = None,
) -> DataFrame:
    """Pages of ``df``.

    ``index``: a dense 0-based unique column (or expression) giving record order,
    a page that would hold more than ``page_size`` records fails the job; when absent
    one is computed with :func:`with_row_index`.
    ``record``: the struct to serialise per row (default: all columns).
    """
    if page_size <= 0:
        raise ValueError("page_size must be positive")
    if index is None:
        df = with_row_index(df, _IDX)
        idx = F.col(_IDX)
    else:
        idx = F.col(index) if isinstance(index, str) else index
    rec = record if record is not None else F.struct(*[_json_ready(df, c) for c in df.columns if c != _IDX])
    # Shuffle plain rows by page first: records are built, collected, sorted and
    # serialised after the exchange, in parallel, with no map-side list buffers.
    keyed = df.withColumn(_IDX, idx.cast("long")).withColumn(PAGE, F.expr(f"`{_IDX}` div {int(page_size)}"))
    rows = keyed.repartition(PAGE).select(PAGE, _IDX, rec.alias(_REC))
    pages = rows.groupBy(PAGE).agg(F.sort_array(F.collect_list(F.struct(_IDX, _REC))).alias(_REC))
    too_many = F.raise_error(F.concat(F.lit("index is not unique: page "), F.col(PAGE).cast("string"),
                                      F.lit(f" would hold more than {int(page_size)} records")))
    pages = pages.select(PAGE, F.when(F.size(_REC) > page_size, too_many).otherwise(F.col(_REC)).alias(_REC))
    ordered = F.transform(F.col(_REC), lambda x: x[_REC])
    return pages.select(
        (F.col(PAGE) + 1).alias(PAGE),
        F.lit(200).alias(STATUS),
        F.to_json(F.struct(ordered.alias(response_path))).alias(BODY),
    )
