"""Plan properties the design relies on: pushed filters, pruned columns, exchanges only where meant."""

import json

from conftest import make_pages
from pagelake.functions.schema import dataset_spec
from pagelake.operators.pages import _end_page, _flags, _summary, check_pages, page_records, stage_pages
from pagelake.sources.table_pages import records_as_pages

COLS = [{"name": "id", "type": "integer"}, {"name": "s", "type": "string"}]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def staged_with_end(spark):
    sp = dataset_spec({"responsePath": "body", "pagination": {"enabled": True}, "columns": COLS}, source="p", name="d")
    pages = [(p, 200, json.dumps({"body": [{"id": p, "s": "x"}]})) for p in range(1, 6)]
    pages.append((6, 200, '{"body":[]}'))
    return sp, stage_pages(make_pages(spark, pages), sp)


def test_final_read_pushes_the_end_page_into_the_scan(spark):
    sp, staged = staged_with_end(spark)
    chk = check_pages(staged, sp)
    plan = plan_of(page_records(staged, chk.stop))
    assert chk.stop == 6
    assert "LessThan(page,6)" in plan
    assert scanned_columns(plan) == {"page", "records"}


def scanned_columns(plan: str) -> set[str]:
    scan = plan.split("FileScan parquet [")[1].split("]")[0]
    return {c.split("#")[0] for c in scan.split(",")}


def test_check_reads_only_flag_columns(spark):
    _, staged = staged_with_end(spark)
    assert scanned_columns(plan_of(_end_page(_flags(staged)))) == {"page", "empty"}
    assert scanned_columns(plan_of(_summary(_flags(staged)))) == {"page", "n_records", "bad"}


def test_replay_shuffles_rows_by_page_number(spark):
    df = spark.range(0, 300, 1, 3).selectExpr("cast(id as int) as id")
    plan = plan_of(records_as_pages(df, "body", 100, index="id"))
    assert "hashpartitioning(page" in plan and "REPARTITION_BY_COL" in plan


def test_check_exchanges_bitmaps_not_page_numbers(spark):
    _, staged = staged_with_end(spark)
    plan = plan_of(_summary(_flags(staged)))
    assert "partial_bitmap_construct_agg" in plan
    keys = [line.split("hashpartitioning(")[1].split(",")[0] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert keys and all(k.startswith(("bucket", "bitmap_bucket_number", "_groupingexpression")) for k in keys), keys
    assert "keys=[page" not in plan
