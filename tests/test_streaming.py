"""Streaming landing: files land once, across runs; the batch check sees all staged pages."""

import json
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelake.functions.schema import dataset_spec
from pagelake.operators.pages import PageError, check_pages
from pagelake.sources.packs import land_page_packs
from pagelake.streaming import landing
from pagelake.streaming.landing import check_summary, ingest_landed, merged, stream_locations, summary_of

COLS = [{"name": "id", "type": "integer"}]


def spec():
    return dataset_spec({"responsePath": "data", "pagination": {"enabled": True}, "columns": COLS},
                        source="feed", name="items")


def put(folder, page, ids):
    with open(os.path.join(folder, f"page-{page}.json"), "w") as fh:
        json.dump({"data": [{"id": i} for i in ids]}, fh)


def test_incremental_landing_is_exactly_once(spark):
    folder = tempfile.mkdtemp(prefix="pagelake-feed-")
    root = tempfile.mkdtemp(prefix="pagelake-stream-")
    put(folder, 1, [1, 2])
    put(folder, 2, [3])
    first = ingest_landed(spark, folder, spec(), layer="stream_t", root=root, timeout=120)
    assert first.records == 3 and first.stop is None
    put(folder, 3, [4, 5])
    put(folder, 4, [])
    put(folder, 5, [6])
    second = ingest_landed(spark, folder, spec(), layer="stream_t", root=root, timeout=120)
    assert second.stop == 4 and second.records == 5
    assert sorted(r.id for r in spark.table("stream_t.feed_items").collect()) == [1, 2, 3, 4, 5]
    staged, _ = stream_locations(spark, spec(), root)
    pages = spark.read.parquet(staged)
    assert pages.count() == 5 and pages.select(F.countDistinct("page")).first()[0] == 5


def pages_frame(spark, rows):
    """(page, bad, empty) rows as staged pages."""
    staged = tempfile.mkdtemp(prefix="pagelake-staged-")
    schema = "page long, bad boolean, empty boolean, n_records int, problem string"
    spark.createDataFrame([(p, b, e, 0 if b or e else 1, f"page {p} broke" if b else None) for p, b, e in rows],
                          schema).write.mode("overwrite").parquet(staged)
    return spark.read.parquet(staged)


def outcome(decide):
    try:
        return decide()
    except PageError as failure:
        return str(failure)


NUMBERS = st.one_of(st.integers(1, 12), st.sampled_from([32766, 32767, 32768, 32769, 32770, 65537, 0, -1]))


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_merged_summaries_decide_as_the_full_check(spark, data):
    first = data.draw(st.sampled_from([[], list(range(1, 9)), list(range(1, 32769)), list(range(1, 32771))]))
    rows = [(p, False, False) for p in first]
    rows += data.draw(st.lists(st.tuples(NUMBERS, st.booleans(), st.booleans()).map(lambda r: (r[0], r[1], r[2] and not r[1])),
                               max_size=5))
    cut = data.draw(st.integers(0, len(rows)))
    paged = data.draw(st.booleans())
    sp = dataset_spec({"responsePath": "data", "pagination": {"enabled": paged}, "columns": COLS}, source="f", name="s")
    staged = pages_frame(spark, rows)
    parts = [summary_of(pages_frame(spark, some).select("page", "bad", "empty")) for some in (rows[:cut], rows[cut:])]
    full = outcome(lambda: check_pages(staged, sp))
    kept = outcome(lambda: check_summary(merged(*parts), staged, sp))
    if isinstance(full, str):
        assert isinstance(kept, str) and kept.split(" are not")[0] == full.split(" are not")[0]
    else:
        assert kept == (full.stop, full.pages)


@pytest.mark.parametrize("pages, end", [([], 32766), ([1, 2, 3], 6)])
def test_pages_missing_right_before_the_end_fail_both_checks(spark, pages, end):
    sp = dataset_spec({"responsePath": "data", "pagination": {"enabled": True}, "columns": COLS}, source="f", name="s")
    staged = pages_frame(spark, [(p, False, False) for p in pages] + [(end, False, True)])
    with pytest.raises(PageError, match="without gaps"):
        check_pages(staged, sp)
    with pytest.raises(PageError, match="without gaps"):
        check_summary(summary_of(staged.select("page", "bad", "empty")), staged, sp)


def test_second_run_reads_the_flags_of_new_files_only(spark, monkeypatch):
    folder, root = tempfile.mkdtemp(prefix="pagelake-feed-"), tempfile.mkdtemp(prefix="pagelake-stream-")
    for page in range(1, 6):
        put(folder, page, [page])
    first = ingest_landed(spark, folder, spec(), layer="stream_u", root=root, timeout=120)
    assert (first.pages, first.records, first.stop) == (5, 5, None)
    summarised = []
    real = landing.summary_of

    def counting(flags):
        summarised.append(sorted(r.page for r in flags.select("page").collect()))
        return real(flags)

    monkeypatch.setattr(landing, "summary_of", counting)
    put(folder, 6, [6, 7])
    put(folder, 7, [])
    second = ingest_landed(spark, folder, spec(), layer="stream_u", root=root, timeout=120)
    assert summarised == [[6, 7]]
    assert (second.pages, second.records, second.stop) == (6, 7, 7)
    third = ingest_landed(spark, folder, spec(), layer="stream_u", root=root, timeout=120)
    assert summarised == [[6, 7]] and third == second


def test_a_broken_off_version_is_made_again(spark):
    folder, root = tempfile.mkdtemp(prefix="pagelake-feed-"), tempfile.mkdtemp(prefix="pagelake-stream-")
    put(folder, 1, [1])
    ingest_landed(spark, folder, spec(), layer="stream_v", root=root, timeout=120)
    os.remove(f"{root}/summary/files/version=0/_SUCCESS")  # as if the run had ended before it wrote the file names
    put(folder, 2, [2])
    again = ingest_landed(spark, folder, spec(), layer="stream_v", root=root, timeout=120)
    assert (again.pages, again.records) == (2, 2)


def test_packs_land_through_their_index(spark):
    folder, root = tempfile.mkdtemp(prefix="pagelake-feed-"), tempfile.mkdtemp(prefix="pagelake-stream-")
    def page(n, ids):
        return (n, 200, json.dumps({"data": [{"id": i} for i in ids]}))
    schema = "page long, status int, body string"
    land_page_packs(spark.createDataFrame([page(1, [1, 2]), page(2, [3])], schema), folder)
    assert ingest_landed(spark, folder, spec(), layer="stream_w", root=root, timeout=120).records == 3
    land_page_packs(spark.createDataFrame([page(3, [4]), page(4, [])], schema), folder, mode="append")
    done = ingest_landed(spark, folder, spec(), layer="stream_w", root=root, timeout=120)
    assert (done.pages, done.records, done.stop) == (3, 4, 4)
    with pytest.raises(PageError, match="repeated page numbers"):
        land_page_packs(spark.createDataFrame([page(2, [9])], schema), folder, mode="append")
        ingest_landed(spark, folder, spec(), layer="stream_w", root=root, timeout=120)
    assert sorted(r.id for r in spark.table("stream_w.feed_items").collect()) == [1, 2, 3, 4]
