"""Page readers: folder/HTTP data source, landed files, table replay, row index."""

import json
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelake.functions.schema import dataset_spec
from pagelake.operators.index import with_row_index
from pagelake.operators.pages import PageError, check_pages, page_records, read_records
from pagelake.plans.ingest import api_pages, stage_api_pages
from pagelake.plans.registry import SourceSpec
from pagelake.sources.landed import land_page_files, land_pages, read_landed_pages, read_page_files
from pagelake.sources.paged_json import endpoint_url, fetch, with_api_key
from pagelake.sources.table_pages import records_as_pages

COLS = [{"name": "id", "type": "integer"}]


def spec(**paging):
    return dataset_spec({"responsePath": "data", "pagination": {"enabled": True, **paging}, "columns": COLS},
                        source="api", name="ds")


def folder_with_pages(n_pages, per_page=3, extra=None):
    d = tempfile.mkdtemp(prefix="pagelake-api-")
    for p in range(1, n_pages + 1):
        with open(os.path.join(d, f"page-{p}.json"), "w") as fh:
            json.dump({"data": [{"id": (p - 1) * per_page + i} for i in range(per_page)]}, fh)
    for name, text in (extra or {}).items():
        with open(os.path.join(d, name), "w") as fh:
            fh.write(text)
    return d


def test_endpoint_url_and_placeholders():
    assert endpoint_url("https://h/api/", "/v2/x") == "https://h/api/v2/x"
    assert endpoint_url("https://h/api", "v2/x") == "https://h/api/v2/x"
    assert with_api_key({"a": "k={api_key}", "b": "{api_key}{api_key}", "c": "-"}, "S") == {"a": "k=S", "b": "SS", "c": "-"}


def test_folder_transport_fetch():
    d = folder_with_pages(2, extra={"response.json": '{"data":[]}'})
    assert fetch(d, {}, {}, 1, 1)[0] == 200
    assert fetch(d, {}, {}, 1, 3) == (200, "{}")
    assert fetch(d, {}, {}, 1, None) == (200, '{"data":[]}')
    assert fetch(tempfile.mkdtemp(), {}, {}, 1, None) == (404, "")


def test_data_source_partitions_and_rows(spark):
    d = folder_with_pages(5)
    src = SourceSpec("api", base_url=d)
    df = api_pages(spark, src, spec(), first=1, last=5, pages_per_partition=2)
    assert df.rdd.getNumPartitions() == 3
    rows = df.orderBy("page").collect()
    assert [(r.page, r.status) for r in rows] == [(i, 200) for i in range(1, 6)]


def test_unbounded_paging_in_waves(spark):
    d = folder_with_pages(20, per_page=2)
    staged = stage_api_pages(spark, SourceSpec("api", base_url=d, first_wave=4, max_wave=8), spec())
    # waves 1-4, 5-12, 13-20, 21-28: page 21 is the first empty one
    assert staged.agg(F.max("page")).first()[0] == 28
    chk = check_pages(staged, spec())
    assert chk.stop == 21 and chk.records == 40
    assert sorted(r.id for r in page_records(staged, chk.stop).collect()) == list(range(40))


def test_capped_paging_requests_only_cap(spark):
    d = folder_with_pages(9)
    staged = stage_api_pages(spark, SourceSpec("api", base_url=d), spec(maxPages=4))
    assert staged.count() == 4


def test_api_key_from_environment(spark, monkeypatch):
    d = folder_with_pages(1)
    src = SourceSpec("keyed", base_url=d, headers={"x-key": "{api_key}"})
    assert src.key_env == "KEYED_KEY"
    # the reader is built in a Python worker forked from the JVM: a missing key fails the read
    with pytest.raises(Exception, match="KEYED_KEY"):
        api_pages(spark, src, spec(), 1, 1).collect()
    # with the key in the environment the placeholder is replaced when the reader is built
    from pagelake.sources.paged_json import PagedJsonReader

    monkeypatch.setenv("KEYED_KEY", "secret")
    reader = PagedJsonReader({"url": d, "headers": json.dumps(dict(src.headers)), "apiKeyEnv": "KEYED_KEY",
                              "firstPage": "1", "lastPage": "3", "pagesPerPartition": "2"})
    assert reader.headers == {"x-key": "secret"}
    assert [list(p.pages) for p in reader.partitions()] == [[1, 2], [3]]
    huge = PagedJsonReader({"url": d, "firstPage": "1", "lastPage": str(10**9), "pagesPerPartition": str(10**7)})
    parts = huge.partitions()
    assert len(parts) == 100 and parts[-1].pages == range(990_000_001, 10**9 + 1)
    assert [(page, status) for page, status, _ in reader.read(reader.partitions()[0])] == [(1, 200), (2, 200)]


def test_landed_files_roundtrip(spark):
    events = spark.range(250).select(F.col("id").alias("id"))
    pages = records_as_pages(events, "data", 100, index="id")
    root = tempfile.mkdtemp(prefix="pagelake-landed-")
    for back in (read_landed_pages(spark, land_pages(pages, root + "/table")),
                 read_page_files(spark, land_page_files(pages, root + "/files"))):
        assert sorted((r.page, r.status) for r in back.collect()) == [(1, 200), (2, 200), (3, 200)]
        assert sorted(r.id for r in read_records(back, spec()).collect()) == list(range(250))
    staged = stage_api_pages(spark, SourceSpec("api", base_url=root + "/files"), spec())
    assert check_pages(staged, spec()).records == 250


def test_landed_failures_stay_failures(spark):
    rows = [(1, 200, '{"data":[{"id":1}]}'), (2, 200, '{"data":[{"id":2}]}'), (3, 500, "down"), (4, -1, "timeout")]
    pages = spark.createDataFrame(rows, "page long, status int, body string")
    root = tempfile.mkdtemp(prefix="pagelake-landed-")
    land_pages(pages, root + "/table")
    land_page_files(pages, root + "/files")
    assert sorted(tuple(r) for r in read_landed_pages(spark, root + "/table").collect()) == rows
    for back in (read_landed_pages(spark, root + "/table"), read_page_files(spark, root + "/files")):
        with pytest.raises(PageError, match="page 3 answered 500: down"):
            read_records(back, spec())
    staged = stage_api_pages(spark, SourceSpec("api", base_url=root + "/files"), spec())
    with pytest.raises(PageError, match="page 3 answered 500: down"):
        check_pages(staged, spec())


def test_a_hole_in_a_folder_is_a_failure(spark):
    d = folder_with_pages(4)
    os.remove(os.path.join(d, "page-2.json"))
    staged = stage_api_pages(spark, SourceSpec("api", base_url=d), spec())
    with pytest.raises(PageError, match="page 2 answered 404"):
        check_pages(staged, spec())
    with pytest.raises(PageError, match="without gaps"):
        read_records(read_page_files(spark, d), spec())


def test_several_files_of_one_page_are_a_failure(spark):
    d = tempfile.mkdtemp()
    for name in ("page=1/a.json", "page=1/b.json"):
        os.makedirs(os.path.dirname(os.path.join(d, name)), exist_ok=True)
        with open(os.path.join(d, name), "w") as fh:
            fh.write('{"data":[{"id":1}]}')
    assert fetch(d, {}, {}, 1, 1)[0] == -1
    with pytest.raises(PageError, match="repeated page numbers"):
        read_records(read_page_files(spark, d), spec())


def test_page_numbers_from_file_names(spark):
    d = tempfile.mkdtemp()
    for name in ("00017.json", "page-18.v2.json", "page_19.json", "response.json"):
        with open(os.path.join(d, name), "w") as fh:
            fh.write("{}")
    assert sorted(r.page for r in read_page_files(spark, d).collect()) == [1, 17, 18, 19]
    with open(os.path.join(d, "notes-2024.txt"), "w") as fh:
        fh.write("{}")
    with pytest.raises(Exception, match="no page number in the name of .*notes-2024.txt"):
        read_page_files(spark, d).collect()


def test_scratch_folders_are_released(spark):
    from pagelake.session import hadoop_path, release_scratch, shared_dir

    release_scratch(spark)
    good = spark.createDataFrame([(1, 200, '{"data":[{"id":1}]}')], "page long, status int, body string")
    assert read_records(good, spec()).count() == 1
    with pytest.raises(PageError):
        read_records(good.selectExpr("page", "500 as status", "body"), spec())
    fs, where = hadoop_path(spark, shared_dir(spark) + "/pagelake/staging")
    assert len(fs.listStatus(where)) == 1  # of the frame that can still be read
    release_scratch(spark)
    assert len(fs.listStatus(where)) == 0


def test_landed_flat_files(spark):
    d = folder_with_pages(3, extra={"page-4.json": '{"data":[]}'})
    back = read_page_files(spark, d, glob="page-*.json")
    assert sorted(r.page for r in back.collect()) == [1, 2, 3, 4]
    assert read_records(back, spec()).count() == 9


def test_row_index_dense_over_partitions(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 3).alias("v"))
    idx = with_row_index(df, "i").collect()
    assert sorted(r.i for r in idx) == list(range(1000))
    assert sorted(r.v for r in idx) == [v * 3 for v in range(1000)]


def test_pages_bounded_and_complete(spark):
    df = spark.range(0, 1234, 1, 5).select(F.col("id").cast("int").alias("id"))
    pages = records_as_pages(df, "data", 100)
    sizes = pages.select(F.json_array_length(F.get_json_object("body", "$.data")).alias("n")).collect()
    assert max(r.n for r in sizes) == 100 and sum(r.n for r in sizes) == 1234
    assert pages.count() == 13


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(min_value=0, max_value=300), size=st.integers(min_value=1, max_value=120),
       parts=st.integers(min_value=1, max_value=6))
def test_pages_roundtrip_property(spark, n, size, parts):
    df = spark.range(0, n, 1, parts).select(F.col("id").cast("int").alias("id"))
    pages = records_as_pages(df, "data", size)
    assert sorted(r.id for r in read_records(pages, spec()).collect()) == list(range(n))


def test_row_index_over_a_shuffled_input(spark):
    df = spark.range(0, 500, 1, 4).select((F.col("id") + 7).alias("v")).repartition("v")
    out = with_row_index(df, "i")  # the input is written once, so its order cannot change between reads
    assert sorted(r.i for r in out.collect()) == list(range(500))
    assert sorted(r.v for r in out.collect()) == list(range(7, 507))


def test_single_request_through_data_source(spark):
    single = dataset_spec({"responsePath": "data", "pagination": {"enabled": False}, "columns": COLS},
                          source="api", name="one")
    d = folder_with_pages(0, extra={"response.json": json.dumps({"data": [{"id": 1}, {"id": 2}]})})
    staged = stage_api_pages(spark, SourceSpec("api", base_url=d), single)
    chk = check_pages(staged, single)
    assert sorted(r.id for r in page_records(staged, chk.stop).collect()) == [1, 2]
    missing = stage_api_pages(spark, SourceSpec("api", base_url=tempfile.mkdtemp()), single)
    with pytest.raises(PageError, match="answered 404"):
        check_pages(missing, single)


def test_repeated_index_is_refused(spark):
    df = spark.range(0, 300, 1, 3).select((F.col("id") % 2).alias("k"))
    with pytest.raises(Exception, match="not unique: page 0 would hold more than 100 records"):
        records_as_pages(df, "data", 100, index="k").collect()


def test_page_predicates_prune_requests(spark):
    from pagelake.sources.paged_json import PUSHDOWN_CONF

    d = folder_with_pages(12)
    src = SourceSpec("api", base_url=d)
    spark.conf.set(PUSHDOWN_CONF, "true")
    try:
        df = api_pages(spark, src, spec(), first=1, last=12, pages_per_partition=1)
        narrowed = df.where((F.col("page") >= 3) & (F.col("page") < 6))
        assert narrowed.rdd.getNumPartitions() == 3
        assert sorted(r.page for r in narrowed.collect()) == [3, 4, 5]
        picked = df.where(F.col("page").isin(2, 11, 40))
        assert picked.rdd.getNumPartitions() == 2
        assert sorted(r.page for r in picked.collect()) == [2, 11]
    finally:
        spark.conf.unset(PUSHDOWN_CONF)
    assert api_pages(spark, src, spec(), 1, 12, 1).where(F.col("page") < 3).rdd.getNumPartitions() == 12


def test_http_fetch_retries_transient_failures(monkeypatch):
    import requests

    calls = []

    class Reply:
        def __init__(self, status, text):
            self.status_code, self.text = status, text

    script = [requests.ConnectionError("reset"), Reply(503, "busy"), Reply(200, '{"data":[]}')]

    def fake_get(url, headers, params, timeout):
        calls.append(dict(params))
        step = script[len(calls) - 1]
        if isinstance(step, Exception):
            raise step
        return step

    monkeypatch.setattr(requests, "get", fake_get)
    assert fetch("https://api.example/x", {"type": "S"}, {}, 1, 7, retries=2, backoff=0) == (200, '{"data":[]}')
    assert calls == [{"type": "S", "page": "7"}] * 3
    calls.clear()
    assert fetch("https://api.example/x", {}, {}, 1, None, retries=0, backoff=0)[0] == -1
    calls.clear()
    script[:] = [Reply(404, "nope"), Reply(200, "late")]
    assert fetch("https://api.example/x", {}, {}, 1, 1, retries=3, backoff=0) == (404, "nope")


def test_large_cap_does_not_overfetch(spark):
    d = folder_with_pages(5)
    staged = stage_api_pages(spark, SourceSpec("api", base_url=d, first_wave=8), spec(maxPages=100_000))
    # one wave of 8 pages holds the end (page 6): nothing beyond it is requested
    assert staged.count() == 8
    assert check_pages(staged, spec(maxPages=100_000)).stop == 6


def test_replay_dotted_column_names(spark):
    df = spark.sql("select id, cast(id as string) as `a.b` from range(5)")
    cols = [{"name": "id", "type": "integer"}, {"name": "a.b", "type": "string"}]
    sp = dataset_spec({"responsePath": "data", "pagination": {"enabled": True}, "columns": cols}, source="s", name="d")
    out = read_records(records_as_pages(df, "data", 2, index="id"), sp)
    assert sorted((r["id"], r["a.b"]) for r in out.collect()) == [(i, str(i)) for i in range(5)]


def test_filesystem_uris():
    from pagelake.session import filesystem_uri

    assert filesystem_uri("/tmp/x") == "file:///tmp/x"
    assert filesystem_uri("file:/tmp/x") == "file:///tmp/x"
    assert filesystem_uri("file:///tmp/x") == "file:///tmp/x"
    assert filesystem_uri("hdfs://nn:8020/a") == "hdfs://nn:8020/a"
    assert filesystem_uri("s3a://bucket/key") == "s3://bucket/key"


def page_rows(spark, rows):
    return spark.createDataFrame(rows, "page long, status int, body string")


def test_packs_give_back_every_response(spark):
    from pagelake.sources.packs import land_page_packs, read_page_packs

    rows = [(p, 200 if p % 5 else 503, None if p == 9 else "é\n{" * (p % 7) + str(p)) for p in range(1, 400)]
    root = tempfile.mkdtemp(prefix="pagelake-packs-")
    for size in (1, 300, 1 << 27):  # a pack for each page, for some, for all pages of a task
        land_page_packs(page_rows(spark, rows).repartition(5), root, pack_bytes=size)
        assert sorted(tuple(r) for r in read_page_packs(spark, root).collect()) == rows
        packs = [f for d in os.listdir(root) if d.startswith("packs-") for f in os.listdir(f"{root}/{d}") if f.endswith(".pack")]
        assert len({d for d in os.listdir(root) if d.startswith("packs-")}) == 1
        assert (len(packs) == 5) == (size == 1 << 27)
    more = [(p, 200, str(p)) for p in range(400, 420)]
    land_page_packs(page_rows(spark, more), root, mode="append")
    assert sorted(tuple(r) for r in read_page_packs(spark, root).collect()) == rows + more
    empty = land_page_packs(page_rows(spark, []), tempfile.mkdtemp())
    assert read_page_packs(spark, empty).collect() == []


def test_a_failing_landing_keeps_the_packs_before(spark):
    from pagelake.sources.packs import land_page_packs, read_page_packs

    root = tempfile.mkdtemp(prefix="pagelake-packs-")
    land_page_packs(page_rows(spark, [(1, 200, "kept")]), root)
    broken = page_rows(spark, [(1, 200, "x"), (2, 200, "y")]).withColumn(
        "body", F.when(F.col("page") == 2, F.raise_error(F.lit("no page 2"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="no page 2"):
        land_page_packs(broken, root, mode="append")
    assert [r.body for r in read_page_packs(spark, root).collect()] == ["kept"]
    assert len([d for d in os.listdir(root) if d.startswith("packs-")]) == 1


def test_data_source_serves_packs_and_files_together(spark):
    from pagelake.sources.packs import land_page_packs

    d = folder_with_pages(2)
    land_page_packs(page_rows(spark, [(p, 200, json.dumps({"data": [{"id": 100 + p}]})) for p in range(3, 8)]), d)
    staged = stage_api_pages(spark, SourceSpec("api", base_url=d, first_wave=3, max_wave=4), spec())
    check = check_pages(staged, spec())
    assert (check.stop, check.pages, check.records) == (8, 7, 11)
    land_page_packs(page_rows(spark, [(2, 200, "{}")]), d, mode="append")
    assert fetch(d, {}, {}, 1, 2)[0] == -1  # a file and a pack hold page 2


def test_one_listing_per_scan(spark, monkeypatch):
    from pagelake.sources import paged_json

    d = folder_with_pages(40)
    listed = []
    real = paged_json.ResponseFolder.__init__

    def counting(self, url):
        listed.append(url)
        real(self, url)

    monkeypatch.setattr(paged_json.ResponseFolder, "__init__", counting)
    reader = paged_json.PagedJsonReader({"url": d, "firstPage": "1", "lastPage": "50", "pagesPerPartition": "4"})
    parts = reader.partitions()
    rows = [r for p in parts for r in reader.read(p)]
    assert len(parts) == 13 and len(rows) == 50 and len(listed) == 1
    assert {r[0]: r[1] for r in rows} == {p: 200 for p in range(1, 51)}
    assert all(set(p.places) <= set(p.pages) for p in parts)  # a task gets the places of its own pages only


def test_single_responses_of_a_folder_are_one_scan(spark):
    single = dataset_spec({"responsePath": "data", "pagination": {"enabled": False}, "columns": COLS},
                          source="api", name="ranges")
    d = folder_with_pages(30)
    pages = api_pages(spark, SourceSpec("api", base_url=d), single, pages_per_partition=4)
    assert pages.rdd.getNumPartitions() == 8
    assert sorted(r.id for r in read_records(pages, single).collect()) == list(range(90))
    with open(os.path.join(d, "page-7.json"), "w") as fh:
        fh.write('{"other": []}')
    with pytest.raises(PageError, match="page 7 has no list"):
        read_records(pages, single)
