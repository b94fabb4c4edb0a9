"""Ingest job, targets, dataset selection."""

import json

import pytest

from conftest import make_pages
from pagelake.functions.schema import dataset_spec
from pagelake.operators.pages import PageError
from pagelake.plans.ingest import ingest, run
from pagelake.plans.registry import SourceSpec, load_source, select_datasets, source_spec
from pagelake.plans.sinks import CatalogTarget, postgres_target, target_table

COLS = [{"name": "id", "type": "integer"}, {"name": "_rowHash", "type": "string"},
        {"name": "_processedTimestamp", "type": "timestamp"}, {"name": "s", "type": "string"}]


def spec(name="d", source="src", columns=COLS, **paging):
    pag = {"enabled": True, **paging}
    return dataset_spec({"responsePath": "body", "pagination": pag, "columns": columns}, source=source, name=name)


def body(*ids):
    return json.dumps({"body": [{"id": i, "s": f"r{i}"} for i in ids]})


def test_target_naming():
    assert target_table("bronze", "market", "tickers") == "bronze.market_tickers"
    assert CatalogTarget().qualified("bronze", "x_y") == "`bronze`.`x_y`"


def test_ingest_writes_table_with_audit_columns(spark):
    pages = make_pages(spark, [(1, 200, body(1, 2)), (2, 200, body(3)), (3, 200, '{"body":[]}')])
    res = ingest(spark, spec("audited"), pages=pages, layer="bronze_t")
    assert res.table == "`bronze_t`.`src_audited`" and res.pages == 2 and res.records == 3 and res.stop == 3
    t = spark.table("bronze_t.src_audited")
    assert t.columns == ["id", "_rowHash", "_processedTimestamp", "s"]
    rows = t.orderBy("id").collect()
    want = [r[0] for r in spark.sql("select sha2(concat_ws('||', id, s), 256) from values "
                                    "(1, 'r1'), (2, 'r2'), (3, 'r3') as v(id, s) order by id").collect()]
    assert [r["_rowHash"] for r in rows] == want
    assert len({r["_processedTimestamp"] for r in rows}) == 1


def test_failed_read_leaves_target_untouched(spark):
    good = make_pages(spark, [(1, 200, body(1, 2))])
    ingest(spark, spec("keep"), pages=good, layer="bronze_t")
    bad = make_pages(spark, [(1, 200, body(5)), (2, 500, "down"), (3, 200, '{"body":[]}')])
    with pytest.raises(PageError, match="page 2 answered 500: down"):
        ingest(spark, spec("keep"), pages=bad, layer="bronze_t")
    assert sorted(r["id"] for r in spark.table("bronze_t.src_keep").collect()) == [1, 2]


def test_failed_write_leaves_target_untouched(spark):
    from pyspark.sql import functions as F

    good = make_pages(spark, [(1, 200, body(1, 2))])
    ingest(spark, spec("solid"), pages=good, layer="bronze_t")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|by zero"):
        ingest(spark, spec("solid"), pages=good, layer="bronze_t",
               transform=lambda df: df.withColumn("id", F.expr("cast(id / (id - id) as int)")))
    assert sorted(r["id"] for r in spark.table("bronze_t.src_solid").collect()) == [1, 2]
    ingest(spark, spec("solid"), pages=make_pages(spark, [(1, 200, body(7))]), layer="bronze_t")
    assert [r["id"] for r in spark.table("bronze_t.src_solid").collect()] == [7]


def test_cleaning_up_never_fails_a_load(spark, caplog):
    from pagelake.session import remove_folder

    remove_folder(spark, "nosuchscheme://somewhere/x")
    assert "Could not delete" in caplog.text


def test_bound_parameters(spark):
    from pagelake.plans.sinks import run_sql

    assert [tuple(r) for r in run_sql(spark, "SELECT ? AS a, ? + 1 AS b", "it's", 2).collect()] == [("it's", 3)]
    assert run_sql(spark, "SELECT 1 AS a").first().a == 1


def test_overwrite_replaces_schema_and_rows(spark):
    ingest(spark, spec("swap"), pages=make_pages(spark, [(1, 200, body(1))]), layer="bronze_t")
    other = [{"name": "id", "type": "string"}, {"name": "extra", "type": "boolean"}]
    ingest(spark, spec("swap", columns=other), pages=make_pages(spark, [(1, 200, '{"body":[{"id":9}]}')]),
           layer="bronze_t")
    t = spark.table("bronze_t.src_swap")
    assert t.columns == ["id", "extra", "_rowHash", "_processedTimestamp"]
    assert [r["id"] for r in t.collect()] == ["9"]


def test_namespace_created(spark):
    ingest(spark, spec("ns"), pages=make_pages(spark, [(1, 200, '{"body":[]}')]), layer="fresh_layer")
    assert "fresh_layer" in [r[0] for r in spark.sql("SHOW NAMESPACES").collect()]
    assert spark.table("fresh_layer.src_ns").count() == 0


RUN = {"sources": {
    "a": {"enabled": True, "datasets": {"one": {"enabled": True}, "two": {"enabled": True},
                                        "three": {"enabled": False}}},
    "b": {"enabled": False, "datasets": {"one": {"enabled": True}}},
    "c": {"enabled": True, "datasets": {"one": {"enabled": True}}},
}}
SOURCES = [SourceSpec("a", datasets=(spec("one", "a"), spec("two", "a"), spec("three", "a"))),
           SourceSpec("b", datasets=(spec("one", "b"),)), SourceSpec("c", datasets=(spec("one", "c"),)),
           SourceSpec("d", datasets=(spec("one", "d"),))]


def names(selected):
    return [d.qualified_name for s in selected for d in s.datasets]


def test_selection():
    assert names(select_datasets(SOURCES, RUN)) == ["a.one", "a.two", "c.one"]
    assert names(select_datasets(SOURCES, RUN, "a.two")) == ["a.two"]
    assert names(select_datasets(SOURCES, RUN, "a")) == ["a.one", "a.two"]
    assert names(select_datasets(SOURCES, RUN, "a.three")) == []
    assert names(select_datasets(SOURCES, RUN, "b.one")) == []
    assert names(select_datasets(SOURCES, RUN, "c.one.x")) == []
    assert select_datasets(SOURCES, {"sources": {}}) == []
    assert select_datasets(SOURCES, {"sources": {"a": {"enabled": True}}}, "*") == []


def test_run_sequential_and_stops_at_first_failure(spark):
    pages = {"a.one": [(1, 200, body(1))], "a.two": [(1, 500, "x")], "c.one": [(1, 200, body(3))]}

    def pages_for(src, ds):
        return make_pages(spark, pages[ds.qualified_name])

    with pytest.raises(PageError):
        run(spark, SOURCES, RUN, layer="run_t", pages_for=pages_for)
    assert spark.table("run_t.a_one").count() == 1
    assert not spark.catalog.tableExists("run_t.c_one")
    done = run(spark, SOURCES, RUN, selector="c", layer="run_t", pages_for=pages_for)
    assert [r.dataset for r in done] == ["c.one"] and spark.table("run_t.c_one").count() == 1
    assert run(spark, SOURCES, {"sources": {}}, pages_for=pages_for) == []


def test_source_config_and_api_key_env():
    doc = {"name": "market", "variables": {"base_url": "https://api.example/", "timeout": 10},
           "headers": {"grp": {"x-key": "{api_key}", "x-host": "h"}}}
    src = source_spec(doc, headers_group="grp")
    assert src.base_url == "https://api.example/" and src.timeout == 10 and src.key_env == "MARKET_KEY"
    with pytest.raises(ValueError, match="no request headers in group grp"):
        source_spec({"name": "n", "headers": {}}, headers_group="grp")
    full = load_source(doc, {"t": {"responsePath": "body", "pagination": {"enabled": False}, "columns": []}},
                       endpoints={"t": "v2/t"}, params={"t": {"type": "S"}}, headers_group="grp")
    assert full.datasets[0].endpoint == "v2/t" and full.datasets[0].params == {"type": "S"}


def test_postgres_target_from_env():
    t = postgres_target({"POSTGRES_HOST": "db", "POSTGRES_DB": "w", "POSTGRES_USER": "u",
                         "POSTGRES_PASSWORD": "p"}, batchsize="5000")
    assert t.url == "jdbc:postgresql://db:5432/w"
    assert t.properties == {"user": "u", "password": "p", "driver": "org.postgresql.Driver"}
    assert t.write_options == {"batchsize": "5000"}
    assert postgres_target({"POSTGRES_HOST": "h", "POSTGRES_PORT": "6543", "POSTGRES_DB": "d"}).url == \
        "jdbc:postgresql://h:6543/d"
    with pytest.raises(ValueError, match="POSTGRES_HOST and no POSTGRES_DB"):
        postgres_target({})


def test_jdbc_target_prepares_rows_and_catalog(spark):
    from pagelake.plans.sinks import JdbcTarget, _jdbc_ready

    df = spark.sql("select 1 as i, named_struct('x', 2) as st, array(named_struct('y', 'q')) as arr, 'a' as `s.t`")
    ready = _jdbc_ready(df)
    assert [f.dataType.simpleString() for f in ready.schema.fields] == ["int", "string", "string", "string"]
    assert ready.first()["st"] == '{"x":2}' and ready.columns == ["i", "st", "arr", "s.t"]
    t = JdbcTarget("jdbc:postgresql://db:5432/w", {"user": "u", "password": "secret", "driver": "org.postgresql.Driver"})
    with t.catalog(spark) as name:
        assert spark.conf.get(f"spark.sql.catalog.{name}.url") == "jdbc:postgresql://db:5432/w"
        assert spark.conf.get(f"spark.sql.catalog.{name}.user") == "u"
        assert spark.conf.get(f"spark.sql.catalog.{name}.password") == "secret"
        assert spark.conf.get(f"spark.sql.catalog.{name}").endswith("JDBCTableCatalog")
    assert spark.conf.get(f"spark.sql.catalog.{name}.password", None) is None
    assert name != JdbcTarget("jdbc:postgresql://other:5432/w").catalog_name
    assert t.qualified("bronze", "src_ds") == "bronze.src_ds"


def test_transform_hook_runs_before_audit_columns(spark):
    from pyspark.sql import functions as F

    pages = make_pages(spark, [(1, 200, body(1, 2, 3))])
    ingest(spark, spec("shaped"), pages=pages, layer="bronze_t",
           transform=lambda df: df.where(F.col("id") != 2).withColumn("s", F.upper("s")))
    rows = spark.table("bronze_t.src_shaped").orderBy("id").collect()
    assert [(r.id, r.s) for r in rows] == [(1, "R1"), (3, "R3")]
    want = spark.sql("select sha2(concat_ws('||', 1, 'R1'), 256)").first()[0]
    assert rows[0]["_rowHash"] == want

    def pages_for(src, ds):
        return make_pages(spark, [(1, 200, body(7))])

    done = run(spark, SOURCES, RUN, selector="c.one", layer="run_t", pages_for=pages_for,
               transforms={"c.one": lambda df: df.withColumn("s", F.lit("x"))})
    assert [r.s for r in spark.table(done[0].table).collect()] == ["x"]
