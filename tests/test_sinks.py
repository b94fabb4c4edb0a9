"""Switching a finished load in: never without a table, taken back when it fails, the load before kept once."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pagelake.plans import sinks
from pagelake.plans.sinks import ASIDE, CatalogTarget


@pytest.fixture
def statements(monkeypatch):
    seen = []
    run = sinks.run_sql

    def recorded(spark, sql, *params):
        seen.append(sql)
        return run(spark, sql, *params)

    monkeypatch.setattr(sinks, "run_sql", recorded)
    return seen


def load(spark, n, columns=("id",)):
    rows = spark.range(n).withColumn("ts", F.current_timestamp())  # a column that cannot be null
    return rows.select(*[F.col("id").cast("string").alias(c) if c != "id" else F.col("id") for c in columns], "ts")


def folders(spark, layer, table):
    root = spark.catalog.getDatabase(layer).locationUri.removeprefix("file:")
    return {f for f in os.listdir(root) if f.startswith(f"{table}-")}


def test_the_same_columns_move_the_location_only(spark, statements):
    target = CatalogTarget()
    target.ensure_namespace(spark, "switch_t")
    target.overwrite(load(spark, 3), "switch_t", "same")
    reader = spark.table("switch_t.same")
    assert reader.count() == 3
    statements.clear()
    target.overwrite(load(spark, 5), "switch_t", "same")
    assert any("SET LOCATION" in s for s in statements)
    assert not any("DROP" in s or "CREATE" in s or "RENAME" in s for s in statements)
    assert spark.table("switch_t.same").count() == 5
    assert reader.count() == 3  # the folder of the load before is still there
    for n in (7, 9):
        target.overwrite(load(spark, n), "switch_t", "same")
        assert spark.table("switch_t.same").count() == n
        assert len(folders(spark, "switch_t", "same")) == 2


def test_other_columns_come_in_under_a_second_name(spark, statements):
    target = CatalogTarget()
    target.ensure_namespace(spark, "switch_t")
    target.overwrite(load(spark, 3), "switch_t", "other")
    statements.clear()
    target.overwrite(load(spark, 4, ("id", "a")), "switch_t", "other")
    made = next(i for i, s in enumerate(statements) if s.startswith("CREATE TABLE"))
    gone = [i for i, s in enumerate(statements) if s.startswith("DROP TABLE") and "`other`" in s]
    assert not gone and any("RENAME" in s for s in statements[made:])
    assert spark.table("switch_t.other").columns == ["id", "a", "ts"] and spark.table("switch_t.other").count() == 4
    assert [t.name for t in spark.catalog.listTables("switch_t") if t.name.startswith("other")] == ["other"]


@pytest.mark.parametrize("fails", ["SET LOCATION", "CREATE TABLE", "RENAME TO `switch_t`.`kept__before`",
                                   "RENAME TO `switch_t`.`kept`"])
def test_a_failing_switch_keeps_the_old_table(spark, monkeypatch, fails):
    target = CatalogTarget()
    target.ensure_namespace(spark, "switch_t")
    target.overwrite(load(spark, 3), "switch_t", "kept")
    before = folders(spark, "switch_t", "kept")
    run, armed = sinks.run_sql, [True]

    def breaking(spark, sql, *params):
        if armed[0] and sql.endswith(fails) or armed[0] and fails in sql and "RENAME" not in fails:
            armed[0] = False
            raise ConnectionError("the catalog is lost")
        return run(spark, sql, *params)

    monkeypatch.setattr(sinks, "run_sql", breaking)
    columns = ("id",) if fails == "SET LOCATION" else ("id", "a")
    with pytest.raises(ConnectionError):
        target.overwrite(load(spark, 4, columns), "switch_t", "kept")
    assert spark.table("switch_t.kept").count() == 3 and spark.table("switch_t.kept").columns == ["id", "ts"]
    assert folders(spark, "switch_t", "kept") == before
    assert [t.name for t in spark.catalog.listTables("switch_t") if t.name.startswith("kept")] == ["kept"]
    spark.sql("DROP TABLE switch_t.kept")


def test_a_run_that_ended_between_the_renames_is_repaired(spark):
    target = CatalogTarget()
    target.ensure_namespace(spark, "switch_t")
    target.overwrite(load(spark, 3), "switch_t", "torn")
    spark.sql(f"ALTER TABLE switch_t.torn RENAME TO switch_t.torn{ASIDE}")
    target.overwrite(load(spark, 6), "switch_t", "torn")
    assert spark.table("switch_t.torn").count() == 6
    assert not spark.catalog.tableExists(f"switch_t.torn{ASIDE}")


def test_a_view_is_not_replaced(spark):
    target = CatalogTarget()
    target.ensure_namespace(spark, "switch_t")
    spark.sql("CREATE OR REPLACE VIEW switch_t.looked_at AS SELECT 1 AS id")
    with pytest.raises(ValueError, match="no table that a load can replace"):
        target.overwrite(load(spark, 2), "switch_t", "looked_at")
    assert spark.table("switch_t.looked_at").first().id == 1 and not folders(spark, "switch_t", "looked_at")


def test_a_table_that_was_not_loaded_here_keeps_its_files(spark):
    target = CatalogTarget()
    target.ensure_namespace(spark, "switch_t")
    folder = tempfile.mkdtemp(prefix="pagelake-own-")
    spark.range(2).write.mode("overwrite").parquet(folder)
    spark.sql(f"CREATE TABLE switch_t.foreign USING parquet LOCATION '{folder}'")
    for n in (1, 2, 3):
        target.overwrite(load(spark, n), "switch_t", "foreign")
    assert spark.table("switch_t.foreign").count() == 3 and spark.read.parquet(folder).count() == 2
