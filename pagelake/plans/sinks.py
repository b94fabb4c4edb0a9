"""Targets of an ingest: full-refresh tables in a Spark catalog or over JDBC.

A dataset ``<source>.<dataset>`` lands in ``<layer>.<source>_<dataset>``; the
layer is a namespace created if missing.  A load replaces the whole table, and only
once all its rows are written.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelake.session import remove_folder

DEFAULT_LAYER = "bronze"
SECRETS = {"password"}
#: Table property with the folder of the load before, and suffix of a table that a load is taking the place of.
BEFORE, ASIDE = "pagelake.before", "__before"


def table_name(source: str, dataset: str) -> str:
    return f"{source}_{dataset}"


def target_table(layer: str, source: str, dataset: str) -> str:
    """``<layer>.<source>_<dataset>``."""
    return f"{layer}.{table_name(source, dataset)}"


def _quote(*parts: str) -> str:
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def run_sql(spark: SparkSession, sql: str, *params) -> DataFrame:
    """Run one statement, its ``?`` parameters bound to the values in order; its result, if it has one."""
    return spark.sql(sql, args=list(params) if params else None)


@dataclass(frozen=True)
class CatalogTarget:
    """Tables of a Spark catalog: the session catalog (``catalog=None``) or a named one.

    In the session catalog every load is written to a fresh folder beside the
    namespace's tables, and a finished load takes the table's place without dropping it
    first: with the same columns the table is pointed at the new folder; other columns
    go in as a table of a second name, which takes the first one's name by renames.
    A switch that fails is taken back.  The folder of the load before stays until the
    next load, for queries that still read it.  The tables are external: DROP TABLE keeps
    the last loads' folders.
    Named catalogs (v2) use ``createOrReplace``, which is theirs to make atomic.
    """

    catalog: str | None = None
    format: str = "parquet"

    def qualified(self, layer: str, table: str) -> str:
        return _quote(*([self.catalog] if self.catalog else []), layer, table)

    def ensure_namespace(self, spark: SparkSession, layer: str) -> None:
        ns = _quote(*([self.catalog] if self.catalog else []), layer)
        run_sql(spark, f"CREATE NAMESPACE IF NOT EXISTS {ns}")

    def execute(self, spark: SparkSession, sql: str, *params) -> DataFrame:
        """Run one statement against the catalog, with ``?`` parameters bound."""
        return run_sql(spark, sql, *params)

    def overwrite(self, df: DataFrame, layer: str, table: str) -> str:
        spark, name = df.sparkSession, self.qualified(layer, table)
        if self.catalog is not None:
            df.writeTo(name).using(self.format).createOrReplace()
            return name
        root = spark.catalog.getDatabase(layer).locationUri.rstrip("/")
        folder = f"{root}/{table}-{uuid.uuid4().hex}"
        try:
            df.write.format(self.format).save(folder)
            self._switch(spark, layer, table, df.schema, folder)
        except Exception:
            remove_folder(spark, folder)
            raise
        return name

    def _switch(self, spark: SparkSession, layer: str, table: str, schema: T.StructType, folder: str) -> None:
        """Let the table hold the load in ``folder``."""
        name, aside = self.qualified(layer, table), self.qualified(layer, f"{table}{ASIDE}")
        if not spark.catalog.tableExists(name) and spark.catalog.tableExists(aside):
            run_sql(spark, f"ALTER TABLE {aside} RENAME TO {name}")  # a run ended between two renames
        if not spark.catalog.tableExists(name):
            self._create(spark, name, folder)
            return
        before, older = self._location(spark, name), self._property(spark, name, BEFORE)
        if before is None:
            raise ValueError(f"{name} is no table that a load can replace")
        if spark.table(name).schema.simpleString() == schema.simpleString():  # columns and types; files hold any null
            run_sql(spark, f"ALTER TABLE {name} SET LOCATION {_text(folder)}")
        else:
            self._rename_in(spark, layer, table, folder)
        spark.catalog.refreshTable(name)
        run_sql(spark, f"ALTER TABLE {name} SET TBLPROPERTIES ({_text(BEFORE)} = {_text(before)})")
        if older is not None and older not in (before, folder) and older.rsplit("/", 1)[-1].startswith(f"{table}-"):
            remove_folder(spark, older)

    def _create(self, spark: SparkSession, name: str, folder: str) -> None:
        run_sql(spark, f"CREATE TABLE {name} USING {self.format} LOCATION {_text(folder)}")

    def _rename_in(self, spark: SparkSession, layer: str, table: str, folder: str) -> None:
        """A table of other columns under a second name, then both renamed; the old one goes last."""
        name, aside = self.qualified(layer, table), self.qualified(layer, f"{table}{ASIDE}")
        loaded = self.qualified(layer, f"{table}_{folder.rsplit('-', 1)[-1]}")
        self._create(spark, loaded, folder)
        try:
            run_sql(spark, f"DROP TABLE IF EXISTS {aside}")
            run_sql(spark, f"ALTER TABLE {name} RENAME TO {aside}")
            try:
                run_sql(spark, f"ALTER TABLE {loaded} RENAME TO {name}")
            except Exception:
                run_sql(spark, f"ALTER TABLE {aside} RENAME TO {name}")
                raise
        except Exception:
            run_sql(spark, f"DROP TABLE IF EXISTS {loaded}")
            raise
        run_sql(spark, f"DROP TABLE IF EXISTS {aside}")

    def _property(self, spark: SparkSession, name: str, key: str) -> str | None:
        rows = spark.sql(f"SHOW TBLPROPERTIES {name}").filter(F.col("key") == key).collect()
        return rows[0]["value"] if rows else None

    def _location(self, spark: SparkSession, name: str) -> str | None:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
        return rows[0].data_type if rows else None

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        return spark.table(self.qualified(layer, table))


def _jdbc_ready(df: DataFrame) -> DataFrame:
    """JDBC has no struct/array/map columns: write those as JSON text."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(
        *[F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
          for f in df.schema.fields]
    )


@dataclass(frozen=True)
class JdbcTarget:
    """A database reached over JDBC (any JDBC URL with its driver on the classpath).

    Writes use Spark's JDBC writer: one connection per partition, ``numPartitions``
    and ``batchsize`` tune the load.  Namespaces are created through Spark's JDBC
    table catalog.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    write_options: Mapping[str, str] = field(default_factory=dict)

    @property
    def catalog_name(self) -> str:
        """A catalog of its own for each database."""
        return "pagelake_jdbc_" + hashlib.sha256(self.url.encode()).hexdigest()[:12]

    @contextmanager
    def catalog(self, spark: SparkSession) -> Iterator[str]:
        """The database as a catalog of the session; secrets are in its settings only until the catalog is open."""
        prefix = f"spark.sql.catalog.{self.catalog_name}"
        spark.conf.set(prefix, "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog")
        spark.conf.set(f"{prefix}.url", self.url)
        given = {k: v for k, v in self.properties.items() if v is not None}
        for k, v in given.items():
            spark.conf.set(f"{prefix}.{k}", v)
        try:
            yield self.catalog_name
        finally:
            for k in SECRETS & given.keys():
                spark.conf.unset(f"{prefix}.{k}")

    def ensure_namespace(self, spark: SparkSession, layer: str) -> None:
        with self.catalog(spark) as name:
            run_sql(spark, f"CREATE NAMESPACE IF NOT EXISTS {_quote(name, layer)}")

    def execute(self, spark: SparkSession, sql: str, *params) -> DataFrame:
        """Run one statement that names tables as ``{catalog}.<layer>.<table>``, with ``?`` parameters bound."""
        with self.catalog(spark) as name:
            return run_sql(spark, sql.replace("{catalog}", _quote(name)), *params)

    def qualified(self, layer: str, table: str) -> str:
        return f"{layer}.{table}"

    def overwrite(self, df: DataFrame, layer: str, table: str) -> str:
        name = self.qualified(layer, table)
        props = {k: v for k, v in self.properties.items() if v is not None}
        writer = _jdbc_ready(df).write
        for k, v in self.write_options.items():
            writer = writer.option(k, v)
        writer.jdbc(url=self.url, table=name, mode="overwrite", properties=props)
        return name

    def read(self, spark: SparkSession, layer: str, table: str) -> DataFrame:
        props = {k: v for k, v in self.properties.items() if v is not None}
        return spark.read.jdbc(self.url, self.qualified(layer, table), properties=props)


# --- Fixed values: environment variables and driver of a PostgreSQL target ---
POSTGRES_ENV = {
    "host": "POSTGRES_HOST",
    "port": "POSTGRES_PORT",
    "dbname": "POSTGRES_DB",
    "user": "POSTGRES_USER",
    "password": "POSTGRES_PASSWORD",
}
POSTGRES_DEFAULT_PORT = "5432"
POSTGRES_DRIVER = "org.postgresql.Driver"
# --- end of fixed values ---


def postgres_target(env: Mapping[str, str] | None = None, **write_options: str) -> JdbcTarget:
    """JDBC target ``jdbc:postgresql://host:port/db`` from the ``POSTGRES_*`` environment."""
    env = os.environ if env is None else env
    missing = [POSTGRES_ENV[k] for k in ("host", "dbname") if not env.get(POSTGRES_ENV[k])]
    if missing:
        raise ValueError(f"the environment has no {' and no '.join(missing)}")
    host, db = env[POSTGRES_ENV["host"]], env[POSTGRES_ENV["dbname"]]
    port = env.get(POSTGRES_ENV["port"], POSTGRES_DEFAULT_PORT)
    props = {
        "user": env.get(POSTGRES_ENV["user"]),
        "password": env.get(POSTGRES_ENV["password"]),
        "driver": POSTGRES_DRIVER,
    }
    return JdbcTarget(url=f"jdbc:postgresql://{host}:{port}/{db}", properties=props, write_options=write_options)
