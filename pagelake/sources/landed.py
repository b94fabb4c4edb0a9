"""Landed responses, read back as ``page, status, body`` rows.

* :func:`land_pages` / :func:`read_landed_pages`: a Parquet folder that keeps page,
  status and body, written and read by Spark.  Failed pages stay failed pages.
* :func:`read_page_files`: a folder of response files that another process fetched,
  one file per page, read whole in the JVM.  :func:`land_page_files` writes such a
  folder (``page=<n>/status=<s>/``), which the ``paged_json`` data source can serve from.

The page number of a response file comes from a ``page=<n>`` folder, else from a name
like ``17.json``, ``page-17.json`` or ``page_17.v2.json``; ``response.json`` is the only
page of a single request.  Any other name fails the read and is named in the error.
The status is that of a ``status=<s>`` folder, else 200.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.operators.pages import BODY, PAGE, PAGE_SCHEMA, STATUS

_PAGE_DIR = r"/page=(\d+)/"
_STATUS_DIR = r"/status=(-?\d+)/"
_PAGE_NAME = r"^(?:page[-_]?)?(\d+)(?:\.[A-Za-z]\w*)*$"
# --- Fixed value: file name of the response of a single request ---
SINGLE_FILE = "response.json"


def land_pages(pages: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write pages with their status and body as Parquet."""
    pages.select(F.col(PAGE).cast("long"), F.col(STATUS).cast("int"), BODY).write.mode(mode).parquet(path)
    return path


def read_landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages that :func:`land_pages` wrote."""
    return spark.read.schema(PAGE_SCHEMA).parquet(path)


def land_page_files(pages: DataFrame, path: str) -> str:
    """Write one text file per page, in ``page=<n>/status=<s>/`` folders."""
    rows = pages.select(F.col(PAGE).cast("long"), F.coalesce(F.col(STATUS), F.lit(200)).cast("int").alias(STATUS),
                        F.coalesce(BODY, F.lit("")).alias(BODY))
    rows.repartition(PAGE).write.mode("overwrite").partitionBy(PAGE, STATUS).text(path)
    return path


def _number(source: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(source, pattern, 1), F.lit("")).cast("long")


def file_pages(files: DataFrame) -> DataFrame:
    """Rows of whole files (``value`` and ``_metadata``) as pages."""
    path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    page = F.coalesce(
        _number(path, _PAGE_DIR), _number(name, _PAGE_NAME), F.when(name == SINGLE_FILE, F.lit(1).cast("long")),
        F.raise_error(F.concat(F.lit("no page number in the name of "), path)).cast("long"))
    status = F.coalesce(_number(path, _STATUS_DIR), F.lit(200))
    return files.select(page.alias(PAGE), status.cast("int").alias(STATUS), F.col("value").alias(BODY))


def read_page_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One page per file of a folder and its subfolders."""
    reader = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return file_pages(reader.text(path))
