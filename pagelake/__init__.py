"""pagelake: paged JSON API ingest on Spark.

Responses become rows (``page, status, body``), are typed by a declared schema,
get a row hash and a processing timestamp, and replace a ``<layer>.<source>_<dataset>``
table - all as DataFrame plans that run on executors.

Typical use::

    from pagelake import dataset_spec, ingest, read_records
    spec = dataset_spec("schema/events.yaml", source="clicks")
    rows = read_records(pages, spec)                # typed records, checked
    ingest(spark, spec, pages=pages)               # -> bronze.clicks_events
"""

from pagelake.functions import dataset_spec, row_hash, with_audit_columns, with_row_hash
from pagelake.operators import PageError, check_pages, parse_pages, read_records, stage_pages
from pagelake.plans import CatalogTarget, JdbcTarget, SourceSpec, ingest, postgres_target, run

__version__ = "0.1.0"

__all__ = [
    "CatalogTarget",
    "JdbcTarget",
    "PageError",
    "SourceSpec",
    "check_pages",
    "dataset_spec",
    "ingest",
    "parse_pages",
    "postgres_target",
    "read_records",
    "row_hash",
    "run",
    "stage_pages",
    "with_audit_columns",
    "with_row_hash",
]
