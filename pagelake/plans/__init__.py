"""Jobs: targets, the ingest of one dataset, runs over selected datasets, configuration files."""

from pagelake.plans.config import discover_sources, load_run_config, load_source_config
from pagelake.plans.ingest import IngestResult, api_pages, ingest, run, stage_api_pages
from pagelake.plans.registry import SourceSpec, load_source, select_datasets, source_spec
from pagelake.plans.sinks import CatalogTarget, JdbcTarget, postgres_target, run_sql, target_table

__all__ = [
    "CatalogTarget",
    "IngestResult",
    "JdbcTarget",
    "SourceSpec",
    "api_pages",
    "discover_sources",
    "ingest",
    "load_run_config",
    "load_source",
    "load_source_config",
    "postgres_target",
    "run",
    "run_sql",
    "select_datasets",
    "source_spec",
    "stage_api_pages",
    "target_table",
]
