"""Command line: ``spark-submit -m pagelake --action ingest --dataset <source>[.<dataset>]``.

Runs on the session the platform provides (``SparkSession.builder.getOrCreate()``).
``--dataset`` selects ``<source>.<dataset>``, every enabled dataset of
``<source>``, or ``*`` for everything enabled.  ``--target postgres`` writes
over JDBC to the database named by the ``POSTGRES_*`` environment; the default
writes tables of the session catalog.
"""

from __future__ import annotations

import argparse
import logging
import sys

from pagelake.plans.config import discover_sources, load_run_config
from pagelake.plans.ingest import run
from pagelake.plans.sinks import DEFAULT_LAYER, CatalogTarget, postgres_target

log = logging.getLogger("pagelake")


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="pagelake", description="Paged JSON API ingest on Spark")
    parser.add_argument("--action", required=True, choices=["ingest"])
    parser.add_argument("--dataset", required=True, help="<source>.<dataset>, <source>, or * for all enabled")
    parser.add_argument("--config", default="config.yaml", help="run configuration (enabled sources/datasets)")
    parser.add_argument("--datasets-dir", default="datasets", help="folder with <source>/config.yaml and schema/")
    parser.add_argument("--headers-group", default=None, help="take request headers from headers.<group>")
    parser.add_argument("--target", choices=["catalog", "postgres"], default="catalog")
    parser.add_argument("--layer", default=DEFAULT_LAYER)
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(asctime)s %(name)s: %(message)s")
    run_config = load_run_config(args.config)
    sources = discover_sources(args.datasets_dir, headers_group=args.headers_group)

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("pagelake-ingest").getOrCreate()
    target = postgres_target() if args.target == "postgres" else CatalogTarget()
    results = run(spark, sources, run_config, selector=args.dataset, target=target, layer=args.layer)
    for r in results:
        log.info("%s -> %s: %d records from %d pages", r.dataset, r.table, r.records, r.pages)
    return 0


if __name__ == "__main__":
    sys.exit(main())
