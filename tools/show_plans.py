"""Print the physical plans of the main operators (Markdown) - the source of PLANS.md.

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pagelake.functions.audit import with_audit_columns  # noqa: E402
from pagelake.operators.index import with_row_index  # noqa: E402
from pagelake.operators.pages import (  # noqa: E402
    _end_page,
    _flags,
    _summary,
    check_pages,
    page_records,
    parse_pages,
    stage_pages,
)
from pagelake.plans import queries as q  # noqa: E402
from pagelake.session import local_session, scratch_folder  # noqa: E402
from pagelake.sources.landed import land_pages, read_landed_pages  # noqa: E402


def plan(df, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    text = re.sub(r"#\d+L?", "", buf.getvalue())  # expression ids change from run to run
    return re.sub(r"-[0-9a-f]{32}", "-<run>", text)


def section(title: str, note: str, df, mode: str = "formatted") -> None:
    print(f"## {title}\n\n{note}\n\n```\n{plan(df, mode).strip()}\n```\n")


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    spec = q.spec("events", q.EVENTS)
    print(f"# Physical plans\n\nGenerated by `tools/show_plans.py` on `{os.path.basename(sf_dir)}` "
          "(Spark 4.1, `local[8]`, AQE on). Expression ids removed.\n")
    landed = read_landed_pages(spark, land_pages(q.event_pages(spark, sf_dir), scratch_folder(spark, "landed") + "/p"))
    section("1. Parse landed pages (the staging write's input)",
            "One scan of the landed pages, the envelope `from_json` once, flags in stacked "
            "projections. No exchange.", parse_pages(landed, spec), "simple")
    # pages with an empty middle page (and broken pages after it), so an end page exists
    staged = stage_pages(q._with_middle_stop(q.event_pages(spark, sf_dir)), spec)
    result = check_pages(staged, spec)
    flags = _flags(staged)
    section("2a. End page over staged pages",
            "Reads only `page, empty` (`ReadSchema`); one row.", _end_page(flags))
    section("2b. Summary of the pages before the end page",
            f"`page < {result.stop}` is a literal pushed into the Parquet scan; reads only the flag columns.",
            _summary(flags.where(F.col("page") < F.lit(result.stop))))
    section("3. Records of the pages before the end page, with audit columns (what the target receives)",
            f"End page {result.stop}: `page < stop` is a pushed Parquet filter; `inline`, `sha2`/`concat_ws` "
            "and the timestamp stay in one codegen stage.",
            with_audit_columns(page_records(staged, result.stop)))
    section("4. Table replay as pages (test and bench input)",
            "Rows are shuffled by page number (`REPARTITION_BY_COL`), then collected (at most 100 per page), "
            "ordered and serialised after the exchange.", q.event_pages(spark, sf_dir), "simple")
    section("5. Dense row index",
            "The input is written once; per-partition counts, a running sum over one row per partition, and an "
            "equi-join on the partition id.",
            with_row_index(q.table(spark, sf_dir, "lineitem"), "row_index"), "simple")


if __name__ == "__main__":
    main(sys.argv)
