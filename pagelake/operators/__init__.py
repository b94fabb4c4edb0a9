"""DataFrame operators: page parsing, end-of-data rule, checks, dense row index."""

from pagelake.operators.index import with_row_index
from pagelake.operators.pages import (
    PAGE_SCHEMA,
    PageCheck,
    PageError,
    cap_pages,
    check_pages,
    page_records,
    parse_pages,
    read_records,
    stage_pages,
)

__all__ = [
    "PAGE_SCHEMA",
    "PageCheck",
    "PageError",
    "cap_pages",
    "check_pages",
    "page_records",
    "parse_pages",
    "read_records",
    "stage_pages",
    "with_row_index",
]
