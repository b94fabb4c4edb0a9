"""Page sources: the paged JSON data source, landed page files, table replay."""

from pagelake.sources.landed import land_page_files, land_pages, read_landed_pages, read_page_files
from pagelake.sources.packs import land_page_packs, read_page_packs
from pagelake.sources.paged_json import PagedJsonDataSource, endpoint_url, register
from pagelake.sources.table_pages import records_as_pages

__all__ = [
    "PagedJsonDataSource",
    "endpoint_url",
    "land_page_files",
    "land_page_packs",
    "land_pages",
    "read_landed_pages",
    "read_page_files",
    "read_page_packs",
    "records_as_pages",
    "register",
]
