"""``paged_json``: a Python data source that requests API pages on executors.

Each input partition holds a range of page numbers; each executor task issues
its own GETs and emits ``page, status, body`` rows.  Nothing passes through the
driver and pages are fetched in parallel (one task per ``pagesPerPartition``).

Options:

* ``url`` - full endpoint URL (see :func:`endpoint_url`).  A URL that is not
  ``http(s)://`` names a folder of responses (:class:`ResponseFolder`:
  ``page-<n>.json`` or ``page=<n>/``, packs with their index, ``response.json`` for a single
  request) on any filesystem; a page missing from the middle of it fails, it never ends the
  data.  The folder is listed once, when the scan is planned, and every partition gets
  the places of its own pages.
* ``params`` / ``headers`` - JSON objects.  Header values may hold the
  ``{api_key}`` placeholder; ``apiKeyEnv`` names the environment variable that
  holds the key, looked up when the reader is built (the key never appears in
  options or plans).
* ``paginate`` - ``true``: add ``page=<n>`` for n in ``firstPage..lastPage``;
  ``false``: one request, no page parameter.  A folder without ``response.json`` that holds
  numbered responses is a set of single responses, all read by one scan.
* ``singleTasks`` - most tasks that read such a set (default 256).
* ``timeout`` - seconds per request (default 30).
* ``retries`` - extra attempts for transient failures (connection errors,
  timeouts, 429, 502-504), with exponential backoff (default 0).
* ``prunePages`` - ``true`` when the session enables
  ``spark.sql.python.filterPushdown.enabled``: comparisons on ``page`` in the
  query narrow the pages that are requested at all.

A request that raises (timeout, connection error) yields ``status = -1`` and the
error text as body: a page past the end of data may fail without failing the
dataset, one before it fails the dataset in :func:`pagelake.operators.check_pages`.
HTTP transport cannot be exercised in this repository's tests (no network);
the folder transport exercises the same planning and partitioning.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Mapping

from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)
from pyspark.sql.types import StructType

from pagelake.operators.pages import PAGE_SCHEMA
from pagelake.sources.packs import INDEX

# --- Fixed values ---
API_KEY_PLACEHOLDER = "{api_key}"
DEFAULT_TIMEOUT = 30
PAGE_PARAM = "page"
FILE_SINGLE = "response.json"
# --- end of fixed values ---
TRANSIENT_STATUS = frozenset({429, 502, 503, 504})
BACKOFF_SECONDS = 0.5
DEFAULT_SINGLE_TASKS = 256
_FILE_PAGE = re.compile(r"page-(\d+)\.json$")
_FOLDER_PAGE = re.compile(r"page=(\d+)/")
_FOLDER_STATUS = re.compile(r"/status=(-?\d+)/")
MAX_BACKOFF_SECONDS = 30.0


def is_http(url: str) -> bool:
    return url.startswith(("http://", "https://"))


def endpoint_url(base_url: str, endpoint: str) -> str:
    """``base_url`` and ``endpoint`` joined by exactly one slash."""
    return base_url.rstrip("/") + "/" + endpoint.lstrip("/")


def api_key_env(source_name: str) -> str:
    """Environment variable holding a source's API key: ``<SOURCE>_KEY``."""
    return f"{source_name.upper()}_KEY"


def with_api_key(headers: Mapping[str, str], key: str) -> dict[str, str]:
    """Request headers with the key in place of its placeholder."""
    return {name: value.replace(API_KEY_PLACEHOLDER, key) for name, value in headers.items()}


#: Where a response lies: path, status, and offset and length in a pack (None: the whole file).
Place = tuple[str, int, int | None, int | None]


class ResponseFolder:
    """Responses in a folder, listed once: ``page-<n>.json`` files, one file below each ``page=<n>/`` folder, and packs.

    A page that lies beyond the highest one present is an empty response (end of
    data).  A page missing below it is a 404, and a page with several responses is a
    failed request: neither may pass for the end.
    """

    def __init__(self, url: str):
        from pyarrow import fs as pafs

        from pagelake.session import resolve_filesystem

        self.filesystem, self.root = resolve_filesystem(url)
        self.places: dict[int | None, list[Place]] = {}
        selector = pafs.FileSelector(self.root, allow_not_found=True, recursive=True)
        packed = False
        for info in self.filesystem.get_file_info(selector):
            inner = info.path[len(self.root):].lstrip("/")
            if info.type != pafs.FileType.File or any(p.startswith(("_", ".")) for p in inner.split("/")):
                continue
            folder, name = _FOLDER_PAGE.match(inner), _FILE_PAGE.match(inner)
            if inner.startswith(f"{INDEX}/"):
                packed = True
            elif folder or name:
                status = _FOLDER_STATUS.search(info.path)
                place = (info.path, int(status.group(1)) if status else 200, None, None)
                self.places.setdefault(int((folder or name).group(1)), []).append(place)
            elif inner == FILE_SINGLE:
                self.places.setdefault(None, []).append((info.path, 200, None, None))
        if packed:
            self._list_packs()
        self.last = max((p for p in self.places if p is not None), default=0)

    def _list_packs(self) -> None:
        import pyarrow.dataset as ds

        index = ds.dataset(f"{self.root}/{INDEX}", filesystem=self.filesystem, format="parquet").to_table()
        for page, status, file, offset, length in zip(*(index[c].to_pylist() for c in (
                "page", "status", "file", "offset", "length")), strict=True):
            self.places.setdefault(page, []).append((f"{self.root}/{file}", 200 if status is None else status, offset, length or 0))

    def within(self, pages: range | list[int | None]) -> dict[int | None, list[Place]]:
        """Places of these pages (a range may be far longer than the folder)."""
        if len(pages) > len(self.places):
            return {page: found for page, found in self.places.items() if page in pages}
        return {page: self.places[page] for page in pages if page in self.places}

    def get(self, page: int | None) -> tuple[int, str]:
        return next((status, text) for _, status, text in served(self.filesystem, [page], self.within([page]), self.last))


def served(filesystem, pages: Iterable[int | None], places: Mapping[int | None, list[Place]],
           last: int) -> Iterator[tuple[int | None, int, str]]:
    """The responses of some pages, read from their places; a pack stays open from page to page."""
    opened = (None, None)
    for page in pages:
        found = places.get(page, [])
        if not found:
            yield (page, 200, "{}") if page is not None and page > last else (page, 404, "")
            continue
        if len(found) > 1:
            yield page, -1, f"{len(found)} responses for one page: {', '.join(sorted(p[0] for p in found))}"
            continue
        path, status, offset, length = found[0]
        if offset is None:
            with filesystem.open_input_stream(path, compression=None) as file:
                data = file.read()
        else:
            if opened[0] != path:
                if opened[1] is not None:
                    opened[1].close()
                opened = (path, filesystem.open_input_file(path))
            data = opened[1].read_at(length, offset)
        yield page, status, data.decode("utf-8")
    if opened[1] is not None:
        opened[1].close()


def retried(send, attempts: int, backoff: float = BACKOFF_SECONDS) -> tuple[int, str]:
    """The first answer of ``send()`` that is not transient (no answer, 429, 502-504), else the last one."""
    import time

    outcome = (-1, "not requested")
    for attempt in range(max(1, attempts)):
        if attempt:
            time.sleep(min(backoff * 2 ** (attempt - 1), MAX_BACKOFF_SECONDS))
        outcome = send()
        if outcome[0] >= 0 and outcome[0] not in TRANSIENT_STATUS:
            break
    return outcome


def http_get(url: str, params: Mapping[str, str], headers: Mapping[str, str], timeout: float) -> tuple[int, str]:
    """One GET; ``(-1, error)`` where no answer came."""
    import requests

    try:
        response = requests.get(url, headers=dict(headers), params=params, timeout=timeout)
    except requests.RequestException as exc:
        return -1, f"{type(exc).__name__}: {exc}"
    return response.status_code, response.text


def fetch(url: str, params: Mapping[str, str], headers: Mapping[str, str], timeout: float,
          page: int | None, retries: int = 0, backoff: float = BACKOFF_SECONDS) -> tuple[int, str]:
    """One response: ``(status, text)``.  ``page=None``: no page parameter.

    Transient failures are retried ``retries`` times with exponential backoff.
    """
    if not is_http(url):
        return ResponseFolder(url).get(page)
    query = dict(params)
    if page is not None:
        query[PAGE_PARAM] = str(page)
    return retried(lambda: http_get(url, query, headers, timeout), retries + 1, backoff)


class PageRange(InputPartition):
    """Pages of one fetch task: a ``range`` (compact however many pages) or an explicit list, and, for a folder,
    where its own pages lie and what the folder's last page is."""

    def __init__(self, pages: range | list[int | None], places: dict[int | None, list[Place]] | None = None, last: int = 0):
        super().__init__(pages)
        self.pages = pages
        self.places = places
        self.last = last


def _chunks(first: int, last: int, size: int) -> list[PageRange]:
    return [PageRange(range(start, min(start + size, last + 1))) for start in range(first, last + 1, size)]


class PagedJsonReader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self.url = options["url"]
        self.params = json.loads(options.get("params") or "{}")
        headers = json.loads(options.get("headers") or "{}")
        env_name = options.get("apiKeyEnv")
        if env_name:
            key = os.environ.get(env_name)
            if not key:
                raise ValueError(f"the environment has no {env_name}, which the request headers need")
            headers = with_api_key(headers, key)
        self.headers = headers
        self.timeout = float(options.get("timeout") or DEFAULT_TIMEOUT)
        self.retries = int(options.get("retries") or 0)
        self.paginate = str(options.get("paginate", "true")).lower() == "true"
        self.first = int(options.get("firstPage") or 1)
        self.last = int(options.get("lastPage") or self.first)
        self.per_partition = max(1, int(options.get("pagesPerPartition") or 1))
        self.most_tasks = max(1, int(options.get("singleTasks") or DEFAULT_SINGLE_TASKS))

    def planned(self) -> list[PageRange]:
        """The pages of each task."""
        return _chunks(self.first, self.last, self.per_partition) or [PageRange([])]

    def partitions(self) -> list[InputPartition]:
        if is_http(self.url):
            return self.planned() if self.paginate else [PageRange([None])]
        folder = ResponseFolder(self.url)  # the only listing of this scan
        if self.paginate:
            parts = self.planned()
        elif None in folder.places or not folder.places:
            parts = [PageRange([None])]
        else:
            numbers = sorted(folder.places)
            size = max(self.per_partition, -(-len(numbers) // self.most_tasks))
            parts = [PageRange(numbers[i:i + size]) for i in range(0, len(numbers), size)]
        return [PageRange(p.pages, folder.within(p.pages), folder.last) for p in parts]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        if is_http(self.url):
            for page in partition.pages:
                yield (1 if page is None else page,
                       *fetch(self.url, self.params, self.headers, self.timeout, page, self.retries))
            return
        from pagelake.session import resolve_filesystem

        filesystem, _ = resolve_filesystem(self.url)
        for page, status, text in served(filesystem, partition.pages, partition.places or {}, partition.last):
            yield (1 if page is None else page, status, text)


class PagePruningReader(PagedJsonReader):
    """Reader that narrows the requested pages by pushed ``page`` comparisons.

    Used when the session enables ``spark.sql.python.filterPushdown.enabled``.
    Every filter is also handed back, so Spark still applies it after the scan.
    """

    def pushFilters(self, filters):
        wanted: set[int] | None = None
        for f in filters:
            if self.paginate and tuple(f.attribute) == (PAGE_PARAM,):
                if isinstance(f, (LessThan, LessThanOrEqual)):
                    self.last = min(self.last, int(f.value) - (1 if isinstance(f, LessThan) else 0))
                elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                    self.first = max(self.first, int(f.value) + (1 if isinstance(f, GreaterThan) else 0))
                elif isinstance(f, EqualTo):
                    wanted = {int(f.value)} if wanted is None else wanted & {int(f.value)}
                elif isinstance(f, In):
                    values = {int(v) for v in f.value if v is not None}
                    wanted = values if wanted is None else wanted & values
            yield f
        self.only = wanted

    def planned(self) -> list[PageRange]:
        only = getattr(self, "only", None)
        if only is None:
            return super().planned()
        numbers = sorted(p for p in only if self.first <= p <= self.last)
        return [PageRange(numbers[i:i + self.per_partition])
                for i in range(0, len(numbers), self.per_partition)] or [PageRange([])]


class PagedJsonDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> StructType:
        return PAGE_SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        if str(self.options.get("prunePages", "false")).lower() == "true":
            return PagePruningReader(self.options)
        return PagedJsonReader(self.options)


PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"


def pushdown_enabled(spark) -> bool:
    return str(spark.conf.get(PUSHDOWN_CONF, "false")).lower() == "true"


def register(spark) -> None:
    from pagelake.session import ship_package

    ship_package(spark)
    spark.dataSource.register(PagedJsonDataSource)
