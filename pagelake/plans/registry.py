"""Sources, their datasets, and which of them a run ingests.

A run configuration enables sources and datasets::

    sources:
      <source>:
        enabled: true
        datasets:
          <dataset>: {enabled: true}

Both flags default to false.  A selector then narrows the enabled datasets:
``"<source>.<dataset>"``, ``"<source>"`` (all enabled datasets of that source), or ``None``/``""``/``"*"`` (everything
enabled).  Sources left without datasets are dropped.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pagelake.functions.schema import DatasetSpec, dataset_spec, yaml_document
from pagelake.sources.paged_json import API_KEY_PLACEHOLDER, DEFAULT_TIMEOUT, api_key_env, is_http


@dataclass(frozen=True)
class SourceSpec:
    """An API: base URL, request headers, how it is requested, and its datasets.

    ``first_wave``/``max_wave``: pages requested at once at first, and at most (waves
    double).  A dataset that ends early is over-fetched by less than one wave, so set
    both to 1 for an API that must see one request beyond the end and no more.
    ``pages_per_task``: pages that one task requests, one after another (default: two
    tasks per core); with the wave size it bounds the requests in flight.
    ``transport``: what answers the requests (see :mod:`pagelake.sources.requests`); by
    default they go to ``base_url``.
    An ``http(s)`` source must have request headers.
    """

    name: str
    base_url: str = ""
    headers: Mapping[str, str] = field(default_factory=dict)
    timeout: float = DEFAULT_TIMEOUT
    datasets: tuple[DatasetSpec, ...] = ()
    retries: int = 0
    first_wave: int = 64
    max_wave: int = 8192
    pages_per_task: int | None = None
    transport: str = ""

    def __post_init__(self) -> None:
        nested = [name for name, value in self.headers.items() if isinstance(value, Mapping)]
        if nested:
            raise ValueError(f"request headers must be texts; {', '.join(nested)} holds a group of headers")
        if is_http(self.base_url) and not self.headers:
            raise ValueError(f"source {self.name} is requested over HTTP and needs request headers")
        if self.first_wave < 1 or self.max_wave < self.first_wave:
            raise ValueError("waves need 1 <= first_wave <= max_wave")

    @property
    def key_env(self) -> str | None:
        """Name of the env variable with the API key, when a header asks for one."""
        needs = any(API_KEY_PLACEHOLDER in str(v) for v in self.headers.values())
        return api_key_env(self.name) if needs else None


def source_spec(
    doc: Mapping[str, Any] | str,
    datasets: Iterable[DatasetSpec] = (),
    headers_group: str | None = None,
) -> SourceSpec:
    """Source from its config document.

    Read are ``name``, ``variables`` (``base_url``, ``timeout``, ``retry_attempts``, ``first_wave``,
    ``max_wave``, ``pages_per_task``, ``transport``) and ``headers``: the headers themselves, or
    groups of them.  ``headers_group`` names the group; a single group needs no name.
    """
    d = yaml_document(doc)
    variables, headers = d.get("variables") or {}, d.get("headers") or {}
    groups = {name: group for name, group in headers.items() if isinstance(group, Mapping)}
    if headers_group is not None:
        headers = groups.get(headers_group) or {}
        if not headers:
            raise ValueError(f"source {d['name']} has no request headers in group {headers_group}")
    elif len(groups) == len(headers) == 1:
        (headers,) = groups.values()
    elif groups:
        raise ValueError(f"source {d['name']} has several header groups ({', '.join(groups)}): name one")
    first = int(variables.get("first_wave") or 64)
    per_task = variables.get("pages_per_task")
    return SourceSpec(
        name=d["name"],
        base_url=variables.get("base_url", ""),
        headers={name: str(value) for name, value in headers.items()},
        timeout=float(variables.get("timeout", DEFAULT_TIMEOUT)),
        datasets=tuple(datasets),
        retries=int(variables.get("retry_attempts", 0) or 0),
        first_wave=first,
        max_wave=int(variables.get("max_wave") or max(first, 8192)),
        pages_per_task=None if per_task is None else int(per_task),
        transport=str(variables.get("transport") or ""),
    )


def load_source(source_doc, dataset_docs: Mapping[str, Mapping[str, Any] | str],
                endpoints: Mapping[str, str] | None = None, params: Mapping[str, Mapping[str, str]] | None = None,
                headers_group: str | None = None) -> SourceSpec:
    """A source with its datasets, each from a schema document keyed by dataset name."""
    src = source_spec(source_doc, headers_group=headers_group)
    specs = tuple(
        dataset_spec(doc, source=src.name, name=name, endpoint=(endpoints or {}).get(name),
                     params=(params or {}).get(name))
        for name, doc in dataset_docs.items()
    )
    return replace(src, datasets=specs)


def select_datasets(
    sources: Iterable[SourceSpec], run_config: Mapping[str, Any] | str, selector: str | None = None
) -> list[SourceSpec]:
    """Sources (with only their selected datasets) that a run ingests, in declared order."""
    settings = yaml_document(run_config).get("sources") or {}

    def on(part: Any) -> bool:
        return bool((part or {}).get("enabled", False))

    def wanted(source: SourceSpec, dataset: DatasetSpec) -> bool:
        own = settings.get(source.name) or {}
        if not on(own) or not on((own.get("datasets") or {}).get(dataset.name)):
            return False
        return not selector or selector in ("*", source.name, dataset.qualified_name)

    narrowed = (replace(s, datasets=tuple(d for d in s.datasets if wanted(s, d))) for s in sources)
    return [s for s in narrowed if s.datasets]
