"""Configuration files of a run.

Layout (one folder per source)::

    config.yaml                          run configuration: which sources/datasets are enabled
    <datasets_dir>/<source>/config.yaml  source: name, variables.base_url/timeout, headers
    <datasets_dir>/<source>/schema/<dataset>.yaml
                                         dataset: responsePath, pagination, columns
                                         (+ optional endpoint, params)

Endpoints and query parameters may also sit in the source config under
``datasets.<dataset>.endpoint`` / ``.params``.
"""

from __future__ import annotations

import os
from glob import escape as glob_escape
from glob import glob

from pagelake.functions.schema import yaml_document
from pagelake.plans.registry import SourceSpec, load_source


def load_run_config(path: str = "config.yaml") -> dict:
    """The run configuration; a missing file is an error that names it."""
    return dict(yaml_document(path))


def load_source_config(datasets_dir: str, source: str) -> dict:
    """A source's configuration; a missing file is an error that names it."""
    return dict(yaml_document(os.path.join(datasets_dir, source, "config.yaml")))


def discover_sources(datasets_dir: str, headers_group: str | None = None) -> list[SourceSpec]:
    """Every ``<datasets_dir>/<source>`` with a ``config.yaml``, with the datasets of its ``schema/`` folder."""
    sources = []
    for config in sorted(glob(os.path.join(glob_escape(datasets_dir), "*", "config.yaml"))):
        folder = os.path.dirname(config)
        doc = load_source_config(datasets_dir, os.path.basename(folder))
        schemas = sorted(glob(os.path.join(glob_escape(folder), "schema", "*.y*ml")))
        docs = {os.path.splitext(os.path.basename(path))[0]: yaml_document(path) for path in schemas}
        requests = {name: entry or {} for name, entry in (doc.get("datasets") or {}).items()}
        sources.append(load_source(
            doc, docs, headers_group=headers_group,
            endpoints={name: r["endpoint"] for name, r in requests.items() if r.get("endpoint") is not None},
            params={name: r["params"] for name, r in requests.items() if r.get("params") is not None}))
    return sources
