"""Declared dataset schemas: YAML column lists -> Spark ``StructType``.

A dataset declares its records as a list of columns, each with a ``name`` and a
``type`` word.  Nested records are declared with a ``columns`` list under a
``dict``/``dictionary`` (one struct) or ``list`` (array of structs) column.
Every field is nullable.  Unknown type words fall back to ``string`` - this is
part of the contract: a column declared ``double`` is read as text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import yaml
from pyspark.sql import types as T

# --- Fixed values (must stay exactly as they are for schema compatibility) ---
# Type word -> Spark type.  Any other word, or a missing type, maps to string.
TYPE_WORDS: Mapping[str, T.DataType] = {
    "float": T.FloatType(),
    "integer": T.IntegerType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}
# Words that open a nested record when the column also carries ``columns``.
STRUCT_WORDS = ("dict", "dictionary")
ARRAY_WORD = "list"
# --- end of fixed values ---


def column_type(column: Mapping[str, Any]) -> T.DataType:
    """Spark type of one declared column (recursive for nested records)."""
    word = column.get("type")
    if "columns" in column and (word in STRUCT_WORDS or word == ARRAY_WORD):
        inner = struct_type(column["columns"])
        return T.ArrayType(inner) if word == ARRAY_WORD else inner
    return TYPE_WORDS.get(word, T.StringType())


def struct_type(columns: Sequence[Mapping[str, Any]] | None) -> T.StructType:
    """``StructType`` for a declared column list, in declared order, all nullable."""
    return T.StructType([T.StructField(c.get("name"), column_type(c), True) for c in (columns or [])])


@dataclass(frozen=True)
class Paging:
    """How a dataset's endpoint is read.

    ``enabled``: request ``page=1,2,...`` and stop at the first empty page;
    otherwise one request whose response must hold the record array.
    ``max_pages``: upper bound on pages read (``None`` = until the first empty page).
    """

    enabled: bool = True
    max_pages: int | None = None

    def __post_init__(self) -> None:
        if self.max_pages is not None and int(self.max_pages) < 0:
            raise ValueError(f"maxPages must be >= 0, got {self.max_pages}")


@dataclass(frozen=True)
class DatasetSpec:
    """One dataset of a source: where its records are and what they look like."""

    source: str
    name: str
    response_path: str
    paging: Paging
    columns: tuple = ()
    endpoint: str = ""
    params: Mapping[str, str] = field(default_factory=dict)
    enabled: bool = True

    @property
    def schema(self) -> T.StructType:
        return struct_type(self.columns)

    @property
    def qualified_name(self) -> str:
        return f"{self.source}.{self.name}"


def yaml_document(doc: Mapping[str, Any] | str) -> Mapping[str, Any]:
    """A YAML mapping, given as such, as text, or as the path of a ``.yaml``/``.yml`` file (which must exist)."""
    if isinstance(doc, Mapping):
        return doc
    text = str(doc)
    if "\n" not in text and text.endswith((".yaml", ".yml")):
        with open(text, encoding="utf-8") as file:
            text = file.read()
    loaded = yaml.safe_load(text)
    if loaded is None:
        return {}
    if not isinstance(loaded, Mapping):
        raise ValueError(f"expected a YAML mapping, got {type(loaded).__name__}")
    return loaded


def dataset_spec(
    doc: Mapping[str, Any] | str,
    source: str,
    name: str | None = None,
    endpoint: str | None = None,
    params: Mapping[str, str] | None = None,
    enabled: bool = True,
) -> DatasetSpec:
    """Build a :class:`DatasetSpec` from a schema document (mapping, YAML text or YAML path).

    ``responsePath`` and ``pagination`` are required.  ``endpoint`` and ``params``
    may be given in the document or as arguments (arguments win).
    """
    d = yaml_document(doc)
    response_path = d.get("responsePath")
    if response_path is None:
        raise ValueError("a dataset needs a responsePath: the key of its records in a response")
    pagination = d.get("pagination")
    if not isinstance(pagination, Mapping) or "enabled" not in pagination:
        raise ValueError("a dataset needs pagination.enabled: true for pages, false for a single request")
    max_pages = pagination.get("maxPages")
    return DatasetSpec(
        source=source,
        name=name or d.get("name"),
        response_path=str(response_path),
        paging=Paging(enabled=bool(pagination.get("enabled")), max_pages=None if max_pages is None else int(max_pages)),
        columns=tuple(d.get("columns") or ()),
        endpoint=endpoint if endpoint is not None else d.get("endpoint", ""),
        params=dict(params if params is not None else d.get("params") or {}),
        enabled=enabled,
    )
