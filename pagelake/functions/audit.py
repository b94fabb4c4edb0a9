"""Audit columns: a SHA-256 row hash and a processing timestamp.

``_rowHash`` is ``sha2(concat_ws("||", every column in order), 256)`` over the
columns present *before* the audit columns are set.  ``concat_ws`` skips nulls,
so ``('x', null, 'y')`` and ``('x', 'y', null)`` hash alike, and an all-null row
hashes to SHA-256 of the empty string.  Struct, map and array-of-struct columns
are hashed through their JSON text.

Both audit columns are added-or-replaced: a column of that name that is already
in the frame keeps its position, otherwise the column is appended.
Everything stays in JVM expressions (whole-stage codegen, no Python UDF).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values (column names and hash format of the audit contract) ---
ROW_HASH = "_rowHash"
PROCESSED_TIMESTAMP = "_processedTimestamp"
HASH_SEPARATOR = "||"
HASH_BITS = 256
# --- end of fixed values ---

_FLAT = (T.StringType, T.NumericType, T.BooleanType, T.DatetimeType, T.BinaryType)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _hash_input(df: DataFrame, name: str) -> Column:
    col = _quoted(name)
    dtype = df.schema[name].dataType
    if isinstance(dtype, _FLAT):
        return col
    if isinstance(dtype, T.ArrayType) and isinstance(dtype.elementType, _FLAT):
        return col.cast(T.ArrayType(T.StringType()))
    return F.to_json(col)


def row_hash(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """SHA-256 hex of the ``||``-joined values of ``columns`` (default: all, in order)."""
    names = list(df.columns if columns is None else columns)
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *[_hash_input(df, c) for c in names]), HASH_BITS)


def with_row_hash(df: DataFrame, name: str = ROW_HASH) -> DataFrame:
    return df.withColumns({name: row_hash(df)})


def with_processed_timestamp(df: DataFrame, name: str = PROCESSED_TIMESTAMP) -> DataFrame:
    """``current_timestamp()``: one value per query, a new one per action - write once, then read."""
    return df.withColumns({name: F.current_timestamp()})


def with_audit_columns(df: DataFrame) -> DataFrame:
    """Row hash over the incoming columns, then the processing timestamp (not hashed)."""
    return df.withColumns({ROW_HASH: row_hash(df)}).withColumns({PROCESSED_TIMESTAMP: F.current_timestamp()})
