"""Column-level functions: declared schemas and audit columns."""

from pagelake.functions.audit import (
    PROCESSED_TIMESTAMP,
    ROW_HASH,
    row_hash,
    with_audit_columns,
    with_processed_timestamp,
    with_row_hash,
)
from pagelake.functions.schema import DatasetSpec, Paging, column_type, dataset_spec, struct_type

__all__ = [
    "PROCESSED_TIMESTAMP",
    "ROW_HASH",
    "DatasetSpec",
    "Paging",
    "column_type",
    "dataset_spec",
    "row_hash",
    "struct_type",
    "with_audit_columns",
    "with_processed_timestamp",
    "with_row_hash",
]
