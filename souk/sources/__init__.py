"""Sources and sinks."""

from .fixture import transactions_raw
from .io import (
    clustered_for_write,
    malformed_rows,
    read_table,
    read_transactions,
    write_silver,
    write_small_csv,
    write_table,
)

__all__ = [
    "clustered_for_write",
    "malformed_rows",
    "read_table",
    "read_transactions",
    "transactions_raw",
    "write_silver",
    "write_small_csv",
    "write_table",
]
