"""Scans and sinks (the only modules, with ``plans``, that touch storage)."""

from ratelake.sources.feeds import (
    compact_date_partition_parts,
    drop_bad_rows,
    read_delimited_feed,
    rename_columns,
    schema_from_json,
)
from ratelake.sources.parquet import read_parquet, strings_for_binary
from ratelake.sources.sinks import (
    materialize,
    save_as_table,
    staged_overwrite,
    write_parquet,
    write_csv,
    written_rows,
)

__all__ = [
    "compact_date_partition_parts",
    "drop_bad_rows",
    "materialize",
    "read_delimited_feed",
    "read_parquet",
    "rename_columns",
    "save_as_table",
    "schema_from_json",
    "staged_overwrite",
    "strings_for_binary",
    "write_parquet",
    "write_csv",
    "written_rows",
]
