from tallyweave.sources.control import clean_control, latest_control
from tallyweave.sources.delimited import (
    drop_empty_rows,
    infer_integers,
    integer_columns,
    kept_order,
    position_columns,
    read_delimited,
    read_with_offset,
    with_source_order,
)
from tallyweave.sources.files import ingest_finals, latest_file, list_files, period_of_name
from tallyweave.sources.sinks import publish, replace_period, table_name, write_csv, write_quality_table
from tallyweave.sources.snapshots import compare_runs, read_snapshots, write_snapshot
from tallyweave.sources.store import Conflict, PeriodStore
from tallyweave.sources.tables import find_period_tables, load_table, read_period

__all__ = [
    "Conflict",
    "PeriodStore",
    "clean_control",
    "compare_runs",
    "drop_empty_rows",
    "find_period_tables",
    "infer_integers",
    "ingest_finals",
    "integer_columns",
    "kept_order",
    "latest_control",
    "latest_file",
    "list_files",
    "load_table",
    "period_of_name",
    "position_columns",
    "publish",
    "read_delimited",
    "read_period",
    "read_snapshots",
    "read_with_offset",
    "replace_period",
    "table_name",
    "with_source_order",
    "write_csv",
    "write_quality_table",
    "write_snapshot",
]
