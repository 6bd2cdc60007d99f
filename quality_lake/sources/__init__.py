"""Sources and sinks."""

from .files import read_csv_strict, read_parquet, read_source
from .tables import (
    RUN_RECORD_SCHEMA,
    append_run_record,
    empty_frame,
    file_stats,
    files_under,
    literal_frame,
    read_staged,
    release,
    run_record,
    run_record_frame,
    scratch_path,
    scratch_root,
    stage,
    staging,
    write_table,
)
from .versions import (
    Version,
    current_version,
    expire_versions,
    publish,
    read_table,
    save,
    storage_stats,
    table_versions,
)

__all__ = [
    "RUN_RECORD_SCHEMA", "append_run_record", "empty_frame", "file_stats", "files_under", "literal_frame",
    "read_csv_strict", "read_parquet", "read_source", "read_staged", "read_table", "release",
    "run_record", "run_record_frame", "scratch_path", "scratch_root", "stage", "staging", "write_table",
    "Version", "current_version", "expire_versions", "publish", "save", "storage_stats", "table_versions",
]
