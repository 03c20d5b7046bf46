"""Reading and writing tables."""
from larder.sources.files import (  # noqa: F401
    csv_to_parquet, file_date, ingest_audit, json_to_parquet, read_csv, read_json_records,
    read_parquet, single_file, write_csv, write_json, write_parquet, write_table,
)
from larder.sources.snapshots import read_current, read_snapshots, staged_replace, write_snapshot  # noqa: F401
