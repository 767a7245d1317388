"""Sources and sinks: CSV / Parquet files, catalog tables, paths, fixtures."""

from aerolap.sources.files import (
    materialise,
    read_csv,
    read_declared,
    read_flights,
    read_raw_csv,
    with_source_rows,
    write_csv,
    write_parquet,
)
from aerolap.sources.fixtures import raw_flights
from aerolap.sources.infer import infer_csv_schema, read_csv_inferred
from aerolap.sources.lines import read_raw_csv_lines
from aerolap.sources.paths import Layout, dataset_path, size_label
from aerolap.sources.publish import recover, replace, replace_partitions
from aerolap.sources.tables import (
    declare_table,
    drop_table,
    ensure_database,
    insert_overwrite,
    save_table,
)

__all__ = [
    "Layout",
    "dataset_path",
    "declare_table",
    "drop_table",
    "ensure_database",
    "infer_csv_schema",
    "insert_overwrite",
    "materialise",
    "raw_flights",
    "read_csv",
    "read_csv_inferred",
    "read_declared",
    "read_flights",
    "read_raw_csv",
    "read_raw_csv_lines",
    "recover",
    "replace",
    "replace_partitions",
    "save_table",
    "size_label",
    "with_source_rows",
    "write_csv",
    "write_parquet",
]
