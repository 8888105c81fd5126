"""Sources and sinks: CSV / Parquet files and JDBC tables."""

from ledgerflow.sources.files import CheckedRead, read_csv, read_csv_checked, read_parquet, string_schema, typed_schema
from ledgerflow.sources.sinks import write_csv, write_parquet
from ledgerflow.sources.jdbc import (
    JdbcConfig,
    jdbc_config_from_env,
    read_jdbc,
    write_jdbc,
    insert_into_jdbc,
    upsert_jdbc,
)

__all__ = [
    "CheckedRead",
    "read_csv",
    "read_csv_checked",
    "read_parquet",
    "string_schema",
    "typed_schema",
    "write_csv",
    "write_parquet",
    "JdbcConfig",
    "jdbc_config_from_env",
    "read_jdbc",
    "write_jdbc",
    "insert_into_jdbc",
    "upsert_jdbc",
]
