from strataflow.sources.files import read_csv, read_parquet, read_tables, row_counts
from strataflow.sources.jdbc import extract_all, jdbc_options, read_jdbc
from strataflow.sources.series import date_series, replicate
from strataflow.sources.streams import arriving_in_lots, read_bus_stream, read_file_stream

__all__ = [
    "arriving_in_lots", "date_series", "extract_all", "jdbc_options", "read_bus_stream", "read_csv", "read_file_stream", "read_jdbc",
    "read_parquet", "read_tables", "replicate", "row_counts",
]
