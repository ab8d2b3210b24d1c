from crashlake.sources.csv import CSV_DIALECT, read_csv, read_raw_dataset
from crashlake.sources.tables import file_inventory, read_table, register_lake_tables, register_lake_views

__all__ = ["CSV_DIALECT", "read_csv", "read_raw_dataset", "read_table", "register_lake_views", "register_lake_tables", "file_inventory"]
