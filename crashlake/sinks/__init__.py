from crashlake.sinks.csv import chunk_assign, land_chunked_csv, write_csv
from crashlake.sinks.tables import write_table

__all__ = ["write_table", "write_csv", "land_chunked_csv", "chunk_assign"]
