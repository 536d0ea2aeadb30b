"""Table writers."""

from rankspark.sinks.delimited import write_items_csv, write_ratings_csv
from rankspark.sinks.jdbc import clear_tables
from rankspark.sinks.stored import write_stored

__all__ = [
    "clear_tables",
    "write_items_csv",
    "write_ratings_csv",
    "write_stored",
]
