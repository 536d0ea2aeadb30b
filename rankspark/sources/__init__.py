"""Table readers."""

from rankspark.sources.delimited import accepted, read_items, read_ratings, rejected
from rankspark.sources.jdbc import JdbcTarget, read_jdbc
from rankspark.sources.stored import read_published, read_stored
from rankspark.sources.subset import item_subset, ratings_of

__all__ = [
    "JdbcTarget",
    "accepted",
    "item_subset",
    "ratings_of",
    "read_items",
    "read_jdbc",
    "read_ratings",
    "read_published",
    "read_stored",
    "rejected",
]
