"""Column expressions; all JVM built-ins, no UDFs."""

from rankspark.functions.dates import DATE_BUCKETS, date_bucket, date_bucket_range
from rankspark.functions.exact import exact_mean, exact_sum
from rankspark.functions.labels import (
    dataset_label,
    fixed,
    genres_label,
    item_label,
    preference_label,
    rating_label,
    recommendation_label,
    thousands,
    year_label,
)
from rankspark.functions.scoring import falsy_default, smoothed_score, title_year
from rankspark.functions.text import contains_any, contains_ci, search_terms

__all__ = [
    "DATE_BUCKETS",
    "contains_any",
    "contains_ci",
    "dataset_label",
    "date_bucket",
    "date_bucket_range",
    "exact_mean",
    "exact_sum",
    "falsy_default",
    "fixed",
    "genres_label",
    "item_label",
    "preference_label",
    "rating_label",
    "recommendation_label",
    "search_terms",
    "smoothed_score",
    "thousands",
    "title_year",
    "year_label",
]
