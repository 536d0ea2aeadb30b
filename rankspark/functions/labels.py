"""Display values: fixed-point numbers, fallbacks and row labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def fixed(value: Column, digits: int) -> Column:
    """Text with a fixed number of decimals; exact ties go to the even digit."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", value, F.lit(pattern))


def thousands(value: Column) -> Column:
    """Whole number with a comma every three digits."""
    return F.format_number(value, 0)


# The display texts in the functions below.


def genres_label(genres: Column, missing: str = "Unknown") -> Column:
    return F.coalesce(F.nullif(genres, F.lit("")), F.lit(missing))


def year_label(year: Column) -> Column:
    known = F.nullif(year, F.lit(0))
    return F.coalesce(F.concat(F.lit("Year: "), known.cast("string")), F.lit("Year unknown"))


def item_label(title: Column, mean: Column) -> Column:
    return F.concat(title, F.lit(" ("), fixed(mean, 2), F.lit(")"))


def rating_label(user_id: Column, title: Column, rating: Column) -> Column:
    return F.concat(
        F.lit("User "), user_id.cast("string"), F.lit(" rated "), title,
        F.lit(": "), rating.cast("string"),
    )


def recommendation_label(title: Column, score: Column) -> Column:
    return F.concat(title, F.lit(" (Score: "), fixed(score, 2), F.lit(")"))


def dataset_label(data_file: Column, processed: Column) -> Column:
    state = F.when(processed, F.lit("Processed")).otherwise(F.lit("Pending"))
    return F.concat(data_file, F.lit(" - "), state)


def preference_label(user: Column) -> Column:
    return F.concat(user, F.lit("'s preferences"))
