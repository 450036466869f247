"""Row filters of the exports; each keeps to what a missing or empty value means there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names

#: What counts as set in a flag column.
TRUE = ("true", "yes", "1")


def not_deleted(df: DataFrame, flag: str = "deleted") -> DataFrame:
    """Rows whose flag is false; an unknown flag leaves a row out."""
    return df.filter(~F.col(flag))


def of_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a table of keys."""
    return df.join(keys.select(key), key, "left_semi")


def in_scope(df: DataFrame, fuel: str = "fuel", scope: str = "LNG") -> DataFrame:
    """Rows of a fuel; an empty fuel is out, a table without the column is in scope as a whole."""
    return df.filter(F.col(fuel) == scope) if fuel in df.columns else df


def is_set(flag: Column) -> Column:
    return F.lower(F.trim(F.coalesce(flag.cast("string"), F.lit("")))).isin(*TRUE)


def of_country(df: DataFrame, country: str, normal: bool, col: str = "country") -> DataFrame:
    """Rows of a country: by its usual name, whatever the spelling, or by the very text."""
    return df.filter(names.country(F.col(col)) == names.country(F.lit(country))) if normal else df.filter(F.col(col) == country)


def without_subtotals(df: DataFrame, notes: str = "notes") -> DataFrame:
    """Report rows but those of a country's subtotal."""
    return df.filter(~F.lower(F.coalesce(notes, F.lit(""))).startswith("country subtotal"))
