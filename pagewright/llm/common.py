"""What several operators share: the word pattern, shared-folder tables and literal tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pagewright.functions.tables import materialise, release

__all__ = ["NOT_WORD", "WORD", "bind", "lower_ascii", "materialise", "read", "release", "words"]

#: Words of every contract in this package: runs of anything but space and \t\n\v\f\r.
WORD = r"[^\x20\x09-\x0D]+"
NOT_WORD = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def words(text: Column) -> Column:
    """Array of the words of text; null and empty give an empty array."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bind(value: Column, body) -> Column:
    """body(value) with value computed once per row, however often body uses it."""
    return F.transform(F.array(value), body)[0]
