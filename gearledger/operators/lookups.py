"""Scalar probes and code lookups as joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def id_bounds(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(F.min(column).alias("lower_bound"), F.max(column).alias("upper_bound"))


def distinct_codes(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(column).distinct()


def join_folded(rows: DataFrame, folded: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join rows to a table that was aggregated on exactly these keys.

    A shuffled join would reuse the aggregation's partitioning, and adaptive execution splits a
    hot key only where both sides come straight from an exchange. The hash of the keys as one
    more equal column gives the folded side an exchange of its own.
    """
    key_hash = F.xxhash64(*keys)
    return rows.withColumn("key_hash", key_hash).join(
        folded.withColumn("key_hash", key_hash), [*keys, "key_hash"], how).drop("key_hash")


def lookup(
    rows: DataFrame, dimension: DataFrame, key: str, code: str, value: str, out: str,
    default: str | None = "",
) -> DataFrame:
    """Add ``out``: the dimension's value for the row's key, or the default where none is found.

    One join for all rows. The dimension is reduced to one row per code first, so it never
    multiplies rows.
    """
    names = dimension.groupBy(F.col(code).alias("lookup_code")).agg(F.min(value).alias("lookup_value"))
    found = join_folded(rows.withColumn("lookup_code", F.col(key)), names, ["lookup_code"])
    result = F.col("lookup_value") if default is None else F.coalesce("lookup_value", F.lit(default))
    return found.withColumn(out, result).drop("lookup_code", "lookup_value")


def join_inner_dim(rows: DataFrame, dimension: DataFrame, key: str, code: str) -> DataFrame:
    """Rows with their dimension columns; rows without a match are dropped."""
    return rows.join(dimension, F.col(key) == F.col(code), "inner")


def join_left_dim(rows: DataFrame, dimension: DataFrame, key: str, code: str) -> DataFrame:
    return rows.join(dimension, F.col(key) == F.col(code), "left")
