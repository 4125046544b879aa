"""Rows at the lowest or highest value of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_at_extreme(rows: DataFrame, keys: Sequence[str], value: str, how: str = "min") -> DataFrame:
    """All rows holding their group's extreme value, ties kept.

    The extreme is pre-aggregated before the shuffle and joined back on (keys, value), so a
    group of any size is never sorted in one task, and a hot join key can be split.
    """
    pick = F.min if how == "min" else F.max
    extreme = rows.groupBy(*keys).agg(pick(value).alias(value))
    return rows.join(extreme, [*keys, value])


def extreme_row(price: str, sign: int = 1) -> Column:
    """Aggregate picking a group's row with the lowest (sign 1) or highest (sign -1) price.

    Ties go to the latest delivery, then to the smallest province and part number. It is a
    minimum over an ordering struct, so it combines before the shuffle.
    """
    return F.min(F.struct(
        (F.col(price) * F.lit(sign)).alias("rank_price"),
        (-F.unix_micros(F.col("deliver_time").cast("timestamp"))).alias("rank_time"),
        F.col("province"),
        F.col("part_oe"),
        F.col(price).alias("price"),
        F.col("deliver_time"),
    ))


def _one_per_key(rows: DataFrame, keys: Sequence[str], price: str, sign: int) -> DataFrame:
    return rows.groupBy(*keys).agg(extreme_row(price, sign).alias("w")).select(
        *keys, "w.province", "w.part_oe", F.col("w.price").alias(price), "w.deliver_time")


def lowest_per_key(rows: DataFrame, keys: Sequence[str], price: str) -> DataFrame:
    """One row per key: the lowest price."""
    return _one_per_key(rows, keys, price, 1)


def highest_per_key(rows: DataFrame, keys: Sequence[str], price: str) -> DataFrame:
    """One row per key: the highest price."""
    return _one_per_key(rows, keys, price, -1)
