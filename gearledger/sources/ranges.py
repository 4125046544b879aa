"""Parallel reads by ranges of a key that hold about equally many rows, and key bounds from file footers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Relative accuracy of the quantile sketch, as parts of the whole.
ACCURACY = 10_000


def balanced_cuts(keys: DataFrame, column: str, parts: int) -> list[int]:
    """Inner bounds of so many ranges with about equally many rows each, from a quantile sketch of the key.

    An even stride over the key's span puts most rows into one range where most keys lie close together. The sketch is
    merged from partial ones, so only the bounds reach the driver. Equal bounds count once; without keys there are none.
    """
    shares = [F.lit(n / parts) for n in range(1, parts)]
    if not shares:
        return []
    found = keys.agg(F.percentile_approx(column, F.array(*shares), F.lit(ACCURACY)).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def range_predicates(column: str, cuts: Sequence[int]) -> list[str]:
    """Conditions that hold every row once; a null key falls into the first."""
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {cuts[0]} OR {column} IS NULL"
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [first, *inner, f"{column} >= {cuts[-1]}"]


def read_by_ranges(table: DataFrame, column: str, parts: int) -> DataFrame:
    """The rows of a table read range by range, each with its condition pushed to the scan."""
    predicates = range_predicates(column, balanced_cuts(table.select(column), column, parts))
    return reduce(DataFrame.unionByName, [table.where(p) for p in predicates])


def footer_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Rows of a Parquet table, and the lowest and highest value of integer or date columns, from the file footers.

    The columnar reader answers counts and bounds from the footers' statistics. That reader is switched on in a session
    of its own, so the caller's session keeps its settings. Every row group needs a value in each column, as one of nulls
    only has no bounds and ends the job; ``lookups.id_bounds`` reads the rows instead.
    """
    side = spark.newSession()
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    bounds = [pick(c).alias(f"{name}_{c}") for c in columns for name, pick in (("min", F.min), ("max", F.max))]
    return side.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), *bounds)
