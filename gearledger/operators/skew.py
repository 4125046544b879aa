"""Two-phase counting of groups whose sizes differ widely."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: number of salts.
SALT_BUCKETS = 10


def salted_count(
    rows: DataFrame, keys: Sequence[str], salt_by: Sequence[str], out: str, buckets: int = SALT_BUCKETS
) -> DataFrame:
    """Rows per key, counted per (key, salt) first.

    The salt is a hash of ``salt_by``, so a rerun of a lost task gives the same groups. Rows
    with a null or empty key are left out; keys stay columns and are never joined to a text.
    """
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull() & (F.col(k) != "")
    salted = rows.where(complete).select(
        *keys, F.pmod(F.xxhash64(*salt_by), F.lit(buckets)).alias("salt"))
    partial = salted.groupBy(*keys, "salt").agg(F.count(F.lit(1)).alias("part_count"))
    return partial.groupBy(*keys).agg(F.sum("part_count").alias(out))
