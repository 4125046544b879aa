"""Keyed table merges: a snapshot and a set of changes in, a new snapshot out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.operators.lookups import join_folded


def one_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by its other columns, so that reruns agree. Duplicates
    collapse before the shuffle."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    picked = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"row.{c}") for c in rows.columns])


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], update_columns: Sequence[str],
    unique: bool = False, audit: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys, and overwrite the chosen columns of existing ones.

    Columns outside ``update_columns`` keep the target's value. ``audit`` sets columns of every
    inserted or updated row, such as an update time. Pass ``unique`` when the updates are
    unique on the keys by construction.
    """
    if not unique:
        updates = one_per_key(updates, keys)
    fresh = updates.select(
        *keys, *[F.col(c).alias(f"new_{c}") for c in updates.columns if c not in keys],
        F.lit(True).alias("in_updates"))
    old = target.withColumn("in_target", F.lit(True))
    joined = old.join(fresh, list(keys), "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif audit and c in audit:
            out.append(F.when(F.col("in_updates"), audit[c]).otherwise(F.col(c)).alias(c))
        elif c not in updates.columns:
            out.append(F.col(c))
        elif c in update_columns:
            out.append(F.when(F.col("in_updates"), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("in_target"), F.col(c)).otherwise(F.col(f"new_{c}")).alias(c))
    return joined.select(*out)


def insert_if_absent(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], unique: bool = False,
    audit: Mapping[str, Column] | None = None, small_batch: bool = False,
) -> DataFrame:
    """Add the rows whose key the target does not hold; existing rows stay as they are.

    ``audit`` sets columns of the added rows, such as an insert time. With ``small_batch`` the target's keys first meet
    those of the updates in a semi join. Spark then puts a Bloom filter of the updates' keys on the scan of the target
    if the join shuffles, the target's files are over, and the filtered updates' files under, the sizes that
    ``spark.sql.optimizer.runtime.bloomFilter.*`` names; its bits are bounded there too. So of a large standing table
    only keys that may stand in the batch are shuffled. The result is the same either way.
    """
    batch_keys = updates.select(*keys)
    if not unique:
        updates = one_per_key(updates, keys)
    if audit:
        types = dict(target.dtypes)
        updates = updates.withColumns({c: value.cast(types[c]) for c, value in audit.items()})
    held = target.select(*keys)
    if small_batch:
        held = held.join(batch_keys, list(keys), "left_semi")
    present = held.distinct()  # a key held by very many rows is one row here
    added = updates.join(present, list(keys), "left_anti")
    return target.unionByName(added.select(*target.columns))


def replace_groups(target: DataFrame, updates: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The updates take the place of the target rows of their groups, such as their days; other groups stay.

    Rerunning with the same updates changes nothing, also where keys inside a group are null.
    """
    held = updates.select(*columns).distinct()
    return target.join(held, list(columns), "left_anti").unionByName(updates)


def update_columns(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str],
    where: Column | None = None, unique: bool = False, audit: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Overwrite columns of the target rows that match a key and satisfy ``where``.

    No rows are added. Matched rows take the new value even when it is null. ``audit`` sets further columns of the
    matched rows, such as an update time.
    """
    if not unique:
        updates = one_per_key(updates.select(*keys, *columns), keys)
    new = updates.select(*keys, *[F.col(c).alias(f"new_{c}") for c in columns], F.lit(True).alias("hit"))
    hit = F.coalesce(F.col("hit"), F.lit(False))
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    types = dict(target.dtypes)
    joined = join_folded(target, new, keys)
    values = {c: F.col(f"new_{c}") for c in columns} | dict(audit or {})
    return joined.select(*[
        F.when(hit, values[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in target.columns
    ])
