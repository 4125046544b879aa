"""Signed netting of dated order events, and full-outer merging of keyed totals."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.functions.calendar import DateLike, between_days
from gearledger.functions.money import zero_if_null


def event_rows(
    orders: DataFrame, bases: Mapping[str, str], start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """One row per order and dated event: ``basis`` names the event, ``stat_date`` its day.

    All event kinds come from a single pass over the orders, so that one aggregation can net
    them against each other without a join.
    """
    in_range = {b: F.col(c).isNotNull() & between_days(F.col(c), start, end) for b, c in bases.items()}
    events = F.array(*[
        F.struct(F.lit(b).alias("basis"), F.when(in_range[b], F.col(c)).alias("stat_date"))
        for b, c in bases.items()
    ])
    return (
        orders.where(reduce(lambda a, b: a | b, in_range.values()))
        .withColumn("event", F.explode(events))
        .select("*", "event.basis", "event.stat_date")
        .drop("event")
        .where(F.col("stat_date").isNotNull())
    )


def open_key_side(keys: Iterable[str], side: Column) -> Column:
    """Extra group key that keeps the sides apart where a key is null.

    Totals of different sides meet by key equality, and a null key equals nothing; without
    this the single aggregation would merge them.
    """
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return F.when(any_null, side)


def full_outer_merge(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One row per key over all frames, with zeros where a frame has no such key.

    Every frame must be unique on the keys (they are group-by results).
    """
    merged = reduce(lambda a, b: a.join(b, list(keys), "full_outer"), frames)
    types = dict(merged.dtypes)
    measures = [c for c in merged.columns if c not in keys]
    return merged.select(*keys, *[F.coalesce(c, F.lit(0).cast(types[c])).alias(c) for c in measures])


def net_full_outer(forward: DataFrame, backward: DataFrame, keys: Sequence[str]) -> DataFrame:
    """forward - backward for every shared measure, over the keys of both sides."""
    measures = [c for c in forward.columns if c not in keys]
    returned = backward.select(*keys, *[F.col(c).alias(f"returned_{c}") for c in measures])
    joined = forward.join(returned, list(keys), "full_outer")
    net = [(zero_if_null(c) - zero_if_null(f"returned_{c}")).cast("decimal(28,2)").alias(c) for c in measures]
    return joined.select(*keys, *net)
