"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule over training time. Its integral, scaled to the source's target, is the
cumulative token demand; the documents of the source stand on that demand one after the other (in passes, where
the target exceeds the source) and inverting it gives each taken occurrence a training position in [0, 1).
A range sort by position yields the training order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gearledger.llm.common import words_of
from gearledger.session import materialise

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: Slope of each weight's schedule 1 + slope * (2t - 1): heavy sources come early, light ones late.
SLOPES = (0.5, 0.0, -0.5)
MAX_PASSES = 3
#: Hexadecimal digits that cut a source into buckets, so that no window holds all cells of a source.
BUCKET_DIGITS = 3


def _repeating(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), ((rank - 1) % len(values) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, slopes: tuple = SLOPES,
                   max_passes: int = MAX_PASSES) -> DataFrame:
    """One row per source with its size, weight, slope and target.

    Targets share the total by weight and stop at ``max_passes`` times the source's size. The excess goes to the
    others by weight until none is above, so every uncapped source gets ``level * weight``; the level is the largest
    of the levels that follow from capping the first sources in order of size per weight. The windows hold one row
    per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = by_source.withColumn("rank", F.row_number().over(named))
    caps = ranked.select(
        "source", "source_size", _repeating(weights, F.col("rank")).alias("weight"),
        _repeating(slopes, F.col("rank")).alias("slope"), (F.col("source_size") * max_passes).alias("cap"))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    levels = caps.withColumn("level", (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    ) / F.sum("weight").over(after))
    return levels.withColumn("level", F.max("level").over(everything)).select(
        "source", "source_size", "slope",
        F.least(F.col("level") * F.col("weight"), F.col("cap").cast("double")).alias("target"))


def position(share: Column, slope: Column) -> Column:
    """Time at which the integrated schedule t + slope * (t * t - t) reaches the share."""
    root = F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share)
    return F.when(slope == 0, share).otherwise((root - (1 - slope)) / (2 * slope))


def _source_key(source: Column) -> Column:
    """A text for every source, null included, so that joins and windows meet on plain equality."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def place(docs: DataFrame, *carry: str, weights: tuple = WEIGHTS, slopes: tuple = SLOPES,
          max_passes: int = MAX_PASSES) -> DataFrame:
    """Every document with its size, its source's size and target, its place in the source, and its passes.

    ``carry`` names further columns to keep. The order within a source is that of the md5 of id and text. Rows equal in
    source, id and text are one cell, pre-aggregated; offsets come from sums over hash buckets and a window over the
    cells of a bucket, so a source or an id with a third of all rows is spread over many tasks, and no text enters
    a window but those of repeated rows, which are numbered in their cell. A pass takes a document if the middle of its
    words lies before the target. Null sources form one source, null and empty texts have size 0 and are never taken;
    a row without a doc_id stands at its text's place. Repeated rows are documents of their own. An empty table gives
    an empty result.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    sized = docs.select(
        "doc_id", _source_key(F.col("source")).alias("source_key"),
        F.size(words_of("text")).cast("long").alias("size"), F.md5(name.cast("binary")).alias("place_key"),
        *[F.col(c).alias(f"carry_{c}") for c in carry])
    cells = sized.groupBy("source_key", "place_key").agg(
        F.max("size").alias("size"), F.count(F.lit(1)).alias("copies")).select(
        "source_key", "place_key", F.substring("place_key", 1, BUCKET_DIGITS).alias("bucket"),
        (F.col("size") * F.col("copies")).alias("cell_size"))
    sums = cells.groupBy("source_key", "bucket").agg(F.sum("cell_size").alias("size"))
    earlier = (Window.unboundedPreceding, -1)
    order = Window.partitionBy("source_key").orderBy("bucket").rowsBetween(*earlier)
    offsets = sums.select("source_key", "bucket", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("bucket_start"))
    source = F.when(F.col("source_key") != "", F.expr("substring(source_key, 2)"))
    targets = source_targets(sums.select(source.alias("source"), "size"), weights, slopes, max_passes)
    known = offsets.join(targets.select(_source_key(F.col("source")).alias("source_key"), "source_size", "slope", "target"),
                         "source_key")
    inside = Window.partitionBy("source_key", "bucket").orderBy("place_key").rowsBetween(*earlier)
    starts = cells.join(known, ["source_key", "bucket"]).select(
        "source_key", "place_key", "source_size", "slope", "target",
        (F.col("bucket_start") + F.coalesce(F.sum("cell_size").over(inside), F.lit(0))).alias("cell_start"))
    number = F.row_number().over(Window.partitionBy("source_key", "place_key").orderBy("place_key"))
    placed = sized.join(starts, ["source_key", "place_key"]).withColumn(
        "start", F.col("cell_start") + (number - 1) * F.col("size"))
    middle = F.col("start") + F.col("size") / 2
    passes = sum(((middle + k * F.col("source_size")) < F.col("target")).cast("long") for k in range(max_passes))
    return placed.withColumn("passes", F.when(F.col("size") > 0, passes).otherwise(F.lit(0).cast("long")))


def _pass_position(number: Column | int) -> Column:
    share = (F.col("start") + number * F.col("source_size")) / F.col("target")
    return position(F.least(share, F.lit(1.0)), F.col("slope"))


def _in_training_order(placed: DataFrame, *columns: Column) -> DataFrame:
    """One row per taken occurrence: the columns, ``mix_pass``, ``mix_position`` and ``mix_key``, range-sorted by position."""
    spread = placed.where("passes > 0").withColumn(
        "pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes") - 1)))
    out = spread.select(*columns, F.col("pass").alias("mix_pass"), _pass_position(F.col("pass")).alias("mix_position"),
                        F.col("place_key").alias("mix_key"))
    return out.repartitionByRange("mix_position", "mix_key").sortWithinPartitions("mix_position", "mix_key")


def curriculum(docs: DataFrame, **options) -> DataFrame:
    """The taken documents in training order: the columns of docs, ``mix_pass`` (from 0) and ``mix_position``.

    Columns of docs with these names are replaced. A document stands once for each pass that takes it. Rows are
    range-partitioned and sorted by position, so files written from the result are in training order.
    """
    columns = [c for c in docs.columns if c not in ("mix_pass", "mix_position")]
    placed = place(docs, *columns, **options)
    return _in_training_order(placed, *[F.col(f"carry_{c}").alias(c) for c in columns]).drop("mix_key")


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken words, and the step (millionths) of its first position.

    The taken occurrences are written in training order, without their texts, and what is taken of a document is read
    from there: the words of its occurrences, and the first of their positions. A taken document has words, so its
    source and its start there name it, repeated rows too.
    """
    placed = materialise(place(docs, **options), "mix-places")
    ordered = materialise(
        _in_training_order(placed, F.col("source_key"), F.col("start"), F.col("size")), "mix-order")
    taken = ordered.groupBy("source_key", "start").agg(
        F.sum("size").alias("taken"), F.floor(F.min("mix_position") * 1_000_000).cast("long").alias("first_step"))
    own = F.when(F.col("size") > 0, F.col("start"))
    found = placed.withColumn("start", own).join(taken, ["source_key", "start"], "left")
    return found.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"),
                        "first_step")
