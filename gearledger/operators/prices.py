"""Price history: lowest, highest and running average price merged into stored prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.functions import predicates as P
from gearledger.functions.calendar import DateLike, between_days, day, days_before, same_day_last_year
from gearledger.functions.money import round2
from gearledger.functions.text import clean_part_number, pid
from gearledger.operators.extremes import extreme_row, highest_per_key, lowest_per_key
from gearledger.operators.lookups import join_folded, lookup
from gearledger.operators.merge import update_columns

KEYS = ["car_brand", "temp_oe", "quality_type"]
# Fixed value: days after which a stored lowest or highest price expires.
EXPIRY_DAYS = 90


def price_pid() -> Column:
    return pid(*[F.col(k) for k in KEYS]).alias("pid")


def with_brand_code(rows: DataFrame, brand_map: DataFrame) -> DataFrame:
    """Rows with the standard code of their brand as ``brand_code``; null for a brand the map lacks."""
    return lookup(
        rows, brand_map, "car_brand", "standard_brand_name", "standard_brand_code", "brand_code", default=None)


def with_history(batch: DataFrame, history: DataFrame) -> DataFrame:
    """Batch rows with the stored row of their key beside them, in columns named ``old_*``."""
    old = history.select(*KEYS, *[F.col(c).alias(f"old_{c}") for c in history.columns if c not in KEYS])
    return batch.join(old, KEYS, "left")


def _merge_price(
    winners: DataFrame, history: DataFrame, names: tuple[str, str, str], better: Column, expired: Column
) -> DataFrame:
    """Take the batch value of each column where the stored one is missing, beaten or expired."""
    batch = winners.select(
        *KEYS, F.col("part_oe").alias("oe"), F.col("sale_price").alias("new_price"),
        F.col("province").alias("new_province"), F.col("deliver_time").alias("new_time"))
    take = F.coalesce(better, F.lit(False)) | F.coalesce(expired, F.lit(False))
    merged = [
        F.when(F.col(f"old_{c}").isNull() | take, F.col(new)).otherwise(F.col(f"old_{c}")).alias(c)
        for c, new in zip(names, ("new_price", "new_province", "new_time"))
    ]
    return with_history(batch, history).select(price_pid(), *KEYS, "oe", *merged)


def price_min_merge(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Lowest price per key: the stored one stays unless the batch is lower, or the stored one
    is more than 90 days older than the batch price. For a one-day batch that age counts from
    the business day."""
    return _merge_price(
        lowest_per_key(batch, KEYS, "sale_price"), history,
        ("min_sale_price", "min_sale_province", "min_sale_deliver_time"),
        better=F.col("old_min_sale_price") > F.col("new_price"),
        expired=F.col("old_min_sale_deliver_time") < days_before(F.col("new_time"), EXPIRY_DAYS))


def price_max_merge(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Highest price per key; an equal price refreshes the stored one."""
    return _merge_price(
        highest_per_key(batch, KEYS, "sale_price"), history,
        ("max_sale_price", "max_sale_province", "max_sale_deliver_time"),
        better=F.col("old_max_sale_price") <= F.col("new_price"),
        expired=F.col("old_max_sale_deliver_time") < days_before(F.col("new_time"), EXPIRY_DAYS))


def price_floor_merge(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Lowest traded price with a one-year expiry; stored rows without a day are ignored."""
    return _merge_price(
        lowest_per_key(batch, KEYS, "sale_price"), history.where(F.col("deliver_time").isNotNull()),
        ("sale_price", "sale_province", "deliver_time"),
        better=F.col("old_sale_price") > F.col("new_price"),
        expired=F.col("old_deliver_time") < same_day_last_year(F.col("new_time")))


def price_avg_merge(history: DataFrame, batch: DataFrame) -> DataFrame:
    """Running mean of all sales of a key, and their number."""
    sums = batch.groupBy(*KEYS).agg(
        F.min("part_oe").alias("oe"),
        F.sum("sale_price").cast("double").alias("batch_sum"),
        F.count(F.lit(1)).alias("batch_n"))
    old_avg, old_n = F.col("old_avg_sale_price").cast("double"), F.col("old_sale_times")
    running = (old_avg * old_n + F.col("batch_sum")) / (old_n + F.col("batch_n"))
    return with_history(sums, history).select(
        price_pid(), *KEYS, "oe",
        round2(F.when(old_avg.isNull(), F.col("batch_sum") / F.col("batch_n")).otherwise(running))
        .alias("avg_sale_price"),
        F.when(old_n.isNull(), F.col("batch_n")).otherwise(old_n + F.col("batch_n")).alias("sale_times"),
    )


def price_history(rows: DataFrame) -> DataFrame:
    """History table built from price rows in one aggregation: lowest, highest, average and
    count per key."""
    folded = rows.groupBy(*KEYS).agg(
        extreme_row("sale_price", 1).alias("low"),
        extreme_row("sale_price", -1).alias("high"),
        F.sum("sale_price").cast("double").alias("price_sum"),
        F.count(F.lit(1)).alias("sale_times"))
    return folded.select(
        *KEYS, F.col("low.part_oe").alias("oe"),
        F.col("low.price").alias("min_sale_price"), F.col("low.province").alias("min_sale_province"),
        F.col("low.deliver_time").alias("min_sale_deliver_time"),
        F.col("high.price").alias("max_sale_price"), F.col("high.province").alias("max_sale_province"),
        F.col("high.deliver_time").alias("max_sale_deliver_time"),
        round2(F.col("price_sum") / F.col("sale_times")).alias("avg_sale_price"), "sale_times")


def day_sums(rows: DataFrame) -> DataFrame:
    """Ledger rows: sum and number of the sales of each key and day, from which the running average is folded."""
    return rows.groupBy(*KEYS, "deliver_time").agg(
        F.sum("sale_price").cast("decimal(28,2)").alias("price_sum"), F.count(F.lit(1)).alias("sale_times"))


def replace_days(ledger: DataFrame, sums: DataFrame, start: DateLike | None, end: DateLike | None) -> DataFrame:
    """The ledger with the rows of the days from start to end replaced by those of a batch that stands for these days.

    A batch that comes again, whole or corrected, replaces what it gave before instead of adding to it; a day without
    sales in the new batch is emptied. It is a filter and a union, so nothing is shuffled.
    """
    days = between_days(F.col("deliver_time"), start, end)
    return ledger.where(~days).unionByName(sums.where(days))


def close_days(ledger: DataFrame, until: DateLike) -> DataFrame:
    """The ledger with all days until one folded into that day, one row per key. Closed days cannot be replaced singly."""
    closed = ledger.where(F.col("deliver_time") <= day(until)).groupBy(*KEYS).agg(
        F.sum("price_sum").cast("decimal(28,2)").alias("price_sum"), F.sum("sale_times").alias("sale_times"))
    return ledger.where(F.col("deliver_time") > day(until)).unionByName(
        closed.withColumn("deliver_time", day(until)))


def average_of_ledger(ledger: DataFrame) -> DataFrame:
    """Mean price and number of all sales of each key."""
    return ledger.groupBy(*KEYS).agg(
        round2(F.sum("price_sum").cast("double") / F.sum("sale_times")).alias("avg_sale_price"),
        F.sum("sale_times").alias("sale_times"))


#: Columns of the lowest and of the highest price in the history.
LOW = ("min_sale_price", "min_sale_province", "min_sale_deliver_time")
HIGH = ("max_sale_price", "max_sale_province", "max_sale_deliver_time")


def _beside(history: DataFrame, new: DataFrame, brand_map: DataFrame) -> DataFrame:
    """History and the figures of a batch (``new_*``) with its brand codes in one full join on the keys."""
    coded = with_brand_code(new, brand_map)
    renamed = coded.select(*KEYS, *[F.col(c).alias(f"new_{c}") for c in coded.columns if c not in KEYS],
                           F.lit(True).alias("in_batch"))
    return history.join(renamed, KEYS, "full_outer")


def _kept() -> list[Column | str]:
    code = F.when(F.col("in_batch"), F.col("new_brand_code")).otherwise(F.col("brand_code"))
    return [*KEYS, code.alias("brand_code"), F.coalesce("oe", "new_oe").alias("oe")]


def _taken(names: tuple[str, str, str], better: Column) -> list[Column]:
    """The batch's value of each column where the stored one is missing, beaten or expired."""
    expired = F.col(names[2]) < days_before(F.col(f"new_{names[2]}"), EXPIRY_DAYS)
    take = F.coalesce(better, F.lit(False)) | F.coalesce(expired, F.lit(False))
    return [F.when(F.col("in_batch") & (F.col(c).isNull() | take), F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
            for c in names]


def low_snapshot(history: DataFrame, batch: DataFrame, brand_map: DataFrame) -> DataFrame:
    """The history with the lowest prices of a batch merged in, in one join on the keys; its other columns stay.

    A history stored in buckets of the keys is not shuffled: only the aggregated batch moves.
    """
    low = lowest_per_key(batch, KEYS, "sale_price").select(
        *KEYS, F.col("part_oe").alias("oe"), F.col("sale_price").alias(LOW[0]), F.col("province").alias(LOW[1]),
        F.col("deliver_time").alias(LOW[2]))
    joined = _beside(history, low, brand_map)
    rest = [c for c in history.columns if c not in (*KEYS, "brand_code", "oe", *LOW)]
    merged = joined.select(*_kept(), *_taken(LOW, F.col(LOW[0]) > F.col(f"new_{LOW[0]}")), *rest)
    return merged.select(*history.columns)


def price_snapshot(history: DataFrame, batch: DataFrame, ledger: DataFrame, brand_map: DataFrame) -> DataFrame:
    """The history after a batch: one aggregation of the batch, one join with the history, and the ledger's averages.

    Lowest and highest prices follow the rules of ``price_min_merge`` and ``price_max_merge``; keys outside of the batch
    keep theirs. Averages and sale counts are those of the ledger, which holds the batch already, so merging the same
    batch again changes nothing. A brand code is looked up for the keys of the batch.
    """
    new = price_history(batch).select(*KEYS, "oe", *LOW, *HIGH)
    joined = _beside(history.drop("avg_sale_price", "sale_times"), new, brand_map)
    merged = joined.select(*_kept(), *_taken(LOW, F.col(LOW[0]) > F.col(f"new_{LOW[0]}")),
                           *_taken(HIGH, F.col(HIGH[0]) <= F.col(f"new_{HIGH[0]}")))
    return merged.join(average_of_ledger(ledger), KEYS, "left").select(
        *KEYS, "brand_code", "oe", *LOW, *HIGH, "avg_sale_price", "sale_times")


def order_item_enriched(rows: DataFrame, brand_map: DataFrame, list_prices: DataFrame) -> DataFrame:
    """Clean price rows with the brand code and the list price of the part."""
    coded = lookup(
        rows, brand_map, "car_brand", "standard_brand_name", "standard_brand_code",
        "standard_brand_code", default=None)
    return join_folded(coded, list_prices, ["standard_brand_code", "temp_oe"])


def local_price_match(local: DataFrame, prices: DataFrame, provinces: DataFrame) -> DataFrame:
    """Local list with the lowest traded original and aftermarket price and where it was paid.

    ``prices`` is the stored floor history with its brand codes. It is first folded to one row per
    brand code and part number, so the list is joined once. Rows without either price are left out.
    """
    def lowest(quality: str) -> Column:
        return F.min(F.when(F.col("quality_type") == quality, F.struct("sale_price", "sale_province")))

    folded = (
        prices.where(F.col("quality_type").isin(P.OEM_QUALITY, P.AFTERMARKET_QUALITY))
        .groupBy(F.col("brand_code").alias("standard_brand_code"), "temp_oe")
        .agg(lowest(P.OEM_QUALITY).alias("oem"), lowest(P.AFTERMARKET_QUALITY).alias("afm"))
        .select(
            "standard_brand_code", "temp_oe",
            F.coalesce("oem.sale_price", F.lit(0)).cast("decimal(11,2)").alias("oem_sale_price"),
            F.col("oem.sale_province").alias("oem_province"),
            F.coalesce("afm.sale_price", F.lit(0)).cast("decimal(11,2)").alias("afm_sale_price"),
            F.col("afm.sale_province").alias("afm_province"))
        .where((F.col("oem_sale_price") != 0) | (F.col("afm_sale_price") != 0))
    )
    cleaned = local.withColumn("temp_oe", clean_part_number(F.col("oe")))
    matched = join_folded(cleaned, folded, ["standard_brand_code", "temp_oe"], "inner")
    for side in ("oem", "afm"):
        matched = lookup(
            matched, provinces, f"{side}_province", "province_code", "province_chn", f"{side}_sale_province_name")
    return matched.select(
        "id", "oem_sale_price", "oem_sale_province_name", "afm_sale_price", "afm_sale_province_name")


def local_price_update(local: DataFrame, matched: DataFrame) -> DataFrame:
    """The local list with the matched prices and provinces written to its ``min_*`` columns.

    Those are added empty where the list lacks them; rows without a match keep what they hold.
    """
    sides = [f"{s}_{k}" for s in ("oem", "afm") for k in ("price", "province")]
    for side in sides:
        if f"min_{side}" not in local.columns:
            kind = "decimal(11,2)" if side.endswith("price") else "string"
            local = local.withColumn(f"min_{side}", F.lit(None).cast(kind))
    changes = matched.select(
        "id", F.col("oem_sale_price").alias("min_oem_price"), F.col("oem_sale_province_name").alias("min_oem_province"),
        F.col("afm_sale_price").alias("min_afm_price"), F.col("afm_sale_province_name").alias("min_afm_province"))
    return update_columns(local, changes, ["id"], [f"min_{side}" for side in sides])
