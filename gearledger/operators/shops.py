"""Repeat-purchase shops.

A shop is in the base of a month when it had an order of at least ``price`` earlier in the
year (for January: in January itself). It repeats when it also has one in that month.

The orders of a shop and year collapse to twelve month bits in one pre-aggregated group-by;
base and repeat months are read off the bits, so no self join and no distinct is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.functions import predicates as P
from gearledger.functions.calendar import DateLike, between_days, day
from gearledger.operators.netting import full_outer_merge

MONTH_KEYS = ["year", "month"]
# Fixed value: lowest order amount that counts.
LOWEST_ORDER = 500
BASE_TYPE, REPEAT_TYPE = "2", "1"


def shop_years(
    orders: DataFrame, users: DataFrame, price: float = LOWEST_ORDER, until: DateLike | None = None
) -> DataFrame:
    """Per shop and year: its profile, the first active month and a bit per active month."""
    active = orders.where(
        P.is_b2b() & P.picc() & F.col("deliver_date").isNotNull()
        & between_days(F.col("deliver_date"), None, until)
        & (F.col("order_amount") >= price)
    ).select("repair_id", F.year("deliver_date").alias("year"), F.month("deliver_date").alias("m"))
    bits = active.groupBy("repair_id", "year").agg(
        F.min("m").alias("first_month"), F.expr("bit_or(shiftleft(1, m))").alias("months"))
    profile = users.select(
        "user_id", F.col("company_name").alias("shop_name"), F.col("provinceCode").alias("province"),
        F.col("cityCode").alias("city"))
    return bits.join(profile, F.col("repair_id") == F.col("user_id")).select(
        F.col("repair_id").alias("shop_id"), "shop_name", "province", "city", "year", "first_month", "months")


def _in_base(month: Column) -> Column:
    first = F.col("first_month")
    return (month > first) | ((month == 1) & (first == 1))


def _months_where(years: DataFrame, condition, until: DateLike | None) -> DataFrame:
    months = F.filter(F.sequence(F.lit(1), F.lit(12)), condition)
    rows = years.withColumn("month", F.explode(months))
    if until is not None:
        rows = rows.where(F.make_date("year", "month", F.lit(1)) <= day(until))
    return rows.select("shop_id", "shop_name", "province", "city", *MONTH_KEYS)


def base_shops(years: DataFrame, until: DateLike | None = None) -> DataFrame:
    """Shops in the base of each month."""
    return _months_where(years, _in_base, until)


def repeat_shops(years: DataFrame, until: DateLike | None = None) -> DataFrame:
    """Base shops that ordered again in the month."""
    def repeats(month: Column) -> Column:
        return _in_base(month) & (F.col("months").bitwiseAND(F.pow(F.lit(2), month).cast("int")) != 0)
    return _months_where(years, repeats, until)


def repeat_base_shops(
    orders: DataFrame, users: DataFrame, price: float = LOWEST_ORDER, until: DateLike | None = None
) -> DataFrame:
    return base_shops(shop_years(orders, users, price, until), until)


def repeat_shops_this_month(
    orders: DataFrame, users: DataFrame, price: float = LOWEST_ORDER, until: DateLike | None = None
) -> DataFrame:
    return repeat_shops(shop_years(orders, users, price, until), until)


def shops_by_city(shops: DataFrame) -> DataFrame:
    """Shops per month, province and city. The shop rows are distinct, so a count is enough."""
    return shops.groupBy(*MONTH_KEYS, "province", "city").agg(F.count("shop_id").alias("no_shop"))


def shops_by_province(shops: DataFrame) -> DataFrame:
    return shops.groupBy(*MONTH_KEYS, "province").agg(F.count("shop_id").alias("no_shop"))


def active_shops(years: DataFrame, until: DateLike | None = None) -> DataFrame:
    """Base and repeat counts per month and province."""
    previous = shops_by_province(base_shops(years, until)).withColumnRenamed("no_shop", "previous_repeat_shop")
    current = shops_by_province(repeat_shops(years, until)).withColumnRenamed("no_shop", "this_month_repeat_shop")
    return full_outer_merge([previous, current], [*MONTH_KEYS, "province"])


def city_shop_counts(years: DataFrame, until: DateLike | None = None) -> DataFrame:
    """Base and repeat counts per month, province and city, one row per place and month."""
    previous = shops_by_city(base_shops(years, until)).withColumnRenamed("no_shop", "repeat_purchase_shop_previous")
    current = shops_by_city(repeat_shops(years, until)).withColumnRenamed("no_shop", "repeat_purchase_shop")
    return full_outer_merge([previous, current], [*MONTH_KEYS, "province", "city"])


def shop_detail(years: DataFrame, until: DateLike | None = None) -> DataFrame:
    """Base (type 2) and repeat (type 1) shop rows in one table."""
    base = base_shops(years, until).withColumn("type", F.lit(BASE_TYPE))
    return base.unionByName(repeat_shops(years, until).withColumn("type", F.lit(REPEAT_TYPE)))


def shop_bitmaps(shops: DataFrame) -> DataFrame:
    """Shops per month and city as bitmaps, to be stored: one row per place, month and bucket of shop numbers.

    Distinct counts of any roll-up come from these rows alone, as the bitmaps of months and places can be joined by or.
    """
    return shops.where("shop_id IS NOT NULL").groupBy(
        *MONTH_KEYS, "province", "city", F.bitmap_bucket_number("shop_id").alias("bucket")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("shop_id")).alias("shops"))


def count_bitmaps(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct shops per keys from stored bitmaps."""
    joined = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("shops").alias("shops"))
    return joined.groupBy(*keys).agg(F.sum(F.bitmap_count("shops")).alias("no_shop"))


def year_to_date(bitmaps: DataFrame) -> DataFrame:
    """The bitmaps again for every later month of their year, so that a month holds all shops of the year until it."""
    return bitmaps.withColumn("month", F.explode(F.sequence("month", F.lit(12))))


def shop_levels(bitmaps: DataFrame) -> DataFrame:
    """Distinct shops per month and city, per month and province, and per province from the start of the year."""
    province = [*MONTH_KEYS, "province"]
    frames = {"city": count_bitmaps(bitmaps, [*province, "city"]), "province": count_bitmaps(bitmaps, province),
              "year_to_date": count_bitmaps(year_to_date(bitmaps), province)}
    rows = [df.select(F.lit(level).alias("level"), *province,
                      (F.col("city") if level == "city" else F.lit(None).cast("string")).alias("city"), "no_shop")
            for level, df in frames.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
