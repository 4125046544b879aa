"""Staff roster, sales classes, bonus ratios and target-weighted factors, per year and month.

All frames carry ``year`` and ``month``, so one run covers any number of months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.functions import predicates as P
from gearledger.functions import ratings as R
from gearledger.functions.calendar import DateLike, Month, between_days, in_months
from gearledger.functions.money import quotient, round2, total, zero_if_null
from gearledger.operators.lookups import join_folded
from gearledger.operators.merge import update_columns

MONTH_KEYS = ["year", "month"]


# --- roster ------------------------------------------------------------------------------

def bonus_roster(
    users: DataFrame, areas: DataFrame, region_users: DataFrame, region_provinces: DataFrame,
    first: Month | Column, last: Month | Column,
) -> DataFrame:
    """Field staff with their areas, and region heads with every province of their region."""
    staff = users.where(
        F.col("user_position").isNotNull() & (F.col("status") == P.YES)
        & (F.col("is_region_leader") == P.NO) & (F.col("is_hq") == P.NO))
    columns = ["user_id", "fr_username", "name", "position", "province"]
    field = staff.join(areas.select("user_id", "position", "province"), "user_id", "left").select(*columns)
    heads = (
        users.select("user_id", "fr_username", "name")
        .join(region_users.select("user_id", "region_id"), "user_id")
        .join(region_provinces.select("region_id", "province"), "region_id")
        .withColumn("position", F.lit(R.REGION_HEAD))
        .select(*columns)
    )
    return in_months(field.unionByName(heads).distinct(), first, last).withColumn(
        "repeat_shop_factor", R.repeat_shop_factor(F.lit(0.0)))


# --- month totals ------------------------------------------------------------------------

def _managed(stats: DataFrame, until: DateLike | None) -> DataFrame:
    return stats.where(P.id_is_not("manager_id", 0) & between_days(F.col("dt"), None, until)).withColumns(
        {"year": F.year("dt"), "month": F.month("dt")})


def _picc() -> Column:
    return F.col("picc_selfop_order") + F.col("picc_married_order")


def _actual_picc() -> Column:
    return F.col("picc_selfop_actual_order") + F.col("picc_married_actual_order")


def province_channel_totals(stats: DataFrame, until: DateLike | None = None) -> DataFrame:
    """Month-to-date insured-channel amounts per province."""
    return _managed(stats, until).groupBy(*MONTH_KEYS, "province").agg(
        total(_picc()).alias("amount_picc"), total(_actual_picc()).alias("amount_actual_picc"))


def manager_channel_totals(stats: DataFrame, until: DateLike | None = None) -> DataFrame:
    return _managed(stats, until).groupBy(*MONTH_KEYS, "manager_id").agg(
        total(_picc()).alias("amount_picc"), total(_actual_picc()).alias("amount_actual_picc"))


def province_selfop_totals(stats: DataFrame, until: DateLike | None = None) -> DataFrame:
    return _managed(stats, until).groupBy(*MONTH_KEYS, "province").agg(
        total("picc_selfop_order").alias("amount_picc_selfop"),
        total("picc_selfop_actual_order").alias("amount_actual_picc_selfop"))


# --- classes and ratios ------------------------------------------------------------------

def bonus_regular_staff(roster: DataFrame, province_totals: DataFrame) -> DataFrame:
    """Amounts of all provinces of a staff member, their class, ratio and class name."""
    staff = roster.where(F.col("position").isin(*R.REGULAR_POSITIONS))
    amounts = (
        join_folded(staff, province_totals, ["province", *MONTH_KEYS])
        .groupBy("user_id", "name", "position", *MONTH_KEYS)
        .agg(total("amount_picc").alias("amount_picc"), total("amount_actual_picc").alias("amount_actual_picc"))
    )
    position, cls = F.col("position"), F.col("sales_class")
    return amounts.withColumn("sales_class", R.sales_class(position, F.col("amount_actual_picc"))).withColumns({
        "bonus_ratio": R.bonus_ratio(position, cls),
        "sales_class_name": R.sales_class_name(position, cls),
    })


def bonus_parttime_provincial(
    region_users: DataFrame, areas: DataFrame, province_totals: DataFrame
) -> DataFrame:
    """Ratio of region heads for the province they also run."""
    heads = region_users.where(P.not_switched_off()).select("user_id", "name")
    own = areas.where(P.not_switched_off()).select("user_id", "province", "position")
    cls = R.sales_class(F.col("position"), F.col("amount_actual_picc"))
    return (
        heads.join(own, "user_id").join(province_totals, "province")
        .select("user_id", "name", "province", *MONTH_KEYS, "amount_picc", "amount_actual_picc",
                R.bonus_ratio(F.col("position"), cls).alias("bonus_ratio"))
    )


def bonus_customer_manager(roster: DataFrame, manager_totals: DataFrame) -> DataFrame:
    """Class, own-sale and brokered ratios of every customer manager."""
    managers = roster.where(F.col("position") == R.CUSTOMER_MANAGER).select(
        "user_id", "name", "position", *MONTH_KEYS).distinct()
    amounts = manager_totals.withColumnRenamed("manager_id", "user_id")
    position, cls = F.col("position"), F.col("sales_class")
    return (
        managers.join(amounts, ["user_id", *MONTH_KEYS], "left")
        .withColumns({c: zero_if_null(c) for c in ("amount_picc", "amount_actual_picc")})
        .withColumn("sales_class", R.sales_class(position, F.col("amount_actual_picc")))
        .withColumns({
            "selfop_bonus_ratio": R.manager_selfop_ratio(cls),
            "married_bonus_ratio": R.manager_brokered_ratio(cls),
            "sales_class_name": R.sales_class_name(position, cls),
        })
    )


# --- completion and repeat factors -------------------------------------------------------

def _zero_ratio(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("decimal(18,2)"))


def _completion(actual: Column, target: Column) -> Column:
    """Percent of target; a zero target counts as met."""
    return F.when(target == 0, F.lit(100).cast("decimal(18,2)")).otherwise(
        round2(quotient(actual, target) * 100))


def _repeat_rate() -> Column:
    """Percent of the base that repeated; zero without a base."""
    return _zero_ratio(round2(quotient(F.col("this_month_repeat_shop"), F.col("previous_repeat_shop")) * 100))


def _with_factors(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "selfop_factor": R.completion_selfop_factor(F.col("complete_ratio")),
        "married_factor": R.completion_brokered_factor(F.col("complete_ratio")),
        "repeat_shop_factor": R.repeat_shop_factor(F.col("repeat_ratio")),
    })


def province_level_targets(targets: DataFrame) -> DataFrame:
    return targets.where(F.col("city") == P.PROVINCE_LEVEL_CITY).select(
        "province", *MONTH_KEYS, "picc_selfop_trans_target", "picc_marriedDeal_trans_target")


def province_completion_factors(
    selfop_totals: DataFrame, targets: DataFrame, active_shops: DataFrame
) -> DataFrame:
    """Own-sale completion, repeat rate and the three factors per province; a missing target
    divides by one."""
    keys = ["province", *MONTH_KEYS]
    target = F.col("picc_selfop_trans_target")
    rows = (
        selfop_totals.join(province_level_targets(targets), keys, "left").join(active_shops, keys, "left")
        .select(
            *keys,
            _completion(F.col("amount_actual_picc_selfop"), F.coalesce(target, F.lit(1))).alias("complete_ratio"),
            _repeat_rate().alias("repeat_ratio"),
        )
    )
    return _with_factors(rows)


def region_weighted_completion(
    targets: DataFrame, selfop_totals: DataFrame, active_shops: DataFrame,
    region_provinces: DataFrame, region_users: DataFrame,
) -> DataFrame:
    """Completion and repeat rate per region head, weighted by the provinces' share of the
    region's target. Regions are summed before the heads are joined."""
    keys = ["province", *MONTH_KEYS]
    followed = region_provinces.where(F.col("is_responsible") == P.NO).select("region_id", "province")
    selfop_target = zero_if_null("picc_selfop_trans_target")
    provinces = (
        province_level_targets(targets).join(followed, "province")
        .withColumn("selfop_target", selfop_target)
        .withColumn("target", selfop_target + zero_if_null("picc_marriedDeal_trans_target"))
        .join(selfop_totals, keys, "left").join(active_shops, keys, "left")
    )
    region = ["region_id", *MONTH_KEYS]
    region_targets = provinces.groupBy(*region).agg(F.sum("target").alias("region_target"))
    previous = F.col("previous_repeat_shop")
    weight = quotient(F.col("target"), F.col("region_target"))
    completion = quotient(zero_if_null("amount_actual_picc_selfop"), F.col("selfop_target"))
    repeat = F.when(previous == 0, F.lit(0.0)).otherwise(quotient(F.col("this_month_repeat_shop"), previous))
    exact = "decimal(28,12)"
    per_region = provinces.join(region_targets, region).groupBy(*region).agg(
        F.sum((completion * weight).cast(exact)).alias("completion"),
        F.sum((repeat * weight).cast(exact)).alias("repeat"))
    heads = region_users.where(F.col("status") == P.YES).select("region_id", "user_id")
    return per_region.join(heads, "region_id").groupBy("user_id", *MONTH_KEYS).agg(
        round2(F.sum("completion") * 100).alias("complete_ratio"),
        round2(F.sum("repeat") * 100).alias("repeat_ratio"))


def region_bonus_factors(
    region_users: DataFrame, users: DataFrame, region_provinces: DataFrame, targets: DataFrame,
    active_shops: DataFrame, selfop_totals: DataFrame, weighted: DataFrame,
    first: Month | Column, last: Month | Column,
) -> DataFrame:
    """Factors of region heads per province: own figures where they are responsible for the
    province, the weighted figures of the region elsewhere."""
    keys = ["province", *MONTH_KEYS]
    heads = (
        region_users.where(F.col("status") == P.YES).select("region_id", "user_id")
        .join(users.where(F.col("status") == P.YES).select("user_id"), "user_id")
        .join(region_provinces.select("region_id", "province", "is_responsible"), "region_id")
    )
    wide = weighted.select(
        "user_id", *MONTH_KEYS, F.col("complete_ratio").alias("region_complete"),
        F.col("repeat_ratio").alias("region_repeat"))
    own = F.col("is_responsible") == P.YES
    own_completion = _completion(
        zero_if_null("amount_actual_picc_selfop"), F.col("picc_selfop_trans_target"))
    rows = (
        in_months(heads, first, last)
        .join(province_level_targets(targets), keys, "left")
        .join(active_shops, keys, "left")
        .join(selfop_totals, keys, "left")
        .join(wide, ["user_id", *MONTH_KEYS], "left")
        .select(
            "region_id", "province", "user_id", *MONTH_KEYS,
            _zero_ratio(F.when(own, own_completion).otherwise(F.col("region_complete"))).alias("complete_ratio"),
            F.when(own, _repeat_rate()).otherwise(_zero_ratio(F.col("region_repeat"))).alias("repeat_ratio"),
        )
    )
    return _with_factors(rows)


def manager_repeat_rate(shop_detail: DataFrame, shop_managers: DataFrame) -> DataFrame:
    """Repeat shops per base shop of every manager, in percent, with its factor."""
    repeat = F.count(F.when(F.col("type") == "1", 1))
    base = F.count(F.when(F.col("type") == "2", 1))
    rate = _zero_ratio(round2(quotient(repeat, base) * 100))
    return (
        shop_detail.select("shop_id", "type", *MONTH_KEYS).join(shop_managers, "shop_id")
        .groupBy("manager_id", *MONTH_KEYS).agg(rate.alias("repeat_ratio"))
        .withColumn("repeat_shop_factor", R.repeat_shop_factor(F.col("repeat_ratio")))
    )


# --- the finished table ------------------------------------------------------------------

# Columns the steps fill, and their types.
BONUS_COLUMNS = {
    "personal_picc_amount": "decimal(28,2)",
    "personal_picc_actual_amount": "decimal(28,2)",
    "married_profit_bonus_ratio": "double",
    "selfop_profit_bonus_ratio": "double",
    "manager_level": "string",
    "level_name": "string",
    "picc_selfop_completion": "decimal(18,2)",
    "this_repeat_rate": "decimal(18,2)",
    "selfop_profit_factor": "double",
    "married_profit_factor": "double",
}


def with_bonus_columns(roster: DataFrame) -> DataFrame:
    """Roster with the bonus columns still empty."""
    return roster.withColumns({c: F.lit(None).cast(t) for c, t in BONUS_COLUMNS.items()})


def _named(rows: DataFrame, keys: Sequence[str], names: dict[str, str]) -> DataFrame:
    return rows.select(*keys, *[F.col(src).alias(dst) for dst, src in names.items()])


def apply_class_updates(table: DataFrame, regular: DataFrame, parttime: DataFrame, managers: DataFrame) -> DataFrame:
    """Amounts, ratios and classes: regular staff and customer managers, then region heads running a province."""
    position = F.col("position")
    person = ["user_id", "position", *MONTH_KEYS]
    names = {
        "personal_picc_amount": "amount_picc", "personal_picc_actual_amount": "amount_actual_picc",
        "married_profit_bonus_ratio": "married_bonus_ratio", "selfop_profit_bonus_ratio": "selfop_bonus_ratio",
        "manager_level": "sales_class", "level_name": "sales_class_name",
    }
    # Their positions differ, so one join serves both; regular staff have one ratio for either column.
    both = F.col("bonus_ratio")
    staff = regular.where(position.isin(*R.REGULAR_POSITIONS)).withColumns(
        {"married_bonus_ratio": both, "selfop_bonus_ratio": both})
    staff = _named(staff, person, names).unionByName(
        _named(managers.where(position == R.CUSTOMER_MANAGER), person, names))
    place = ["user_id", "province", *MONTH_KEYS]
    parttime_names = {c: "bonus_ratio" for c in ("married_profit_bonus_ratio", "selfop_profit_bonus_ratio")}
    table = update_columns(table, staff, person, list(names))
    return update_columns(
        table, _named(parttime, place, parttime_names), place, list(parttime_names),
        position == R.REGION_HEAD)


_FACTOR_NAMES = {
    "picc_selfop_completion": "complete_ratio", "this_repeat_rate": "repeat_ratio",
    "selfop_profit_factor": "selfop_factor", "married_profit_factor": "married_factor",
    "repeat_shop_factor": "repeat_shop_factor",
}
_REPEAT_NAMES = {"this_repeat_rate": "repeat_ratio", "repeat_shop_factor": "repeat_shop_factor"}


def apply_factor_updates(
    table: DataFrame, provinces: DataFrame, regions: DataFrame, manager_repeat: DataFrame
) -> DataFrame:
    """Completion and repeat factors: by province, by region head, by manager."""
    position = F.col("position")
    place = ["province", *MONTH_KEYS]
    head = ["user_id", "province", *MONTH_KEYS]
    person = ["user_id", *MONTH_KEYS]
    # One join by province. Customer managers take the completion from it and keep their own repeat columns.
    own = position == R.CUSTOMER_MANAGER
    named = _named(provinces, place, {f"province_{c}": name for c, name in _FACTOR_NAMES.items()})
    joined = join_folded(table, named.withColumn("in_province", F.lit(True)), place)
    of_province = F.coalesce("in_province", F.lit(False)) & position.isin(*R.PROVINCE_POSITIONS, R.CUSTOMER_MANAGER)
    table = joined.select(*[
        F.when(of_province & ~own if c in _REPEAT_NAMES else of_province,
               F.col(f"province_{c}").cast(kind)).otherwise(F.col(c)).alias(c) if c in _FACTOR_NAMES else F.col(c)
        for c, kind in table.dtypes])
    table = update_columns(table, _named(regions, head, _FACTOR_NAMES), head, list(_FACTOR_NAMES))
    by_user = manager_repeat.withColumnRenamed("manager_id", "user_id")
    return update_columns(
        table, _named(by_user, person, _REPEAT_NAMES), person, list(_REPEAT_NAMES),
        position == R.CUSTOMER_MANAGER, unique=True)
