"""Named queries: every operator over the whole tables of a data folder."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gearledger.functions import calendar as cal
from gearledger.functions import predicates as P
from gearledger.functions import ratings as R
from gearledger.functions.money import GOODS_TAX, ex_tax, total_if
from gearledger.functions.sql_rules import register_rules
from gearledger.functions.text import clean_part_number, pid, quality_group
from gearledger.operators import bonus, managers, parts, prices, scorecard, shops
from gearledger.operators.columns import add_price_columns
from gearledger.operators.event_log import EventLog
from gearledger.operators.extremes import rows_at_extreme
from gearledger.operators.lookups import distinct_codes, id_bounds, join_inner_dim, join_left_dim, lookup
from gearledger.operators.merge import insert_if_absent, replace_groups, update_columns, upsert
from gearledger.operators.netting import net_full_outer
from gearledger.session import materialise, shared_folder, tune
from gearledger.sources import views as V
from gearledger.sources.ranges import footer_bounds, read_by_ranges
from gearledger.sources.tables import Tables, bucketed_table

# Parameters of the registered queries. The tables cover 1995 to 2001, so the rule dates that
# lie outside that span are moved into it; otherwise those rules would never apply.
BROKER_TERM_START = "1998-01-01"
REFUND_STATE_START = "1998-08-01"
SERVICE_BONUS_START = "1998-07-01"
EXCLUDED_SUPPLIER = 50
PRICE_BATCH_START, LAST_DAY_BEFORE_BATCH = "2001-06-01", "2001-05-31"
SECOND_BATCH_START, LAST_DAY_OF_FIRST_BATCH = "2001-07-01", "2001-06-30"
# No event of the tables is later.
LAST_EVENT_DAY = "2002-12-31"
ITEM_TARGET_END = "1999-12-31"
ITEM_UPDATE_START = "1999-01-01"
PRICE_PROVINCES = ["nation_1", "nation_2"]

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a function of the tables under its own name (a trailing _ avoids a clash)."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return fn(Tables(tune(spark), folder))
    _QUERIES[fn.__name__.rstrip("_")] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- sources, lookups, sinks -------------------------------------------------------------

@query
def scan_orders(t: Tables) -> DataFrame:
    return V.orders(t)


@query
def id_bounds_(t: Tables) -> DataFrame:
    return id_bounds(t.orders, "o_orderkey")


@query
def bounds_from_footers(t: Tables) -> DataFrame:
    return footer_bounds(t.spark, f"{t.folder}/orders.parquet", ["o_orderkey", "o_custkey"])


@query
def orders_by_ranges(t: Tables) -> DataFrame:
    """The orders read in eight ranges of about equally many rows."""
    return read_by_ranges(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 8)


@query
def brand_code_list(t: Tables) -> DataFrame:
    return distinct_codes(V.brand_map(t), "standard_brand_code")


@query
def province_name_lookup(t: Tables) -> DataFrame:
    rows = t.supplier.select("s_suppkey", F.col("s_nationkey").cast("string").alias("code"))
    named = lookup(rows, V.province_map(t), "code", "province_code", "province_chn", "province_name")
    named = lookup(named, V.province_map(t), "code", "province_code", "province", "province_pinyin")
    return lookup(named, V.province_map(t), "province_pinyin", "province", "province_chn", "name_by_pinyin")


@query
def brand_code_lookup(t: Tables) -> DataFrame:
    return lookup(
        t.part.select("p_partkey", "p_brand"), V.brand_map(t), "p_brand",
        "standard_brand_name", "standard_brand_code", "brand_code")


def _price_rows(t: Tables) -> DataFrame:
    return P.clean_price_rows(V.parts(t))


def _price_history_and_batch(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Stored prices from before the batch, and the price rows of the batch."""
    rows = V.parts(t)
    before = P.clean_price_rows(rows).where(F.col("deliver_time") < cal.day(PRICE_BATCH_START))
    return before, P.clean_price_rows(rows, PRICE_BATCH_START)


@query
def upsert_price_history(t: Tables) -> DataFrame:
    before, batch = _price_history_and_batch(t)
    target = prices.with_brand_code(prices.price_history(before), V.brand_map(t))
    merged = prices.with_brand_code(prices.price_min_merge(target, batch), V.brand_map(t))
    return upsert(
        target, merged.drop("pid"), prices.KEYS,
        ["brand_code", "min_sale_price", "min_sale_province", "min_sale_deliver_time"], unique=True)


@query
def upsert_bucketed_history(t: Tables) -> DataFrame:
    """As ``upsert_price_history``, on a history stored in buckets of its keys."""
    before, batch = _price_history_and_batch(t)
    history = prices.with_brand_code(prices.price_history(before), V.brand_map(t))
    return prices.low_snapshot(bucketed_table(history, "price_history", prices.KEYS), batch, V.brand_map(t))


def _items_and_updates(t: Tables) -> tuple[DataFrame, DataFrame]:
    columns = ["orderitem_id", "car_brand", "temp_oe", "quality_type", "province", "sale_price", "deliver_time"]
    target = P.clean_price_rows(V.parts(t), end=ITEM_TARGET_END).select(*columns)
    return target, P.clean_price_rows(V.parts(t), ITEM_UPDATE_START).select(*columns)


@query
def insert_if_absent_(t: Tables) -> DataFrame:
    return insert_if_absent(*_items_and_updates(t), ["orderitem_id"])


@query
def insert_small_batch(t: Tables) -> DataFrame:
    return insert_if_absent(*_items_and_updates(t), ["orderitem_id"], small_batch=True)


@query
def update_bonus_columns(t: Tables) -> DataFrame:
    staff = bonus.bonus_customer_manager(_roster(t), bonus.manager_channel_totals(V.manager_stats(t)))
    keys = ["user_id", *bonus.MONTH_KEYS]
    changes = staff.select(*keys, F.col("amount_picc").alias("personal_picc_amount"),
                           F.col("sales_class").alias("manager_level"))
    table = bonus.with_bonus_columns(_roster(t)).select(
        "user_id", "position", "province", *bonus.MONTH_KEYS, "personal_picc_amount", "manager_level")
    return update_columns(
        table, changes, keys, ["personal_picc_amount", "manager_level"],
        F.col("position") == R.CUSTOMER_MANAGER, unique=True)


@query
def manager_scorecard(t: Tables) -> DataFrame:
    return managers.manager_scorecard(
        V.orders(t), V.track(t), V.settlement(t), V.city_map(t), refund_state_start=REFUND_STATE_START,
        excluded_supplier=EXCLUDED_SUPPLIER, bonus_start=SERVICE_BONUS_START)


@query
def manager_stats_two_days(t: Tables) -> DataFrame:
    """Days up to the cut, then those from the cut on, these twice: equal to one run over all days."""
    def run(start: str | None, end: str | None) -> DataFrame:
        return managers.manager_scorecard(
            V.orders(t), V.track(t), V.settlement(t), V.city_map(t), start, end, refund_state_start=REFUND_STATE_START,
            excluded_supplier=EXCLUDED_SUPPLIER, bonus_start=SERVICE_BONUS_START)
    later = materialise(run(PRICE_BATCH_START, None))
    table = replace_groups(run(None, LAST_DAY_BEFORE_BATCH), later, ["stat_date"])
    return replace_groups(table, later, ["stat_date"])


# --- filters -----------------------------------------------------------------------------

@query
def filter_b2b(t: Tables) -> DataFrame:
    return V.orders(t).where(P.is_b2b()).select("id", "province", "city", "order_amount", "payment_date")


@query
def effective_receipt_date(t: Tables) -> DataFrame:
    rows = V.track(t, with_city=False).withColumn("stat_date", P.receipt_date())
    return rows.where(F.col("stat_date").isNotNull()).select(
        "order_id", "operate_code", "operate_date", "deliver_date", "stat_date", "amount")


@query
def valid_refunds(t: Tables) -> DataFrame:
    return V.orders(t).where(P.refund_is_valid(REFUND_STATE_START)).select(
        "id", "order_status", "payment_date", "refund_date", "refund_amount")


@query
def broker_term_cutoff(t: Tables) -> DataFrame:
    return V.track(t, with_city=False).where(P.broker_term_ok(BROKER_TERM_START)).select(
        "order_id", "operate_code", "deliver_date", "amount")


@query
def clean_price_rows(t: Tables) -> DataFrame:
    return _price_rows(t)


@query
def valid_products(t: Tables) -> DataFrame:
    return P.valid_products(V.goods(t)).select(
        "goodsCode", "originSource", "carTypeBrandName", "qualityType", "partsOe", "provinceCode", "partsPrice")


# --- joins and extremes ------------------------------------------------------------------

@query
def join_inner_dim_(t: Tables) -> DataFrame:
    mapping = V.city_map(t).where(F.col("status") == P.YES)
    return join_inner_dim(V.orders(t), mapping, "city", "city_code").select(
        "id", "province", "city", "business_city_code", "order_amount")


@query
def join_left_dim_(t: Tables) -> DataFrame:
    return join_left_dim(_price_rows(t), V.brand_map(t), "car_brand", "standard_brand_name").select(
        "orderitem_id", "car_brand", "standard_brand_code", "temp_oe", "sale_price")


@query
def join_full_outer_net(t: Tables) -> DataFrame:
    rows = V.orders(t)
    keys = scorecard.KEYS
    forward = rows.where(F.col("deliver_date").isNotNull()).groupBy(
        F.col("deliver_date").alias("stat_date"), "province", "city"
    ).agg(F.sum("order_amount").alias("amount"), F.sum("purchase_amount").alias("purchase"))
    backward = rows.where(F.col("refund_date").isNotNull()).groupBy(
        F.col("refund_date").alias("stat_date"), "province", "city"
    ).agg(F.sum("refund_amount").alias("amount"), F.sum("refund_purchase_amount").alias("purchase"))
    return net_full_outer(forward, backward, keys)


@query
def arg_min_ties(t: Tables) -> DataFrame:
    return rows_at_extreme(_price_rows(t), prices.KEYS, "sale_price", "min").select(
        *prices.KEYS, "sale_price", "province", "deliver_time", "part_oe")


@query
def arg_max_ties(t: Tables) -> DataFrame:
    return rows_at_extreme(_price_rows(t), prices.KEYS, "sale_price", "max").select(
        *prices.KEYS, "sale_price", "province", "deliver_time", "part_oe")


@query
def history_left_join(t: Tables) -> DataFrame:
    before, batch = _price_history_and_batch(t)
    lows = batch.groupBy(*prices.KEYS).agg(F.min("sale_price").alias("batch_price"))
    stored = before.groupBy(*prices.KEYS).agg(F.min("sale_price").alias("price"))
    return prices.with_history(lows, stored)


# --- functions ---------------------------------------------------------------------------

@query
def pid_key(t: Tables) -> DataFrame:
    return V.orders(t).select(
        "id",
        pid(F.col("province"), F.col("city"), cal.yyyymmdd(F.col("payment_date"))).alias("city_pid"),
        pid(F.col("province"), F.col("payment_date").cast("string")).alias("province_pid"))


@query
def income_ex_tax(t: Tables) -> DataFrame:
    return V.orders(t).groupBy("payment_date", "province").agg(
        ex_tax(total_if(P.selfop(), "order_amount"), GOODS_TAX).alias("income"))


@query
def business_calendar(t: Tables) -> DataFrame:
    d = F.col("d")
    return t.orders.select(F.to_date("o_orderdate").alias("d")).distinct().select(
        "d",
        cal.month_start(d).alias("month_start"),
        cal.month_end(d).alias("month_end"),
        cal.previous_month_end(d).alias("previous_month_end"),
        cal.year_start(d).alias("year_start"),
        cal.same_day_last_year(d).alias("same_day_last_year"),
        cal.days_before(d, prices.EXPIRY_DAYS).alias("ninety_days_before"),
        cal.day_after(d).alias("day_after"),
        F.year(d).alias("y"), F.month(d).alias("m"), F.day(d).alias("dd"))


@query
def clean_part_number_(t: Tables) -> DataFrame:
    return V.part_numbers(t).select(
        "p_partkey", "part_oe", "temp_oe",
        clean_part_number(F.concat("p_name", F.lit("#"), "p_brand", F.lit("~+1,2"))).alias("cleaned_name"))


@query
def quality_group_(t: Tables) -> DataFrame:
    return V.goods(t).select("goodsCode", "qualityType", quality_group(F.col("qualityType")).alias("quality"))


# --- rating expressions ------------------------------------------------------------------

def _rated(t: Tables) -> DataFrame:
    """Positions and amounts spread over all bands, one row per order."""
    k = F.col("o_orderkey")
    position = (F.when(k % 6 == 0, "00").when(k % 6 == 1, "01").when(k % 6 == 2, "02")
                .when(k % 6 == 3, "03").when(k % 6 == 4, "05").otherwise("09"))
    rows = t.orders.select(
        k.alias("id"), position.alias("position"),
        (F.col("o_totalprice").cast("decimal(11,2)") * 80).cast("decimal(18,2)").alias("amount"),
        (k % 6000).cast("decimal(11,2)").alias("hundredths"))
    return rows.select(
        "id", "position", "amount", (F.col("hundredths") / 100).cast("decimal(11,2)").alias("repeat_rate"),
        (F.col("hundredths") / 40).cast("decimal(11,2)").alias("completion"))


def _classed(t: Tables) -> DataFrame:
    return _rated(t).withColumn("sales_class", R.sales_class(F.col("position"), F.col("amount")))


def _rating(t: Tables, name: str, expression: Column) -> DataFrame:
    return _classed(t).select("id", "position", "sales_class", expression.alias(name))


@query
def sales_class(t: Tables) -> DataFrame:
    literal = R.sales_class(F.col("position"), F.col("amount"), strict_reference=True)
    return _classed(t).select("id", "position", "amount", "sales_class", literal.alias("literal_class"))


@query
def sales_class_name(t: Tables) -> DataFrame:
    return _rating(t, "class_name", R.sales_class_name(F.col("position"), F.col("sales_class")))


@query
def bonus_ratio(t: Tables) -> DataFrame:
    return _rating(t, "ratio", R.bonus_ratio(F.col("position"), F.col("sales_class")))


@query
def manager_selfop_ratio(t: Tables) -> DataFrame:
    return _rating(t, "ratio", R.manager_selfop_ratio(F.col("sales_class")))


@query
def manager_brokered_ratio(t: Tables) -> DataFrame:
    return _rating(t, "ratio", R.manager_brokered_ratio(F.col("sales_class")))


@query
def repeat_shop_factor(t: Tables) -> DataFrame:
    return _rated(t).select("id", "repeat_rate", R.repeat_shop_factor(F.col("repeat_rate")).alias("factor"))


@query
def completion_selfop_factor(t: Tables) -> DataFrame:
    return _rated(t).select("id", "completion", R.completion_selfop_factor(F.col("completion")).alias("factor"))


@query
def completion_brokered_factor(t: Tables) -> DataFrame:
    return _rated(t).select("id", "completion", R.completion_brokered_factor(F.col("completion")).alias("factor"))


@query
def rules_in_sql(t: Tables) -> DataFrame:
    """All nine rules called from SQL text."""
    return register_rules(t.spark).sql("""
        SELECT id, class, sales_class_name(position, class) AS class_name, bonus_ratio(position, class) AS ratio,
          manager_selfop_ratio(class) AS selfop_ratio, manager_brokered_ratio(class) AS brokered_ratio,
          repeat_shop_factor(repeat_rate) AS repeat_factor, completion_selfop_factor(completion) AS selfop_factor,
          completion_brokered_factor(completion) AS brokered_factor,
          clean_part_number(concat(position, '-', class, '~')) AS cleaned
        FROM (SELECT *, sales_class(position, amount) AS class FROM {rated})""", rated=_rated(t))


# --- scorecards --------------------------------------------------------------------------

@query
def daily_delivery_net(t: Tables) -> DataFrame:
    return scorecard.daily_delivery_net(V.orders(t))


@query
def daily_actual_receipts(t: Tables) -> DataFrame:
    return scorecard.daily_actual_receipts(V.track(t, with_city=False), V.orders(t), cutoff=BROKER_TERM_START)


@query
def daily_paid(t: Tables) -> DataFrame:
    return scorecard.daily_paid(V.orders(t))


@query
def daily_scorecard(t: Tables) -> DataFrame:
    return scorecard.daily_scorecard(V.orders(t), V.track(t, with_city=False), cutoff=BROKER_TERM_START)


@query
def scorecard_from_event_log(t: Tables) -> DataFrame:
    """Days up to the cut from the orders; those from the cut on appended to a day-partitioned event log in two runs, the
    second of them twice, and read from there. Refunds of orders from before the cut come with the day they fall on."""
    orders, track = V.orders(t), V.track(t, with_city=False)
    log = EventLog(t.spark, f"{shared_folder(t.spark)}/gearledger/event-log-{uuid.uuid4().hex}")
    first, middle, last = (dt.date.fromisoformat(x) for x in (PRICE_BATCH_START, SECOND_BATCH_START, LAST_EVENT_DAY))
    log.append(orders, track, first, middle - dt.timedelta(days=1), BROKER_TERM_START)
    for _ in range(2):
        log.append(orders, track, middle, last, BROKER_TERM_START)
    before = scorecard.daily_scorecard(orders, track, None, LAST_DAY_BEFORE_BATCH, BROKER_TERM_START)
    return before.unionByName(log.daily_scorecard(PRICE_BATCH_START))


@query
def vehicle_part_mix_net(t: Tables) -> DataFrame:
    return scorecard.vehicle_part_mix_net(V.orders(t))


@query
def paid_not_delivered(t: Tables) -> DataFrame:
    return scorecard.paid_not_delivered(V.orders(t))


@query
def vehicle_scorecard(t: Tables) -> DataFrame:
    return scorecard.vehicle_scorecard(V.orders(t))


@query
def complementary_scorecard(t: Tables) -> DataFrame:
    return scorecard.complementary_scorecard(V.orders(t), shops.city_shop_counts(_shop_years(t)))


# --- shops -------------------------------------------------------------------------------

def _shop_years(t: Tables) -> DataFrame:
    return shops.shop_years(V.orders(t), V.core_users(t))


@query
def repeat_base_shops(t: Tables) -> DataFrame:
    return shops.repeat_base_shops(V.orders(t), V.core_users(t))


@query
def repeat_base_by_city(t: Tables) -> DataFrame:
    return shops.shops_by_city(shops.base_shops(_shop_years(t)))


@query
def repeat_base_by_province(t: Tables) -> DataFrame:
    return shops.shops_by_province(shops.base_shops(_shop_years(t)))


@query
def repeat_shops_this_month(t: Tables) -> DataFrame:
    return shops.repeat_shops_this_month(V.orders(t), V.core_users(t))


@query
def repeat_by_city(t: Tables) -> DataFrame:
    return shops.shops_by_city(shops.repeat_shops(_shop_years(t)))


@query
def repeat_by_province(t: Tables) -> DataFrame:
    return shops.shops_by_province(shops.repeat_shops(_shop_years(t)))


@query
def repeat_shops_from_bitmaps(t: Tables) -> DataFrame:
    """City, province and year-to-date counts from stored bitmaps; the orders are read for these once."""
    return shops.shop_levels(materialise(shops.shop_bitmaps(shops.repeat_shops(_shop_years(t))), "shop-bitmaps"))


# --- managers ----------------------------------------------------------------------------

@query
def manager_delivery_net(t: Tables) -> DataFrame:
    return managers.manager_delivery_net(V.orders(t), V.city_map(t), refund_state_start=REFUND_STATE_START)


@query
def manager_actual_receipts(t: Tables) -> DataFrame:
    return managers.manager_actual_receipts(V.track(t), V.orders(t), V.city_map(t))


@query
def service_charge_by_manager(t: Tables) -> DataFrame:
    return managers.service_charge_by_manager(
        V.settlement(t), V.orders(t), excluded_supplier=EXCLUDED_SUPPLIER, bonus_start=SERVICE_BONUS_START)


# --- bonus -------------------------------------------------------------------------------

def _roster(t: Tables) -> DataFrame:
    return bonus.bonus_roster(
        V.sales_users(t), V.user_areas(t), V.region_users(t), V.region_provinces(t), *V.order_months(t))


def _targets(t: Tables) -> DataFrame:
    return V.targets(t, *V.order_months(t))


@query
def bonus_roster(t: Tables) -> DataFrame:
    return _roster(t)


@query
def province_channel_totals(t: Tables) -> DataFrame:
    return bonus.province_channel_totals(V.manager_stats(t))


@query
def manager_channel_totals(t: Tables) -> DataFrame:
    return bonus.manager_channel_totals(V.manager_stats(t))


@query
def province_selfop_totals(t: Tables) -> DataFrame:
    return bonus.province_selfop_totals(V.manager_stats(t))


@query
def bonus_regular_staff(t: Tables) -> DataFrame:
    return bonus.bonus_regular_staff(_roster(t), bonus.province_channel_totals(V.manager_stats(t)))


@query
def bonus_parttime_provincial(t: Tables) -> DataFrame:
    totals = bonus.province_channel_totals(V.manager_stats(t))
    return bonus.bonus_parttime_provincial(V.region_users(t), V.user_areas(t), totals)


@query
def bonus_customer_manager(t: Tables) -> DataFrame:
    return bonus.bonus_customer_manager(_roster(t), bonus.manager_channel_totals(V.manager_stats(t)))


@query
def province_completion_factors(t: Tables) -> DataFrame:
    return bonus.province_completion_factors(
        bonus.province_selfop_totals(V.manager_stats(t)), _targets(t), shops.active_shops(_shop_years(t)))


def _region_weighted(t: Tables, selfop: DataFrame, active: DataFrame) -> DataFrame:
    return bonus.region_weighted_completion(
        _targets(t), selfop, active, V.region_provinces(t), V.region_users(t))


def _region_factors(t: Tables, selfop: DataFrame, active: DataFrame) -> DataFrame:
    return bonus.region_bonus_factors(
        V.region_users(t), V.sales_users(t), V.region_provinces(t), _targets(t), active, selfop,
        _region_weighted(t, selfop, active), *V.order_months(t))


@query
def region_weighted_completion(t: Tables) -> DataFrame:
    return _region_weighted(
        t, bonus.province_selfop_totals(V.manager_stats(t)), shops.active_shops(_shop_years(t)))


@query
def region_bonus_factors(t: Tables) -> DataFrame:
    selfop = materialise(bonus.province_selfop_totals(V.manager_stats(t)))
    active = materialise(shops.active_shops(_shop_years(t)))
    return _region_factors(t, selfop, active)


@query
def manager_repeat_rate(t: Tables) -> DataFrame:
    return bonus.manager_repeat_rate(shops.shop_detail(_shop_years(t)), V.shop_managers(t))


@query
def bonus_table(t: Tables) -> DataFrame:
    stats = materialise(V.manager_stats(t))
    years = materialise(_shop_years(t))
    roster = materialise(_roster(t))
    province_totals = materialise(bonus.province_channel_totals(stats))
    selfop = materialise(bonus.province_selfop_totals(stats))
    active = materialise(shops.active_shops(years))
    table = bonus.apply_class_updates(
        bonus.with_bonus_columns(roster),
        bonus.bonus_regular_staff(roster, province_totals),
        bonus.bonus_parttime_provincial(V.region_users(t), V.user_areas(t), province_totals),
        bonus.bonus_customer_manager(roster, bonus.manager_channel_totals(stats)))
    return bonus.apply_factor_updates(
        table,
        bonus.province_completion_factors(selfop, _targets(t), active),
        _region_factors(t, selfop, active),
        bonus.manager_repeat_rate(shops.shop_detail(years), V.shop_managers(t)))


# --- prices ------------------------------------------------------------------------------

@query
def price_floor_merge(t: Tables) -> DataFrame:
    before, batch = _price_history_and_batch(t)
    stored = prices.lowest_per_key(before, prices.KEYS, "sale_price").select(
        *prices.KEYS, "sale_price", F.col("province").alias("sale_province"), "deliver_time")
    return prices.with_brand_code(prices.price_floor_merge(stored, batch), V.brand_map(t))


@query
def price_min_merge(t: Tables) -> DataFrame:
    before, batch = _price_history_and_batch(t)
    merged = prices.price_min_merge(prices.price_history(before), batch)
    return prices.with_brand_code(merged, V.brand_map(t))


@query
def price_max_merge(t: Tables) -> DataFrame:
    before, batch = _price_history_and_batch(t)
    merged = prices.price_max_merge(prices.price_history(before), batch)
    return prices.with_brand_code(merged, V.brand_map(t))


@query
def price_avg_merge(t: Tables) -> DataFrame:
    before, batch = _price_history_and_batch(t)
    merged = prices.price_avg_merge(prices.price_history(before), batch)
    return prices.with_brand_code(merged, V.brand_map(t))


def _price_ledger(t: Tables) -> DataFrame:
    """Sales before the cut as closed days, then two batches, the second of them twice."""
    before, batch = _price_history_and_batch(t)
    early = prices.day_sums(batch.where(F.col("deliver_time") < cal.day(SECOND_BATCH_START)))
    late = materialise(prices.day_sums(batch.where(F.col("deliver_time") >= cal.day(SECOND_BATCH_START))), "ledger")
    ledger = prices.close_days(prices.day_sums(before), LAST_DAY_BEFORE_BATCH)
    ledger = prices.replace_days(ledger, early, PRICE_BATCH_START, LAST_DAY_OF_FIRST_BATCH)
    for _ in range(2):
        ledger = prices.replace_days(ledger, late, SECOND_BATCH_START, None)
    return ledger


@query
def price_average_from_ledger(t: Tables) -> DataFrame:
    return prices.average_of_ledger(_price_ledger(t))


@query
def price_snapshot(t: Tables) -> DataFrame:
    """The history before the cut merged with the batch, and that merged with the same batch again."""
    before, batch = _price_history_and_batch(t)
    brand_map, ledger = V.brand_map(t), materialise(_price_ledger(t), "ledger")
    history = prices.with_brand_code(prices.price_history(before), brand_map)
    once = materialise(prices.price_snapshot(history, batch, ledger, brand_map), "price-history")
    return prices.price_snapshot(once, batch, ledger, brand_map)


@query
def order_item_enriched(t: Tables) -> DataFrame:
    return prices.order_item_enriched(_price_rows(t), V.brand_map(t), V.list_prices(t))


@query
def local_price_match(t: Tables) -> DataFrame:
    return prices.local_price_match(V.local_prices(t), V.floor_prices(t), V.province_map(t))


@query
def local_price_update(t: Tables) -> DataFrame:
    matched = prices.local_price_match(V.local_prices(t), V.floor_prices(t), V.province_map(t))
    return prices.local_price_update(V.local_prices(t), matched)


@query
def add_price_columns_(t: Tables) -> DataFrame:
    return add_price_columns(V.local_prices(t), PRICE_PROVINCES)


# --- parts and products ------------------------------------------------------------------

@query
def inquiry_alias_parts(t: Tables) -> DataFrame:
    return parts.inquiry_alias_parts(V.damage(t), V.damage_parts(t), V.product_info(t))


@query
def offer_brand_list(t: Tables) -> DataFrame:
    return parts.offer_brand_list(V.offers(t), V.base_parts(t))


@query
def base_part_table(t: Tables) -> DataFrame:
    return parts.base_part_table(
        parts.inquiry_alias_parts(V.damage(t), V.damage_parts(t), V.product_info(t)),
        parts.goods_daily_upload(V.goods(t)), parts.offer_brands(V.offers(t)))


@query
def goods_daily_upload(t: Tables) -> DataFrame:
    return parts.goods_daily_upload(V.goods(t))


@query
def product_count_salted(t: Tables) -> DataFrame:
    return parts.product_count_salted(V.goods(t))


@query
def price_by_quality_group(t: Tables) -> DataFrame:
    return parts.price_by_quality_group(V.goods(t))
