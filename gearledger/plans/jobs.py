"""The five batch jobs over a source of domain tables.

``source`` gives a DataFrame per domain table name, from parquet or JDBC; every job takes the
day it runs for and returns its finished tables by name. Frames that several tables share are written
to the shared folder while the job is built; the rest runs when a table is written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from gearledger.functions import predicates as P
from gearledger.operators import bonus, managers, parts, prices, scorecard, shops
from gearledger.operators.event_log import EventLog
from gearledger.operators.merge import insert_if_absent, upsert
from gearledger.session import materialise
from gearledger.sources.tables import publish
from gearledger.sources.versions import publish_parts, read_parts

Source = Callable[[str], DataFrame]


def business_job(source: Source, date: dt.date, log: EventLog | None = None) -> dict[str, DataFrame]:
    """Scorecards, repeat shops and manager achievement of one day.

    With an event log the daily scorecard reads the day's partition of it instead of all orders and receipts.
    """
    orders, track, cities = source("orders"), source("track"), source("city_map")
    years = materialise(shops.shop_years(orders, source("core_users"), until=date))
    month = f"year = {date.year} AND month = {date.month}"
    return {
        "daily_scorecard": log.daily_scorecard(date, date) if log else scorecard.daily_scorecard(
            orders, track, date, date),
        "vehicle_scorecard": scorecard.complementary_scorecard(orders, shops.city_shop_counts(years, date), date, date),
        "shop_detail": shops.shop_detail(years, date).where(month),
        "active_shops": shops.active_shops(years, date).where(month),
        "manager_scorecard": managers.manager_scorecard(
            orders, track, source("settlement"), cities, date, date),
    }


def bonus_job(source: Source, date: dt.date) -> dict[str, DataFrame]:
    """Bonus table of the month of a day, from the published manager scorecard and shop tables."""
    month = (date.year, date.month)
    in_month = f"year = {date.year} AND month = {date.month}"
    scores = managers.as_manager_stats(source("manager_scorecard"))
    stats = scores.where(
        (scores["dt"] >= date.replace(day=1)) & (scores["dt"] <= date))
    users, areas = source("sales_users"), source("user_areas")
    region_users, region_provinces = source("region_users"), source("region_provinces")
    targets, active = source("targets").where(in_month), source("active_shops").where(in_month)
    totals = materialise(bonus.province_channel_totals(stats))
    selfop = materialise(bonus.province_selfop_totals(stats))
    roster = materialise(bonus.bonus_roster(users, areas, region_users, region_provinces, month, month))
    classed = bonus.apply_class_updates(
        bonus.with_bonus_columns(roster),
        bonus.bonus_regular_staff(roster, totals),
        bonus.bonus_parttime_provincial(region_users, areas, totals),
        bonus.bonus_customer_manager(roster, bonus.manager_channel_totals(stats)))
    weighted = bonus.region_weighted_completion(targets, selfop, active, region_provinces, region_users)
    finished = bonus.apply_factor_updates(
        classed,
        bonus.province_completion_factors(selfop, targets, active),
        bonus.region_bonus_factors(
            region_users, users, region_provinces, targets, active, selfop, weighted, month, month),
        bonus.manager_repeat_rate(source("shop_detail").where(in_month), source("shop_managers")))
    return {"bonus_table": finished}


def price_job(source: Source, date: dt.date) -> dict[str, DataFrame]:
    """New price-history and order-item snapshots, and the price ledger, after one day of sales.

    The day replaces itself in the ledger, so the job may run again for a day, also on the history it published.
    """
    batch = P.clean_price_rows(source("order_items"), date, date)
    history, brand_map = source("price_history"), source("brand_map")
    ledger = materialise(prices.replace_days(source("price_ledger"), prices.day_sums(batch), date, date), "ledger")
    items = prices.order_item_enriched(batch, brand_map, source("list_prices"))
    floor = prices.price_floor_merge(source("floor_history"), P.clean_price_rows(source("sold_parts"), date, date))
    return {
        "price_history": prices.price_snapshot(history, batch, ledger, brand_map),
        "price_ledger": ledger,
        "order_items_priced": insert_if_absent(source("order_items_priced"), items, ["orderitem_id"]),
        "floor_history": upsert(
            source("floor_history"), prices.with_brand_code(floor.drop("pid"), brand_map), prices.KEYS,
            ["brand_code", "sale_price", "sale_province", "deliver_time"], unique=True),
    }


def alias_job(source: Source, date: dt.date) -> dict[str, DataFrame]:
    """Alias parts, uploaded goods and offered brands of one day, and the standing base parts after it."""
    aliases = parts.inquiry_alias_parts(source("damage"), source("damage_parts"), source("product_info"), date, date)
    goods = parts.goods_daily_upload(source("goods"), date, date)
    return {
        "alias_parts": aliases,
        "goods_parts": goods,
        "offer_brands": parts.offer_brand_list(source("offers"), source("base_parts"), date, date),
        "base_part_table": parts.base_part_table(
            aliases, goods, parts.offer_brands(source("offers"), date, date), source("base_part_table")),
    }


def catalogue_job(source: Source) -> dict[str, DataFrame]:
    """Product counts, price census, and the local list with prices from the floor history of the price job."""
    goods, local = source("goods"), source("local_prices")
    matched = prices.local_price_match(local, source("floor_history"), source("province_map"))
    return {
        "product_counts": parts.product_count_salted(goods),
        "price_census": parts.price_by_quality_group(goods),
        "local_prices": prices.local_price_update(local, matched),
    }


#: Standing tables that a day or a month is added to, with the columns that its rows replace as a whole.
STANDING = {
    "daily_scorecard": ["stat_date"], "vehicle_scorecard": ["stat_date"], "manager_scorecard": ["stat_date"],
    "shop_detail": ["year", "month"], "active_shops": ["year", "month"], "bonus_table": ["year", "month"],
}


def publish_all(tables: Mapping[str, DataFrame], folder: str, date: dt.date | None = None) -> None:
    """Write the finished tables of a job.

    Rows of a standing table replace those of their day or month and leave the others, so days accumulate. With a
    ``date``, its day or month is replaced also where the job found nothing, and every table moves to its new state in
    one step (see ``sources.versions``); read such tables with ``published``. Without one, a partition for which a
    rerun has no row keeps its old rows. Other tables replace their snapshot; such a one may be computed from the old
    one, so without a date it goes to a folder of its own run.
    """
    for name, table in tables.items():
        columns = STANDING.get(name, [])
        if date is None:
            publish(table, f"{folder}/{name}", columns or None)
        else:
            known = {"stat_date": date, "year": date.year, "month": date.month}
            publish_parts(table, f"{folder}/{name}", columns, [{c: known[c] for c in columns}])


def published(spark: SparkSession, folder: str) -> Source:
    """Source of the tables that ``publish_all`` wrote with a date."""
    return lambda name: read_parts(spark, f"{folder}/{name}")
