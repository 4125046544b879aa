"""The jobs chained over the smallest data folder, through written tables."""

import datetime as dt
from collections import Counter

import pytest

from gearledger.functions import predicates as P
from gearledger.operators import managers, parts, prices
from gearledger.plans import jobs
from gearledger.sources import views as V
from gearledger.sources.tables import Tables, publish
from tests.conftest import SMALL

DATE = dt.date(1998, 3, 31)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    t = Tables(spark, SMALL)
    folder = str(tmp_path_factory.mktemp("published"))
    month = (DATE.year, DATE.month)
    makers = {
        "orders": V.orders, "track": V.track, "city_map": V.city_map, "core_users": V.core_users,
        "settlement": V.settlement, "sales_users": V.sales_users, "user_areas": V.user_areas,
        "region_users": V.region_users, "region_provinces": V.region_provinces,
        "targets": lambda t: V.targets(t, month, month), "shop_managers": V.shop_managers,
        "order_items": V.parts, "sold_parts": V.parts, "brand_map": V.brand_map, "list_prices": V.list_prices,
        "damage": V.damage, "damage_parts": V.damage_parts, "product_info": V.product_info, "goods": V.goods,
        "offers": V.offers, "base_parts": V.base_parts, "local_prices": V.local_prices,
        "province_map": V.province_map,
        "price_history": lambda t: prices.with_brand_code(
            prices.price_history(P.clean_price_rows(V.parts(t), end="1998-03-30")), V.brand_map(t)),
        "price_ledger": lambda t: prices.close_days(prices.day_sums(
            P.clean_price_rows(V.parts(t), end="1998-03-30")), "1998-03-30"),
        "floor_history": lambda t: prices.with_brand_code(prices.lowest_per_key(
            V.parts(t).where("deliver_time < '1998-03-31'"), prices.KEYS, "sale_price").selectExpr(
            *prices.KEYS, "part_oe AS oe", "sale_price", "province AS sale_province", "deliver_time"), V.brand_map(t)),
        "base_part_table": lambda t: parts.base_part_table(
            parts.inquiry_alias_parts(V.damage(t), V.damage_parts(t), V.product_info(t)).limit(0),
            parts.goods_daily_upload(V.goods(t)).limit(0), parts.offer_brands(V.offers(t)).limit(0)),
        "order_items_priced": lambda t: prices.order_item_enriched(V.parts(t), V.brand_map(t), V.list_prices(t)).limit(0),
    }

    def source(name):
        if name in makers:
            return makers[name](t)
        return spark.read.parquet(f"{folder}/{name}")

    return source, folder, spark


def test_daily_tables_feed_the_bonus_table(run):
    source, folder, spark = run
    day_before = DATE - dt.timedelta(days=1)
    for date in (day_before, DATE, DATE):
        jobs.publish_all(jobs.business_job(source, date), folder)
    scores = spark.read.parquet(f"{folder}/manager_scorecard")
    assert {r[0] for r in scores.select("stat_date").distinct().collect()} == {day_before, DATE}
    both_days = managers.manager_scorecard(
        source("orders"), source("track"), source("settlement"), source("city_map"), day_before, DATE)
    assert Counter(map(tuple, scores.select(both_days.columns).collect())) == Counter(map(tuple, both_days.collect()))
    assert spark.read.parquet(f"{folder}/daily_scorecard").select("stat_date").distinct().count() == 2
    jobs.publish_all(jobs.bonus_job(source, DATE), folder)
    table = spark.read.parquet(f"{folder}/bonus_table")
    assert table.count() == 13 and table.where("position = '00' AND level_name = 'M0'").count() > 0


def test_price_job_updates_the_snapshot(run):
    source, folder, spark = run
    before = source("price_history").count()
    out = jobs.price_job(source, DATE)
    publish(out["price_history"], f"{folder}/new_history")
    after = spark.read.parquet(f"{folder}/new_history")
    sold = out["order_items_priced"].count()
    assert sold > 0 and after.count() >= before
    old_sales = source("price_history").agg({"sale_times": "sum"}).first()[0]
    batch_rows = V.parts(Tables(spark, SMALL)).where(
        "deliver_time = '1998-03-31' AND temp_oe <> '' AND temp_oe NOT LIKE 'JY%' AND sale_price > 5").count()
    assert after.agg({"sale_times": "sum"}).first()[0] == old_sales + batch_rows
    assert after.where("brand_code IS NULL").count() == 0
    # The same day again, on what the first run published: nothing is counted twice.
    publish(out["price_ledger"], f"{folder}/new_ledger")
    new = {"price_history": after, "price_ledger": spark.read.parquet(f"{folder}/new_ledger")}
    again = jobs.price_job(lambda name: new.get(name) or source(name), DATE)
    assert Counter(again["price_history"].collect()) == Counter(after.collect())
    assert Counter(again["price_ledger"].collect()) == Counter(new["price_ledger"].collect())
    publish(out["floor_history"], f"{folder}/new_floor")
    floor = spark.read.parquet(f"{folder}/new_floor")
    assert floor.count() >= source("floor_history").count()
    matched = prices.local_price_match(source("local_prices"), floor, source("province_map"))
    sold_parts = floor.where("quality_type IN ('1', '2') AND sale_price <> 0").select("brand_code", "temp_oe").distinct()
    listed = matched.join(source("local_prices"), "id").select("standard_brand_code", "oe").distinct()
    assert 0 < listed.count() and matched.count() >= sold_parts.count()


def test_alias_and_catalogue_jobs(run):
    source, _, _ = run
    alias = jobs.alias_job(source, dt.date(1998, 3, 16))
    assert alias["alias_parts"].count() > 0 and alias["goods_parts"].count() > 0
    assert alias["base_part_table"].select("data_source").distinct().count() == 2
    assert jobs.alias_job(source, dt.date(2024, 1, 5))["offer_brands"].count() > 0
    catalogue = jobs.catalogue_job(source)
    assert all(df.count() > 0 for df in catalogue.values())
