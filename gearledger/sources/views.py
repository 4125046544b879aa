"""Domain tables expressed over the star-schema tables of a data folder.

Each function returns one of the tables the operators work on. Small dimensions are joined
without hints: the optimizer broadcasts a side whose measured size is under its threshold and
shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gearledger.functions.calendar import Month, in_months, month_index
from gearledger.functions.money import cents_if
from gearledger.functions.text import (
    BRANDED_QUALITY, CIRCULATED_ORIGINAL_QUALITY, ORIGINAL_QUALITY, clean_part_number,
)
from gearledger.operators.extremes import lowest_per_key
from gearledger.sources.tables import Tables


def _order_dates(orders: DataFrame) -> DataFrame:
    """Payment, delivery and refund day of every order."""
    return orders.selectExpr("*", "to_date(o_orderdate) AS payment_date").selectExpr(
        "*",
        "CASE WHEN o_orderstatus <> 'P' THEN date_add(payment_date, CAST(o_orderkey % 7 AS INT)) END AS deliver_date",
        """CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0
             THEN date_add(payment_date, CAST(10 + o_orderkey % 20 AS INT)) END AS refund_date""",
    )


def _places(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey", "r_name AS province", "n_name AS city")


MANAGER_ID = "CAST(c_nationkey AS BIGINT) * 4 + c_custkey % 4"


def orders(t: Tables) -> DataFrame:
    """Orders with shop, place, manager, flags, amounts and the three event days."""
    base = (
        _order_dates(t.orders)
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(_places(t), F.col("c_nationkey") == F.col("n_nationkey"))
        .selectExpr("*", "CAST(o_totalprice AS DECIMAL(11,2)) AS order_amount")
        .selectExpr(
            "*",
            "CAST(order_amount * 0.80 AS DECIMAL(11,2)) AS purchase_amount",
            "CAST(CASE WHEN o_orderkey % 4 = 0 THEN order_amount ELSE 0 END AS DECIMAL(11,2)) AS oem_amount")
    )
    return base.selectExpr(
        "o_orderkey AS id",
        "o_orderkey AS order_id",
        "province",
        "city",
        "o_custkey AS repair_id",
        "c_name AS repair_name",
        f"{MANAGER_ID} AS manager_id",
        f"concat('Manager#', {MANAGER_ID}) AS manager_name",
        "if(o_orderpriority <> '5-LOW', '1', '0') AS is_b2b",
        "if(c_mktsegment IN ('AUTOMOBILE', 'MACHINERY', 'BUILDING'), '1', '0') AS is_picc",
        "if(o_orderkey % 2 = 0, '1', '0') AS is_fbj",
        "if(o_orderpriority = '1-URGENT', '05', '01') AS payment_type",
        "CASE o_orderkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE '9' END AS vehicle_type",
        "CASE o_orderstatus WHEN 'F' THEN '700' WHEN 'O' THEN '500' ELSE '600' END AS order_status",
        "order_amount",
        "purchase_amount",
        "oem_amount",
        "if(refund_date IS NOT NULL, order_amount, NULL) AS refund_amount",
        "if(refund_date IS NOT NULL, purchase_amount, NULL) AS refund_purchase_amount",
        "if(refund_date IS NOT NULL, oem_amount, NULL) AS refund_oem_amount",
        "deliver_date",
        "refund_date",
        "payment_date",
    )


def track(t: Tables, with_city: bool = True) -> DataFrame:
    """Cash receipts of an order. The city costs two more joins, so callers that do not use it
    leave it out."""
    parents = _order_dates(t.orders).select("o_orderkey", "o_custkey", "deliver_date")
    rows = t.lineitem.join(parents, F.col("l_orderkey") == F.col("o_orderkey"))
    if with_city:
        rows = rows.join(
            t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
        ).join(_places(t), F.col("c_nationkey") == F.col("n_nationkey"))
    columns = [
        "l_orderkey AS iorder_id",
        "l_orderkey AS order_id",
        "to_date(l_shipdate) AS operate_date",
        "deliver_date",
        "concat('0', l_linenumber % 5) AS operate_code",
        "CAST(l_extendedprice AS DECIMAL(11,2)) AS amount",
    ]
    return rows.selectExpr(*columns, "city") if with_city else rows.selectExpr(*columns)


def settlement(t: Tables) -> DataFrame:
    parents = t.orders.selectExpr("o_orderkey", "o_orderdate AS order_receive_time")
    returned = t.lineitem.where("l_returnflag = 'R'")
    return returned.join(parents, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "l_orderkey AS order_id",
        "l_suppkey AS supplier_id",
        "l_shipdate AS service_charge_date",
        "CAST(CAST(l_extendedprice AS DECIMAL(11,2)) * 0.05 AS DECIMAL(13,4)) AS service_charge_amount",
        "order_receive_time",
    )


def city_map(t: Tables) -> DataFrame:
    return t.nation.selectExpr(
        "n_name AS city_code", "concat('NATION_', n_nationkey % 20) AS business_city_code",
        "if(n_nationkey % 9 <> 0, '1', '0') AS status")


def core_users(t: Tables) -> DataFrame:
    return t.customer.join(_places(t), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "c_custkey AS user_id", "c_name AS company_name", "province AS provinceCode", "city AS cityCode")


def shop_managers(t: Tables) -> DataFrame:
    return t.customer.selectExpr("c_custkey AS shop_id", f"{MANAGER_ID} AS manager_id")


# --- staff -------------------------------------------------------------------------------

POSITION = "element_at(array('00', '01', '02', '03', '05'), CAST(s_suppkey % 5 AS INT) + 1)"


def _suppliers(t: Tables) -> DataFrame:
    places = t.nation.select("n_nationkey", "n_regionkey")
    return t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey"))


def sales_users(t: Tables) -> DataFrame:
    return t.supplier.selectExpr(
        "s_suppkey AS user_id",
        "lower(s_name) AS fr_username",
        "s_name AS name",
        f"{POSITION} AS user_position",
        "if(s_suppkey % 13 <> 0, '1', '0') AS status",
        "if(s_suppkey % 5 = 0, '1', '0') AS is_region_leader",
        "if(s_suppkey % 17 = 0, '1', '0') AS is_hq",
    )


def user_areas(t: Tables) -> DataFrame:
    """Areas of the staff; every tenth key is a region head who also runs a province."""
    return _suppliers(t).selectExpr(
        "s_suppkey AS user_id",
        f"if(s_suppkey % 10 = 0, '01', {POSITION}) AS position",
        "r_name AS province",
        "if(s_suppkey % 11 <> 0, '1', '0') AS status",
    )


def region_users(t: Tables) -> DataFrame:
    return _suppliers(t).where("s_suppkey % 5 = 0").selectExpr(
        "s_suppkey AS user_id",
        "s_name AS name",
        "CAST(r_regionkey % 2 + 1 AS BIGINT) AS region_id",
        "concat('REGION_', r_regionkey % 2 + 1) AS region_name",
        "if(s_suppkey % 4 <> 0, '1', '0') AS status",
    )


def region_provinces(t: Tables) -> DataFrame:
    return t.region.selectExpr(
        "CAST(r_regionkey % 2 + 1 AS BIGINT) AS region_id", "r_name AS province",
        "if(r_regionkey < 2, '1', '0') AS is_responsible")


def order_months(t: Tables) -> tuple[Column, Column]:
    """First and last month of the whole years that hold a payment or delivery, read inside the plan."""
    days = _order_dates(t.orders)
    first = days.agg(F.year(F.min(F.least("payment_date", "deliver_date"))).alias("year"))
    last = days.agg(F.year(F.max(F.greatest("payment_date", "deliver_date"))).alias("year"))
    return month_index(first.scalar(), 1), month_index(last.scalar(), 12)


def targets(t: Tables, first: Month | Column, last: Month | Column) -> DataFrame:
    """Monthly targets, as a province-level row and a city-level row."""
    rows = in_months(t.region, first, last).withColumn("city", F.expr("explode(array('100000', '110100'))"))
    return rows.selectExpr(
        "year", "month", "r_name AS province", "city",
        """CAST(CASE WHEN r_regionkey = 3 AND month = 6 THEN NULL
             ELSE r_regionkey * 1000000 END AS DECIMAL(11,2)) AS picc_selfop_trans_target""",
        "CAST(if(r_regionkey = 4, NULL, 500000) AS DECIMAL(11,2)) AS picc_marriedDeal_trans_target")


def manager_stats(t: Tables) -> DataFrame:
    """Daily insured-channel sums per province and manager, on delivery and on payment day."""
    events = orders(t).where("is_b2b = '1' AND is_picc = '1'").selectExpr(
        "province", "manager_id", "is_fbj = '1' AS own", "CAST(order_amount * 100 AS BIGINT) AS cents",
        """explode(array(
             struct(true AS delivered, deliver_date AS dt), struct(false AS delivered, payment_date AS dt))) AS e""")
    delivered, own, x = F.col("delivered"), F.col("own"), F.col("cents")
    return events.selectExpr("*", "e.dt", "e.delivered").where("dt IS NOT NULL").groupBy(
        "dt", "province", "manager_id"
    ).agg(
        cents_if(delivered & own, x).alias("picc_selfop_order"),
        cents_if(delivered & ~own, x).alias("picc_married_order"),
        cents_if(~delivered & own, x).alias("picc_selfop_actual_order"),
        cents_if(~delivered & ~own, x).alias("picc_married_actual_order"),
    )


# --- parts -------------------------------------------------------------------------------

# Raw part number; at most four parts share one.
PART_OE = """if(p_partkey % 45 = 1, '',
  concat(if(p_partkey % 20 = 0, 'JY', 'OE'), '-', p_partkey DIV 4, '.', p_size % 3))"""
BRAND_CODE = "concat('B', lpad(substring(p_brand, 7), 3, '0'))"


def part_numbers(t: Tables) -> DataFrame:
    numbered = t.part.selectExpr("*", f"{PART_OE} AS part_oe", f"{BRAND_CODE} AS brand_code")
    return numbered.withColumn("temp_oe", clean_part_number(F.col("part_oe")))


def _sold(t: Tables) -> DataFrame:
    places = t.supplier.selectExpr("s_suppkey", "CAST(s_nationkey AS STRING) AS province")
    return t.lineitem.join(part_numbers(t), F.col("l_partkey") == F.col("p_partkey")).join(
        places, F.col("l_suppkey") == F.col("s_suppkey"))


def parts(t: Tables) -> DataFrame:
    """Sold parts with cleaned number, price and the supplier's province code."""
    return _sold(t).selectExpr(
        "l_orderkey * 10 + l_linenumber AS orderitem_id",
        "concat('VIN', l_orderkey) AS vinno",
        "p_brand AS car_brand",
        "part_oe",
        "temp_oe",
        "if(p_size % 2 = 0, '1', '2') AS quality_type",
        "p_name AS part_name",
        "province",
        "CAST(floor(l_extendedprice / 1000) AS DECIMAL(11,2)) AS sale_price",
        "to_date(l_shipdate) AS deliver_time",
    )


def brand_map(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "p_brand AS standard_brand_name", f"{BRAND_CODE} AS standard_brand_code").distinct()


def list_prices(t: Tables) -> DataFrame:
    rows = part_numbers(t).selectExpr(
        "brand_code AS standard_brand_code", "temp_oe", "CAST(p_retailprice AS DECIMAL(11,2)) AS price")
    return rows.where("temp_oe <> ''").groupBy("standard_brand_code", "temp_oe").agg(
        F.min("price").alias("sys_manufacture_price"))


def province_map(t: Tables) -> DataFrame:
    return t.nation.selectExpr(
        "CAST(n_nationkey AS STRING) AS province_code", "lower(n_name) AS province", "n_name AS province_chn")


def local_prices(t: Tables) -> DataFrame:
    return part_numbers(t).selectExpr("p_partkey AS id", "brand_code AS standard_brand_code", "part_oe AS oe")


def floor_prices(t: Tables) -> DataFrame:
    """Lowest traded price per brand, part number and quality, with the brand code."""
    lowest = lowest_per_key(parts(t).where("temp_oe <> ''"), ["car_brand", "temp_oe", "quality_type"], "sale_price")
    coded = lowest.join(brand_map(t), F.col("car_brand") == F.col("standard_brand_name"), "left")
    return coded.selectExpr(
        "concat(car_brand, temp_oe, quality_type) AS pid", "province AS sale_province",
        "standard_brand_code AS brand_code", "car_brand AS brand", "part_oe AS oe", "temp_oe",
        "quality_type", "sale_price", "deliver_time")


def goods(t: Tables) -> DataFrame:
    return _sold(t).selectExpr(
        "concat('G', l_orderkey, '-', l_linenumber) AS goodsCode",
        "if(p_partkey % 40 = 3, NULL, p_name) AS partsName",
        "p_name AS suppPartsName",
        "part_oe AS suppPartsOe",
        "temp_oe AS partsOe",
        "p_type AS vehicleType",
        "p_brand AS partsBrandName",
        "p_brand AS carTypeBrandName",
        "l_shipdate AS updateTime",
        "if(l_linestatus = 'F', '1', '0') AS status",
        "concat('0', l_linenumber % 4 + 1) AS originSource",
        "CAST(if(p_partkey % 30 = 7, 0, p_retailprice) AS DECIMAL(11,2)) AS partsPrice",
        f"""CASE p_type WHEN 'STANDARD' THEN '{ORIGINAL_QUALITY}' WHEN 'PROMO' THEN '{CIRCULATED_ORIGINAL_QUALITY}'
              ELSE '{BRANDED_QUALITY}' END AS qualityType""",
        "province AS provinceCode",
    )


def damage(t: Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", "c_mktsegment")
    return t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "o_orderkey AS damage_id", "c_mktsegment AS car_type",
        "concat(if(o_orderkey % 11 = 0, '测', '京A'), o_orderkey) AS car_no", "o_orderdate AS creat_time")


def damage_parts(t: Tables) -> DataFrame:
    return t.lineitem.join(part_numbers(t), F.col("l_partkey") == F.col("p_partkey")).selectExpr(
        "l_orderkey AS damage_id", "l_orderkey * 10 + l_linenumber AS part_id", "p_name AS part_name", "part_oe")


def product_info(t: Tables) -> DataFrame:
    return part_numbers(t).selectExpr("temp_oe AS partsOe", "if(p_partkey % 40 = 3, NULL, p_name) AS partsName")


def offers(t: Tables) -> DataFrame:
    return t.events.selectExpr(
        "user_id AS damagePartId", "if(event_id % 7 = 0, '', concat(event_type, ',')) AS remark",
        "ts AS updateTime", "if(event_id % 4 <> 0, '1', '0') AS status")


def base_parts(t: Tables) -> DataFrame:
    return t.events.select("user_id").distinct().selectExpr(
        "user_id * 10 + 1 AS id", "CAST(user_id AS STRING) AS part_id",
        "if(user_id % 5 <> 0, '1', '0') AS data_source")
