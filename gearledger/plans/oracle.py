"""Checking SQL: for every named query the equivalent statement over the base tables.

The statements are written on their own, mostly with other techniques than the operators
(full outer joins, window ranks, self joins), so that both sides can disagree.
"""

from __future__ import annotations

import re

from gearledger.plans import registry as Q

# Domain tables. Each text may use other v_ names; they become common table expressions.
VIEWS: dict[str, str] = {}

VIEWS["v_place"] = """
SELECT n_nationkey, r_name AS province, n_name AS city FROM nation JOIN region ON n_regionkey = r_regionkey"""

VIEWS["v_order_dates"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate,
  CAST(o_orderdate AS DATE) AS payment_date,
  CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 7 AS INTEGER) END AS deliver_date,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0
    THEN CAST(o_orderdate AS DATE) + CAST(10 + o_orderkey % 20 AS INTEGER) END AS refund_date
FROM orders"""

VIEWS["v_orders_base"] = """
SELECT o_orderkey AS id, o_orderkey AS order_id, province, city, o_custkey AS repair_id, c_name AS repair_name,
  CAST(c_nationkey AS BIGINT) * 4 + c_custkey % 4 AS manager_id,
  CASE WHEN o_orderpriority <> '5-LOW' THEN '1' ELSE '0' END AS is_b2b,
  CASE WHEN c_mktsegment IN ('AUTOMOBILE','MACHINERY','BUILDING') THEN '1' ELSE '0' END AS is_picc,
  CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '0' END AS is_fbj,
  CASE WHEN o_orderpriority = '1-URGENT' THEN '05' ELSE '01' END AS payment_type,
  CASE o_orderkey % 3 WHEN 0 THEN '1' WHEN 1 THEN '0' ELSE '9' END AS vehicle_type,
  CASE o_orderstatus WHEN 'F' THEN '700' WHEN 'O' THEN '500' ELSE '600' END AS order_status,
  CAST(o_totalprice AS DECIMAL(11,2)) AS order_amount,
  CAST(CAST(o_totalprice AS DECIMAL(11,2)) * CAST(0.80 AS DECIMAL(3,2)) AS DECIMAL(11,2)) AS purchase_amount,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_totalprice AS DECIMAL(11,2)) ELSE CAST(0 AS DECIMAL(11,2)) END AS oem_amount,
  deliver_date, refund_date, payment_date
FROM v_order_dates JOIN customer ON o_custkey = c_custkey JOIN v_place ON c_nationkey = n_nationkey"""

VIEWS["v_orders"] = """
SELECT id, order_id, province, city, repair_id, repair_name, manager_id, 'Manager#' || manager_id AS manager_name,
  is_b2b, is_picc, is_fbj, payment_type, vehicle_type, order_status, order_amount, purchase_amount, oem_amount,
  CASE WHEN refund_date IS NOT NULL THEN order_amount END AS refund_amount,
  CASE WHEN refund_date IS NOT NULL THEN purchase_amount END AS refund_purchase_amount,
  CASE WHEN refund_date IS NOT NULL THEN oem_amount END AS refund_oem_amount,
  deliver_date, refund_date, payment_date
FROM v_orders_base"""

VIEWS["v_b2b"] = "SELECT * FROM v_orders WHERE is_b2b = '1'"

VIEWS["v_track"] = """
SELECT l_orderkey AS order_id, city, deliver_date, CAST(l_shipdate AS DATE) AS operate_date,
  '0' || (l_linenumber % 5) AS operate_code, CAST(l_extendedprice AS DECIMAL(11,2)) AS amount,
  GREATEST(CAST(l_shipdate AS DATE), deliver_date) AS stat_date
FROM lineitem JOIN v_orders ON l_orderkey = order_id
WHERE deliver_date IS NOT NULL"""

VIEWS["v_track_all"] = """
SELECT l_orderkey AS order_id, deliver_date, '0' || (l_linenumber % 5) AS operate_code,
  CAST(l_extendedprice AS DECIMAL(11,2)) AS amount
FROM lineitem JOIN v_order_dates ON l_orderkey = o_orderkey"""

VIEWS["v_settlement"] = """
SELECT l_orderkey AS order_id, l_suppkey AS supplier_id, CAST(l_shipdate AS DATE) AS stat_date,
  CAST(CAST(l_extendedprice AS DECIMAL(11,2)) * CAST(0.05 AS DECIMAL(2,2)) AS DECIMAL(13,4)) AS amount,
  o_orderdate AS received
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'"""

VIEWS["v_city_map"] = """
SELECT n_name AS city_code, 'NATION_' || (n_nationkey % 20) AS business_city_code
FROM nation WHERE n_nationkey % 9 <> 0"""

VIEWS["v_users"] = """
SELECT c_custkey AS user_id, c_name AS shop_name, province, city
FROM customer JOIN v_place ON c_nationkey = n_nationkey"""

VIEWS["v_months"] = """
SELECT CAST(m // 12 AS INTEGER) AS year, CAST(m % 12 + 1 AS INTEGER) AS month FROM (
  SELECT unnest(range(lo * 12, (hi + 1) * 12)) AS m FROM (
    SELECT year(MIN(payment_date)) AS lo, year(GREATEST(MAX(payment_date), MAX(deliver_date))) AS hi FROM v_order_dates) y) t"""

VIEWS["v_supplier"] = """
SELECT s_suppkey, s_name, r_name, r_regionkey,
  CASE s_suppkey % 5 WHEN 0 THEN '00' WHEN 1 THEN '01' WHEN 2 THEN '02' WHEN 3 THEN '03' ELSE '05' END AS pos
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

VIEWS["v_area"] = """
SELECT s_suppkey AS user_id, CASE WHEN s_suppkey % 10 = 0 THEN '01' ELSE pos END AS position, r_name AS province
FROM v_supplier"""

VIEWS["v_region_user"] = """
SELECT s_suppkey AS user_id, s_name AS name, r_regionkey % 2 + 1 AS region_id FROM v_supplier WHERE s_suppkey % 5 = 0"""

VIEWS["v_region_province"] = """
SELECT r_regionkey % 2 + 1 AS region_id, r_name AS province, r_regionkey < 2 AS responsible FROM region"""

VIEWS["v_target"] = """
SELECT year, month, r_name AS province,
  CASE WHEN r_regionkey = 3 AND month = 6 THEN NULL ELSE CAST(r_regionkey * 1000000 AS DECIMAL(11,2)) END AS selfop_target,
  CASE WHEN r_regionkey = 4 THEN NULL ELSE CAST(500000 AS DECIMAL(11,2)) END AS married_target
FROM region CROSS JOIN v_months"""

VIEWS["v_stats"] = """
SELECT dt, province, manager_id, SUM(so) AS so, SUM(mo) AS mo, SUM(sa) AS sa, SUM(ma) AS ma FROM (
  SELECT deliver_date AS dt, province, manager_id,
    CASE WHEN is_fbj = '1' THEN order_amount ELSE 0 END AS so, CASE WHEN is_fbj = '0' THEN order_amount ELSE 0 END AS mo,
    0 AS sa, 0 AS ma
  FROM v_b2b WHERE is_picc = '1' AND deliver_date IS NOT NULL
  UNION ALL
  SELECT payment_date, province, manager_id, 0, 0,
    CASE WHEN is_fbj = '1' THEN order_amount ELSE 0 END, CASE WHEN is_fbj = '0' THEN order_amount ELSE 0 END
  FROM v_b2b WHERE is_picc = '1') u
WHERE manager_id <> 0 GROUP BY dt, province, manager_id"""

VIEWS["v_province_month"] = """
SELECT CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month, province,
  CAST(SUM(so + mo) AS DECIMAL(28,2)) AS amount_picc, CAST(SUM(sa + ma) AS DECIMAL(28,2)) AS amount_actual_picc,
  CAST(SUM(so) AS DECIMAL(28,2)) AS amount_picc_selfop, CAST(SUM(sa) AS DECIMAL(28,2)) AS amount_actual_picc_selfop
FROM v_stats GROUP BY 1, 2, 3"""

VIEWS["v_manager_month"] = """
SELECT CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month, manager_id,
  CAST(SUM(so + mo) AS DECIMAL(28,2)) AS amount_picc, CAST(SUM(sa + ma) AS DECIMAL(28,2)) AS amount_actual_picc
FROM v_stats GROUP BY 1, 2, 3"""

VIEWS["v_shop_orders"] = """
SELECT DISTINCT repair_id AS shop_id, CAST(year(deliver_date) AS INTEGER) AS year,
  CAST(month(deliver_date) AS INTEGER) AS month
FROM v_b2b WHERE is_picc = '1' AND order_amount >= 500 AND deliver_date IS NOT NULL"""

VIEWS["v_base_shops"] = """
SELECT shop_id, shop_name, province, city, m.year, m.month
FROM v_months m JOIN v_users u ON TRUE JOIN (SELECT shop_id, year, MIN(month) AS f FROM v_shop_orders GROUP BY 1, 2) o
  ON o.shop_id = u.user_id AND o.year = m.year AND f <= CASE WHEN m.month = 1 THEN 1 ELSE m.month - 1 END"""

VIEWS["v_repeat_shops"] = """
SELECT b.* FROM v_base_shops b JOIN v_shop_orders o USING (shop_id, year, month)"""

VIEWS["v_active"] = """
SELECT COALESCE(a.year, b.year) AS year, COALESCE(a.month, b.month) AS month, COALESCE(a.province, b.province) AS province,
  COALESCE(prev, 0) AS prev, COALESCE(cur, 0) AS cur
FROM (SELECT year, month, province, COUNT(*) AS prev FROM v_base_shops GROUP BY 1, 2, 3) a
FULL JOIN (SELECT year, month, province, COUNT(DISTINCT shop_id) AS cur FROM v_repeat_shops GROUP BY 1, 2, 3) b
  ON a.year = b.year AND a.month = b.month AND a.province = b.province"""

# Parts
VIEWS["v_part"] = r"""
SELECT *, regexp_replace(part_oe, '([+-/~.# ]|\\[s*])', '', 'g') AS temp_oe,
  'B' || lpad(substr(p_brand, 7), 3, '0') AS code
FROM (SELECT *, CASE WHEN p_partkey % 45 = 1 THEN '' ELSE
    (CASE WHEN p_partkey % 20 = 0 THEN 'JY' ELSE 'OE' END) || '-' || (p_partkey // 4) || '.' || (p_size % 3) END AS part_oe
  FROM part) p"""

VIEWS["v_parts"] = """
SELECT l_orderkey * 10 + l_linenumber AS orderitem_id, 'VIN' || l_orderkey AS vinno, p_brand AS car_brand, part_oe, temp_oe,
  CASE WHEN p_size % 2 = 0 THEN '1' ELSE '2' END AS quality_type, p_name AS part_name,
  CAST(s_nationkey AS VARCHAR) AS province,
  CAST(floor(l_extendedprice / 1000) AS DECIMAL(11,2)) AS sale_price, CAST(l_shipdate AS DATE) AS deliver_time
FROM lineitem JOIN v_part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""

VIEWS["v_clean"] = """
SELECT * FROM v_parts WHERE temp_oe <> '' AND temp_oe NOT LIKE 'JY%' AND car_brand <> '' AND sale_price > 5"""

_BATCH = f"DATE '{Q.PRICE_BATCH_START}'"
VIEWS["v_before"] = f"SELECT * FROM v_clean WHERE deliver_time < {_BATCH}"
VIEWS["v_batch"] = f"SELECT * FROM v_clean WHERE deliver_time >= {_BATCH}"

for _name, _source in (("before", "v_before"), ("batch", "v_batch")):
    for _kind, _direction in (("low", "ASC"), ("high", "DESC")):
        VIEWS[f"v_{_name}_{_kind}"] = f"""
SELECT car_brand, temp_oe, quality_type, province, part_oe, sale_price, deliver_time FROM (
  SELECT *, row_number() OVER (PARTITION BY car_brand, temp_oe, quality_type
    ORDER BY sale_price {_direction}, deliver_time DESC, province, part_oe) AS rn FROM {_source}) r WHERE rn = 1"""


def ratio2(x: str) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,6)), 2) AS DECIMAL(18,2))"


VIEWS["v_before_avg"] = f"""
SELECT car_brand, temp_oe, quality_type, {ratio2("CAST(SUM(sale_price) AS DOUBLE) / COUNT(*)")} AS avg_sale_price,
  COUNT(*) AS sale_times FROM v_before GROUP BY 1, 2, 3"""

VIEWS["v_min_merge"] = """
SELECT b.car_brand || b.temp_oe || b.quality_type AS pid, b.car_brand, b.temp_oe, b.quality_type, b.part_oe AS oe,
  CASE WHEN keep THEN h.sale_price ELSE b.sale_price END AS min_sale_price,
  CASE WHEN keep THEN h.province ELSE b.province END AS min_sale_province,
  CASE WHEN keep THEN h.deliver_time ELSE b.deliver_time END AS min_sale_deliver_time
FROM (SELECT b.*, COALESCE(h.sale_price <= b.sale_price AND h.deliver_time >= b.deliver_time - 90, FALSE) AS keep
  FROM v_batch_low b LEFT JOIN v_before_low h USING (car_brand, temp_oe, quality_type)) b
LEFT JOIN v_before_low h USING (car_brand, temp_oe, quality_type)"""

VIEWS["v_brand_map"] = "SELECT DISTINCT p_brand AS name, code FROM v_part"
VIEWS["v_list_price"] = """
SELECT code, temp_oe, MIN(CAST(p_retailprice AS DECIMAL(11,2))) AS price FROM v_part
WHERE temp_oe <> '' GROUP BY 1, 2"""

VIEWS["v_goods"] = """
SELECT 'G' || l_orderkey || '-' || l_linenumber AS goodsCode, CASE WHEN p_partkey % 40 <> 3 THEN p_name END AS partsName,
  p_name AS suppPartsName, part_oe AS suppPartsOe, temp_oe AS partsOe, p_type AS vehicleType, p_brand AS brand,
  CASE WHEN l_linestatus = 'F' THEN '1' ELSE '0' END AS status, '0' || (l_linenumber % 4 + 1) AS originSource,
  CAST(CASE WHEN p_partkey % 30 = 7 THEN 0 ELSE p_retailprice END AS DECIMAL(11,2)) AS partsPrice,
  CASE p_type WHEN 'STANDARD' THEN '原厂件' WHEN 'PROMO' THEN '流通原厂件' ELSE '品牌件' END AS qualityType,
  CAST(s_nationkey AS VARCHAR) AS provinceCode
FROM lineitem JOIN v_part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"""

VIEWS["v_products"] = """
SELECT * FROM v_goods WHERE status = '1' AND originSource IN ('01','02','03') AND partsPrice <> 0"""

# Ratings
VIEWS["v_rated"] = """
SELECT o_orderkey AS id,
  CASE o_orderkey % 6 WHEN 0 THEN '00' WHEN 1 THEN '01' WHEN 2 THEN '02' WHEN 3 THEN '03' WHEN 4 THEN '05' ELSE '09' END AS position,
  CAST(CAST(o_totalprice AS DECIMAL(11,2)) * 80 AS DECIMAL(18,2)) AS amount,
  CAST(CAST(o_orderkey % 6000 AS DECIMAL(11,4)) * 0.01 AS DECIMAL(11,2)) AS repeat_rate,
  CAST(round(CAST(o_orderkey % 6000 AS DECIMAL(11,4)) * 0.025, 2) AS DECIMAL(11,2)) AS completion
FROM orders"""


def sales_class(position: str, amount: str) -> str:
    return f"""CASE {position}
  WHEN '01' THEN CASE WHEN {amount} <= 6000000 THEN '1.1' WHEN {amount} <= 10000000 THEN '1.2'
    WHEN {amount} <= 15000000 THEN '2.1' WHEN {amount} <= 20000000 THEN '2.2' ELSE '3' END
  WHEN '02' THEN CASE WHEN {amount} <= 10000000 THEN '2' WHEN {amount} <= 20000000 THEN '3' WHEN {amount} <= 30000000 THEN '4' ELSE '5' END
  WHEN '05' THEN CASE WHEN {amount} <= 10000000 THEN '2' WHEN {amount} <= 20000000 THEN '3' WHEN {amount} <= 30000000 THEN '4' ELSE '5' END
  WHEN '03' THEN CASE WHEN {amount} <= 850000 THEN '1' WHEN {amount} <= 1500000 THEN '2' WHEN {amount} <= 3000000 THEN '3'
    WHEN {amount} <= 6000000 THEN '4' ELSE '5' END
  ELSE '0' END"""


def class_name(position: str, cls: str) -> str:
    return (f"CASE {position} WHEN '00' THEN 'M0' WHEN '01' THEN 'M' || left({cls}, 1) "
            f"WHEN '03' THEN 'S' || {cls} ELSE 'O' || {cls} END")


def bonus_ratio(position: str, cls: str) -> str:
    return f"""CAST(CASE
  WHEN {position} = '00' THEN 0.012
  WHEN {position} = '01' THEN CASE {cls} WHEN '1.1' THEN 0.025 WHEN '1.2' THEN 0.028 WHEN '2.1' THEN 0.032 WHEN '2.2' THEN 0.035 ELSE 0.038 END
  WHEN {position} = '02' THEN CASE {cls} WHEN '2' THEN 0.016 WHEN '3' THEN 0.018 WHEN '4' THEN 0.020 WHEN '5' THEN 0.022 ELSE 0 END
  WHEN {position} = '05' THEN CASE {cls} WHEN '2' THEN 0.014 WHEN '3' THEN 0.015 WHEN '4' THEN 0.016 WHEN '5' THEN 0.017 ELSE 0 END
  ELSE 0 END AS DOUBLE)"""


def selfop_ratio(cls: str) -> str:
    return f"CAST(CASE {cls} WHEN '1' THEN 0.07 WHEN '2' THEN 0.11 WHEN '3' THEN 0.15 WHEN '4' THEN 0.17 ELSE 0.18 END AS DOUBLE)"


def brokered_ratio(cls: str) -> str:
    return f"CAST(CASE {cls} WHEN '1' THEN 0.04 WHEN '2' THEN 0.08 WHEN '3' THEN 0.10 WHEN '4' THEN 0.12 ELSE 0.14 END AS DOUBLE)"


def repeat_factor(rate: str) -> str:
    return f"CAST(CASE WHEN {rate} >= 40 THEN 1.0 WHEN {rate} >= 35 THEN 0.9 WHEN {rate} >= 25 THEN 0.8 ELSE 0.7 END AS DOUBLE)"


def selfop_factor(c: str) -> str:
    return f"CAST(CASE WHEN {c} >= 110 THEN 1.1 ELSE 1.0 END AS DOUBLE)"


def brokered_factor(c: str) -> str:
    return (f"CASE WHEN {c} >= 100 THEN CAST(1.0 AS DOUBLE) "
            f"ELSE GREATEST(CAST({c} AS DOUBLE) / CAST(100 AS DOUBLE), CAST(0.6 AS DOUBLE)) END")


def total(x: str, condition: str | None = None) -> str:
    body = f"SUM({x})" if condition is None else f"SUM(CASE WHEN {condition} THEN {x} END)"
    return f"CAST(COALESCE({body}, 0) AS DECIMAL(28,2))"


def ex_tax(x: str, rate: str = "1.13") -> str:
    return ratio2(f"CAST({x} AS DOUBLE) / CAST({rate} AS DOUBLE)")


_CHANNELS = {
    "picc_selfop": "is_picc = '1' AND is_fbj = '1'", "picc_married": "is_picc = '1' AND is_fbj = '0'",
    "nonpicc_selfop": "is_picc = '0' AND is_fbj = '1'", "nonpicc_married": "is_picc = '0' AND is_fbj = '0'",
}


def channels(prefix: str, x: str) -> str:
    return ", ".join(f"{total(x, c)} AS {prefix}_{n}" for n, c in _CHANNELS.items())


def _outer(left: str, right: str, keys: list[str], columns: list[str]) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    head = ", ".join(f"COALESCE(a.{k}, b.{k}) AS {k}" for k in keys)
    return f"SELECT {head}, {', '.join(columns)} FROM ({left}) a FULL JOIN ({right}) b ON {on}"


_DAY = ["stat_date", "province", "city"]


def _delivery_side(date: str, prefix: str) -> str:
    amount, purchase = prefix + "order_amount", "purchase_amount"
    if prefix:
        amount, purchase = "refund_amount", "refund_purchase_amount"
    return f"""SELECT {date} AS stat_date, province, city, COUNT(id) AS no_b2b_order,
  COUNT(CASE WHEN is_picc = '1' THEN id END) AS no_picc_order,
  {total(amount)} AS amount_b2b, {total(purchase)} AS amount_purchase, {total(amount, "is_picc = '1'")} AS amount_picc,
  {channels("amount", amount)}, {total(amount, "is_picc = '1' AND payment_type = '05'")} AS amount_picc_direct,
  {ex_tax(total(amount, "is_fbj = '1'"))} AS amount_income
FROM v_b2b WHERE {date} IS NOT NULL GROUP BY 1, 2, 3"""


_DELIVERY = ["amount_b2b", "amount_purchase", "amount_picc", *[f"amount_{c}" for c in _CHANNELS], "amount_picc_direct"]


def _net(columns: list[str], dtype: str = "DECIMAL(28,2)") -> list[str]:
    return [f"CAST(COALESCE(a.{c}, 0) - COALESCE(b.{c}, 0) AS {dtype}) AS {c}" for c in columns]


VIEWS["v_delivery_net"] = _outer(
    _delivery_side("deliver_date", ""), _delivery_side("refund_date", "refund_"), _DAY,
    ["COALESCE(a.no_b2b_order, 0) AS no_b2b_order", "COALESCE(a.no_picc_order, 0) AS no_picc_order",
     *_net(_DELIVERY), *_net(["amount_income"], "DECIMAL(18,2)")])

VIEWS["v_receipts"] = f"""
SELECT stat_date, o.province, o.city, COUNT(DISTINCT o.order_id) AS no_actual_order, {total("amount")} AS actual_b2b,
  {total("purchase_amount")} AS actual_purchase, COUNT(CASE WHEN is_picc = '1' THEN 1 END) AS no_actual_picc_order,
  {total("amount", "is_picc = '1'")} AS actual_picc, {channels("actual", "amount")},
  {total("amount", "vehicle_type = '1'")} AS actual_passenger, {total("amount", "vehicle_type = '0'")} AS actual_commercial,
  {total("amount", "is_picc = '1' AND payment_type = '05'")} AS actual_picc_direct,
  {ex_tax(total("amount", "is_fbj = '1'"))} AS actual_income
FROM v_track t JOIN v_b2b o ON t.order_id = o.order_id
WHERE CASE WHEN operate_code IN ('03','04') THEN o.deliver_date >= DATE '{Q.BROKER_TERM_START}' ELSE TRUE END
GROUP BY 1, 2, 3"""
_RECEIPTS = ["no_actual_order", "actual_b2b", "actual_purchase", "no_actual_picc_order", "actual_picc",
             *[f"actual_{c}" for c in _CHANNELS], "actual_passenger", "actual_commercial", "actual_picc_direct",
             "actual_income"]

VIEWS["v_paid"] = f"""
SELECT payment_date AS stat_date, province, city, COUNT(id) AS no_paid_order, {total("order_amount")} AS amount_paid,
  {total("order_amount", "is_picc = '1'")} AS amount_paid_picc
FROM v_b2b WHERE payment_date IS NOT NULL GROUP BY 1, 2, 3"""


def _mix_side(date: str, amount: str, oem: str) -> str:
    return f"""SELECT {date} AS stat_date, province, city, {total(oem)} AS amount_oem,
  CAST(COALESCE(SUM({amount}) - SUM({oem}), 0) AS DECIMAL(28,2)) AS amount_afm,
  {total(amount, "vehicle_type = '1'")} AS amount_passenger, {total(amount, "vehicle_type = '0'")} AS amount_commercial,
  {total(amount, "vehicle_type = '9'")} AS amount_other, {total(oem, "vehicle_type = '1'")} AS amount_passenger_oem,
  {total(oem, "vehicle_type = '0'")} AS amount_commercial_oem,
  {total(f"{amount} - {oem}", "vehicle_type = '1'")} AS amount_passenger_afm,
  {total(f"{amount} - {oem}", "vehicle_type = '0'")} AS amount_commercial_afm
FROM v_b2b WHERE {date} IS NOT NULL GROUP BY 1, 2, 3"""


_MIX = ["amount_oem", "amount_afm", "amount_passenger", "amount_commercial", "amount_other", "amount_passenger_oem",
        "amount_commercial_oem", "amount_passenger_afm", "amount_commercial_afm"]
VIEWS["v_mix"] = _outer(
    _mix_side("deliver_date", "order_amount", "oem_amount"),
    _mix_side("refund_date", "refund_amount", "refund_oem_amount"), _DAY, _net(_MIX))

_OPEN = {"paid_not_delivered": "TRUE", **{f"{n}_not_delivered": c for n, c in _CHANNELS.items()}}
_OPEN_SUMS = ", ".join(f"{total('order_amount', c)} AS {n}" for n, c in _OPEN.items())
VIEWS["v_open_daily"] = f"""
SELECT payment_date, province, city, {_OPEN_SUMS} FROM v_b2b
WHERE order_status IN ('500','600') AND payment_date IS NOT NULL GROUP BY 1, 2, 3"""
VIEWS["v_open"] = """
SELECT CAST(d.stat_date AS DATE) AS stat_date, province, city, """ + ", ".join(
    f"CAST(SUM({n}) AS DECIMAL(28,2)) AS {n}" for n in _OPEN) + """
FROM (SELECT unnest(generate_series((SELECT date_trunc('year', MIN(payment_date)) FROM v_open_daily),
    (SELECT CAST(MAX(payment_date) AS TIMESTAMP) FROM v_open_daily), INTERVAL 1 DAY)) AS stat_date) d
JOIN v_open_daily o ON o.payment_date >= date_trunc('year', d.stat_date) AND o.payment_date <= d.stat_date
GROUP BY 1, 2, 3"""

_GRAIN = ["stat_date", "province", "city", "manager_id", "manager_name"]


def _manager_measures(prefix: str, x: str) -> str:
    return f"{total(x)} AS {prefix}_b2b, {channels(prefix, x)}"


def _manager_side(date: str, amount: str, where: str) -> str:
    return f"""SELECT {date} AS stat_date, province, business_city_code AS city, manager_id, manager_name,
  {_manager_measures("delivered", amount)}
FROM v_b2b JOIN v_city_map ON city = city_code WHERE {where} GROUP BY 1, 2, 3, 4, 5"""


_MANAGER_NET = ["delivered_b2b", *[f"delivered_{c}" for c in _CHANNELS]]
_REFUND_OK = f"""refund_date IS NOT NULL AND payment_date IS NOT NULL AND NOT (payment_date >= DATE '{Q.REFUND_STATE_START}'
  AND COALESCE(order_status, '') NOT IN ('700','701'))"""
VIEWS["v_manager_net"] = _outer(
    _manager_side("deliver_date", "order_amount", "deliver_date IS NOT NULL"),
    _manager_side("refund_date", "refund_amount", _REFUND_OK), _GRAIN, _net(_MANAGER_NET))

VIEWS["v_manager_actual"] = f"""
SELECT stat_date, o.province, business_city_code AS city, manager_id, manager_name, {_manager_measures("actual", "amount")}
FROM v_track t JOIN v_b2b o ON t.order_id = o.order_id JOIN v_city_map m ON o.city = m.city_code
WHERE t.city IN (SELECT city_code FROM v_city_map) GROUP BY 1, 2, 3, 4, 5"""
_MANAGER_ACTUAL = ["actual_b2b", *[f"actual_{c}" for c in _CHANNELS]]


def _service(city: str) -> str:
    def charge(x: str) -> str:
        return ex_tax(f"CAST(COALESCE(SUM({x}), 0) AS DECIMAL(28,4))", "1.06")
    return f"""SELECT stat_date, province, {city} AS city, manager_id, manager_name, {charge("amount")} AS service_charge,
  {charge(f"CASE WHEN received < TIMESTAMP '{Q.SERVICE_BONUS_START}' THEN 0 ELSE amount END")} AS bonus_service_charge
FROM v_settlement s JOIN v_orders o ON s.order_id = o.order_id LEFT JOIN v_city_map ON city = city_code
WHERE COALESCE(supplier_id, 0) <> {Q.EXCLUDED_SUPPLIER} GROUP BY 1, 2, 3, 4, 5"""


VIEWS["v_service"] = _service("city")
VIEWS["v_service_mapped"] = _service("COALESCE(business_city_code, city)")


def _fill(side: str, columns: list[str]) -> list[str]:
    return [f"COALESCE({side}.{c}, 0) AS {c}" for c in columns]


# Bonus
VIEWS["v_staff"] = """
  SELECT s.s_suppkey AS user_id, lower(s.s_name) AS fr_username, s.s_name AS name, a.position, a.province
  FROM v_supplier s LEFT JOIN v_area a ON a.user_id = s.s_suppkey
  WHERE s.s_suppkey % 13 <> 0 AND s.pos <> '00' AND s.s_suppkey % 17 <> 0
  UNION
  SELECT s.s_suppkey, lower(s.s_name), s.s_name, '00', p.province
  FROM v_supplier s JOIN v_region_user u ON u.user_id = s.s_suppkey JOIN v_region_province p ON p.region_id = u.region_id"""
VIEWS["v_roster"] = """
SELECT user_id, fr_username, name, position, province, year, month, CAST(0.7 AS DOUBLE) AS repeat_shop_factor
FROM v_staff r CROSS JOIN v_months"""

VIEWS["v_regular_sum"] = """
SELECT r.user_id, r.name, r.position, r.year, r.month,
  CAST(SUM(COALESCE(amount_picc, 0)) AS DECIMAL(28,2)) AS amount_picc,
  CAST(SUM(COALESCE(amount_actual_picc, 0)) AS DECIMAL(28,2)) AS amount_actual_picc
FROM v_roster r LEFT JOIN v_province_month p ON p.province = r.province AND p.year = r.year AND p.month = r.month
WHERE r.position IN ('00','01','02','05') GROUP BY 1, 2, 3, 4, 5"""
VIEWS["v_regular"] = f"""
SELECT *, {bonus_ratio("position", "sales_class")} AS bonus_ratio, {class_name("position", "sales_class")} AS sales_class_name
FROM (SELECT *, {sales_class("position", "amount_actual_picc")} AS sales_class FROM v_regular_sum) x"""

VIEWS["v_parttime"] = f"""
SELECT user_id, name, province, year, month, amount_picc, amount_actual_picc, {bonus_ratio("position", "cls")} AS bonus_ratio
FROM (SELECT u.user_id, u.name, a.province, a.position, year, month, amount_picc, amount_actual_picc,
    {sales_class("a.position", "amount_actual_picc")} AS cls
  FROM v_region_user u JOIN v_area a ON a.user_id = u.user_id JOIN v_province_month p ON p.province = a.province
  WHERE u.user_id % 4 <> 0 AND a.user_id % 11 <> 0) x"""

VIEWS["v_customer_manager"] = f"""
SELECT *, {selfop_ratio("sales_class")} AS selfop_bonus_ratio, {brokered_ratio("sales_class")} AS married_bonus_ratio,
  {class_name("position", "sales_class")} AS sales_class_name
FROM (SELECT *, {sales_class("position", "amount_actual_picc")} AS sales_class FROM (
  SELECT DISTINCT r.user_id, r.name, r.position, r.year, r.month,
    CAST(COALESCE(amount_picc, 0) AS DECIMAL(28,2)) AS amount_picc,
    CAST(COALESCE(amount_actual_picc, 0) AS DECIMAL(28,2)) AS amount_actual_picc
  FROM v_roster r LEFT JOIN v_manager_month m ON m.manager_id = r.user_id AND m.year = r.year AND m.month = r.month
  WHERE r.position = '03') a) x"""

_REPEAT = ratio2("CAST(cur AS DOUBLE) / CAST(nullif(prev, 0) AS DOUBLE) * 100")


def _factors(complete: str, repeat: str) -> str:
    return (f"{selfop_factor(complete)} AS selfop_factor, {brokered_factor(complete)} AS married_factor, "
            f"{repeat_factor(repeat)} AS repeat_shop_factor")


def _complete(actual: str, target: str) -> str:
    percent = ratio2(f"CAST({actual} AS DOUBLE) / CAST(nullif({target}, 0) AS DOUBLE) * 100")
    return f"CASE WHEN {target} = 0 THEN CAST(100 AS DECIMAL(18,2)) ELSE {percent} END"


VIEWS["v_province_factors"] = f"""
SELECT province, year, month, complete_ratio, repeat_ratio, {_factors("complete_ratio", "repeat_ratio")} FROM (
  SELECT p.province, p.year, p.month,
    {_complete("amount_actual_picc_selfop", "COALESCE(selfop_target, 1)")} AS complete_ratio,
    COALESCE({_REPEAT}, 0) AS repeat_ratio
  FROM v_province_month p
  LEFT JOIN v_target t ON t.province = p.province AND t.year = p.year AND t.month = p.month
  LEFT JOIN v_active s ON s.province = p.province AND s.year = p.year AND s.month = p.month) x"""

VIEWS["v_weighted"] = f"""
SELECT user_id, year, month, {ratio2("SUM(CAST(completion * weight AS DECIMAL(28,12))) * 100")} AS complete_ratio,
  {ratio2("SUM(CAST(repeat * weight AS DECIMAL(28,12))) * 100")} AS repeat_ratio
FROM (
  SELECT rp.region_id, t.year, t.month,
    CAST(COALESCE(amount_actual_picc_selfop, 0) AS DOUBLE) / CAST(nullif(COALESCE(selfop_target, 0), 0) AS DOUBLE) AS completion,
    CASE WHEN prev = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(cur AS DOUBLE) / CAST(nullif(prev, 0) AS DOUBLE) END AS repeat,
    CAST(COALESCE(selfop_target, 0) + COALESCE(married_target, 0) AS DOUBLE)
      / CAST(nullif(SUM(COALESCE(selfop_target, 0) + COALESCE(married_target, 0)) OVER (PARTITION BY rp.region_id, t.year, t.month), 0) AS DOUBLE) AS weight
  FROM v_target t JOIN v_region_province rp ON rp.province = t.province AND NOT rp.responsible
  LEFT JOIN v_province_month p ON p.province = t.province AND p.year = t.year AND p.month = t.month
  LEFT JOIN v_active s ON s.province = t.province AND s.year = t.year AND s.month = t.month) x
JOIN v_region_user u ON u.region_id = x.region_id AND u.user_id % 4 <> 0
GROUP BY user_id, year, month"""

VIEWS["v_region_factors"] = f"""
SELECT region_id, province, user_id, year, month, complete_ratio, repeat_ratio, {_factors("complete_ratio", "repeat_ratio")} FROM (
  SELECT CAST(u.region_id AS BIGINT) AS region_id, rp.province, u.user_id, m.year, m.month,
    COALESCE(CASE WHEN rp.responsible THEN {_complete("COALESCE(amount_actual_picc_selfop, 0)", "selfop_target")}
      ELSE w.complete_ratio END, 0) AS complete_ratio,
    COALESCE(CASE WHEN rp.responsible THEN {_REPEAT} ELSE w.repeat_ratio END, 0) AS repeat_ratio
  FROM v_region_user u JOIN v_region_province rp ON rp.region_id = u.region_id CROSS JOIN v_months m
  LEFT JOIN v_target t ON t.province = rp.province AND t.year = m.year AND t.month = m.month
  LEFT JOIN v_active s ON s.province = rp.province AND s.year = m.year AND s.month = m.month
  LEFT JOIN v_province_month p ON p.province = rp.province AND p.year = m.year AND p.month = m.month
  LEFT JOIN v_weighted w ON w.user_id = u.user_id AND w.year = m.year AND w.month = m.month
  WHERE u.user_id % 4 <> 0 AND u.user_id % 13 <> 0) x"""

VIEWS["v_manager_repeat"] = f"""
SELECT *, {repeat_factor("repeat_ratio")} AS repeat_shop_factor FROM (
  SELECT manager_id, year, month, COALESCE({ratio2("CAST(SUM(r) AS DOUBLE) / CAST(nullif(SUM(b), 0) AS DOUBLE) * 100")}, 0) AS repeat_ratio
  FROM (SELECT shop_id, year, month, 0 AS r, 1 AS b FROM v_base_shops
    UNION ALL SELECT shop_id, year, month, 1, 0 FROM v_repeat_shops) d
  JOIN (SELECT c_custkey, CAST(c_nationkey AS BIGINT) * 4 + c_custkey % 4 AS manager_id FROM customer) c ON c.c_custkey = d.shop_id
  GROUP BY 1, 2, 3) x"""


def _price_merge(kind: str, names: tuple[str, str, str], keep: str) -> str:
    columns = ", ".join(
        f"CASE WHEN {keep} THEN h.{c} ELSE b.{c} END AS {n}"
        for c, n in zip(("sale_price", "province", "deliver_time"), names))
    return f"""SELECT b.car_brand || b.temp_oe || b.quality_type AS pid, b.car_brand, b.temp_oe, b.quality_type,
  b.part_oe AS oe, {columns}
FROM v_batch_{kind} b LEFT JOIN v_before_{kind} h
  ON h.car_brand = b.car_brand AND h.temp_oe = b.temp_oe AND h.quality_type = b.quality_type"""


_KEEP = "h.sale_price IS NOT NULL AND h.sale_price {} b.sale_price AND h.deliver_time >= {}"

_ORDER_COLUMNS = """id, order_id, province, city, repair_id, repair_name, manager_id, manager_name, is_b2b, is_picc,
  is_fbj, payment_type, vehicle_type, order_status, order_amount, purchase_amount, oem_amount, refund_amount,
  refund_purchase_amount, refund_oem_amount, deliver_date, refund_date, payment_date"""

_REPORT = """, province || city || strftime(stat_date, '%Y%m%d') AS pid, strftime(stat_date, '%Y%m') AS yr_mth"""
_OE_REGEX = r"'([+-/~.# ]|\\[s*])', '', 'g'"

_POINT = "regexp_replace(p_name || '#' || p_brand || '~+1,2', " + _OE_REGEX + ")"

ORACLES: dict[str, str] = {
    "scan_orders": f"SELECT {_ORDER_COLUMNS} FROM v_orders",
    "id_bounds": "SELECT MIN(o_orderkey) AS lower_bound, MAX(o_orderkey) AS upper_bound FROM orders",
    "bounds_from_footers": """
SELECT COUNT(*) AS n_rows, MIN(o_orderkey) AS min_o_orderkey, MAX(o_orderkey) AS max_o_orderkey,
  MIN(o_custkey) AS min_o_custkey, MAX(o_custkey) AS max_o_custkey FROM orders""",
    "orders_by_ranges": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "brand_code_list": "SELECT DISTINCT code AS standard_brand_code FROM v_brand_map",
    "province_name_lookup": """
SELECT s_suppkey, CAST(s_nationkey AS VARCHAR) AS code, COALESCE(n_name, '') AS province_name,
  COALESCE(lower(n_name), '') AS province_pinyin,
  COALESCE(n_name, '') AS name_by_pinyin
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "brand_code_lookup": """
SELECT p_partkey, p_brand, COALESCE(code, '') AS brand_code FROM part LEFT JOIN v_brand_map ON p_brand = name""",
    "upsert_price_history": """
SELECT COALESCE(h.car_brand, m.car_brand) AS car_brand, COALESCE(h.temp_oe, m.temp_oe) AS temp_oe,
  COALESCE(h.quality_type, m.quality_type) AS quality_type, g.code AS brand_code, COALESCE(h.part_oe, m.oe) AS oe,
  COALESCE(m.min_sale_price, h.sale_price) AS min_sale_price,
  COALESCE(m.min_sale_province, h.province) AS min_sale_province,
  COALESCE(m.min_sale_deliver_time, h.deliver_time) AS min_sale_deliver_time,
  x.sale_price AS max_sale_price, x.province AS max_sale_province, x.deliver_time AS max_sale_deliver_time,
  a.avg_sale_price, a.sale_times
FROM v_before_low h FULL JOIN v_min_merge m
  ON h.car_brand = m.car_brand AND h.temp_oe = m.temp_oe AND h.quality_type = m.quality_type
LEFT JOIN v_before_high x ON x.car_brand = h.car_brand AND x.temp_oe = h.temp_oe AND x.quality_type = h.quality_type
LEFT JOIN v_before_avg a ON a.car_brand = h.car_brand AND a.temp_oe = h.temp_oe AND a.quality_type = h.quality_type
LEFT JOIN v_brand_map g ON g.name = COALESCE(h.car_brand, m.car_brand)""",
    "insert_if_absent": f"""
WITH tgt AS (SELECT * FROM v_clean WHERE deliver_time <= DATE '{Q.ITEM_TARGET_END}'),
upd AS (SELECT *, row_number() OVER (PARTITION BY orderitem_id
    ORDER BY car_brand, temp_oe, quality_type, province, sale_price, deliver_time) AS rn
  FROM v_clean WHERE deliver_time >= DATE '{Q.ITEM_UPDATE_START}')
SELECT orderitem_id, car_brand, temp_oe, quality_type, province, sale_price, deliver_time FROM tgt
UNION ALL SELECT orderitem_id, car_brand, temp_oe, quality_type, province, sale_price, deliver_time
FROM upd WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.orderitem_id = upd.orderitem_id)""",
    "update_bonus_columns": f"""
WITH picc AS (SELECT manager_id, order_amount, deliver_date, payment_date FROM v_b2b WHERE is_picc = '1' AND manager_id <> 0),
sold AS (SELECT manager_id, year(deliver_date) AS y, month(deliver_date) AS m, SUM(order_amount) AS amount
  FROM picc WHERE deliver_date IS NOT NULL GROUP BY 1, 2, 3),
got AS (SELECT manager_id, year(payment_date) AS y, month(payment_date) AS m, SUM(order_amount) AS amount
  FROM picc GROUP BY 1, 2, 3),
rows AS MATERIALIZED (SELECT user_id, position, province, year, month, CASE WHEN position = '03' THEN user_id END AS manager
  FROM v_staff CROSS JOIN v_months),
full_rows AS (SELECT r.*, CAST(COALESCE(s.amount, 0) AS DECIMAL(28,2)) AS sold, COALESCE(g.amount, 0) AS got
  FROM rows r LEFT JOIN sold s ON s.manager_id = r.manager AND s.y = r.year AND s.m = r.month
  LEFT JOIN got g ON g.manager_id = r.manager AND g.y = r.year AND g.m = r.month)
SELECT user_id, position, province, year, month, CASE WHEN position = '03' THEN sold END AS personal_picc_amount,
  CASE WHEN position = '03' THEN {sales_class("position", "got")} END AS manager_level FROM full_rows""",
    "manager_scorecard": _outer(
        _outer("SELECT * FROM v_manager_net", "SELECT * FROM v_manager_actual", _GRAIN,
               _fill("a", _MANAGER_NET) + _fill("b", _MANAGER_ACTUAL)),
        "SELECT * FROM v_service_mapped", _GRAIN,
        _fill("a", _MANAGER_NET + _MANAGER_ACTUAL) + _fill("b", ["service_charge", "bonus_service_charge"])),
    "filter_b2b": "SELECT id, province, city, order_amount, payment_date FROM v_b2b",
    "effective_receipt_date": "SELECT order_id, operate_code, operate_date, deliver_date, stat_date, amount FROM v_track",
    "valid_refunds": f"""
SELECT id, order_status, payment_date, refund_date, refund_amount FROM v_orders WHERE {_REFUND_OK}""",
    "broker_term_cutoff": f"""
SELECT order_id, operate_code, deliver_date, amount FROM v_track_all
WHERE CASE WHEN operate_code IN ('03','04') THEN deliver_date >= DATE '{Q.BROKER_TERM_START}' ELSE TRUE END""",
    "clean_price_rows": "SELECT * FROM v_clean",
    "valid_products": """
SELECT goodsCode, originSource, brand AS carTypeBrandName, qualityType, partsOe, provinceCode, partsPrice FROM v_products""",
    "join_inner_dim": """
SELECT id, province, city, business_city_code, order_amount FROM v_orders JOIN v_city_map ON city = city_code""",
    "join_left_dim": """
SELECT orderitem_id, car_brand, code AS standard_brand_code, temp_oe, sale_price
FROM v_clean LEFT JOIN v_brand_map ON car_brand = name""",
    "join_full_outer_net": _outer(
        """SELECT deliver_date AS stat_date, province, city, SUM(order_amount) AS amount, SUM(purchase_amount) AS purchase
FROM v_orders WHERE deliver_date IS NOT NULL GROUP BY 1, 2, 3""",
        """SELECT refund_date AS stat_date, province, city, SUM(refund_amount) AS amount, SUM(refund_purchase_amount) AS purchase
FROM v_orders WHERE refund_date IS NOT NULL GROUP BY 1, 2, 3""", _DAY, _net(["amount", "purchase"])),
    **{f"arg_{how}_ties": f"""
SELECT car_brand, temp_oe, quality_type, sale_price, province, deliver_time, part_oe FROM (
  SELECT *, rank() OVER (PARTITION BY car_brand, temp_oe, quality_type ORDER BY sale_price {direction}) AS rk FROM v_clean) r
WHERE rk = 1""" for how, direction in (("min", "ASC"), ("max", "DESC"))},
    "history_left_join": """
SELECT b.car_brand, b.temp_oe, b.quality_type, b.batch_price, h.price AS old_price
FROM (SELECT car_brand, temp_oe, quality_type, MIN(sale_price) AS batch_price FROM v_batch GROUP BY 1, 2, 3) b
LEFT JOIN (SELECT car_brand, temp_oe, quality_type, MIN(sale_price) AS price FROM v_before GROUP BY 1, 2, 3) h
  ON b.car_brand = h.car_brand AND b.temp_oe = h.temp_oe AND b.quality_type = h.quality_type""",
    "pid_key": """
SELECT id, province || city || strftime(payment_date, '%Y%m%d') AS city_pid,
  province || CAST(payment_date AS VARCHAR) AS province_pid FROM v_orders""",
    "income_ex_tax": f"""
SELECT payment_date, province, {ex_tax(total("order_amount", "is_fbj = '1'"))} AS income FROM v_orders GROUP BY 1, 2""",
    "business_calendar": """
SELECT d, CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end,
  CAST(date_trunc('month', d) - INTERVAL 1 DAY AS DATE) AS previous_month_end,
  CAST(date_trunc('year', d) AS DATE) AS year_start, CAST(d - INTERVAL 1 YEAR AS DATE) AS same_day_last_year,
  CAST(d - INTERVAL 90 DAY AS DATE) AS ninety_days_before, CAST(d + INTERVAL 1 DAY AS DATE) AS day_after,
  CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m, CAST(day(d) AS INTEGER) AS dd
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x""",
    "clean_part_number": f"SELECT p_partkey, part_oe, temp_oe, {_POINT} AS cleaned_name FROM v_part",
    "quality_group": """
SELECT goodsCode, qualityType, CASE WHEN vehicleType IN ('STANDARD','PROMO') THEN '原厂件' ELSE '品牌件' END AS quality FROM v_goods""",
    "sales_class": f"""
SELECT id, position, amount, {sales_class("position", "amount")} AS sales_class,
  CASE WHEN position <> '03' THEN {sales_class("position", "amount")}
    WHEN amount <= 850000 THEN '1' WHEN amount > 8500000 AND amount <= 1500000 THEN '2'
    WHEN amount > 1500001 AND amount <= 3000000 THEN '3' WHEN amount > 3000001 AND amount <= 6000000 THEN '4' ELSE '5' END AS literal_class
FROM v_rated""",
    **{name: f"SELECT id, position, sales_class, {expr} AS {column} FROM (SELECT *, {sales_class('position', 'amount')} AS sales_class FROM v_rated) x"
       for name, column, expr in (
           ("sales_class_name", "class_name", class_name("position", "sales_class")),
           ("bonus_ratio", "ratio", bonus_ratio("position", "sales_class")),
           ("manager_selfop_ratio", "ratio", selfop_ratio("sales_class")),
           ("manager_brokered_ratio", "ratio", brokered_ratio("sales_class")))},
    "repeat_shop_factor": f"SELECT id, repeat_rate, {repeat_factor('repeat_rate')} AS factor FROM v_rated",
    "completion_selfop_factor": f"SELECT id, completion, {selfop_factor('completion')} AS factor FROM v_rated",
    "completion_brokered_factor": f"SELECT id, completion, {brokered_factor('completion')} AS factor FROM v_rated",
    "daily_delivery_net": "SELECT * FROM v_delivery_net",
    "daily_actual_receipts": "SELECT * FROM v_receipts",
    "daily_paid": "SELECT * FROM v_paid",
    "daily_scorecard": "SELECT *" + _REPORT + " FROM (" + _outer(
        _outer("SELECT * FROM v_delivery_net", "SELECT * FROM v_receipts", _DAY,
               _fill("a", ["no_b2b_order", "no_picc_order", *_DELIVERY, "amount_income"]) + _fill("b", _RECEIPTS)),
        "SELECT * FROM v_paid", _DAY,
        _fill("a", ["no_b2b_order", "no_picc_order", *_DELIVERY, "amount_income", *_RECEIPTS])
        + _fill("b", ["no_paid_order", "amount_paid", "amount_paid_picc"])) + ") z",
    "vehicle_part_mix_net": "SELECT * FROM v_mix",
    "paid_not_delivered": "SELECT * FROM v_open",
    "vehicle_scorecard": "SELECT *" + _REPORT + " FROM (" + _outer(
        "SELECT * FROM v_mix", "SELECT * FROM v_open", _DAY, _fill("a", _MIX) + _fill("b", list(_OPEN))) + ") z",
    "repeat_base_shops": "SELECT shop_id, shop_name, province, city, year, month FROM v_base_shops",
    "repeat_base_by_city": "SELECT year, month, province, city, COUNT(*) AS no_shop FROM v_base_shops GROUP BY 1, 2, 3, 4",
    "repeat_base_by_province": "SELECT year, month, province, COUNT(*) AS no_shop FROM v_base_shops GROUP BY 1, 2, 3",
    "repeat_shops_this_month": "SELECT shop_id, shop_name, province, city, year, month FROM v_repeat_shops",
    "repeat_by_city": """
SELECT year, month, province, city, COUNT(DISTINCT shop_id) AS no_shop FROM v_repeat_shops GROUP BY 1, 2, 3, 4""",
    "repeat_by_province": """
SELECT year, month, province, COUNT(DISTINCT shop_id) AS no_shop FROM v_repeat_shops GROUP BY 1, 2, 3""",
    "repeat_shops_from_bitmaps": """
SELECT 'city' AS level, year, month, province, city, COUNT(DISTINCT shop_id) AS no_shop FROM v_repeat_shops GROUP BY ALL
UNION ALL SELECT 'province', year, month, province, NULL, COUNT(DISTINCT shop_id) FROM v_repeat_shops GROUP BY ALL
UNION ALL SELECT 'year_to_date', year, CAST(later AS INTEGER), province, NULL, COUNT(DISTINCT shop_id)
FROM v_repeat_shops JOIN (SELECT unnest(range(1, 13)) AS later) m ON later >= month GROUP BY ALL""",
    "manager_delivery_net": "SELECT * FROM v_manager_net",
    "manager_actual_receipts": "SELECT * FROM v_manager_actual",
    "service_charge_by_manager": "SELECT * FROM v_service",
    "bonus_roster": "SELECT * FROM v_roster",
    "province_channel_totals": "SELECT year, month, province, amount_picc, amount_actual_picc FROM v_province_month",
    "manager_channel_totals": "SELECT year, month, manager_id, amount_picc, amount_actual_picc FROM v_manager_month",
    "province_selfop_totals": """
SELECT year, month, province, amount_picc_selfop, amount_actual_picc_selfop FROM v_province_month""",
    "bonus_regular_staff": "SELECT * FROM v_regular",
    "bonus_parttime_provincial": "SELECT * FROM v_parttime",
    "bonus_customer_manager": "SELECT * FROM v_customer_manager",
    "province_completion_factors": "SELECT * FROM v_province_factors",
    "region_weighted_completion": "SELECT * FROM v_weighted",
    "region_bonus_factors": "SELECT * FROM v_region_factors",
    "manager_repeat_rate": "SELECT * FROM v_manager_repeat",
    "bonus_table": """
SELECT r.user_id, r.fr_username, r.name, r.position, r.province, r.year, r.month,
  CASE WHEN f.user_id IS NOT NULL AND (q.manager_id IS NULL OR r.position <> '03') THEN f.repeat_shop_factor
    WHEN r.position = '03' AND q.manager_id IS NOT NULL THEN q.repeat_shop_factor
    WHEN r.position IN ('01','02','05') AND p.province IS NOT NULL THEN p.repeat_shop_factor
    ELSE r.repeat_shop_factor END AS repeat_shop_factor,
  COALESCE(g.amount_picc, c.amount_picc) AS personal_picc_amount,
  COALESCE(g.amount_actual_picc, c.amount_actual_picc) AS personal_picc_actual_amount,
  COALESCE(h.bonus_ratio, g.bonus_ratio, c.married_bonus_ratio) AS married_profit_bonus_ratio,
  COALESCE(h.bonus_ratio, g.bonus_ratio, c.selfop_bonus_ratio) AS selfop_profit_bonus_ratio,
  COALESCE(g.sales_class, c.sales_class) AS manager_level, COALESCE(g.sales_class_name, c.sales_class_name) AS level_name,
  COALESCE(f.complete_ratio, p.complete_ratio) AS picc_selfop_completion,
  CASE WHEN r.position = '03' AND q.manager_id IS NOT NULL THEN q.repeat_ratio WHEN f.user_id IS NOT NULL THEN f.repeat_ratio
    WHEN r.position <> '03' THEN p.repeat_ratio END AS this_repeat_rate,
  COALESCE(f.selfop_factor, p.selfop_factor) AS selfop_profit_factor,
  COALESCE(f.married_factor, p.married_factor) AS married_profit_factor
FROM v_roster r
LEFT JOIN v_regular g ON g.user_id = r.user_id AND g.position = r.position AND g.year = r.year AND g.month = r.month
LEFT JOIN (SELECT *, '00' AS at_position FROM v_parttime) h ON h.at_position = r.position AND h.user_id = r.user_id AND h.province = r.province AND h.year = r.year AND h.month = r.month
LEFT JOIN (SELECT *, '03' AS at_position FROM v_customer_manager) c
  ON c.at_position = r.position AND c.user_id = r.user_id AND c.year = r.year AND c.month = r.month
LEFT JOIN v_province_factors p
  ON p.province = CASE WHEN r.position IN ('01','02','03','05') THEN r.province END AND p.year = r.year AND p.month = r.month
LEFT JOIN v_region_factors f ON f.user_id = r.user_id AND f.province = r.province AND f.year = r.year AND f.month = r.month
LEFT JOIN (SELECT *, '03' AS at_position FROM v_manager_repeat) q ON q.at_position = r.position AND q.manager_id = r.user_id AND q.year = r.year AND q.month = r.month""",
    "price_floor_merge": _price_merge(
        "low", ("sale_price", "sale_province", "deliver_time"),
        _KEEP.format("<=", "CAST(b.deliver_time - INTERVAL 1 YEAR AS DATE)")),
    "price_min_merge": "SELECT * FROM v_min_merge",
    "price_max_merge": _price_merge(
        "high", ("max_sale_price", "max_sale_province", "max_sale_deliver_time"),
        _KEEP.format(">", "b.deliver_time - 90")),
    "price_avg_merge": f"""
SELECT b.car_brand || b.temp_oe || b.quality_type AS pid, b.car_brand, b.temp_oe, b.quality_type, b.oe,
  {ratio2("CASE WHEN h.avg_sale_price IS NULL THEN s / n ELSE (CAST(h.avg_sale_price AS DOUBLE) * h.sale_times + s) / (h.sale_times + n) END")} AS avg_sale_price,
  COALESCE(h.sale_times, 0) + n AS sale_times
FROM (SELECT car_brand, temp_oe, quality_type, MIN(part_oe) AS oe, CAST(SUM(sale_price) AS DOUBLE) AS s, COUNT(*) AS n
  FROM v_batch GROUP BY 1, 2, 3) b
LEFT JOIN v_before_avg h ON h.car_brand = b.car_brand AND h.temp_oe = b.temp_oe AND h.quality_type = b.quality_type""",
    "order_item_enriched": """
SELECT r.*, m.code AS standard_brand_code, p.price AS sys_manufacture_price
FROM v_clean r LEFT JOIN v_brand_map m ON r.car_brand = m.name
LEFT JOIN v_list_price p ON p.code = m.code AND p.temp_oe = r.temp_oe""",
    "local_price_match": """
SELECT l.p_partkey AS id, CAST(COALESCE(o.sale_price, 0) AS DECIMAL(11,2)) AS oem_sale_price,
  COALESCE('NATION_' || o.province, '') AS oem_sale_province_name,
  CAST(COALESCE(a.sale_price, 0) AS DECIMAL(11,2)) AS afm_sale_price,
  COALESCE('NATION_' || a.province, '') AS afm_sale_province_name
FROM v_part l
LEFT JOIN (SELECT code, f.* FROM v_floor f JOIN v_brand_map ON car_brand = name) o
  ON o.code = l.code AND o.temp_oe = l.temp_oe AND o.quality_type = '1'
LEFT JOIN (SELECT code, f.* FROM v_floor f JOIN v_brand_map ON car_brand = name) a
  ON a.code = l.code AND a.temp_oe = l.temp_oe AND a.quality_type = '2'
WHERE COALESCE(o.sale_price, 0) <> 0 OR COALESCE(a.sale_price, 0) <> 0""",
    "add_price_columns": "SELECT p_partkey AS id, code AS standard_brand_code, part_oe AS oe, " + ", ".join(
        f"CAST(0 AS DECIMAL(11,2)) AS {p}_{k}_price" for p in Q.PRICE_PROVINCES for k in ("oem", "afm")) + " FROM v_part",
    "inquiry_alias_parts": """
SELECT DISTINCT l_orderkey * 10 + l_linenumber AS part_id, i.p_name AS standard_part_name, p.p_name AS part_name,
  p.part_oe, c_mktsegment AS car_type
FROM lineitem JOIN v_part p ON l_partkey = p.p_partkey JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN v_part i ON i.temp_oe = p.temp_oe AND i.p_partkey % 40 <> 3
WHERE p.part_oe <> '' AND p.part_oe NOT LIKE 'JY%' AND o_orderkey % 11 <> 0""",
    "offer_brand_list": """
SELECT stat_date, user_id * 10 + 1 AS id, string_agg(event_type, ',' ORDER BY event_type) AS part_brand
FROM (SELECT DISTINCT CAST(ts AS DATE) AS stat_date, user_id, event_type FROM events
  WHERE event_id % 7 <> 0 AND event_id % 4 <> 0 AND user_id % 5 <> 0) x GROUP BY 1, 2""",
    "goods_daily_upload": """
SELECT goodsCode, partsName, suppPartsName, suppPartsOe, vehicleType, brand AS partsBrandName
FROM v_goods WHERE partsName IS NOT NULL AND status = '1'""",
    "product_count_salted": """
SELECT provinceCode, originSource, brand AS carTypeBrandName, qualityType, COUNT(*) AS no_products
FROM v_products GROUP BY 1, 2, 3, 4""",
    "price_by_quality_group": """
SELECT brand AS carTypeBrandName, CASE WHEN qualityType IN ('原厂件','流通原厂件') THEN '原厂件' ELSE '品牌件' END AS qualityType,
  partsOe, provinceCode, CAST(MIN(partsPrice) AS DECIMAL(10,2)) AS min_part_price,
  CAST(SUM(partsPrice) AS DOUBLE) / COUNT(partsPrice) AS average_part_price
FROM v_products GROUP BY 1, 2, 3, 4""",
}

VIEWS["v_floor"] = """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY car_brand, temp_oe, quality_type
  ORDER BY sale_price, deliver_time DESC, province, part_oe) AS rn FROM v_parts WHERE temp_oe <> '') r WHERE rn = 1"""


_PLAIN_MAX_MERGE = ORACLES["price_max_merge"]
_ALL_AVERAGES = f"""
SELECT car_brand, temp_oe, quality_type, {ratio2("CAST(SUM(sale_price) AS DOUBLE) / COUNT(*)")} AS avg_sale_price,
  COUNT(*) AS sale_times FROM v_clean GROUP BY 1, 2, 3"""
for _name in ("price_floor_merge", "price_min_merge", "price_max_merge", "price_avg_merge"):
    ORACLES[_name] = f"SELECT p.*, g.code AS brand_code FROM ({ORACLES[_name]}) p LEFT JOIN v_brand_map g ON g.name = p.car_brand"

ORACLES["price_snapshot"] = f"""
SELECT k.car_brand, k.temp_oe, k.quality_type, g.code AS brand_code, COALESCE(lo.part_oe, m.oe) AS oe,
  COALESCE(m.min_sale_price, lo.sale_price) AS min_sale_price, COALESCE(m.min_sale_province, lo.province) AS min_sale_province,
  COALESCE(m.min_sale_deliver_time, lo.deliver_time) AS min_sale_deliver_time,
  COALESCE(x.max_sale_price, hi.sale_price) AS max_sale_price, COALESCE(x.max_sale_province, hi.province) AS max_sale_province,
  COALESCE(x.max_sale_deliver_time, hi.deliver_time) AS max_sale_deliver_time, k.avg_sale_price, k.sale_times
FROM ({_ALL_AVERAGES}) k LEFT JOIN v_before_low lo USING (car_brand, temp_oe, quality_type)
LEFT JOIN v_before_high hi USING (car_brand, temp_oe, quality_type)
LEFT JOIN v_min_merge m USING (car_brand, temp_oe, quality_type)
LEFT JOIN ({_PLAIN_MAX_MERGE}) x USING (car_brand, temp_oe, quality_type)
LEFT JOIN v_brand_map g ON g.name = k.car_brand"""
ORACLES["upsert_bucketed_history"] = ORACLES["upsert_price_history"]
ORACLES["insert_small_batch"] = ORACLES["insert_if_absent"]
ORACLES["rules_in_sql"] = f"""
SELECT id, cls AS class, {class_name("position", "cls")} AS class_name, {bonus_ratio("position", "cls")} AS ratio,
  {selfop_ratio("cls")} AS selfop_ratio, {brokered_ratio("cls")} AS brokered_ratio,
  {repeat_factor("repeat_rate")} AS repeat_factor, {selfop_factor("completion")} AS selfop_factor,
  {brokered_factor("completion")} AS brokered_factor, replace(position || cls, '.', '') AS cleaned
FROM (SELECT *, {sales_class("position", "amount")} AS cls FROM v_rated) x"""
ORACLES["price_average_from_ledger"] = _ALL_AVERAGES
ORACLES["scorecard_from_event_log"] = ORACLES["daily_scorecard"]

ORACLES["manager_stats_two_days"] = ORACLES["manager_scorecard"]

ORACLES["complementary_scorecard"] = "SELECT *" + _REPORT + " FROM (" + _outer(
    _outer("SELECT * FROM v_mix", "SELECT * FROM v_open", _DAY, _fill("a", _MIX) + _fill("b", list(_OPEN))),
    """SELECT last_day(make_date(year, month, 1)) AS stat_date, province, city,
  CAST(SUM(base) AS BIGINT) AS repeat_purchase_shop_previous, CAST(SUM(again) AS BIGINT) AS repeat_purchase_shop
FROM (SELECT year, month, province, city, 1 AS base, 0 AS again FROM v_base_shops
  UNION ALL SELECT year, month, province, city, 0, 1 FROM v_repeat_shops) s GROUP BY 1, 2, 3""",
    _DAY, _fill("a", [*_MIX, *_OPEN]) + _fill("b", ["repeat_purchase_shop_previous", "repeat_purchase_shop"])) + ") z"

ORACLES["local_price_update"] = f"""
SELECT l.p_partkey AS id, l.code AS standard_brand_code, l.part_oe AS oe, m.oem_sale_price AS min_oem_price,
  m.oem_sale_province_name AS min_oem_province, m.afm_sale_price AS min_afm_price,
  m.afm_sale_province_name AS min_afm_province
FROM v_part l LEFT JOIN ({ORACLES["local_price_match"]}) m ON m.id = l.p_partkey"""

ORACLES["base_part_table"] = f"""
SELECT CAST(i.part_id AS VARCHAR) AS part_id, i.standard_part_name, i.part_name, i.part_oe AS oe,
  i.car_type AS vehicle_type, o.part_brand, '1' AS data_source
FROM (SELECT * FROM ({ORACLES["inquiry_alias_parts"]}) a
  QUALIFY row_number() OVER (PARTITION BY part_id, standard_part_name ORDER BY part_name, part_oe, car_type) = 1) i
LEFT JOIN (
  SELECT user_id, arg_max(part_brand, stat_date) AS part_brand FROM (
    SELECT stat_date, user_id, string_agg(event_type, ',' ORDER BY event_type) AS part_brand
    FROM (SELECT DISTINCT CAST(ts AS DATE) AS stat_date, user_id, event_type FROM events
      WHERE event_id % 7 <> 0 AND event_id % 4 <> 0) d GROUP BY 1, 2) x GROUP BY 1) o ON o.user_id = i.part_id
UNION ALL
SELECT goodsCode, partsName, suppPartsName, suppPartsOe, vehicleType, partsBrandName, '2'
FROM ({ORACLES["goods_daily_upload"]}) g
QUALIFY row_number() OVER (
  PARTITION BY goodsCode, partsName ORDER BY suppPartsName, suppPartsOe, vehicleType, partsBrandName) = 1"""


def _views_of(sql: str) -> list[str]:
    """Domain tables a statement needs, each after the ones it uses itself."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"\bv_\w+", text)):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(sql)
    return ordered


def oracle_sql() -> dict[str, str]:
    out = {}
    for key, sql in ORACLES.items():
        ctes = [f"{name} AS ({VIEWS[name]})" for name in _views_of(sql)]
        body = sql.strip()
        if body.startswith("WITH "):
            body = ", " .join([*ctes, body[len("WITH "):]])
            out[key] = "WITH " + body
        else:
            out[key] = ("WITH " + ", ".join(ctes) + "\n" if ctes else "") + body
    return out
