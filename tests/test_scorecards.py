import datetime as dt

from pyspark.sql import functions as F

from gearledger.operators import managers, scorecard, shops
from gearledger.operators.netting import full_outer_merge, net_full_outer
from tests.conftest import day, rows_of

TRACK = "iorder_id long, order_id long, city string, operate_code string, operate_date date, deliver_date date, amount decimal(11,2)"
CITY_MAP = "city_code string, business_city_code string, status string"


def by_city(df, *columns):
    return {r["city"]: tuple(float(r[c]) for c in columns) for r in df.collect()}


def test_delivery_netting_covers_both_sides(orders):
    df = orders(
        dict(city="both", deliver_date="2020-03-02"),
        dict(city="both", deliver_date="2020-02-01", refund_date="2020-03-02", refund_amount=30, refund_purchase_amount=20),
        dict(city="only_delivered", deliver_date="2020-03-02", is_picc="0", is_fbj="0"),
        dict(city="only_refunded", refund_date="2020-03-02", refund_amount=30, refund_purchase_amount=None),
        dict(city="not_b2b", deliver_date="2020-03-02", is_b2b="0"),
        dict(city="null_flag", deliver_date="2020-03-02", is_b2b=None),
    )
    net = scorecard.daily_delivery_net(df, "2020-03-02", "2020-03-02")
    columns = ("no_b2b_order", "amount_b2b", "amount_purchase", "amount_picc_selfop", "amount_nonpicc_married", "amount_income")
    assert by_city(net, *columns) == {
        "both": (1, 70, 60, 70, 0, 61.95),  # 100/1.13 - 30/1.13, each rounded
        "only_delivered": (1, 100, 80, 0, 100, 0),
        "only_refunded": (0, -30, 0, -30, 0, -26.55),
    }
    assert {r["stat_date"] for r in net.collect()} == {day("2020-03-02")}


def test_null_city_sides_do_not_meet(orders):
    df = orders(
        dict(city=None, deliver_date="2020-03-02"),
        dict(city=None, deliver_date="2020-03-02", refund_date="2020-03-02", refund_amount=30))
    net = scorecard.daily_delivery_net(df)
    assert sorted(float(r["amount_b2b"]) for r in net.collect()) == [-30, 200]


def test_netting_equals_full_outer_join(spark, orders):
    df = orders(*[
        dict(city=f"c{i % 5}", deliver_date=f"2020-03-0{1 + i % 4}", refund_date=f"2020-03-0{1 + i % 7}" if i % 3 else None,
             refund_amount=i if i % 3 else None, order_amount=10 * i, is_picc=str(i % 2))
        for i in range(1, 60)])
    keys = scorecard.KEYS
    forward = df.groupBy(F.col("deliver_date").alias("stat_date"), "province", "city").agg(F.sum("order_amount").alias("amount_b2b"))
    back = df.where("refund_date IS NOT NULL").groupBy(F.col("refund_date").alias("stat_date"), "province", "city").agg(
        F.sum("refund_amount").alias("amount_b2b"))
    joined = net_full_outer(forward, back, keys)
    assert rows_of(joined, *keys, "amount_b2b") == rows_of(scorecard.daily_delivery_net(df), *keys, "amount_b2b")


def test_receipts_count_orders_once(orders, table):
    df = orders(
        dict(id=1, order_id=1, deliver_date="2020-03-01"),
        dict(id=2, order_id=2, deliver_date="2019-03-01", is_fbj="0"),
        dict(id=3, order_id=3, deliver_date="2020-03-01", is_b2b="0"),
    )
    track = table(TRACK, [
        (1, 1, "C", "01", "2020-02-01", "2020-03-01", 10), (1, 1, "C", "03", "2020-03-01", "2020-03-01", 5),
        (1, 1, "C", None, "2020-03-01", "2020-03-01", 1), (1, 1, "C", "01", "2020-03-05", "2020-03-01", 7),
        (2, 2, "C", "03", "2020-03-01", "2019-03-01", 50), (2, 2, "C", "02", "2020-03-01", "2019-03-01", 20),
        (3, 3, "C", "01", "2020-03-01", "2020-03-01", 90), (1, 1, "C", "01", None, "2020-03-01", 90),
    ])
    got = scorecard.daily_actual_receipts(track, df)
    assert rows_of(got, "stat_date", "no_actual_order", "actual_b2b", "actual_purchase", "no_actual_picc_order",
                   "actual_picc_selfop", "actual_picc_married") == [
        (day("2020-03-01"), 2, 36.0, 320.0, 4, 16.0, 20.0), (day("2020-03-05"), 1, 7.0, 80.0, 1, 7.0, 0.0)]


def test_order_rows_sharing_an_order_id_count_once(orders, table):
    df = orders(dict(order_id=1, is_picc="1"), dict(order_id=1, is_picc="0"), dict(order_id=1, is_picc="0"),
                dict(order_id=1, city="other"), dict(order_id=2))
    track = table(TRACK, [(1, 1, "C", "01", "2020-03-01", "2020-03-01", 10), (1, 1, "C", "01", "2020-03-02", "2020-03-01", 4),
                          (2, 2, "C", "01", "2020-03-01", "2020-03-01", 5)])
    got = scorecard.daily_actual_receipts(track, df)
    assert sorted(rows_of(got, "stat_date", "city", "no_actual_order", "actual_b2b")) == [
        (day("2020-03-01"), "C", 2, 35.0), (day("2020-03-01"), "other", 1, 10.0),
        (day("2020-03-02"), "C", 1, 12.0), (day("2020-03-02"), "other", 1, 4.0)]


def test_scorecard_has_one_row_per_key(orders, table):
    df = orders(
        dict(city="a", deliver_date="2020-03-02", payment_date="2020-03-01"),
        dict(city="a", deliver_date="2020-03-01", payment_date="2020-03-01", refund_date="2020-03-02", refund_amount=5),
        dict(city="b", payment_date="2020-03-02"))
    track = table(TRACK, [(1, 1, "a", "01", "2020-03-02", "2020-03-02", 60), (1, 1, "a", "01", "2020-03-04", "2020-03-02", 40)])
    got = scorecard.daily_scorecard(df, track)
    keys = rows_of(got, *scorecard.KEYS)
    assert len(keys) == len(set(keys)) == 4
    row = got.where("city = 'a' AND stat_date = '2020-03-02'").first()
    assert (float(row["amount_b2b"]), float(row["actual_b2b"]), row["no_paid_order"]) == (95, 60, 0)
    assert (row["pid"], row["yr_mth"]) == ("Pa20200302", "202003")


def test_vehicle_mix(orders):
    df = orders(
        dict(vehicle_type="1", deliver_date="2020-03-02"),
        dict(vehicle_type="0", deliver_date="2020-03-02", oem_amount=None),
        dict(vehicle_type="9", deliver_date="2020-03-02"),
        dict(vehicle_type="1", refund_date="2020-03-02", refund_amount=30, refund_oem_amount=10))
    row = scorecard.vehicle_part_mix_net(df).first()
    got = [float(row[c]) for c in (
        "amount_oem", "amount_afm", "amount_passenger", "amount_commercial", "amount_other", "amount_passenger_oem",
        "amount_commercial_oem", "amount_passenger_afm", "amount_commercial_afm")]
    # all delivered 300 less oem 80, refunded 30 less oem 10; no aftermarket value for the null oem order
    assert got == [70, 200, 70, 100, 100, 30, 0, 40, 0]


def test_open_amounts_run_over_the_year(orders):
    df = orders(
        dict(payment_date="2019-12-31", order_status="500"), dict(payment_date="2020-01-02", order_status="600"),
        dict(payment_date="2020-01-05", order_status="500", is_picc="0", is_fbj="0", order_amount=7),
        dict(payment_date="2020-01-05", order_status="700"), dict(payment_date="2020-01-06", order_status="500", city="D"))
    got = scorecard.paid_not_delivered(df, "2020-01-01", "2020-01-06").where("city = 'C'")
    assert rows_of(got, "stat_date", "paid_not_delivered", "picc_selfop_not_delivered", "nonpicc_married_not_delivered") == [
        (dt.date(2020, 1, d), 100.0 if d < 5 else 107.0, 100.0, 0.0 if d < 5 else 7.0) for d in range(2, 7)]
    whole = scorecard.paid_not_delivered(df)
    assert whole.where("year(stat_date) = 2020 AND city = 'C'").count() == 5  # 2 January to the last payment
    assert whole.where("year(stat_date) = 2019").count() == 1


def test_merge_fills_zeros(table):
    a = table("k string, x long", [("p", 1), (None, 2)])
    b = table("k string, y decimal(11,2)", [("q", 3), (None, 4)])
    assert rows_of(full_outer_merge([a, b], ["k"])) == [("p", 1, 0.0), ("q", 0, 3.0), (None, 0, 4.0), (None, 2, 0.0)]


# --- managers ----------------------------------------------------------------------------

def test_managers_of_one_city_stay_apart(orders, table):
    cities = table(CITY_MAP, [("C", "BC", "1"), ("X", "BX", "0")])
    df = orders(
        dict(manager_id=1, manager_name="a", deliver_date="2020-03-02"),
        dict(manager_id=2, manager_name="b", deliver_date="2020-03-02", order_amount=50),
        dict(manager_id=2, manager_name="b", refund_date="2020-03-02", refund_amount=20),
        dict(manager_id=3, manager_name="c", refund_date="2020-03-02", refund_amount=9, order_status="500"),
        dict(manager_id=4, manager_name="d", deliver_date="2020-03-02", city="X"))
    got = managers.manager_delivery_net(df, cities)
    assert rows_of(got, "city", "manager_id", "delivered_b2b") == [("BC", 1, 100.0), ("BC", 2, 30.0)]


def test_manager_receipts(orders, table):
    cities = table(CITY_MAP, [("C", "BC", "1")])
    df = orders(dict(id=1, order_id=1), dict(id=2, order_id=2, is_fbj="0"))
    track = table(TRACK, [
        (1, 1, "C", "01", "2020-03-01", "2020-03-02", 10), (1, 1, "C", "01", "2020-03-02", "2020-03-01", 5),
        (2, 2, "C", "01", "2020-03-02", "2020-03-02", 3), (2, 2, "Z", "01", "2020-03-02", "2020-03-02", 99)])
    mapped = managers.manager_actual_receipts(track, df, cities)
    assert rows_of(mapped, "stat_date", "city", "actual_b2b", "actual_picc_selfop", "actual_picc_married") == [
        (day("2020-03-02"), "BC", 18.0, 15.0, 3.0)]
    raw = managers.manager_actual_receipts(track, df, cities, mapped_city=False)
    assert rows_of(raw, "city", "actual_b2b") == [("C", 18.0)]


def test_service_charge_day_supplier_and_bonus(orders, table):
    charges = table(
        "order_id long, supplier_id long, service_charge_date timestamp, service_charge_amount decimal(13,4), order_receive_time timestamp",
        [(1, 1, "2020-03-02 00:00:00", 106, "2019-06-30 23:59:59"), (1, None, "2020-03-02 23:59:59.5", 106, "2019-07-01 00:00:00"),
         (1, 1, "2020-03-02 10:00:00", 53, None), (1, 7550, "2020-03-02 10:00:00", 999, None),
         (1, 1, "2020-03-03 00:00:00", 10.6, "2020-01-01 00:00:00"), (1, 1, None, 5, None)])
    got = managers.service_charge_by_manager(charges, orders(dict(is_b2b="0")))
    assert rows_of(got, "stat_date", "service_charge", "bonus_service_charge") == [
        (day("2020-03-02"), 250.0, 150.0), (day("2020-03-03"), 10.0, 10.0)]
    assert managers.service_charge_by_manager(charges, orders({}), "2020-03-02", "2020-03-02").count() == 1


def test_manager_scorecard_fills_disjoint_columns(orders, table):
    cities = table(CITY_MAP, [("C", "BC", "1")])
    df = orders(dict(deliver_date="2020-03-02"))
    track = table(TRACK, [(1, 1, "C", "01", "2020-03-02", "2020-03-02", 60)])
    charges = table(
        "order_id long, supplier_id long, service_charge_date timestamp, service_charge_amount decimal(13,4), order_receive_time timestamp",
        [(1, 1, "2020-03-05 01:00:00", 106, "2020-01-01 00:00:00")])
    got = managers.manager_scorecard(df, track, charges, cities)
    assert rows_of(got, "stat_date", "city", "delivered_b2b", "actual_b2b", "service_charge") == [
        (day("2020-03-02"), "BC", 100.0, 60.0, 0.0), (day("2020-03-05"), "BC", 0.0, 0.0, 100.0)]
    stats = managers.as_manager_stats(got)
    assert rows_of(stats, "dt", "picc_selfop_order", "picc_selfop_actual_order")[0] == (day("2020-03-02"), 100.0, 60.0)


# --- shops -------------------------------------------------------------------------------

USERS = "user_id long, company_name string, provinceCode string, cityCode string"


def test_repeat_shops_by_month(orders, table):
    users = table(USERS, [(i, f"s{i}", "P", "C") for i in (1, 2, 3, 4)])
    df = orders(*[
        dict(repair_id=shop, deliver_date=d, order_amount=amount)
        for shop, d, amount in [
            (1, "2020-01-10", 500), (1, "2020-01-20", 600), (1, "2020-10-05", 700), (2, "2020-10-01", 500),
            (2, "2020-11-30", 500), (3, "2020-02-29", 499.99), (4, "2020-12-31", 500), (4, "2019-12-31", 500), (9, "2020-01-01", 900)]])
    base = shops.repeat_base_shops(df, users, 500, until="2020-12-31")
    got = rows_of(base.where("year = 2020"), "shop_id", "month")
    assert got == sorted([(1, m) for m in range(1, 13)] + [(2, 11), (2, 12)], key=repr)
    assert base.where("year = 2019").count() == 0
    again = shops.repeat_shops_this_month(df, users, 500, until="2020-12-31")
    assert rows_of(again, "shop_id", "month") == [(1, 1), (1, 10), (2, 11)]
    years = shops.shop_years(df, users, 500)
    active = shops.active_shops(years).where("year = 2020 AND month IN (10, 11, 12)")
    assert rows_of(active, "month", "previous_repeat_shop", "this_month_repeat_shop") == [(10, 1, 1), (11, 2, 1), (12, 2, 0)]
    assert rows_of(shops.shop_detail(years).where("month = 11"), "shop_id", "type") == [(1, "2"), (2, "1"), (2, "2")]


def test_shops_until_a_day(orders, table):
    users = table(USERS, [(1, "s", "P", "C")])
    df = orders(dict(repair_id=1, deliver_date="2020-03-01", order_amount=500),
                dict(repair_id=1, deliver_date="2020-05-20", order_amount=500))
    before = shops.repeat_shops_this_month(df, users, 500, until="2020-05-19")
    assert before.count() == 0
    assert shops.repeat_shops_this_month(df, users, 500, until="2020-05-20").count() == 1
    assert rows_of(shops.repeat_base_shops(df, users, 500, until="2020-05-19"), "month") == [(4,), (5,)]
