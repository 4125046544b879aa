import datetime as dt
import re
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gearledger.functions import calendar as cal
from gearledger.functions import predicates as P
from gearledger.functions import ratings as R
from gearledger.functions.money import ex_tax, from_cents, cents, quotient, round2
from gearledger.functions.text import clean_part_number, drop_last_char, pid, quality_group
from tests.conftest import rows_of


def values(spark, rows, schema, expression):
    df = spark.createDataFrame(rows, schema).withColumn("out", expression)
    return [r["out"] for r in df.collect()]


BANDS = [
    ("01", "6000000.00", "1.1"), ("01", "6000000.01", "1.2"), ("01", "10000000.00", "1.2"),
    ("01", "10000000.01", "2.1"), ("01", "15000000.01", "2.2"), ("01", "20000000.01", "3"),
    ("02", "10000000.00", "2"), ("02", "10000000.01", "3"), ("05", "20000000.01", "4"), ("05", "30000000.01", "5"),
    ("03", "850000.00", "1"), ("03", "850000.01", "2"), ("03", "1500000.00", "2"), ("03", "1500000.01", "3"),
    ("03", "3000000.01", "4"), ("03", "6000000.01", "5"), ("00", "1.00", "0"), ("09", "1.00", "0"), (None, "1.00", "0"),
]


def test_sales_class_at_band_edges(spark):
    rows = [(p, Decimal(a)) for p, a, _ in BANDS]
    got = values(spark, rows, "position string, amount decimal(18,2)", R.sales_class(F.col("position"), F.col("amount")))
    assert got == [c for _, _, c in BANDS]


def test_sales_class_literal_rule_keeps_its_gaps(spark):
    amounts = ["850000.00", "850000.01", "1500001.00", "1500001.01", "3000000.00", "3000000.50", "3000001.50", "6000000.01"]
    got = values(
        spark, [("03", Decimal(a)) for a in amounts], "position string, amount decimal(18,2)",
        R.sales_class(F.col("position"), F.col("amount"), strict_reference=True))
    assert got == ["1", "5", "5", "3", "3", "5", "4", "5"]


def test_class_names_and_ratios(spark):
    rows = [("00", "0"), ("01", "2.1"), ("01", "3"), ("02", "4"), ("05", "4"), ("03", "2"), ("02", "9"), ("09", "0")]
    schema = "position string, cls string"
    position, cls = F.col("position"), F.col("cls")
    assert values(spark, rows, schema, R.sales_class_name(position, cls)) == [
        "M0", "M2", "M3", "O4", "O4", "S2", "O9", "O0"]
    assert values(spark, rows, schema, R.bonus_ratio(position, cls)) == [
        0.012, 0.032, 0.038, 0.020, 0.016, 0.0, 0.0, 0.0]
    assert values(spark, [(c,) for c in "12345"], "cls string", R.manager_selfop_ratio(cls)) == [
        0.07, 0.11, 0.15, 0.17, 0.18]
    assert values(spark, [(c,) for c in "12345"], "cls string", R.manager_brokered_ratio(cls)) == [
        0.04, 0.08, 0.10, 0.12, 0.14]


def test_factor_edges(spark):
    rates = [24.99, 25.0, 35.0, 40.0, 60.0, 99.99, 100.0, 110.0, 0.0]
    rows = [(r,) for r in rates]
    rate = F.col("r")
    assert values(spark, rows, "r double", R.repeat_shop_factor(rate)) == [.7, .8, .9, 1., 1., 1., 1., 1., .7]
    assert values(spark, rows, "r double", R.completion_selfop_factor(rate)) == [1.] * 7 + [1.1, 1.]
    assert values(spark, rows, "r double", R.completion_brokered_factor(rate)) == pytest.approx(
        [.6, .6, .6, .6, .6, .9999, 1., 1., .6])


def test_part_number_cleaning(spark):
    texts = ["a+b,c-d.e/f~g#h i", r"x\sy\*z[s*]", "", None, "plain", "a\\b"]
    assert values(spark, [(t,) for t in texts], "t string", clean_part_number(F.col("t"))) == [
        "abcdefghi", "xyz[s*]", "", None, "plain", "a\\b"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="\\\\s*+,-./~# ab[]", max_size=12), min_size=1, max_size=40))
def test_part_number_cleaning_equals_the_pattern(spark, texts):
    rows = [(t,) for t in texts]
    assert values(spark, rows, "t string", clean_part_number(F.col("t"))) == [
        re.sub(r"([+-/~.# ]|\\[s*])", "", t) for t in texts]


def test_text_helpers(spark):
    assert values(spark, [("ab,",), (",",), ("",)], "t string", drop_last_char(F.col("t"))) == ["ab", "", ""]
    assert values(spark, [("a", "b"), ("ab", "")], "x string, y string", pid(F.col("x"), F.col("y"))) == ["ab", "ab"]
    labels = [("原厂件",), ("流通原厂件",), ("拆车件",), (None,)]
    assert values(spark, labels, "q string", quality_group(F.col("q"))) == ["原厂件", "原厂件", "品牌件", "品牌件"]


DAYS = ["2020-01-15", "2020-02-29", "2020-03-31", "2020-10-01", "2020-11-30", "2020-12-31"]


def test_calendar(spark):
    d = F.col("d")
    df = spark.createDataFrame([(dt.date.fromisoformat(x),) for x in DAYS], "d date").select(
        cal.month_end(d), cal.previous_month_end(d), cal.month_start(d), cal.year_start(d),
        cal.same_day_last_year(d), cal.days_before(d, 90), cal.yyyymmdd(d))
    for text, row in zip(DAYS, df.collect()):
        x = dt.date.fromisoformat(text)
        first = x.replace(day=1)
        next_first = (first + dt.timedelta(days=32)).replace(day=1)
        assert row[0] == next_first - dt.timedelta(days=1)
        assert row[1] == first - dt.timedelta(days=1)
        assert row[2] == first
        assert row[3] == x.replace(month=1, day=1)
        last_day = 28 if (x.month, x.day) == (2, 29) else x.day
        assert row[4] == x.replace(year=x.year - 1, day=last_day)
        assert row[5] == x - dt.timedelta(days=90)
        assert row[6] == x.strftime("%Y%m%d")


def test_day_ranges_are_half_open(spark, table):
    df = table("t timestamp", [("2020-01-01 00:00:00",), ("2020-01-01 23:59:59.9",), ("2020-01-02 00:00:00",)])
    assert df.where(cal.between_days(F.col("t"), "2020-01-01", "2020-01-01")).count() == 2


def test_months_cross_the_year(spark):
    df = cal.in_months(spark.range(1), (2019, 11), (2020, 2))
    assert rows_of(df, "year", "month") == [(2019, 11), (2019, 12), (2020, 1), (2020, 2)]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(-10**11 + 1, 10**11 - 1), min_size=1, max_size=30))
def test_cent_sums_equal_decimal_sums(spark, units):
    amounts = [(Decimal(u) / 100,) for u in units]
    df = spark.createDataFrame(amounts, "a decimal(11,2)")
    got = df.agg(from_cents(F.sum(cents("a"))).alias("s")).first()["s"]
    assert got == sum(a for a, in amounts)


def test_rounding_and_division(spark):
    rows = [(1.005, 0.0), (0.285, 2.0), (-1.005, 4.0)]
    assert values(spark, rows, "a double, b double", round2(F.col("a"))) == [
        Decimal("1.01"), Decimal("0.29"), Decimal("-1.01")]
    assert values(spark, rows, "a double, b double", quotient(F.col("a"), F.col("b")))[0] is None
    assert values(spark, [(Decimal("113.00"),)], "a decimal(28,2)", ex_tax(F.col("a"), 1.13)) == [Decimal("100.00")]


def test_predicates_on_nulls(spark, table):
    codes = table("status string, supplier_id long", [("0", 7550), ("1", 1), (None, None)])
    assert rows_of(codes.where(P.not_switched_off()), "status") == [("1",), (None,)]
    assert rows_of(codes.where(P.id_is_not("supplier_id", 7550)), "supplier_id") == [(1,), (None,)]
    assert codes.where(P.id_is_not("supplier_id", 0)).count() == 2


def test_receipt_date_and_term_cutoff(spark, table):
    track = table("operate_date date, deliver_date date, operate_code string", [
        ("2020-01-02", "2020-01-01", "01"), ("2020-01-01", "2020-01-02", "03"), ("2020-01-02", "2020-01-02", "04"),
        ("2019-01-02", "2019-12-31", "03"), (None, "2020-01-01", "01"), ("2020-01-01", None, None)])
    dates = [r[0] and str(r[0]) for r in track.select(P.receipt_date()).collect()]
    assert dates == ["2020-01-02", "2020-01-02", "2020-01-02", "2019-12-31", None, None]
    kept = [r[0] for r in track.select(P.broker_term_ok()).collect()]
    assert kept == [True, True, True, False, True, True]


def test_refund_validity(spark, table):
    refunds = table("payment_date date, refund_date date, order_status string", [
        ("2018-07-31", "2018-09-01", "500"), ("2018-08-01", "2018-09-01", "500"), ("2018-08-01", "2018-09-01", "700"),
        ("2018-08-01", "2018-09-01", "701"), ("2018-08-01", "2018-09-01", None), (None, "2018-09-01", "700"),
        ("2018-08-01", None, "700")])
    assert [r[0] for r in refunds.select(P.refund_is_valid()).collect()] == [
        True, False, True, True, False, False, False]


def test_price_gate(table):
    schema = "temp_oe string, car_brand string, quality_type string, part_oe string, deliver_time date, sale_price decimal(11,2)"
    good = ("A1", "B", "1", "A-1", "2020-01-01", 6)
    rows = [good, ("", *good[1:]), ("JY1", *good[1:]), ("A1", "", *good[2:]), (*good[:5], 5), (*good[:5], 5.01),
            *[tuple(None if i == j else v for j, v in enumerate(good)) for i in range(6)], (*good[:4], "2020-01-02", 6)]
    df = table(schema, rows)
    assert P.clean_price_rows(df).count() == 3
    assert P.clean_price_rows(df, "2020-01-01", "2020-01-01").count() == 2


def test_valid_products(table):
    df = table("status string, originSource string, partsPrice decimal(11,2)", [
        ("1", "01", 1), ("0", "01", 1), ("1", "04", 1), ("1", "03", 0), (None, "01", 1), ("1", None, 1), ("1", "02", None)])
    assert P.valid_products(df).count() == 1
