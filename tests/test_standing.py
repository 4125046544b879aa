"""Tables that stand between runs: safe publishing, the event log and the price ledger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gearledger.functions import ratings as R
from gearledger.functions.sql_rules import register_rules
from gearledger.functions.text import clean_part_number
from gearledger.operators import prices, scorecard, shops
from gearledger.operators.event_log import EventLog
from gearledger.operators.merge import insert_if_absent, update_columns, upsert
from gearledger.plans import jobs
from gearledger.sources import ranges, versions
from gearledger.sources.tables import bucketed_table
from tests.conftest import day, rows_of

ROWS = "day date, shop string, n long"


def test_publishing_replaces_whole_days(spark, table, tmp_path):
    folder = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        versions.read_parts(spark, folder)
    versions.publish_parts(table(ROWS, [("2020-01-01", "a", 1), ("2020-01-02", "b", 2), ("2020-01-02", None, 3)]),
                           folder, ["day"], [])
    versions.publish_parts(table(ROWS, [("2020-01-03", "c", 4)]), folder, ["day"], [{"day": day("2020-01-03")}])
    got = versions.read_parts(spark, folder)
    assert [f.dataType.simpleString() for f in got.select("day", "shop", "n").schema] == ["date", "string", "bigint"]
    assert rows_of(got, "day", "shop", "n") == sorted([
        (day("2020-01-01"), "a", 1), (day("2020-01-02"), "b", 2), (day("2020-01-02"), None, 3),
        (day("2020-01-03"), "c", 4)], key=repr)
    # A rerun of a day replaces it, one that finds nothing empties it, and a day that is not named but there goes, too.
    versions.publish_parts(table(ROWS, [("2020-01-01", "z", 9)]), folder, ["day"], [{"day": day("2020-01-02")}])
    got = versions.read_parts(spark, folder)
    assert rows_of(got, "day", "shop", "n") == [(day("2020-01-01"), "z", 9), (day("2020-01-03"), "c", 4)]
    assert versions.drop_old_parts(spark, folder) == 2 and versions.drop_old_parts(spark, folder) == 0
    assert rows_of(versions.read_parts(spark, folder), "shop") == [("c",), ("z",)]
    versions.publish_parts(table(ROWS, []), folder, ["day"], [{"day": day(d)} for d in ("2020-01-01", "2020-01-03")])
    empty = versions.read_parts(spark, folder)
    assert empty.count() == 0 and set(empty.columns) == {"day", "shop", "n"}


def test_a_failure_before_the_pointer_moves_leaves_the_old_table(spark, table, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    versions.publish_parts(table(ROWS, [("2020-01-01", "a", 1)]), folder, ["day"], [])

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(versions, "_move_pointer", fail)
        with pytest.raises(OSError):
            versions.publish_parts(table(ROWS, [("2020-01-01", "b", 2)]), folder, ["day"], [])
    assert rows_of(versions.read_parts(spark, folder), "shop") == [("a",)]
    versions.publish_parts(table(ROWS, [("2020-01-01", "c", 3)]), folder, ["day"], [])
    assert rows_of(versions.read_parts(spark, folder), "shop") == [("c",)]
    # A table computed from its own old state, without partitions.
    whole = str(tmp_path / "whole")
    versions.publish_parts(table("k string, n long", [("x", 1)]), whole, [], [{}])
    grown = versions.read_parts(spark, whole).union(table("k string, n long", [("y", 2)]))
    versions.publish_parts(grown, whole, [], [{}])
    assert rows_of(versions.read_parts(spark, whole)) == [("x", 1), ("y", 2)]


def test_publish_all_empties_a_day_without_rows(spark, table, tmp_path):
    kind = "stat_date date, province string"
    folder, date = str(tmp_path), dt.date(2020, 5, 4)
    for rows in ([("2020-05-03", "p")], [("2020-05-04", "q")], []):
        jobs.publish_all({"daily_scorecard": table(kind, rows)}, folder, day(rows[0][0]) if rows else date)
    assert rows_of(jobs.published(spark, folder)("daily_scorecard"), "province") == [("p",)]


TRACK = """order_id long, iorder_id long, operate_code string, operate_date date, deliver_date date, amount decimal(11,2),
  purchase_amount decimal(11,2)"""


def source_rows(orders, table):
    sold = orders(
        dict(id=1, deliver_date="2020-03-02", refund_date="2020-03-05", refund_amount=30, refund_purchase_amount=10),
        dict(id=2, deliver_date="2020-03-03", is_fbj="0"), dict(id=3, payment_date="2020-03-03", is_picc="0"),
        dict(id=4, is_b2b="0", deliver_date="2020-03-03"), dict(id=5, city=None, deliver_date="2020-03-02"),
        dict(id=6, refund_date="2020-03-05", refund_amount=7, payment_date="2020-02-01"))
    track = table("iorder_id long, operate_code string, operate_date date, deliver_date date, amount decimal(11,2)", [
        (1, "01", "2020-03-02", "2020-03-02", 50), (1, "01", "2020-03-04", "2020-03-02", 25),
        (2, "03", "2020-03-03", "2020-03-03", 80), (9, "01", "2020-03-03", "2020-03-03", 8), (3, "01", None, None, 5)])
    return sold, track


def test_event_log_equals_the_orders(spark, orders, table, tmp_path):
    sold, track = source_rows(orders, table)
    log = EventLog(spark, str(tmp_path / "log"))
    first, last = day("2020-02-01"), day("2020-03-05")
    log.append(sold, track, first, day("2020-03-03"))
    # The next day holds only what happened on it: a late refund, and a receipt of an order delivered before.
    for date in ("2020-03-04", "2020-03-05", "2020-03-05"):
        log.append(sold.where(f"'{date}' IN (deliver_date, refund_date, payment_date) OR id IN (1)"), track, day(date), day(date))
    wanted = scorecard.daily_scorecard(sold, track, first, last)
    assert rows_of(log.daily_scorecard(), *wanted.columns) == rows_of(wanted)
    assert rows_of(log.daily_scorecard(last, last), *wanted.columns) == rows_of(scorecard.daily_scorecard(sold, track, last, last))
    mix = scorecard.vehicle_part_mix_net(sold, first, last)
    assert rows_of(log.vehicle_mix(first, last), *mix.columns) == rows_of(mix)
    # A day that has nothing any more is emptied.
    log.append(sold.limit(0), track, last, last)
    assert log.order_events(last, last).count() == 0 and log.order_events(first, day("2020-03-04")).count() > 0


def test_a_day_of_the_log_reads_its_partition(spark, orders, table, tmp_path):
    sold, track = source_rows(orders, table)
    log = EventLog(spark, str(tmp_path / "log"))
    log.append(sold, track, day("2020-03-01"), day("2020-03-05"))
    plan = log.daily_scorecard("2020-03-05", "2020-03-05")._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.split("\n") if "FileScan parquet" in x]
    assert len(scans) == 2 and all("(event_day#" in x.split("PartitionFilters: [")[1].split("PushedFilters")[0] for x in scans)
    files = log.order_events("2020-03-05", "2020-03-05").select(F.input_file_name()).distinct().collect()
    assert files and all("event_day=2020-03-05" in r[0] for r in files)


SALES = """car_brand string, temp_oe string, quality_type string, part_oe string, province string,
  deliver_time date, sale_price decimal(11,2)"""


def sale(price, when, oe="A1", province="p"):
    return ("B", oe, "1", "A-1", province, when, price)


def test_ledger_takes_a_day_again(table):
    days = [[sale(10, "2020-06-01"), sale(20, "2020-06-01")], [sale(33, "2020-06-02"), sale(5.55, "2020-06-02", "A2")]]
    first, second = (prices.day_sums(table(SALES, rows)) for rows in days)
    once = prices.replace_days(first, second, "2020-06-02", "2020-06-02")
    wanted = [("B", "A1", "1", 21.0, 3), ("B", "A2", "1", 5.55, 1)]
    assert rows_of(prices.average_of_ledger(once)) == wanted
    again = prices.replace_days(once, second, "2020-06-02", "2020-06-02")
    assert rows_of(prices.average_of_ledger(again)) == wanted
    # A corrected day replaces what it gave, also by nothing; days outside of the batch's range are not touched.
    fixed = prices.replace_days(again, prices.day_sums(table(SALES, [sale(3, "2020-06-02"), sale(1, "2020-06-09")])),
                                "2020-06-02", "2020-06-02")
    assert rows_of(prices.average_of_ledger(fixed)) == [("B", "A1", "1", 11.0, 3)]
    closed = prices.close_days(again, "2020-06-01")
    assert rows_of(prices.average_of_ledger(closed)) == wanted and closed.where("deliver_time = '2020-06-01'").count() == 1
    assert rows_of(prices.average_of_ledger(prices.close_days(again, "2020-06-02"))) == wanted
    assert rows_of(prices.average_of_ledger(first.limit(0))) == []


def test_snapshot_follows_the_single_merges(table):
    brands = table("standard_brand_name string, standard_brand_code string", [("B", "C1")])
    before = table(SALES, [sale(10, "2020-01-01", province="old"), sale(30, "2020-05-20", province="old"),
                           sale(8, "2020-05-01", "A2"), sale(7, "2020-05-01", "A3")])
    batch = table(SALES, [sale(12, "2020-06-01"), sale(30, "2020-06-01"), sale(9, "2020-06-01", "A2"), sale(4, "2020-06-01", "A4")])
    history = prices.with_brand_code(prices.price_history(before), brands)
    ledger = prices.day_sums(before.union(batch))
    once = prices.price_snapshot(history, batch, ledger, brands)
    low = {r[1]: r for r in rows_of(prices.price_min_merge(history, batch), "pid", "temp_oe", *prices.LOW)}
    high = {r[1]: r for r in rows_of(prices.price_max_merge(history, batch), "pid", "temp_oe", *prices.HIGH)}
    got = {r[0]: r[1:] for r in rows_of(once, "temp_oe", *prices.LOW, *prices.HIGH)}
    assert set(got) == {"A1", "A2", "A3", "A4"} and got["A3"][0] == 7.0
    for key in ("A1", "A2", "A4"):
        assert got[key] == low[key][2:] + high[key][2:]
    assert rows_of(once, "temp_oe", "brand_code", "avg_sale_price", "sale_times") == [
        ("A1", "C1", 20.5, 4), ("A2", "C1", 8.5, 2), ("A3", "C1", 7.0, 1), ("A4", "C1", 4.0, 1)]
    assert rows_of(prices.price_snapshot(once, batch, ledger, brands)) == rows_of(once)
    empty = prices.price_snapshot(history, batch.limit(0), prices.day_sums(before), brands)
    assert rows_of(empty, *history.columns) == rows_of(history)


def test_audit_columns_of_inserted_and_updated_rows(table):
    target = table("k long, v string, who string", [(1, "old", "a"), (2, "old", "a")])
    updates = table("k long, v string, who string", [(2, "new", "x"), (3, "new", "x")])
    stamp = {"who": F.lit("job")}
    assert rows_of(insert_if_absent(target, updates, ["k"], audit=stamp)) == [
        (1, "old", "a"), (2, "old", "a"), (3, "new", "job")]
    assert rows_of(update_columns(target, updates, ["k"], ["v"], audit=stamp)) == [(1, "old", "a"), (2, "new", "job")]
    assert rows_of(update_columns(target, updates, ["k"], ["v"], F.col("k") > 5, audit=stamp)) == rows_of(target)


def test_ranges_hold_every_row_once_and_about_equally_many(spark, tmp_path):
    # A third of the keys lies in one percent of their span; some keys are null.
    crowded = ["SELECT id + 500000 AS id FROM range(0, 10000)", "SELECT id * 50 AS id FROM range(0, 20000)",
               "SELECT CAST(NULL AS LONG) AS id FROM range(0, 100)"]
    spark.sql(" UNION ALL ".join(crowded)).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    cuts = ranges.balanced_cuts(table, "id", 20)
    counts = [table.where(p).count() for p in ranges.range_predicates("id", cuts)]
    assert len(counts) == 20 and sum(counts) == 30100 and max(counts) < 2 * 30100 / 20
    read = ranges.read_by_ranges(table, "id", 20)
    assert sorted(read.collect(), key=repr) == sorted(table.collect(), key=repr)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(id,") >= 19
    none = table.limit(0)
    assert ranges.balanced_cuts(none, "id", 20) == [] and ranges.read_by_ranges(none, "id", 20).count() == 0
    assert ranges.read_by_ranges(table.where("id IS NULL"), "id", 5).count() == 100
    assert ranges.balanced_cuts(table, "id", 1) == [] and ranges.range_predicates("id", [7]) == [
        "id < 7 OR id IS NULL", "id >= 7"]
    same = spark.sql("SELECT 3L AS id FROM range(50)")
    assert ranges.read_by_ranges(same, "id", 8).count() == 50


def test_bounds_come_from_the_footers(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table("id long, day date, shop string", [(3, "2020-01-05", "a"), (None, None, "b"), (9, "2020-03-01", "c")]).coalesce(1).write.parquet(path)
    bounds = ranges.footer_bounds(spark, path, ["id", "day"])
    assert rows_of(bounds) == [(3, 3, 9, day("2020-01-05"), day("2020-03-01"))]
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(day), MAX(day)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_shops_counted_from_bitmaps(spark, table):
    kind = "shop_id long, shop_name string, province string, city string, year int, month int"
    rows = [(s, "n", f"p{s % 3}", f"c{s % 5}", 2020, m) for s in (1, 2, 40000, 40001, 99999, 7) for m in (2, 3, 11) if (s + m) % 2]
    rows += [(1, "n", None, "c1", 2021, 1), (None, "n", "p1", "c1", 2020, 2), rows[0]]
    bitmaps = shops.shop_bitmaps(table(kind, rows))
    assert bitmaps.select("bucket").distinct().count() == 3
    known = [r for r in rows if r[0] is not None]
    wanted = {}
    for s, _, p, c, y, m in known:
        wanted.setdefault(("city", y, m, p, c), set()).add(s)
        wanted.setdefault(("province", y, m, p, None), set()).add(s)
        for later in range(m, 13):
            wanted.setdefault(("year_to_date", y, later, p, None), set()).add(s)
    assert rows_of(shops.shop_levels(bitmaps)) == sorted([(*k, len(v)) for k, v in wanted.items()], key=repr)
    assert shops.shop_levels(bitmaps.limit(0)).count() == 0


def test_bucketed_history_is_not_shuffled(spark, table):
    brands = table("standard_brand_name string, standard_brand_code string", [("B", "C1")])
    before = table(SALES, [sale(10, "2020-05-01", f"A{i}") for i in range(50)])
    batch = table(SALES, [sale(i % 20 + 1, "2020-06-01", f"A{i}", "new") for i in range(40, 60)])
    history = prices.with_brand_code(prices.price_history(before), brands)
    stored = bucketed_table(history, "test_history", prices.KEYS)
    merged = prices.low_snapshot(stored, batch, brands)
    low = prices.with_brand_code(prices.price_min_merge(history, batch).drop("pid"), brands)
    wanted = upsert(history, low, prices.KEYS, ["brand_code", *prices.LOW], unique=True)
    assert rows_of(merged, *wanted.columns) == rows_of(wanted)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = prices.low_snapshot(stored, batch, brands)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = next(i for i, line in enumerate(plan) if "Bucketed: true" in line)
    depth, above = len(plan[at]) - len(plan[at].lstrip(" :+-")), []
    for line in reversed(plan[:at]):
        own = len(line) - len(line.lstrip(" :+-"))
        if own < depth:
            depth = own
            above.append(line)
    assert any("SortMergeJoin" in x or "ShuffledHashJoin" in x for x in above) and not any("Exchange" in x for x in above)
    assert any("Exchange" in x for x in plan)


def test_rules_in_sql_text(spark, table):
    rows = [(p, a, c, r) for p in ("00", "01", "02", "03", "05", "09", None)
            for a in ("0", "850000", "850000.01", "1500000.5", "6000000", "6000000.01", "20000000", "99999999", None)
            for c in ("1", "1.1", "2.2", "3", "5", None) for r in ("0", "25", "34.99", "40", "99.99", "110", None)]
    frame = table("p string, a decimal(18,2), c string, r decimal(11,2)", rows)
    columns = {
        "sales_class(p, a)": R.sales_class(F.col("p"), F.col("a")),
        "sales_class_name(p, c)": R.sales_class_name(F.col("p"), F.col("c")),
        "bonus_ratio(p, c)": R.bonus_ratio(F.col("p"), F.col("c")),
        "manager_selfop_ratio(c)": R.manager_selfop_ratio(F.col("c")),
        "manager_brokered_ratio(c)": R.manager_brokered_ratio(F.col("c")),
        "repeat_shop_factor(r)": R.repeat_shop_factor(F.col("r")),
        "completion_selfop_factor(r)": R.completion_selfop_factor(F.col("r")),
        "completion_brokered_factor(r)": R.completion_brokered_factor(F.col("r")),
        "clean_part_number(concat(p, r'+, -./~# \\*x', c))": clean_part_number(
            F.concat("p", F.lit("+, -./~# \\*x"), "c")),
    }
    register_rules(spark)
    for text, column in columns.items():
        got = spark.sql(f"SELECT {text} AS v, p, a, c, r FROM {{frame}}", frame=frame)
        assert got.exceptAll(frame.select(column.alias("v"), "p", "a", "c", "r")).count() == 0, text
        assert got.count() == len(rows)
