import random

from pyspark.sql import functions as F

from gearledger.operators import prices
from gearledger.operators.columns import add_price_columns
from gearledger.operators.extremes import rows_at_extreme
from gearledger.operators.lookups import distinct_codes, id_bounds, lookup
from gearledger.operators.merge import insert_if_absent, one_per_key, update_columns, upsert
from gearledger.operators.skew import salted_count
from tests.conftest import day, rows_of

PRICE = """car_brand string, temp_oe string, quality_type string, part_oe string, province string,
  deliver_time date, sale_price decimal(11,2)"""
MIN_HISTORY = """car_brand string, temp_oe string, quality_type string, min_sale_price decimal(11,2),
  min_sale_province string, min_sale_deliver_time date"""
KEY = ("B", "A1", "1")


def batch_row(price, province="new", when="2020-06-01", oe="A-1", key=KEY):
    return (*key, oe, province, when, price)


def min_case(table, history, price=10):
    merged = prices.price_min_merge(table(MIN_HISTORY, [(*KEY, *h) for h in history]), table(PRICE, [batch_row(price)]))
    return rows_of(merged, "min_sale_price", "min_sale_province", "min_sale_deliver_time")


def test_min_merge_keeps_replaces_and_expires(table):
    new, d = (10.0, "new", day("2020-06-01")), "2020-05-01"
    assert min_case(table, []) == [new]
    assert min_case(table, [(9, "old", d)]) == [(9.0, "old", day(d))]
    assert min_case(table, [(10, "old", d)]) == [(10.0, "old", day(d))]
    assert min_case(table, [(11, "old", d)]) == [new]
    assert min_case(table, [(9, "old", "2020-03-03")]) == [(9.0, "old", day("2020-03-03"))]  # 90 days
    assert min_case(table, [(9, "old", "2020-03-02")]) == [new]  # 91 days


def test_min_merge_fills_each_missing_column(table):
    d = "2020-05-01"
    assert min_case(table, [(None, "old", d)]) == [(10.0, "old", day(d))]
    assert min_case(table, [(9, None, d)]) == [(9.0, "new", day(d))]
    assert min_case(table, [(9, "old", None)]) == [(9.0, "old", day("2020-06-01"))]


def test_max_merge_refreshes_on_equal(table):
    schema = MIN_HISTORY.replace("min_", "max_")
    def case(price, when):
        merged = prices.price_max_merge(table(schema, [(*KEY, price, "old", when)]), table(PRICE, [batch_row(10)]))
        return rows_of(merged, "max_sale_price", "max_sale_province")
    assert case(10, "2020-05-01") == [(10.0, "new")]
    assert case(11, "2020-05-01") == [(11.0, "old")]
    assert case(9, "2020-05-01") == [(10.0, "new")]
    assert case(11, "2020-03-02") == [(10.0, "new")]


def test_floor_merge_expires_after_a_year(table):
    schema = "car_brand string, temp_oe string, quality_type string, sale_price decimal(11,2), sale_province string, deliver_time date"
    def case(when):
        merged = prices.price_floor_merge(table(schema, [(*KEY, 9, "old", when)]), table(PRICE, [batch_row(10)]))
        return rows_of(merged, "sale_price", "sale_province")
    assert case("2019-06-01") == [(9.0, "old")]
    assert case("2019-05-31") == [(10.0, "new")]
    assert case(None) == [(10.0, "new")]


def test_ties_are_kept_or_resolved(table):
    rows = table(PRICE, [
        batch_row(7, "b", "2020-06-01"), batch_row(7, "a", "2020-06-02", "A.1"), batch_row(7, "c", "2020-06-02", "A1"),
        batch_row(9, "z"), batch_row(3, "k", key=("B", "A2", "1"))])
    ties = rows_at_extreme(rows, prices.KEYS, "sale_price", "min")
    assert rows_of(ties, "province") == [("a",), ("b",), ("c",), ("k",)]
    assert rows_of(rows_at_extreme(rows, prices.KEYS, "sale_price", "max"), "province") == [("k",), ("z",)]
    low = prices.lowest_per_key(rows, prices.KEYS, "sale_price").where("temp_oe = 'A1'")
    assert rows_of(low, "sale_price", "province", "deliver_time", "part_oe") == [(7.0, "a", day("2020-06-02"), "A.1")]


def test_running_average(table):
    schema = "car_brand string, temp_oe string, quality_type string, avg_sale_price decimal(18,2), sale_times long"
    def case(*history):
        merged = prices.price_avg_merge(
            table(schema, [(*KEY, *h) for h in history]), table(PRICE, [batch_row(10), batch_row(21)]))
        return rows_of(merged, "avg_sale_price", "sale_times")
    assert case() == [(15.5, 2)]
    assert case((6, 1)) == [(12.33, 3)]
    assert case((None, 1)) == [(15.5, 3)]
    assert case((6, None)) == [(None, 2)]


def test_history_matches_its_parts(table):
    rows = table(PRICE, [batch_row(p, f"p{p}", f"2020-06-{p:02d}") for p in (6, 9, 12)])
    row = prices.price_history(rows).first()
    assert [float(row[c]) for c in ("min_sale_price", "max_sale_price", "avg_sale_price")] == [6, 12, 9]
    assert (row["min_sale_province"], row["max_sale_province"], row["sale_times"]) == ("p6", "p12", 3)


def test_empty_batch_leaves_history(table, spark):
    history = prices.price_history(table(PRICE, [batch_row(6), batch_row(8, key=("B", "A2", "2"))]))
    empty = prices.price_min_merge(history, table(PRICE, []))
    after = upsert(history, empty.drop("pid"), prices.KEYS, ["min_sale_price"], unique=True)
    assert rows_of(after) == rows_of(history)


def test_upsert_twice_is_once(table):
    target = table("k string, a long, b long", [("x", 1, 1), ("y", 2, 2), (None, 9, 9)])
    updates = table("k string, a long, b long", [("x", 7, 7), ("z", 8, 8), ("z", 8, 8)])
    once = upsert(target, updates, ["k"], ["a"])
    assert rows_of(once) == sorted([("x", 7, 1), ("y", 2, 2), ("z", 8, 8), (None, 9, 9)], key=repr)
    assert rows_of(upsert(once, updates, ["k"], ["a"])) == rows_of(once)
    stamped = upsert(target, updates, ["k"], [], audit={"b": F.lit(5).cast("long")})
    assert rows_of(stamped, "k", "b") == [("x", 5), ("y", 2), ("z", 5), (None, 9)]


def test_upsert_can_write_null(table):
    target = table("k string, a long", [("x", 1)])
    assert rows_of(upsert(target, table("k string, a long", [("x", None)]), ["k"], ["a"])) == [("x", None)]


def test_insert_if_absent_keeps_existing_rows(table):
    target = table("k long, v string", [(1, "old"), (1, "old2")])
    updates = table("k long, v string", [(1, "new"), (2, "b"), (2, "a")])
    once = insert_if_absent(target, updates, ["k"])
    assert rows_of(once) == [(1, "old"), (1, "old2"), (2, "a")]
    assert rows_of(insert_if_absent(once, updates, ["k"])) == rows_of(once)


def test_small_batch_inserts_the_same(table):
    kind = "k long, v string"
    target = table(kind, [(1, "old"), (1, "old2"), (None, "n"), (5, "o")])
    for rows in ([(1, "new"), (2, "b"), (2, "a"), (None, "m"), (5, None), (6, None)], []):
        updates = table(kind, rows)
        assert rows_of(insert_if_absent(target, updates, ["k"], small_batch=True)) == rows_of(
            insert_if_absent(target, updates, ["k"]))
        assert rows_of(insert_if_absent(target.limit(0), updates, ["k"], small_batch=True)) == rows_of(
            insert_if_absent(target.limit(0), updates, ["k"]))


def test_small_batch_filters_the_scan_of_the_target(spark, tmp_path):
    rows = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") % 40).alias("day"), F.lit("v").alias("v"))
    rows.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    target, updates = stored.where("day < 38"), stored.where("day = 39 OR day = 1")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        merged = insert_if_absent(target, updates, ["k"], small_batch=True)
        plan = merged._jdf.queryExecution().optimizedPlan().toString()
        lines = plan.split("\n")
        filters = [x for x in lines if "might_contain" in x]
        assert len(filters) == 1 and "< 38" in filters[0]
        assert merged.count() == target.count() + stored.where("day = 39").count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_update_columns_needs_key_and_condition(table):
    target = table("k long, pos string, v long, w long", [(1, "a", 0, 0), (1, "b", 0, 0), (2, "a", 0, 0), (3, None, 0, 0)])
    updates = table("k long, v long", [(1, 5), (3, 6), (4, 7), (1, 4)])
    got = update_columns(target, updates, ["k"], ["v"], F.col("pos") == "a")
    assert rows_of(got) == [(1, "a", 4, 0), (1, "b", 0, 0), (2, "a", 0, 0), (3, None, 0, 0)]


def test_one_per_key_is_deterministic(table):
    rows = [(i % 3, f"v{i}", i) for i in range(30)]
    random.Random(1).shuffle(rows)
    got = one_per_key(table("k long, v string, n long", rows), ["k"])
    assert rows_of(got) == [(0, "v0", 0), (1, "v1", 1), (2, "v11", 11)]


def test_salted_count_equals_plain_count(table):
    rows = [("p", "s_#", "b", "q", i) for i in range(500)] + [("p2", "s", "b", "q", i) for i in range(3)]
    rows += [(None, "s", "b", "q", 1), ("p", "", "b", "q", 2)]
    df = table("a string, b string, c string, d string, id long", rows)
    keys = ["a", "b", "c", "d"]
    for buckets in (1, 10, 37):
        got = salted_count(df, keys, ["id"], "n", buckets)
        assert rows_of(got) == [("p", "s_#", "b", "q", 500), ("p2", "s", "b", "q", 3)]


def test_lookup_never_multiplies_rows(table):
    rows = table("c string", [("1",), ("1",), ("2",), (None,)])
    names = table("code string, name string", [("1", "one"), ("1", "uno"), (None, "none")])
    assert rows_of(lookup(rows, names, "c", "code", "name", "n")) == [("1", "one"), ("1", "one"), ("2", ""), (None, "")]
    assert rows_of(lookup(rows, names, "c", "code", "name", "n", default=None), "n") == [("one",), ("one",), (None,), (None,)]


def test_bounds_and_codes(table):
    df = table("id long, code string", [(3, "a"), (9, "b"), (5, "a")])
    assert rows_of(id_bounds(df, "id")) == [(3, 9)]
    assert rows_of(distinct_codes(df, "code")) == [("a",), ("b",)]


def test_price_columns_replace_existing_ones(table):
    df = table("id long, hn_oem_price string", [(1, "x")])
    got = add_price_columns(df, ["hn", "gd"])
    assert got.columns == ["id", "hn_oem_price", "hn_afm_price", "gd_oem_price", "gd_afm_price"]
    assert rows_of(got) == [(1, 0.0, 0.0, 0.0, 0.0)]


def test_local_prices(table):
    local = table("id long, standard_brand_code string, oe string", [
        (1, "B1", "a-1"), (2, "B1", "a2"), (3, "B9", "a1"), (4, "B1", "a.1"), (5, "B1", "a3")])
    traded = table("brand_code string, temp_oe string, quality_type string, sale_price decimal(11,2), sale_province string", [
        ("B1", "a1", "1", 10, "44"), ("B1", "a1", "2", 8, "99"), ("B1", "a2", "2", 6, "11"), ("B1", "a2", "3", 1, "11"),
        (None, "a1", "1", 1, "11"), ("B1", "a3", "1", 0, "11")])
    provinces = table("province_code string, province_chn string", [("44", "广东省"), ("11", "北京市")])
    assert rows_of(prices.local_price_match(local, traded, provinces)) == [
        (1, 10.0, "广东省", 8.0, ""), (2, 0.0, "", 6.0, "北京市"), (4, 10.0, "广东省", 8.0, "")]


def test_order_items_get_code_and_list_price(table):
    rows = table(PRICE, [batch_row(10), batch_row(10, key=("?", "A1", "1"))])
    brands = table("standard_brand_name string, standard_brand_code string", [("B", "C1")])
    listed = table("standard_brand_code string, temp_oe string, sys_manufacture_price decimal(11,2)", [("C1", "A1", 12)])
    got = prices.order_item_enriched(rows, brands, listed)
    assert rows_of(got, "car_brand", "standard_brand_code", "sys_manufacture_price") == [("?", None, None), ("B", "C1", 12.0)]
