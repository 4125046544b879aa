"""Every registered query against its checking SQL, and the shape of the plans."""

import duckdb
import pytest

import __spark_entry__ as entry
from gearledger.plans import oracle, registry
from gearledger.sources import jdbc
from tests.conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
NAMES = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


def test_every_query_has_checking_sql():
    assert set(NAMES) == set(oracle.oracle_sql()) and set(NAMES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    cursor = duck.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, cursor.fetchall())


@pytest.mark.parametrize("name", NAMES)
def test_plan_is_native(spark, name):
    plan = registry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin", "MapInPandas"):
        assert word not in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_scans_are_pruned_and_filtered(spark):
    # settlement rows are filtered in the scan, and only the used columns are read
    plan = registry.queries()["service_charge_by_manager"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan
    assert "l_discount" not in plan and "c_acctbal" not in plan


def test_views_name_their_dependencies_first():
    names = oracle._views_of("SELECT * FROM v_receipts")
    assert names.index("v_orders") < names.index("v_b2b") < names.index("v_receipts")


def test_jdbc_options_do_not_touch_the_callers():
    connection = {"url": "jdbc:x", "user": "u"}
    options = jdbc.scan_options(connection, "t", "id", 1, 900)
    assert connection == {"url": "jdbc:x", "user": "u"}
    assert (options["lowerBound"], options["upperBound"], options["numPartitions"]) == ("1", "900", "50")
    assert "MIN(id)" in jdbc.bounds_query("t", "id")


def test_tasks_of_a_join_follow_its_bytes(spark):
    settings = {"spark.sql.shuffle.partitions": "2", "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k"}
    old = {c: spark.conf.get(c) for c in settings}
    try:
        for c, value in settings.items():
            spark.conf.set(c, value)
        left = spark.range(100_000).selectExpr("id AS k", "sha2(CAST(id AS STRING), 256) AS v")
        assert left.join(left.withColumnRenamed("v", "w"), "k").rdd.getNumPartitions() > 2
    finally:
        for c, value in old.items():
            spark.conf.set(c, value)
