"""Parquet tables of one data folder, and publishing of finished tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from gearledger.session import shared_folder

# Known schemas; a table read with one needs no job to look into its files first.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,
        l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING,
        l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING""",
}


class Tables:
    """Lazy access to the parquet tables of a folder: ``Tables(spark, path).orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        reader = self.spark.read
        if name in SCHEMAS:
            reader = reader.schema(SCHEMAS[name])
        frame = reader.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)
        return frame


def publish(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a published table by a finished result, or only the partitions that the result holds."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def bucketed_table(df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Store a standing table bucketed and sorted by its keys, in the catalog, and read it.

    A join on exactly these keys then shuffles its other side only. There are as many buckets as the session has shuffle
    partitions, unless said otherwise; a session with more shuffles the table again.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).option(
        "path", f"{shared_folder(spark)}/gearledger/{known}").saveAsTable(known)
    return spark.table(known)
