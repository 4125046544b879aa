"""Session settings and lineage cutting shared by the jobs, the benchmark and the tests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every plan here relies on. They can be changed on a live session.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start finely cut and are brought together again by their measured bytes, so what one task holds
    # follows the advisory size and not the share of the whole table that a fixed number of partitions gives it.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1000",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join on a hot key is split even when the next aggregation reuses its partitioning;
    # the extra exchange then carries partial aggregates only.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A shuffled join skips its sorts where every partition of one side is measured as small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
}

# Bytes that adaptive execution gives a task, where the session leaves Spark's own 64 MB.
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
ADVISORY_OF_SPARK, ADVISORY_HERE = "67108864b", "32m"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the plan settings to a running session."""
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(ADVISORY) == ADVISORY_OF_SPARK:
        spark.conf.set(ADVISORY, ADVISORY_HERE)
    return spark


def local_session(cores: int | str = "*", settings: dict[str, str] | None = None) -> SparkSession:
    """Single-machine session for tests and benchmarks, without the web page."""
    options = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": str(cores) if str(cores).isdigit() else "8",
        **(settings or {}),
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("gearledger")
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that the driver and every executor see.

    It is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, as in tests,
    a folder inside the SQL warehouse takes its place, which is shared as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"


def materialise(df: DataFrame, name: str = "frame") -> DataFrame:
    """Write a frame that several later steps read as parquet into the shared folder, and read it back.

    This runs a job at once. Lineage ends at the written files, so a lost executor costs a reread only.
    The files stay until the owner of the folder clears it.
    """
    path = f"{shared_folder(df.sparkSession)}/gearledger/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
