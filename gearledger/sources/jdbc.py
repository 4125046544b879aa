"""JDBC tables: range-partitioned scans, whole lookups and bulk writes.

Bounds only set the stride of the parallel reads; they never filter rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from gearledger.sources.ranges import balanced_cuts, range_predicates

# Number of parallel range reads.
SCAN_PARTITIONS = 50
PRICE_CENSUS_PARTITIONS = 100
PRODUCT_CENSUS_PARTITIONS = 150
WRITE_BATCH = 10_000


def scan_options(
    connection: Mapping[str, str], table: str, column: str, lower: int, upper: int,
    partitions: int = SCAN_PARTITIONS,
) -> dict[str, str]:
    """Reader options of a range-partitioned scan; the caller's options are not changed."""
    return {
        **connection,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def bounds_query(table: str, column: str) -> str:
    return f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) bounds"


def lookup_table(spark: SparkSession, connection: Mapping[str, str], table: str) -> DataFrame:
    return spark.read.format("jdbc").options(**{**connection, "dbtable": table}).load()


def scan_table(
    spark: SparkSession, connection: Mapping[str, str], table: str, column: str = "id",
    partitions: int = SCAN_PARTITIONS,
) -> DataFrame:
    """Scan split by ranges of a numeric column whose bounds the database is asked for."""
    lo, hi = lookup_table(spark, connection, bounds_query(table, column)).first()
    if lo is None:
        return lookup_table(spark, connection, table)
    options = scan_options(connection, table, column, int(lo), int(hi), partitions)
    return spark.read.format("jdbc").options(**options).load()


def scan_balanced(
    spark: SparkSession, connection: Mapping[str, str], table: str, column: str = "id",
    partitions: int = SCAN_PARTITIONS,
) -> DataFrame:
    """Scan split into ranges of about equally many rows. The key column is read first, split by an even stride."""
    keys = scan_table(spark, connection, f"(SELECT {column} FROM {table}) keys", column, partitions)
    predicates = range_predicates(column, balanced_cuts(keys, column, partitions))
    options = {k: v for k, v in connection.items() if k != "url"}
    return spark.read.jdbc(connection["url"], table, predicates=predicates, properties=options)


def write_table(df: DataFrame, connection: Mapping[str, str], table: str, mode: str = "overwrite") -> None:
    """Bulk write of a finished table, in batches instead of a statement per row."""
    options = {**connection, "dbtable": table, "batchsize": str(WRITE_BATCH), "truncate": "true"}
    df.write.format("jdbc").options(**options).mode(mode).save()
