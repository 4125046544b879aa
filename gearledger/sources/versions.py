"""Standing tables that are published safely: parts are written beside the old ones, then a small pointer file moves.

A published day or month is a folder of its own below its partition folder. The pointer file lists the folders that are
current. It is replaced by one rename, so readers see the old table until everything new is written, whatever fails
before. Writers take turns; two that publish the same table at the same time are not kept apart.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

POINTER = "_current.json"
VERSION = "table_version"


def _files(spark: SparkSession, path: str):
    """The file system of a path, as the cluster's settings name it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _read_pointer(spark: SparkSession, folder: str) -> dict | None:
    where, files = _files(spark, f"{folder}/{POINTER}")
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _move_pointer(spark: SparkSession, folder: str, pointer: dict) -> None:
    """Write the new pointer beside the old one and rename it over that in one step."""
    jvm = spark._jvm
    fresh, files = _files(spark, f"{folder}/{POINTER}.{uuid.uuid4().hex}")
    stream = files.create(fresh, True)
    try:
        stream.write(bytearray(json.dumps(pointer).encode()))
    finally:
        stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fresh, jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}"), options)


def _partition(values: Mapping[str, object], columns: Sequence[str]) -> str:
    return "/".join(f"{c}={values[c]}" for c in columns)


def publish_parts(df: DataFrame, folder: str, columns: Sequence[str], replaced: Sequence[Mapping[str, object]]) -> None:
    """Replace whole partitions of a standing table, or all of a table without partition columns.

    ``replaced`` names the partitions this run stands for, such as its days; one for which the result has no row is
    emptied. Partitions of the result that are not named are replaced as well, all others stay.
    """
    spark = df.sparkSession
    folder = folder.rstrip("/")
    version = uuid.uuid4().hex
    marked = df.withColumn(VERSION, F.lit(version))
    # Rebalancing splits a large partition and joins small ones, so a small day is one file and a large one several.
    marked = marked.hint("rebalance", *columns) if columns else marked
    marked.write.mode("append").partitionBy(*columns, VERSION).parquet(folder)
    pattern = "/".join([*(f"{c}=*" for c in columns), f"{VERSION}={version}"])
    where, files = _files(spark, f"{folder}/{pattern}")
    base = str(_files(spark, folder)[0].toUri().getPath())
    written = {str(x.getPath().getParent().toUri().getPath())[len(base) + 1 :] for x in files.globStatus(where) or []}
    old = _read_pointer(spark, folder) or {"parts": {}}
    gone = {_partition(values, columns) for values in replaced} | written
    parts = {part: v for part, v in old["parts"].items() if part not in gone} | {part: version for part in written}
    schema = StructType([f for f in df.schema.fields if f.name not in columns])
    kinds = StructType([df.schema[c] for c in columns])
    _move_pointer(spark, folder, {"columns": list(columns), "parts": parts, "schema": schema.json(), "keys": kinds.json()})


def read_parts(spark: SparkSession, folder: str) -> DataFrame:
    """The current partitions of a standing table; filters on the partition columns prune folders."""
    folder = folder.rstrip("/")
    pointer = _read_pointer(spark, folder)
    if pointer is None:
        raise FileNotFoundError(f"no published table in {folder}")
    rows = StructType.fromJson(json.loads(pointer["schema"])).fields
    keys = StructType.fromJson(json.loads(pointer["keys"])).fields
    schema = StructType([*rows, *keys])
    if not pointer["parts"]:
        return spark.createDataFrame([], schema)
    paths = ["/".join(filter(None, [folder, part, f"{VERSION}={version}"])) for part, version in sorted(pointer["parts"].items())]
    found = spark.read.schema(schema).option("basePath", folder).parquet(*paths)
    return found.select(*[f.name for f in schema.fields])


def drop_old_parts(spark: SparkSession, folder: str) -> int:
    """Delete the folders that the pointer no longer lists, and return their number. Readers must have ended."""
    folder = folder.rstrip("/")
    pointer = _read_pointer(spark, folder)
    if pointer is None:
        return 0
    pattern = "/".join([*(f"{c}=*" for c in pointer["columns"]), f"{VERSION}=*"])
    where, files = _files(spark, f"{folder}/{pattern}")
    base = str(_files(spark, folder)[0].toUri().getPath())
    kept = {"/".join(filter(None, [part, f"{VERSION}={version}"])) for part, version in pointer["parts"].items()}
    old = [x.getPath() for x in files.globStatus(where) or []
           if str(x.getPath().toUri().getPath())[len(base) + 1 :] not in kept]
    for path in old:
        files.delete(path, True)
    return len(old)
