"""Scans: tables of Parquet parts, optional ones, code tables, state that may not exist yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def fingerprint(spark: SparkSession, path: str) -> tuple[str, int, int]:
    """Path, bytes and time of change of a table: another one means that it was replaced."""
    fs, target = _fs(spark, path)
    return path, fs.getContentSummary(target).getLength(), fs.getFileStatus(target).getModificationTime()


def scan(spark: SparkSession, folder: str, name: str, schema: StructType | str | None = None) -> DataFrame:
    """The table ``name`` of ``folder``: ``name.parquet``, or the parts in a folder ``name``.

    With ``schema`` no file has to be opened to plan the scan. A missing table is an error.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    for path in (f"{folder}/{name}.parquet", f"{folder}/{name}"):
        if exists(spark, path):
            return reader.parquet(path)
    raise FileNotFoundError(f"no table {name} in {folder}")


def scan_all(spark: SparkSession, folder: str, required: list[str], optional: list[str] = ()) -> dict[str, DataFrame]:
    """The required tables of ``folder`` and those of the optional ones that are there."""
    if not exists(spark, folder):
        raise FileNotFoundError(f"no folder {folder}")
    found = {name: scan(spark, folder, name) for name in required}
    for name in optional:
        if exists(spark, f"{folder}/{name}.parquet") or exists(spark, f"{folder}/{name}"):
            found[name] = scan(spark, folder, name)
    return found


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` of the tables, counted on the executors."""
    parts = [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows") for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def codes(spark: SparkSession, path: str) -> DataFrame:
    """``(code, description)`` of a CSV code table with a header; the description may be called ``generic_name``."""
    table = spark.read.option("header", True).csv(path)
    named = [c for c in ("description", "generic_name") if c in table.columns]
    if "code" not in table.columns or not named:
        raise ValueError(f"{path} has no columns code and description")
    return table.select("code", F.col(named[0]).alias("description"))


def state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one where nothing was written yet."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
