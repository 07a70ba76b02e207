"""Tables that runs write: replaced, appended, and published together.

A run writes its tables into a folder of its own; ``publish`` then makes it the current one
by writing one small pointer. Readers see all tables of a run or all of the one before, and
a run that fails leaves the current one as it was. Every table is written by the executors
in one job, whatever its size, and an empty one still has its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.sources import tables


def replace(df: DataFrame, path: str, partition_by: list[str] | None = None, cluster_by: list[str] | None = None) -> None:
    """Write ``df`` as the whole table; partitioned by columns, or with like rows together."""
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append(df: DataFrame, path: str, schema: str) -> None:
    """Add rows to an audit table; its columns are those of ``schema``, in order, also if there are no rows."""
    fields = df.sparkSession.createDataFrame([], schema).schema
    df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in fields]).write.mode("append").parquet(path)


class Store:
    """Runs below ``root``, and which of them is current."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def current(self) -> str | None:
        """The run that readers see."""
        path = f"{self.root}/current"
        return self.spark.read.text(path).first()[0] if tables.exists(self.spark, path) else None

    def path(self, run_id: str, name: str) -> str:
        return f"{self.root}/{run_id}/{name}"

    def write(self, run_id: str, named: dict[str, DataFrame]) -> None:
        for name, df in named.items():
            replace(df, self.path(run_id, name))

    def read(self, name: str, schema: str | None = None) -> DataFrame:
        """A table of the current run; without one an empty table of ``schema``, or an error."""
        run = self.current()
        if run is not None and tables.exists(self.spark, self.path(run, name)):
            return self.spark.read.parquet(self.path(run, name))
        if schema is None:
            raise FileNotFoundError(f"no run below {self.root} has published {name}")
        return self.spark.createDataFrame([], schema)

    def publish(self, run_id: str) -> None:
        """Make ``run_id`` current: the pointer is written aside and renamed."""
        aside, path = f"{self.root}/next-{run_id}", f"{self.root}/current"
        self.spark.createDataFrame([(run_id,)], "value string").coalesce(1).write.mode("overwrite").text(aside)
        fs, target = tables._fs(self.spark, path)
        if fs.exists(target):
            fs.delete(target, True)
        fs.rename(tables._fs(self.spark, aside)[1], target)

    def audit(self, name: str, rows: DataFrame, schema: str) -> None:
        """Add rows to a table that all runs share."""
        append(rows, f"{self.root}/audit/{name}", schema)

    def audited(self, name: str, schema: str) -> DataFrame:
        return tables.state(self.spark, f"{self.root}/audit/{name}", schema)
