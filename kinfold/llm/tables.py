"""Reading the corpus tables, and names for columns that operators add for a while."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free(name: str, taken: Iterable[str]) -> str:
    """``_name``, with as many underscores in front as no column of ``taken`` has (in any case of letters)."""
    used = {c.lower() for c in taken}
    while (name := f"_{name}").lower() in used:
        continue
    return name


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Arrow batches of at most so many rows and bytes (a larger row is one of its own) for what runs within."""
    bounds = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": str(size)}
    before = {k: spark.conf.get(k) for k in bounds}
    try:
        for k, v in bounds.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
