"""A streaming front of ``api.resolve``: records that arrive are given identities, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinfold import api
from kinfold.operators import identity
from kinfold.sources import tables

RESOLVED = "record_key string, outcome string, patient_global_id string, match_score double"
#: What arrives: texts as a caller types them, dates as ``yyyy-MM-dd``.
ARRIVING = "record_key string, first_name string, last_name string, dob string, gender string, ssn string"


def resolved(spark: SparkSession, folder: str) -> DataFrame:
    """What all batches so far have decided."""
    return tables.state(spark, folder, f"{RESOLVED}, batch long").select("record_key", "outcome", "patient_global_id", "match_score")


def resolve_batch(batch: DataFrame, batch_id: int, core: DataFrame, known: DataFrame, folder: str, events: DataFrame | None = None) -> None:
    """Resolve one batch and write it under its number: a batch that is repeated replaces itself.

    ``core`` and ``known`` are the records and the crosswalk of the last run. New numbers
    start after those of earlier batches too. A key that occurs twice in a batch counts once.
    """
    spark = batch.sparkSession
    before = tables.state(spark, folder, f"{RESOLVED}, batch long").where(F.col("batch") < batch_id)
    given = before.select(F.lit("create").alias("event_type"), F.col("patient_global_id").alias("surviving_id"), F.lit(None).cast("string").alias("retired_id"))
    if events is not None:
        given = given.unionByName(events.select("event_type", "surviving_id", "retired_id"))
    new = api.normalize_records(batch.dropDuplicates(["record_key"]))
    out = api.resolve(new, core, known, given)
    out.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")


def resolve_stream(arriving: DataFrame, core: DataFrame, known: DataFrame, folder: str, checkpoint: str, **trigger: object) -> StreamingQuery:
    """Start resolving a stream of ``ARRIVING`` rows; ``trigger`` is that of ``writeStream``."""
    known = known.select(*[f.name for f in known.sparkSession.createDataFrame([], identity.CROSSWALK).schema])
    each = lambda batch, batch_id: resolve_batch(batch, batch_id, core, known, folder)
    return arriving.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
