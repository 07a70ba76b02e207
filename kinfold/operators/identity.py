"""Stable identities across runs, golden records, snapshots and quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.session import materialize, unsent

TRUST = {
    "first_name": ["VENDOR_A", "VENDOR_B", "VENDOR_C"],
    "last_name": ["VENDOR_A", "VENDOR_B", "VENDOR_C"],
    "dob": ["VENDOR_A", "VENDOR_C", "VENDOR_B"],
    "ssn": ["VENDOR_A", "VENDOR_B"],
    "gender": ["VENDOR_A", "VENDOR_B", "VENDOR_C"],
}
RULES = ("vendor_trust", "plurality", "completeness", "recency", "deterministic")


def mint(number: Column) -> Column:
    return F.format_string("PGID%012d", number)


CROSSWALK = "record_key string, patient_global_id string, first_seen_run string, last_seen_run string"
EVENTS = "event_type string, surviving_id string, retired_id string, run_id string, reason string"
#: Why an identity was created.
ELSEWHERE, UNKNOWN = "all prior ids already claimed elsewhere this run", "new cluster, no prior crosswalk entry"


def next_number(existing: DataFrame, events: DataFrame | None = None) -> int:
    """The number after all that were given out: to living identities, and to those that events mention."""
    ids = existing.select("patient_global_id")
    if events is not None:
        ids = ids.union(events.select("surviving_id")).union(events.select("retired_id"))
    number = F.nullif(F.regexp_extract("patient_global_id", "^PGID([0-9]+)$", 1), F.lit("")).cast("long")
    last = ids.agg(F.max(number).alias("n")).first()["n"]
    return 0 if last is None else last + 1


def _stored(df: DataFrame, label: str) -> DataFrame:
    out = materialize(df, label)
    return unsent(out, out)


def crosswalk(members: DataFrame, existing: DataFrame, run_id: str, first_number: int) -> tuple[DataFrame, DataFrame]:
    """Identities of this run's clusters, and the events that changed identities.

    ``members``: ``(record_key, cluster)``, a cluster named by its smallest member.
    ``existing``: ``(record_key, patient_global_id, first_seen_run, last_seen_run)``. An id goes
    to the first cluster that holds a record which had it; a cluster with several takes the
    oldest; one with none gets a new one, numbered from ``first_number`` in cluster order.
    Records absent from this run are dropped. Run ids must sort in time. What entries and
    events share is written once: in the driver, a plan that makes it anew for each of them
    takes more than its rows.
    """
    prior = members.join(existing, "record_key")
    oldest = existing.groupBy("patient_global_id").agg(F.min("first_seen_run").alias("since"))
    held = prior.select("cluster", "patient_global_id").distinct().join(oldest, "patient_global_id")
    held = _stored(held.withColumn("claimant", F.min("cluster").over(Window.partitionBy("patient_global_id"))), "held")
    mine = held.where("claimant = cluster")
    taken = mine.groupBy("cluster").agg(F.min(F.struct("since", "patient_global_id")).alias("best")).select("cluster", F.col("best.patient_global_id").alias("kept"))
    every = members.groupBy("cluster").agg(F.count("*").alias("n")).join(taken, "cluster", "left")
    had = held.select("cluster").distinct().withColumn("had", F.lit(True))
    # Numbers by cluster order, in two levels: counts of range partitions, then ranks within.
    ranged = materialize(every.where("kept is null").select("cluster").repartitionByRange("cluster").withColumn("part", F.spark_partition_id()), "bare")
    bare = unsent(ranged, ranged)
    ahead = bare.groupBy("part").agg(F.count("*").alias("n"))
    ahead = ahead.withColumn("ahead", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "ahead")  # one row a partition
    numbered = bare.withColumn("within", F.row_number().over(Window.partitionBy("part").orderBy("cluster"))).join(ahead, "part")
    fresh = unsent(numbered.select("cluster", mint(F.lit(first_number) + F.col("ahead") + F.col("within") - 1).alias("minted")), ranged)
    ids = _stored(every.join(fresh, "cluster", "left").join(had, "cluster", "left").withColumn("patient_global_id", F.coalesce("kept", "minted")), "ids")
    entries = members.join(ids.select("cluster", "patient_global_id"), "cluster").join(existing.select("record_key", "first_seen_run"), "record_key", "left")
    entries = entries.select("record_key", "patient_global_id", F.coalesce("first_seen_run", F.lit(run_id)).alias("first_seen_run"), F.lit(run_id).alias("last_seen_run"))
    run = F.lit(run_id).alias("run_id")
    nothing = F.lit(None).cast("string").alias("retired_id")
    created = ids.where("kept is null").select(F.lit("create").alias("event_type"), F.col("patient_global_id").alias("surviving_id"), nothing, run, F.when(F.col("had"), ELSEWHERE).otherwise(UNKNOWN).alias("reason"))
    joined = mine.groupBy("cluster").agg(F.array_join(F.array_sort(F.collect_set("patient_global_id")), "', '").alias("ids"))
    unified = F.concat(F.lit("cluster unified existing ids ['"), "ids", F.lit("']"))
    merged = mine.join(taken, "cluster").join(joined, "cluster").where("patient_global_id != kept").select(F.lit("merge").alias("event_type"), F.col("kept").alias("surviving_id"), F.col("patient_global_id").alias("retired_id"), run, unified.alias("reason"))
    split = held.where("claimant != cluster").select("cluster", F.col("patient_global_id").alias("old")).join(ids.select("cluster", "patient_global_id"), "cluster")
    split = split.select(F.lit("split").alias("event_type"), F.col("old").alias("surviving_id"), F.col("patient_global_id").alias("retired_id"), run, F.concat(F.lit("a subset of "), "old", F.lit("'s former members moved to "), "patient_global_id").alias("reason"))
    return entries, created.unionByName(merged).unionByName(split)


def survive(records: DataFrame, fields: tuple[str, ...] = tuple(TRUST)) -> DataFrame:
    """Golden values with lineage: one row an identity and field.

    ``records`` holds ``patient_global_id``, ``record_key``, ``source_vendor``, ``normalized_at``
    and the fields. While an identity's candidates for a field differ, the rules drop some in
    turn: trusted vendor, most frequent value, most complete record, latest record, smallest key.
    """
    full = sum([(F.col(f).isNotNull() & (F.col(f).cast("string") != "")).cast("int") for f in fields], F.lit(0))
    tall = records.withColumn("full", full).select(
        "patient_global_id", "record_key", "source_vendor", "normalized_at", "full",
        F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value"), F.coalesce(F.array_position(F.array(*[F.lit(v) for v in TRUST[f]]), F.col("source_vendor")), F.lit(0)).alias("trust")) for f in fields])).alias("x"),
    ).select("patient_global_id", "record_key", "source_vendor", "normalized_at", "full", "x.*")
    group = Window.partitionBy("patient_global_id", "field_name")
    valued = tall.where("value is not null and value != ''").withColumn("n", F.count("*").over(group)).withColumn("rule", F.lit(None).cast("string"))
    for name in RULES:
        valued = valued.withColumn("differ", F.min("value").over(group) != F.max("value").over(group))
        if name == "vendor_trust":
            best = F.min(F.when(F.col("trust") > 0, F.col("trust"))).over(group)
            keep = best.isNull() | (F.col("trust") == best)
        elif name == "plurality":
            valued = valued.withColumn("times", F.count("*").over(Window.partitionBy("patient_global_id", "field_name", "value")))
            keep = F.col("times") == F.max("times").over(group)
        elif name == "completeness":
            keep = F.col("full") == F.max("full").over(group)
        elif name == "recency":
            keep = F.col("normalized_at") == F.max("normalized_at").over(group)
        else:
            keep = F.col("record_key") == F.min("record_key").over(group)
        valued = valued.withColumn("keep", ~F.col("differ") | keep)
        valued = valued.withColumn("rule", F.when(F.max(~F.col("keep")).over(group), name).otherwise(F.col("rule"))).where("keep")
    won = valued.groupBy("patient_global_id", "field_name").agg(F.min(F.struct("record_key", "value", "source_vendor")).alias("w"), F.max("rule").alias("rule"), F.max("n").alias("n"))
    first = records.groupBy("patient_global_id").agg(F.min(F.struct("record_key", "source_vendor")).alias("f"))
    grid = first.select("patient_global_id", "f", F.explode(F.array(*[F.lit(f) for f in fields])).alias("field_name"))
    rule = F.when(F.col("n").isNull(), "no_non_null_value").otherwise(F.coalesce("rule", F.when(F.col("n") > 1, "deterministic").otherwise("single_candidate")))
    out = grid.join(won, ["patient_global_id", "field_name"], "left")
    return out.select("patient_global_id", "field_name", F.col("w.value").alias("winning_value"), F.coalesce("w.source_vendor", "f.source_vendor").alias("source_vendor"), F.coalesce("w.record_key", "f.record_key").alias("record_key"), rule.alias("rule_applied"))


def demographics(lineage: DataFrame) -> DataFrame:
    """One row an identity; of the SSN only the last four digits."""
    of = lambda f: F.max(F.when(F.col("field_name") == f, F.col("winning_value")))
    return lineage.groupBy("patient_global_id").agg(of("first_name").alias("first_name"), of("last_name").alias("last_name"), of("dob").cast("date").alias("dob"), of("gender").alias("gender"), F.right(of("ssn"), F.lit(4)).alias("ssn_last4"))


def masked(lineage: DataFrame) -> DataFrame:
    """Lineage for serving: of SSNs only the last four digits."""
    return lineage.withColumn("winning_value", F.when(F.col("field_name") == "ssn", F.right("winning_value", F.lit(4))).otherwise(F.col("winning_value")))


def snapshot(history: DataFrame, current: DataFrame, key: str, checked: list[str], at: str) -> DataFrame:
    """Type-2 history: open rows whose checked columns changed are closed at ``at``, new versions opened."""
    open_ = history.where("valid_to is null")
    now = current.select(F.col(key).alias("_key"), F.struct(*checked).alias("_new"))
    joined = open_.join(now, open_[key] == now["_key"], "left")
    changed = F.col("_key").isNotNull() & ~F.struct(*[F.col(c) for c in checked]).eqNullSafe(F.col("_new"))
    closed = joined.withColumn("valid_to", F.when(changed, F.lit(at)).otherwise(F.col("valid_to"))).select(*history.columns)
    old = open_.select(F.col(key).alias("_old"), F.struct(*checked).alias("_was"))
    fresh = current.join(old, current[key] == old["_old"], "left").where(F.col("_old").isNull() | ~F.struct(*[F.col(c) for c in checked]).eqNullSafe(F.col("_was")))
    opened = fresh.select(key, *checked, F.lit(at).alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    return history.where("valid_to is not null").unionByName(closed).unionByName(opened.select(*history.columns))
