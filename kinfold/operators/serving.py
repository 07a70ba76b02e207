"""Serving tables: facts on identities, members, and the 360 view. Every join key is equal on both sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def alternate_identifiers(entries: DataFrame) -> DataFrame:
    """``(patient_global_id, source_vendor, source_record_id)`` of a crosswalk's records."""
    return entries.select("patient_global_id", F.substring_index("record_key", ":", 1).alias("source_vendor"), F.split("record_key", ":", 2)[1].alias("source_record_id"))


def membership(entries: DataFrame) -> DataFrame:
    return entries.groupBy("patient_global_id").agg(F.count("*").alias("source_record_count"))


def by_member_id(facts: DataFrame, alternate: DataFrame, columns: list[str], member_id: str = "member_id") -> DataFrame:
    """Facts that carry their vendor's own record id."""
    alt = alternate.withColumnRenamed("source_record_id", member_id).hint("merge")  # as many rows as records: not for the driver
    return facts.join(alt, ["source_vendor", member_id]).select("patient_global_id", *columns)


def medical_history(facts: DataFrame, alternate: DataFrame) -> DataFrame:
    return by_member_id(facts, alternate, ["source_vendor", "encounter_key", "encounter_date", "condition_code", "encounter_type"])


def medical_claims(facts: DataFrame, alternate: DataFrame) -> DataFrame:
    return by_member_id(facts, alternate, ["source_vendor", "claim_key", "claim_date", "diagnosis_code", "procedure_code", "billed_amount", "paid_amount", "claim_status"])


def pharmacy_claims(facts: DataFrame, id_map: DataFrame, alternate: DataFrame) -> DataFrame:
    """Fills carry the dispenser's member number, which a map leads to the vendor's record id."""
    known = facts.join(id_map.hint("merge"), ["source_vendor", "pbm_member_id"])  # a few MB of a file may be a million rows
    return by_member_id(known, alternate, ["source_vendor", "rx_key", "fill_date", "ndc_code", "days_supply", "quantity"], "enrollment_member_id")


def pharmacy_info(persons: DataFrame, resolution: DataFrame) -> DataFrame:
    found = resolution.where("domain = 'pharmacy_info'").select("record_key", "patient_global_id", "match_score")
    return persons.join(found, "record_key").select("patient_global_id", "source_record_id", "plan_tier", "address", "phone", "match_score")


def lab_results(results: DataFrame, resolution: DataFrame) -> DataFrame:
    found = resolution.where("domain = 'lab_identity'").select("source_record_id", "patient_global_id", "match_score")
    return results.join(found, "source_record_id").select("patient_global_id", "lab_result_key", "test_date", "test_code", "result_value", "result_unit", "abnormal_flag", "match_score")


def dim_member(golden: DataFrame, members: DataFrame) -> DataFrame:
    return golden.join(members, "patient_global_id")


def member_360(golden: DataFrame, entries: DataFrame, lineage: DataFrame, facts: dict[str, DataFrame], as_of: str) -> DataFrame:
    """One row an identity: golden values, sources, and each domain's counts and latest dates.

    Every domain is reduced to one row an identity before it is joined, so nothing fans out.
    """
    key = "patient_global_id"
    count = lambda name: F.count("*").alias(name)
    sources = entries.groupBy(key).agg(count("source_record_count"), F.array_join(F.array_sort(F.collect_set("record_key")), ",").alias("alternate_identifiers"))
    active = F.date_add("fill_date", F.col("days_supply").cast("int")) >= F.lit(as_of).cast("date")
    parts: list[tuple[DataFrame, list[Column]]] = [
        (lineage, [F.countDistinct("field_name", "record_key").alias("field_lineage_rows")]),
        (facts["medical_history"], [count("encounter_count"), F.max("encounter_date").alias("most_recent_encounter_date")]),
        (facts["medical_claims"], [count("medical_claim_count"), F.max("claim_date").alias("most_recent_claim_date")]),
        (facts["pharmacy_claims"], [count("pharmacy_claim_count"), F.max("fill_date").alias("most_recent_fill_date"), F.count_if(active).alias("active_prescription_count")]),
        (facts["pharmacy_info"], [F.max("plan_tier").alias("pharmacy_plan_tier"), count("pharmacy_info_match_count")]),
        (facts["lab_results"], [count("lab_result_count"), F.max("test_date").alias("most_recent_lab_date"), F.count_if(F.col("abnormal_flag") != "normal").alias("abnormal_lab_count")]),
    ]
    out = golden.join(sources, key)
    for table, columns in parts:
        out = out.join(table.groupBy(key).agg(*columns), key, "left")
    counts = [c for c in out.columns if c.endswith("_count") or c == "field_lineage_rows"]
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def dedup_metrics(records: DataFrame, golden: DataFrame, members: DataFrame, events: DataFrame) -> DataFrame:
    """One row: totals, rate, events by type, cluster sizes."""
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("event_type") == kind, 1).otherwise(0)), F.lit(0)).alias(f"{kind}_events")
    parts = [
        records.agg(F.count("*").alias("total_source_records")), golden.agg(F.count("*").alias("total_golden_records")), events.agg(of("create"), of("merge"), of("split")),
        members.agg(F.max("source_record_count").alias("max_cluster_size"), F.round(F.avg("source_record_count"), 6).alias("avg_cluster_size")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.crossJoin(F.broadcast(part))  # one row each
    rate = F.lit(1.0) - F.col("total_golden_records") / F.nullif(F.col("total_source_records"), F.lit(0))
    return out.withColumn("dedup_rate", F.round(rate, 6))
