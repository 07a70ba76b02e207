"""Checks of a run: five that warn, and structural gates whose every violation stops it."""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import matching, matchpath
from kinfold.sources.domains import ENCOUNTERS, MATCHED, PLANS, STATUSES

if TYPE_CHECKING:
    from kinfold.plans.state import State

VALIDATION = "run_id string, check_name string, status string, value double, message string, checked_at string"


def quality_checks(st: State, as_of_year: int = 2024) -> DataFrame:
    """One row a check; a warning does not stop a run."""
    blocks = matching.block_stats(matching.block_keys(st.records)).agg(F.round(F.max("record_count") / F.sum("record_count"), 6).alias("value"))
    rate = st.membership.agg(F.round(F.coalesce(1 - F.count("*") / F.nullif(F.sum("source_record_count"), F.lit(0)), F.lit(0.0)), 6).alias("value"))
    review = (F.col("score") >= matching.LOWER) & (F.col("score") < matching.UPPER)
    queue = st.levels.agg(F.round(F.coalesce(F.sum(F.when(review, F.col("pairs")).otherwise(0)) / F.nullif(F.sum("pairs"), F.lit(0)), F.lit(0.0)), 6).alias("value"))
    born = st.records.agg(F.count_if((F.col("dob_year") < 1900) | (F.col("dob_year") > as_of_year)).cast("double").alias("value"))
    rows = [
        ("dedup_rate", rate, "value between 0 and 0.9"), ("review_queue_rate", queue, "value <= 0.5"), ("block_skew", blocks, "value <= 0.05"), ("dob_plausibility", born, "value = 0"),
        ("cluster_size", st.membership.agg(F.max("source_record_count").cast("double").alias("value")), "value <= 10"),
    ]
    parts = [df.select(F.lit(name).alias("check_name"), F.when(F.expr(ok), "pass").otherwise("warn").alias("status"), F.col("value").cast("double").alias("value")) for name, df, ok in rows]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def validation_rows(checks: DataFrame, run_id: str, checked_at: str) -> DataFrame:
    """The checks as rows of the validation history."""
    told = F.concat_ws(" ", "check_name", F.format_string("%.6f", "value"), "status")
    return checks.select(F.lit(run_id).alias("run_id"), "check_name", "status", "value", told.alias("message"), F.lit(checked_at).alias("checked_at"))


def _unique(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).count().where("count > 1")


def _same_count(a: DataFrame, b: DataFrame) -> DataFrame:
    both = a.agg(F.count("*").alias("a")).crossJoin(F.broadcast(b.agg(F.count("*").alias("b"))))  # one row each
    return both.where("a != b")


def _in_blocks(rows: DataFrame, passes: dict[str, list[str]], wanted: DataFrame) -> DataFrame:
    """The ids of rows that take part in one of some blocks."""
    each = rows.select("id", F.explode(F.array(*[F.struct(F.lit(p).alias("blocking_pass"), F.col(p).alias("block_key")) for p in passes])).alias("x")).select("id", "x.*")
    return each.join(wanted, ["blocking_pass", "block_key"], "left_semi").select("id").distinct()


def structural(st: State) -> dict[str, DataFrame]:
    """By gate, the rows that violate it."""
    n, f, keys = st.normalized, st.facts, matching.block_keys(st.records)
    on = ["blocking_pass", "block_key"]
    # Pairs are streamed. One comes twice only if a record has two keys in a pass: only blocks with such records are looked into.
    pairs = st.blocks.pairs()
    twice = keys.join(_unique(keys, "record_key", "blocking_pass").select("record_key", "blocking_pass"), ["record_key", "blocking_pass"], "left_semi")
    doubtful = matching.candidate_pairs(keys.join(twice.select(*on).distinct(), on, "left_semi"))
    sizes = matching.block_stats(keys).where("is_oversized")
    resolution, review = st.matched
    # Of the rows that make pairs those that should make none, and their pairs.
    within, people = st.blocks, st.person_blocks
    forbidden = within.left.join(_in_blocks(within.left, matching.PASSES, sizes), "id", "left_semi")
    strangers = people.left.join(st.persons.select("record_key"), "record_key", "left_anti")
    outsiders = people.right.join(st.records.select("record_key"), "record_key", "left_anti")
    crowded = people.right.join(_in_blocks(people.right, matchpath.PASSES, sizes), "id", "left_semi")
    pair = ["record_key_a", "record_key_b"]
    missing = lambda df, *columns: df.where(" or ".join(f"{c} is null" for c in columns))
    outside = lambda df, column, values: df.where(~F.col(column).isin(*values))
    orphan = lambda df: df.join(st.golden, "patient_global_id", "left_anti")
    return {
        "record_key_not_null": missing(st.records, "record_key"), "record_key_unique": _unique(st.records, "record_key"), "gender_accepted": outside(st.records, "gender", ("M", "F", "U")),
        "block_pass_accepted": outside(keys, "blocking_pass", tuple(matching.PASSES)), "block_key_not_null": missing(keys, "record_key", "blocking_pass", "block_key"), "block_stats_unique": _unique(matching.block_stats(keys), "blocking_pass", "block_key"),
        "pairs_ordered": pairs.where("record_key_a >= record_key_b"), "pairs_unique": _unique(doubtful, "record_key_a", "record_key_b", "blocking_pass"), "no_pairs_from_oversized_blocks": within.pairs(left=forbidden, right=forbidden).select(*pair),
        "crosswalk_complete": st.records.join(st.entries, "record_key", "left_anti"), "crosswalk_unique": _unique(st.entries, "record_key"), "crosswalk_not_null": missing(st.entries, "patient_global_id", "first_seen_run", "last_seen_run"),
        "event_type_accepted": outside(st.events, "event_type", ("create", "merge", "split")), "golden_unique": _unique(st.golden, "patient_global_id"), "lineage_five_fields": st.lineage.groupBy("patient_global_id").count().where("count != 5"),
        "lineage_identity_known": orphan(st.lineage), "membership_unique": _unique(st.membership, "patient_global_id"), "membership_identity_known": orphan(st.membership), "alternate_identifiers_conserved": _same_count(st.records, st.alternate),
        "encounter_key_unique": _unique(n["medical_history"], "encounter_key"), "encounter_type_accepted": outside(n["medical_history"], "encounter_type", ENCOUNTERS), "claim_key_unique": _unique(n["medical_claims"], "claim_key"),
        "claim_status_accepted": outside(n["medical_claims"], "claim_status", STATUSES), "rx_key_unique": _unique(n["pharmacy_claims"], "rx_key"), "days_supply_accepted": outside(n["pharmacy_claims"], "days_supply", (30, 60, 90)),
        "id_map_unique": _unique(n["vendor_id_map"], "source_vendor", "pbm_member_id"), "plan_tier_accepted": outside(n["pharmacy_info"], "plan_tier", PLANS), "person_key_unique": _unique(st.persons, "record_key"),
        "lab_result_key_unique": _unique(n["lab_results"], "lab_result_key"), "abnormal_flag_accepted": outside(n["lab_results"], "abnormal_flag", ("normal", "high", "low", "critical")),
        "medical_history_conserved": _same_count(n["medical_history"], f["medical_history"]), "medical_claims_conserved": _same_count(n["medical_claims"], f["medical_claims"]), "pharmacy_claims_conserved": _same_count(n["pharmacy_claims"], f["pharmacy_claims"]),
        "pharmacy_info_no_fanout": _unique(f["pharmacy_info"], "source_record_id"), "lab_results_no_fanout": _unique(f["lab_results"], "lab_result_key"),
        "matchpath_sides_not_swapped": people.pairs(left=strangers).select(*pair).unionByName(people.pairs(right=outsiders).select(*pair)),
        "no_matchpath_pairs_from_oversized_blocks": people.pairs(right=crowded).select(*pair),
        "resolution_unique": _unique(resolution, "record_key"), "resolution_domain_accepted": outside(resolution, "domain", tuple(MATCHED)), "resolution_identity_known": orphan(resolution), "review_not_resolved": review.join(resolution, "record_key", "left_semi"),
        "fact_identity_known": orphan(f["medical_claims"].select("patient_global_id")),
    }


def count_violations(gates: dict[str, DataFrame]) -> DataFrame:
    """``(gate, violations)``."""
    out = None
    for name, bad in gates.items():
        row = bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("gate"), "violations")
        out = row if out is None else out.unionByName(row)
    return out


def enforce(counted: DataFrame) -> None:
    """Raise if a gate is violated; one row a gate comes to the driver."""
    bad = counted.where("violations > 0").collect()
    if bad:
        raise RuntimeError("structural gates: " + ", ".join(f"{r['gate']} ({r['violations']})" for r in bad))
