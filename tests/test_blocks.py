"""Streamed pairs against pairs made one by one, and what queries over them write."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kinfold import session
from kinfold.operators import blocks, evaluation, matching
from kinfold.operators.components import connected_components, thinned
from kinfold.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
FEED = "vendor string, record_id string, first_name string, last_name string, dob string, gender string, ssn string"


def _records(spark, n, seed):
    rng = random.Random(seed)
    one = lambda i: ("VENDOR_A", f"{i:06}", rng.choice(["BOB", "ROBERT", "ROBRET", "ANN", "ANNE", "", None]), rng.choice(["LEE", "LEA", "SMITH", "SMTIH", None]), rng.choice(["1980-01-02", "1980-02-01", "1980-01-03", "1981-01-02", None]), rng.choice(["M", "F", "", None]), rng.choice([None, "", "111", "222", "333"]))
    return matching.patient_normalized(spark.createDataFrame([one(i) for i in range(n)], FEED))


@pytest.mark.parametrize("max_block", [5, 30, 1000])
def test_streamed_pairs_equal_stored_ones(spark, max_block):
    records = _records(spark, 120, max_block)
    want = matching.score_pairs(matching.candidate_pairs(matching.block_keys(records), max_block), records)
    made = blocks.Blocks(blocks.rows(blocks.numbered(records), large=blocks.oversized(records, max_block=max_block)))
    got = made.scored().select(*want.columns)
    assert want.count() == got.count() and want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty()
    assert made.levels().agg(F.sum("pairs")).first()[0] == want.count()


def test_thinned_edges_keep_components(spark):
    rng = random.Random(3)
    edges = spark.createDataFrame([(rng.randrange(300), rng.randrange(300)) for _ in range(260)], "a long, b long").where("a != b")
    few = thinned(edges.coalesce(1), "a", "b")
    assert few.count() < edges.count()
    got, want = (sorted(map(tuple, connected_components(e, "a", "b").collect())) for e in (few, edges))
    assert got == want


def _stored(spark, name, labels):
    before = len(session._written)
    QUERIES[name](spark, FOLDER).collect()
    return [path for _, path in session._written[before:] if any(f"kinfold-{label}-" in path for label in labels)]


@pytest.mark.parametrize("name", ["pair_scores", "agreement_vectors", "pr_curve", "pr_curve_naive", "blocking_metrics", "match_metrics", "thresholds", "scoring_comparison", "tier_parity", "matchpath_metrics", "fct_medical_claims", "fct_pharmacy_claims", "fact_conservation", "member_claims_page", "member_page", "resolve_batch", "structural_gates"])
def test_candidates_are_not_stored(spark, name):
    assert _stored(spark, name, ["scored", "pairs", "matchpath"]) == []


def test_tier_parity_plans_one_pass_at_a_time(spark):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    store = spark._jsparkSession.sharedState().statusStore()
    began = store.executionsCount()
    try:
        assert QUERIES["tier_parity"](spark, FOLDER).collect() == []
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(began, store.executionsList().size())]
    joins = [len(re.findall(r"^Left keys \[\d+\]: \[a_bp_", plan, re.MULTILINE)) for plan in plans]
    assert max(joins) == 1 and sum(joins) == 2 * len(matching.PASSES)


def test_parity_of_pieces_finds_a_difference_in_any(spark):
    piece = lambda *rows: spark.createDataFrame(rows, "record_key_a string, record_key_b string, score double")
    left = [piece(("A", "B", 1.0), ("A", "B", 1.0)), piece(("C", "D", 2.0))]
    columns = ["record_key_a", "record_key_b", "score"]
    same = [piece(("C", "D", 2.0), ("A", "B", 1.0)), piece(("A", "B", 1.0))]
    assert evaluation.parity_in_parts(left, same, columns).collect() == []
    other = [piece(("A", "B", 1.0)), piece(("C", "D", 2.5))]
    got = sorted(map(tuple, evaluation.parity_in_parts(left, other, columns).collect()))
    assert got == [("A", "B", "1.0", "left"), ("C", "D", "2.0", "left"), ("C", "D", "2.5", "right")]
