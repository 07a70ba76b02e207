import random

import pytest

from kinfold.operators import evaluation, identity, matching
from kinfold.operators.components import connected_components


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, j) for j in range(101, 140)] + [(200, 200), (None, 3), (5, 6), (6, 5)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 100 for i in range(100, 140)}


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_cluster_guards(spark):
    edges = spark.createDataFrame([("A", "B"), ("B", "C"), ("A", "C"), ("D", "E"), ("E", "F")], "record_key_a string, record_key_b string")
    got = {r.component: (r.confidence, r.flag_reasons) for r in matching.clusters(edges, 6, 0.9).collect()}
    assert got["A"] == (1.0, [])
    assert got["D"][1] == ["density"]
    assert {r.component: r.flag_reasons for r in matching.clusters(edges, 2, 0.5).collect()} == {"A": ["size"], "D": ["size"]}


def _crosswalk(spark, members, existing):
    m = spark.createDataFrame(members, "record_key string, cluster string")
    e = spark.createDataFrame(existing, "record_key string, patient_global_id string, first_seen_run string, last_seen_run string")
    entries, events = identity.crosswalk(m, e, "run2", 10)
    return {r.record_key: r.patient_global_id for r in entries.collect()}, sorted((r.event_type, r.surviving_id, r.retired_id) for r in events.collect())


def test_crosswalk_cases(spark):
    ids, events = _crosswalk(spark, [("A", "A"), ("B", "A"), ("C", "C")], [])
    assert ids == {"A": "PGID000000000010", "B": "PGID000000000010", "C": "PGID000000000011"}
    assert [e[0] for e in events] == ["create", "create"]
    old = [("A", "P5", "run1", "run1"), ("B", "P1", "run0", "run1"), ("Z", "P9", "run0", "run1")]
    ids, events = _crosswalk(spark, [("A", "A"), ("B", "A"), ("N", "A")], old)
    assert ids == {"A": "P1", "B": "P1", "N": "P1"} and events == [("merge", "P1", "P5")]
    ids, events = _crosswalk(spark, [("A", "A"), ("B", "B")], [("A", "P1", "run1", "run1"), ("B", "P1", "run1", "run1")])
    assert ids == {"A": "P1", "B": "PGID000000000010"}
    assert events == [("create", "PGID000000000010", None), ("split", "P1", "PGID000000000010")]


def test_plans_of_a_crosswalk_hold_each_step_once(spark):
    m = spark.createDataFrame([("A", "A"), ("B", "A"), ("C", "C"), ("D", "D")], "record_key string, cluster string")
    e = spark.createDataFrame([("A", "P1", "run0", "run0"), ("B", "P2", "run0", "run0"), ("C", "P2", "run0", "run0")], identity.CROSSWALK)
    entries, events = identity.crosswalk(m, e, "run1", 10)
    moves = [df._jdf.queryExecution().executedPlan().toString().count("Exchange ") for df in (entries, events)]
    assert max(moves) <= 12
    assert sorted((r.event_type, r.surviving_id, r.retired_id) for r in events.collect()) == [("create", "PGID000000000010", None), ("create", "PGID000000000011", None), ("merge", "P1", "P2"), ("split", "P2", "PGID000000000010")] and entries.count() == 4


def test_survivorship_rules(spark):
    rows = [
        ("1", "VENDOR_B:1", "VENDOR_B", 2, "ANN", "LEE", "1980-01-01", "1", "F"), ("1", "VENDOR_A:1", "VENDOR_A", 1, "ANNA", None, "1980-01-02", None, "F"),
        ("2", "VENDOR_C:2", "VENDOR_C", 1, "BO", "X", None, None, "M"), ("2", "VENDOR_C:3", "VENDOR_C", 1, "BOB", "X", None, None, "M"), ("2", "VENDOR_C:4", "VENDOR_C", 1, "BOB", "Y", None, None, "M"),
    ]
    df = spark.createDataFrame(rows, "patient_global_id string, record_key string, source_vendor string, normalized_at int, first_name string, last_name string, dob string, ssn string, gender string")
    for shuffled in (df, df.repartition(5)):
        got = {(r.patient_global_id, r.field_name): (r.winning_value, r.rule_applied, r.record_key) for r in identity.survive(shuffled).collect()}
        assert len(got) == 10
        assert got["1", "first_name"] == ("ANNA", "vendor_trust", "VENDOR_A:1")
        assert got["1", "last_name"] == ("LEE", "single_candidate", "VENDOR_B:1")
        assert got["1", "gender"] == ("F", "deterministic", "VENDOR_A:1")
        assert got["2", "first_name"] == ("BOB", "plurality", "VENDOR_C:3")
        assert got["2", "ssn"] == (None, "no_non_null_value", "VENDOR_C:2")


def test_snapshot_closes_and_opens(spark):
    history = spark.createDataFrame([("1", "A", "t0", None), ("2", "B", "t0", None)], "id string, v string, valid_from string, valid_to string")
    now = spark.createDataFrame([("1", "A"), ("2", "C"), ("3", "D")], "id string, v string")
    got = sorted(tuple(map(str, r)) for r in identity.snapshot(history, now, "id", ["v"], "t1").collect())
    assert got == [("1", "A", "t0", "None"), ("2", "B", "t0", "t1"), ("2", "C", "t1", "None"), ("3", "D", "t1", "None")]


def test_thresholds_of_two_scorers_in_the_plan_of_one(spark):
    levels = spark.createDataFrame([(1.0, 0.2, 5), (2.0, 0.9, 3), (3.0, 0.9, 2), (-1.00004, 0.1, 7)], "score double, naive_score double, pairs long")
    hits = spark.createDataFrame([(2.0, 0.9, 2), (3.0, 0.9, 2), (1.0, 0.2, 1)], "score double, naive_score double, tp long")
    truth = spark.createDataFrame([(i,) for i in range(6)], "k int")
    scorers = {"one": "score", "two": "naive_score"}
    got = evaluation.thresholds_of_counts(levels, hits, truth, scorers)
    one = evaluation.thresholds(evaluation.curve_of_counts(levels, hits, truth))
    exchanges = [df._jdf.queryExecution().executedPlan().toString().count("Exchange ") for df in (got, one)]
    assert exchanges[0] <= exchanges[1]
    want = [tuple(evaluation.thresholds(evaluation.curve_of_counts(levels, hits, truth, c)).first()) + (n,) for n, c in scorers.items()]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    with pytest.raises(Exception, match="empty curve"):
        evaluation.thresholds_of_counts(levels.limit(0), hits.limit(0), truth, scorers).collect()
