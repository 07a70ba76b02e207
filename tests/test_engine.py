"""Configuration, sinks, whole runs, evaluation, services and the streaming front."""

import pytest
from pyspark.sql import functions as F

from kinfold import api, config, streaming
from kinfold.functions import compare
from kinfold.operators import evaluation, identity, matching, serving
from kinfold.plans import flows, gates
from kinfold.sinks import Store, append, replace
from kinfold.sources import domains, tables

FOLDER = "/root/testdata/sf0.001"
PAIRS = "record_key_a string, record_key_b string"


def test_config_files_change_defaults(tmp_path):
    base = config.load()
    assert config.thresholds(base, "dev") == (matching.UPPER, matching.LOWER) and base["trust"] == identity.TRUST and base["blocking"]["max_block_size"] == matching.MAX_BLOCK
    assert (base["comparators"]["near"], base["comparators"]["similar"]) == (compare.NEAR, compare.SIMILAR) and list(base["clustering"].values()) == [matching.MAX_CLUSTER, matching.MIN_DENSITY]
    (tmp_path / "own.yml").write_text("blocking: {max_block_size: 50}\nthresholds: {mine: {upper: 5, lower: 6}}\n")
    own = config.load(str(tmp_path / "own.yml"))
    assert own["blocking"]["max_block_size"] == 50 and own["clustering"] == base["clustering"]
    with pytest.raises(ValueError, match="above"):
        config.thresholds(own, "mine")
    with pytest.raises(KeyError, match="no thresholds"):
        config.thresholds(base, "nowhere")
    (tmp_path / "bad.yml").write_text("blocks: 1\n")
    with pytest.raises(KeyError, match="unknown"):
        config.load(str(tmp_path / "bad.yml"))
    config.save_params(str(tmp_path / "p.yml"), [{"field": "dob", "level": "exact", "m": 0.9, "u": 0.1, "weight": 3.17}], "dev", 5, 7)
    assert config.load_params(str(tmp_path / "p.yml")) == {"dob": {"exact": 3.17}}


def test_scans_and_sinks(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.scan_all(spark, str(tmp_path / "none"), [])
    replace(spark.range(10).withColumn("p", F.col("id") % 2), str(tmp_path / "t"), ["p"])
    found = tables.scan_all(spark, str(tmp_path), ["t"], ["missing"])
    assert list(found) == ["t"] and tables.row_counts(found).first()["rows"] == 10
    with pytest.raises(FileNotFoundError):
        tables.scan(spark, str(tmp_path), "missing")
    replace(spark.range(10).select("id").where("id < 0"), str(tmp_path / "empty"), cluster_by=["id"])
    assert spark.read.parquet(str(tmp_path / "empty")).columns == ["id"]
    for i in range(2):
        append(spark.createDataFrame([(i, "x")], "n int, s string"), str(tmp_path / "log"), "s string, n long")
    assert spark.read.parquet(str(tmp_path / "log")).dtypes == [("s", "string"), ("n", "bigint")] and spark.read.parquet(str(tmp_path / "log")).count() == 2
    (tmp_path / "codes.csv").write_text("code,generic_name\nA,one\nB,two\n")
    assert [tuple(r) for r in tables.codes(spark, str(tmp_path / "codes.csv")).orderBy("code").collect()] == [("A", "one"), ("B", "two")]
    store = Store(spark, str(tmp_path / "store"))
    assert store.current() is None and store.read("t", "a int").count() == 0
    store.write("r1", {"t": spark.range(3)})
    with pytest.raises(FileNotFoundError):
        store.read("t")
    store.publish("r1")
    store.write("r2", {"t": spark.range(9)})
    assert store.read("t").count() == 3
    store.publish("r2")
    assert store.current() == "r2" and store.read("t").count() == 9


def test_two_runs_keep_identities_and_a_violated_gate_publishes_nothing(spark, tmp_path, monkeypatch):
    store = flows.run(spark, FOLDER, str(tmp_path), "r1", "2024-06-30", "2024-07-01T00:00:00")
    first = {r.record_key: r.patient_global_id for r in store.read("crosswalk").collect()}
    n = store.audited("identity_events", identity.EVENTS).count()
    assert n == len(set(first.values())) and store.read("member_360").count() == n
    monkeypatch.setattr(gates, "structural", lambda st: {"bad": st.records})
    with pytest.raises(RuntimeError, match="bad"):
        flows.run(spark, FOLDER, str(tmp_path), "r2", "2024-06-30", "2024-07-02T00:00:00")
    assert store.current() == "r1" and store.audited("identity_events", identity.EVENTS).count() == n
    assert "| total_source_records | 314 |" in flows.report(store) and flows.validation_history(store).count() == 10
    entries, events = identity.crosswalk(store.read("crosswalk").select("record_key", F.col("patient_global_id").alias("cluster")), store.read("crosswalk"), "r3", 10**6)
    assert {r.record_key: r.patient_global_id for r in entries.collect()} == first and events.count() == 0


def test_reasons_name_the_identities(spark):
    members = spark.createDataFrame([("A", "A"), ("B", "A"), ("C", "C"), ("D", "D")], "record_key string, cluster string")
    old = spark.createDataFrame([("A", "PGID000000000005", "run1", "run1"), ("B", "PGID000000000001", "run0", "run1"), ("C", "PGID000000000001", "run0", "run1")], identity.CROSSWALK)
    _, events = identity.crosswalk(members, old, "run2", identity.next_number(old))
    got = {(r.event_type, r.surviving_id, r.retired_id): r.reason for r in events.collect()}
    assert got == {
        ("merge", "PGID000000000001", "PGID000000000005"): "cluster unified existing ids ['PGID000000000001', 'PGID000000000005']",
        ("create", "PGID000000000006", None): identity.ELSEWHERE, ("create", "PGID000000000007", None): identity.UNKNOWN,
        ("split", "PGID000000000001", "PGID000000000006"): "a subset of PGID000000000001's former members moved to PGID000000000006",
    }
    assert identity.next_number(old, events) == 8 and identity.next_number(old.limit(0)) == 0


def test_evaluation(spark):
    truth = spark.createDataFrame([("A", "B"), ("C", "D")], PAIRS)
    scored = spark.createDataFrame([("A", "B", 9.0), ("A", "C", 9.0), ("C", "D", 5.0)], PAIRS + ", score double")
    got = {r.score: (r.tp, r.fp, r.precision, r.recall) for r in evaluation.curve(scored, truth).collect()}
    assert got == {9.0: (1, 1, 0.5, 0.5), 5.0: (2, 1, 0.666667, 1.0)}
    best = evaluation.thresholds(evaluation.curve(scored, truth)).first()
    assert (best.upper, best.lower, best.best_f1) == (9.0, 5.0, 0.8)
    with pytest.raises(Exception, match="empty curve"):
        evaluation.thresholds(evaluation.curve(scored.limit(0), truth)).collect()
    assert tuple(evaluation.pair_metrics(scored.limit(0), truth).first()) == (0, 0, 2, 0.0, 0.0, 0.0)
    assert evaluation.parity(scored, scored, ["score"]).count() == 0 and evaluation.parity(scored, scored.limit(2), ["score"]).first().only_in == "left"
    records = spark.createDataFrame([(f"R{i}",) for i in range(50)], "record_key string")
    some = evaluation.non_match_pairs(records, spark.createDataFrame([("R1", "R2")], PAIRS), 200)
    assert 100 < some.count() <= 200 and some.where("record_key_a >= record_key_b").count() == 0 and evaluation.non_match_pairs(records.limit(1), truth, 5).count() == 0


def test_large_components_are_flagged_without_a_list(spark, monkeypatch):
    monkeypatch.setattr(matching, "MAX_LISTED", 5)
    edges = spark.createDataFrame([("A", f"B{i}") for i in range(9)] + [("X", "Y")], PAIRS)
    got = {r.component: r for r in matching.clusters(edges).collect()}
    assert got["A"].members is None and got["A"].size == 10 and got["A"].flagged and got["X"].members == ["X", "Y"]
    records = spark.createDataFrame([(k,) for k in ["A", "X", "Y", *[f"B{i}" for i in range(9)]]], "record_key string")
    assert {r.record_key: r.cluster for r in matching.membership(records, matching.clusters(edges)).collect()} == {"A": "A", "X": "X", "Y": "X"} | {f"B{i}": f"B{i}" for i in range(9)}


def test_services(spark):
    facts = {"medical_claims": spark.createDataFrame([("P1", f"C{i}") for i in range(9)], "patient_global_id string, claim_key string")}
    view = spark.createDataFrame([("P1", "Johnson", 3), ("P2", "SONG", 5), ("P3", None, 1)], "patient_global_id string, last_name string, source_record_count int")
    assert [r.claim_key for r in api.member_page(facts, "medical_claims", "P1", 2, 3).collect()] == ["C3", "C4"]
    for wrong in ((0, 0), (501, 0), (5, -1)):
        with pytest.raises(ValueError):
            api.member_page(facts, "medical_claims", "P1", *wrong)
    with pytest.raises(KeyError):
        api.member_page(facts, "dental", "P1")
    with pytest.raises(LookupError):
        api.member_summary(view, facts, "P9")
    assert api.member_summary(view, facts, "P1").first().total == 9
    assert [r.patient_global_id for r in api.search_members(view, "son").collect()] == ["P2", "P1"]
    typed = spark.createDataFrame([("k", " ann ", "", "1980-3-7", "x", "12-3"), ("l", None, "lee", "no", None, "")], streaming.ARRIVING)
    got = {r.record_key: r for r in api.normalize_records(typed).collect()}
    assert (got["k"].first_name, got["k"].last_name, str(got["k"].dob), got["k"].gender, got["k"].ssn) == ("ANN", None, "1980-03-07", "U", "123") and (got["l"].dob, got["l"].ssn) == (None, None)
    keys = spark.createDataFrame([("VENDOR_D:1",), ("VENDOR_B_PHARMACY:2",)], "k string")
    assert [r[0] for r in keys.select(domains.domain_of(F.col("k"))).collect()] == ["lab_identity", "pharmacy_info"]
    with pytest.raises(Exception, match="no domain"):
        spark.createDataFrame([("X:1",)], "k string").select(domains.domain_of(F.col("k"))).collect()
    assert serving.membership(spark.createDataFrame([], identity.CROSSWALK)).count() == 0


def test_streamed_records_get_identities_once(spark, tmp_path):
    core = api.normalize_records(spark.createDataFrame([("A:1", "ANN", "LEE", "1980-01-02", "F", "123456789")], streaming.ARRIVING))
    known = spark.createDataFrame([("A:1", "PGID000000000041", "r1", "r1")], identity.CROSSWALK)
    (tmp_path / "in").mkdir()
    rows = [("N:1", "ann", "lee", "1980-01-02", "f", "123-45-6789"), ("N:2", "Bob", "Stone", "1999-09-09", "m", None), ("N:2", "Bob", "Stone", "1999-09-09", "m", None)]
    spark.createDataFrame(rows, streaming.ARRIVING).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def once():
        arriving = spark.readStream.schema(streaming.ARRIVING).parquet(str(tmp_path / "in"))
        streaming.resolve_stream(arriving, core, known, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return {r.record_key: (r.outcome, r.patient_global_id) for r in streaming.resolved(spark, str(tmp_path / "out")).collect()}

    assert once() == {"N:1": ("matched", "PGID000000000041"), "N:2": ("created", "PGID000000000042")}
    spark.createDataFrame([("N:3", "Zed", "Quick", "2001-01-01", "m", None)], streaming.ARRIVING).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert once()["N:3"] == ("created", "PGID000000000043")
