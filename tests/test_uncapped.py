"""Blocking metrics where some blocks give no candidates to score, and with copies and records that take no part."""

import duckdb
import pytest

from kinfold.operators import blocks, evaluation, matching
from kinfold.operators.matching import MAX_BLOCK
from kinfold.plans.queries import QUERIES
from kinfold.plans.sql import SQL
from kinfold.sources.feeds import LAST
from tests.test_blocks import _records


def _plain(rows):
    return sorted([str(round(v, 6)) if isinstance(v, float) else str(v) for v in row] for row in rows)


def test_blocks_of_any_size_count(spark, tmp_path):
    duck = duckdb.connect()
    crowd = f"""SELECT k FROM (SELECT k, count(*) OVER (PARTITION BY (k * 7919 + k // 97) % {len(LAST)}, (k * 104729 // 7) % 2, year(DATE '1950-01-01' + (k * 15485863 // 11 % 9000)::INT)) AS n
      FROM (SELECT range AS k FROM range(2_000_000))) WHERE k % 97 != 5 AND k % 101 != 3 QUALIFY dense_rank() OVER (ORDER BY n DESC, (k * 7919 + k // 97) % {len(LAST)}, (k * 104729 // 7) % 2, year(DATE '1950-01-01' + (k * 15485863 // 11 % 9000)::INT)) = 1 ORDER BY k LIMIT 600"""
    duck.sql(f"copy (select k as c_custkey from ({crowd}) union all select range from range(20)) to '{tmp_path}/customer.parquet' (format parquet)")
    duck.sql(f"create view customer as select * from read_parquet('{tmp_path}/customer.parquet')")
    cursor = duck.execute(SQL["blocking_metrics"])
    names, want = [x[0] for x in cursor.description], cursor.fetchall()
    assert duck.execute(f"select max(record_count) from ({SQL['block_stats']})").fetchone()[0] > MAX_BLOCK
    got = QUERIES["blocking_metrics"](spark, str(tmp_path)).select(*names).collect()
    assert len(want) == 5 and _plain(got) == _plain(want)


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_equal_those_of_listed_pairs(spark, seed):
    records = _records(spark, 150, seed)
    truth = records.select("record_key").crossJoin(records.select(records.record_key.alias("other"))).where("record_key < other and hash(record_key, other) % 3 = 0").toDF(*evaluation.PAIR)
    listed = matching.candidate_pairs(matching.block_keys(records), None).collect()
    true = {tuple(r) for r in truth.collect()}
    want = {p: {(r[0], r[1]) for r in listed if r.blocking_pass == p} for p in matching.PASSES}
    want["unioned"] = {(r[0], r[1]) for r in listed}
    pairs, found = (dict(map(tuple, df.collect())) for df in blocks.uncapped(records, truth))
    assert pairs == {p: len(x) for p, x in want.items()} and found == {p: len(x & true) for p, x in want.items()}
    twice = dict(map(tuple, blocks.uncapped(records.unionByName(records), truth)[0].collect()))
    assert twice == {p: len(x) * (1 if p == "unioned" else 4) for p, x in want.items()}


def test_counts_of_nothing(spark):
    records = _records(spark, 1, 1)
    pairs, found = blocks.uncapped(records, records.limit(0).selectExpr("record_key as record_key_a", "record_key as record_key_b"))
    assert pairs.collect() == [] and found.collect() == []
