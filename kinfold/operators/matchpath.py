"""Persons of files without shared ids, matched to the core population; none of them creates an identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinfold.operators import matching

#: All passes but the one on SSN, which these files do not have.
PASSES = {name: columns for name, columns in matching.PASSES.items() if name != "bp_ssn"}


def block_keys(persons: DataFrame, core: DataFrame) -> DataFrame:
    """``(record_key, blocking_pass, block_key, side)`` of both populations."""
    return matching.block_keys(persons, PASSES).withColumn("side", F.lit("matchpath")).unionByName(matching.block_keys(core, PASSES).withColumn("side", F.lit("core")))


def block_stats(keys: DataFrame, max_block: int = matching.MAX_BLOCK) -> DataFrame:
    """Block sizes on the core side, which is what a person is compared with."""
    return matching.block_stats(keys.where("side = 'core'"), max_block)


def candidate_pairs(keys: DataFrame, max_block: int = matching.MAX_BLOCK) -> DataFrame:
    """Distinct ``(record_key_a, record_key_b)``: a person of a file and a core record that share a block.

    Blocks that are oversized on the core side give none.
    """
    on = ["blocking_pass", "block_key"]
    small = block_stats(keys, max_block).where("not is_oversized").select(*on)
    core = keys.where("side = 'core'").join(small, on, "left_semi").select(*on, F.col("record_key").alias("record_key_b"))
    return keys.where("side = 'matchpath'").select(*on, F.col("record_key").alias("record_key_a")).join(core, on).select("record_key_a", "record_key_b").distinct()


def best(scored: DataFrame, decision: str) -> DataFrame:
    """Of each person the best pair with a decision; of equal scores the smallest core key."""
    some = scored.where(matching.decide(F.col("score")) == decision)
    order = Window.partitionBy("record_key_a").orderBy(F.desc(F.round("score", 4)), "record_key_b")
    return some.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def resolve(scored: DataFrame, persons: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The resolution of persons with an automatic match, and the review queue of the others.

    ``persons``: ``(record_key, domain, source_record_id)``; ``entries``: the core's crosswalk. A
    person whose match has no identity there is not resolved.
    """
    auto = best(scored, "auto_match")
    named = persons.select(F.col("record_key").alias("record_key_a"), "domain", "source_record_id")
    ids = entries.select(F.col("record_key").alias("record_key_b"), "patient_global_id")
    resolution = auto.join(named, "record_key_a").join(ids, "record_key_b").select("domain", F.col("record_key_a").alias("record_key"), "source_record_id", "patient_global_id", F.col("record_key_b").alias("matched_core_record_key"), F.round("score", 4).alias("match_score"))
    open_ = best(scored, "review").join(auto.select("record_key_a"), "record_key_a", "left_anti").join(named, "record_key_a")
    review = open_.select("domain", F.col("record_key_a").alias("record_key"), F.col("record_key_b").alias("candidate_core_record_key"), F.round("score", 4).alias("score"), F.lit("pending").alias("status"))
    return resolution, review


def resolve_best(best: DataFrame, persons: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same from each person's best automatic match and best pair to review (``blocks.Blocks.best``)."""
    named = persons.select(F.col("record_key").alias("record_key_a"), "domain", "source_record_id")
    ids = entries.select(F.col("record_key").alias("record_key_b"), "patient_global_id")
    auto = best.where("auto is not null").select("record_key_a", "auto.record_key_b", "auto.score")
    resolution = auto.join(named, "record_key_a").join(ids, "record_key_b").select("domain", F.col("record_key_a").alias("record_key"), "source_record_id", "patient_global_id", F.col("record_key_b").alias("matched_core_record_key"), F.col("score").alias("match_score"))
    open_ = best.where("auto is null and review is not null").join(named, "record_key_a")
    review = open_.select("domain", F.col("record_key_a").alias("record_key"), F.col("review.record_key_b").alias("candidate_core_record_key"), F.col("review.score").alias("score"), F.lit("pending").alias("status"))
    return resolution, review


def metrics(resolution: DataFrame, persons: DataFrame, truth: DataFrame) -> DataFrame:
    """Precision and recall by file and ``overall``.

    ``truth``: ``(record_key, k)`` of persons and core records; persons whose ``k`` no core
    record has cannot be found and do not count against recall.
    """
    core = truth.select(F.col("record_key").alias("matched_core_record_key"), F.col("k").alias("core_k"))
    mine = truth.select("record_key", "k")
    findable = persons.select("record_key", "domain").join(mine, "record_key").join(truth.join(persons.select("record_key"), "record_key", "left_anti").select("k").distinct(), "k", "left_semi")
    hits = resolution.join(mine, "record_key").join(core, "matched_core_record_key").select("domain", (F.col("k") == F.col("core_k")).alias("hit"))
    both = lambda df: df.unionByName(df.withColumn("domain", F.lit("overall")))
    found = both(hits).groupBy("domain").agg(F.count_if("hit").alias("tp"), F.count_if(~F.col("hit")).alias("fp"))
    total = both(findable.select("domain")).groupBy("domain").agg(F.count("*").alias("true_matches"))
    out = total.join(found, "domain", "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("tp", "fp")})
    ratio = lambda a, b: F.round(F.when(b > 0, a / b).otherwise(0.0), 6)
    return out.select("domain", "tp", "fp", (F.col("true_matches") - F.col("tp")).alias("fn"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("true_matches")).alias("recall"))
