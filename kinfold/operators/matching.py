"""Conformance, blocking, scoring, triage and clustering of person records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.clean import DATE_FORMATS, clean_name, digits, parse_date, phonetic_key, standard_gender
from kinfold.functions.compare import agreement
from kinfold.operators.components import connected_components, thinned
from kinfold.session import materialize, unsent

FIELDS = ("first_name", "last_name", "dob", "ssn", "gender")
#: Weights in bits of each level of agreement, estimated on labelled pairs.
WEIGHTS = {
    "first_name": {"exact": 6.8708, "nickname": 5.6743, "near": 6.3311, "similar": 0.1901, "different": -8.3777, "missing": -0.5366},
    "last_name": {"exact": 8.3026, "nickname": -0.5366, "near": 7.6166, "similar": -0.6637, "different": -8.8134, "missing": -0.5366},
    "dob": {"exact": 13.9382, "transposed": 10.6157, "one_component_off": 5.0716, "year_only": -0.1946, "different": -10.5596, "missing": -0.5366},
    "ssn": {"exact": 12.5653, "different": -13.5046, "missing": 0.2175},
    "gender": {"exact": 1.0047, "different": -13.8292, "missing": -0.5366},
}
#: Hand-set weight of each field and share of it that each level earns.
NAIVE_FIELD = {"first_name": 0.2, "last_name": 0.2, "dob": 0.3, "ssn": 0.2, "gender": 0.1}
NAIVE_LEVEL = {"exact": 1.0, "nickname": 0.8, "near": 0.7, "similar": 0.5, "transposed": 0.8, "one_component_off": 0.6, "year_only": 0.3}
PASSES = {"bp_ssn": ["ssn"], "bp_dob_lname": ["dob", "last_name_phonetic"], "bp_year_names": ["dob_year", "first_name_phonetic", "last_name_phonetic"], "bp_coarse": ["last_name_phonetic", "gender", "dob_year"]}
MAX_BLOCK = 1000
UPPER, LOWER = 9.5203, 2.0
MAX_CLUSTER, MIN_DENSITY = 6, 0.6
#: Members of a component that are listed.
MAX_LISTED = 1000


def stage(feed: DataFrame, vendor: str) -> DataFrame:
    """One vendor's records in the common schema."""
    return feed.where(F.col("vendor") == vendor).select(
        F.col("vendor").alias("source_vendor"), F.col("record_id").alias("source_record_id"), F.concat("vendor", F.lit(":"), "record_id").alias("record_key"),
        clean_name(F.col("first_name")).alias("first_name"), clean_name(F.col("last_name")).alias("last_name"),
        parse_date(F.col("dob"), DATE_FORMATS[vendor]).alias("dob"), standard_gender(F.col("gender")).alias("gender"), digits(F.col("ssn")).alias("ssn"),
    )


def patient_normalized(feed: DataFrame) -> DataFrame:
    """All vendors' records with phonetic keys and birth year and decade; nothing is merged."""
    parts = [stage(feed, v) for v in DATE_FORMATS]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    year = F.year("dob")
    return every.select("*", phonetic_key(F.col("first_name")).alias("first_name_phonetic"), phonetic_key(F.col("last_name")).alias("last_name_phonetic"), year.alias("dob_year"), (F.floor(year / 10) * 10).cast("int").alias("dob_decade"))


def block_keys(records: DataFrame, passes: dict[str, list[str]] = PASSES) -> DataFrame:
    """``(record_key, blocking_pass, block_key)``: one scan; a pass with a null in its key is skipped."""
    one = [F.struct(F.lit(name).alias("blocking_pass"), F.concat_ws("|", *[F.col(c).cast("string") for c in cols]).alias("block_key"), sum([F.col(c).isNull().cast("int") for c in cols], F.lit(0)).alias("gone")) for name, cols in passes.items()]
    keyed = records.select("record_key", F.explode(F.array(*one)).alias("b")).where("b.gone = 0")
    return keyed.select("record_key", "b.blocking_pass", "b.block_key")


def block_stats(keys: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    counted = keys.groupBy("blocking_pass", "block_key").agg(F.count("*").alias("record_count"))
    return counted.withColumn("is_oversized", F.col("record_count") > max_block)


def candidate_pairs(keys: DataFrame, max_block: int | None = MAX_BLOCK) -> DataFrame:
    """Pairs of records in one block, smaller key first, one row a pass. Oversized blocks give none."""
    stats = block_stats(keys, max_block or (1 << 62)).where("not is_oversized and record_count > 1")
    kept = keys.join(stats.select("blocking_pass", "block_key"), ["blocking_pass", "block_key"], "left_semi")
    other = kept.select(F.col("record_key").alias("record_key_b"), "blocking_pass", "block_key")
    pairs = kept.withColumnRenamed("record_key", "record_key_a").join(other, ["blocking_pass", "block_key"]).where("record_key_a < record_key_b")
    return pairs.select("record_key_a", "record_key_b", "blocking_pass", "block_key")


def with_records(pairs: DataFrame, records: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """Pairs with both records' fields as ``a_*`` and ``b_*``; no side is broadcast by hand."""
    out = pairs
    for side, table in (("a", records), ("b", records if other is None else other)):
        out = out.join(table.select(F.col("record_key").alias(f"record_key_{side}"), *[F.col(f).alias(f"{side}_{f}") for f in FIELDS]), f"record_key_{side}")
    return out


def _weight(field: str, table: dict[str, float]) -> Column:
    levels = F.create_map(*[F.lit(x) for item in table.items() for x in item])
    return F.coalesce(F.try_element_at(levels, F.col(field)), F.lit(0.0))


def score_pairs(pairs: DataFrame, records: DataFrame, other: DataFrame | None = None, weights: dict[str, dict[str, float]] = WEIGHTS) -> DataFrame:
    """Distinct pairs with their levels, the Fellegi-Sunter ``score`` and the ``naive_score``."""
    distinct = pairs.select("record_key_a", "record_key_b").distinct()
    leveled = agreement(with_records(distinct, records, other))
    score, naive = F.lit(0.0), F.lit(0.0)
    for f in FIELDS:
        score = score + _weight(f, weights[f])
        naive = naive + F.lit(NAIVE_FIELD[f]) * _weight(f, NAIVE_LEVEL)
    return leveled.select("record_key_a", "record_key_b", *FIELDS, score.alias("score"), naive.alias("naive_score"))


def decide(score: Column, upper: float = UPPER, lower: float = LOWER) -> Column:
    return F.when(score >= upper, "auto_match").when(score >= lower, "review").otherwise("non_match")


def deterministic_pairs(records: DataFrame) -> DataFrame:
    """Pairs equal in SSN, or in both names and birth date; the SSN rule counts first."""
    found = None
    for rank, (rule, cols) in enumerate({"ssn_exact": ["ssn"], "name_dob_exact": ["first_name", "last_name", "dob"]}.items()):
        some = records.dropna(subset=cols).select("record_key", *cols)
        pairs = some.withColumnRenamed("record_key", "record_key_a").join(some.withColumnRenamed("record_key", "record_key_b"), cols).where("record_key_a < record_key_b")
        pairs = pairs.select("record_key_a", "record_key_b", F.struct(F.lit(rank).alias("r"), F.lit(rule).alias("rule")).alias("x"))
        found = pairs if found is None else found.unionByName(pairs)
    return found.groupBy("record_key_a", "record_key_b").agg(F.min("x").alias("x")).select("record_key_a", "record_key_b", "x.rule")


def clusters(edges: DataFrame, max_size: int = MAX_CLUSTER, min_density: float = MIN_DENSITY, names: DataFrame | None = None) -> DataFrame:
    """Components of distinct edges with size, density (confidence) and the reasons for a flag.

    With ``names`` (``id`` and ``record_key`` in the same order) the edges are between ids.

    ``members`` are listed up to ``MAX_LISTED`` of them; a larger component, which is flagged in
    any case, has none, so that no task has to hold it.
    """
    edges = materialize(edges.select("record_key_a", "record_key_b").distinct(), "edges")
    nodes = connected_components(edges if names is None else thinned(edges, "record_key_a", "record_key_b"), "record_key_a", "record_key_b", growing=True)
    degrees = unsent(edges, edges).groupBy("record_key_a").agg(F.count("*").alias("n")).withColumnRenamed("record_key_a", "node")
    nodes = nodes.join(degrees, "node", "left")
    if names is not None:
        for column in ("node", "component"):
            nodes = nodes.withColumnRenamed(column, "id").join(names.hint("merge"), "id").drop("id").withColumnRenamed("record_key", column)
    nodes = materialize(nodes, "components")
    nodes = unsent(nodes, nodes)
    sizes = nodes.groupBy("component").agg(F.count("*").alias("size"))
    small = nodes.join(sizes.where(F.col("size") <= MAX_LISTED).select("component"), "component", "left_semi")
    listed = small.groupBy("component").agg(F.array_sort(F.collect_list("node")).alias("members"))
    sized = sizes.join(listed, "component", "left")
    counted = nodes.groupBy("component").agg(F.sum("n").alias("scored_pairs"))
    out = sized.join(counted, "component").withColumn("possible_pairs", (F.col("size") * (F.col("size") - 1) / 2).cast("long"))
    out = out.withColumn("confidence", F.col("scored_pairs") / F.col("possible_pairs"))
    reasons = F.array_compact(F.array(F.when(F.col("size") > max_size, "size"), F.when(F.col("confidence") < min_density, "density")))
    return out.withColumn("flag_reasons", reasons).withColumn("flagged", F.size("flag_reasons") > 0)


def membership(records: DataFrame, found: DataFrame) -> DataFrame:
    """``(record_key, cluster)``: flagged clusters fall apart, records without an edge stand alone."""
    of = found.select(F.explode("members").alias("record_key"), F.when(~F.col("flagged"), F.col("component")).alias("cluster"))
    return records.select("record_key").join(of, "record_key", "left").select("record_key", F.coalesce("cluster", "record_key").alias("cluster"))


def true_pairs(truth: DataFrame) -> DataFrame:
    """Pairs of records of one person, with the noise between them."""
    a = truth.select(F.col("record_key").alias("record_key_a"), "k", F.col("noise").alias("na"))
    b = truth.select(F.col("record_key").alias("record_key_b"), "k", F.col("noise").alias("nb"))
    noise = F.when((F.col("na") == "exact") & (F.col("nb") == "exact"), "exact").when(F.col("na") == "exact", F.col("nb")).when(F.col("nb") == "exact", F.col("na")).otherwise("multiple")
    return a.join(b, "k").where("record_key_a < record_key_b").select("record_key_a", "record_key_b", noise.alias("noise_type"))
