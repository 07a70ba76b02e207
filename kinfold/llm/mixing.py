"""Mixing sources to target weights by Pareto order sampling.

Each source has a target of words. A document's expected copies are its weight times a
factor of its source, at most ``max_copies``; the factor is the one with which the expected
words meet the target. The whole part is allocated for certain, and the fraction p is the
inclusion probability of one more copy, which differs between documents by their weight.
Documents are ranked within their source by the Pareto order

    (u / (1 - u)) / (p / (1 - p)),   u a hash of the document in (0, 1),

and the sample is the first documents of that order whose words come nearest to what the
target still asks for. The sample's size is thus fixed by the target, not by chance.
A weight is a level from 1 to ``LEVELS``: a column of its own (of quality, say), or else
the number of binary digits of the document's words, so that longer documents are likelier.

Scale: a table of sources by level (at most ``LEVELS`` rows a source) is the only summary.
Ranks and running sums come from range-partitioned sorts with a small table of sums a
partition (``running_sum``), so a source that holds a third of all rows is spread over all
tasks. Nothing is gathered in the driver but one row with the level of the water filling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.tables import table
from kinfold.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
#: Most levels of weight.
LEVELS = 64


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than blank and U+0009 to U+000D; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*cols: Column) -> Column:
    """A number in (0, 1) from the MD5 of the columns: the same in every run and engine."""
    digits = F.substring(F.md5(F.concat_ws("|", *cols)), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES) -> DataFrame:
    """Add ``weight`` and ``target`` to ``(_source, source_size)``, one row a source.

    Weights repeat over the sources in order of code point, null last. Targets share
    ``share`` of all words by weight; a target stops at ``max_copies`` times its source's
    words, and the excess is shared anew by weight until no target is above: the sources
    with the least words for their weight stop first, so one running sum in that order
    tells at which level the others stay.
    """
    ordered = sources.withColumns({"_null": F.col("_source").isNull().cast("int"), "_one": F.lit(1).cast("long"), "source_size": F.coalesce("source_size", F.lit(0))})
    rank = running_sum(ordered, [], ["_null", "_source"], ["_one"])
    pick = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("_running__one") - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * F.lit(max_copies)
    weighted = rank.withColumn("weight", pick.cast("long")).withColumns({"_cap": cap, "_ratio": F.col("source_size").cast("double") / F.col("weight")})
    weighted = materialize(weighted.select("_source", "_null", "source_size", "weight", "_cap", "_ratio"), "sources")
    total = weighted.agg(F.sum("source_size").alias("_s"), F.sum("weight").alias("_w"))  # one row
    filled = running_sum(weighted, [], ["_ratio", "_null", "_source"], ["_cap", "weight"]).crossJoin(F.broadcast(total))
    level = (F.lit(share) * F.col("_s").cast("double") - (F.col("_running__cap") - F.col("_cap")).cast("double")) / (F.col("_w") - F.col("_running_weight") + F.col("weight")).cast("double")
    above = filled.withColumn("_level", level).where(F.col("_cap") > F.col("weight") * F.col("_level"))
    found = above.agg(F.min(F.struct("_ratio", "_null", "_source", "_level")).alias("at")).first()["at"]
    if found is None:  # every source stops
        return weighted.withColumn("target", F.col("_cap").cast("double")).drop("_null", "_cap", "_ratio")
    even = F.col("weight") * F.lit(found["_level"])
    return weighted.withColumn("target", F.when(F.col("_cap") <= even, F.col("_cap").cast("double")).otherwise(even)).drop("_null", "_cap", "_ratio")


def running_sum(df: DataFrame, groups: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Add ``_running_<value>`` for each of ``values``: the sum up to and with each row, in order, by group.

    Two levels: a range-partitioned sort, and sums of whole partitions (one row a partition
    and group) added in front. Rows equal in all ``groups + order`` columns and in value get
    running sums in any order among them.
    """
    ranged = df.repartitionByRange(*[F.col(c) for c in groups + order]).withColumn("_part", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    sums = ranged.groupBy(*groups, "_part").agg(*[F.sum(v).alias(f"_sum_{v}") for v in values])
    before = Window.partitionBy(*groups).orderBy("_part")
    ahead = sums.select(*[F.col(c).alias(f"_g_{c}") for c in groups], F.col("_part").alias("_g__part"), *[(F.sum(f"_sum_{v}").over(before) - F.col(f"_sum_{v}")).alias(f"_ahead_{v}") for v in values])
    within = Window.partitionBy("_part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = F.col("_part") == F.col("_g__part")
    for c in groups:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    joined = ranged.withColumns({f"_within_{v}": F.sum(v).over(within) for v in values}).join(ahead, same)
    return joined.select(*df.columns, *[(F.col(f"_ahead_{v}") + F.col(f"_within_{v}")).alias(f"_running_{v}") for v in values])


def _expected(levels: DataFrame, max_copies: int) -> DataFrame:
    """Copies by source and level: ``(_of, _level, target, source_size, _sure, _p, _wanted)``.

    ``levels``: ``(_source, _level, words, source_size, target)``, at most ``LEVELS`` rows a
    source. Levels from above reach ``max_copies`` first; the factor follows from those that
    do not. ``_wanted``: words that the sample has to add to the certain copies.
    """
    down = Window.partitionBy("_source").orderBy(F.desc("_level")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_source")
    mass = F.col("_level") * F.col("words")
    full = F.coalesce(F.sum("words").over(down), F.lit(0))
    rest = F.sum(mass).over(whole) - F.coalesce(F.sum(mass).over(down), F.lit(0))
    # Written in one way here and in the SQL, so that both round alike.
    factor = F.when(rest > 0, (F.col("target") - (F.lit(max_copies) * full).cast("double")) / rest.cast("double"))
    open_ = F.col("_factor") * F.col("_level") < max_copies
    found = F.max(F.when(open_, F.struct("_level", "_factor"))).over(whole)["_factor"]
    expected = F.when(F.col("_found").isNull() | (F.col("_found") * F.col("_level") >= max_copies), F.lit(float(max_copies))).otherwise(F.col("_found") * F.col("_level"))
    expected = F.when(F.col("source_size") > 0, expected).otherwise(0.0)
    out = levels.withColumn("_factor", factor).withColumn("_found", found).withColumn("_e", expected)
    out = out.withColumn("_sure", F.floor("_e").cast("long")).withColumn("_p", F.col("_e") - F.col("_sure"))
    wanted = F.col("target") - F.sum(F.col("_sure") * F.col("words")).over(whole)
    return out.select(F.col("_source").alias("_of"), "_level", "target", "source_size", "_sure", "_p", wanted.alias("_wanted"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, max_copies: int = MAX_COPIES, seed: str = "mix", level_col: str | None = None, carry: str | None = None) -> DataFrame:
    """``(id_col, size, source_size, target, copies, taken)`` for every row of ``docs``, and the column ``carry`` as it is.

    ``copies`` is how often the mix holds the document (0 to ``max_copies``), ``taken`` its
    words times copies. ``level_col`` holds weights from 1 to ``LEVELS`` (others are moved to
    the nearest of these, null counts as 1); without it a weight is the number of binary
    digits of the size. Null and empty texts have size 0 and weight 1, are allocated whole
    copies only and take nothing. A null source is a source of its own. Rows with equal id
    and text get the same random number; a hash of the text breaks ties, so reruns agree.
    An empty table gives an empty table.
    """
    size = word_count(F.col(text_col))
    level = F.col(level_col).cast("long") if level_col else F.length(F.bin("size")).cast("long")
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("_source"), size.alias("size"), F.md5(F.col(text_col)).alias("_digest"), *([F.col(level_col)] if level_col else []), *([F.col(carry)] if carry else []))
    sized = sized.withColumn("_level", F.greatest(F.lit(1).cast("long"), F.least(F.lit(LEVELS).cast("long"), F.coalesce(level, F.lit(1).cast("long")))))
    sized = materialize(sized.select("id", "_source", "size", "_digest", "_level", *([carry] if carry else [])), "sizes")
    levels = materialize(sized.groupBy("_source", "_level").agg(F.sum("size").alias("words")), "levels")
    targets = source_targets(levels.groupBy("_source").agg(F.sum("words").alias("source_size")), weights, share, max_copies)
    targets = targets.select(F.col("_source").alias("_of"), "source_size", "target")
    placed = levels.join(targets, F.col("_source").eqNullSafe(F.col("_of"))).drop("_of")
    copies = materialize(_expected(placed, max_copies), "copies").withColumnRenamed("_level", "_at")
    joined = sized.join(copies, F.col("_source").eqNullSafe(F.col("_of")) & (F.col("_level") == F.col("_at"))).drop("_of", "_at")
    u = unit_hash(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit("")))
    order = (u / (1 - u)) / (F.col("_p") / (1 - F.col("_p")))
    drawn = joined.where((F.col("_p") > 0) & (F.col("size") > 0)).withColumn("_order", order)
    ranked = running_sum(drawn, ["_source"], ["_order", "id", "_digest"], ["size"])
    # The document across the border comes in where that leaves the sample nearer its goal.
    ran, wanted = F.col("_running_size"), F.col("_wanted")
    chosen = (ran - wanted <= 0) | ((ran - F.col("size") < wanted) & (ran - wanted <= wanted - (ran - F.col("size"))))
    sampled = ranked.withColumn("copies", F.col("_sure") + chosen.cast("long"))
    sure = joined.where(~((F.col("_p") > 0) & (F.col("size") > 0))).withColumn("copies", F.col("_sure"))
    out = [F.col("id").alias(id_col), "size", "source_size", "target", F.col("copies").cast("int"), (F.col("size") * F.col("copies")).alias("taken"), *([carry] if carry else [])]
    return sampled.select(*out).unionByName(sure.select(*out))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(text) AS digest,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
sources AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source)),
filled AS (
  SELECT *, 1.5::DOUBLE * (sum(s) OVER ())::DOUBLE AS goal,
    (coalesce(sum(2 * s) OVER (ORDER BY s::DOUBLE / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS stopped,
    (sum(w) OVER (ORDER BY s::DOUBLE / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS free,
    row_number() OVER (ORDER BY s::DOUBLE / w, source) AS n
  FROM sources),
level AS (SELECT min_by((goal - stopped) / free, n) FILTER (WHERE 2 * s > w * ((goal - stopped) / free)) AS v FROM filled),
targets AS (
  SELECT source, s, CASE WHEN v IS NULL OR 2 * s <= w * v THEN (2 * s)::DOUBLE ELSE w * v END AS target FROM sources, level),
levels AS (
  SELECT sized.source, length(bin(size))::BIGINT AS level, any_value(s) AS s, any_value(target) AS target, sum(size)::BIGINT AS words
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source GROUP BY ALL),
factors AS (
  SELECT *, CASE WHEN rest > 0 THEN (target - (2 * above)::DOUBLE) / rest::DOUBLE END AS factor FROM (
    SELECT *, coalesce(sum(words) OVER d, 0)::BIGINT AS above, (sum(level * words) OVER (PARTITION BY source) - coalesce(sum(level * words) OVER d, 0))::BIGINT AS rest
    FROM levels WINDOW d AS (PARTITION BY source ORDER BY level DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))),
found AS (
  SELECT *, max_by(factor, level) FILTER (WHERE factor * level < 2) OVER (PARTITION BY source) AS f FROM factors),
expected AS (
  SELECT *, CASE WHEN s <= 0 THEN 0::DOUBLE WHEN f IS NULL OR f * level >= 2 THEN 2::DOUBLE ELSE f * level END AS e FROM found),
split AS (
  SELECT *, target - (sum(sure * words) OVER (PARTITION BY source))::DOUBLE AS wanted FROM (SELECT *, floor(e)::BIGINT AS sure, e - floor(e) AS p FROM expected)),
joined AS (
  SELECT sized.*, s, target, sure, p, wanted,
    (('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM sized JOIN split ON sized.source IS NOT DISTINCT FROM split.source AND split.level = length(bin(size))),
ranked AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY (u / (1 - u)) / (p / (1 - p)), doc_id, digest ROWS UNBOUNDED PRECEDING))::BIGINT AS running
  FROM joined WHERE p > 0 AND size > 0),
copied AS (
  SELECT *, sure + CASE WHEN running - wanted <= 0 OR (running - size < wanted AND running - wanted <= wanted - (running - size)) THEN 1 ELSE 0 END AS copies FROM ranked
  UNION ALL BY NAME
  SELECT *, sure AS copies FROM joined WHERE NOT (p > 0 AND size > 0))
SELECT doc_id, size, s AS source_size, target, copies::INTEGER AS copies, (size * copies)::BIGINT AS taken FROM copied
"""
