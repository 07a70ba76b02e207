"""Pairs of records that share a block, streamed with their levels of agreement and never stored.

A pair comes once, in the first pass whose block holds both records, so nothing has to be
made distinct: records move once a pass, pairs not at all. The levels of a pair are one
number, which a table of all combinations (``grid``) turns into levels and scores. Names are
compared once for each two that share a block; a record carries those close to its own.
Record keys must be unique; copies of a record (equal in all columns) give a pair each.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.functions.compare import NEAR, SIMILAR, canonical, jaro_winkler_column
from kinfold.operators import matching
from kinfold.operators.matching import FIELDS, MAX_BLOCK, NAIVE_FIELD, NAIVE_LEVEL, PASSES, WEIGHTS
from kinfold.session import materialize, unsent

NAMES = ("first_name", "last_name")
LEVELS = {f: tuple(WEIGHTS[f]) for f in FIELDS}
#: Combinations of records that one task goes through.
A_TASK = 4_000_000


def grid(spark: SparkSession, weights: dict[str, dict[str, float]] = WEIGHTS) -> DataFrame:
    """``(code, five levels, score, naive_score)`` of all 1944 combinations of levels."""
    out = []
    for code, levels in enumerate(product(*LEVELS.values())):
        score = naive = 0.0
        for f, level in zip(FIELDS, levels, strict=True):
            score += weights[f].get(level, 0.0)
            naive += NAIVE_FIELD[f] * NAIVE_LEVEL.get(level, 0.0)
        out.append((code, *levels, score, naive))
    return spark.createDataFrame(out, f"code int, {', '.join(f'{f} string' for f in FIELDS)}, score double, naive_score double")


def numbered(records: DataFrame) -> DataFrame:
    """Add ``id``, the place of the record's key in the order of all keys, and ``copy``, from 1 for each key."""
    spread = materialize(records.where("record_key is not null").repartitionByRange("record_key").withColumn("part", F.spark_partition_id()), "spread")
    ahead = spread.groupBy("part").agg(F.countDistinct("record_key").alias("c")).withColumn("ahead", F.sum("c").over(Window.orderBy("part")) - F.col("c")).drop("c")  # one row a partition
    within = F.dense_rank().over(Window.partitionBy("part").orderBy("record_key"))
    copy = F.row_number().over(Window.partitionBy("part", "record_key").orderBy("record_key"))
    return spread.withColumns({"w": within, "copy": copy}).join(ahead, "part").withColumn("id", (F.col("ahead") + F.col("w")).cast("long")).drop("part", "w", "ahead")


def oversized(records: DataFrame, passes: dict[str, list[str]] = PASSES, max_block: int = MAX_BLOCK) -> DataFrame:
    return materialize(matching.block_stats(matching.block_keys(records, passes), max_block).where("is_oversized").select("blocking_pass", "block_key"), "oversized")


def _keys(passes: dict[str, list[str]]) -> list[Column]:
    """The record's block in each pass, null where it takes no part."""
    whole = lambda columns: reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns])
    return [F.when(whole(columns), F.concat_ws("|", *[F.col(c).cast("string") for c in columns])).alias(name) for name, columns in passes.items()]


def uncapped(records: DataFrame, truth: DataFrame, passes: dict[str, list[str]] = PASSES) -> tuple[DataFrame, DataFrame]:
    """Numbers of pairs that blocks of any size give, made from counts and not from pairs: ``(blocking_pass, pairs)``, and of ``truth`` ``(blocking_pass, found)``.

    A pair counts in each pass that it shares, and once in ``unioned``: those that share a block
    are those that share it in one pass, less those in two, plus those in three, and so on, and
    pairs that share some passes are pairs of records equal in all of their blocks.
    """
    keyed = records.where("record_key is not null").select("record_key", *_keys(passes))
    keyed = materialize(keyed.groupBy("record_key", *passes).agg(F.count("*").alias("c")), "keyed")
    keyed = unsent(keyed, keyed)
    sets = [some for n in range(1, len(passes) + 1) for some in combinations(passes, n)]
    block = lambda some: F.array(*[F.col(p) for p in some])
    one = [F.when(~F.exists(block(some), lambda x: x.isNull()), F.struct(F.lit(i).alias("set"), block(some).alias("block"))) for i, some in enumerate(sets)]
    each = keyed.select("c", F.explode(F.array_compact(F.array(*one))).alias("x")).groupBy("x").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("same"), F.count("*").alias("d"))
    of = each.groupBy("x.set").agg(F.sum(F.expr("(n * n - same) div 2")).alias("pairs"), F.sum(F.expr("d * (d - 1) div 2")).alias("once"))
    named = lambda c, xs: F.element_at(F.array(*[F.lit(x) for x in xs]), F.col(c) + 1)
    of = materialize(of, "uncapped")  # a row for each set of passes
    whole = of.agg(F.sum(F.col("once") * named("set", [1 if len(some) % 2 else -1 for some in sets])).alias("pairs")).select(F.lit("unioned").alias("blocking_pass"), "pairs")
    pairs = of.where(F.col("set") < len(passes)).select(named("set", [some[0] for some in sets]).alias("blocking_pass"), "pairs").unionByName(whole).where("pairs > 0")
    side = lambda x: keyed.select(F.col("record_key").alias(f"record_key_{x}"), *[F.col(p).alias(f"{x}_{p}") for p in passes])
    both = truth.join(side("a"), "record_key_a").join(side("b"), "record_key_b")
    shared = F.array_compact(F.array(*[F.when(F.col(f"a_{p}") == F.col(f"b_{p}"), F.lit(p)) for p in passes]))
    listed = both.select(shared.alias("shared")).where("size(shared) > 0").select(F.explode(F.concat(F.array(F.lit("unioned")), "shared")).alias("blocking_pass"))
    return pairs, listed.groupBy("blocking_pass").agg(F.count("*").alias("found"))


def rows(records: DataFrame, passes: dict[str, list[str]] = PASSES, large: DataFrame | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """What pairs are made of: ids, fields with null for what is missing, and a column for each pass.

    A pass's column holds the record's block, null where the record or the block (one of
    ``large``) takes no part.
    """
    said = lambda c: F.nullif(F.col(c), F.lit(""))
    out = records.select(
        "record_key", "id", "copy", *extra, *[said(c).alias(c) for c in (*NAMES, "ssn")], *[canonical(F.col(c)).alias(f"{c}_alias") for c in NAMES], "dob", F.year("dob").alias("y"), F.month("dob").alias("m"), F.dayofmonth("dob").alias("d"),
        F.when(~F.col("gender").isin("", "U"), F.col("gender")).alias("gender"), *_keys(passes),
    )
    for name in passes if large is not None else ():
        gone = large.where(F.col("blocking_pass") == name).select(F.col("block_key").alias(name), F.lit(True).alias("gone"))
        out = out.join(gone, name, "left").withColumn(name, F.when(F.col("gone").isNull(), F.col(name))).drop("gone")
    return out


def _tall(side: DataFrame, passes: dict[str, list[str]], *columns: str) -> DataFrame:
    """One row for each pass that a record takes part in."""
    one = [F.struct(F.lit(i).alias("pass"), F.col(p).alias("block")) for i, p in enumerate(passes)]
    return side.select(*columns, F.explode(F.array(*one)).alias("x")).where("x.block is not null").select(*columns, "x.pass", "x.block")


def _with_close_names(left: DataFrame, right: DataFrame, passes: dict[str, list[str]]) -> DataFrame:
    """Add to ``left`` the names that are near and similar to its own among those that share a block with it.

    Both are stored tables.
    """
    stored = left, right
    for field in NAMES:
        mine, theirs = (unsent(_tall(side, passes, field).where(F.col(field).isNotNull()).withColumnRenamed(field, x).distinct(), *stored) for side, x in ((left, "x"), (right, "y")))
        two = mine.join(theirs, ["pass", "block"]).where("x != y").select("x", "y").distinct()
        like = materialize(two.withColumn("s", jaro_winkler_column(F.col("x"), F.col("y"))).where(F.col("s") >= SIMILAR), "names")
        of = like.groupBy(F.col("x").alias(field)).agg(F.collect_set(F.when(F.col("s") >= NEAR, F.col("y"))).alias(f"near_{field}"), F.collect_set(F.when(F.col("s") < NEAR, F.col("y"))).alias(f"similar_{field}"))
        left = left.join(materialize(of, "close"), field, "left")
    return left


def _code() -> Column:
    """The number of a pair's levels in ``grid``."""
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    same = lambda c: a(c) == b(c)
    tests = {f: [("missing", a(f).isNull() | b(f).isNull()), ("exact", same(f))] for f in FIELDS}
    for f in NAMES:
        tests[f] += [("nickname", same(f"{f}_alias")), ("near", F.array_contains(a(f"near_{f}"), b(f))), ("similar", F.array_contains(a(f"similar_{f}"), b(f)))]
    crossed = same("y") & (a("m") == b("d")) & (a("d") == b("m"))
    off = same("y").cast("int") + same("m").cast("int") + same("d").cast("int") == 2
    tests["dob"] += [("transposed", crossed), ("one_component_off", off), ("year_only", same("y"))]
    out = F.lit(0)
    for f, levels in LEVELS.items():
        level = F.lit(levels.index("different"))
        for name, holds in reversed(tests[f]):
            level = F.when(holds, levels.index(name)).otherwise(level)
        out = out * len(levels) + level
    return out


class Blocks:
    """Pairs within ``left``, smaller key first, or of ``left`` with ``right``."""

    def __init__(self, left: DataFrame, right: DataFrame | None = None, passes: dict[str, list[str]] = PASSES):
        self.within, self.passes = right is None, passes
        left = materialize(left, "left")
        right = left if right is None else materialize(right, "right")
        self.left = materialize(_with_close_names(left, right, passes), "left")
        # As many rows as records; the names added are few and may be sent.
        self.left, self.right = unsent(self.left, self.left), unsent(right, right)
        count = lambda side, n: _tall(side, passes).groupBy("pass", "block").agg(F.count("*").alias(n))
        sizes = count(self.left, "n").join(count(self.right, "m"), ["pass", "block"])
        work = {r["pass"]: r["work"] for r in sizes.groupBy("pass").agg(F.sum(F.col("n").cast("double") * F.col("m")).alias("work")).collect()}  # one row a pass
        # Without a bound on blocks some are too large for a task.
        hot = sizes.where(F.col("m") > MAX_BLOCK).select("pass", "block", F.ceil(F.col("m") / MAX_BLOCK).cast("int").alias("parts"))
        self.hot = None if self.within else materialize(hot, "hot")
        self.tasks = {p: min(4000, int(work.get(i, 0) // A_TASK) + 1) for i, p in enumerate(passes)}

    def _sides(self) -> tuple[list[Column], list[Column]]:
        return [F.col(c).alias(f"a_{c}") for c in self.left.columns], [F.col(c).alias(f"b_{c}") for c in self.right.columns]

    def _shares(self, name: str) -> Column:
        return F.coalesce(F.col(f"a_{name}") == F.col(f"b_{name}"), F.lit(False))

    def _dealt(self, name: str, left: DataFrame, right: DataFrame) -> list[DataFrame]:
        """Both sides by a pass's block; one with many records on the right in parts, each of which meets all of the left."""
        left, right = left.where(F.col(name).isNotNull()), right.where(F.col(name).isNotNull())
        if self.hot is None:
            return [side.withColumn("part", F.lit(0)).repartition(self.tasks[name], name) for side in (left, right)]
        parts = self.hot.where(F.col("pass") == list(self.passes).index(name)).select(F.col("block").alias(name), "parts")
        n = F.coalesce("parts", F.lit(1))
        left = left.join(parts, name, "left").withColumn("part", F.explode(F.sequence(F.lit(0), n - 1))).drop("parts")
        right = right.join(parts, name, "left").withColumn("part", F.pmod(F.xxhash64("record_key"), n).cast("int")).drop("parts")
        return [side.repartition(self.tasks[name], name, "part") for side in (left, right)]

    def pairs(self, left: DataFrame | None = None, right: DataFrame | None = None, only: str | None = None) -> DataFrame:
        """``a_*``, ``b_*`` and ``code`` of every pair that shares a block, once; of some of the sides' rows if given.

        With ``only``, those that come in that pass: those of all passes are all pairs.
        """
        (a, b), out, before = self._sides(), None, []
        for name in self.passes:
            if only not in (None, name):
                before.append(name)
                continue
            dealt = self._dealt(name, self.left if left is None else left, self.right if right is None else right)
            on = (F.col(f"a_{name}") == F.col(f"b_{name}")) & (F.col("a_part") == F.col("b_part"))
            if self.within:
                on &= F.col("a_id") < F.col("b_id")
            for earlier in before:
                on &= ~self._shares(earlier)
            found = dealt[0].select(*a, F.col("part").alias("a_part")).join(dealt[1].select(*b, F.col("part").alias("b_part")).hint("merge"), on)
            out = found if out is None else out.unionByName(found)
            before.append(name)
        return out.select("*", F.col("a_record_key").alias("record_key_a"), F.col("b_record_key").alias("record_key_b"), _code().alias("code"))

    def among(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` that share a block, with ``code`` and a column for each pass that says whether they share its block."""
        a, b = self._sides()
        both = pairs.join(self.left.select(*a, F.col("a_record_key").alias("record_key_a")), "record_key_a").join(self.right.select(*b, F.col("b_record_key").alias("record_key_b")), "record_key_b")
        both = both.select(*pairs.columns, "a_copy", "b_copy", _code().alias("code"), *[self._shares(p).alias(p) for p in self.passes])
        return both.where(" or ".join(self.passes))

    def scored(self, table: DataFrame | None = None, only: str | None = None) -> DataFrame:
        """``(record_key_a, record_key_b, five levels, score, naive_score)`` of every pair, or of those of one pass, streamed; with ``table``, some of ``grid``, what that has."""
        pairs = self.pairs(only=only).select("record_key_a", "record_key_b", "code")
        return pairs.join(F.broadcast(grid(pairs.sparkSession) if table is None else table), "code").drop("code")  # 1944 rows at most

    def best(self, **kinds: Column) -> DataFrame:
        """``record_key_a`` and for each of ``kinds``, conditions on the score, a struct of the best pair: ``(record_key_b, score, auto)``.

        Scores count at four decimals, of equal ones the smallest key. Score, key's number and
        whether the pair matches automatically are one number, so that minima need no sort.
        """
        table = grid(self.left.sparkSession)
        rank = ((100 - F.round("score", 4).cast("decimal(10,4)")) * 10000).cast("long") * F.lit(1 << 41) + F.when(F.col("score") >= matching.UPPER, 0).otherwise(1)
        table = table.where(reduce(lambda x, y: x | y, kinds.values())).select("code", rank.alias("rank"), *[cond.alias(kind) for kind, cond in kinds.items()])
        ranked = self.pairs().select("a_id", "b_id", "code").join(F.broadcast(table), "code")  # 1944 rows at most
        found = ranked.groupBy("a_id").agg(*[F.min(F.when(F.col(kind), F.col("rank") + F.col("b_id") * 2)).alias(kind) for kind in kinds])
        found = found.join(self.left.where("copy = 1").select(F.col("id").alias("a_id"), F.col("record_key").alias("record_key_a")), "a_id")
        for kind in kinds:
            packed = F.col(kind)
            found = found.withColumn("b_id", F.shiftright(packed, 1).bitwiseAND(F.lit((1 << 40) - 1))).join(self.right.where("copy = 1").select(F.col("id").alias("b_id"), "record_key"), "b_id", "left")
            score = (1_000_000 - F.shiftright(packed, 41)).cast("double") / 10000
            found = found.withColumn(kind, F.when(packed.isNotNull(), F.struct(F.col("record_key").alias("record_key_b"), score.alias("score"), (packed.bitwiseAND(F.lit(1)) == 0).alias("auto")))).drop("b_id", "record_key")
        return found.drop("a_id")

    def levels(self) -> DataFrame:
        """``grid`` of the combinations that occur, with their ``pairs`` (copies counted) and ``distinct_pairs``."""
        once = F.count_if((F.col("a_copy") == 1) & (F.col("b_copy") == 1)).alias("distinct_pairs")
        counted = self.pairs().groupBy("code").agg(F.count("*").alias("pairs"), once)
        return counted.join(F.broadcast(grid(counted.sparkSession)), "code")  # 1944 rows
