"""Near-duplicate vectors by spherical-cap filters.

Filters are the directions of a structured random product code: after a random rotation
the coordinates are cut into four blocks, each with a small code of random unit vectors,
and every combination of one code word a block is a filter. A vector falls into all
filters whose inner product with it exceeds a bound (and into its best few anyway); these
are list-decoded from the sorted products of the blocks, without looking at all filters.
Vectors at a small angle share filters almost surely; those in one filter are compared by
exact cosines in double precision, in blocks.

Vectors are decoded relative to the mean direction of all of their length, as embeddings
crowd around one: otherwise a few filters would hold most of them. What the threshold means
for the centred vectors, and how many filters a vector must fall into for pairs at the
threshold to meet, is computed beforehand by decoding random pairs at that angle.

Scale: equal vectors are one node with a weight. The number of filters grows with the
number of vectors, so that a filter holds few of them. The index has numbers only; vectors
are fetched once, for filters that hold several. A filter with more than ``TILE``
vectors is dealt out as pairs of tiles. Linked pairs are never written: a tile returns per
vector the number of its links - each pair is counted in the first filter that its two
vectors share - and a root for the components. The components' joins have a root with many
links on one side only, where adaptive execution splits it, and minima are partial.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinfold.llm.tables import table
from kinfold.operators.components import connected_components
from kinfold.session import materialize

THRESHOLD = 0.95
BLOCKS = 4
#: Filters a vector falls into on average: from, and at most. Three quarters of them it falls into anyway.
FILTERS, MOST_FILTERS = 32, 512
#: Share of random pairs at the threshold that must meet in a filter, and how many are tried.
RECALL, TRIED = 0.985, 400
#: Least share of a centred vector's squared length: the mean is subtracted in part only where less would be left.
LEFT = 0.17
#: Vectors a filter holds on average.
CROWD = 8
TILE = 1024
SEED = 20240501


@functools.lru_cache(maxsize=4)
def _code(dim: int, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation and the blocks' code words, the same on every machine."""
    rng = np.random.Generator(np.random.PCG64(SEED + dim))
    rotation, _ = np.linalg.qr(rng.standard_normal((dim, dim)))
    words = []
    for width in [len(x) for x in np.array_split(np.arange(dim), BLOCKS)]:
        w = rng.standard_normal((size, width))
        words.append(w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-300) / np.sqrt(BLOCKS))
    return rotation, words


def code_size(n: int, filters: int = FILTERS) -> int:
    """Code words a block for ``n`` vectors."""
    return int(np.clip(round((n * filters / CROWD) ** (1 / BLOCKS)), 6, 400))


def filters_of(unit: np.ndarray, size: int, filters: int = FILTERS) -> list[np.ndarray]:
    """Sorted numbers of the filters that each row of ``unit`` falls into."""
    dim, most = unit.shape[1], filters * 3 // 4
    rotation, words = _code(dim, size)
    bound = NormalDist().inv_cdf(1 - min(0.5, filters / size**BLOCKS)) / np.sqrt(dim)
    turned = unit @ rotation
    products = [turned[:, at] @ w.T for at, w in zip(np.array_split(np.arange(dim), BLOCKS), words, strict=True)]
    left = (products[0][:, :, None] + products[1][:, None, :]).reshape(len(unit), -1)
    right = (products[2][:, :, None] + products[3][:, None, :]).reshape(len(unit), -1)
    order_l, order_r = np.argsort(-left, axis=1), np.argsort(-right, axis=1)
    out = []
    for i in range(len(unit)):
        l, r = left[i, order_l[i]], right[i, order_r[i]]
        many = np.searchsorted(-r, l - bound, "right")  # right halves that exceed with each left half
        many = many[: max(1, int(np.searchsorted(-many, 0, "left")))]
        total = int(many.sum())
        if total >= most:
            a = np.repeat(np.arange(len(many)), many)
            b = np.arange(total) - np.repeat(np.cumsum(many) - many, many)
        else:
            best = (l[:most, None] + r[None, :most]).ravel()
            top = np.argsort(-best, kind="stable")[:most]
            a, b = top // len(r[:most]), top % len(r[:most])
        out.append(np.sort(order_l[i, a] * np.int64(size * size) + order_r[i, b]))
    return out


def _met(dim: int, size: int, filters: int, cosine: float) -> float:
    """Share of random pairs at a cosine that have a filter in common."""
    rng = np.random.Generator(np.random.PCG64(SEED + 1))
    x = rng.standard_normal((TRIED, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.standard_normal((TRIED, dim))
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y = cosine * x + np.sqrt(1 - cosine**2) * y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    return float(np.mean([len(np.intersect1d(a, b)) > 0 for a, b in zip(filters_of(x, size, filters), filters_of(y, size, filters), strict=True)]))


@functools.lru_cache(maxsize=64)
def tuned(dim: int, n: int, cosine: float) -> tuple[int, int]:
    """Filters a vector and code words a block with which pairs at ``cosine`` meet."""
    filters = FILTERS
    while dim > 1 and filters < MOST_FILTERS and _met(dim, code_size(n, filters), filters, cosine) < RECALL:
        filters = filters * 3 // 2
    return filters, code_size(n, filters)


def centre(sums: np.ndarray, n: int, threshold: float) -> tuple[np.ndarray, float]:
    """What to subtract from unit vectors with these ``sums``, and the cosine that ``threshold`` then is."""
    mean = sums / n
    mass = float(mean @ mean)
    part = 1.0 if 1 - mass >= LEFT else 1 - np.sqrt(max(0.0, 1 - (1 - LEFT) / mass))
    left = 1 - 2 * part * mass + part**2 * mass
    return part * mean, round(max(0.0, 1 - (1 - threshold) / left), 3)


def _units(flat: np.ndarray, start: np.ndarray, mine: np.ndarray, dim: int) -> np.ndarray:
    x = flat[start[mine][:, None] + np.arange(dim)].astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def means(vectors: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """Sum of the unit vectors, and their number, of every length that a hundredth of ``vectors`` has."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        count: dict[int, int] = {}
        for batch in batches:
            dims = np.diff(batch.column(0).offsets.to_numpy())
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            start = np.concatenate([[0], np.cumsum(dims)])
            for dim in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == dim)
                sums[dim] = sums.get(dim, 0) + _units(flat, start, mine, dim).sum(axis=0)
                count[dim] = count.get(dim, 0) + len(mine)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([count[d] for d in sums], pa.int64()), pa.array([sums[d].tolist() for d in sums], pa.list_(pa.float64()))], names=["dim", "n", "sums"])

    parts = materialize(vectors.select("v").mapInArrow(add, "dim int, n long, sums array<double>"), "sums")
    per = parts.groupBy("dim").agg(F.sum("n").alias("n"))
    total = parts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    common = {r["dim"]: r["n"] for r in per.where(F.col("n") * 100 >= total).collect()}  # a hundred at most
    rows = parts.where(F.col("dim").isin(list(common))).select("dim", F.posexplode("sums").alias("at", "s")).groupBy("dim", "at").agg(F.sum("s").alias("s")).orderBy("dim", "at").collect()
    return {dim: (np.array([r["s"] for r in rows if r["dim"] == dim]), n) for dim, n in common.items()}


def _compare(vectors: np.ndarray, of: np.ndarray, lists: list[np.ndarray], side: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links counted in this filter, by weight, and a root, of each vector of a tile.

    ``of``: weights. ``lists``: each vector's filters before this one. ``side``: 0 or 1 for the two blocks of a tile of two; all 2 for a
    block with itself.
    """
    n = len(vectors)
    linked = vectors @ vectors.T >= threshold
    np.fill_diagonal(linked, False)
    if side[0] != 2:
        linked &= side[:, None] != side[None, :]
    if not linked.any():
        return np.zeros(n, np.int64), np.arange(n)
    roots = np.arange(n)
    while True:
        fresh = np.minimum(roots, np.where(linked, roots[None, :], n).min(axis=1))
        fresh = fresh[fresh]
        if (fresh == roots).all():
            break
        roots = fresh
    involved = np.flatnonzero(linked.any(axis=1))
    before = [lists[i] for i in involved]
    names, column = np.unique(np.concatenate(before), return_inverse=True)
    row = np.repeat(np.arange(len(involved)), [len(b) for b in before])
    first = linked[np.ix_(involved, involved)]
    for start in range(0, len(names), 2048):
        mine = (column >= start) & (column < start + 2048)
        incidence = np.zeros((len(involved), min(2048, len(names) - start)), np.float32)
        incidence[row[mine], column[mine] - start] = 1
        first &= incidence @ incidence.T == 0
    links = np.zeros(n, np.int64)
    links[involved] = first @ of[involved]
    return links, roots


def _usable(vector: str) -> F.Column:
    value = F.col(vector)
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return value.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(value, lambda x: x != 0)


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` of every row of ``vectors``.

    Rows link when their cosine is ``threshold`` or more; ``n_links`` counts the other rows
    linked directly (also equal rows), ``component_id`` is the smallest id that links lead
    to, ``kept`` marks that row. Vectors that are null, empty, zero, or hold a null or a
    value that is not finite link with nothing, and neither do vectors of different length.
    Null ids are never the smallest.
    """
    value = F.col(vector_col).cast("array<double>")
    lossless = isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType)
    rows = vectors.select(F.col(id_col).alias("id"), value.alias("v")).withColumn("v", F.when(_usable("v"), F.col("v")))
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    for salt in range(4):
        known = F.when(F.col("v").isNotNull(), F.xxhash64(F.lit(salt), "v"))
        hashed = rows.withColumn("node", known).where("node is not null")
        whole = hashed.groupBy("node").agg(F.any_value("v").alias("v"), F.count("*").alias("n"), F.min("id").alias("id"), F.min(F.xxhash64(F.lit(-1 - salt), "v")).alias("o1"), F.max(F.xxhash64(F.lit(-1 - salt), "v")).alias("o2"))
        whole = materialize(whole, "vectors")
        if whole.where("o1 != o2").isEmpty():
            break  # else two different vectors share a hash: another salt
    else:
        raise RuntimeError("hashes of different vectors keep colliding")
    narrow = rows.select("id", known.alias("node"))
    codes = {dim: (*centre(sums, n, threshold), n) for dim, (sums, n) in means(whole).items()}
    total = max(1, whole.count())
    sizes = {dim: tuned(dim, n, cosine) for dim, (_, cosine, n) in codes.items()}
    plain = (FILTERS, code_size(total))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                dims = np.diff(part.column(1).offsets.to_numpy())
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False)
                start = np.concatenate([[0], np.cumsum(dims)])
                for dim in np.unique(dims).tolist():
                    mine = np.flatnonzero(dims == dim)
                    unit = _units(flat, start, mine, dim)
                    filters, size = sizes.get(dim, plain)
                    turned = unit - codes[dim][0] if dim in codes else unit
                    norm = np.linalg.norm(turned, axis=1, keepdims=True)
                    turned = np.where(norm > 1e-9, turned / np.maximum(norm, 1e-300), unit)
                    lists = [(f + np.int64(dim) * (1 << 40)).tolist() for f in filters_of(turned, size, filters)]
                    kind = np.float32 if lossless else np.float64
                    data = [flat[a : a + dim].astype(kind).tobytes() for a in start[mine]]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(mine)), part.column(2).take(pa.array(mine)), pa.array(data, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], names=["node", "n", "vector", "lists"])

    coded = materialize(whole.select("node", "v", "n").mapInArrow(decode, "node long, n long, vector binary, lists array<long>"), "coded")
    index = coded.select("node", F.posexplode("lists").alias("at", "filter"))
    crowd = index.groupBy("filter").agg(F.count("*").alias("crowd")).where("crowd > 1")
    index = index.join(crowd, "filter").withColumn("parts", F.ceil(F.col("crowd") / TILE).cast("int"))
    mine = F.pmod(F.col("node"), F.col("parts")).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: F.struct(F.least(j, mine).alias("i"), F.greatest(j, mine).alias("j")))
    dealt = index.withColumn("mine", mine).withColumn("tile", F.explode(tiles)).select("filter", "tile.i", "tile.j", "mine", "node", "at")
    # Of a vector's filters only those before this one are needed here.
    dealt = dealt.join(coded.hint("merge"), "node").select("filter", "i", "j", "mine", "node", "n", "vector", F.slice("lists", F.lit(1), F.col("at")).alias("before"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch | None:
            if len(held) < 2:
                return None
            node = np.array([h[0] for h in held], np.int64)
            flat = np.frombuffer(b"".join(h[2] for h in held), np.float32 if lossless else np.float64)
            dim = len(flat) // len(held)
            unit = _units(flat, np.arange(len(held)) * dim, np.arange(len(held)), dim)
            side = np.array([h[4] for h in held]) != key[1]
            side = side.astype(int) if key[1] != key[2] else np.full(len(held), 2)
            links, roots = _compare(unit, np.array([h[1] for h in held], np.int64), [np.asarray(h[3], np.int64) for h in held], side, threshold)
            told = np.flatnonzero((links > 0) | (roots != np.arange(len(held))))
            if not len(told):
                return None
            return pa.RecordBatch.from_arrays([pa.array(node[told]), pa.array(links[told]), pa.array(node[roots[told]])], names=["node", "links", "root"])

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for f, i, j, at, node, n, vector, before in zip(*columns, strict=True):
                if (f, i, j) != key:
                    if (out := done()) is not None:
                        yield out
                    key, held = (f, i, j), []
                held.append((node, n, vector, before, at))
        if (out := done()) is not None:
            yield out

    spread = dealt.repartition("filter", "i", "j").sortWithinPartitions("filter", "i", "j")
    told = materialize(spread.mapInArrow(compare, "node long, links long, root long"), "links")
    links = told.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(told.select("node", "root").distinct(), "node", "root")
    placed = whole.select("node", "n", "id").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    known = placed.join(smallest, "component").join(links, "node", "left").select("node", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = narrow.join(materialize(known, "known"), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def op4_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


OP4_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y ON x.vec_id != y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id, e.vec_id = least(e.vec_id, coalesce(m, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = e.vec_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = e.vec_id
"""
