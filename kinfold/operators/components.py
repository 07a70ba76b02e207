"""Connected components by alternating large and small stars.

Large star: every node ties its larger neighbours to its smallest neighbour. Small star:
every node ties its smaller neighbours and itself to its smallest neighbour. Both keep
the components, and repeated in turn they end in one star a component, in a number of
rounds that grows with the logarithm of a component's size (Kiveris et al., 2014).

Minima are partial aggregates, so a node with very many edges sends one row a task; the
join back is a sort-merge join that adaptive execution can split. Each round is written
to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.session import materialize, unsent

MAX_ROUNDS = 60


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    mixed = F.xxhash64("hi", "lo").cast("decimal(20,0)")
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.sum(mixed), F.lit(0)).alias("h")).first()
    return int(row["n"]), int(row["h"])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = at[: len(a)], at[len(a) :]
        least = np.arange(len(nodes))
        while True:
            new = least.copy()
            np.minimum.at(new, x, least[y])
            np.minimum.at(new, y, least[x])
            new = new[new]
            if (new == least).all():
                break
            least = new
        tied = least != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[least[tied]]), pa.array(nodes[tied])], names=batch.schema.names)


def thinned(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Edges between numbers with the same components: in each batch of rows, a star for each component of that batch."""
    return edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(a, b).mapInArrow(_forest, f"{a} long, {b} long")


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = MAX_ROUNDS, growing: bool = False) -> DataFrame:
    """``(node, component)`` for every node with an edge; ``component`` is its smallest node.

    Nulls, loops and repeated edges in ``(a, b)`` are allowed and ignored. Raises if the
    rounds do not suffice. ``growing``: there may be as many edges as records, which joins
    are not to take for few by their files' bytes.
    """
    both = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    stars = materialize(both.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    before = _fingerprint(stars)
    for _ in range(max_rounds):
        sym = stars.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(stars.select("lo", "hi"))
        if growing:
            sym = unsent(sym, stars)
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = sym.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        tied = large.join(least, "hi")
        small = tied.select(F.explode(F.array(F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")), F.struct(F.col("hi"), F.col("m").alias("lo")))).alias("e"))
        stars = materialize(small.select("e.hi", "e.lo").where(F.col("hi") != F.col("lo")).distinct(), "stars")
        now = _fingerprint(stars)
        if now == before:
            roots = stars.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
            return stars.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
        before = now
    raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
