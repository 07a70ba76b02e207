"""Cap filters: recall at the threshold against brute force, and vectors that crowd around one direction."""

import numpy as np

from kinfold.llm import cap_filters


def _pairs(rng, base, cosine):
    """Each vector and one at the cosine from it."""
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    other = rng.standard_normal(base.shape)
    other -= (other * unit).sum(axis=1, keepdims=True) * unit
    other /= np.linalg.norm(other, axis=1, keepdims=True)
    return np.vstack([unit, cosine * unit + np.sqrt(1 - cosine**2) * other])


def _links(spark, x):
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))], "vec_id long, embedding array<float>")
    return {r.vec_id: r.n_links for r in cap_filters.link_vectors(df).collect()}


def test_recall_at_the_threshold_with_a_common_direction(spark):
    rng = np.random.default_rng(4)
    for spread in (1e9, 0.8):  # none, and average cosine of about 0.6
        base = rng.standard_normal((1500, 64)) + (rng.standard_normal(64) * 1.25 if spread < 1 else 0)
        x = _pairs(rng, base, 0.953).astype(np.float32)
        unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
        linked = unit @ unit.T >= 0.95
        np.fill_diagonal(linked, False)
        got = _links(spark, x)
        found = sum(min(got[i], n) for i, n in enumerate(linked.sum(axis=1).tolist()))
        assert linked.sum() >= 2900 and found >= 0.95 * linked.sum() and all(got[i] <= n for i, n in enumerate(linked.sum(axis=1).tolist()))


def test_filters_hold_a_small_part_of_crowded_vectors():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((4000, 64)) + rng.standard_normal(64) * 1.5
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert (unit @ unit.T).mean() > 0.6
    shift, cosine = cap_filters.centre(unit.sum(axis=0), len(unit), 0.95)
    filters, size = cap_filters.tuned(64, len(unit), cosine)
    turned = unit - shift
    lists = cap_filters.filters_of(turned / np.linalg.norm(turned, axis=1, keepdims=True), size, filters)
    crowd = np.unique(np.concatenate(lists), return_counts=True)[1]
    assert 0.7 < cosine < 0.95 and (crowd * (crowd - 1) / 2).sum() < 0.5 * len(unit) ** 2 / 2
    for n in (10**5, 10**7):
        filters, size = cap_filters.tuned(64, n, 0.95)
        assert cap_filters._met(64, size, filters, 0.95) >= 0.9
