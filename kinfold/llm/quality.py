"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Texts become counts of hashed terms: trigrams of character classes (which show shouting,
markup, tables and debris), words, and a few bins of whole-text ratios. A truncated
singular value decomposition of the weighted counts of a bounded labelled sample gives the
latent space. The sample's vectors are broadcast; every document's cosines with all of
them are exact products of blocks, and its nearest neighbours vote, weighted by cosine.

Scale: the model's size is bounded by ``TRAIN_ROWS``, ``TERMS`` and ``RANK``, whatever
the corpus. Scoring is one map without a shuffle, in slices of bounded length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.tables import table
from kinfold.session import materialize

#: Most labelled rows of each label that the model holds.
TRAIN_ROWS = 1500
#: Hashed terms: half for character classes, half for words; then ratio bins.
TERMS = 2048
RATIOS, BINS = 5, 10
WIDTH = 2 * TERMS + RATIOS * BINS
RANK = 48
NEIGHBOURS = 25
SHARPNESS = 4
SLICE = 1 << 20


def _slices(texts: list[str]) -> Iterator[slice]:
    start, total = 0, 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > SLICE or i - start >= 512:
            yield slice(start, i)
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


def _classes(points: np.ndarray) -> np.ndarray:
    """Character classes: letters by case, digits, blanks, line feeds; other characters one by one."""
    out = (points % 61 + 8).astype(np.uint32)
    out[points >= 0xC0] = 1
    out[(points >= 97) & (points <= 122)] = 1
    out[((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE))] = 2
    out[(points >= 48) & (points <= 57)] = 3
    out[(points <= 32) | (points == 0xA0)] = 4
    out[points == 10] = 5
    return out


def counts(texts: list[str]) -> np.ndarray:
    """Term counts of each text, one row a text."""
    n = len(texts)
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.array([len(t) + 1 for t in texts])
    text = np.repeat(np.arange(n), lengths)
    kind = _classes(points)
    one = np.concatenate([[5], kind[:-1]]).astype(np.uint32)
    two = np.concatenate([[5, 5], kind[:-2]])[: len(kind)].astype(np.uint32)
    shape = kind * np.uint32(0x9E3779B1) ^ one * np.uint32(0x85EBCA77) ^ two * np.uint32(0xC2B2AE3D)
    shape = (shape ^ shape >> np.uint32(15)) * np.uint32(0x2C1B3C6D) >> np.uint32(21)
    out = np.zeros((n, WIDTH))
    out[:, :TERMS] = np.bincount(text * TERMS + shape, minlength=n * TERMS).reshape(n, TERMS)

    letter = (kind == 1) | (kind == 2)
    low = np.where(kind == 2, points + 32, points).astype(np.uint64)
    edge = np.diff(np.concatenate([[0], letter.astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(first):
        with np.errstate(over="ignore"):
            mixed = (low * np.uint64(0x9E3779B97F4A7C15)) ^ (low << np.uint64(7))
            position = np.arange(len(low)) - np.repeat(np.concatenate([[0], first]), np.diff(np.concatenate([[0], first, [len(low)]])))
            mixed = mixed * (2 * position.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(letter, mixed, np.uint64(0)), dtype=np.uint64)])
        word = total[last] - total[first]
        word = word ^ word >> np.uint64(29)
        owner = text[first]
        bucket = ((word * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(53)).astype(np.int64)
        out[:, TERMS : 2 * TERMS] = np.bincount(owner * TERMS + bucket, minlength=n * TERMS).reshape(n, TERMS)
        words = np.bincount(owner, minlength=n)
        order = np.lexsort((word, owner))
        new = np.concatenate([[True], (word[order][1:] != word[order][:-1]) | (owner[order][1:] != owner[order][:-1])])
        distinct = np.bincount(owner[order][new], minlength=n)
        same = np.concatenate([[False], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])])
        repeats = np.bincount(owner[same], minlength=n)
    else:
        words = distinct = repeats = np.zeros(n, np.int64)
    upper, letters = np.bincount(text[kind == 2], minlength=n), np.bincount(text[letter], minlength=n)
    marks = np.bincount(text[kind >= 8], minlength=n)
    floor = np.maximum(words, 1)
    ratios = [upper / np.maximum(letters, 1), np.minimum(marks / floor, 2) / 2, np.minimum(distinct / floor / np.maximum(1, 1.25 - np.log10(floor + 1) / 4), 1), repeats / floor, np.minimum(np.log10(floor), 4) / 4]
    for i, r in enumerate(ratios):
        bin_ = np.minimum((r * BINS).astype(int), BINS - 1)
        out[np.arange(n), 2 * TERMS + i * BINS + bin_] = words > 0
    return out


class Model:
    """The latent space, and the labelled sample in it."""

    def __init__(self, sample: np.ndarray, labels: np.ndarray, prior: float):
        self.prior = prior
        seen = (sample > 0).sum(axis=0)
        self.weight = (np.log((1 + len(sample)) / (1 + seen)) + 0.1).astype(np.float32)
        self.weight[2 * TERMS :] = 1
        self.basis = np.zeros((WIDTH, 0), np.float32)
        self.vectors, self.labels = np.zeros((0, 0), np.float32), labels.astype(np.float32)
        if len(sample):
            x = self._weighted(sample)
            rng = np.random.Generator(np.random.PCG64(7))
            rank = min(RANK, len(x))
            y = x @ rng.standard_normal((WIDTH, rank + 10)).astype(np.float32)
            for _ in range(3):
                y = x @ (x.T @ np.linalg.qr(y)[0])
            q = np.linalg.qr(y)[0]
            self.basis = np.linalg.svd(q.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)
            self.vectors = self._unit(x @ self.basis)

    def _weighted(self, terms: np.ndarray) -> np.ndarray:
        x = np.log1p(terms).astype(np.float32)
        for part in (slice(0, TERMS), slice(TERMS, 2 * TERMS)):
            x[:, part] /= np.maximum(np.linalg.norm(x[:, part], axis=1, keepdims=True), 1e-9)
        return x * self.weight

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)

    def score(self, texts: list[str]) -> np.ndarray:
        """Scores in [0, 1]; texts without words, or a model without a sample, get the prior.

        The ``NEIGHBOURS`` nearest vectors vote, and all that are as near as the last of them.
        """
        out = np.full(len(texts), self.prior)
        if not len(self.vectors):
            return out
        for part in _slices(texts):
            terms = counts(texts[part])
            near = self._unit(self._weighted(terms) @ self.basis) @ self.vectors.T
            k = min(NEIGHBOURS, near.shape[1])
            least = np.partition(near, near.shape[1] - k, axis=1)[:, -k, None]
            votes = np.where(near >= least, np.maximum(near, 0), 0).astype(np.float64) ** SHARPNESS  # ties with the last one vote too
            total = votes.sum(axis=1)
            some = (total > 0) & (terms[:, 2 * TERMS :].sum(axis=1) > 0)
            out[np.flatnonzero(some) + part.start] = ((votes @ self.labels)[some] / total[some]).clip(0, 1)
        return out


def fit(docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label", rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` documents of each label, the first in the order of a hash of their ids.

    ``labelled`` has an id and a label a row, an id once; texts are only fetched for the
    chosen ids. Where several documents have a chosen id, the one with the least hash of its
    text stands for it, so the sample has one row an id, whatever ``docs`` holds. Null texts
    count as empty.
    """
    shares = {int(r[0]): r[1] for r in labelled.groupBy(label_col).count().collect()}
    prior = shares.get(1, 0) / max(1, sum(shares.values())) if shares else 0.5
    order = F.xxhash64(F.col(id_col), F.lit("quality"))
    picked = None
    for value in (0, 1):
        ids = labelled.where(F.col(label_col) == value).select(id_col, label_col).orderBy(order, id_col).limit(rows)
        picked = ids if picked is None else picked.unionByName(ids)
    picked = materialize(picked.withColumnRenamed(label_col, "_label").withColumnRenamed(id_col, "_picked"), "sample")
    wanted = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(picked), F.col("id") == F.col("_picked"))  # at most 2 * rows ids
    one = wanted.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.md5("text").alias("m"))).alias("of"))
    texts = wanted.join(one.select(F.col("id").alias("_of"), "of.h", "of.m"), (F.col("id") == F.col("_of")) & (F.xxhash64("text") == F.col("h")) & (F.md5("text") == F.col("m"))).dropDuplicates(["id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [t or "" for t in batch.column(1).to_pylist()]
            for part in _slices(whole):
                terms = counts(whole[part])
                at = [np.flatnonzero(r).astype(np.int32) for r in terms]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, part.stop - part.start), pa.array([a.tobytes() for a in at], pa.binary()), pa.array([r[a].astype(np.int32).tobytes() for r, a in zip(terms, at, strict=True)], pa.binary()), batch.column(2).slice(part.start, part.stop - part.start)],
                    names=["id", "at", "n", "label"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    got = texts.select("id", "text", F.col("_label").cast("int").alias("label")).mapInArrow(run, f"id {kind}, at binary, n binary, label int").orderBy("id", "at").collect()
    sample = np.zeros((len(got), WIDTH))
    for row, g in zip(sample, got, strict=True):
        row[np.frombuffer(g["at"], np.int32)] = np.frombuffer(g["n"], np.int32)
    return Model(sample, np.array([g["label"] for g in got]), prior)


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)`` of every row from its text alone; null and empty texts get the prior."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.score([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, label)`` to learn from: one label an id, ids with contradicting labels left out."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out())
    one = usable.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("_other"))
    return one.where("label = _other").drop("_other")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    scored = score_quality(docs, fit(docs, training_labels(labels)))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
