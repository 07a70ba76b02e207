"""Jaccard self-join on word shingles with adaptive multi-match prefixes.

A document is the set of its distinct 5-word shingles, as 64-bit hashes in hash order.
Two sets of which neither is smaller than 80 % of the other can only reach a similarity
of 0.8 if their prefixes - the first n - ceil(0.8 n) + k shingles of each, in any order
that all documents share - have k shingles in common (multi-match prefix filter). Each
document's k adapts to what its candidates would cost: a shingle in the prefixes of many
documents is costly, and for each costly shingle in its prefix the document takes one
shingle more and asks for one match more. The costly ones can then supply at most k - 1
of the k matches, so only the others need to be indexed; the full count of k is asked
for before a pair's similarity is computed.

Steps: (1) one pass hashes the texts, with a signature of each set; equal sets are one node
from here on. (2) Counts of the plain prefixes of all documents, by packed 32-bit halves,
give the costly shingles (they only choose the order; any choice gives the same links).
Documents that have some count once more, over as much of their sets as their prefixes may
grow to: there, shingles are costly that plain prefixes rarely reach. (3) A third pass emits the indexed shingles, packed by bucket; shingles that only one
node has drop out where the buckets meet. Costly ones are dealt by node instead, as very
many nodes may have them. (4) Sets that agree in the
least shingles of some residue classes are compared with one of them. That is linear, and
binds large groups of near copies together beforehand. Then the
sets in long lists of the index are compared with two sets of each list, which binds what
the classes missed. (5) Every pair that still lies in
two different components and shares enough indexed shingles is verified. No link between
components can be missed, and pairs inside one component need no more links. (6) Components,
and the documents' smallest ids.

Equal 64-bit hashes stand for equal shingles. Sets are told apart by a second hash: where two
different ones share the first, it is chosen anew. Counting and meeting of shingles take one
bucket at a time, and the number of buckets grows with the bytes of text.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.tables import arrow_batches, free, table
from kinfold.operators.components import connected_components
from kinfold.session import materialize, release

WORDS = 5
PERCENT = 80
#: A shingle in the prefixes of so many documents is costly.
COSTLY = 24
#: Most shingles that either count adds to the costly ones (the most frequent; any choice is exact).
MOST_COSTLY = 200_000
#: Keys a set has in the rounds of stars.
BANDS = 10
#: Nodes of a band in a part, on average, that chains run through.
PART_NODES = 5_000
#: Bytes of text whose shingles are counted, or met, in one bucket.
BUCKET_BYTES = 32 << 20
#: Most tasks that buckets are dealt to; a task takes its buckets one after the other.
MOST_TASKS = 20_000
#: Shingles a task holds before it deals them out, packed by bucket.
FLUSH = 1 << 19
#: Most documents whose ids are broadcast to pick their texts for verification.
BROADCAST_ROWS = 400_000
#: Longs of the small parity sketch that index rows of sets with costly shingles carry.
SKETCH = 8
#: Sets of more shingles have no sketch: it would show too few of their differences.
SKETCHED = 1000
#: Most rows and bytes of an Arrow batch: pairs carry both whole sets.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20
#: Bytes of text hashed at once.
SLICE = 1 << 18
_MULTIPLIER = 0x9E3779B97F4A7C15 | 5
_MASK = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_values() -> np.ndarray:
    values = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    values[65:91] = values[97:123]  # A-Z count as a-z
    return values


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


def _slices(sizes: list[int]) -> Iterator[slice]:
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE:
            yield slice(start, i)
            start, total = i, 0
        total += n + 1
    if start < len(sizes):
        yield slice(start, len(sizes))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of the bytes starts, and its hash, which does not depend on the place.

    Bytes are taken ``SLICE`` at a time, up to a word's end, so memory is bounded by that and the longest word.
    """
    starts, hashes, at = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while at < len(data):
        end = at + SLICE
        while end < len(data):  # to the next gap, however long the word is
            some = data[end : end + 4096]
            gaps = np.flatnonzero((some == 32) | ((some >= 9) & (some <= 13)))
            if len(gaps):
                end += int(gaps[0])
                break
            end += len(some)
        part = data[at:end]
        gap = (part == 32) | ((part >= 9) & (part <= 13))
        power, inverse = _powers(1 << max(SLICE.bit_length(), (len(part) - 1).bit_length()))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_byte_values()[part] * power[: len(part)], dtype=np.uint64)])
        edge = np.diff(np.concatenate([[1], gap.astype(np.int8), [1]]).astype(np.int8))
        first, last = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        hashes.append(_mix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(np.uint64)))
        starts.append(first + at)
        at = end
    return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each UTF-8 text.

    Words are runs of bytes other than blank and 9 to 13, with A-Z as a-z. A text of fewer
    words is one shingle, of the whole sequence; a text without words has none.
    """
    out: list[np.ndarray] = []
    for part in _slices([len(t) for t in texts]):
        mine = texts[part]
        first, word = _words(np.frombuffer(b" ".join([*mine, b""]), np.uint8))
        borders = np.cumsum([len(t) + 1 for t in mine])
        starts = np.searchsorted(first, np.concatenate([[0], borders]))
        chain = np.zeros(max(0, len(word) - words + 1), np.uint64)
        for k in range(words):
            chain = chain * np.uint64(0xA0761D6478BD642F) + word[k : k + len(chain)]
        chain = _mix(chain)
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a >= words:
                out.append(np.unique(chain[a : b - words + 1]))
            elif b > a:
                whole = np.uint64(b - a)
                with np.errstate(over="ignore"):
                    for w in word[a:b]:
                        whole = whole * np.uint64(0xE7037ED1A0B428DB) + w
                out.append(_mix(np.array([whole], np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of which one must be shared by two similar sets, if one has ``n``."""
    return n - (percent * n + 99) // 100 + 1 if n else 0


def lead_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of which a similar set that is no smaller must share one."""
    return n - (2 * percent * n + 99 + percent) // (100 + percent) + 1 if n else 0


def _keys(shingles: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and lower half of each hash: what prefix counts are kept by."""
    return ((shingles >> np.uint64(32)) % np.uint64(buckets)) << np.uint64(32) | (shingles & np.uint64(0xFFFFFFFF))


class Costly:
    """The costly shingles, by their keys."""

    def __init__(self, keys: np.ndarray, buckets: int):
        self.keys, self.buckets = np.sort(keys), buckets

    def among(self, shingles: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(shingles), bool)
        mine = _keys(shingles, self.buckets)
        return self.keys[np.minimum(np.searchsorted(self.keys, mine), len(self.keys) - 1)] == mine


def adaptive_prefix(shingles: np.ndarray, costly: Costly, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray, int, int]:
    """``(cheap shingles to index, costly ones to index, length of the lengthened prefix, matches asked for)``.

    The prefix grows by one for each costly shingle in it. Where a set has too few others,
    it is the whole set, and the first costly ones are indexed too.
    """
    need = prefix_length(len(shingles), percent)
    dear = costly.among(shingles)
    cheap = np.flatnonzero(~dear)
    if len(cheap) >= need:
        long = int(cheap[need - 1]) + 1 if need else 0
        return shingles[cheap[:need]], shingles[:0], long, long - need + 1
    return shingles[cheap], shingles[dear][: need - len(cheap)], len(shingles), len(shingles) - need + 1


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _node(sets: list[np.ndarray], salt: int = 0) -> np.ndarray:
    """A hash of each whole set; other salts give other hashes."""
    key = np.uint64((0x5851F42D4C957F2D + salt * 0x9E3779B97F4A7C15) & _MASK)
    sums = [_mix(s ^ key).sum(dtype=np.uint64) + np.uint64(len(s)) for s in sets]
    return _signed(_mix(np.array(sums, np.uint64)))


def parity_bits(shingles: np.ndarray) -> bytes:
    """Parities of the shingles by their hash modulo a power of two of 4 n or more bits."""
    size = max(64, 1 << (4 * len(shingles) - 1).bit_length()) if len(shingles) else 64
    odd = np.bincount((shingles & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sketch(shingles: np.ndarray) -> np.ndarray | None:
    """Parities by the hash modulo a fixed number of bits, as longs; none for large sets."""
    if len(shingles) > SKETCHED:
        return None
    odd = np.bincount((shingles & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def bands(shingles: np.ndarray) -> np.ndarray:
    """Hashes of the least shingles of three residue classes each: equal for most sets that are alike."""
    least = np.zeros(3 * BANDS, np.uint64)
    names, at = np.unique(shingles % np.uint64(3 * BANDS), return_index=True)
    least[names.astype(np.int64)] = shingles[at]
    least = least.reshape(BANDS, 3)
    keys = _mix((least * np.array([1, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))
    return _signed(keys[least.any(axis=1)])


def least_difference(a: bytes, b: bytes) -> int:
    """What two sets differ in, at least: their parities differ nowhere else."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) != len(y):
        if len(x) > len(y):
            x = x[: len(x) // 2] ^ x[len(x) // 2 :]
        else:
            y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _dealt(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    """The columns' values by bucket, packed."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    names, starts = np.unique(bucket[order], return_index=True)
    for name, rows in zip(names.tolist(), np.split(order, starts[1:]), strict=True):
        yield name, [c[rows].tobytes() for c in columns]


def _by_bucket(packed: DataFrame, buckets: int) -> DataFrame:
    """Packed rows, those of a bucket together: a task needs memory for one bucket only."""
    return packed.repartition(min(buckets, MOST_TASKS), "bucket").sortWithinPartitions("bucket")


def _documents(docs: DataFrame, id_col: str, text_col: str, buckets: int, salt: int) -> DataFrame:
    """Rows ``(id, h, n, node, other)`` of each document, with its parities in ``data``, and packed rows ``(bucket, data)`` of plain prefixes.

    ``h`` is a hash of the text, ``other`` a second hash of the set.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = pa_type(docs, id_col)
    names = ["id", "h", "n", "node", "other", "bands", "sketch", "bucket", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            keys = _keys(np.concatenate(held), buckets)
            dealt = list(_dealt((keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32)))
            held.clear()
            n = len(dealt)
            return pa.RecordBatch.from_arrays([pa.nulls(n, id_type), *[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64())), pa.array([d[0] for d in dealt], pa.int64()), pa.array([d[1][0] for d in dealt], pa.binary())], names=names)

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sets = shingle_sets(_texts(part.column(1)))
                held += [s[: prefix_length(len(s))].copy() for s in sets if len(s)]  # not a view, which holds the set
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(_node(sets, salt)), pa.array(_node(sets, -1 - salt)), pa.array([bands(s) for s in sets], pa.list_(pa.int64())), pa.array([sketch(s) for s in sets], pa.list_(pa.int64())), pa.nulls(n, pa.int64()), pa.array([parity_bits(s) for s in sets], pa.binary())], names=names)
                if sum(map(len, held)) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("h")).mapInArrow(run, f"id {kind}, h long, n long, node long, other long, bands array<long>, sketch array<long>, bucket long, data binary")


def pa_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def _lengthened(docs: DataFrame, text_col: str, costly, buckets: int) -> DataFrame:
    """Packed rows ``(bucket, data)`` of what the prefixes of documents with costly shingles may grow to.

    The costly share of the plain prefix tells how much is needed; a quarter is added.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            keys = _keys(np.concatenate(held), buckets)
            dealt = list(_dealt((keys >> np.uint64(32)).astype(np.int64), keys.astype(np.uint32)))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([d[0] for d in dealt], pa.int64()), pa.array([d[1][0] for d in dealt], pa.binary())], names=["bucket", "data"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for s in shingle_sets(_texts(batch.column(0).slice(at, 512))):
                    need = prefix_length(len(s))
                    dear = int(costly.value.among(s[:need]).sum())
                    if dear:
                        held.append(s[: need * need * 5 // (4 * (need - dear)) + 16].copy() if dear < need else s)
                if sum(map(len, held)) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    return docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null").mapInArrow(run, "bucket long, data binary")


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Consecutive rows with equal values in the first ``keys`` columns, and what they have in the others."""
    key, held = None, []
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if row[:keys] != key:
                if held:
                    yield key, held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield key, held


def _costly(packed: DataFrame, buckets: int, known: Costly | None = None) -> Costly:
    """The shingles that the most of the packed prefixes have, and those known already."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in _runs(batches, 1):
            low, n = np.unique(np.frombuffer(b"".join(r[0] for r in rows), np.uint32), return_counts=True)
            many = n >= COSTLY
            key = (np.int64(name[0]) << np.int64(32)) | low[many].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n[many].astype(np.int64))], names=["key", "n"])

    counts = _by_bucket(packed.select("bucket", "data").where("bucket is not null"), buckets).mapInArrow(count, "key long, n long")
    top = counts.orderBy(F.desc("n"), "key").limit(MOST_COSTLY).select("key").toPandas()["key"]
    keys = top.to_numpy(np.int64).astype(np.uint64)
    return Costly(np.union1d(keys, known.keys) if known else keys, buckets)


def _shared(docs: DataFrame, text_col: str, costly, buckets: int, salt: int) -> DataFrame:
    """``(shingle, node, lead, dear)`` of indexed shingles that more than one node has, and of all costly ones."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, int, int]] = []

        def flush() -> pa.RecordBatch:
            nodes = {h[2]: h for h in held}.values()  # equal sets once
            parts = []
            for k in (0, 1):
                shingles = np.concatenate([h[k] for h in nodes])
                owner = np.repeat(np.array([h[2] for h in nodes], np.int64), [len(h[k]) for h in nodes])
                lead = np.concatenate([np.arange(len(h[k])) + k * len(h[0]) < h[3] for h in nodes]).astype(np.uint8)
                # Costly shingles may have very many nodes: they are dealt by node, and only passed on.
                by = shingles >> np.uint64(32) if k == 0 else _mix(owner.view(np.uint64))
                parts += [(name, bool(k), *data) for name, data in _dealt((by % np.uint64(buckets)).astype(np.int64), shingles, owner, lead)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in parts], t) for i, t in enumerate((pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()))], names=["bucket", "dear", "shingles", "nodes", "leads"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                sets = shingle_sets(_texts(batch.column(0).slice(at, 512)))
                for s, node in zip(sets, _node(sets, salt).tolist(), strict=True):
                    if len(s):
                        held.append((*adaptive_prefix(s, costly.value)[:2], node, lead_length(len(s))))
                if sum(len(h[0]) + len(h[1]) for h in held) >= FLUSH:
                    yield flush()
        if held:
            yield flush()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, dear), rows in _runs(batches, 2):
            x, y, z = zip(*rows, strict=True)
            shingles, nodes, leads = np.frombuffer(b"".join(x), np.int64), np.frombuffer(b"".join(y), np.int64), np.frombuffer(b"".join(z), np.uint8)
            order = np.lexsort((nodes, shingles))
            shingles, nodes, leads = shingles[order], nodes[order], leads[order]
            same = shingles[1:] == shingles[:-1]
            fresh = np.concatenate([[True], ~(same & (nodes[1:] == nodes[:-1]))])
            shingles, nodes, leads = shingles[fresh], nodes[fresh], leads[fresh]
            same = shingles[1:] == shingles[:-1]
            keep = np.ones(len(shingles), bool) if dear else np.concatenate([[False], same]) | np.concatenate([same, [False]])
            yield pa.RecordBatch.from_arrays([pa.array(shingles[keep]), pa.array(nodes[keep]), pa.array(leads[keep] > 0), pa.array(np.full(int(keep.sum()), dear))], names=["shingle", "node", "lead", "dear"])

    text = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    packed = text.mapInArrow(emit, "bucket long, dear boolean, shingles binary, nodes binary, leads binary")
    return packed.repartition(min(buckets, MOST_TASKS), "bucket").sortWithinPartitions("bucket", "dear").mapInArrow(meet, "shingle long, node long, lead boolean, dear boolean")


def _sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, costly, salt: int) -> DataFrame:
    """``(node, data, long, matches)`` of the nodes whose document ``(id, h, node)`` is wanted.

    Ids may be null. A document that several rows hold is returned once a task.
    """
    ids = wanted.select("id", "h", "node")
    if wanted.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)  # 24 bytes a row; beyond the bound the join is shuffled
    text = F.col(text_col).cast("string")
    whole = docs.select(F.col(id_col).alias("_id"), text.alias("text"), F.xxhash64(text).alias("_h"))
    picked = whole.join(ids, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_h") == F.col("h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                asked = part.column(1).to_numpy()
                fresh = [i for i, node in enumerate(asked.tolist()) if node not in seen and not seen.add(node)]
                part, asked = part.take(pa.array(fresh, pa.int64())), asked[fresh]
                sets = shingle_sets(_texts(part.column(0)))
                mine = np.flatnonzero(_node(sets, salt) == asked)
                sets = [sets[i] for i in mine]
                shape = [adaptive_prefix(s, costly.value)[2:] for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(pa.array(mine)), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([x[0] for x in shape], pa.int32()), pa.array([x[1] for x in shape], pa.int32())],
                    names=["node", "data", "long", "matches"],
                )

    return picked.select("text", "node").mapInArrow(run, "node long, data binary, long int, matches int")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the similarity."""
    sides = pairs.join(sets.select(F.col("node").alias("a"), F.struct("data", "long", "matches").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.struct("data", "long", "matches").alias("y")), "b")

    @F.pandas_udf("boolean")
    def similar(x: pd.DataFrame, y: pd.DataFrame) -> pd.Series:
        out = []
        for xd, xl, xm, yd, yl, ym in zip(x["data"], x["long"], x["matches"], y["data"], y["long"], y["matches"], strict=True):
            p, q = np.frombuffer(xd, np.uint64), np.frombuffer(yd, np.uint64)
            good = percent * max(len(p), len(q)) <= 100 * min(len(p), len(q))
            good = good and np.intersect1d(p[:xl], q[:yl], assume_unique=True).size >= min(xm, ym)
            if good:
                both = np.intersect1d(p, q, assume_unique=True).size
                good = 100 * both >= percent * (len(p) + len(q) - both)
            out.append(good)
        return pd.Series(out, dtype=bool)

    return sides.where(similar("x", "y")).select("a", "b")


def join_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, n_shingles, component_id)`` of every row of ``docs``.

    Documents are linked when their shingle sets have a Jaccard similarity of 0.8 or more;
    ``component_id`` is the smallest id that links lead to, the row's own included. Null,
    empty and blank texts have no shingles and link with nothing: their ``component_id`` is
    their own id. Rows with equal texts are linked, also with equal ids; null ids are linked
    like any others and are never the smallest, so a group of null ids only has a null
    component. An empty table gives an empty table.
    """
    with arrow_batches(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        return _groups(docs, id_col, text_col)


def _groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All that runs Python runs here; what is returned reads tables it has written."""
    spark = docs.sparkSession
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    for salt in range(4):
        first = materialize(_documents(docs, id_col, text_col, buckets, salt), "shingles")
        nodes = first.where("bucket is null and n > 0").groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("null"), "id", "h")).alias("of"), F.max("n").alias("n"), F.any_value("data").alias("bits"), F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"), F.min("other").alias("other"), F.max("other").alias("other2"))
        nodes = materialize(nodes.select("node", "of.id", "of.h", "n", "bits", "bands", "sketch", "other", "other2"), "nodes")
        if nodes.where("other != other2").isEmpty():
            break  # else two different sets share a hash: another salt
        release(first, nodes)
    else:
        raise RuntimeError("hashes of different sets keep colliding")
    documents = first.where("bucket is null").select("id", "n", "node")
    plain = spark.sparkContext.broadcast(_costly(first, buckets))
    costly = spark.sparkContext.broadcast(_costly(_lengthened(docs, text_col, plain, buckets), buckets, plain.value))
    shared = materialize(_shared(docs, text_col, costly, buckets, salt), "shared")
    index = materialize(shared.distinct().join(nodes.select("node", "n"), "node"), "index")
    release(shared)

    @F.pandas_udf("long")
    def difference(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([least_difference(a, b) for a, b in zip(x, y, strict=True)], dtype="int64")

    def plausible(pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, na, b, nb)`` whose parities allow the similarity.

        Sets so similar differ in no more than (na + nb) / 9 shingles; their parities show
        differences at a sixteenth of the sets' size.
        """
        for side in ("a", "b"):
            pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("bits").alias(f"bits_{side}")).hint("merge"), side)
        differ = difference("bits_a", "bits_b")
        return pairs.where((100 + PERCENT) * differ <= (100 - PERCENT) * (F.col("na") + F.col("nb"))).select("a", "b")

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes, "node")
        sets = materialize(_sets(docs, id_col, text_col, ends, costly, salt), "sets")
        out = materialize(_verified(pairs, sets), label)
        release(sets)
        return out

    # Stars and chains first: of the nodes with an equal band, each is compared with the least one,
    # and with the two before it among those that fall into the same part of the band.
    banded = nodes.select("node", "n", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min(F.struct("node", "n")).alias("of"), F.max("node").alias("last"), F.count("*").alias("c")).where("of.node != last")
    stars = banded.join(leaders.select("band", F.col("of").alias("x"), F.ceil(F.col("c") / PART_NODES).alias("parts")), "band")
    before = Window.partitionBy("band", F.pmod("node", "parts")).orderBy("node")
    lags = stars.select("node", "n", *[F.lag(F.struct("node", "n"), k).over(before).alias(f"x{k}") for k in (1, 2)])
    chains = lags.select("node", "n", F.explode(F.array_compact(F.array("x1", "x2"))).alias("x"))
    flat = [F.col("x.node").alias("a"), F.col("x.n").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb")]
    stars = stars.select(*flat).union(chains.select(*flat)).where("a != b").distinct()
    alike = PERCENT * F.greatest("na", "nb") <= 100 * F.least("na", "nb")
    stars = materialize(plausible(stars.where(alike)), "stars")
    links = verified(stars, "links")
    found = connected_components(links, "a", "b")

    # Long lists of the index next, each set against two that a hash picks from the list.
    long = index.groupBy("shingle").agg(F.count("*").alias("c"), *[f(F.struct("node", "n"), F.xxhash64("shingle", "node")).alias(k) for k, f in (("x1", F.min_by), ("x2", F.max_by))]).where(F.col("c") >= COSTLY)
    spokes = index.join(long, "shingle").select("node", "n", F.explode(F.array("x1", "x2")).alias("x")).select(*flat).where("a != b").where(alike)
    spokes = spokes.select(*[F.when(F.col("a") < F.col("b"), F.col(x)).otherwise(F.col(y)).alias(x) for x, y in (("a", "b"), ("na", "nb"), ("b", "a"), ("nb", "na"))]).distinct()
    for side in ("a", "b"):
        spokes = spokes.join(found.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left")
    spokes = spokes.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "na", "b", "nb")
    spokes = materialize(plausible(spokes).join(stars, ["a", "b"], "left_anti"), "spokes")
    if not spokes.isEmpty():
        stars = stars.unionByName(spokes)
        links = links.unionByName(verified(spokes, "spoke_links"))
        found = connected_components(links, "a", "b")

    # A set with costly shingles in the index has all its others there: what dropped out of
    # these is in no other such set. ``alone`` counts it; null stands for a set without costly ones.
    need = F.col("n") - F.floor((PERCENT * F.col("n") + 99) / 100) + 1
    alone = index.groupBy("node").agg(F.count("*").alias("kept"), F.max("n").alias("n"), F.max("dear").alias("dear")).select("node", F.when(F.col("dear"), need - F.col("kept")).alias("alone"))
    alone = alone.join(nodes.select("node", "sketch"), "node").withColumn("sketch", F.when(F.col("alone").isNotNull(), F.col("sketch")))
    placed = index.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")).join(alone, "node")
    placed = materialize(placed, "placed")
    split = placed.groupBy("shingle").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo != hi").select("shingle")
    open_ = placed.join(split, "shingle")
    a, b = (open_.select("shingle", F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("component").alias(f"c{x}"), F.col("alone").alias(f"alone_{x}"), F.col("sketch").alias(f"sketch_{x}"), F.col("lead").alias(f"lead_{x}")) for x in "ab")
    near = (100 * F.col("na") >= PERCENT * F.col("nb")) & ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    common = F.least(F.col("na") - F.col("alone_a"), F.col("nb") - F.col("alone_b"))  # at most, where both have costly ones
    enough = F.col("alone_a").isNull() | F.col("alone_b").isNull() | ((100 + PERCENT) * common >= PERCENT * (F.col("na") + F.col("nb")))
    differ = sum((F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH)), F.lit(0))
    enough &= F.coalesce((100 + PERCENT) * differ <= (100 - PERCENT) * (F.col("na") + F.col("nb")), F.lit(True))
    # The smaller set of a pair has a common shingle in its lead, or the pair is not similar.
    rest = a.join(b, "shingle").where((F.col("ca") != F.col("cb")) & near & enough).groupBy("a", "na", "b", "nb").agg(F.count("*").alias("c"), F.max("lead_a").alias("leads")).where("leads")
    # Behind the prefix that ends first there are n - p shingles of its set, at most those of
    # the larger one, so that c + nb - pb bounds what is common, and 180 times that must reach
    # 80 * (na + nb).
    behind = F.floor((PERCENT * F.col("nb") + 99) / 100) - 1
    rest = plausible(rest.where((100 + PERCENT) * (F.col("c") + behind) >= PERCENT * (F.col("na") + F.col("nb"))))
    rest = materialize(rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(stars, ["a", "b"], "left_anti"), "rest")
    if not rest.isEmpty():
        links = links.unionByName(verified(rest, "more"))
        found = connected_components(links, "a", "b")

    whole = nodes.select("node", "id").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = whole.groupBy("component").agg(F.min("id").alias("component_id"))
    groups = materialize(whole.join(smallest, "component").select("node", "component_id"), "groups")
    release(index, placed, stars, rest)
    out = documents.select("id", "n", "node").join(groups, "node", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one row, the first in the order in which the table is read, of each linked group.

    Rows are told apart by a number of their own, so null and repeated ids make no
    difference: rows with equal texts are one group, rows with equal ids and different texts
    are not. Rows without shingles are linked with nothing and stay. Other columns of any
    name stay as they are.
    """
    row = free("row", docs.columns)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")  # written, so that numbers stay
    groups = join_groups(rows, row, text_col)
    stay = materialize(groups.where(F.col("component_id") == F.col(row)).select(F.col(row).alias(free("stay", docs.columns))), "stay")
    return rows.join(stay.hint("merge"), F.col(row) == stay[stay.columns[0]], "left_semi").select(*docs.columns)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_groups(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
    WHEN len(w) > 0 THEN [len(w)::VARCHAR || chr(10) || array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id != y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT documents.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(documents.doc_id, coalesce(m, documents.doc_id)) AS component_id
FROM documents LEFT JOIN sizes ON sizes.doc_id = documents.doc_id LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = documents.doc_id
"""
