"""Best-fit packing of tokenized documents into sequences of fixed length.

Method (linear grouping): the lengths above ``capacity / small`` are split into groups
of equal cardinality and rounded up to their group's longest; the few sizes that remain
are packed by a configuration linear program (column generation); the actual documents
replace the rounded ones; what is left over, and all short documents, go by best fit
into the room that remains.

Scale: lengths are integers from 1 to ``capacity``, so the driver only sees the histogram
of lengths (at most ``capacity`` rows) and makes a plan in runs: "ranks a to b of length L
go to sequences s to s + b - a at offset o". The number of runs depends on ``capacity``,
not on the number of documents. Every piece then finds its place from its length and its rank among pieces of
equal length: the task that writes a piece counts those before it, and a table with a row a
task and length has the sums of earlier tasks, so one frequent length is spread over all tasks.
"""

from __future__ import annotations

import bisect
import functools
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.llm.tables import table
from kinfold.session import materialize

CAPACITY = 2048
#: Distinct chunks, and parts of chunks, that a worker's tokenizer cache keeps.
CACHE_WORDS = 200_000


class ChunkEncoder:
    """Token ids of whole texts, with caches for the chunks between blanks and their parts.

    The tokenizer never joins text across a blank or a line feed (it collapses white
    space and drops it between its pre-tokens), so the ids of a text are those of its
    chunks in order. A chunk of plain Latin characters is split here by the tokenizer
    file's own pattern and its parts go straight to the tokenizer's model; any other
    chunk (and any with a "<", which may hold a special token) goes through the whole tokenizer.
    """

    def __init__(self, tokenizer_path: str):
        import json
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        with open(tokenizer_path, encoding="utf-8") as file:
            steps = json.load(file)["pre_tokenizer"]["pretokenizers"]
        self.parts = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.model = self.tokenizer.model.tokenize
        self.plain = regex.compile("[\x21-\x7e\u00a1-\u012f\u0131-\u024f]+").fullmatch
        # Byte-level names: printable bytes stand for themselves, the others for 256, 257, ... in order.
        shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
        hidden = [b for b in range(256) if b not in shown]
        self.names = {b: 256 + k for k, b in enumerate(hidden)}
        self.chunks = _Memo(self._chunk)
        self.pieces = _Memo(self._piece)

    def _piece(self, piece: str) -> bytes:
        name = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.names)
        return _words([t.id for t in self.model(name)])

    def _chunk(self, chunk: str) -> bytes:
        if "<" in chunk or not (chunk.isascii() and chunk.isprintable() or self.plain(chunk)):
            return _words(self.tokenizer.encode(chunk, add_special_tokens=False).ids)
        low, pieces = chunk.lower(), self.pieces
        if low.isalpha():
            return pieces[low]
        if low[:-1].isalpha() and not low[-1].isalnum():
            return pieces[low[:-1]] + pieces[low[-1]]
        return b"".join(map(pieces.__getitem__, self.parts(low)))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        return (b"".join(map(self.chunks.__getitem__, t.replace("\n", " ").split(" "))) for t in texts)


def _words(ids: list[int]) -> bytes:
    packed = array("I", ids)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class _Memo(dict):
    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) < CACHE_WORDS:  # the frequent ones come early
            self[key] = value
        return value


@functools.lru_cache(maxsize=2)
def encoder(tokenizer_path: str) -> ChunkEncoder:
    """A worker's encoder, which later tasks of the worker use again."""
    return ChunkEncoder(tokenizer_path)


def tokenize(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0, numbered: bool = False) -> DataFrame:
    """Pieces ``(id_col, piece, start, length, ids)`` of every text.

    With ``numbered`` they have ``_part`` and ``_nth`` too, as ``numbered`` adds them; they hold once the pieces are written.

    ``ids`` holds little-endian unsigned 32-bit token ids. Each document ends with
    ``end_id``; a null or empty text is that id alone. Only documents longer than
    ``capacity`` are cut, into pieces of ``capacity`` ids; the last may be shorter.
    Repeated rows give repeated pieces.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    end = int(end_id).to_bytes(4, "little")
    width = 4 * capacity

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer_path).encode
        task, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows, piece, start, length, ids, nth = [], [], [], [], [], []
                for row, data in enumerate(encode([t or "" for t in part.column(1).to_pylist()])):
                    data += end
                    for k, begin in enumerate(range(0, len(data), width)):
                        cut = data[begin : begin + width]
                        rows.append(row)
                        piece.append(k)
                        start.append(begin // 4)
                        length.append(len(cut) // 4)
                        ids.append(cut)
                        nth.append(seen.get(length[-1], 0))
                        seen[length[-1]] = nth[-1] + 1
                extra = [pa.array([task] * len(nth), pa.int32()), pa.array(nth, pa.int64())] if numbered else []
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), *extra],
                    names=[id_col, "piece", "start", "length", "ids", *(["_part", "_nth"] if numbered else [])],
                )

    return docs.select(id_col, text_col).mapInArrow(pieces, f"`{id_col}` {id_type}, piece int, start long, length long, ids binary" + ", _part int, _nth long" * numbered)


def _configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = 1000) -> list[tuple[list[int], float]]:
    """Column generation for the configuration program: ``(copies of each size, number)``.

    The knapsack that prices configurations goes by the number of pieces in them, which is
    small, as all sizes are large.
    """
    k, most = len(sizes), capacity // min(sizes)
    columns = np.diag([capacity // s for s in sizes]).astype(float)
    basis, inverse = columns.copy(), np.diag(1 / np.diag(columns))
    amount = inverse @ np.array(demand, float)
    room = np.arange(capacity + 1)[None, :] - np.array(sizes)[:, None]
    fits, room = room >= 0, np.maximum(room, 0)
    every = np.arange(capacity + 1)
    for _ in range(rounds):
        value = inverse.sum(axis=0)  # dual prices, as every pattern costs 1
        best, picks = np.zeros(capacity + 1), []
        for _ in range(most):
            gains = np.where(fits, best[room] + value[:, None], -1.0)
            top = gains.argmax(axis=0)
            better = gains[top, every] > best + 1e-12
            picks.append(np.where(better, top, -1))
            best = np.where(better, gains[top, every], best)
        if best[capacity] < 1 + 1e-4:
            break
        column, c = np.zeros(k), capacity
        for pick in reversed(picks):
            if pick[c] >= 0:
                column[pick[c]] += 1
                c -= sizes[pick[c]]
        step = inverse @ column
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        amount = amount - ratio[out] * step
        amount[out] = ratio[out]
        pivot = inverse[out] / step[out]
        inverse = inverse - np.outer(step, pivot)
        inverse[out] = pivot
    return [([int(x) for x in basis[:, j]], max(0.0, float(amount[j]))) for j in range(k)]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """The best of the grouped plans for some bounds between long and short pieces.

    Plain best fit is the plan only where every grouped plan needs more sequences, as it is
    where plenty of short pieces fill whatever room best fit leaves: tight configurations of
    long pieces then leave gaps that no piece fills. Twice the groups are tried where all
    plans are a hundredth above the least number that the tokens need.
    """
    least = -(-sum(n * k for n, k in histogram.items()) // capacity)
    best, needs = [], None
    for small, groups in ((3, 48), (5, 48), (8, 48), (1, 0), (8, 96)):
        if groups > 48 and needs <= 1.01 * least:
            break
        runs = grouped_plan(histogram, capacity, groups, small)
        needed = max((r[3] + r[2] for r in runs), default=0)
        if needs is None or needed < needs:
            best, needs = runs, needed
        if needs == least:
            break
    return best


def grouped_plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = 48, small: int = 3) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(length, first rank, number, first sequence, offset)`` that place every piece.

    ``histogram`` has the number of pieces of each length. The pieces of one length are
    told apart by rank only, so runs describe any number of them. Pieces longer than
    ``capacity / small`` are grouped; for ``small`` = 1 none are, and all go by best fit.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    used = dict.fromkeys(histogram, 0)
    sequences = 0
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> [(first sequence, number)]

    def place(length: int, number: int, sequence: int, offset: int) -> None:
        runs.append((length, used[length], number, sequence, offset))
        used[length] += number

    def leave(sequence: int, number: int, free: int) -> None:
        if number and free:
            room.setdefault(free, []).append((sequence, number))

    large = sorted((n for n in histogram if capacity // small < n and histogram[n]), reverse=True)
    total = sum(histogram[n] for n in large)
    if total:
        of_group: list[list[list[int]]] = [[]]  # per group [length, number], longest first
        quota, filled = -(-total // groups), 0
        for n in large:
            left = histogram[n]
            while left:
                take = min(left, quota - filled)
                of_group[-1].append([n, take])
                left, filled = left - take, filled + take
                if filled == quota:
                    of_group.append([])
                    filled = 0
        by_size: dict[int, list[list[int]]] = {}
        for group in of_group:
            if group:
                by_size.setdefault(group[0][0], []).extend(group)
        sizes = sorted(by_size)
        demand = [sum(x[1] for x in by_size[s]) for s in sizes]
        for copies, number in sorted(_configurations(sizes, demand, capacity), key=lambda x: (-x[1], x[0])):
            bins = int(number + 1e-6)
            if not bins:
                continue
            segments = [(sequences, bins, 0)]  # first sequence, number, tokens in use
            sequences += bins
            for i in reversed(range(len(sizes))):
                waiting = by_size[sizes[i]]
                for _ in range(copies[i]):
                    filled_segments = []
                    for first, count, fill in segments:
                        while count:
                            while waiting and not waiting[0][1]:
                                waiting.pop(0)
                            if not waiting:
                                filled_segments.append((first, count, fill))
                                break
                            take = min(count, waiting[0][1])
                            place(waiting[0][0], take, first, fill)
                            waiting[0][1] -= take
                            filled_segments.append((first, take, fill + waiting[0][0]))
                            first, count = first + take, count - take
                    segments = filled_segments
            for first, count, fill in segments:
                leave(first, count, capacity - fill)

    keys: list[int] = sorted(room)
    for length in sorted((n for n in histogram if histogram[n]), reverse=True):
        left = histogram[length] - used[length]
        while left:
            at = bisect.bisect_left(keys, length)
            if at < len(keys):
                free = keys[at]
                first, count = room[free].pop()
                if not room[free]:
                    del room[free]
                    keys.pop(at)
                each = free // length
            else:
                free, each = capacity, capacity // length
                count = max(1, left // each)
                first = sequences
                sequences += count
            full = min(count, left // each)
            for i in range(each if full else 0):
                place(length, full, first, capacity - free + i * length)
            left -= full * each
            changed = [(first, full, free - each * length)]
            if full < count:
                last = min(left, each)
                for i in range(last):
                    place(length, 1, first + full, capacity - free + i * length)
                left -= last
                changed += [(first + full, 1, free - last * length), (first + full + 1, count - full - 1, free)]
            for sequence, number, still in changed:
                if number and still:
                    if still not in room:
                        bisect.insort(keys, still)
                    leave(sequence, number, still)
    return runs


def numbered(pieces: DataFrame, label: str = "pieces") -> DataFrame:
    """``pieces``, written, with ``_part`` (the task that wrote a row) and ``_nth`` (its rank there among rows of its length, from 0)."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), {}
        for batch in batches:
            nth = []
            for n in batch.column(batch.schema.names.index("length")).to_pylist():
                nth.append(seen.get(n, 0))
                seen[n] = nth[-1] + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(nth), pa.int32()), pa.array(nth, pa.int64())], names=[*batch.schema.names, "_part", "_nth"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return materialize(pieces.mapInArrow(number, f"{fields}, _part int, _nth long"), label)


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` from 1 to ``capacity`` (null or other lengths are an error).

    Pieces of equal length are interchangeable: each has a rank, which counts those of
    earlier tasks and those before it in its own. Repeated rows get places of their own. An
    empty table gives an empty table.
    """
    spark = pieces.sparkSession
    pieces = pieces if {"_part", "_nth"} <= set(pieces.columns) else numbered(pieces)
    counts = materialize(pieces.groupBy("length", "_part").agg(F.count("*").alias("_n")), "counts")
    histogram = {r["length"]: int(r["n"]) for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).limit(capacity + 1).collect()}
    if not all(n is not None and 1 <= n <= capacity for n in histogram):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    runs = sorted(plan(histogram, capacity))
    starts = np.array([r[0] << 44 | r[1] for r in runs], np.int64)
    sequence = np.array([r[3] for r in runs], np.int64)
    offset = np.array([r[4] for r in runs], np.int64)
    lookup = spark.sparkContext.broadcast((starts, sequence, offset))
    # A task's rows of one length meet one row of counts: no key has more rows than a task wrote.
    before = counts.select(F.col("length").alias("_l"), F.col("_part").alias("_p"), (F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")).alias("_before"))
    ranked = pieces.join(before, (F.col("length") == F.col("_l")) & (F.col("_part") == F.col("_p"))).withColumn("_rank", F.col("_before") + F.col("_nth"))

    @F.pandas_udf("struct<sequence_id: long, offset: long>")
    def find(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        first, to, place = lookup.value
        key = (length.to_numpy(np.int64) << 44) | rank.to_numpy(np.int64)
        at = np.searchsorted(first, key, "right") - 1
        return pd.DataFrame({"sequence_id": to[at] + key - first[at], "offset": place[at]})

    kept = [c for c in pieces.columns if c not in ("_part", "_nth")]
    return ranked.withColumn("_place", find("length", "_rank")).select(*kept, "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """Tokenize and pack ``docs``: ``(id_col, piece, start, length, ids_crc32, sequence_id, offset)``.

    Sequence ids run from 0; offsets in a sequence have no gaps. With ``with_ids`` the
    token ids come along. A null id is kept as it is; repeated rows are packed as often
    as they occur. The tokens are made once: they are written to the shared folder (only
    their checksum, unless ``with_ids``).
    """
    pieces = tokenize(docs, tokenizer_path, id_col, text_col, capacity, end_id, numbered=True).withColumn("ids_crc32", F.crc32("ids"))
    kept = [id_col, "piece", "start", "length", "ids_crc32", "_part", "_nth"] + ["ids"] * with_ids
    return place_pieces(materialize(pieces.select(*kept), "pieces"), capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), default_tokenizer())
