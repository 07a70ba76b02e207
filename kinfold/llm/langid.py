"""Language identification of mixed-language text.

Script ranges narrow the candidate languages of each word; every word gets a score for
each candidate from character trigrams and tetragrams (hashed, with marks for the word's
ends); a Viterbi pass over the words with a penalty for each switch labels spans; the
document's language is the one that labels most of its words.

Scale: the model is two tables of fixed size (``BUCKETS`` rows, one column a language),
counted on the executors over a bounded sample of labelled rows. Prediction is one map
over the documents without a shuffle; whole texts are scored as arrays of code points, in
slices of bounded length.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.tables import free, table

BUCKETS = 1 << 16
#: Expected number of labelled rows a language that the model is fitted on.
TRAIN_ROWS = 1500
#: Most languages of a model: its size is that many times ``BUCKETS``.
MAX_LANGS = 200
SWITCH = 9.0
CLIP = 6.0
#: Scores held at once by the exact pass, where a single text does not have more.
CELLS = 1 << 21
#: Code points scored at once.
SLICE = 1 << 20

#: First and last code point of each script's ranges (Unicode).
SCRIPTS = {
    "Latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x77F), (0x8A0, 0x8FF)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}


@functools.cache
def script_of() -> np.ndarray:
    """Script number of every code point: 0 for what is no letter, the last number for other scripts."""
    out = np.zeros(0x110000, np.uint8)
    letters = [c for c in range(0x110000) if chr(c).isalpha()]
    out[letters] = len(SCRIPTS) + 1
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            part = out[first : last + 1]
            part[part > 0] = number
    return out


def _features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of the words of ``texts``.

    Returns the trigram and tetragram buckets of each scored position, the first position
    of each word, each word's script and each word's text. Words are runs of letters; the
    position behind a word's last letter is scored too, as its end.
    """
    texts = [t.lower() for t in texts]
    points = np.frombuffer(" ".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in texts])
    script = script_of()[points]
    letter = script > 0
    c0 = np.where(letter, points, 32).astype(np.uint32)
    c1 = np.concatenate([[32], c0[:-1]]).astype(np.uint32)
    c2 = np.where(c1 == 32, 32, np.concatenate([[32, 32], c0[:-2]])[: len(c0)]).astype(np.uint32)
    c3 = np.where(c2 == 32, 32, np.concatenate([[32, 32, 32], c0[:-3]])[: len(c0)]).astype(np.uint32)
    first = letter & (c1 == 32)
    scored = letter | (c1 != 32)
    three = (c0 * np.uint32(0x9E3779B1)) ^ (c1 * np.uint32(0x85EBCA77)) ^ (c2 * np.uint32(0xC2B2AE3D))
    four = three ^ (c3 * np.uint32(0x27D4EB2F))
    bucket = [((x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16))[scored] for x in (three, four)]
    text_of_word = np.searchsorted(ends, np.flatnonzero(first), "right")
    return bucket[0], bucket[1], np.flatnonzero(first[scored]), script[first], text_of_word


def _slices(texts: list[str]) -> Iterator[slice]:
    """Slices of about ``SLICE`` characters; a longer text is a slice of its own."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > SLICE:
            yield slice(start, i)
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield slice(start, len(texts))


class Model:
    """Log probabilities of n-gram buckets by language, and the scripts of each language."""

    def __init__(self, langs: list[str], three: np.ndarray, four: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        smooth = [np.log((c + 0.5) / (c.sum(axis=0) + 0.5 * BUCKETS)) for c in (three, four)]
        self.tables = [np.ascontiguousarray(x.T, np.float32) for x in smooth]  # language by bucket
        share = scripts / np.maximum(scripts.sum(axis=0), 1)
        self.candidates = share >= 0.01  # script by language

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per word: scores by language (0 for the best candidate, down to ``-CLIP``), its text, and whether it has a candidate.

        A word in a script that no learned language uses scores 0 for all of them.
        """
        three, four, starts, script, text = _features(texts)
        n = len(text)
        if not n:
            return np.zeros((0, len(self.langs)), np.float32), text, np.zeros(0, bool)
        total = np.empty((n, len(self.langs)), np.float32)
        for k in range(len(self.langs)):
            total[:, k] = np.add.reduceat(self.tables[0][k][three] + self.tables[1][k][four], starts)
        allowed = self.candidates[script]
        none = ~allowed.any(axis=1)
        total[~allowed] = -np.inf
        total[none] = 0
        total -= total.max(axis=1, keepdims=True)
        return np.maximum(total, -CLIP), text, ~none


def constant(scores: np.ndarray, switch: float) -> int:
    """The one label that is best for all words of a text when a change costs ``switch``; -1 if none is proven.

    Against the label with the best sum, let no stretch of words gain more than ``switch`` by
    another label, nor the text's beginning and end together. A path with m stretches of
    other labels inside the text pays for m + 1 changes or more, one at its border for m; and
    a path without the best label pays m - 1, of which beginning and end gain one.
    """
    best = int(scores.sum(axis=0).argmax())
    begin = end = 0.0
    for other in range(scores.shape[1]):
        if other != best:
            rise = np.cumsum(scores[:, other] - scores[:, best], dtype=np.float64)
            low = np.minimum(np.minimum.accumulate(rise), 0)
            if (rise - low).max() > switch:
                return -1
            begin, end = max(begin, rise.max()), max(end, rise[-1] - low[-1])
    return best if begin + end <= switch else -1


def decode(many: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """The best label of each word of each text when each change of label costs ``switch``.

    Of equal paths one that changes as late as it can is taken, of equal labels the first.
    """
    out = [np.full(len(s), constant(s, switch), np.int16) for s in many]
    hard = sorted((i for i in range(len(many)) if out[i][0] < 0), key=lambda i: -len(many[i]))
    while hard:
        take = max(1, min(len(hard), CELLS // (len(many[hard[0]]) * many[0].shape[1])))
        for i, path in zip(hard[:take], viterbi([many[i] for i in hard[:take]], switch), strict=True):
            out[i] = path
        hard = hard[take:]
    return out


def viterbi(many: list[np.ndarray], switch: float) -> list[np.ndarray]:
    """The exact pass for several texts at once, one step a word position.

    Shorter texts go on with scores of 0, on which no change of label pays.
    """
    n, longest, k = len(many), max(map(len, many)), many[0].shape[1]
    scores = np.zeros((longest, n, k), np.float32)
    for i, s in enumerate(many):
        scores[: len(s), i] = s
    total = scores[0].astype(np.float64)
    came = np.empty((longest, n, k), np.int16)
    labels, rows = np.arange(k, dtype=np.int16), np.arange(n)
    for t in range(1, longest):
        jump = total.argmax(axis=1)
        reach = total[rows, jump] - switch
        stay = total >= reach[:, None]
        came[t] = np.where(stay, labels, jump[:, None])
        total = np.where(stay, total, reach[:, None]) + scores[t]
    path = np.empty((longest, n), np.int16)
    path[-1] = total.argmax(axis=1)
    for t in range(longest - 1, 0, -1):
        path[t - 1] = came[t, rows, path[t]]
    return [path[: len(s), i] for i, s in enumerate(many)]


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = TRAIN_ROWS) -> Model:
    """Fit on about ``rows`` labelled documents a language, chosen by a hash of their ids.

    ``labelled`` has no null language, and at most ``MAX_LANGS`` different ones (an error
    otherwise: the column is no language label then). N-grams are counted on the executors;
    the driver gets the counts: 2 * ``BUCKETS`` rows a language at most. Null texts are left
    out; without labelled rows the model knows ``und`` only.
    """
    counts = {r[0]: r[1] for r in labelled.groupBy(lang_col).count().limit(MAX_LANGS + 1).collect()}
    if len(counts) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} different values of {lang_col}")
    langs = sorted(counts)
    if not langs:
        return Model(["und"], np.zeros((BUCKETS, 1)), np.zeros((BUCKETS, 1)), np.zeros((len(SCRIPTS) + 2, 1)))
    share = F.lit(0.0)
    for lang in langs:
        share = F.when(F.col(lang_col) == lang, F.lit(min(1.0, rows / counts[lang]))).otherwise(share)
    drawn = F.pmod(F.xxhash64(F.col(id_col), F.lit("langid")), F.lit(1 << 20)) < share * (1 << 20)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tables = np.zeros((2 * BUCKETS + len(SCRIPTS) + 2, len(langs)), np.int64)
        for batch in batches:
            for at, lang in enumerate(langs):
                texts = batch.loc[batch[lang_col] == lang, text_col].tolist()
                for part in _slices(texts):
                    three, four, _, script, _ = _features(texts[part])
                    tables[:BUCKETS, at] += np.bincount(three, minlength=BUCKETS)
                    tables[BUCKETS : 2 * BUCKETS, at] += np.bincount(four, minlength=BUCKETS)
                    tables[2 * BUCKETS :, at] += np.bincount(script, minlength=len(SCRIPTS) + 2)
        row, lang = np.nonzero(tables)
        yield pd.DataFrame({"row": row, "lang": lang, "n": tables[row, lang]})

    sample = labelled.where(drawn & F.col(text_col).isNotNull()).select(text_col, lang_col)
    got = sample.mapInPandas(count, "row long, lang long, n long").groupBy("row", "lang").agg(F.sum("n").alias("n")).toPandas()
    tables = np.zeros((2 * BUCKETS + len(SCRIPTS) + 2, len(langs)))
    tables[got["row"], got["lang"]] = got["n"]
    return Model(langs, tables[:BUCKETS], tables[BUCKETS : 2 * BUCKETS], tables[2 * BUCKETS :])


def label(texts: list[str | None], model: Model, switch: float = SWITCH) -> list[tuple[str, float, list[tuple[str, int, int]]]]:
    """Language, share of words, and spans ``(language, first word, words)`` of each text.

    Words without a candidate language belong to spans, but speak for no language: they
    count against the share.
    """
    out: list[tuple[str, float, list[tuple[str, int, int]]]] = []
    whole = [t or "" for t in texts]
    for part in _slices(whole):
        mine = whole[part]
        scores, text, known = model.scores(mine)
        borders = np.searchsorted(text, np.arange(len(mine) + 1))
        some = [i for i in range(len(mine)) if borders[i] < borders[i + 1]]
        paths = dict(zip(some, decode([scores[borders[i] : borders[i + 1]] for i in some], switch), strict=True))
        for i in range(len(mine)):
            if i not in paths:
                out.append(("und", 0.0, []))
                continue
            path = paths[i]
            words = np.bincount(path[known[borders[i] : borders[i + 1]]], minlength=len(model.langs))
            best = int(words.argmax())
            cuts = np.flatnonzero(np.diff(path)) + 1
            starts = [0, *cuts.tolist()]
            spans = [(model.langs[path[a]], a, b - a) for a, b in zip(starts, [*starts[1:], len(path)], strict=True)]
            out.append((model.langs[best], float(words[best] / len(path)), spans))
    return out


def identify(docs: DataFrame, model: Model, id_cols: list[str], text_col: str = "text", switch: float = SWITCH, names: tuple[str, str, str] = ("lang_pred", "score", "spans")) -> DataFrame:
    """``(id_cols, lang_pred, score, spans)`` of every row of ``docs``, from its text alone.

    ``score`` is the share of the text's words in spans of ``lang_pred`` whose script that
    language uses. A text that is null or has no letter is ``und`` with score 0 and no spans;
    one in unlearned scripts only has score 0. Ties go to the language that sorts first.
    Repeated rows give repeated results. ``names`` are those of the three columns, for
    ``id_cols`` that have them already.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in id_cols)
    span = pa.list_(pa.struct([("lang", pa.string()), ("first_word", pa.int64()), ("words", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = label(batch.column(len(id_cols)).to_pylist(), shared.value, switch)
            spans = [[{"lang": a, "first_word": b, "words": c} for a, b, c in x[2]] for x in got]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(id_cols))], pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64()), pa.array(spans, span)],
                names=[*id_cols, *names],
            )

    pred, share, found = names
    own = free("text", id_cols)
    return docs.select(*id_cols, F.col(text_col).alias(own)).mapInArrow(run, f"{kinds}, `{pred}` string, `{share}` double, `{found}` array<struct<lang: string, first_word: long, words: long>>")


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit_documents(docs: DataFrame) -> Model:
    return fit(docs.where(~held_out() & F.col("lang").isNotNull()))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit_documents(docs), ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
