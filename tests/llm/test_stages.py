"""Pipeline stages on odd tables: nulls, repeated ids, clashing names, nothing at all."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinfold.llm import langid, mixing

EXTRA = ["score", "lang_pred", "spans", "copies", "_k0", "n_shingles", "_row", "_own", "removed_lines", "n_lines", "size", "target"]
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def _docs(spark, rows):
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return base.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in EXTRA])


def _text(i, n=40):
    return " ".join(f"{WORDS[(i * 7 + k * k + k // 3) % 20]}{chr(97 + (i + k) % 26)}" for k in range(n))


ODD = [(1, _text(1), "en", "a", 0), (1, _text(1), "en", "a", 0), (1, _text(2), "en", "b", 0), (None, _text(3), "en", None, 0), (None, _text(3) + " more", "en", "a", 0), (None, _text(4), None, "b", 0), (3, _text(5), "en", "a", 0), (5, _text(5) + " end", "en", "a", 0), (5, _text(6), "en", "b", 0)]
NOTHING = [(7, None, "en", "a", 0), (8, "", "en", "a", 0), (9, " \n ", None, None, 0)]


@pytest.mark.parametrize("at", range(4))
def test_stages_keep_columns_and_clean_rows(spark, at):
    name, stage = corpus_pipeline.STAGES[at]
    docs = _docs(spark, ODD + NOTHING)
    out = stage(spark, docs, "")
    assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
    got = sorted((r.doc_id or 0, r.text or "", r.score or "") for r in out.collect())
    rows = [(i or 0, t or "", f"score{i}" if i else "") for i, t, *_ in ODD]
    empty = [(i, t or "", f"score{i}") for i, t, *_ in NOTHING]
    if name == "language_id":
        assert got == sorted(rows)
    elif name == "line_dedup":
        assert got == sorted(rows + empty)
    elif name == "near_duplicates":  # one of rows 1 and 2, of 4 and 5, of 7 and 8
        assert len(got) == len(rows) - 3 + len(empty) and {(5, _text(6), "score5"), (1, _text(2), "score1")} <= set(got)
    else:
        assert all(got.count(r) <= 2 * rows.count(r) for r in got if r[1].strip())
    assert stage(spark, docs.limit(0), "").count() == 0


def test_foreign_scripts_are_rejected(spark):
    rows = [(i, _text(i), "en", "a", 0) for i in range(30)] + [(99, "слово за словом идёт", None, "a", 0), (98, _text(5) + " слово", None, "a", 0)]
    docs = _docs(spark, rows)
    got = {r.doc_id: r.score for r in langid.identify(docs, langid.fit_documents(docs), ["doc_id"]).collect()}
    assert got[99] == 0 and 0.9 < got[98] < 1
    assert {r.doc_id for r in corpus_pipeline.identify_language(spark, docs, "").collect()} == {*range(30), 98}
    many = _docs(spark, [(i, "a", f"l{i}", "a", 0) for i in range(langid.MAX_LANGS + 9)])
    with pytest.raises(ValueError, match="different values"):
        langid.fit(many)


def test_mixing_probabilities_differ_and_meet_the_target(spark):
    rows = [(i, " ".join(["w"] * (3 if i % 2 else 200 + i % 3)), f"s{i % 3}") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).toPandas()
    for _, g in got.groupby("source_size"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 202
    open_ = got[got.target < 1.9 * got.source_size]
    assert len(open_) and open_[open_["size"] > 3].copies.mean() > 1.5 * open_[open_["size"] == 3].copies.mean() > 0
    levels = mixing.mix(spark.createDataFrame([(*r, 1 + r[0] % 4) for r in rows], "doc_id long, text string, source string, level int"), level_col="level").toPandas()
    assert len(levels) == 3000
    one = mixing.mix(spark.createDataFrame([(1, "a b c", None)], "doc_id long, text string, source string")).first()
    assert (one.size, one.source_size, one.copies, one.taken) == (3, 3, 2, 6) or one.copies == 1
