import datetime

import pytest
from pyspark.sql import functions as F

from kinfold.functions import clean, compare


@pytest.mark.parametrize(("a", "b", "want"), [("SMITH", "SMITX", 0.92), ("SMITH", "SMYTH", 0.893), ("ROBERT", "BOB", 0.5), ("", "A", 0.0), ("A", "A", 1.0)])
def test_jaro_winkler(a, b, want):
    assert compare.jaro_winkler(a, b) == pytest.approx(want, abs=5e-4)


def test_later_canonical_name_counts():
    assert compare.CANONICAL["PAT"] == "PATRICIA"


def test_names(spark):
    rows = [("SMITH", "SMITH", "exact"), (None, "SMITH", "missing"), ("", "SMITH", "missing"), ("ROBERT", "BOB", "nickname"), ("BOB", "BOBBY", "nickname"), ("SMITH", "SMITX", "near"), ("SMITH", "SMYTH", "similar"), ("SMITH", "ZZZZZZ", "different"), ("PATRICK", "PAT", "similar")]
    df = spark.createDataFrame(rows, "a string, b string, want string").withColumn("jw", compare.jaro_winkler_column(F.col("a"), F.col("b")))
    got = df.select("want", compare.name_level(F.col("a"), F.col("b"), F.col("jw")).alias("got")).collect()
    assert [r.got for r in got[:8]] == [r.want for r in got[:8]]
    assert got[8].got != "nickname"


def test_dates(spark):
    base = datetime.date(1980, 3, 7)
    rows = [(base, base, "exact"), (base, datetime.date(1980, 7, 3), "transposed"), (base, datetime.date(1981, 3, 7), "one_component_off"), (base, datetime.date(1980, 5, 9), "year_only"), (base, datetime.date(1990, 5, 9), "different"), (None, base, "missing")]
    df = spark.createDataFrame(rows, "a date, b date, want string")
    assert all(r.want == r.got for r in df.select("want", compare.dob_level(F.col("a"), F.col("b")).alias("got")).collect())


def test_phonetic_and_cleaning(spark):
    rows = [("SMITH", "S530"), ("SMTIH", "S530"), ("SANCHEZ", "S522"), ("ASHCRAFT", "A226"), ("123", None), (None, None)]
    df = spark.createDataFrame(rows, "a string, want string")
    assert all(r.want == r.got for r in df.select("want", clean.phonetic_key(F.col("a")).alias("got")).collect())
    r = spark.createDataFrame([("13/45/1980", " 3/7/1980 ", "--")], "a string, b string, c string").select(clean.parse_date(F.col("a"), "M/d/yyyy"), clean.parse_date(F.col("b"), "M/d/yyyy"), clean.digits(F.col("c"))).first()
    assert tuple(r) == (None, datetime.date(1980, 3, 7), None)
