"""Cleaning and normalizing columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the codes of A to Z, vowels and H, W, Y as 0.
PHONETIC_CODES = "01230120022455012623010202"
DATE_FORMATS = {"VENDOR_A": "yyyy-M-d", "VENDOR_B": "M/d/yyyy", "VENDOR_C": "d-MMM-yyyy"}


def is_missing(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def clean_name(c: Column) -> Column:
    return F.upper(F.trim(c))


def standard_gender(c: Column) -> Column:
    """M, F, or U for anything else and null."""
    g = F.upper(F.trim(c))
    return F.when(g.isin("M", "F"), g).otherwise("U")


def digits(c: Column) -> Column:
    """The digits of a text; null if there are none."""
    return F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def parse_date(c: Column, pattern: str) -> Column:
    """The date, or null where the text is none."""
    return F.try_to_date(F.trim(c), pattern)


def phonetic_key(c: Column) -> Column:
    """Letter and three digits by sound; null for texts without letters.

    Equal neighbouring codes count once, also across vowels' zeros next to each other; the
    first letter's own code is dropped with its neighbours of the same code.
    """
    letters = F.regexp_replace(F.upper(c), "[^A-Z]", "")
    coded = F.regexp_replace(F.translate(letters, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", PHONETIC_CODES), r"(.)\1+", "$1")
    tail = F.translate(F.substring(coded, F.lit(2), F.length(coded)), "0", "")
    return F.when(letters != "", F.concat(F.substring(letters, 1, 1), F.rpad(F.substring(tail, 1, 3), 3, "0")))
