"""Comparators: discrete levels of agreement of two values."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions.clean import is_missing
from kinfold.sources.feeds import NICKNAMES

NEAR, SIMILAR = 0.90, 0.80
#: Variant to canonical name; a canonical name stands for itself; the last entry counts.
CANONICAL = {v: name for name, variants in NICKNAMES.items() for v in [name, *variants]}


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised above 0.7 by a tenth for each of up to four equal first letters."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    taken = [False] * len(b)
    from_a = []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not taken[j] and b[j] == ch:
                taken[j] = True
                from_a.append(ch)
                break
    m = len(from_a)
    if not m:
        return 0.0
    from_b = [ch for ch, t in zip(b, taken, strict=True) if t]
    swaps = sum(x != y for x, y in zip(from_a, from_b, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro)


#: Pairs of names whose similarity a worker keeps: names repeat, so most pairs are known.
MEMO = 1_000_000
_memo: dict[tuple[str, str], float] = {}


def _similarities(a: pd.Series, b: pd.Series) -> pd.Series:
    out = []
    for pair in zip(a, b, strict=True):
        found = _memo.get(pair)
        if found is None:
            found = jaro_winkler(pair[0] or "", pair[1] or "")
            if len(_memo) < MEMO:
                _memo[pair] = found
        out.append(found)
    return pd.Series(out, dtype="float64")


def jaro_winkler_column(a: Column, b: Column) -> Column:
    return F.pandas_udf(_similarities, "double")(a, b)


def canonical(c: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in CANONICAL.items() for x in item])
    return F.try_element_at(table, c)


def name_level(a: Column, b: Column, similarity: Column) -> Column:
    """missing, exact, nickname, near, similar or different, the first that holds."""
    alias = canonical(a)
    return (
        F.when(is_missing(a) | is_missing(b), "missing").when(a == b, "exact").when(alias == canonical(b), "nickname")
        .when(similarity >= NEAR, "near").when(similarity >= SIMILAR, "similar").otherwise("different")
    )


def dob_level(a: Column, b: Column) -> Column:
    """missing, exact, transposed, one_component_off, year_only or different."""
    y, m, d = F.year(a) == F.year(b), F.month(a) == F.month(b), F.dayofmonth(a) == F.dayofmonth(b)
    crossed = y & (F.month(a) == F.dayofmonth(b)) & (F.dayofmonth(a) == F.month(b))
    return (
        F.when(a.isNull() | b.isNull(), "missing").when(a == b, "exact").when(crossed, "transposed")
        .when(y.cast("int") + m.cast("int") + d.cast("int") == 2, "one_component_off").when(y, "year_only").otherwise("different")
    )


def exact_level(a: Column, b: Column, unknown: str | None = None) -> Column:
    """missing, exact or different; the value ``unknown`` counts as missing."""
    gone = is_missing(a) | is_missing(b)
    if unknown:
        gone = gone | (a == unknown) | (b == unknown)
    return F.when(gone, "missing").when(a == b, "exact").otherwise("different")


def agreement(pairs: DataFrame) -> DataFrame:
    """Add the five level columns to pairs with ``a_*`` and ``b_*`` fields.

    Similarities come from one vectorized pass over the pairs, without a shuffle; names that
    are equal or missing are not sent.
    """
    for field in ("first_name", "last_name"):
        a, b = F.col(f"a_{field}"), F.col(f"b_{field}")
        differ = (a != b) & (a != "") & (b != "")
        pairs = pairs.withColumns({f"x_{field}": F.when(differ, a), f"y_{field}": F.when(differ, b)})
    pairs = pairs.withColumns({f"jw_{f}": jaro_winkler_column(F.col(f"x_{f}"), F.col(f"y_{f}")) for f in ("first_name", "last_name")})
    of = lambda side, field: F.col(f"{side}_{field}")
    return pairs.select(
        "*",
        *[name_level(of("a", f), of("b", f), F.col(f"jw_{f}")).alias(f) for f in ("first_name", "last_name")],
        dob_level(of("a", "dob"), of("b", "dob")).alias("dob"),
        exact_level(of("a", "ssn"), of("b", "ssn")).alias("ssn"),
        exact_level(of("a", "gender"), of("b", "gender"), "U").alias("gender"),
    )
