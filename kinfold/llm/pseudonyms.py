"""Pseudonyms for personal data that keep its format, by keyed Feistel permutations.

Found and validated: payment card numbers (Luhn), bank account numbers (IBAN, modulo 97),
telephone numbers, social security numbers, IPv4 addresses, e-mail addresses, calendar dates
and long hexadecimal secrets. A value is split in two halves, each a number below a given
bound; in alternate rounds a keyed hash (HMAC of SHA-256) of one half is added to the other
modulo its bound. That is a permutation of all values of the format, so equal values get
equal pseudonyms everywhere, different ones different ones, and separators stay. Cards and
accounts keep valid check digits, dates stay dates, addresses stay addresses, social security
numbers are permuted among those that can be issued, and telephone numbers of the North
American plan (area and exchange from 200) among themselves; others keep the first digits of
both.

A card number is any 13 to 19 digits with a valid check digit that start and end at a
border of a digit group, whatever other groups stand before or after; in a run of groups the
first one is taken, of those that start there the longest, and so on behind it. Dates with
slashes are read day first, and month first where they are no date otherwise.

DataFrame functions only; no shuffle and no join: a value's pseudonym depends on nothing
but the key and the value. Patterns repeat without recursion or within small bounds, so that
hostile texts need neither stack nor more than linear time.

The key is ``spark.kinfold.pseudonym.key``; where that is unset a random one holds for the
session, and pseudonyms of different sessions do not match.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.tables import free, table

ROUNDS = 8
KEY = "spark.kinfold.pseudonym.key"
#: Days from 1900-01-01 whose dates are permuted: 250 * 292, up to 2099-11-13.
DAYS = (250, 292)

EMAIL = r"(?<![A-Za-z0-9])[A-Za-z0-9][A-Za-z0-9._%+-]{0,255}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,63}+"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"
IPV4 = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"
PHONE = r"(?:(?<![0-9])\+[1-9][0-9]{0,2}[ .-]?)?(?<![0-9(])(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
ISO_DATE = r"(?<![0-9-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])"
SECRET = r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]{0,63}[0-9])(?=[0-9A-Fa-f]{0,63}[A-Fa-f])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])"
#: Fixed order: the first kind that fits at a place is taken.
KINDS = {"email": EMAIL, "secret": SECRET, "iban": IBAN, "date": ISO_DATE, "day_first": r"(?<![0-9./])(?:[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/])", "ipv4": IPV4, "ssn": SSN, "phone": PHONE}
#: A whole run of digit groups with single blanks or hyphens between; it ends before a value of another kind. Possessive, so that long runs need no stack.
KINDS["card"] = r"(?<![0-9])[0-9](?:[0-9]|[ -](?!" + "|".join(KINDS.values()) + r")[0-9]){12,}+"
#: Digits of a card number.
CARD_DIGITS = (13, 19)
ANY = "|".join(KINDS.values())


#: Every kind but e-mail addresses has a digit, and these have an at sign: other texts are not searched.
ANY_SIGN = "[0-9@]"


def session_key(spark: SparkSession) -> str:
    """The key that the cluster sets, or a random one for this session."""
    key = spark.conf.get(KEY, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY, key)
    return key


def _hash(key: str, *cols: Column) -> Column:
    """A number below 2 ** 60 from the HMAC (RFC 2104, SHA-256) of the columns."""
    data = key.encode()
    data = hashlib.sha256(data).digest() if len(data) > 64 else data
    inner, outer = (bytes(b ^ pad for b in data.ljust(64, b"\0")) for pad in (0x36, 0x5C))
    text = F.encode(F.concat_ws(":", *[c.cast("string") for c in cols]), "UTF-8")
    first = F.unhex(F.sha2(F.concat(F.lit(inner), text), 256))
    return F.conv(F.substring(F.sha2(F.concat(F.lit(outer), first), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tweak: Column, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of the pairs ``left`` in [0, a), ``right`` in [0, b): a struct ``(l, r)``.

    Another ``tweak`` gives another permutation.
    """
    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    def turn(pair: Column, i: Column) -> Column:
        even = F.struct(F.pmod(pair["l"] + F.pmod(_hash(key, tweak, i, pair["r"]), a), a).cast("long").alias("l"), pair["r"].alias("r"))
        odd = F.struct(pair["l"].alias("l"), F.pmod(pair["r"] + F.pmod(_hash(key, tweak, i, pair["l"]), b), b).cast("long").alias("r"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), start, turn)


def _power(base: int, n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(base**k) for k in range(16 if base <= 16 else 11)]), (n + 1).cast("int"))


def _digits(value: Column, key: str, tweak: str) -> Column:
    """A string of at most 30 decimal digits, permuted among those of its length."""
    half = F.floor(F.length(value) / 2).cast("int")
    rest = F.length(value) - half
    pair = feistel(F.substring(value, F.lit(1), half).cast("long"), F.substring(value, half + 1, rest).cast("long"), _power(10, half), _power(10, rest), key, F.concat(F.lit(tweak + "d"), F.length(value).cast("string")))
    return F.concat(F.lpad(pair["l"].cast("string"), half, "0"), F.lpad(pair["r"].cast("string"), rest, "0"))


def _refill(shape: Column, digits: Column, which: str) -> Column:
    """``shape`` with its characters of the class ``which`` replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def step(done: Column, ch: Column) -> Column:
        hit = ch.rlike(which)
        return F.struct(F.concat(done["out"], F.when(hit, F.substring(digits, done["at"], F.lit(1))).otherwise(ch)).alias("out"), (done["at"] + hit.cast("int")).alias("at"))

    return F.aggregate(F.split(shape, ""), start, step, lambda done: done["out"])


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum of a digit string; ``doubled`` is the parity, from the right, of the doubled digits."""
    return F.aggregate(
        F.split(F.reverse(digits), ""),
        F.struct(F.lit(0).alias("s"), F.lit(0).alias("i")),
        lambda acc, ch: F.struct((acc["s"] + F.when(acc["i"] % 2 == doubled, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), ch.cast("int") + 1)).otherwise(ch.cast("int"))).alias("s"), (acc["i"] + 1).alias("i")),
        lambda acc: acc["s"],
    )


def _with_groups(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of the value's digit groups, which are split once only."""
    return F.element_at(F.transform(F.array(F.split(value, "[ -]")), f), 1)


def _bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is evaluated once only."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _card_windows(value: Column) -> Column:
    """The card numbers of a run of digit groups: an array of ``(at, n)``, first group (from 0) and number of groups, in order."""
    least, most = CARD_DIGITS

    def longest(groups: Column, at: Column) -> Column:
        """Groups of the longest card number that starts at a group; 0 if none does."""
        spans = F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(groups) - at)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(groups, at + 1, n), "").alias("digits")))
        sized = F.filter(spans, lambda w: F.length(w["digits"]).between(least, most))
        return F.coalesce(F.array_max(F.transform(F.filter(sized, lambda w: F.pmod(_luhn_sum(w["digits"], 1), F.lit(10)) == 0), lambda w: w["n"])), F.lit(0))

    def windows(groups: Column) -> Column:
        every = F.transform(groups, lambda _, at: F.struct(at.alias("at"), longest(groups, at).alias("n")))
        start = F.struct(F.array().cast("array<struct<at:int,n:int>>").alias("taken"), F.lit(0).alias("free"))

        def take(done: Column, w: Column) -> Column:
            fits = w["at"] >= done["free"]
            return F.struct(F.when(fits, F.concat(done["taken"], F.array(w))).otherwise(done["taken"]).alias("taken"), F.when(fits, w["at"] + w["n"]).otherwise(done["free"]).alias("free"))

        return F.aggregate(F.filter(every, lambda w: w["n"] > 0), start, take, lambda done: done["taken"])

    run = (F.length(value) >= least) & value.rlike(r"^[0-9]+(?:[ -][0-9]+)*+$")
    return F.when(run, _with_groups(value, windows)).otherwise(F.array().cast("array<struct<at:int,n:int>>"))


def _cards(value: Column, windows: Column, key: str) -> Column:
    """A run of digit groups with the cards at ``windows`` replaced."""

    def card(shape: Column) -> Column:
        digits = F.regexp_replace(shape, "[^0-9]", "")
        body = _digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "c")
        return _bind(body, lambda b: _refill(shape, F.concat(b, F.pmod(10 - F.pmod(_luhn_sum(b, 0), F.lit(10)), F.lit(10)).cast("string")), "[0-9]"))

    def weave(groups: Column) -> Column:
        """``groups`` have their separators behind them."""
        part = lambda at, n: F.array_join(F.slice(groups, at + 1, n), "")
        end = lambda k: F.when(k > 0, F.get(windows, k - 1)["at"] + F.get(windows, k - 1)["n"]).otherwise(0)
        pieces = F.transform(windows, lambda w, k: F.concat(part(end(k), w["at"] - end(k)), card(part(w["at"], w["n"]))))
        last = end(F.size(windows))
        return F.concat(F.array_join(pieces, ""), part(last, F.size(groups) - last))

    return F.when(F.size(windows) > 0, _bind(F.split(value, "(?<=[ -])"), weave)).otherwise(value)


def _check97(text: Column) -> Column:
    """The number that letters (A is 10) and digits make, modulo 97."""
    code = lambda ch: F.when(ch.between("0", "9"), F.ascii(ch) - 48).otherwise(F.ascii(ch) - 55)
    return F.aggregate(F.split(text, ""), F.lit(0), lambda n, ch: F.when(ch == "", n).otherwise(F.pmod(n * F.when(ch.between("0", "9"), 10).otherwise(100) + code(ch), F.lit(97))).cast("int"))


def _iban(value: Column, key: str) -> Column:
    """Country and letters stay, digits are permuted among those of their number, check digits are made anew."""

    def fresh(bare: Column) -> Column:
        country, rest = F.substring(bare, 1, 2), F.substring(bare, F.lit(5), F.length(bare))
        digits = F.regexp_replace(rest, "[^0-9]", "")
        check = lambda body: F.lpad((98 - _check97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
        body = F.when(F.length(digits) > 1, _refill(rest, _digits(digits, key, "b"), "[0-9]")).otherwise(rest)
        new = _bind(body, lambda b: _refill(value, F.concat(country, check(b), b), "[0-9A-Z]"))
        return F.when(_check97(F.concat(rest, F.substring(bare, 1, 4))) == 1, new).otherwise(value)

    return _bind(F.replace(value, F.lit(" "), F.lit("")), fresh)


EPOCH = "1900-01-01"


def _day(days: Column, key: str, tweak: str) -> Column:
    """A day of the permuted range, permuted."""
    a, b = DAYS
    pair = feistel(F.floor(days / b), F.pmod(days, F.lit(b)), F.lit(a), F.lit(b), key, F.lit(tweak))
    return (pair["l"] * b + pair["r"]).cast("int")


def _date(value: Column, key: str, pattern: str) -> Column:
    days = F.datediff(F.try_to_date(value, pattern), F.lit(EPOCH).cast("date"))
    there = F.date_add(F.lit(EPOCH).cast("date"), _day(days, key, "t"))
    return F.when((days >= 0) & (days < DAYS[0] * DAYS[1]), F.date_format(there, pattern)).otherwise(value)


def _month_first(value: Column, key: str) -> Column:
    """A date that is none day first. Its pseudonym is none either: the permutation is repeated until the day is above 12, so that it is nobody else's."""
    date = lambda days: F.date_add(F.lit(EPOCH).cast("date"), days)
    days = F.datediff(F.try_to_date(value, "MM/dd/yyyy"), F.lit(EPOCH).cast("date"))
    walk = F.aggregate(F.sequence(F.lit(1), F.lit(64)), _day(days, key, "u"), lambda d, _: F.when(F.dayofmonth(date(d)) <= 12, _day(d, key, "u")).otherwise(d))
    return F.when((days >= 0) & (days < DAYS[0] * DAYS[1]), F.date_format(date(walk), "MM/dd/yyyy")).otherwise(value)


def _ipv4(value: Column, key: str) -> Column:
    part = lambda k: F.element_at(F.split(value, r"\."), k).cast("long")
    pair = feistel(part(1) * 256 + part(2), part(3) * 256 + part(4), F.lit(65536), F.lit(65536), key, F.lit("i"))
    of = lambda half: [F.floor(pair[half] / 256).cast("string"), F.pmod(pair[half], F.lit(256)).cast("string")]
    return F.concat_ws(".", *of("l"), *of("r"))


def _ssn(value: Column, key: str) -> Column:
    """Area, group and number permuted among those that can be issued: 898 areas, 99 groups, 9999 numbers."""
    part = lambda a, n: F.substring(value, a, n).cast("long")
    area = part(1, 3) - F.when(part(1, 3) > 666, 2).otherwise(1)
    pair = feistel(area * 99 + part(5, 2) - 1, part(8, 4) - 1, F.lit(898 * 99), F.lit(9999), key, F.lit("s"))
    there = F.floor(pair["l"] / 99)
    pad = lambda n, width: F.lpad(n.cast("string"), width, "0")
    return F.concat_ws("-", pad(there + F.when(there >= 665, 2).otherwise(1), 3), pad(F.pmod(pair["l"], F.lit(99)) + 1, 2), pad(pair["r"] + 1, 4))


def _phone(value: Column, key: str) -> Column:
    """The last ten digits: area and exchange from 200 stay so, others keep their first digits. A country code stays."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    ahead = F.length(digits) - 10
    of = lambda a, n: F.substring(digits, ahead + a, F.lit(n)).cast("long")
    pad = lambda n, width: F.lpad(n.cast("string"), width, "0")
    area, exchange, line = of(1, 3), of(4, 3), of(7, 4)
    plan = feistel((area - 200) * 800 + exchange - 200, line, F.lit(640_000), F.lit(10_000), key, F.lit("p"))
    other = feistel(F.pmod(area, F.lit(100)) * 100 + F.pmod(exchange, F.lit(100)), line, F.lit(10_000), F.lit(10_000), key, F.concat(F.lit("q"), F.floor(area / 100).cast("string"), F.floor(exchange / 100).cast("string")))
    first = F.when((area >= 200) & (exchange >= 200), F.concat(pad(F.floor(plan["l"] / 800) + 200, 3), pad(F.pmod(plan["l"], F.lit(800)) + 200, 3), pad(plan["r"], 4)))
    second = F.concat(F.floor(area / 100).cast("string"), pad(F.floor(other["l"] / 100), 2), F.floor(exchange / 100).cast("string"), pad(F.pmod(other["l"], F.lit(100)), 2), pad(other["r"], 4))
    return _refill(value, F.concat(F.substring(digits, F.lit(1), ahead), F.coalesce(first, second)), "[0-9]")


def _hex(value: Column, key: str) -> Column:
    """Blocks of 16 hexadecimal digits from the left, each permuted with what stands before it as part of the key."""
    low = F.lower(value)

    def block(done: Column, at: Column) -> Column:
        text = F.substring(low, at, F.lit(16))
        half = F.floor(F.length(text) / 2).cast("int")
        rest = F.length(text) - half
        number = lambda t: F.coalesce(F.conv(t, 16, 10).cast("long"), F.lit(0))
        pair = feistel(number(F.substring(text, F.lit(1), half)), number(F.substring(text, half + 1, rest)), _power(16, half), _power(16, rest), key, F.concat(F.lit("x"), F.length(low).cast("string"), F.lit(":"), F.substring(low, F.lit(1), at - 1)))
        show = lambda n, width: F.lpad(F.lower(F.hex(n)), width, "0")
        return F.concat(done, F.when(half > 0, show(pair["l"], half)).otherwise(""), show(pair["r"], rest))

    fresh = F.aggregate(F.sequence(F.lit(1), F.length(low), F.lit(16)), F.lit(""), block)
    return F.when(value.rlike("[A-F]"), F.upper(fresh)).otherwise(fresh)


def _email(value: Column, key: str) -> Column:
    """The local part as a name of its own length in letters and digits; the domain stays.

    Letters and digits are permuted in blocks of eight base-36 digits, like secrets; the
    characters between them stay. Upper and lower case make no difference.
    """
    local = F.lower(F.substring_index(value, "@", 1))
    plain = F.regexp_replace(local, "[^0-9a-z]", "")

    def block(done: Column, at: Column) -> Column:
        text = F.substring(plain, at, F.lit(8))
        half = F.floor(F.length(text) / 2).cast("int")
        rest = F.length(text) - half
        number = lambda t: F.coalesce(F.conv(t, 36, 10).cast("long"), F.lit(0))
        pair = feistel(number(F.substring(text, F.lit(1), half)), number(F.substring(text, half + 1, rest)), _power(36, half), _power(36, rest), key, F.concat(F.lit("e"), F.length(plain).cast("string"), F.lit(":"), F.substring(plain, F.lit(1), at - 1)))
        show = lambda n, width: F.lpad(F.lower(F.conv(n.cast("string"), 10, 36)), width, "0")
        return F.concat(done, F.when(half > 0, show(pair["l"], half)).otherwise(""), show(pair["r"], rest))

    fresh = F.aggregate(F.sequence(F.lit(1), F.length(plain), F.lit(8)), F.lit(""), block)
    return F.concat(_refill(local, fresh, "[0-9a-z]"), F.lit("@"), F.substring_index(value, "@", -1))


def pseudonym(value: Column, key: str, windows: Column | None = None) -> Column:
    """The pseudonym of one value that ``ANY`` matched; a value that fails its validation stays.

    ``windows``: the value's ``_card_windows``, where they are known.
    """
    k = key
    us = F.try_to_date(value, "dd/MM/yyyy").isNull()
    whole = lambda kind: value.rlike(f"^(?:{KINDS[kind]})$")
    return (
        F.when(whole("email"), _email(value, k))
        .when(whole("secret"), _hex(value, k))
        .when(whole("iban"), _iban(value, k))
        .when(whole("date"), _date(value, k, "yyyy-MM-dd"))
        .when(whole("day_first") & value.contains("/"), F.when(us, _month_first(value, k)).otherwise(_date(value, k, "dd/MM/yyyy")))
        .when(whole("day_first"), _date(value, k, "dd.MM.yyyy"))
        .when(whole("ipv4"), _ipv4(value, k))
        .when(whole("ssn"), _ssn(value, k))
        .when(whole("phone"), _phone(value, k))
        .otherwise(_cards(value, _card_windows(value) if windows is None else windows, k))
    )


def pseudonymize(docs: DataFrame, text_col: str = "text", key: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced; adds ``n_replaced``.

    ``key`` is the session's (``session_key``) unless given. ``n_replaced`` counts the values
    that changed. Null texts stay null and count 0; texts without personal data stay as they
    are, empty ones too. Repeated rows give repeated rows. A column named ``n_replaced`` is
    replaced, columns of other names stay.
    """
    key = key or session_key(docs.sparkSession)
    found_, new_ = free("found", docs.columns), free("new", docs.columns)
    text = F.col(text_col)
    found = F.when(text.rlike(ANY_SIGN) & text.rlike(ANY), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    split = docs.drop("n_replaced").withColumn(found_, found)
    cut = F.transform(found_, lambda v: F.struct(v.alias("old"), _card_windows(v).alias("cards")))
    changed = F.transform(cut, lambda v: F.struct(v["old"].alias("old"), F.size(v["cards"]).alias("cards"), pseudonym(v["old"], key, v["cards"]).alias("new")))
    split = split.withColumn(new_, F.when(F.col(found_).isNotNull(), changed))
    woven = F.array_join(F.flatten(F.zip_with(F.split(text, ANY, -1), new_, lambda a, b: F.array(a, F.coalesce(b["new"], F.lit(""))))), "")
    replaced = F.aggregate(new_, F.lit(0), lambda n, v: n + F.greatest(v["cards"], (v["old"] != v["new"]).cast("int")))
    return split.select(
        *[F.when(F.col(new_).isNull(), text).otherwise(woven).alias(c) if c == text_col else F.col(c) for c in docs.columns if c != "n_replaced"],
        F.coalesce(replaced, F.lit(0)).alias("n_replaced"),
    )


def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))
