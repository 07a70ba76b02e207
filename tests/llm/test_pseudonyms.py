"""Pseudonyms against a literal Feistel network in Python, formats, and hostile texts."""

import datetime
import hashlib
import hmac
import random
import time

import pytest
from pyspark.sql import functions as F

from kinfold.llm import pseudonyms

KEY = "a key for tests"


def _hash(*parts):
    return int(hmac.new(KEY.encode(), ":".join(map(str, parts)).encode(), hashlib.sha256).hexdigest()[:15], 16)


def _feistel(left, right, a, b, tweak):
    for i in range(pseudonyms.ROUNDS):
        if i % 2 == 0:
            left = (left + _hash(tweak, i, right) % a) % a
        else:
            right = (right + _hash(tweak, i, left) % b) % b
    return left, right


def _digits(text, tweak):
    half = len(text) // 2
    rest = len(text) - half
    left, right = _feistel(int(text[:half]), int(text[half:]), 10**half, 10**rest, f"{tweak}d{len(text)}")
    return f"{left:0{half}}{right:0{rest}}"


def _luhn(digits):
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(int(c) for c in reversed(digits))) % 10


def _card(digits):
    body = _digits(digits[:-1], "c")
    return body + str(-_luhn(body + "0") % 10)


def _ssn(text):
    area, group, number = map(int, text.split("-"))
    left, right = _feistel((area - (2 if area > 666 else 1)) * 99 + group - 1, number - 1, 898 * 99, 9999, "s")
    area = left // 99
    return f"{area + (2 if area >= 665 else 1):03}-{left % 99 + 1:02}-{right + 1:04}"


def _phone(digits):
    area, exchange, line = int(digits[:3]), int(digits[3:6]), int(digits[6:])
    if area >= 200 and exchange >= 200:
        left, line = _feistel((area - 200) * 800 + exchange - 200, line, 640_000, 10_000, "p")
        return f"{left // 800 + 200}{left % 800 + 200}{line:04}"
    left, line = _feistel(area % 100 * 100 + exchange % 100, line, 10_000, 10_000, f"q{area // 100}{exchange // 100}")
    return f"{area // 100}{left // 100:02}{exchange // 100}{left % 100:02}{line:04}"


def _date(day):
    left, right = _feistel(*divmod((day - datetime.date(1900, 1, 1)).days, 292), 250, 292, "t")
    return datetime.date(1900, 1, 1) + datetime.timedelta(left * 292 + right)


def _ipv4(text):
    a, b, c, d = map(int, text.split("."))
    left, right = _feistel(a * 256 + b, c * 256 + d, 65536, 65536, "i")
    return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"


def _mod97(text):
    return int("".join(str(int(c, 36)) for c in text)) % 97


def test_against_a_literal_feistel_network(spark):
    rng = random.Random(3)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    cases = []
    for _ in range(60):
        body = digits(rng.randint(12, 18))
        cases.append((body + str(-_luhn(body + "0") % 10),) * 2)
        cases[-1] = (cases[-1][0], _card(cases[-1][0]))
        ssn = f"{rng.choice([1, 665, 667, 899, rng.randint(1, 665)]):03}-{rng.randint(1, 99):02}-{rng.randint(1, 9999):04}"
        cases.append((ssn, _ssn(ssn)))
        phone = digits(10)
        new = _phone(phone)
        cases.append((f"({phone[:3]}) {phone[3:6]}-{phone[6:]}", f"({new[:3]}) {new[3:6]}-{new[6:]}"))
        day = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(73_000))
        cases.append((day.isoformat(), _date(day).isoformat()))
        ip = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        cases.append((ip, _ipv4(ip)))
    df = spark.createDataFrame([(i, f"x {old} y", f"x {new} y") for i, (old, new) in enumerate(cases)], "doc_id long, text string, want string")
    out = pseudonyms.pseudonymize(df, key=KEY)
    wrong = [(r.text, r.want) for r in out.collect() if r.text != r.want]
    assert not wrong[:5]


def test_formats_stay_valid(spark):
    ssns = spark.range(2000).select(F.format_string("%03d-%02d-%04d", F.col("id") % 665 + 1, F.col("id") % 99 + 1, F.col("id") * 37 % 9999 + 1).alias("text"))
    out = [r.text for r in pseudonyms.pseudonymize(ssns, key=KEY).collect()]
    assert len(set(out)) == ssns.distinct().count() and all(1 <= int(x[:3]) <= 899 and x[:3] != "666" and x[4:6] != "00" and x[7:] != "0000" for x in out)
    phones = spark.range(2000).select(F.format_string("%03d-%03d-%04d", F.col("id") % 800 + 200, F.col("id") * 7 % 800 + 200, F.col("id")).alias("text"))
    out = [r.text for r in pseudonyms.pseudonymize(phones, key=KEY).collect()]
    assert len(set(out)) == 2000 and all(x[0] > "1" and x[4] > "1" for x in out)
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR1420041010050500013M02606", "DE89 3704 0044 0532 0130 01"]
    got = [r.text for r in pseudonyms.pseudonymize(spark.createDataFrame([(f"to {x}.",) for x in ibans], "text string"), key=KEY).collect()]
    for old, new in zip(ibans[:3], got, strict=False):
        bare = new[3:-1].replace(" ", "")
        assert new != f"to {old}." and len(new) == len(old) + 4 and bare[:2] == old[:2] and _mod97(bare[4:] + bare[:4]) == 1
    assert "GB" in got[1] and "WEST" in got[1] and got[3] == f"to {ibans[3]}."


@pytest.mark.parametrize("kind", ["mail", "labels", "local", "hex", "groups", "cards", "dates", "addresses", "letters", "iban"])
def test_hostile_texts(spark, kind):
    n = 1 << 20 if kind == "mail" else 1 << 18
    text = {
        "mail": "a@" + "a." * (n // 2) + "1", "labels": "a@b." * (n // 4), "local": "a.b_c%" * (n // 6) + "@x", "hex": "0a" * (n // 2), "groups": "12 " * (n // 3), "cards": "4111 1111 1111 1111 " * (n // 200),
        "dates": "01/02/2003" * (n // 10), "addresses": "1.2.3." * (n // 6), "letters": "a" * n, "iban": "AB12 " * (n // 5),
    }[kind]
    df = spark.createDataFrame([(1, text + " 8.8.8.8")], "doc_id long, text string")
    start = time.time()
    got = pseudonyms.pseudonymize(df, key=KEY).first()
    assert got.n_replaced >= 1 and time.time() - start < 60


def test_keys_differ_by_session_or_are_set(spark):
    df = spark.createDataFrame([(1, "8.8.8.8", "x", "y")], "doc_id long, text string, _found string, _new string")
    first = pseudonyms.pseudonymize(df).first()
    assert first.text == pseudonyms.pseudonymize(df).first().text and (first["_found"], first["_new"]) == ("x", "y")
    assert pseudonyms.pseudonymize(df, key="k1").first().text != pseudonyms.pseudonymize(df, key="k2").first().text
