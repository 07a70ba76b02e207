"""Line windows: brute force, clashing columns, passages within lines, very long texts."""

import random
import re
import time

from kinfold.llm import line_windows

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def _brute(rows, width=3, min_words=30):
    seen, out = set(), {}
    for i, text in sorted(rows):
        lines = re.split(r"(?<=[.!?] )|(?<=\n)", text)
        bare = [x.strip(" \n") for x in lines]
        covered = [False] * len(lines)
        for k in range(len(lines) - width + 1):
            key = tuple(bare[k : k + width])
            if key in seen:
                covered[k : k + width] = [True] * width
            seen.add(key)
        kept, k = [], 0
        while k < len(lines):
            e = k
            while e < len(lines) and covered[e]:
                e += 1
            part = lines[k:e]
            whole = sum(x.endswith("\n") for x in part) + (e == len(lines)) - (k > 0 and not lines[k - 1].endswith("\n"))
            if part and sum(len(x.split()) for x in part) < min_words and whole < width:
                kept += part
            if e == k:
                kept.append(lines[k])
                e += 1
            k = e
        out[i] = "".join(kept)
    return out


def test_against_brute_force(spark):
    rng = random.Random(5)
    sentence = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, 9))) + rng.choice([".", "!", ""])
    passages = [[sentence() + rng.choice([" ", "\n"]) for _ in range(rng.randint(2, 8))] for _ in range(12)]
    rows = []
    for i in range(120):
        parts = []
        for _ in range(rng.randint(0, 6)):
            parts += rng.choice(passages) if rng.random() < 0.5 else [sentence() + rng.choice([" ", "\n"]) for _ in range(rng.randint(1, 4))]
        rows.append((i, "".join(parts)))
    got = {r.doc_id: r for r in line_windows.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = _brute(rows)
    assert {i: r.text for i, r in got.items()} == want and any(want[i] != t for i, t in rows)
    assert all((r.removed_lines > 0) == (r.text != dict(rows)[i]) for i, r in got.items())


def test_a_passage_within_lines_goes_and_short_phrases_stay(spark):
    rng = random.Random(6)
    fresh = lambda n: " ".join(rng.choice(WORDS) + str(rng.randint(0, 999)) for _ in range(n))
    passage = ". ".join(fresh(9).capitalize() for _ in range(6)) + "."
    rows = [(1, f"{fresh(8)} {passage} {fresh(8)}\n{fresh(9)}"), (2, f"{fresh(5)}. {passage} {fresh(4)}"), (3, f"Yes. No. Maybe. {fresh(9)}"), (4, f"{fresh(9)}. Yes. No. Maybe. {fresh(3)}")]
    got = {r.doc_id: r for r in line_windows.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and len(got[2].text.split()) <= 5 + 4 + 9 and got[3].text == rows[2][1] and got[4].text == rows[3][1]


def test_columns_of_any_name_stay(spark):
    text = "a b\nc d\ne f\ng h"
    df = spark.createDataFrame([(1, text, "p", "q", 5), (2, "x\n" + text, "r", "s", 6)], "doc_id long, text string, _k0 string, _own string, n_lines int")
    got = {r.doc_id: r for r in line_windows.dedup_lines(df).collect()}
    assert (got[2]["_k0"], got[2]["_own"], got[2].n_lines, got[2].removed_lines, got[2].text) == ("r", "s", 5, 4, "x\n")


def test_a_very_long_repeated_text_takes_linear_time(spark):
    text = "\n".join(f"line number {i}" for i in range(100_000))
    df = spark.createDataFrame([(1, text), (2, text + "\nend"), (3, "\n".join(f"line number {i}\nother {i}\nthird {i}" if i % 7 else f"line number {i}" for i in range(20_000)))], "doc_id long, text string")
    line_windows.dedup_lines(df.limit(1)).count()
    start = time.time()
    got = {r.doc_id: r for r in line_windows.dedup_lines(df).collect()}
    assert got[1].removed_lines == 0 and got[2].text == "end" and time.time() - start < 30
