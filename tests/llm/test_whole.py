"""Cases that the operators once left out."""

import random
from collections import Counter

import corpus_pipeline
from kinfold.llm import mixing, pseudonyms, url_filter


def test_url_seeds_of_both_kinds_weigh_the_same_and_siblings_connect(spark):
    rules = [("org/ok", "allow"), ("org/bad", "block"), ("com/bad", "block")]
    urls = ["x://a.x.org/ok"] * 14 + ["x://a.x.org/bad"] * 7 + ["x://other.net.org/ok"] * 60 + ["x://a.x.org/new", "x://new.p.com/", "x://deep.er.new.p.com/", "x://q.com/", "x://1.2.3.4/"] + ["x://spam.p.com/bad"] * 3
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], "page_id long, url string, html string")
    got = {r.host + r.path: r.verdict for r in url_filter.filter_urls(pages, rules).where("rule is null").collect()}
    assert got == {"a.x.org/new": "allow", "new.p.com/": "block", "deep.er.new.p.com/": "block", "q.com/": "allow", "1.2.3.4/": "allow"}


def test_propagation_is_a_power_iteration(spark):
    """Cycles, hosts without links, a hub, seeds of both kinds: against plain iteration with dangling mass returned."""
    rng = random.Random(9)
    hosts = [f"h{i}" for i in range(30)]
    links = {(a, b): rng.randint(1, 4) for a in hosts[:24] for b in rng.sample(hosts, 3) if a != b}
    links |= {(a, "h0"): 5 for a in hosts[1:20]}
    pages = [(rng.choice(hosts), rng.choice(["allow", "allow", "block", None])) for _ in range(60)]
    edges = spark.createDataFrame([(a, b, n) for (a, b), n in links.items()], "src string, dst string, n long")
    got = {r.host: r for r in url_filter.propagate(spark.createDataFrame(pages, "host string, ruled string"), edges, tolerance=1e-4).collect()}
    total = sum(v is not None for _, v in pages)
    for kind, says, turn in (("trust", "allow", False), ("distrust", "block", True)):
        seed = {h: sum(p == (h, says) for p in pages) / total for h in hosts}
        mass = sum(seed.values())
        out = {h: {} for h in hosts}
        for (a, b), n in links.items():
            a, b = (b, a) if turn else (a, b)
            out[a][b] = n
        score = dict(seed)
        for _ in range(200):
            new = {h: 0.15 * seed[h] for h in hosts}
            for h in hosts:
                for to, n in out[h].items():
                    new[to] += 0.85 * score[h] * n / sum(out[h].values())
                if not out[h]:
                    for to in hosts:
                        new[to] += 0.85 * score[h] * seed[to] / mass
            score = new
        assert all(abs(score[h] - (got[h][kind] if h in got else 0)) < 2e-3 for h in hosts)


def _luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if i % 2 == 0 else (2 * d - 9 * (d > 4)) for i, d in enumerate(digits)) % 10 == 0


def test_cards_beside_other_digits_and_dates_month_first(spark):
    card, spaced, other = "4111111111111111", "4111 1111 1111 1111", "5500-0000-0000-0004"
    texts = [card, f"{card} 12/27", f"{spaced} 123", f"7 {card}", f"{spaced} {other}", f"{card} 536-22-1234", f"{card} 12/25/1990", f"{card} 8.8.8.8", "12/25/1990", "25/12/1990", "31/31/1990", "4111111111111112 12/27", "1" * 25, "12 " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pseudonyms.pseudonymize(df).collect()}
    new = [got[i].text for i in range(len(texts))]
    assert all(len(a) == len(b) for a, b in zip(texts[:7], new, strict=False))
    alone = new[0]
    assert alone != card and _luhn(alone) and new[1] == f"{alone} 12/27" and new[3] == f"7 {alone}"
    assert new[2].replace(" ", "") == alone + "123" and new[4][:19].replace(" ", "") == alone and new[4][20:] != other and _luhn(new[4][20:])
    assert [new[i][:17] == alone + " " for i in (5, 6, 7)] == [True] * 3 and all(new[i][17:] != texts[i][17:] for i in (5, 6, 7))
    assert new[6][17:] == new[8] != texts[8] and int(new[8][:2]) <= 12 < int(new[8][3:5]) and new[9] != texts[9]
    assert new[10:13] == texts[10:13]
    assert [got[i].n_replaced for i in range(13)] == [1, 1, 1, 1, 2, 2, 2, 2, 1, 1, 0, 0, 0]


def test_month_first_pseudonyms_differ_from_each_other_and_from_day_first_ones(spark):
    df = spark.sql("select date_format(date_add(date '1980-01-01', cast(id as int)), p) as text from range(1500), values ('MM/dd/yyyy'), ('dd/MM/yyyy') t(p)").distinct()
    out = pseudonyms.pseudonymize(df)
    assert out.select("text").distinct().count() == df.count() and out.where("n_replaced = 0").count() == 0


def test_mix_sources_keeps_rows_with_null_and_repeated_ids(spark):
    rows = [(None if i % 5 == 0 else i // 4, f"w{i // 2 if i % 8 < 2 else i} " * (1 + i % 7), "en", f"s{i % 3}", 0) for i in range(240)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda r: (r.doc_id, r.size, r.source_size)
    want = Counter()
    for r in mixing.mix(docs).collect():
        want[key(r)] += r.copies
    total = {s: sum(len(r[1].split()) for r in rows if r[3] == s) for s in ("s0", "s1", "s2")}
    out = corpus_pipeline.mix_sources(spark, docs, "").collect()
    got = Counter((r.doc_id, len(r.text.split()), total[r.source]) for r in out)
    assert got == +want and any(r.doc_id is None for r in out)
    most = Counter(rows)
    assert all(n <= 2 * most[tuple(r)] for r, n in Counter(out).items())
