"""URL filters: allow and block rules, and link-graph propagation for the other hosts.

A URL is judged by the longest rule that fits its host (or a parent domain) and path.
Hosts that rules do not reach are judged by two personalised PageRanks over the host
graph: trust starts at hosts of allowed pages and follows links; distrust starts at hosts
of blocked pages and follows links backwards (who links to bad hosts is suspect). A host
whose distrust outweighs its trust by the threshold is blocked.

Every host is joined to its parent domains at all levels, with or without pages of their
own, so that sibling subdomains connect; and a page weighs the same as a seed whether it is
allowed or blocked.

The ranks are summed until the mass still under way, a power of the damping, is at most
``TOLERANCE``. Mass at hosts without links goes back to the seeds: that only scales what the
other walks bring, so each kind's scores are scaled to its seeds' mass at the end.

DataFrame functions only. Edges are host pairs with counts, aggregated before the
shuffle; each step is one join and one aggregate over the edges, and the scores are
written to the shared folder every few steps to cut the lineage.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm.tables import table
from kinfold.session import materialize, release

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host and path, verdict)
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]
DAMPING = 0.85
#: Mass that may still be under way when the steps end, of 1.
TOLERANCE = 0.01
CUT_EVERY = 5
#: A share of trust and distrust so small is no difference: sums in another order may show it.
EVEN = 1e-9
#: Share of distrust in a host's trust and distrust above which it is blocked.
THRESHOLD = 0.5
LINK = r"(?i)href\s*=\s*[\x22']?(?:https?:)?//([^/?#\x22'\s>]+)"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (nulls if none fits). ``rules`` is a short list."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block")):
        domain, slash, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def steps_for(damping: float = DAMPING, tolerance: float = TOLERANCE) -> int:
    """Steps after which no more than ``tolerance`` of the mass is under way."""
    return max(1, math.ceil(math.log(tolerance) / math.log(damping)))


def host_edges(judged: DataFrame, html: DataFrame | None = None) -> DataFrame:
    """``(src, dst, n)``: links between different hosts, and between a host and its parent domains.

    ``judged`` and ``html`` have a ``host``; null texts and hosts that are null or empty have
    no links. A subdomain and its parent domain count as linking each other, up to the
    domain of two labels; addresses have no parents.
    """
    hosts = judged.select("host").where("host != ''").distinct()
    labels = F.split("host", r"\.")
    suffix = lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    levels = F.transform(F.sequence(F.lit(1), F.size(labels) - 2), lambda i: F.struct(suffix(i).alias("host"), suffix(i + 1).alias("parent")))
    named = hosts.where((F.size(labels) > 2) & ~F.col("host").rlike(r"^[0-9.]+(:[0-9]*)?$"))
    up = named.select(F.explode(levels).alias("u")).select("u.host", "u.parent").distinct()
    one = F.lit(1).cast("long").alias("n")
    edges = up.select(F.col("host").alias("src"), F.col("parent").alias("dst"), one)
    edges = edges.unionByName(up.select(F.col("parent").alias("src"), F.col("host").alias("dst"), one))
    if html is not None:
        target = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), 1)))
        links = html.select(F.col("host").alias("src"), target.alias("to")).select("src", F.translate("to", UPPER, LOWER).alias("dst"))
        edges = edges.unionByName(links.where("src != dst and src != ''").groupBy("src", "dst").agg(F.count("*").alias("n")))
    return edges.groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(judged: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``(host, trust, distrust)`` for hosts that either reaches.

    ``judged`` has ``host`` and the ``ruled`` verdict of each page. The two scores start in
    proportion to the pages that rules allow, or block, on a host, with mass 1 together; so
    a comparison of the two does not depend on how many pages of each kind there are
    elsewhere. Without seeds of a kind nobody has any of it.
    """
    says = F.when(F.col("ruled") == "allow", "trust").when(F.col("ruled") == "block", "distrust")
    pages = judged.where("ruled is not null and host != ''").groupBy("host", says.alias("kind")).agg(F.count("*").alias("n"))
    total = pages.agg(F.sum("n").alias("total"))  # one row
    seeds = materialize(pages.crossJoin(F.broadcast(total)).select("kind", "host", (F.col("n") / F.col("total")).alias("seed")), "seeds")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), F.col("n")))
    out = both.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    shares = materialize(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("n") / F.col("out")).alias("share")), "edges")
    start = seeds.select("kind", "host", (F.lit(1 - damping) * F.col("seed")).alias("part"))
    score, written = seeds.select("kind", "host", F.col("seed").alias("score")), None
    for step in range(1, steps_for(damping, tolerance) + 1):
        moved = score.withColumnRenamed("host", "src").join(shares, ["kind", "src"])
        moved = moved.select("kind", F.col("dst").alias("host"), (F.lit(damping) * F.col("score") * F.col("share")).alias("part"))
        score = moved.unionByName(start).groupBy("kind", "host").agg(F.sum("part").alias("score"))
        if step % CUT_EVERY == 0:
            score = materialize(score, "rank")
            if written is not None:
                release(written)
            written = score
    arrived = score.groupBy("kind").agg(F.sum("score").alias("arrived"))
    mass = seeds.groupBy("kind").agg(F.sum("seed").alias("mass")).join(arrived, "kind").select("kind", (F.col("mass") / F.col("arrived")).alias("scale"))
    scaled = score.join(F.broadcast(mass), "kind").withColumn("score", F.col("score") * F.col("scale"))  # mass: two rows
    one = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    return scaled.groupBy("host").agg(one("trust"), one("distrust"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str | None = "html", threshold: float = THRESHOLD, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """``(id_col, host, path, rule, verdict, trust, distrust)`` for every page.

    Pages that no rule fits take their host's verdict: ``block`` where distrust is more than
    ``threshold`` of trust and distrust together, else ``allow`` (also where both are even,
    where neither arrives, and for URLs that are null or without ``://``, whose host and path
    are empty). Repeated rows give repeated results and count as often as seeds. Other
    columns are not looked at. An empty table gives an empty table.
    """
    parts = pages.select(F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rule, verdict = judge(F.col("host"), F.col("path"), rules)
    judged = materialize(parts.withColumn("rule", rule).withColumn("ruled", verdict), "judged")
    html = pages.select(url_host(F.col(url_col)).alias("host"), F.col(html_col).alias("html")) if html_col else None
    edges = materialize(host_edges(judged, html), "hosts")
    hosts = materialize(propagate(judged, edges, damping, tolerance), "scores")
    # One host may have a third of all pages: its row is copied to as many parts as its pages are dealt to.
    salts = 16
    spread = judged.withColumn("_salt", F.pmod(F.xxhash64("id", "path"), F.lit(salts)))
    copied = hosts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<long>")))
    joined = spread.join(copied, ["host", "_salt"], "left")
    both = F.col("trust") + F.col("distrust")
    blocked = F.col("distrust") - threshold * both > EVEN * both
    final = F.coalesce("ruled", F.when(blocked, "block").otherwise("allow"))
    return joined.select(F.col("id").alias(id_col), "host", "path", "rule", final.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    def fits(rule: str) -> str:
        domain, slash, rest = rule.partition("/")
        return f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash}{rest}')"

    order = sorted(RULES, key=lambda r: (-len(r[0]), r[1] != "block"))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r}'" for r, _ in order) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{v}'" for r, v in order) + " END"

    def step(previous: str, name: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT kind, host, sum(part) AS score FROM (
    SELECT s.kind, dst AS host, {DAMPING}::DOUBLE * score * share AS part FROM {previous} s JOIN shares e ON s.kind = e.kind AND s.host = e.src
    UNION ALL SELECT kind, host, (1 - {DAMPING}::DOUBLE) * seed FROM seeds) GROUP BY kind, host)"""

    chain = reduce(lambda done, k: [*done, step(f"r{k - 1}", f"r{k}")], range(1, steps_for() + 1), [])
    link = LINK.replace("'", "''")
    return f"""
WITH parts AS (
  SELECT page_id, html, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
judged AS MATERIALIZED (SELECT *, {rule} AS rule, {verdict} AS ruled FROM parts),
hosts AS (SELECT DISTINCT host, string_split(host, '.') AS l FROM judged WHERE host != ''),
up AS (
  SELECT DISTINCT array_to_string(l[i:], '.') AS host, array_to_string(l[i + 1:], '.') AS parent
  FROM (SELECT l, unnest(range(1, len(l) - 1)) AS i FROM hosts WHERE len(l) > 2 AND NOT regexp_matches(host, '^[0-9.]+(:[0-9]*)?$'))),
links AS (
  SELECT host AS src, translate(t, '{UPPER}', '{LOWER}') AS dst FROM (SELECT host, unnest(list_distinct(regexp_extract_all(html, '{link}', 1))) AS t FROM judged)),
edges AS (
  SELECT src, dst, sum(n) AS n FROM (
    SELECT host AS src, parent AS dst, 1 AS n FROM up UNION ALL SELECT parent, host, 1 FROM up
    UNION ALL SELECT src, dst, count(*) FROM links WHERE src != dst AND src != '' GROUP BY src, dst) GROUP BY src, dst),
directed AS (SELECT 'trust' AS kind, src, dst, n FROM edges UNION ALL SELECT 'distrust', dst, src, n FROM edges),
shares AS MATERIALIZED (SELECT kind, src, dst, n::DOUBLE / sum(n) OVER (PARTITION BY kind, src) AS share FROM directed),
counted AS (
  SELECT CASE ruled WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM judged WHERE ruled IS NOT NULL AND host != '' GROUP BY ALL),
seeds AS MATERIALIZED (SELECT kind, host, n::DOUBLE / sum(n) OVER () AS seed FROM counted),
r0 AS (SELECT kind, host, seed AS score FROM seeds),
{", ".join(chain)},
scaled AS (
  SELECT host, kind, score * (SELECT sum(seed) FROM seeds s WHERE s.kind = r.kind) / sum(score) OVER (PARTITION BY kind) AS score FROM r{steps_for()} r),
scores AS (
  SELECT host, coalesce(sum(score) FILTER (WHERE kind = 'trust'), 0) AS trust, coalesce(sum(score) FILTER (WHERE kind = 'distrust'), 0) AS distrust
  FROM scaled GROUP BY host)
SELECT page_id, judged.host, path, rule,
  coalesce(ruled, CASE WHEN distrust - {THRESHOLD} * (trust + distrust) > {EVEN} * (trust + distrust) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN scores ON judged.host = scores.host
"""


OP3_SQL = _sql()
