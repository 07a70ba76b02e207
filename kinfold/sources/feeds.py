"""Vendor feeds derived from ``customer`` by integer arithmetic that every SQL engine shares.

One person a customer; two or three of the vendors hold a record of them, in formats of
their own; records after the first carry noise. ``FEED`` is one text for both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Canonical first names and their common nicknames. Where a nickname has
# several canonical names, the last one counts.
NICKNAMES = {
    "ROBERT": ["BOB", "BOBBY", "ROB", "ROBBIE"],
    "WILLIAM": ["BILL", "WILL", "BILLY", "LIAM"],
    "RICHARD": ["RICK", "DICK", "RICH", "RICKY"],
    "JAMES": ["JIM", "JIMMY", "JAMIE"],
    "MICHAEL": ["MIKE", "MIKEY", "MICK"],
    "JOSEPH": ["JOE", "JOEY"],
    "CHARLES": ["CHUCK", "CHARLIE", "CHAS"],
    "THOMAS": ["TOM", "TOMMY"],
    "CHRISTOPHER": ["CHRIS", "TOPHER"],
    "DANIEL": ["DAN", "DANNY"],
    "MATTHEW": ["MATT", "MATTY"],
    "ANTHONY": ["TONY", "ANT"],
    "EDWARD": ["ED", "EDDIE", "TED", "TEDDY"],
    "ANDREW": ["ANDY", "DREW"],
    "JOSHUA": ["JOSH"],
    "KENNETH": ["KEN", "KENNY"],
    "NICHOLAS": ["NICK", "NICKY"],
    "BENJAMIN": ["BEN", "BENNY", "BENJI"],
    "SAMUEL": ["SAM", "SAMMY"],
    "ALEXANDER": ["ALEX", "XANDER", "SASHA"],
    "PATRICK": ["PAT", "PADDY"],
    "ELIZABETH": ["BETH", "LIZ", "ELIZA", "BETTY", "LIZZIE"],
    "MARGARET": ["PEGGY", "MAGGIE", "MEG", "MARGIE"],
    "KATHERINE": ["KATE", "KATIE", "KATHY", "KAT"],
    "JENNIFER": ["JEN", "JENNY"],
    "PATRICIA": ["PAT", "PATTY", "TRISH"],
    "DEBORAH": ["DEBBIE", "DEB"],
    "BARBARA": ["BARB", "BABS"],
    "SUSAN": ["SUE", "SUSIE"],
    "DOROTHY": ["DOT", "DOTTIE", "DOLLY"],
    "REBECCA": ["BECKY", "BECCA"],
    "JESSICA": ["JESS", "JESSIE"],
    "VICTORIA": ["VICKY", "TORI"],
    "CYNTHIA": ["CINDY", "CYNDI"],
    "STEPHANIE": ["STEPH", "STEVIE"],
}
FIRST = list(NICKNAMES)
LAST = "SMITH JOHNSON BROWN GARCIA MILLER DAVIS LOPEZ WILSON ANDERSON TAYLOR MOORE JACKSON MARTIN THOMPSON WHITE HARRIS CLARK RAMIREZ LEWIS ROBINSON WALKER YOUNG ALLEN KING WRIGHT SCOTT TORRES NGUYEN HILL FLORES GREEN ADAMS NELSON BAKER HALL RIVERA CAMPBELL MITCHELL CARTER ROBERTS GOMEZ".split()

#: What differs between the engines.
SPARK = {"div": "div", "list": "array", "open": "(", "close": ")", "at": "element_at({}, {})", "iso": "date_format({}, 'yyyy-MM-dd')", "us": "date_format({}, 'MM/dd/yyyy')", "mon": "date_format({}, 'dd-MMM-yyyy')", "days": "date_add({}, cast({} as int))"}
DUCK = {"div": "//", "list": "", "open": "[", "close": "]", "at": "{}[{}]", "iso": "strftime({}, '%Y-%m-%d')", "us": "strftime({}, '%m/%d/%Y')", "mon": "strftime({}, '%d-%b-%Y')", "days": "({} + cast({} as int))"}


def feed_sql(e: dict[str, str], customer: str) -> str:
    """Rows ``(k, vendor, record_id, first_name, last_name, dob, gender, ssn, noise)``, all text but ``k``."""
    names = lambda xs: e["list"] + e["open"] + ", ".join(f"'{x}'" for x in xs) + e["close"]
    pick = lambda xs, i: e["at"].format(names(xs), f"cast({i} as int) + 1")
    dob = e["days"].format("born", "off")
    return f"""
  SELECT k, vendor, concat(lpad(cast(k as varchar(20)), 8, '0'), dup) AS record_id,
    concat(' ', lower(CASE WHEN noise = 'nickname' THEN nick ELSE first END)) AS first_name,
    CASE WHEN noise = 'typo_name' THEN concat(substr(last, 1, 1), substr(last, 3, 1), substr(last, 2, 1), substr(last, 4)) ELSE last END AS last_name,
    CASE WHEN k % 97 = 5 AND vendor = 'VENDOR_B' THEN '13/45/1980'
      WHEN vendor = 'VENDOR_A' THEN {e["iso"].format(dob)} WHEN vendor = 'VENDOR_B' THEN {e["us"].format(dob)} ELSE {e["mon"].format(dob)} END AS dob,
    CASE WHEN k % 101 = 3 THEN '' ELSE sex END AS gender,
    CASE WHEN vendor = 'VENDOR_C' THEN NULL WHEN noise = 'missing_ssn' THEN '' ELSE concat(substr(ssn, 1, 3), '-', substr(ssn, 4, 2), '-', substr(ssn, 6, 4)) END AS ssn, noise
  FROM (SELECT *, CASE WHEN noise = 'dob_error' THEN 1 ELSE 0 END AS off FROM (
    SELECT p.*, a.vendor, a.dup, CASE WHEN a.nth = 0 THEN 'exact' WHEN k % 20 < 5 THEN 'exact' WHEN k % 20 < 8 THEN 'nickname'
      WHEN k % 20 < 14 THEN 'typo_name' WHEN k % 20 < 18 THEN 'dob_error' ELSE 'missing_ssn' END AS noise
    FROM (SELECT k, {pick(FIRST, f"(k * 31 + k {e['div']} 7) % {len(FIRST)}")} AS first, {pick([n[0] for n in NICKNAMES.values()], f"(k * 31 + k {e['div']} 7) % {len(FIRST)}")} AS nick,
        {pick(LAST, f"(k * 7919 + k {e['div']} 97) % {len(LAST)}")} AS last, CASE WHEN (k * 104729 {e["div"]} 7) % 2 = 0 THEN 'm' ELSE 'F ' END AS sex,
        {e["days"].format("date '1950-01-01'", f"(k * 15485863 {e['div']} 11) % 9000")} AS born, cast(100000000 + k * 7654321 % 800000000 as varchar(20)) AS ssn
      FROM (SELECT cast(c_custkey as bigint) AS k FROM {customer}) c) p
    JOIN (SELECT 0 AS r, 'VENDOR_A' AS vendor, 0 AS nth, '' AS dup UNION ALL SELECT 0, 'VENDOR_B', 1, '' UNION ALL SELECT 1, 'VENDOR_B', 0, '' UNION ALL SELECT 1, 'VENDOR_C', 1, ''
      UNION ALL SELECT 2, 'VENDOR_A', 0, '' UNION ALL SELECT 2, 'VENDOR_C', 1, '' UNION ALL SELECT 12, 'VENDOR_C', 2, '' UNION ALL SELECT 50, 'VENDOR_A', 3, '-1') a
    ON (a.r < 3 AND p.k % 3 = a.r) OR (a.r = 12 AND p.k % 12 = 0) OR (a.r = 50 AND p.k % 150 = 50)) x) y"""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vendor_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vendors' records, as they deliver them."""
    return spark.sql(feed_sql(SPARK, "{customer}"), customer=read(spark, sf_dir, "customer").select("c_custkey"))
