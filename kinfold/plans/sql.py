"""DuckDB SQL for the queries: an independent statement of each, in common table expressions."""

from __future__ import annotations

from kinfold.functions.clean import PHONETIC_CODES
from kinfold.functions.compare import CANONICAL
from kinfold.operators.identity import ELSEWHERE, RULES, TRUST, UNKNOWN
from kinfold.operators.matching import FIELDS, LOWER, MAX_BLOCK, MAX_CLUSTER, MIN_DENSITY, NAIVE_FIELD, NAIVE_LEVEL, UPPER, WEIGHTS
from kinfold.plans.queries import NON_MATCHES
from kinfold.sources.domains import ENCOUNTERS, MATCHED, PLANS, STATUSES
from kinfold.sources.feeds import DUCK, FIRST, LAST, feed_sql


def _phonetic(column: str) -> str:
    letters = f"regexp_replace(upper({column}), '[^A-Z]', '', 'g')"
    coded = f"translate({letters}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '{PHONETIC_CODES}')"
    for _ in range(3):
        for d in "0123456":
            coded = f"replace({coded}, '{d}{d}', '{d}')"
    tail = f"replace(substr({coded}, 2), '0', '')"
    return f"CASE WHEN {letters} != '' THEN substr({letters}, 1, 1) || rpad(substr({tail}, 1, 3), 3, '0') END"


def _weights(name: str, table: dict[str, dict[str, float]]) -> str:
    rows = ", ".join(f"('{f}', '{lv}', {w}::DOUBLE)" for f, levels in table.items() for lv, w in levels.items())
    return f"{name}(field, level, w) AS (VALUES {rows})"


def _name_level(f: str) -> str:
    a, b = f"a.{f}", f"b.{f}"
    return f"""CASE WHEN {a} IS NULL OR {b} IS NULL OR {a} = '' OR {b} = '' THEN 'missing' WHEN {a} = {b} THEN 'exact'
      WHEN (SELECT c FROM nick WHERE v = {a}) = (SELECT c FROM nick WHERE v = {b}) THEN 'nickname'
      WHEN jaro_winkler_similarity({a}, {b}) >= 0.9 THEN 'near' WHEN jaro_winkler_similarity({a}, {b}) >= 0.8 THEN 'similar' ELSE 'different' END AS {f}"""


def _exact_level(f: str, unknown: str = "") -> str:
    also = f" OR a.{f} = '{unknown}' OR b.{f} = '{unknown}'" if unknown else ""
    return f"CASE WHEN a.{f} IS NULL OR b.{f} IS NULL OR a.{f} = '' OR b.{f} = ''{also} THEN 'missing' WHEN a.{f} = b.{f} THEN 'exact' ELSE 'different' END AS {f}"


_DOB = """CASE WHEN a.dob IS NULL OR b.dob IS NULL THEN 'missing' WHEN a.dob = b.dob THEN 'exact'
      WHEN year(a.dob) = year(b.dob) AND month(a.dob) = day(b.dob) AND day(a.dob) = month(b.dob) THEN 'transposed'
      WHEN (year(a.dob) = year(b.dob))::INT + (month(a.dob) = month(b.dob))::INT + (day(a.dob) = day(b.dob))::INT = 2 THEN 'one_component_off'
      WHEN year(a.dob) = year(b.dob) THEN 'year_only' ELSE 'different' END AS dob"""
_LEVELS = ", ".join([_name_level("first_name"), _name_level("last_name"), _DOB, _exact_level("ssn"), _exact_level("gender", "U")])


def _sum(table: str, factor: dict[str, float] | None = None) -> str:
    """Weights added in the fields' order."""
    one = lambda f: f"coalesce((SELECT w FROM {table} WHERE field = '{f}' AND level = l.{f}), 0)"
    return " + ".join(["0::DOUBLE", *[f"{factor[f]}::DOUBLE * {one(f)}" if factor else one(f) for f in FIELDS]])


def _survive() -> str:
    """The rules in turn, as one step of windows each."""
    keys = {
        "vendor_trust": ("CASE WHEN trust > 0 THEN -trust END", "max({k}) OVER g IS NULL OR {k} = max({k}) OVER g"),
        "plurality": ("count(*) OVER (PARTITION BY pgid, field_name, value)", "{k} = max({k}) OVER g"),
        "completeness": ("complete", "{k} = max({k}) OVER g"),
        "recency": ("normalized_at", "{k} = max({k}) OVER g"),
        "deterministic": ("record_key", "{k} = min({k}) OVER g"),
    }
    out, before = [], "valued"
    for i, rule in enumerate(RULES):
        key, keep = keys[rule]
        out.append(f"""s{i} AS (SELECT * EXCLUDE (k, keep, rule), CASE WHEN bool_or(NOT keep) OVER (PARTITION BY pgid, field_name) THEN '{rule}' ELSE rule END AS rule, keep AS kept FROM (
    SELECT *, min(value) OVER g = max(value) OVER g OR coalesce({keep.format(k="k")}, false) AS keep FROM (SELECT * , {key} AS k FROM {before}) WINDOW g AS (PARTITION BY pgid, field_name)) QUALIFY keep)""")
        out.append(f"t{i} AS (SELECT * EXCLUDE (kept) FROM s{i} WHERE kept)")
        before = f"t{i}"
    return ",\n".join(out), before


_CHAIN, _LAST = _survive()
_TRUST = "CASE field_name " + " ".join(f"WHEN '{f}' THEN coalesce(list_position({vs!r}, source_vendor), 0)" for f, vs in TRUST.items()) + " END"
_EARLIER = "NOT (source_vendor = 'VENDOR_C' AND substr(source_record_id, 1, 8)::INT % 3 = 1)"


def _scored(records: str, p: str, pairs: str, other: str | None = None) -> str:
    """Levels and scores of the distinct pairs in ``pairs``."""
    return f"""{p}levels AS MATERIALIZED (
  SELECT p.record_key_a, p.record_key_b, {_LEVELS}
  FROM (SELECT DISTINCT record_key_a, record_key_b FROM {pairs}) p JOIN {records} a ON a.record_key = p.record_key_a JOIN {other or records} b ON b.record_key = p.record_key_b),
{p}scored AS MATERIALIZED (SELECT l.*, {_sum("fs")} AS score, {_sum("nv", NAIVE_FIELD)} AS naive_score FROM {p}levels l)"""


def _members(records: str, p: str) -> str:
    """Components of the automatic matches among ``records``, and the membership that follows."""
    inside = f"SELECT s.* FROM scored s WHERE score >= {UPPER} AND s.record_key_a IN (SELECT record_key FROM {records}) AND s.record_key_b IN (SELECT record_key FROM {records})"
    return f"""{p}matches AS MATERIALIZED ({inside}),
{p}edges AS (SELECT record_key_a AS a, record_key_b AS b FROM {p}matches UNION SELECT record_key_b, record_key_a FROM {p}matches),
{p}reach(a, b) AS (SELECT a, b FROM {p}edges UNION SELECT r.a, e.b FROM {p}reach r JOIN {p}edges e ON r.b = e.a),
{p}comp AS MATERIALIZED (SELECT a AS node, least(a, min(b)) AS component FROM {p}reach GROUP BY a),
{p}clusters AS MATERIALIZED (
  SELECT c.component, string_agg(c.node, ',' ORDER BY c.node) AS members, count(*) AS size, any_value(n) AS scored_pairs, count(*) * (count(*) - 1) // 2 AS possible_pairs, any_value(n) / (count(*) * (count(*) - 1) / 2) AS confidence
  FROM {p}comp c JOIN (SELECT component, count(*) AS n FROM {p}matches s JOIN {p}comp c ON c.node = s.record_key_a GROUP BY component) e ON e.component = c.component GROUP BY c.component),
{p}members AS MATERIALIZED (
  SELECT r.record_key, coalesce(CASE WHEN size > {MAX_CLUSTER} OR confidence < {MIN_DENSITY} THEN NULL ELSE c.component END, r.record_key) AS cluster
  FROM {records} r LEFT JOIN {p}comp c ON c.node = r.record_key LEFT JOIN {p}clusters k ON k.component = c.component)"""


def _pick(values: tuple[str, ...] | list[str], i: str) -> str:
    return f"{list(values)!r}[({i})::INT + 1]"


def _persons() -> str:
    first, last = _pick(FIRST, f"(k * 31 + k // 7) % {len(FIRST)}"), _pick(LAST, f"(k * 7919 + k // 97) % {len(LAST)}")
    keep = {"pharmacy_info": "k % 2 = 0", "lab_identity": "k % 3 != 0"}
    parts = " UNION ALL ".join(f"SELECT '{d}' AS domain, '{v}' AS source_vendor, * FROM named WHERE {keep[d]}" for d, v in MATCHED.items())
    return f"""named AS (
  SELECT k, lpad(k::VARCHAR, 8, '0') AS source_record_id, f AS first_name, CASE WHEN k % 20 = 8 THEN substr(l, 1, 1) || substr(l, 3, 1) || substr(l, 2, 1) || substr(l, 4) WHEN k % 20 = 18 THEN 'QUIXOTE' ELSE l END AS last_name,
    DATE '1950-01-01' + (k * 15485863 // 11 % 9000 + CASE WHEN k % 20 = 14 THEN 1 ELSE 0 END)::INT AS dob, CASE WHEN (k * 104729 // 7) % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM (SELECT k, {first} AS f, {last} AS l FROM (SELECT c_custkey::BIGINT AS k FROM customer))),
persons AS MATERIALIZED (
  SELECT domain, source_vendor, source_record_id, source_vendor || ':' || source_record_id AS record_key, first_name, last_name, dob, gender, NULL::VARCHAR AS ssn,
    {_phonetic("first_name")} AS first_name_phonetic, {_phonetic("last_name")} AS last_name_phonetic, year(dob)::INTEGER AS dob_year, k, k || ' Main St' AS address, '555' || lpad(k::VARCHAR, 7, '0') AS phone, {_pick(PLANS, "k % 4")} AS plan_tier
  FROM ({parts})),
person_keys AS MATERIALIZED (
  SELECT record_key, 'bp_dob_lname' AS blocking_pass, dob::VARCHAR || '|' || last_name_phonetic AS block_key, 'matchpath' AS side FROM persons
  UNION ALL SELECT record_key, 'bp_year_names', dob_year::VARCHAR || '|' || first_name_phonetic || '|' || last_name_phonetic, 'matchpath' FROM persons
  UNION ALL SELECT record_key, 'bp_coarse', last_name_phonetic || '|' || gender || '|' || dob_year::VARCHAR, 'matchpath' FROM persons
  UNION ALL SELECT record_key, blocking_pass, block_key, 'core' FROM keys WHERE blocking_pass != 'bp_ssn'),
person_every AS MATERIALIZED (
  SELECT DISTINCT x.record_key AS record_key_a, y.record_key AS record_key_b, blocking_pass, block_key FROM person_keys x JOIN person_keys y USING (blocking_pass, block_key) WHERE x.side = 'matchpath' AND y.side = 'core'),
person_pairs AS (
  SELECT DISTINCT record_key_a, record_key_b FROM person_every
  WHERE (blocking_pass, block_key) IN (SELECT (blocking_pass, block_key) FROM person_keys WHERE side = 'core' GROUP BY ALL HAVING count(*) <= {MAX_BLOCK})),
{_scored("persons", "person_", "person_pairs", "patients")},
{_scored("persons", "every_", "person_every", "patients")},
person_auto AS MATERIALIZED (SELECT * FROM person_scored WHERE score >= {UPPER} QUALIFY row_number() OVER (PARTITION BY record_key_a ORDER BY round(score, 4) DESC, record_key_b) = 1),
resolution AS MATERIALIZED (
  SELECT domain, record_key, source_record_id, x.pgid AS patient_global_id, record_key_b AS matched_core_record_key, round(score, 4) AS match_score
  FROM person_auto JOIN persons ON record_key = record_key_a JOIN xw x ON x.key = record_key_b),
person_review AS (
  SELECT domain, p.record_key, record_key_b AS candidate_core_record_key, round(score, 4) AS score, 'pending' AS status FROM (
    SELECT * FROM person_scored WHERE score >= {LOWER} AND score < {UPPER} QUALIFY row_number() OVER (PARTITION BY record_key_a ORDER BY round(score, 4) DESC, record_key_b) = 1) s
  JOIN persons p ON p.record_key = record_key_a WHERE record_key_a NOT IN (SELECT record_key_a FROM person_auto))"""


def _curve(name: str, score: str) -> str:
    return f"""{name} AS (
  SELECT score, tp, fp, round(tp / (tp + fp), 6) AS precision, round(tp / (SELECT count(*) FROM truth), 6) AS recall FROM (
    SELECT score, (sum(tp) OVER w)::BIGINT AS tp, (sum(fp) OVER w)::BIGINT AS fp FROM (
      SELECT round({score}, 4) AS score, count(t.record_key_a) AS tp, count(*) - count(t.record_key_a) AS fp FROM scored s LEFT JOIN truth t ON t.record_key_a = s.record_key_a AND t.record_key_b = s.record_key_b GROUP BY 1) WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)))"""


PRELUDE = f"""WITH RECURSIVE feed AS MATERIALIZED ({feed_sql(DUCK, "customer")}),
nick(v, c) AS (VALUES {", ".join(f"('{v}', '{c}')" for v, c in CANONICAL.items())}),
{_weights("fs", WEIGHTS)},
{_weights("nv", {f: NAIVE_LEVEL for f in FIELDS})},
staged AS (
  SELECT vendor AS source_vendor, record_id AS source_record_id, vendor || ':' || record_id AS record_key, upper(trim(first_name)) AS first_name, upper(trim(last_name)) AS last_name,
    CASE vendor WHEN 'VENDOR_A' THEN try_strptime(dob, '%Y-%m-%d') WHEN 'VENDOR_B' THEN try_strptime(dob, '%m/%d/%Y') ELSE try_strptime(dob, '%d-%b-%Y') END::DATE AS dob,
    CASE upper(trim(gender)) WHEN 'M' THEN 'M' WHEN 'F' THEN 'F' ELSE 'U' END AS gender, nullif(regexp_replace(ssn, '[^0-9]', '', 'g'), '') AS ssn FROM feed),
patients AS MATERIALIZED (
  SELECT *, {_phonetic("first_name")} AS first_name_phonetic, {_phonetic("last_name")} AS last_name_phonetic, year(dob)::INTEGER AS dob_year, (year(dob) // 10 * 10)::INTEGER AS dob_decade FROM staged),
earlier AS MATERIALIZED (SELECT * FROM patients WHERE {_EARLIER}),
keys AS (
  SELECT record_key, 'bp_ssn' AS blocking_pass, ssn AS block_key FROM patients WHERE ssn IS NOT NULL
  UNION ALL SELECT record_key, 'bp_dob_lname', dob::VARCHAR || '|' || last_name_phonetic FROM patients WHERE dob IS NOT NULL AND last_name_phonetic IS NOT NULL
  UNION ALL SELECT record_key, 'bp_year_names', dob_year::VARCHAR || '|' || first_name_phonetic || '|' || last_name_phonetic FROM patients WHERE dob_year IS NOT NULL AND first_name_phonetic IS NOT NULL AND last_name_phonetic IS NOT NULL
  UNION ALL SELECT record_key, 'bp_coarse', last_name_phonetic || '|' || gender || '|' || dob_year::VARCHAR FROM patients WHERE last_name_phonetic IS NOT NULL AND dob_year IS NOT NULL),
uncapped AS (
  SELECT x.record_key AS record_key_a, y.record_key AS record_key_b, x.blocking_pass, x.block_key FROM keys x JOIN keys y USING (blocking_pass, block_key) WHERE x.record_key < y.record_key),
pairs AS (
  SELECT * FROM uncapped WHERE (blocking_pass, block_key) IN (SELECT (blocking_pass, block_key) FROM keys GROUP BY ALL HAVING count(*) <= {MAX_BLOCK})),
{_scored("patients", "", "pairs")},
{_members("patients", "")},
{_members("earlier", "e_")},
truth AS MATERIALIZED (
  SELECT x.r AS record_key_a, y.r AS record_key_b, CASE WHEN x.noise = 'exact' AND y.noise = 'exact' THEN 'exact' WHEN x.noise = 'exact' THEN y.noise WHEN y.noise = 'exact' THEN x.noise ELSE 'multiple' END AS noise_type
  FROM (SELECT k, vendor || ':' || record_id AS r, noise FROM feed) x JOIN (SELECT k, vendor || ':' || record_id AS r, noise FROM feed) y USING (k) WHERE x.r < y.r),
determined AS MATERIALIZED (
  SELECT record_key_a, record_key_b, CASE min(r) WHEN 0 THEN 'ssn_exact' ELSE 'name_dob_exact' END AS rule FROM (
    SELECT x.record_key AS record_key_a, y.record_key AS record_key_b, 0 AS r FROM patients x JOIN patients y ON x.ssn = y.ssn
    UNION ALL SELECT x.record_key, y.record_key, 1 FROM patients x JOIN patients y ON x.first_name = y.first_name AND x.last_name = y.last_name AND x.dob = y.dob) WHERE record_key_a < record_key_b GROUP BY ALL),
one AS MATERIALIZED (
  SELECT record_key, CASE WHEN record_key LIKE 'VENDOR_B%' AND record_key LIKE '%0' THEN 'PGID9' || substr(id, 6, 11) ELSE id END AS id, 'run1' AS since FROM (
    SELECT m.record_key, 'PGID' || lpad(n::VARCHAR, 12, '0') AS id FROM e_members m JOIN (SELECT cluster, row_number() OVER (ORDER BY cluster) - 1 AS n FROM e_members GROUP BY cluster) c ON c.cluster = m.cluster)),
held AS MATERIALIZED (SELECT *, min(cluster) OVER (PARTITION BY id) AS claimant FROM (SELECT DISTINCT m.cluster, o.id FROM members m JOIN one o USING (record_key))),
taken AS (SELECT cluster, min(id) AS kept FROM held WHERE claimant = cluster GROUP BY cluster),
every AS (SELECT DISTINCT cluster FROM members),
ids AS MATERIALIZED (
  SELECT e.cluster, kept, coalesce(kept, 'PGID' || lpad(((SELECT max(substr(id, 5)::BIGINT) FROM one) + row_number() OVER (PARTITION BY kept IS NULL ORDER BY e.cluster))::VARCHAR, 12, '0')) AS id FROM every e LEFT JOIN taken t ON t.cluster = e.cluster),
xw AS MATERIALIZED (SELECT m.record_key AS key, i.id AS pgid FROM members m JOIN ids i USING (cluster)),
tall AS (
  SELECT pgid, record_key, source_vendor, CASE source_vendor WHEN 'VENDOR_A' THEN 1 WHEN 'VENDOR_B' THEN 2 ELSE 3 END AS normalized_at,
    (first_name IS NOT NULL AND first_name != '')::INT + (last_name IS NOT NULL AND last_name != '')::INT + (dob IS NOT NULL)::INT + (ssn IS NOT NULL)::INT + (gender IS NOT NULL)::INT AS complete,
    unnest(['first_name', 'last_name', 'dob', 'ssn', 'gender']) AS field_name, unnest([first_name, last_name, dob::VARCHAR, ssn, gender]) AS value FROM patients JOIN xw ON key = record_key),
valued AS (SELECT *, {_TRUST} AS trust, count(*) OVER (PARTITION BY pgid, field_name) AS n, NULL::VARCHAR AS rule FROM tall WHERE value IS NOT NULL AND value != ''),
{_CHAIN},
won AS (SELECT pgid, field_name, min_by(value, record_key) AS value, min(record_key) AS record_key, min_by(source_vendor, record_key) AS source_vendor, max(rule) AS rule, max(n) AS n FROM {_LAST} GROUP BY ALL),
lineage AS MATERIALIZED (
  SELECT f.pgid AS patient_global_id, f.field_name, CASE WHEN f.field_name = 'ssn' THEN right(value, 4) ELSE value END AS winning_value, coalesce(w.source_vendor, f.source_vendor) AS source_vendor, coalesce(w.record_key, f.record_key) AS record_key,
    CASE WHEN w.n IS NULL THEN 'no_non_null_value' ELSE coalesce(rule, CASE WHEN w.n > 1 THEN 'deterministic' ELSE 'single_candidate' END) END AS rule_applied
  FROM (SELECT pgid, field_name, min(record_key) AS record_key, min_by(source_vendor, record_key) AS source_vendor FROM tall GROUP BY ALL) f LEFT JOIN won w ON w.pgid = f.pgid AND w.field_name = f.field_name),
golden AS MATERIALIZED (
  SELECT patient_global_id, max(winning_value) FILTER (field_name = 'first_name') AS first_name, max(winning_value) FILTER (field_name = 'last_name') AS last_name, (max(winning_value) FILTER (field_name = 'dob'))::DATE AS dob,
    max(winning_value) FILTER (field_name = 'gender') AS gender, max(winning_value) FILTER (field_name = 'ssn') AS ssn_last4 FROM lineage GROUP BY 1),
alt AS (SELECT pgid AS patient_global_id, split_part(key, ':', 1) AS source_vendor, split_part(key, ':', 2) AS source_record_id FROM xw),
per AS (SELECT pgid AS patient_global_id, count(*) AS source_record_count FROM xw GROUP BY pgid),
spread AS (SELECT *, user_id * 10 + event_id % 10 AS k FROM events),
encounters AS (
  SELECT v AS source_vendor, v || ':E' || event_id AS encounter_key, 'E' || event_id AS source_encounter_id, lpad(k::VARCHAR, 8, '0') AS member_id, ts::DATE AS encounter_date, 'C' || event_id % 97 AS condition_code, {_pick(ENCOUNTERS, "event_id % 5")} AS encounter_type
  FROM (SELECT *, CASE WHEN k % 3 = 1 THEN 'VENDOR_C' ELSE 'VENDOR_A' END AS v FROM spread)),
claims AS (
  SELECT v AS source_vendor, v || ':' || o_orderkey AS claim_key, o_orderkey::VARCHAR AS source_claim_id, lpad(o_custkey::VARCHAR, 8, '0') AS member_id, o_orderdate::DATE AS claim_date, 'D' || o_orderkey % 89 AS diagnosis_code, 'P' || o_orderkey % 61 AS procedure_code,
    round(o_totalprice, 2) AS billed_amount, CASE WHEN o_orderkey % 3 = 0 THEN round(o_totalprice, 2) ELSE 0 END AS paid_amount, {_pick(STATUSES, "o_orderkey % 3")} AS claim_status
  FROM (SELECT *, CASE WHEN o_custkey % 3 = 1 THEN 'VENDOR_B' ELSE 'VENDOR_A' END AS v FROM orders)),
rx AS (
  SELECT v AS source_vendor, v || ':' || rx AS rx_key, rx AS source_rx_id, 'P' || o_custkey AS pbm_member_id, l_shipdate::DATE AS fill_date, 'N' || l_partkey AS ndc_code,
    ((l_quantity::INT % 3 + 1) * 30)::BIGINT AS days_supply, l_quantity::BIGINT AS quantity
  FROM (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_extendedprice * 100)::BIGINT) AS rx, CASE WHEN o_custkey % 3 = 1 THEN 'VENDOR_C' ELSE 'VENDOR_A' END AS v FROM lineitem JOIN orders ON l_orderkey = o_orderkey)),
id_map AS (SELECT CASE WHEN c_custkey % 3 = 1 THEN 'VENDOR_C' ELSE 'VENDOR_A' END AS source_vendor, 'P' || c_custkey AS pbm_member_id, lpad(c_custkey::VARCHAR, 8, '0') AS enrollment_member_id FROM customer),
labs AS (
  SELECT source_record_id || ':' || row_number() OVER (PARTITION BY source_record_id ORDER BY test_date, test_code, t, event_id) AS lab_result_key, source_record_id, test_date, test_code, t::DOUBLE AS result_value, 'mg/dL' AS result_unit, abnormal_flag FROM (
    SELECT event_id, lpad(k::VARCHAR, 8, '0') AS source_record_id, ts::DATE AS test_date, event_type AS test_code, printf('%.4f', round(value, 4)) AS t,
      CASE WHEN event_id % 20 < 14 THEN 'normal' WHEN event_id % 20 < 17 THEN 'high' WHEN event_id % 20 < 19 THEN 'low' ELSE 'critical' END AS abnormal_flag FROM spread)),
{_persons()},
fct_history AS (SELECT patient_global_id, e.source_vendor, encounter_key, encounter_date, condition_code, encounter_type FROM encounters e JOIN alt ON alt.source_vendor = e.source_vendor AND alt.source_record_id = member_id),
fct AS (SELECT patient_global_id, c.source_vendor, claim_key, claim_date, diagnosis_code, procedure_code, billed_amount, paid_amount, claim_status FROM claims c JOIN alt ON alt.source_vendor = c.source_vendor AND alt.source_record_id = member_id),
fct_rx AS (
  SELECT patient_global_id, r.source_vendor, rx_key, fill_date, ndc_code, days_supply, quantity FROM rx r JOIN id_map i ON i.source_vendor = r.source_vendor AND i.pbm_member_id = r.pbm_member_id
  JOIN alt ON alt.source_vendor = r.source_vendor AND alt.source_record_id = enrollment_member_id),
fct_info AS (SELECT patient_global_id, p.source_record_id, plan_tier, address, phone, match_score FROM persons p JOIN resolution r ON r.domain = 'pharmacy_info' AND r.record_key = p.record_key),
fct_labs AS (SELECT patient_global_id, lab_result_key, test_date, test_code, result_value, result_unit, abnormal_flag, match_score FROM labs JOIN resolution r ON r.domain = 'lab_identity' AND r.source_record_id = labs.source_record_id),
id_events AS (
  SELECT 'create' AS event_type, id AS surviving_id, NULL AS retired_id, 'run2' AS run_id, CASE WHEN cluster IN (SELECT cluster FROM held) THEN '{ELSEWHERE}' ELSE '{UNKNOWN}' END AS reason FROM ids WHERE kept IS NULL
  UNION ALL SELECT 'merge', kept, h.id, 'run2', $$cluster unified existing ids ['$$ || u.ids || $$']$$ FROM held h JOIN taken USING (cluster)
    JOIN (SELECT cluster, string_agg(id, $$', '$$ ORDER BY id) AS ids FROM held WHERE claimant = cluster GROUP BY cluster) u ON u.cluster = h.cluster WHERE claimant = h.cluster AND h.id != kept
  UNION ALL SELECT 'split', h.id, i.id, 'run2', 'a subset of ' || h.id || $$'s former members moved to $$ || i.id FROM held h JOIN ids i USING (cluster) WHERE claimant != cluster),
sizes AS (SELECT blocking_pass, block_key, count(*) AS record_count FROM keys GROUP BY ALL),
{_curve("pr", "score")},
{_curve("pr_naive", "naive_score")},
numbered AS (SELECT record_key, row_number() OVER (ORDER BY record_key) - 1 AS pos FROM patients),
drawn AS (
  SELECT record_key, ('0x' || substr(md5('7|' || i || '|' || record_key), 1, 12))::BIGINT % (SELECT count(*) FROM patients) AS pos
  FROM patients, (SELECT unnest(range(1, 1 + ({NON_MATCHES} + (SELECT count(*) FROM patients) - 1) // (SELECT count(*) FROM patients))) AS i)),
others AS MATERIALIZED (
  SELECT DISTINCT least(d.record_key, n.record_key) AS record_key_a, greatest(d.record_key, n.record_key) AS record_key_b FROM drawn d JOIN numbered n USING (pos) WHERE d.record_key != n.record_key
  EXCEPT SELECT record_key_a, record_key_b FROM truth),
{_scored("patients", "true_", "truth")},
{_scored("patients", "other_", "others")},
one_member AS (SELECT patient_global_id AS id FROM per ORDER BY source_record_count DESC, patient_global_id LIMIT 1)
"""

_PAIRS = "SELECT blocking_pass, record_key_a, record_key_b FROM uncapped UNION ALL SELECT 'unioned', record_key_a, record_key_b FROM (SELECT DISTINCT record_key_a, record_key_b FROM uncapped)"
_TALL = ", ".join(f"('{f}', '{lv}', {len(levels)})" for f, levels in WEIGHTS.items() for lv in levels)

_FIELD_LIST = list(FIELDS)


def _levels_of(table: str) -> str:
    return f"(SELECT unnest({_FIELD_LIST!r}) AS field, unnest([{', '.join(_FIELD_LIST)}]) AS level FROM {table})"


def _thresholds(curve: str) -> str:
    return f"""SELECT upper, least(low, upper) AS lower, best_f1 FROM (
  SELECT coalesce(min(score) FILTER (precision >= 0.99), max(score)) AS upper, coalesce(max(score) FILTER (recall >= 0.99), min(score)) AS low, round(max(CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END), 6) AS best_f1 FROM {curve})"""


def _pair_metrics(pairs: str) -> str:
    return f"""SELECT tp, fp, fn, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM (
  SELECT tp, fp, n - tp AS fn, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS p, CASE WHEN n > 0 THEN tp / n ELSE 0 END AS r FROM (
    SELECT count(t.noise_type) AS tp, count(*) - count(t.noise_type) AS fp, (SELECT count(*) FROM truth) AS n FROM (SELECT DISTINCT record_key_a, record_key_b FROM {pairs}) x LEFT JOIN truth t USING (record_key_a, record_key_b)))"""


_EVENT_COUNTS = ", ".join(f"(SELECT count(*) FROM id_events WHERE event_type = '{e}') AS {e}_events" for e in ("create", "merge", "split"))
_REVIEW = f"score >= {LOWER} AND score < {UPPER}"
_DUPLICATES = "SELECT count(*) FROM (SELECT 1 FROM {} GROUP BY {} HAVING count(*) > 1)"
_UNEQUAL = "SELECT count(*) FROM (SELECT 1 WHERE (SELECT count(*) FROM {}) != (SELECT count(*) FROM {}))"
_SMALL = f"(blocking_pass, block_key) IN (SELECT (blocking_pass, block_key) FROM sizes WHERE record_count <= {MAX_BLOCK})"
_KNOWN = "SELECT count(*) FROM {} WHERE patient_global_id NOT IN (SELECT patient_global_id FROM golden)"
GATES = {
    "record_key_not_null": "SELECT count(*) FROM patients WHERE record_key IS NULL",
    "record_key_unique": _DUPLICATES.format("patients", "record_key"),
    "gender_accepted": "SELECT count(*) FROM patients WHERE gender NOT IN ('M', 'F', 'U')",
    "block_pass_accepted": "SELECT count(*) FROM keys WHERE blocking_pass NOT IN ('bp_ssn', 'bp_dob_lname', 'bp_year_names', 'bp_coarse')",
    "block_key_not_null": "SELECT count(*) FROM keys WHERE block_key IS NULL",
    "block_stats_unique": _DUPLICATES.format("sizes", "blocking_pass, block_key"),
    "pairs_ordered": "SELECT count(*) FROM pairs WHERE record_key_a >= record_key_b",
    "pairs_unique": _DUPLICATES.format("pairs", "record_key_a, record_key_b, blocking_pass"),
    "no_pairs_from_oversized_blocks": f"SELECT count(*) FROM pairs WHERE NOT {_SMALL}",
    "crosswalk_complete": "SELECT count(*) FROM patients WHERE record_key NOT IN (SELECT key FROM xw)",
    "crosswalk_unique": _DUPLICATES.format("xw", "key"),
    "crosswalk_not_null": "SELECT count(*) FROM xw WHERE pgid IS NULL",
    "event_type_accepted": "SELECT count(*) FROM id_events WHERE event_type NOT IN ('create', 'merge', 'split')",
    "golden_unique": _DUPLICATES.format("golden", "patient_global_id"),
    "lineage_five_fields": "SELECT count(*) FROM (SELECT 1 FROM lineage GROUP BY patient_global_id HAVING count(*) != 5)",
    "lineage_identity_known": _KNOWN.format("lineage"),
    "membership_unique": _DUPLICATES.format("per", "patient_global_id"),
    "membership_identity_known": _KNOWN.format("per"),
    "alternate_identifiers_conserved": _UNEQUAL.format("patients", "alt"),
    "encounter_key_unique": _DUPLICATES.format("encounters", "encounter_key"),
    "encounter_type_accepted": f"SELECT count(*) FROM encounters WHERE encounter_type NOT IN {ENCOUNTERS!r}",
    "claim_key_unique": _DUPLICATES.format("claims", "claim_key"),
    "claim_status_accepted": f"SELECT count(*) FROM claims WHERE claim_status NOT IN {STATUSES!r}",
    "rx_key_unique": _DUPLICATES.format("rx", "rx_key"),
    "days_supply_accepted": "SELECT count(*) FROM rx WHERE days_supply NOT IN (30, 60, 90)",
    "id_map_unique": _DUPLICATES.format("id_map", "source_vendor, pbm_member_id"),
    "plan_tier_accepted": f"SELECT count(*) FROM persons WHERE plan_tier NOT IN {PLANS!r}",
    "person_key_unique": _DUPLICATES.format("persons", "record_key"),
    "lab_result_key_unique": _DUPLICATES.format("labs", "lab_result_key"),
    "abnormal_flag_accepted": "SELECT count(*) FROM labs WHERE abnormal_flag NOT IN ('normal', 'high', 'low', 'critical')",
    "medical_history_conserved": _UNEQUAL.format("encounters", "fct_history"),
    "medical_claims_conserved": _UNEQUAL.format("claims", "fct"),
    "pharmacy_claims_conserved": _UNEQUAL.format("rx", "fct_rx"),
    "pharmacy_info_no_fanout": _DUPLICATES.format("fct_info", "source_record_id"),
    "lab_results_no_fanout": _DUPLICATES.format("fct_labs", "lab_result_key"),
    "matchpath_sides_not_swapped": "SELECT count(*) FROM person_pairs WHERE record_key_a NOT IN (SELECT record_key FROM persons) OR record_key_b NOT IN (SELECT record_key FROM patients)",
    "no_matchpath_pairs_from_oversized_blocks": f"SELECT count(*) FROM person_pairs WHERE (record_key_a, record_key_b) NOT IN (SELECT (record_key_a, record_key_b) FROM person_every WHERE {_SMALL})",
    "resolution_unique": _DUPLICATES.format("resolution", "record_key"),
    "resolution_domain_accepted": f"SELECT count(*) FROM resolution WHERE domain NOT IN {tuple(MATCHED)!r}",
    "resolution_identity_known": _KNOWN.format("resolution"),
    "review_not_resolved": "SELECT count(*) FROM person_review WHERE record_key IN (SELECT record_key FROM resolution)",
    "fact_identity_known": _KNOWN.format("fct"),
}
_FACTS = {"medical_history": ("encounters", "fct_history"), "medical_claims": ("claims", "fct"), "pharmacy_claims": ("rx", "fct_rx"), "pharmacy_info": ("persons", "fct_info"), "lab_results": ("labs", "fct_labs")}

BODIES = {
    "stg_vendors": "SELECT * FROM staged",
    "patient_normalized": "SELECT * FROM patients",
    "block_keys": "SELECT * FROM keys",
    "block_stats": "SELECT *, record_count > 8 AS is_oversized FROM sizes",
    "block_summary": "SELECT blocking_pass, count(*) AS blocks, max(record_count) AS largest, round(avg(record_count), 6) AS mean_size FROM sizes GROUP BY 1",
    "candidate_pairs": "SELECT * FROM pairs",
    "candidate_pairs_capped": "SELECT * FROM pairs WHERE (blocking_pass, block_key) IN (SELECT (blocking_pass, block_key) FROM sizes WHERE record_count <= 4)",
    "candidate_pairs_uncapped": "SELECT DISTINCT record_key_a, record_key_b FROM uncapped",
    "blocking_metrics": f"SELECT blocking_pass, count(*) AS pairs, round(count(t.noise_type) / (SELECT count(*) FROM truth), 6) AS pair_completeness, round(1 - count(*) / (SELECT count(*) * (count(*) - 1) / 2 FROM patients), 6) AS reduction_ratio FROM ({_PAIRS}) p LEFT JOIN truth t USING (record_key_a, record_key_b) GROUP BY 1",
    "block_cap_cost": """SELECT round(u, 6) AS uncapped_pair_completeness, round(c, 6) AS capped_pair_completeness, round(u - c, 6) AS pair_completeness_cost_of_cap FROM (
  SELECT count(*) FILTER ((record_key_a, record_key_b) IN (SELECT (record_key_a, record_key_b) FROM uncapped)) / count(*) AS u,
    count(*) FILTER ((record_key_a, record_key_b) IN (SELECT (record_key_a, record_key_b) FROM uncapped WHERE (blocking_pass, block_key) IN (SELECT (blocking_pass, block_key) FROM sizes WHERE record_count <= 4))) / count(*) AS c FROM truth)""",
    "deterministic_pairs": "SELECT * FROM determined",
    "deterministic_metrics": _pair_metrics("determined"),
    "true_pairs_by_noise": "SELECT * FROM truth",
    "recall_by_noise": "SELECT noise_type, count(*) AS true_pairs, count(rule) AS found FROM truth LEFT JOIN determined USING (record_key_a, record_key_b) GROUP BY 1",
    "agreement_vectors": "SELECT * FROM levels",
    "pair_scores": "SELECT record_key_a, record_key_b, round(score, 4) AS score, round(naive_score, 4) AS naive_score FROM scored",
    "match_metrics": _pair_metrics("matches"),
    "triage_decisions": f"SELECT CASE WHEN score >= {UPPER} THEN 'auto_match' WHEN score >= {LOWER} THEN 'review' ELSE 'non_match' END AS decision, count(*) AS pairs, round(avg(score), 4) AS mean_score, round(count(*) / (SELECT count(*) FROM scored), 6) AS share FROM scored GROUP BY 1",
    "review_queue": f"SELECT record_key_a, record_key_b, round(score, 4) AS score, 'pending' AS status FROM scored WHERE {_REVIEW}",
    "review_queue_records": f"""SELECT record_key_a, record_key_b, round(score, 4) AS score, 'pending' AS status, {", ".join(f"{x}.{c} AS {x}_{c}" for x in "ab" for c in ("first_name", "last_name", "dob", "source_vendor"))}
  FROM scored s JOIN patients a ON a.record_key = record_key_a JOIN patients b ON b.record_key = record_key_b WHERE {_REVIEW}""",
    "non_match_pairs": "SELECT * FROM others",
    "fs_params": f"""SELECT field, level, round(m, 6) AS m, round(u, 6) AS u, round(log2(m / u), 4) AS weight FROM (
  SELECT g.field, g.level, (coalesce(mn, 0) + 1) / ((SELECT count(*) FROM true_levels) + levels) AS m, (coalesce(un, 0) + 1) / ((SELECT count(*) FROM other_levels) + levels) AS u FROM (VALUES {_TALL}) g(field, level, levels)
  LEFT JOIN (SELECT field, level, count(*) AS mn FROM {_levels_of("true_levels")} GROUP BY ALL) x ON x.field = g.field AND x.level = g.level
  LEFT JOIN (SELECT field, level, count(*) AS un FROM {_levels_of("other_levels")} GROUP BY ALL) y ON y.field = g.field AND y.level = g.level)""",
    "pr_curve": "SELECT * FROM pr",
    "pr_curve_naive": "SELECT * FROM pr_naive",
    "thresholds": _thresholds("pr"),
    "scoring_comparison": f"SELECT 'fellegi_sunter' AS scorer, * FROM ({_thresholds('pr')}) UNION ALL SELECT 'naive', * FROM ({_thresholds('pr_naive')})",
    "tier_parity": "SELECT record_key_a, record_key_b, score, 'left' AS only_in FROM scored WHERE false",
    "clusters": f"SELECT component, members, size, scored_pairs, possible_pairs, round(confidence, 6) AS confidence, size > {MAX_CLUSTER} OR confidence < {MIN_DENSITY} AS flagged, concat_ws(',', CASE WHEN size > {MAX_CLUSTER} THEN 'size' END, CASE WHEN confidence < {MIN_DENSITY} THEN 'density' END) AS flag_reasons FROM clusters",
    "cluster_membership": "SELECT * FROM members",
    "crosswalk_run2": "SELECT m.record_key, i.id AS patient_global_id, coalesce(o.since, 'run2') AS first_seen_run, 'run2' AS last_seen_run FROM members m JOIN ids i USING (cluster) LEFT JOIN one o ON o.record_key = m.record_key",
    "identity_events_run2": "SELECT * FROM id_events",
    "run_summary": f"""SELECT (SELECT count(*) FROM patients) AS records, (SELECT count(*) FROM scored) AS scored_pairs, (SELECT count(*) FROM matches) AS auto_matches, (SELECT count(*) FROM scored WHERE {_REVIEW}) AS review_pairs,
  (SELECT count(DISTINCT pgid) FROM xw) AS identities, {_EVENT_COUNTS}""",
    "field_lineage": "SELECT * FROM lineage",
    "golden_records": "SELECT * FROM golden",
    "membership": "SELECT * FROM per",
    "alternate_identifiers": "SELECT * FROM alt",
    "dim_member": "SELECT g.*, source_record_count FROM golden g JOIN per USING (patient_global_id)",
    "records_by_vendor": "SELECT source_vendor, count(*) AS records FROM patients GROUP BY 1",
    "medical_history_normalized": "SELECT * FROM encounters",
    "medical_claims_normalized": "SELECT * FROM claims",
    "pharmacy_claims_normalized": "SELECT * FROM rx",
    "vendor_id_map_normalized": "SELECT * FROM id_map",
    "pharmacy_info_normalized": "SELECT * EXCLUDE (domain, k) FROM persons WHERE domain = 'pharmacy_info'",
    "lab_identity_normalized": "SELECT * EXCLUDE (domain, k, plan_tier) FROM persons WHERE domain = 'lab_identity'",
    "lab_results_normalized": "SELECT * FROM labs",
    "patients_with_matchpath": f"SELECT record_key, {', '.join(FIELDS)} FROM patients UNION ALL SELECT record_key, {', '.join(FIELDS)} FROM persons",
    "matchpath_block_keys": "SELECT * FROM person_keys",
    "matchpath_block_stats": "SELECT blocking_pass, block_key, count(*) AS record_count, count(*) > 8 AS is_oversized FROM person_keys WHERE side = 'core' GROUP BY 1, 2",
    "matchpath_candidate_pairs": "SELECT * FROM person_pairs",
    "matchpath_resolution": "SELECT * FROM resolution",
    "matchpath_review_queue": "SELECT * FROM person_review",
    "matchpath_metrics": """SELECT domain, tp, fp, n - tp AS fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN n > 0 THEN tp / n ELSE 0 END, 6) AS recall FROM (
  SELECT coalesce(domain, 'overall') AS domain, count(*) FILTER (hit) AS tp, count(*) FILTER (NOT hit) AS fp, count(*) FILTER (findable) AS n FROM (
    SELECT p.domain, p.k IN (SELECT k FROM feed) AS findable, f.k = p.k AS hit FROM persons p LEFT JOIN resolution r USING (record_key) LEFT JOIN feed f ON f.vendor || ':' || f.record_id = r.matched_core_record_key) GROUP BY GROUPING SETS ((domain), ()))""",
    "resolve_batch": f"""SELECT record_key, CASE WHEN pgid IS NULL THEN 'created' ELSE 'matched' END AS outcome, match_score,
  coalesce(pgid, 'PGID' || lpad(((SELECT max(substr(x, 5)::BIGINT) FROM (SELECT pgid AS x FROM xw UNION ALL SELECT surviving_id FROM id_events UNION ALL SELECT retired_id FROM id_events)) + row_number() OVER (PARTITION BY pgid IS NULL ORDER BY record_key))::VARCHAR, 12, '0')) AS patient_global_id
  FROM (SELECT p.record_key, round(score, 4) AS match_score, CASE WHEN score >= {UPPER} THEN pgid END AS pgid FROM persons p
    LEFT JOIN (SELECT * FROM every_scored QUALIFY row_number() OVER (PARTITION BY record_key_a ORDER BY round(score, 4) DESC, record_key_b) = 1) s ON s.record_key_a = p.record_key LEFT JOIN xw ON key = record_key_b)""",
    "fact_conservation": " UNION ALL ".join(f"SELECT '{d}' AS domain, (SELECT count(*) FROM {_FACTS[d][0]}) AS conformance_rows, count(*) AS fact_rows, count(DISTINCT patient_global_id) AS distinct_members FROM {_FACTS[d][1]}" for d in ("medical_history", "medical_claims", "pharmacy_claims")),
    "member_360": """SELECT g.*, source_record_count, alternate_identifiers, coalesce(field_lineage_rows, 0) AS field_lineage_rows, coalesce(encounter_count, 0) AS encounter_count, most_recent_encounter_date, coalesce(medical_claim_count, 0) AS medical_claim_count, most_recent_claim_date,
    coalesce(pharmacy_claim_count, 0) AS pharmacy_claim_count, most_recent_fill_date, coalesce(active_prescription_count, 0) AS active_prescription_count, pharmacy_plan_tier, coalesce(pharmacy_info_match_count, 0) AS pharmacy_info_match_count,
    coalesce(lab_result_count, 0) AS lab_result_count, most_recent_lab_date, coalesce(abnormal_lab_count, 0) AS abnormal_lab_count
  FROM golden g JOIN (SELECT pgid AS patient_global_id, count(*) AS source_record_count, string_agg(key, ',' ORDER BY key) AS alternate_identifiers FROM xw GROUP BY 1) USING (patient_global_id)
  LEFT JOIN (SELECT patient_global_id, count(DISTINCT (field_name, record_key)) AS field_lineage_rows FROM lineage GROUP BY 1) USING (patient_global_id)
  LEFT JOIN (SELECT patient_global_id, count(*) AS encounter_count, max(encounter_date) AS most_recent_encounter_date FROM fct_history GROUP BY 1) USING (patient_global_id)
  LEFT JOIN (SELECT patient_global_id, count(*) AS medical_claim_count, max(claim_date) AS most_recent_claim_date FROM fct GROUP BY 1) USING (patient_global_id)
  LEFT JOIN (SELECT patient_global_id, count(*) AS pharmacy_claim_count, max(fill_date) AS most_recent_fill_date, count(*) FILTER (fill_date + days_supply::INT >= DATE '2024-06-30') AS active_prescription_count FROM fct_rx GROUP BY 1) USING (patient_global_id)
  LEFT JOIN (SELECT patient_global_id, max(plan_tier) AS pharmacy_plan_tier, count(*) AS pharmacy_info_match_count FROM fct_info GROUP BY 1) USING (patient_global_id)
  LEFT JOIN (SELECT patient_global_id, count(*) AS lab_result_count, max(test_date) AS most_recent_lab_date, count(*) FILTER (abnormal_flag != 'normal') AS abnormal_lab_count FROM fct_labs GROUP BY 1) USING (patient_global_id)""",
    "agg_dedup_metrics": f"""SELECT (SELECT count(*) FROM patients) AS total_source_records, (SELECT count(*) FROM golden) AS total_golden_records, {_EVENT_COUNTS},
  max(source_record_count) AS max_cluster_size, round(avg(source_record_count), 6) AS avg_cluster_size, round(1 - (SELECT count(*) FROM golden) / (SELECT count(*) FROM patients), 6) AS dedup_rate FROM per""",
    "top_members": "SELECT * FROM per ORDER BY source_record_count DESC, patient_global_id LIMIT 200",
    "member_search": "SELECT g.*, source_record_count FROM golden g JOIN per USING (patient_global_id) WHERE upper(last_name) LIKE '%SON%' ORDER BY source_record_count DESC, patient_global_id LIMIT 200",
    "member_claims_page": "SELECT * FROM fct ORDER BY claim_key LIMIT 20 OFFSET 40",
    "member_page": "SELECT * FROM fct_rx WHERE patient_global_id = (SELECT id FROM one_member) ORDER BY rx_key LIMIT 20 OFFSET 5",
    "member_summary": " UNION ALL ".join(f"SELECT '{d}' AS domain, count(*) AS total FROM {f} WHERE patient_global_id = (SELECT id FROM one_member)" for d, (_, f) in _FACTS.items()),
    "eligibility": "SELECT a.source_vendor, a.source_record_id, first_name, last_name, dob, gender, right(ssn, 4) AS ssn_last4 FROM alt a LEFT JOIN patients p ON p.source_vendor = a.source_vendor AND p.source_record_id = a.source_record_id WHERE patient_global_id = (SELECT id FROM one_member)",
    "snapshot_scd2": """SELECT patient_global_id, first_name, CASE WHEN patient_global_id LIKE '%3' THEN 'FORMER' ELSE last_name END AS last_name, gender, '2024-01-01' AS valid_from, CASE WHEN patient_global_id LIKE '%3' AND last_name IS DISTINCT FROM 'FORMER' THEN '2024-06-30' END AS valid_to FROM golden WHERE patient_global_id NOT LIKE '%7'
  UNION ALL SELECT patient_global_id, first_name, last_name, gender, '2024-06-30', NULL FROM golden WHERE patient_global_id LIKE '%7' OR patient_global_id LIKE '%3'""",
    "quality_checks": f"""SELECT check_name, CASE WHEN ok THEN 'pass' ELSE 'warn' END AS status, value::DOUBLE AS value FROM (
  SELECT 'dedup_rate' AS check_name, v AS value, v BETWEEN 0 AND 0.9 AS ok FROM (SELECT round(1 - count(*) / sum(source_record_count), 6) AS v FROM per)
  UNION ALL SELECT 'review_queue_rate', v, v <= 0.5 FROM (SELECT round(count(*) FILTER ({_REVIEW}) / count(*), 6) AS v FROM scored)
  UNION ALL SELECT 'block_skew', v, v <= 0.05 FROM (SELECT round(max(record_count) / sum(record_count), 6) AS v FROM sizes)
  UNION ALL SELECT 'dob_plausibility', v, v = 0 FROM (SELECT count(*) FILTER (dob_year < 1900 OR dob_year > 2024) AS v FROM patients)
  UNION ALL SELECT 'cluster_size', v, v <= 10 FROM (SELECT max(source_record_count) AS v FROM per))""",
    "structural_gates": " UNION ALL ".join(f"SELECT '{g}' AS gate, ({body}) AS violations" for g, body in GATES.items()),
    **{f"fct_{d}": f"SELECT * FROM {f}" for d, (_, f) in _FACTS.items()},
}

SQL = {name: f"{PRELUDE}{body}" for name, body in BODIES.items()}
