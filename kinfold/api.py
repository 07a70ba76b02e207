"""What a service asks of the serving tables: members, their domains' pages, lookups of new records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.functions.clean import clean_name, digits, phonetic_key, standard_gender
from kinfold.operators import blocks, identity
from kinfold.operators.matching import FIELDS
from kinfold.session import materialize

#: Domains of a member's pages, and the columns that order their rows.
DOMAINS = {"medical_history": ["encounter_key"], "medical_claims": ["claim_key"], "pharmacy_claims": ["rx_key"], "pharmacy_info": ["source_record_id"], "lab_results": ["lab_result_key"]}


def normalize_records(records: DataFrame) -> DataFrame:
    """Records as a caller types them in the schema of ``patient_normalized``.

    ``records``: text columns ``record_key`` and the five fields, dates as ``yyyy-MM-dd``.
    Blank texts are null; dates that are none are null.
    """
    blank = lambda c: F.nullif(F.trim(F.coalesce(c, F.lit(""))), F.lit(""))
    first, last = blank(clean_name(F.col("first_name"))), blank(clean_name(F.col("last_name")))
    born = F.try_to_date(F.trim("dob"), "yyyy-M-d")
    return records.select("record_key", first.alias("first_name"), last.alias("last_name"), born.alias("dob"), standard_gender(F.col("gender")).alias("gender"), digits(F.col("ssn")).alias("ssn"), phonetic_key(first).alias("first_name_phonetic"), phonetic_key(last).alias("last_name_phonetic"), F.year(born).alias("dob_year"))


def resolve(batch: DataFrame, core: DataFrame, known: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """``(record_key, outcome, patient_global_id, match_score)``: one row for every record of ``batch``.

    Candidates are the core records that share any of the four blocking keys, however many.
    The best automatic match (of equal scores the smallest key) gives its identity in the
    crosswalk ``known``; a record without one, also one without candidates (whose
    ``match_score`` is null), gets an id of its own after the last that ``known`` and
    ``events`` hold, in the order of the records' keys.
    """
    # Records equal in all that is compared share candidates and scores: one of each stands for them.
    profile = F.to_json(F.struct(*FIELDS)).alias("profile")
    mine, theirs = [materialize(r.groupBy(profile).agg(F.min("record_key").alias("rep")), "profiles") for r in (batch, core)]
    news, olds = [materialize(r.join(p, r["record_key"] == p["rep"], "left_semi"), "reps") for r, p in ((batch, mine), (core, theirs))]
    pairs = blocks.Blocks(blocks.rows(blocks.numbered(news)), blocks.rows(blocks.numbered(olds)))
    best = pairs.best(best=F.lit(True))
    found = mine.join(best, mine["rep"] == best["record_key_a"]).select("profile", "best.*")
    every = batch.select("record_key", profile).join(found, "profile", "left")
    every = every.select("record_key", F.col("score").alias("match_score"), F.when(F.col("auto"), F.col("record_key_b")).alias("match"))
    ids = known.select(F.col("record_key").alias("match"), "patient_global_id")
    every = materialize(every.join(ids, "match", "left").drop("match"), "matches")
    new = every.where("patient_global_id is null").drop("patient_global_id")
    clusters = new.select("record_key", F.col("record_key").alias("cluster"))
    minted = identity.crosswalk(clusters, known.limit(0), "batch", identity.next_number(known, events))[0]
    created = new.join(minted, "record_key").select("record_key", F.lit("created").alias("outcome"), "patient_global_id", "match_score")
    return every.where("patient_global_id is not null").select("record_key", F.lit("matched").alias("outcome"), "patient_global_id", "match_score").unionByName(created)


def member_summary(view: DataFrame, facts: dict[str, DataFrame], member: str) -> DataFrame:
    """``(domain, total)`` of a member; a member that is not in ``view`` is an error."""
    if view.where(F.col("patient_global_id") == member).isEmpty():
        raise LookupError(f"no member {member}")
    out = None
    for domain, table in facts.items():
        row = table.where(F.col("patient_global_id") == member).agg(F.count("*").alias("total")).select(F.lit(domain).alias("domain"), "total")
        out = row if out is None else out.unionByName(row)
    return out


def member_page(facts: dict[str, DataFrame], domain: str, member: str, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of a member's rows in a domain, in the order of the domain's keys."""
    if domain not in facts:
        raise KeyError(f"no domain {domain}")
    if not 1 <= limit <= 500 or offset < 0:
        raise ValueError("limit must be from 1 to 500 and offset not negative")
    return facts[domain].where(F.col("patient_global_id") == member).orderBy(*DOMAINS[domain]).offset(offset).limit(limit)


def search_members(view: DataFrame, last_name: str, limit: int = 200) -> DataFrame:
    """Members whose last name holds a text, in any case of letters: those with the most records first."""
    return view.where(F.upper("last_name").contains(last_name.upper())).orderBy(F.desc("source_record_count"), "patient_global_id").limit(limit)


def eligibility(alternate: DataFrame, records: DataFrame, member: str) -> DataFrame:
    """The vendors' records behind a member, with what each of them says."""
    mine = alternate.where(F.col("patient_global_id") == member).select("source_vendor", "source_record_id")
    said = records.select("source_vendor", "source_record_id", "first_name", "last_name", "dob", "gender", F.right("ssn", F.lit(4)).alias("ssn_last4"))
    return mine.join(said, ["source_vendor", "source_record_id"], "left").orderBy("source_vendor", "source_record_id")


def review_records(queue: DataFrame, records: DataFrame) -> DataFrame:
    """The review queue with both records of each pair, highest scores first."""
    out = queue
    for side in "ab":
        said = records.select(F.col("record_key").alias(f"record_key_{side}"), *[F.col(c).alias(f"{side}_{c}") for c in ("first_name", "last_name", "dob", "source_vendor")])
        out = out.join(said, f"record_key_{side}")
    return out.orderBy(F.desc("score"), "record_key_a", "record_key_b")
