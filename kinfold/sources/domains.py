"""Fact and match-path feeds, derived from the test tables like the vendors' records.

``k`` is the customer's number. Claims come from vendors A and B, encounters and fills from A
and C; two files without any shared id (a pharmacy's members and a laboratory's patients) hold
some customers under names, dates and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinfold.functions.clean import clean_name, phonetic_key, standard_gender
from kinfold.sources.feeds import FIRST, LAST, read

PLANS = ("bronze", "silver", "gold", "platinum")
ENCOUNTERS = ("office_visit", "hospitalization", "diagnosis_only", "telehealth", "urgent_care")
STATUSES = ("paid", "denied", "pending")
#: Files whose records are matched, not joined, and the vendor that delivers each.
MATCHED = {"pharmacy_info": "VENDOR_B_PHARMACY", "lab_identity": "VENDOR_D"}


def _pick(values: tuple[str, ...] | list[str], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))


def _id(k: Column) -> Column:
    return F.lpad(k.cast("string"), 8, "0")


def medical_history(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").select("event_id", "ts", (F.col("user_id") * 10 + F.col("event_id") % 10).alias("k"))
    return e.select(
        F.when(F.col("k") % 3 == 1, "VENDOR_C").otherwise("VENDOR_A").alias("source_vendor"), F.concat(F.lit("E"), F.col("event_id").cast("string")).alias("source_encounter_id"), _id(F.col("k")).alias("member_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("encounter_date"), F.concat(F.lit("C"), (F.col("event_id") % 97).cast("string")).alias("condition_code"), _pick(ENCOUNTERS, F.col("event_id") % 5).alias("encounter_type"),
    )


def medical_claims(spark: SparkSession, sf: str) -> DataFrame:
    o = read(spark, sf, "orders")
    n, k = F.col("o_orderkey"), F.col("o_custkey")
    return o.select(
        F.when(k % 3 == 1, "VENDOR_B").otherwise("VENDOR_A").alias("source_vendor"), n.cast("string").alias("source_claim_id"), _id(k).alias("member_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("claim_date"),
        F.concat(F.lit("D"), (n % 89).cast("string")).alias("diagnosis_code"), F.concat(F.lit("P"), (n % 61).cast("string")).alias("procedure_code"),
        F.round("o_totalprice", 2).alias("billed_amount"), F.when(n % 3 == 0, F.round("o_totalprice", 2)).otherwise(0.0).alias("paid_amount"), _pick(STATUSES, n % 3).alias("claim_status"),
    )


def pharmacy_claims(spark: SparkSession, sf: str) -> DataFrame:
    li = read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate")
    fills = li.join(read(spark, sf, "orders").select("o_orderkey", "o_custkey").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))  # two numbers a row: a few MB of a file are millions of rows
    k = F.col("o_custkey")
    return fills.select(
        F.when(k % 3 == 1, "VENDOR_C").otherwise("VENDOR_A").alias("source_vendor"), F.concat_ws("-", *[c.cast("string") for c in (F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"), F.round(F.col("l_extendedprice") * 100).cast("long"))]).alias("source_rx_id"),
        F.concat(F.lit("P"), k.cast("string")).alias("pbm_member_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("fill_date"), F.concat(F.lit("N"), F.col("l_partkey").cast("string")).alias("ndc_code"),
        ((F.col("l_quantity").cast("int") % 3 + 1) * 30).cast("long").alias("days_supply"), F.col("l_quantity").cast("long").alias("quantity"),
    )


def vendor_id_map(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    return read(spark, sf, "customer").select(F.when(k % 3 == 1, "VENDOR_C").otherwise("VENDOR_A").alias("source_vendor"), F.concat(F.lit("P"), k.cast("string")).alias("pbm_member_id"), _id(k).alias("enrollment_member_id"))


def matched_identities(spark: SparkSession, sf: str, domain: str) -> DataFrame:
    """A file of persons without ids: names as in the vendors' feeds, some with errors, ISO dates."""
    k = F.col("c_custkey").cast("long")
    keep = k % 2 == 0 if domain == "pharmacy_info" else k % 3 != 0
    whole = lambda text: F.expr(text.replace("k", "cast(c_custkey as bigint)"))
    first = _pick(FIRST, whole(f"(k * 31 + k div 7) % {len(FIRST)}"))
    last = _pick(LAST, whole(f"(k * 7919 + k div 97) % {len(LAST)}"))
    swapped = F.concat(F.substring(last, 1, 1), F.substring(last, 3, 1), F.substring(last, 2, 1), F.substring(last, F.lit(4), F.lit(20)))
    born = F.date_add(F.lit("1950-01-01").cast("date"), whole("k * 15485863 div 11 % 9000").cast("int") + F.when(k % 20 == 14, 1).otherwise(0))
    sex = F.when(whole("(k * 104729 div 7) % 2") == 0, "m").otherwise("F ")
    return read(spark, sf, "customer").where(keep).select(
        _id(k).alias("source_record_id"), F.concat(F.lit(" "), F.lower(first)).alias("first_name"), F.when(k % 20 == 8, swapped).when(k % 20 == 18, "QUIXOTE").otherwise(last).alias("last_name"),
        F.date_format(born, "yyyy-MM-dd").alias("dob"), sex.alias("gender"), F.concat(k.cast("string"), F.lit(" Main St")).alias("address"), F.concat(F.lit("555"), F.lpad(k.cast("string"), 7, "0")).alias("phone"),
        *([_pick(PLANS, k % 4).alias("plan_tier")] if domain == "pharmacy_info" else []),
    )


def lab_results(spark: SparkSession, sf: str) -> DataFrame:
    e = read(spark, sf, "events").withColumn("k", F.col("user_id") * 10 + F.col("event_id") % 10)
    n = F.col("event_id") % 20
    return e.select(
        _id(F.col("k")).alias("source_record_id"), F.date_format("ts", "yyyy-MM-dd").alias("test_date"), F.col("event_type").alias("test_code"), F.format_string("%.4f", F.round("value", 4)).alias("result_value"),
        F.lit("mg/dL").alias("result_unit"), F.when(n < 14, "normal").when(n < 17, "high").when(n < 19, "low").otherwise("critical").alias("abnormal_flag"), "event_id",
    )


# What the feeds become in the common schema.


def medical_history_normalized(feed: DataFrame) -> DataFrame:
    return feed.select("source_vendor", F.concat("source_vendor", F.lit(":"), "source_encounter_id").alias("encounter_key"), "source_encounter_id", "member_id", F.try_to_date("encounter_date", "yyyy-M-d").alias("encounter_date"), "condition_code", "encounter_type")


def medical_claims_normalized(feed: DataFrame) -> DataFrame:
    return feed.select("source_vendor", F.concat("source_vendor", F.lit(":"), "source_claim_id").alias("claim_key"), "source_claim_id", "member_id", F.try_to_date("claim_date", "yyyy-M-d").alias("claim_date"), "diagnosis_code", "procedure_code", "billed_amount", "paid_amount", "claim_status")


def pharmacy_claims_normalized(feed: DataFrame) -> DataFrame:
    return feed.select("source_vendor", F.concat("source_vendor", F.lit(":"), "source_rx_id").alias("rx_key"), "source_rx_id", "pbm_member_id", F.try_to_date("fill_date", "yyyy-M-d").alias("fill_date"), "ndc_code", "days_supply", "quantity")


def identity_normalized(feed: DataFrame, domain: str) -> DataFrame:
    """A matched file's persons in the schema of the vendors' records, without SSN."""
    vendor, born = F.lit(MATCHED[domain]), F.try_to_date(F.trim("dob"), "yyyy-M-d")
    extra = [c for c in ("address", "phone", "plan_tier") if c in feed.columns]
    return feed.select(
        vendor.alias("source_vendor"), "source_record_id", F.concat(vendor, F.lit(":"), "source_record_id").alias("record_key"), clean_name(F.col("first_name")).alias("first_name"), clean_name(F.col("last_name")).alias("last_name"),
        born.alias("dob"), standard_gender(F.col("gender")).alias("gender"), F.lit(None).cast("string").alias("ssn"), phonetic_key(F.col("first_name")).alias("first_name_phonetic"), phonetic_key(F.col("last_name")).alias("last_name_phonetic"),
        F.year(born).alias("dob_year"), *extra,
    )


def lab_results_normalized(feed: DataFrame) -> DataFrame:
    """Results numbered within a record, in the order of date, code, value text and event."""
    n = F.row_number().over(Window.partitionBy("source_record_id").orderBy("test_date", "test_code", "result_value", "event_id"))
    number = F.col("result_value").try_cast("double")
    return feed.select(F.concat_ws(":", "source_record_id", n.cast("string")).alias("lab_result_key"), "source_record_id", F.try_to_date("test_date", "yyyy-M-d").alias("test_date"), "test_code", number.alias("result_value"), "result_unit", "abnormal_flag")


def domain_of(key: Column) -> Column:
    """The file that a record key belongs to; a key of another prefix is an error."""
    out = F.when(F.lit(False), F.lit(""))
    for domain, vendor in MATCHED.items():
        out = out.when(key.startswith(vendor + ":"), domain)
    return out.otherwise(F.raise_error(F.concat(F.lit("no domain for record key "), F.coalesce(key, F.lit("null")))))
