"""A training corpus from ``documents``: STAGES in order, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.llm import jaccard_join, langid, line_windows, mixing, packing
from kinfold.llm.tables import free
from kinfold.session import materialize, release

#: A document is rejected as being in no known language below this share of words.
LEAST_SHARE = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Set ``lang`` to the language found.

    Documents without any (null, empty, no letters), or of which less than ``LEAST_SHARE`` of
    the words are in it, go. Repeated rows and rows with null ids are judged like others.
    """
    names = tuple(free(c, docs.columns) for c in ("lang_pred", "score", "spans"))
    found = langid.identify(docs, langid.fit_documents(docs), docs.columns, names=names)
    kept = found.where((F.col(names[0]) != "und") & (F.col(names[1]) >= LEAST_SHARE))
    return kept.withColumn("lang", F.col(names[0])).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove later occurrences of three-line passages; documents that nothing is left of go.

    Rows equal in id and text are one document and stay as many as they are; null ids are
    kept, and null texts (which nothing was removed from).
    """
    lines, removed = (free(c, docs.columns) for c in ("lines", "removed"))
    cut = line_windows.dedup_lines(docs, names=(lines, removed))
    left = cut.where((F.col(removed) == 0) | F.col("text").rlike(line_windows.WORD))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays, whatever the ids."""
    return jaccard_join.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as the mix takes it, also where ids are null or repeated."""
    row, of = free("row", docs.columns), free("of", docs.columns)
    rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")  # written, so that numbers stay
    mixed = mixing.mix(rows, carry=row).where("copies > 0").select(F.struct(F.col(row).alias("row"), "copies").alias(of))
    copies = materialize(mixed, "copies").hint("merge")  # the same plan at every size
    repeated = rows.join(copies, F.col(row) == F.col(of)["row"])
    return repeated.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(of)["copies"])).alias(of)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048; null texts count as empty, repeated rows are packed as often as they occur."""
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_duplicates", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: Tokens, language scores and packing are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), name)
        release(before)
    return docs
