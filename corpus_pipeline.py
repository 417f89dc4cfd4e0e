"""Corpus pipeline: documents to packed training sequences.

``STAGES`` run in order, each over all rows its predecessor kept, written as
Parquet in the shared folder and read again: toxic documents go; one document of
each SimHash class stays; documents that hold a benchmark item go; personal
data is redacted; what is left is packed. Every stage but the last returns the
columns of its input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import decontam, packing, pii, simhash, tokens, toxicity
from martlet.llm.common import quoted, staged, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows scored below the rejection threshold; the lexicon is learnt from
    the labels that are not held out."""
    model = toxicity.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    row = F.struct(*[quoted(c) for c in docs.columns]).alias("row")
    scored = docs.select(row, model.score_column(F.col("text")).alias("score"))
    return scored.where(F.col("score") < toxicity.REJECT_FROM).select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of four-word SimHashes linked at up to four bits."""
    return simhash.keep_one(docs, shingle=4, max_distance=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item is found."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark"), verbatim=True)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, personal data replaced by its kind; ``n_chars`` follows."""
    model = pii.fit(docs)
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(pii.redacted_column(F.col("text"), model).alias("text"))
        else:
            columns.append(quoted(c))
    out = docs.select(*columns)
    if "n_chars" in out.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(
            *[quoted(c) for c in docs.columns]
        )
    return out


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2,048 tokens with their ids."""
    return packing.pack(docs, tokens.tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return staged(STAGES[-1][1](spark, docs, sf_dir), "pipeline-packing")


#: Learnt models, fingerprints and packing are beyond SQL; tests/llm holds the
#: pipeline against a step-by-step version.
ORACLE_SQL = None
