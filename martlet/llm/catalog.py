"""The registered queries of this subpackage: name -> fn(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import (
    bm25, chat, decontam, language, packing, pii, repair, secrets, simhash, token_files, tokens, toxicity, vector_codes, warc,
)
from martlet.llm.common import scratch, table


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"), path_col="source")
    return found.select(
        "doc_id",
        "start",
        "end",
        F.sha2("candidate", 256).alias("candidate_sha256"),
        "probability",
        F.col("is_secret").cast("int").alias("is_secret"),
    )


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokens.tokenizer_path())
    return token_files.token_digests(spark, path)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokens.tokenizer_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("token_ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, pii.BASE_KINDS),
        F.sha2(pii.spans_text(base), 256).alias("base_sha256"),
        pii.spans_text(F.col("spans")).alias("spans"),
    )


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.rotate(table(spark, sf_dir, "conversations"))
    return rows.withColumn("loss_spans", chat.spans_text(F.col("loss_spans")))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_on_labels(docs, table(spark, sf_dir, "labels"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), model.score_column(F.col("text")).alias("score")
    )
    return rows.select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.REJECT_FROM).cast("int").alias("predicted"),
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    index = warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.read_records(index, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "bm25")
    bm25.build_index(table(spark, sf_dir, "documents"), path)
    return bm25.search(path, bm25.self_queries(spark, path), k=10)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_distance=4)
    return rows.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), verbatim=True
    )
    return found.drop("tie").withColumn("reparameterised", F.col("reparameterised").cast("int"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(rows), ids=rows.select("conv_id"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs))
    return found.withColumn("rejected", F.col("rejected").cast("int"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secrets": op1_secrets,
    "op2_token_files": op2_token_files,
    "op3_packing": op3_packing,
    "op4_pii": op4_pii,
    "op5_chat": op5_chat,
    "op6_toxicity": op6_toxicity,
    "op7_warc": op7_warc,
    "op8_bm25": op8_bm25,
    "op9_simhash": op9_simhash,
    "op10_decontam": op10_decontam,
    "op11_repair": op11_repair,
    "op12_vector_codes": op12_vector_codes,
    "op13_language": op13_language,
}

#: Queries that SQL can state; the others are tested against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op5_chat": chat.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op11_repair": repair.ORACLE_SQL,
    "op12_vector_codes": vector_codes.ORACLE_SQL,
}
