"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.session import work_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared checkpoint folder, removed when the
    session's work folders are released."""
    return work_path(spark, f"llm-{label}")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, so a lost
    executor never recomputes the work before it, and gives the planner the
    real size for its broadcast decision."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the text operators read, under fixed names; whatever
    else the input carries cannot clash with working columns."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node on an edge; root is the smallest node of its
    component.

    ``edges`` has two long columns ``u`` and ``v``; loops and repeats are
    harmless. Alternating large-star and small-star rounds, each a partial
    aggregate and an equi-join, until the edge set is a set of stars; every
    round is written to the shared folder. Rounds grow with the logarithm of
    the longest chain, and nothing but two numbers a round reaches the driver.
    """

    def large_star(e: DataFrame) -> DataFrame:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        side = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return side.union(low.select("u", F.col("m").alias("v")))

    def state(e: DataFrame) -> tuple:
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    edges = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
    current = staged(small_star(edges).distinct(), "edges")
    seen = state(current)
    while seen[0]:
        current = staged(small_star(large_star(current)).distinct(), "edges")
        now = state(current)
        if now == seen:
            break
        seen = now
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
