"""File sources: positional, explicitly typed CSV and Parquet scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.schemas import BRONZE


#: What the reader turns a quoted empty field into, before it becomes "".
EMPTY_MARKER = "\u0001empty"
#: Stands for NULL in files this library writes; an unquoted empty field is NULL
#: as well, a quoted one ("") is the empty text, as in the source system's loader.
NULL_MARKER = "\\N"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Comma-separated file with a header line that is skipped, not matched.

    Columns are bound by position to ``schema`` (the header may use other
    names), nothing is inferred, an unquoted empty field and ``NULL_MARKER`` are
    NULL, a quoted empty field is the empty text, and a malformed row fails the
    job unless ``mode`` says otherwise.
    """
    if isinstance(schema, str):
        schema = BRONZE[schema]
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    raw = (
        spark.read.schema(text)
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", ",")
        .option("escape", '"')
        .option("mode", mode)
        .option("nullValue", NULL_MARKER)
        .option("emptyValue", EMPTY_MARKER)
        .csv(path)
    )

    def typed(f: T.StructField):
        # the parser gives NULL or "" for a field left out and the marker for a quoted empty one
        value = F.when(F.col(f.name) != NULL_MARKER, F.nullif(F.col(f.name), F.lit("")))
        if isinstance(f.dataType, T.StringType):
            return F.when(F.col(f.name) == EMPTY_MARKER, F.lit("")).otherwise(value).alias(f.name)
        # a value of the wrong type fails the job as a malformed row does, or is NULL
        return (value.cast(f.dataType) if mode == "FAILFAST" else value.try_cast(f.dataType)).alias(f.name)

    return raw.select(*[typed(f) for f in schema.fields])


def write_csv(df: DataFrame, path: str) -> None:
    """Header and rows, NULL as ``NULL_MARKER``, empty texts quoted."""
    (
        df.write.option("header", True)
        .option("escape", '"')
        .option("nullValue", NULL_MARKER)
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Full table scan; column pruning and filters reach the reader via Catalyst."""
    return spark.read.parquet(path)
