"""Files of other writers: typed rows to one side, rejected lines to the other.

``parse_csv`` reads every line and says why it cannot be a row of the schema: fewer
or more fields than columns, or fields that are not of their column's type. ``split_csv``
parses once, writes both sides to one staged table, unsorted, and gives
the typed rows and the quarantined lines with file, reason and the line as it stood,
so that they can be mended and delivered again. Together they are all lines.

Fields follow ``files.read_csv``: positional, comma-separated, quotes doubled inside
quotes, an unquoted empty field NULL, a quoted one the empty text. One line is one
row (no line breaks inside quotes), the first line of each file is its header, blank
lines are skipped. Texts are never of a wrong type; a number with more decimals than
its column has is rounded, one with too many digits is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.schemas import BRONZE
from martlet.session import work_path
from martlet.sources.files import EMPTY_MARKER, NULL_MARKER

#: Columns beside those of the schema.
LINE, FILE, REASON = "_line", "_file", "_reason"
#: Never part of a text file, so that the reader hands out whole lines.
NO_SEPARATOR = "\u0000"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``_line`` and ``_file`` of every line but the files' first."""
    lines = (
        spark.read.schema(f"{LINE} string, _whole string")
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", NO_SEPARATOR)
        .option("quote", "")
        .option("maxCharsPerColumn", -1)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_whole")
        .csv(path)
    )
    line = F.coalesce("_whole", LINE)
    return lines.select(line.alias(LINE), F.col("_metadata.file_path").alias(FILE)).where(F.length(F.trim(LINE)) > 0)


def field_count(line: Column) -> Column:
    """Fields of a line: the commas outside quotes and one."""
    # a doubled quote ends one quoted part and starts the next, so both go
    bare = F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"[^"]*+"', "")).otherwise(line)
    return F.octet_length(bare) - F.octet_length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def parse_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The schema's columns with ``_line``, ``_file`` and ``_reason``, which is
    null for a good row; the columns of a rejected line are all null."""
    if isinstance(schema, str):
        schema = BRONZE[schema]
    text = ", ".join(f"c{i} string" for i in range(len(schema)))
    options = {"sep": ",", "escape": '"', "mode": "PERMISSIVE", "nullValue": NULL_MARKER, "emptyValue": EMPTY_MARKER}
    parsed = read_lines(spark, path).select(
        LINE, FILE, field_count(F.col(LINE)).alias("_n"), F.from_csv(LINE, text, options).alias("_f")
    )
    # a step at a time: one projection of all of it is too long a method for the JIT
    # compiler, and texts and types would be worked out again at each use
    kept = [LINE, FILE, "_n"]
    texts = []
    for i, f in enumerate(schema.fields):
        field = F.col(f"_f.c{i}")
        value = F.when(field != NULL_MARKER, F.nullif(field, F.lit("")))
        if isinstance(f.dataType, T.StringType):
            value = F.when(field == EMPTY_MARKER, F.lit("")).otherwise(value)
        texts.append(value.alias(f"_t{i}"))
    others = {i: f for i, f in enumerate(schema.fields) if not isinstance(f.dataType, T.StringType)}
    typed = parsed.select(*kept, *texts).select(
        "*", *[F.col(f"_t{i}").try_cast(f.dataType).alias(f"_v{i}") for i, f in others.items()]
    )
    wrong = [F.when(F.col(f"_t{i}").isNotNull() & F.col(f"_v{i}").isNull(), F.lit(f.name)) for i, f in others.items()]
    types = F.array_join(F.array(*wrong), ", ") if wrong else F.lit("")
    values = [f"_v{i}" if i in others else f"_t{i}" for i in range(len(schema))]
    typed = typed.select(*kept, *values, types.alias("_types"))
    reason = (
        F.when(F.col("_n") < len(schema), F.lit("too few fields"))
        .when(F.col("_n") > len(schema), F.lit("too many fields"))
        .when(F.col("_types") != "", F.concat(F.lit("type of "), "_types"))
    )
    judged = typed.select(LINE, FILE, *values, reason.alias(REASON))
    good = F.col(REASON).isNull()
    return judged.select(
        *[F.when(good, F.col(v)).alias(f.name) for v, f in zip(values, schema.fields)], LINE, FILE, REASON
    )


def split_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantined lines): one scan, both read from a staged table."""
    if isinstance(schema, str):
        schema = BRONZE[schema]
    both = work_path(spark, "csv-split")
    rows = parse_csv(spark, path, schema)
    # a good row needs no copy of its line
    line = F.when(F.col(REASON).isNotNull(), F.col(LINE))
    rows.withColumn(LINE, line).write.parquet(both)
    kinds = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    for name in (LINE, FILE, REASON):
        kinds = kinds.add(name, T.StringType())
    stored = spark.read.schema(kinds).parquet(both)
    good = stored.where(F.col(REASON).isNull()).select(*[f.name for f in schema.fields])
    rejected = stored.where(F.col(REASON).isNotNull()).select(FILE, REASON, LINE)
    return good, rejected
