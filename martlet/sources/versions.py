"""Tables in write-once folders, switched by one commit record.

A versioned table has a root folder. A load writes new data to folders of its own
under the root, then commits: it writes the manifest, a line for each slice of data (its
name, folder, rows and digest), as ``_commits/<n>.json`` under another name first
and renames it. The manifest with the highest number is the table; readers hold
the folders it names. Data folders are never rewritten, so a load that
fails, or is killed, before its commit leaves the table as it was, and slices that
a load does not touch keep their files. One loader at a time: a version that
somebody else has committed meanwhile is refused. ``vacuum`` removes data that the
newest manifest does not name.

A digest is the sum of the rows' hashes: it does not depend on order or files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

@dataclass(frozen=True)
class Slice:
    slice: str
    path: str
    row_count: int
    digest: str


def _file_system(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def newest_version(spark: SparkSession, root: str) -> int | None:
    """The highest committed version of a table; None for a new one."""
    fs, folder = _file_system(spark, f"{root}/_commits")
    if not fs.exists(folder):
        return None
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=None)


def manifest(spark: SparkSession, root: str) -> tuple[int | None, dict[str, Slice]]:
    """The committed version and its slices by name; (None, {}) for a new table."""
    version = newest_version(spark, root)
    if version is None:
        return None, {}
    return version, {s.slice: s for s in _slices(spark, root, version)}


def _slices(spark: SparkSession, root: str, version: int) -> list[Slice]:
    fs, at = _file_system(spark, f"{root}/_commits/{version}.json")
    stream = fs.open(at)
    try:
        lines = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").splitlines()
    finally:
        stream.close()
    return [Slice(**json.loads(line)) for line in lines]


def commit(spark: SparkSession, root: str, version: int, slices: list[Slice]) -> None:
    """Make ``slices`` the table. Raises if ``version`` has been committed."""
    fs, at = _file_system(spark, f"{root}/_commits/{version}.json")
    _, draft = _file_system(spark, f"{root}/_commits/{version}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray("".join(json.dumps(asdict(s)) + "\n" for s in slices).encode()))
    finally:
        stream.close()
    newest = newest_version(spark, root)
    if newest is not None and newest >= version or not fs.rename(draft, at):
        fs.delete(draft, False)
        raise RuntimeError(f"{root}: version {version} was committed by another load")


def read_slices(spark: SparkSession, slices: list[Slice], schema: T.StructType) -> DataFrame:
    """The rows of the given slices."""
    if not slices:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[s.path for s in slices])


def digest(columns: list[str]) -> Column:
    """Order-free digest of a group of rows, as text."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in columns]).cast("decimal(38,0)")
    return F.coalesce(F.sum(row), F.lit(0).cast("decimal(38,0)")).cast("string")


def measured(df: DataFrame, slice_of: Column) -> list[tuple[str, int, str]]:
    """Name, rows and digest of every slice of ``df``: one row each."""
    rows = df.groupBy(slice_of.alias("_slice")).agg(F.count(F.lit(1)).alias("n"), digest(df.columns).alias("d")).collect()
    return [(r["_slice"], r["n"], r["d"]) for r in rows]


def write_folders(df: DataFrame, slice_of: Column, folder: str) -> None:
    """Write ``df`` with a sub-folder for each slice. Rows meet by slice before
    they are written, and large slices are split again, so that a slice has few
    files however many tasks hold some of it."""
    named = df.withColumn("_slice", slice_of)
    named.hint("rebalance", "_slice").write.partitionBy("_slice").parquet(folder)


def slice_path(folder: str, name: str) -> str:
    return f"{folder}/_slice={name}"


def new_folder(root: str, version: int) -> str:
    """A folder for the data of a version; a second try gets another one."""
    return f"{root}/run-{version}-{uuid.uuid4().hex[:12]}"


def written(spark: SparkSession, folder: str, schema: T.StructType) -> list[Slice]:
    """The slices that ``write_folders`` left in ``folder``, measured from the files."""
    full = T.StructType([*schema.fields, T.StructField("_slice", T.StringType())])
    rows = spark.read.schema(full).parquet(folder).groupBy("_slice")
    found = rows.agg(F.count(F.lit(1)).alias("n"), digest(schema.names).alias("d")).collect()
    return [Slice(r["_slice"], slice_path(folder, r["_slice"]), r["n"], r["d"]) for r in found]


def remove(spark: SparkSession, folder: str) -> bool:
    fs, at = _file_system(spark, folder)
    return bool(fs.delete(at, True))


class RowCountVariance(RuntimeError):
    """A load's row counts are too far from those of the load before."""


def variance(before: int | None, now: int | None) -> float | None:
    """Share by which a row count changed; a table that is gone has no rows, and
    one that is new, or was empty, has nothing to be compared with."""
    if not before:
        return None
    return abs((now or 0) - before) / before


class Load:
    """Several tables written one after the other and committed together: readers
    see all of them in their new state or all in the old one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        version, self.before = manifest(spark, root)
        self.version = 0 if version is None else version + 1
        self.folder = new_folder(root, self.version)
        self.tables: dict[str, Slice] = {}

    def write(self, name: str, df: DataFrame) -> str:
        """Write a table, counted on the way; returns its folder."""
        rows = Observation()
        path = f"{self.folder}/{name}"
        df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
        self.tables[name] = Slice(name, path, int(rows.get.get("n", 0)), "")
        return path

    def commit(self, max_variance: float | None = None) -> None:
        """Switch readers to what was written. With ``max_variance``, a table whose
        row count changed by more, against the load before, refuses the load."""
        if max_variance is not None:
            for name in sorted(self.before.keys() | self.tables.keys()):
                old, new = (t[name].row_count if name in t else None for t in (self.before, self.tables))
                if (changed := variance(old, new)) is not None and changed > max_variance:
                    raise RowCountVariance(f"{name}: {old} rows before, {new or 0} now; more than {max_variance:.1%} apart")
        commit(self.spark, self.root, self.version, list(self.tables.values()))


def history(spark: SparkSession, root: str) -> list[tuple[int, Slice]]:
    """Every table of every committed load, oldest first."""
    newest = newest_version(spark, root)
    return [(v, s) for v in range((newest if newest is not None else -1) + 1) for s in _slices(spark, root, v)]


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete data folders that the current manifest does not name; the manifests
    stay, as the history of the loads. Only when no reader holds an older version.
    Returns how many folders went."""
    version, slices = manifest(spark, root)
    if version is None:
        return 0
    fs, at = _file_system(spark, root)
    path = spark._jvm.org.apache.hadoop.fs.Path
    kept = {fs.makeQualified(path(s.path)).toString() for s in slices.values()}
    gone = 0
    for run in fs.listStatus(at):
        if not run.getPath().getName().startswith("run-"):
            continue
        children = [c.getPath() for c in fs.listStatus(run.getPath()) if c.isDirectory()]
        for child in children:
            if fs.makeQualified(child).toString() not in kept:
                gone += bool(fs.delete(child, True))
    return gone
