"""Session construction and the shared checkpoint folder.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names
(shared storage). Only when the session has none *and* runs in local mode do we
create one of our own, as tests and the local bench need.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# (session, folder) of everything staged by this process
_STAGED: list[tuple[SparkSession, str]] = []

# Settings every mart session wants: AQE for runtime re-planning (coalescing,
# skew-join splitting, runtime broadcast by measured size), UTC so dates derived
# from timestamps do not shift, and no web UI.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str = "local[8]",
    shuffle_partitions: int = 8,
    app_name: str = "martlet",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled"):
        spark.conf.set(key, conf[key])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset.

    Order: the context's folder, then ``spark.checkpoint.dir`` from the
    session, then -- local mode only -- a fresh folder under the system temp
    directory. A non-local session without a configured folder is an error:
    checkpoints on machine-local disk would not survive executor loss.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext on this session type: use the setting alone
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        master = sc.master if sc is not None else str(spark.conf.get("spark.master", ""))
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at shared storage "
                "so checkpoints survive executor loss"
            )
        configured = tempfile.mkdtemp(prefix="martlet-ckpt-", dir=os.environ.get("TMPDIR"))
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # core setting not modifiable at runtime; the context keeps it below
            pass
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared checkpoint folder, removed by
    ``release_staged`` or when the driver process ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/martlet-{label}-{uuid.uuid4().hex}"
    if not _STAGED:
        atexit.register(release_staged)
    _STAGED.append((spark, path))
    return path


def stage_table(df, label: str):
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read
    it back: cuts the lineage (a lost executor never forces a recompute of the
    stage) and gives the planner the real file size, so a small result is
    broadcast by ``autoBroadcastJoinThreshold`` and a large one is not."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release_staged(spark: SparkSession | None = None) -> int:
    """Delete the work folders of ``spark`` (or of every session still running);
    DataFrames that read them must be done with. Returns how many went."""
    gone = 0
    for owner, path in list(_STAGED):
        if spark is not None and owner is not spark:
            continue
        _STAGED.remove((owner, path))
        context = owner.sparkContext
        if context._jsc is None:  # stopped: its folders are the platform's to clean
            continue
        at = context._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True))
    return gone
