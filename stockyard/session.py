"""Session helpers: recommended settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs are planned for. AQE re-plans joins from measured sizes
# (so broadcasts only happen below a measured threshold) and splits skewed
# join partitions; requiring all cluster keys keeps an aggregate or window
# from reusing a coarser upstream partitioning, so one hot product or SKU is
# not funnelled into one task.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForDistribution": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = 8,
                  app_name: str = "stockyard", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster pass ``master=None`` and
    size ``shuffle_partitions`` to the data (about 128-256 MB per partition;
    None keeps the cluster's setting)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(RECOMMENDED_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.sql.session.timeZone"] = "UTC"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect raises a not-implemented error
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Only when it is
    unset on a local master (tests), a folder under the local temp dir is
    chosen; on a cluster, whose machines do not share one, that is an error.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="stockyard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def written(df, name: str):
    """``df`` written once under the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH: list[str] = []


def remove_scratch(spark: SparkSession, since: int = 0) -> int:
    """Delete the scratch folders that this process has made, but for the first
    ``since``; for the end of a job, when nothing reads them any more."""
    gone = _SCRATCH[since:]
    del _SCRATCH[since:]
    for name in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(gone)


def scratch_count() -> int:
    return len(_SCRATCH)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (``addPyFile`` of a
    zip of it), once per SparkContext. Needed by the operators that run
    Python inside tasks (``mapInPandas`` / ``applyInPandas``) when the
    workers do not already have the package on their path."""
    import zipfile

    sc = _context(spark)
    holder = sc if sc is not None else spark
    if getattr(holder, "_stockyard_shipped", False):
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    path = os.path.join(tempfile.mkdtemp(prefix="stockyard-pyfiles-"), "stockyard.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(path)
    else:  # Spark Connect: ship as a session artifact
        spark.addArtifacts(path, pyfile=True)
    holder._stockyard_shipped = True
