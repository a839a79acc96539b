"""Session settings and shared-storage helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins at runtime: a join side is
# broadcast only when its measured shuffle output is under the threshold, and
# sort-merge is kept otherwise. Skewed partitions are split by AQE.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.scheduler.mode": "FAIR",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "cubeshelf",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession, fallback: str = "/tmp/cubeshelf-checkpoints") -> str:
    """Shared folder for staging and lineage cuts.

    On a cluster this is `spark.checkpoint.dir` (a folder every executor
    sees), read from the session. Only when it is unset, as in local tests, a
    fallback is installed as the context's checkpoint folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(fallback)
        root = fallback
    return root.rstrip("/")


STAGING = "cubeshelf-staging"


def staging_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh, never-reused folder under the shared root, among those of this application."""
    return f"{shared_root(spark)}/{STAGING}/{spark.sparkContext.applicationId}/{purpose}-{uuid.uuid4().hex}"


def drop_staging(spark: SparkSession) -> None:
    """Remove what this application has staged; frames read from it are void then."""
    from .sources import fs

    fs.delete(spark, f"{shared_root(spark)}/{STAGING}/{spark.sparkContext.applicationId}")


def materialize(df, purpose: str = "materialized"):
    """Write `df` once to a fresh folder under the shared root and read it
    back: later reads start from these files (no upstream recomputation, and
    a lost executor cannot force one)."""
    path = staging_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make `cubeshelf` importable by the Python workers (once per
    application): the package is zipped into the shared folder and added
    with `addPyFile`, as `--py-files` would. Needed by every operator that
    runs Python on the executors (mapInPandas)."""
    import hashlib
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, dirs, files in os.walk(pkg):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    data = buf.getvalue()
    path = f"{shared_root(spark)}/cubeshelf-pyfiles/cubeshelf-{hashlib.sha1(data).hexdigest()[:12]}.zip"
    from .sources import fs
    fs.write_bytes(spark, path, data)
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)
