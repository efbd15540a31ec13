"""Session helpers: a local session for tests and the bench, and the shared
scratch folder that landed files and lineage cuts go to."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "indicata", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench.

    AQE on (coalesces small shuffles, splits skewed join partitions), UTC
    session time zone (text -> timestamp casts must not depend on the host),
    Spark UI off.  A checkpoint folder is set only here, where none is given;
    on a cluster the session's own ``spark.checkpoint.dir`` is used.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset and everything runs in one
    process (a ``local`` master) a fresh folder is made and registered as the
    checkpoint folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no context on the client; the server owns the folder
        sc = None
    base = spark.conf.get(CHECKPOINT_CONF, None) or (sc.getCheckpointDir() if sc else None)
    if not base:
        master = (spark.conf.get("spark.master", None) or "") if sc is None else sc.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="indicata-ckpt-")
    if sc is not None and not sc.getCheckpointDir():
        # DataFrame.checkpoint() needs the context's folder; keep it in step
        # with the session setting (or the local fallback above).
        sc.setCheckpointDir(base)
    return qualified(spark, base.rstrip("/"))


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme: without one it lies on the session's default file
    system, also for tasks that do not open it through Spark."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", path):
        return path
    try:
        jvm = spark.sparkContext._jvm
    except Exception:  # Spark Connect: the server resolves it
        return path
    found = jvm.org.apache.hadoop.fs.Path(path)
    fs = found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs.makeQualified(found).toString()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared folder."""
    return f"{shared_dir(spark)}/landing/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["local_session", "qualified", "scratch_path", "shared_dir"]
