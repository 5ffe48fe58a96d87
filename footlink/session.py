"""Session helpers: building a session for tests/bench, and cutting lineage.

Library functions never build their own session; they take the caller's.
Lineage is cut with a *reliable* checkpoint written under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared filesystem on a real
cluster), so a lost executor never loses a stage's result.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale: AQE re-plans joins at runtime (broadcast
# conversion only when the *measured* shuffle size is small), coalesces tiny
# partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "footlink", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (a cluster job gets its session from
    spark-submit and should call :func:`ensure_checkpoint_dir` only)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    b = SparkSession.builder.master(master or f"local[{cpus}]").appName(app)
    conf = dict(SCALE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus))
    conf["spark.driver.memory"] = os.environ.get("FOOTLINK_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder named by the session.

    Uses ``spark.checkpoint.dir`` when the cluster sets it; only when it is
    unset (local tests) a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="footlink-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table under the checkpoint folder and
    return a scan of it.

    One pass writes it (an RDD checkpoint would compute the plan twice
    unless cached), the result survives executor loss (shared folder), and
    later plans get column pruning, pushed filters and file statistics for
    AQE's join choices.
    """
    base = ensure_checkpoint_dir(df.sparkSession)
    path = f"{base.rstrip('/')}/footlink-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``footlink`` importable in Python workers (the runtime
    equivalent of ``spark-submit --py-files``): zip the package once per
    application and register it with ``addPyFile``, which distributes it
    through Spark itself. Skipped when the package is already shipped."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="footlink-pkg-"), "footlink.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)
