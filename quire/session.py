"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. UTC keeps ISO strings stable; a small Arrow batch keeps
# the HTML step's memory flat when pages are large (one page can be hundreds of KB).
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quire") -> SparkSession:
    """Session for tests and the bench; on a cluster use the one the platform gives you."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.ansi.enabled", "true")
    )
    for k, v in JOB_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quire`` importable in Python workers (the HTML step runs there).

    Zips the package next to the driver and registers it with ``addPyFile``, which Spark
    distributes to every executor. Done once per application."""
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    # Spark's own folder for files of the session, which it deletes at the end
    fd, path = tempfile.mkstemp(prefix="quire-", suffix=".zip", dir=getattr(sc, "_temp_dir", None))
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in base:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def apply_job_conf(spark: SparkSession) -> None:
    """Set what the results and the HTML step's memory depend on (session scoped): the time zone
    and the Arrow batch. Everything else is left as the user has it."""
    for k in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.maxRecordsPerBatch"):
        spark.conf.set(k, JOB_CONF[k])


def is_local(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` starts several)."""
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Called only where a job checkpoints or stores an intermediate table. On a cluster the
    platform sets it to shared storage and we only read it; if it is unset there, this is an error, because
    a folder made here would be one machine's. In local mode (tests) we pick a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not is_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="quire-ckpt-", dir=os.environ.get("QUIRE_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}"
