"""Session settings, the shared scratch folder, and staged tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library relies on; all may be set on a live session.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a split hot key is worth the extra exchange that the split may need
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made by somebody else."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, app: str = "parcelpulse") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", os.environ.get("PARCELPULSE_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


#: The folder of a local session that names none, and the folders made, by application.
_LOCAL: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local master may do without; its session then has one of this machine, which goes
    when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="parcelpulse-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return _LOCAL[app]


def new_folder(spark: SparkSession, tag: str) -> str:
    path = f"{shared_folder(spark)}/parcelpulse/{tag}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_staged(spark: SparkSession) -> None:
    """Delete what this session has staged; data frames that read it can't be used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)


def staged(df: DataFrame, tag: str, codec: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage, survives lost executors, keeps column pruning, and gives
    the planner the true size: it then broadcasts a staged table only when the
    files are below ``spark.sql.autoBroadcastJoinThreshold``. ``codec`` is for large tables,
    of which a denser one saves disk; the session's is used otherwise.
    """
    spark = df.sparkSession
    path = new_folder(spark, tag)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)
