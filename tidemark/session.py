"""Session defaults and the shared staging area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_AREAS: dict[str, str] = {}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    Shuffle partition counts are left to adaptive execution; pass
    ``spark.checkpoint.dir`` on a cluster, it names the folder every executor sees.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        # state of streams on disk instead of the JVM heap: it grows with the keys inside the watermark
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with the machine, so we refuse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if configured.startswith("file:") and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names a folder of one machine; set one that all executors share")
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _LOCAL_AREAS:
        _LOCAL_AREAS[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_AREAS[app]


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tidemark/{app}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage: a lost executor re-reads files instead of re-running the
    plan, and values that depend on the physical layout (slice and position
    numbers) are fixed for all readers. Columnar, so later passes read only the
    columns they need.
    """
    path = staging_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete everything this application staged. Call it when its results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/tidemark/{spark.sparkContext.applicationId}"
    )
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
