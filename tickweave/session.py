"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def build_session(app: str = "tickweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE with skew-join handling)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Date text and epoch arithmetic are only reproducible in one zone; use UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster whose executors do not have the package, hand it over with ``addPyFile``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    worker_env = spark.sparkContext.environment
    paths = [p for p in worker_env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        worker_env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def use_rocksdb(spark: SparkSession) -> None:
    """Streams with processors of their own need the RocksDB state store; another choice stays."""
    name, package = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming"
    if "HDFSBackedStateStoreProvider" in (spark.conf.get(name, None) or "HDFSBackedStateStoreProvider"):
        spark.conf.set(name, f"{package}.state.RocksDBStateStoreProvider")


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session may fall back to a machine-local folder; a cluster has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tickweave-")
    return _local_folders[context.applicationId]


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage of loops and lets one intermediate feed several consumers without being
    recomputed. The table lives on shared storage, so a lost executor costs nothing.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tickweave/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
