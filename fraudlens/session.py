"""Session settings and the shared folder that staged tables live in."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


_LOCAL_DIR_KEY = "fraudlens.local.dir"


def build_session(app: str = "fraudlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects; ``conf`` wins over the defaults."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_rocksdb(spark: SparkSession) -> None:
    """State variables and timers need this store; streams that have begun with another keep theirs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without it; it then gets one temporary folder per session.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = spark.conf.get(_LOCAL_DIR_KEY, None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="fraudlens-")
        spark.conf.set(_LOCAL_DIR_KEY, folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _staging_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/fraudlens/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else has used."""
    return f"{_staging_dir(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged; frames that read it must not be used any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staging_dir(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def unstage(df: DataFrame) -> None:
    """Delete a table that ``stage`` has returned; nothing must read it any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    folder = files[0].rsplit("/", 1)[0] if files else ""
    if f"/fraudlens/{spark.sparkContext.applicationId}/" in folder:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: lost executors re-read files, and a value that depends on the
    partitioning (a row position) is the same for every later reader.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
