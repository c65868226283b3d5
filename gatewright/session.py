"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Repeated keys in a payload keep the last value, as the usual JSON readers do.
# ``apply`` and ``run_chain`` see to it themselves.
RUNTIME_SETTINGS = {"spark.sql.variant.allowDuplicateKeys": "true"}

# While an intermediate table is written: shuffle files go as soon as the rows they serve are there,
# not when the driver happens to collect its garbage.
WORK_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Where long texts meet Python workers, which take memory beside the executor's heap.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}

_folders: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g"
) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("gatewright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # Building a plan is quicker without a call site for every column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, or
    the checkpoint folder set on the context.

    A machine-local folder serves only where the whole session runs on one
    machine; it goes when Python ends. On a cluster without a shared folder
    executors would not see each other's files, so that is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(
            f"set spark.checkpoint.dir to a folder all executors share (master: {master})"
        )
    root = tempfile.mkdtemp(prefix="gatewright-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate data, on storage that all executors share."""
    folder = os.path.join(_shared_root(spark), f"{purpose}-{uuid.uuid4().hex}")
    _folders.append(folder)
    return folder


@contextlib.contextmanager
def work_settings(spark: SparkSession, settings: dict[str, str] = WORK_SETTINGS):
    """``settings`` hold inside; the session's own come back behind it."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextlib.contextmanager
def work_scope():
    """Notes the work folders that are made inside, so that ``release`` can free them."""
    made: list[str] = []
    first = len(_folders)
    try:
        yield made
    finally:
        made += _folders[first:]


def release(spark: SparkSession, folders: list[str], but: DataFrame | None = None) -> None:
    """Delete work folders that no frame needs any more, except those ``but`` reads."""
    kept = set() if but is None else {os.path.basename(os.path.dirname(f)) for f in but.inputFiles()}
    for folder in folders:
        if folder in _folders and os.path.basename(folder) not in kept:
            _folders.remove(folder)
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def clear_work(spark: SparkSession) -> None:
    """Delete the work folders made so far; frames read from them are gone then."""
    release(spark, list(_folders))


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared work folder and read back.

    Later steps start from files that survive the loss of executors, so that
    the shuffle files behind it go at once.
    """
    folder = work_folder(df.sparkSession, purpose)
    with work_settings(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
