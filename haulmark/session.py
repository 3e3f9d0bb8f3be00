"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of an Arrow batch; Spark's own limits are 10,000 rows and 64 MB.
BATCH_BYTES = 4_000_000

_local_folders: dict[str, str] = {}


def get_session(app_name: str = "haulmark", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the settings the operators are written for; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # Copies and deletions must not run twice at the same time.
        "spark.speculation": "false",
    }
    settings.update({key.replace("_", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and every executor can reach, from ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder (driver and executors share one machine there);
    on a cluster the setting is required.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="haulmark-")
    return _local_folders[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Actions meanwhile hand small Arrow batches to Python, unless the session sets a size: both sides hold whole ones."""
    chosen = spark.conf.get(BATCH_CONF, None)
    if chosen is None:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        if chosen is None:
            spark.conf.unset(BATCH_CONF)


def pin(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Run ``df`` once, store it as a table in the shared folder and continue from that table.

    Used where a plan must not run again (it copies or deletes files) or would grow without bound (a loop).  The
    table outlives lost executors.  The shuffles that made it are removed once it is there: nothing reads them again.
    With ``by`` it is stored by the values of that column, so a filter on one value reads nothing else.  Python gets the
    rows in ``small_batches``.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        with small_batches(spark):
            (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    return spark.read.schema(df.schema).parquet(path)
