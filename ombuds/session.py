"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings the results depend on. They are safe to set on a session somebody else made.
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

#: Settings that only change speed. Shuffle partitions start high and adaptive execution merges the
#: small ones, so one value fits a laptop run and a large cluster.
SPEED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Without it every column expression asks the JVM where in the Python code it was made.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to an existing session."""
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "ombuds", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RESULT_CONF, **SPEED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def conf(spark: SparkSession, **settings: str):
    """Set session options (dots written as ``__``) for the body of a ``with`` block."""
    settings = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def freeing_shuffles(spark: SparkSession):
    """In its body every action deletes its shuffle files at its end. Elsewhere they stay until the driver happens to collect
    its garbage, so that the shuffles of all writes of a job lie on the executors' disks together.

    Not for making frames that are returned: one that runs twice would have to shuffle again.
    """
    return conf(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: the checkpoint folder of the session.

    A folder given to ``setCheckpointDir`` counts first, then the setting ``spark.checkpoint.dir``. Only a local
    master, whose threads share the machine's disk, gets a temporary folder where both are unset; on a cluster that
    is an error, because every executor would write to a disk of its own.
    """
    context = spark.sparkContext
    chosen = context.getCheckpointDir()
    if chosen:
        return chosen.rstrip("/")
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="ombuds-")
    context.setCheckpointDir(named)
    return context.getCheckpointDir().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file, folder or glob pattern names anything."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def move_path(spark: SparkSession, path: str, target: str) -> None:
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs
    source = paths.Path(path)
    source.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).rename(source, paths.Path(target))


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
