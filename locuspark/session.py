"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. Broadcasting is left to Spark's own size check
# (statistics at planning time, real sizes under AQE); nothing is hinted. At planning
# time a table counts as large as its files, and a dictionary-encoded file of ids holds
# many times its size in rows: uncorrected, 60 MB of files are gigabytes on the driver.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A side is broadcast only when its (runtime) size is below this.
    "spark.sql.autoBroadcastJoinThreshold": "8388608",
    # Size of rows for each byte of their files.
    "spark.sql.sources.fileCompressionFactor": "32.0",
    # Input and shuffle read by a task, compressed. Ids and flags are many times larger as rows,
    # and a hash table or sort of Spark's 64 to 128 MB spills once tables fill such tasks.
    "spark.sql.files.maxPartitionBytes": "16777216",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16777216",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # An all-digit hex id in a Hive path must stay a string.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(
    app: str = "locuspark", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if master:
        builder = builder.master(master).config("spark.driver.memory", "12g")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    Only where a session names none (tests, a laptop) is a local folder chosen,
    once per session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.conf.get("spark.locuspark.scratch", None)
    if not named:
        named = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.locuspark.scratch", named)
    return named


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def make_folder(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(place)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that hold for a while, then the session's own again."""
    before = {name: spark.conf.get(name) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Used where one intermediate result feeds several branches: it is computed
    once, survives lost executors, and keeps later plans short. What the write
    shuffled is removed when it ends; otherwise it stays on the executors' disks
    until the driver happens to collect its garbage.
    """
    path = scratch_dir(df.sparkSession, label)
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified_uri(spark: SparkSession, path: str) -> str:
    """Full URI of a path on whatever file system it names or defaults to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    uri = system.makeQualified(place).toString()
    # file:/x and file:///x name the same file; readers outside Hadoop want the latter.
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return uri
