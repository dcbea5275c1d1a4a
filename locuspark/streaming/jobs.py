"""Streaming ingest, outcome ledger and replicate counter.

Keyed state lives in Spark's state store (RocksDB, in the checkpoint); what it
emits goes to versioned tables, one commit per micro-batch. A batch that is
replayed after a failure commits the same again, and tables compact themselves,
so neither state nor folders grow with the number of batches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from locuspark.schemas import TABLES
from locuspark.sinks.versions import Versioned

LEDGER_KEY = ("species", "grp", "nqtl", "effect", "h2", "rep", "mode", "type")
REPLICATION_CELL = ("population", "maf", "nqtl", "effect", "h2", "algorithm", "pca")
_STATE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(stream: DataFrame, mode: str, checkpoint: str, write: Callable[[DataFrame, str], None]) -> StreamingQuery:
    """Run what is available; ``write`` gets each batch with a name that is the same when it is replayed."""
    conf = stream.sparkSession.conf
    before = conf.get(_STATE)
    stream_id = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    conf.set(_STATE, _ROCKS)  # the query takes its own copy of the settings
    try:
        writer = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, epoch: write(batch, f"{stream_id}.{epoch}"))
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        conf.set(_STATE, before)


def mappings_table(spark: SparkSession, base: str) -> Versioned:
    return Versioned(spark, f"{base}/ingested/mappings", ("population", "mapping_id"), ("marker",))


def read_ingested(spark: SparkSession, base: str) -> DataFrame | None:
    """The mappings that ``stream_ingest`` has stored, as of the last snapshot."""
    return mappings_table(spark, base).read()


def stream_ingest(spark: SparkSession, in_dir: str, base: str, checkpoint: str, run: str = "run") -> StreamingQuery:
    """Store arriving markers under their mappings.

    A mapping may arrive in parts, in one micro-batch or several: rows with the
    same number in the column ``run`` (0 where there is none) add up, and of a
    marker that arrives again the latest file decides, by modification time and
    then name, even if it came in an earlier batch. A higher number is a rerun and
    replaces the mapping; rows of a lower one are ignored.
    """
    schema = spark.read.parquet(in_dir).schema
    # Files count whatever their age; by default those a week older than the newest are passed over.
    arriving = spark.readStream.schema(schema).option("maxFileAge", "36500d").parquet(in_dir)
    kept = [c for c in schema.names if c in TABLES["mappings"].names or c in ("population", "mapping_id")]
    token = F.coalesce(F.col(run).cast("long"), F.lit(0)) if run in schema.names else F.lit(0)
    arrived = F.struct(F.unix_micros("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_name").alias("file"))
    arriving = arriving.select(*kept, token.alias("_token"), arrived.alias("_arrived"))
    table = mappings_table(spark, base)

    def write(batch: DataFrame, name: str) -> None:
        table.commit(batch.select(*kept, "_token", "_arrived"), name, F.col("_token"), F.col("_arrived"), drop=("_token", "_arrived"))

    return _start(arriving, "append", checkpoint, write)


def stream_ledger(
    events: DataFrame, base: str, checkpoint: str, key: Sequence[str] = LEDGER_KEY
) -> StreamingQuery:
    """Latest outcome per cell. State is one record per cell; each batch commits changed cells."""
    rest = [c for c in events.columns if c not in key]
    latest = events.groupBy(*key).agg(
        F.max(F.struct(F.col("attempt").alias("_o"), F.struct(*rest).alias("row"))).alias("_last")
    )
    flat = latest.select(*key, "_last.row.*")
    table = Versioned(events.sparkSession, base, tuple(key), buckets=1)
    return _start(flat, "update", checkpoint, lambda batch, name: table.commit(batch, name, at=F.col("attempt")))


def read_ledger(spark: SparkSession, base: str, key: Sequence[str] = LEDGER_KEY) -> DataFrame:
    """Cells whose latest outcome is a failure."""
    return Versioned(spark, base, tuple(key), buckets=1).read().where(F.col("exit_code") != 0)


def stream_replication(
    metadata: DataFrame, base: str, checkpoint: str, cell: Sequence[str] = REPLICATION_CELL
) -> StreamingQuery:
    """Distinct replicates per cell, counted as metadata arrives."""
    counted = (
        metadata.select(*cell, "rep")
        .dropDuplicates([*cell, "rep"])
        .groupBy(*cell)
        .agg(F.count(F.lit(1)).alias("n_reps"))
    )
    table = Versioned(metadata.sparkSession, base, tuple(cell), buckets=1)
    return _start(counted, "update", checkpoint, lambda batch, name: table.commit(batch, name, at=F.col("n_reps")))


def read_replication(
    spark: SparkSession, base: str, expected_reps: int, cell: Sequence[str] = REPLICATION_CELL
) -> DataFrame:
    """Latest count per cell next to the target; counts only grow."""
    counts = Versioned(spark, base, tuple(cell), buckets=1).read()
    return counts.withColumn("complete", F.col("n_reps") >= expected_reps)
