"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from locuspark.session import stage

__all__ = ["add", "arrow_batches", "documents", "held_out", "mix64", "small_table", "stage", "staged_in_batches", "text_of"]

#: Rows an Arrow batch may hold. Texts are long, and a batch is what a Python task has in memory at once.
BATCH_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns an operator works on, under fixed names; a null text is empty.

    Extra columns of the input, whatever their names, do not come along.
    """
    return docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"),
        *[docs[c].alias(c) for c in more],
    )


def held_out(doc_id: Column) -> Column:
    """The fold no model learns from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def arrow_batches(df: DataFrame) -> DataFrame:
    """Bound the rows of the Arrow batches of this session's Python tasks."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def staged_in_batches(df: DataFrame, label: str, rows: int) -> DataFrame:
    """``stage`` with Arrow batches of at most ``rows`` rows; the session's own setting is put back."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    conf.set(name, str(rows))
    try:
        return stage(df, label)
    finally:
        conf.set(name, before)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows of the driver's as a local table.

    Given as a list, they would pass through Python tasks, whose workers are others
    than those of Arrow tasks: every executor would hold two sets of them.
    """
    fields = StructType.fromDDL(schema)
    arrow = to_arrow_schema(fields)
    columns = list(zip(*rows)) or [()] * len(arrow)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), fields)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one piece hold about ``most`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        piece = np.cumsum(np.nan_to_num(sizes.astype("float64"))) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer on unsigned integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def add(left: DataFrame | None, right: DataFrame) -> DataFrame:
    return right if left is None else left.unionByName(right)
