"""What Parquet files hold, from their footers alone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locuspark.session import path_exists

FOOTER = "path string, bytes long, n_rows long, problem string"


def footers(spark: SparkSession, path: str) -> DataFrame:
    """path, bytes, n_rows, problem of every Parquet file below a folder; no row is read.

    Spark lists the files; tasks read each one's last bytes. A file whose footer
    cannot be read has a problem and no row count. A folder that does not exist
    has no files.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], FOOTER)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    listed = reader.load(path).select("path", F.col("length").alias("bytes"))  # only the listing

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import ArrowException, fs

        for batch in batches:
            counts: list[int | None] = []
            problems: list[str | None] = []
            for name in batch["path"]:
                filesystem, file = fs.FileSystem.from_uri(name)
                with filesystem.open_input_file(file) as source:
                    try:
                        counts.append(pq.read_metadata(source).num_rows)
                        problems.append(None)
                    except (ArrowException, OSError, ValueError) as error:
                        counts.append(None)
                        problems.append(str(error).split("\n")[0][:200])
            yield pd.DataFrame({"path": batch["path"], "bytes": batch["bytes"], "n_rows": pd.array(counts, dtype="Int64"), "problem": problems})

    return listed.repartition("path").mapInPandas(read, FOOTER)


def from_path(column: str) -> Column:
    """The value of a partition column in ``path``."""
    return F.regexp_extract("path", f"/{column}=([^/]+)/", 1)
