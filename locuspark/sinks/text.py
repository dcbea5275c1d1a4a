"""Text outputs and file hashes."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locuspark.operators.causal import assessment_columns
from locuspark.schemas import REPLAY_MANIFEST
from locuspark.session import qualified_uri
from locuspark.sources.bgzf import GZIP_EXTRA, SUBFIELD


def _flags_as_text(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.upper(F.col(c).cast("string")) for c in flags})


def write_tsv(df: DataFrame, path: str, header: bool, null: str = "NA") -> None:
    """Tab-separated, unquoted."""
    _flags_as_text(df).write.mode("overwrite").csv(
        path, sep="\t", header=header, nullValue=null, quote="", emptyValue="", escape=""
    )


def write_assessment_tsv(df: DataFrame, path: str) -> None:
    """The 35 columns without header; flags as TRUE and FALSE, unknown as NA."""
    write_tsv(assessment_columns(df), path, header=False)


def write_regions_tsv(df: DataFrame, path: str) -> None:
    write_tsv(df, path, header=True)


def manifest_columns(df: DataFrame) -> DataFrame:
    """Known manifest columns first, further keys sorted; absent ones are empty."""
    known = REPLAY_MANIFEST.names
    extra = sorted(c for c in df.columns if c not in known)
    return df.select(
        *[
            (F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")).alias(c)
            for c in known
        ],
        *extra,
    )


def write_manifest(failures: DataFrame, path: str) -> None:
    write_tsv(manifest_columns(failures), path, header=True, null="")


def _block(data: bytes) -> bytes:
    """One member of a block-gzip file."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    head = GZIP_EXTRA + bytes(4) + b"\x00\xff" + struct.pack("<H", 6) + SUBFIELD + struct.pack("<H", len(body) + 25)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data))


def write_block_gzip(lines: DataFrame, folder: str, header: Sequence[str] = (), ending: str = ".vcf.gz", most: int = 60_000) -> DataFrame:
    """The column ``value`` as block-gzip files, one per partition, each with the header; returns their paths.

    ``most`` is the text of a block. A task writes under another name and renames.
    """
    base = qualified_uri(lines.sparkSession, folder)
    head = "".join(f"{h}\n" for h in header).encode()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        filesystem, root = fs.FileSystem.from_uri(base)
        filesystem.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}{ending}"
        draft = f"{root}/_{uuid.uuid4().hex}"
        with filesystem.open_output_stream(draft) as out:
            data = head
            for batch in batches:
                data += "".join(f"{v}\n" for v in batch["value"]).encode()
                while len(data) >= most:
                    out.write(_block(data[:most]))
                    data = data[most:]
            if data:
                out.write(_block(data))
            out.write(_block(b""))  # the end of the file
        filesystem.move(draft, f"{root}/{name}")
        yield pd.DataFrame({"path": [f"{base}/{name}"]})

    return lines.select("value").mapInPandas(write, "path string")


def write_bytes(partitions: DataFrame, folder: str, data: bytes, name: str) -> DataFrame:
    """A file of these bytes in the partition folder of every row; the columns of ``partitions`` name it. Returns the paths."""
    base, keys = qualified_uri(partitions.sparkSession, folder), partitions.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            paths = []
            for row in batch.itertuples(index=False):
                place = "/".join([base, *(f"{k}={v}" for k, v in zip(keys, row))])
                filesystem, root = fs.FileSystem.from_uri(place)
                filesystem.create_dir(root, recursive=True)
                with filesystem.open_output_stream(f"{root}/{name}") as out:
                    out.write(data)
                paths.append(f"{place}/{name}")
            yield pd.DataFrame({"path": paths})

    return partitions.mapInPandas(write, "path string")


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """A text file for every row, called ``name`` and holding ``value``; returns the paths.

    Files lie in as many folders as there are shuffle partitions, written by a
    task each: a folder per file would have to be committed and listed one by one.
    A task that runs again writes the same files.
    """
    spark = files.sparkSession
    base, folders = qualified_uri(spark, folder), int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        filesystem, root = fs.FileSystem.from_uri(base)
        made = set()
        for batch in batches:
            paths = []
            for row in batch.itertuples(index=False):
                if row.folder not in made:
                    filesystem.create_dir(f"{root}/{row.folder}", recursive=True)
                    made.add(row.folder)
                with filesystem.open_output_stream(f"{root}/{row.folder}/{row.name}") as out:
                    out.write(row.value.encode())
                paths.append(f"{base}/{row.folder}/{row.name}")
            yield pd.DataFrame({"path": paths})

    placed = files.select("name", "value", F.expr(f"pmod(hash(name), {folders})").cast("string").alias("folder"))
    return placed.repartition(folders, "folder").mapInPandas(write, "path string")


def hash_manifest(spark: SparkSession, directory: str, block: int = 1 << 22) -> DataFrame:
    """path, bytes and SHA-256 of every file below a folder, sorted by path.

    Only names and sizes are listed up front (Spark's own file sources do the
    same, but leave out empty files). Each task streams its files, so memory
    does not depend on file size.
    """
    from pyarrow import fs

    uri = qualified_uri(spark, directory)
    filesystem, root = fs.FileSystem.from_uri(uri)
    listed = [
        (i.path, i.size)
        for i in filesystem.get_file_info(fs.FileSelector(root, recursive=True))
        if i.type == fs.FileType.File
    ]
    files = spark.createDataFrame(listed, "path string, bytes long").repartition(
        max(1, min(len(listed), 4 * spark.sparkContext.defaultParallelism)), "path"
    )

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        from pyarrow import fs

        filesystem, _root = fs.FileSystem.from_uri(uri)
        for batch in batches:
            sums = []
            for path in batch["path"]:
                state = hashlib.sha256()
                with filesystem.open_input_stream(path) as source:
                    while data := source.read(block):
                        state.update(data)
                sums.append(state.hexdigest())
            yield batch.assign(sha256=sums)

    return files.mapInPandas(digest, "path string, bytes long, sha256 string").orderBy("path")
