"""Token ids in binary files: frequency-ranked ids, variable-length bytes, control bytes apart.

An id is replaced by its rank in the order of frequency over all documents, so
that frequent ids take one byte. Ranks are stored little-endian in 1 to 4 bytes;
the lengths of four ranks share one control byte, and all control bytes of a
file stand before all data bytes. Decoding looks lengths up in a table of 256
control bytes and gathers bytes with numpy.

A file: ``MAGIC``, documents and tokens as unsigned 64-bit numbers, document ids
(signed 64-bit, the lowest value for null), tokens per document (unsigned
64-bit), control bytes, data bytes. Beside the files lie ``ranks`` (rank to id)
and ``manifest`` (files in order), both Parquet.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from locuspark.llm.common import arrow_batches, stage, text_of
from locuspark.llm.tokens import encoder, gathered, public_path
from locuspark.session import qualified_uri, scratch_dir

MAGIC = b"RVBYTE01"
NO_ID = -(2**63)
#: Tokens after which a file is closed; one document is never divided.
FILE_TOKENS = 4_000_000
#: Files of one group in the two-step running sum over files.
GROUP = 1024

FILES = pa.schema([("name", pa.string()), *[(c, pa.int64()) for c in ("part", "seq", "docs", "tokens")]])

_LENGTHS = np.array([[(c >> 2 * k & 3) + 1 for k in range(4)] for c in range(256)], dtype=np.uint8)
_LOW = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)


def pack_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    r = np.ascontiguousarray(ranks, dtype="<u4")
    code = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    padded = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    padded[: len(r)] = code
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    taken = np.arange(4, dtype=np.uint8) <= code[:, None]
    return control.astype(np.uint8).tobytes(), r.view(np.uint8).reshape(-1, 4)[taken].tobytes()


def unpack_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` numbers behind control and data bytes (unsigned 8-bit arrays)."""
    lengths = _LENGTHS[control].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    padded = np.concatenate([data[: ends[-1] if n else 0], np.zeros(3, np.uint8)])
    at = ends - lengths
    word = padded[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        word[longer] |= padded[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return word


def encode_file(doc_ids: np.ndarray, counts: np.ndarray, ranks: np.ndarray) -> bytes:
    control, data = pack_ranks(ranks)
    head = MAGIC + struct.pack("<QQ", len(doc_ids), len(ranks))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), counts.astype("<u8").tobytes(), control, data])


def decode_file(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, tokens per document and all ranks of one file."""
    if content[:8] != MAGIC:
        raise ValueError("not a token file")
    docs, tokens = struct.unpack("<QQ", content[8:24])
    raw, at = np.frombuffer(content, np.uint8), 24
    ids = raw[at : at + 8 * docs].view("<i8")
    counts = raw[at + 8 * docs : at + 16 * docs].view("<u8").astype(np.int64)
    at += 16 * docs
    quads = -(-tokens // 4)
    return ids, counts, unpack_ranks(raw[at : at + quads], raw[at + quads :], tokens)


def token_table(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, end_id: int) -> DataFrame:
    """doc_id, ids (bytes of 16- or 32-bit numbers, end id included), n; tokenized once and kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        kind = enc.kind if end_id < 2 ** (8 * enc.kind.itemsize) else np.dtype("<u4")
        end = np.array([end_id], dtype=kind)
        for batch in gathered(batches, "text"):
            found = enc.encode(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([np.concatenate([ids.astype(kind), end]).tobytes() for ids in found], pa.binary()),
                    pa.array([len(ids) + 1 for ids in found], pa.int64()),
                    pa.array([kind.itemsize] * len(found), pa.int32()),
                ],
                names=["doc_id", "ids", "n", "width"],
            )

    texts = arrow_batches(text_of(docs, id_col, text_col)).withColumn("doc_id", F.col("doc_id").cast("long"))
    spark = docs.sparkSession
    path = scratch_dir(spark, "token-ids")
    texts.mapInArrow(run, "doc_id long, ids binary, n long, width int").write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def frequency_ranks(tokens: DataFrame) -> DataFrame:
    """rank, id, n: as many rows as the vocabulary has at most. Ties go to the smaller id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            # Counted for all documents of a batch at once: a count is as long as the vocabulary.
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths).tolist():
                raw = b"".join(batch.column("ids").filter(pa.array(widths == width)).to_pylist())
                part = np.bincount(np.frombuffer(raw, f"<u{width}"))
                if len(part) > len(total):
                    part, total = total, part.astype(np.int64)
                total[: len(part)] += part
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    counts = tokens.select("ids", "width").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)


def write_token_files(
    docs: DataFrame,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 0,
    file_tokens: int = FILE_TOKENS,
) -> None:
    """Write all documents below ``path`` in ascending order of their ids (nulls first).

    A null text is empty: its document is the end id alone. Rows with the same
    id follow one another. Files are written whole under their final names, so
    a task that runs again writes the same files.
    """
    spark = docs.sparkSession
    tokens = token_table(docs, id_col, text_col, tokenizer or public_path(), end_id)
    ranks = stage(frequency_ranks(tokens), "token-ranks")
    order = ranks.orderBy("rank").toPandas()["id"].to_numpy(np.int64)  # bounded by the vocabulary
    rank_of = np.zeros((order.max() if len(order) else 0) + 1, np.uint32)
    rank_of[order] = np.arange(len(order), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)
    uri = qualified_uri(spark, path)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(uri)
        system.create_dir(base, recursive=True)
        part = seq = size = 0
        ids: list[int] = []
        counts: list[int] = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            name = f"part-{part:08d}-{seq:05d}.tok"
            content = encode_file(np.array(ids, np.int64), np.array(counts, np.int64), np.concatenate(held))
            temporary = f"{base}/.{name}.{os.getpid()}"
            with system.open_output_stream(temporary) as out:
                out.write(content)
            system.move(temporary, f"{base}/{name}")
            return pa.RecordBatch.from_pylist([{"name": name, "part": part, "seq": seq, "docs": len(ids), "tokens": size}], FILES)

        for batch in batches:
            for part, doc_id, raw, width in zip(*[batch.column(c).to_pylist() for c in ("part", "doc_id", "ids", "width")]):
                if size and size + len(raw) // width > file_tokens:
                    yield close()
                    ids, counts, held, size, seq = [], [], [], 0, seq + 1
                values = shared.value[np.frombuffer(raw, f"<u{width}")]
                ids.append(NO_ID if doc_id is None else doc_id)
                counts.append(len(values))
                held.append(values)
                size += len(values)
        if ids:
            yield close()

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = tokens.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first())
    placed = arrow_batches(placed).select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "ids", "width")
    files = "name string, part long, seq long, docs long, tokens long"
    placed.mapInArrow(write, files).write.mode("overwrite").parquet(f"{path}/manifest")
    ranks.select("rank", "id", "n").write.mode("overwrite").parquet(f"{path}/ranks")


def file_starts(manifest: DataFrame) -> DataFrame:
    """name, start: tokens in all files before each. Groups of files are summed first."""
    part = manifest.withColumn("lot", F.floor(F.col("part") / GROUP))
    lots = part.groupBy("lot").agg(F.sum("tokens").alias("lot_tokens"))
    before = Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    lots = lots.select("lot", F.coalesce(F.sum("lot_tokens").over(before), F.lit(0)).alias("lot_start"))
    inside = Window.partitionBy("lot").orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    within = part.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return within.join(lots, "lot").select("name", (F.col("lot_start") + F.col("inside")).alias("start"))


DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("at", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document below ``path``, and its ids if wanted.

    ``start`` counts the ids of all documents before; ``ids`` are the bytes of
    unsigned 32-bit little-endian numbers.
    """
    order = spark.read.parquet(f"{path}/ranks").select("rank", "id").toPandas().sort_values("rank")["id"]
    shared = spark.sparkContext.broadcast(order.to_numpy("<u4"))  # bounded by the vocabulary

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, content in zip(pdf["name"], pdf["content"]):
                doc_ids, counts, ranks = decode_file(content)
                ids = shared.value[ranks]
                ends = np.cumsum(counts)
                pieces = [ids[a:b].tobytes() for a, b in zip(ends - counts, ends)]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([None if x == NO_ID else x for x in doc_ids.tolist()], dtype="Int64"),
                        "name": name,
                        "at": ends - counts,
                        "n_tokens": counts,
                        "ids_crc32": [zlib.crc32(p) for p in pieces],
                        "ids": pieces if with_ids else [None] * len(pieces),
                    }
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(path)
    found = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content").mapInPandas(read, DOCUMENTS)
    starts = stage(file_starts(spark.read.parquet(f"{path}/manifest")), "token-starts")
    columns = ["doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"]
    return found.join(starts, "name").select(*columns, *(["ids"] if with_ids else []))


def token_files(docs: DataFrame, **options) -> DataFrame:
    """Write the token files of ``docs`` to a new shared folder and read them back."""
    path = scratch_dir(docs.sparkSession, "token-files")
    write_token_files(docs, path, **options)
    return read_token_files(docs.sparkSession, path)
