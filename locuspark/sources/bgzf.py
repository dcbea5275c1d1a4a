"""Lines of block-compressed text: many tasks per file.

A block-gzip file is a chain of gzip members of at most 64 KB, each with its
own length in a header field. A task takes a range of bytes, looks for the
first block that begins in it, and reads blocks until its range is over. The line
that is cut by the start of a range belongs to the task before, which reads on
to the end of its last line.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The first bytes of a block (gzip with an extra field), the
# subfield that holds its length, and the most bytes a block can have.
GZIP_EXTRA = b"\x1f\x8b\x08\x04"
SUBFIELD = b"BC\x02\x00"
BLOCK_MOST = 1 << 16
#: Compressed bytes of a task.
RANGE = 32 << 20


def block_size(data: bytes, at: int = 0) -> int | None:
    """Length of the block that begins at ``at``, or None where none does."""
    if data[at : at + 4] != GZIP_EXTRA or len(data) < at + 18:
        return None
    (extra,) = struct.unpack_from("<H", data, at + 10)
    field, end = at + 12, at + 12 + extra
    while field + 4 <= min(end, len(data)):
        if data[field : field + 4] == SUBFIELD and field + 6 <= len(data):
            return struct.unpack_from("<H", data, field + 4)[0] + 1
        field += 4 + struct.unpack_from("<H", data, field + 2)[0]
    return None


def first_block(source, start: int, length: int) -> int:
    """Where the first block at or after ``start`` begins; ``length`` if there is none.

    The first bytes of a block may occur inside another one by chance, so the
    block has to be followed by another block or the end of the file, and unpack.
    """
    data = source.read_at(min(3 * BLOCK_MOST, length - start), start)
    at = data.find(GZIP_EXTRA)
    while 0 <= at <= BLOCK_MOST:
        size = block_size(data, at)
        if size is not None:
            after = at + size
            if start + after == length or block_size(data, after) is not None:
                try:
                    zlib.decompress(data[at:after], 31)
                    return start + at
                except zlib.error:
                    pass
        at = data.find(GZIP_EXTRA, at + 1)
    return length


def blocks(source, at: int, length: int) -> Iterator[tuple[int, bytes]]:
    """Start and unpacked bytes of every block from ``at`` on."""
    base, data = at, b""
    while at < length:
        if at + BLOCK_MOST > base + len(data) < length:
            base, data = at, source.read_at(min(16 * BLOCK_MOST, length - at), at)
        size = block_size(data, at - base)
        if size is None or at + size > length:
            raise ValueError(f"no whole block at byte {at}")
        yield at, zlib.decompress(data[at - base : at - base + size], 31)
        at += size


def lines_between(source, start: int, end: int, length: int) -> Iterator[bytes]:
    """The lines that begin after the first line end of the range, or at the start of the file, up to its last one."""
    at = first_block(source, start, length)
    if at >= end:
        return
    rest, whole = b"", start == 0
    for place, data in blocks(source, at, length):
        if place >= end:
            # Only the line that is open still belongs here.
            stop = data.find(b"\n")
            if whole:
                rest += data if stop < 0 else data[:stop]
            if stop >= 0:
                break
            continue
        if not whole:
            begin = data.find(b"\n")
            if begin < 0:
                continue
            data, whole = data[begin + 1 :], True
        *done, rest = (rest + data).split(b"\n")
        yield from done
    else:
        if whole and rest:
            yield rest
        return
    if whole:
        yield rest


def is_block_gzip(spark: SparkSession, path: str) -> bool:
    """Whether a file, or the first one of a folder, begins with a block."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(place).isDirectory():
        names = sorted(s.getPath().toString() for s in fs.listStatus(place) if not s.getPath().getName().startswith(("_", ".")))
        if not names:
            return False
        place = spark._jvm.org.apache.hadoop.fs.Path(names[0])
    stream = fs.open(place)
    try:
        head = bytes(b for b in (stream.read() for _ in range(64)) if b >= 0)
    finally:
        stream.close()
    return block_size(head) is not None


def read_block_gzip(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """value, source_file, start (of the range): the lines of a block-gzip file, or of all files in a folder."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # only the listing
    last = F.greatest(F.lit(0).cast("long"), F.col("length") - 1)
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(size).cast("long"))).alias("start"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for batch in batches:
            for row in batch.itertuples():
                filesystem, file = fs.FileSystem.from_uri(row.path)
                held: list[str] = []
                with filesystem.open_input_file(file) as source:
                    for line in lines_between(source, row.start, min(row.start + size, row.length), row.length):
                        held.append(line.decode().removesuffix("\r"))
                        if len(held) == 2000:
                            yield pd.DataFrame({"value": held, "source_file": row.path, "start": row.start})
                            held = []
                if held:
                    yield pd.DataFrame({"value": held, "source_file": row.path, "start": row.start})

    return ranges.repartition("path", "start").mapInPandas(read, "value string, source_file string, start long")
