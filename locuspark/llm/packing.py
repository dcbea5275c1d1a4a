"""Best-fit packing of documents into fixed-length token sequences, in bulk-synchronous rounds.

Every document is tokenized once; longer ones are cut into pieces of the full
length, the first piece taking the remainder. Pieces that fill a sequence are
done. The others are placed in rounds over a table of open pieces and a table
of gaps (sequences with free room):

* Open pieces and gaps are put in one descending order of size, gaps before
  pieces of the same size. Read along it, a gap opens a bracket and a piece
  closes the last open one: that gap is the piece's successor, the smallest gap
  at least as large that no larger piece has taken. Which bracket a row opens or
  closes is its level, and follows from its rank within its size and from how
  many gaps and pieces each size has; pieces that find no bracket lose this
  round. Matching is a window over each level.
* Matched gaps shrink by their piece, and the next round begins.
* Pieces larger than all gaps, and as many as the free room cannot hold, open
  new sequences, largest first.

Sizes are below the sequence length, so the counts by size that the driver sees
are a bounded table. Ranks are taken within salted parts of a size: a length
that a third of all pieces share is no single task. A level holds two rows of
each size at most. Each round is written to the shared folder.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locuspark.llm.common import arrow_batches, small_table, stage, text_of
from locuspark.llm.tokens import encoder, gathered, public_path

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
#: Rows ranked together; larger sizes are split into parts of about this many.
PART = 1000
STATE = ("kind", "pid", "size", "seq", "used")


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece; the first one takes what is left over."""
    if total <= capacity:
        return [(0, total)]
    first = total % capacity
    starts = range(first, total, capacity)
    return ([(0, first)] if first else []) + [(s, capacity) for s in starts]


def pieces_of(docs: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str, end_id: int, with_ids: bool) -> DataFrame:
    """One row per piece of every document, null texts being empty, end id included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer), np.array([end_id], "<u4")
        for batch in gathered(batches, "text"):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), enc.encode(batch.column("text"))):
                raw = np.concatenate([ids.astype("<u4"), end]).tobytes()
                for k, (start, length) in enumerate(cut(len(raw) // 4, capacity)):
                    part = raw[4 * start : 4 * (start + length)]
                    rows.append((doc_id, k, start, length, zlib.crc32(part), part if with_ids else None))
            columns = list(zip(*rows))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    texts = arrow_batches(text_of(docs, id_col, text_col)).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = texts.mapInArrow(run, PIECES)
    if not with_ids:
        found = found.drop("ids")
    # Numbers given here hold for good: what is read from now on is the written table.
    return stage(found.withColumn("pid", F.monotonically_increasing_id()), "pack-pieces")


def sweep(gaps: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bracket level below the gaps of each size, and how many pieces of each size find one.

    Both arguments count rows by size. Larger sizes come first.
    """
    base, placed, level = np.zeros_like(gaps), np.zeros_like(items), 0
    for size in range(len(gaps) - 1, 0, -1):
        base[size] = level
        level += gaps[size]
        placed[size] = min(items[size], level)
        level -= placed[size]
    return base, placed


def openers(gaps: np.ndarray, items: np.ndarray, capacity: int) -> np.ndarray:
    """How many pieces of each size open a new sequence now.

    All above half a sequence, or else the largest ones: as many as the pieces
    that no gap can take need, or as the free room falls short of.
    """
    sizes = np.arange(len(gaps), dtype=np.int64)
    opened = np.where(sizes > capacity // 2, items, 0) if not gaps.any() else np.zeros_like(items)
    left = items - opened
    widest = max(np.flatnonzero(gaps).max(initial=0), capacity - np.flatnonzero(opened).min(initial=capacity))
    free = (gaps * sizes).sum() + (opened * (capacity - sizes)).sum()
    short = max((left * sizes).sum() - free, (left * sizes)[sizes > widest].sum())
    wanted = -(-int(short) // capacity)
    for size in range(capacity, 0, -1):
        take = min(wanted, left[size])
        opened[size] += take
        wanted -= take
    return opened


def _counts(state: DataFrame, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaps and open pieces by size; at most twice ``capacity`` rows reach the driver."""
    found = np.zeros((2, capacity + 1), np.int64)
    for kind, size, n in state.where("kind < 2").groupBy("kind", "size").agg(F.count(F.lit(1)).alias("n")).collect():
        found[kind, size] = n
    return found[0], found[1]


def _round(spark: SparkSession, state: DataFrame, gaps: np.ndarray, items: np.ndarray, capacity: int) -> DataFrame:
    """The state after one sweep. kind: 0 gap, 1 open piece, 2 placed piece."""
    opened = openers(gaps, items, capacity)
    base, placed = sweep(gaps, items - opened)
    smallest = int(np.flatnonzero(items).min())
    rows = []
    for kind, count in ((0, gaps), (1, items)):
        for size in np.flatnonzero(count).tolist():
            parts = max(1, -(-int(count[size]) // PART))
            below, new, matched = (int(base[size]), 0, 0) if kind == 0 else (int(base[size] + gaps[size]), int(opened[size]), int(placed[size]))
            rows.append((kind, size, parts, below, new, matched))
    classes = small_table(spark, rows, "kind int, size int, parts int, level long, opened long, matched long")
    kept = state.where((F.col("kind") == 1) | (F.col("kind") == 0) & (F.col("size") >= smallest))
    salted = kept.join(classes, ["kind", "size"]).withColumn("part", F.pmod(F.xxhash64("pid"), F.col("parts")))
    # One column for kind, size and part, so that ranking is never dealt by kind and size alone.
    cell = F.shiftleft((F.col("size") * 2 + F.col("kind")).cast("long"), 40) + F.col("part")
    salted = salted.withColumn("cell", cell)
    sizes = salted.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.shiftright("cell", 40)).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = salted.withColumn("at", F.row_number().over(Window.partitionBy("cell").orderBy("pid")) - 1)
    ranked = ranked.join(starts, "cell").withColumn("rank", F.col("first") + F.col("at"))
    behind = F.col("rank") - F.col("opened")
    level = (
        F.when(F.col("kind") == 0, F.col("level") + F.col("rank") + 1)
        .when((behind >= 0) & (behind < F.col("matched")), F.col("level") - behind)
        .otherwise(-1 - F.abs(F.xxhash64("pid") % 2**40))  # opens a sequence, or waits: alone on its level
    )
    order = Window.partitionBy("lvl").orderBy(F.desc("size"), "kind", "pid")
    row = F.struct("kind", "pid", "size", "seq", "used")
    events = ranked.withColumn("lvl", level).select(*STATE, "lvl", (F.col("kind") * (behind < 0).cast("int")).alias("opens"))
    events = events.withColumns({"last": F.lag(row).over(order), "next": F.lead(row).over(order)})
    real = F.col("lvl") > 0
    taken = real & (F.col("kind") == 1) & (F.col("last.kind") == 0)
    filled = real & (F.col("kind") == 0) & (F.col("next.kind") == 1)
    opens = F.col("opens") == 1
    new_gap = F.struct(F.lit(0).alias("kind"), F.col("pid"), (capacity - F.col("size")).alias("size"), F.col("pid").alias("seq"), F.col("size").alias("used"))
    first = F.struct(F.lit(2).alias("kind"), F.col("pid"), F.col("size"), F.col("pid").alias("seq"), F.lit(0).alias("used"))
    after = (
        F.when(opens, F.array(first, new_gap))
        .when(taken, F.array(F.struct(F.lit(2).alias("kind"), F.col("pid"), F.col("size"), F.col("last.seq").alias("seq"), F.col("last.used").alias("used"))))
        .when(filled, F.array(F.struct(F.lit(0).alias("kind"), F.col("pid"), (F.col("size") - F.col("next.size")).alias("size"), F.col("seq"), (F.col("used") + F.col("next.size")).alias("used"))))
        .otherwise(F.array(row))
    )
    return stage(events.select(F.explode(after).alias("r")).select("r.*"), "pack-round")


def best_fit(pieces: DataFrame, capacity: int) -> DataFrame:
    """pid, sequence_id, offset of every row (pid, length) with 1 <= length <= ``capacity``.

    A sequence is named by the pid of its first piece. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    full = pieces.where(F.col("length") >= capacity).select("pid", F.col("pid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    state = pieces.where(F.col("length") < capacity).select(
        F.lit(1).alias("kind"), "pid", F.col("length").cast("int").alias("size"), F.lit(None).cast("long").alias("seq"), F.lit(0).alias("used")
    )
    while True:
        gaps, items = _counts(state, capacity)
        if not items.any():
            return full
        state = _round(spark, state, gaps, items, capacity)
        done = state.where("kind = 2").select("pid", F.col("seq").alias("sequence_id"), F.col("used").cast("long").alias("offset"))
        full = full.unionByName(done)


def pack(
    docs: DataFrame,
    capacity: int = 1024,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str | None = None,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece, its ids if wanted.

    A null text is empty and gives the end id alone. Repeated rows are packed
    each. Other columns are ignored.
    """
    pieces = pieces_of(docs, id_col, text_col, capacity, tokenizer or public_path(), end_id, with_ids)
    places = stage(best_fit(pieces.select("pid", "length"), capacity), "pack-places")
    return pieces.join(places, "pid").select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else [])
    )
