"""Hard negatives with Fagin's threshold algorithm over sorted lists of vector components.

Rows lie in blocks of one label. A block has, for every dimension, the list of
its rows in the order of that component. An anchor reads the lists in step, from
the top where its own component is positive and from the bottom where it is
negative, scores each row it meets by random access to the whole vector, and
keeps the best. No row that was not met can score more than the threshold, the
anchor's product with the components at the present depth; once that is strictly
below the k-th score of every window the block is done.

The first search takes each anchor's positives from the blocks of its own label.
They fix the windows, ranges of scores, for which the second search takes
negatives from the blocks of other labels. Blocks of one lot are met in descending
order of length and hand on the k-th scores; what lots find is merged by a rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locuspark.llm.common import stage, staged_in_batches

#: Rows of a block of candidates and of anchors.
BLOCK, ANCHOR_BLOCK = 8192, 1024
#: Depth of the first read; each later one goes four times as deep.
DEPTH = 16
#: Integers below this are exact as floating-point numbers.
EXACT = 2.0**52
NONE = -(2**62)

BLOCKS = "block long, label long, n int, dims int, ids binary, values binary, orders binary, windows binary, top double"
_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
_SCHEMA = pa.schema(list(zip(_NAMES, [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.float64()])))


def labelled_vectors(table: DataFrame, label: Column, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """vec_id, label, v: integer vectors; rows with a null id, label or vector, or a null or non-finite component, go."""
    x = F.transform(table[vector_col], lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = table.select(table[id_col].cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("x"), bad.alias("bad"))
    rows = rows.where("vec_id is not null and label is not null and x is not null and not bad")
    return rows.select("vec_id", "label", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("v"))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of numbers, shorter lists filled up with zeros."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dims), np.int64)
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(lists)), sizes), at] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _packed(table: pa.Table, number: int, dims: int, wide: int, lists: bool) -> dict:
    values = _matrix(table["v"].combine_chunks(), dims)
    orders = np.argsort(values, axis=0, kind="stable").T.astype("<u2").tobytes() if lists else b""
    windows = np.tile([0, -1], (len(values), wide // 2))  # empty where a row has fewer
    if wide:
        given = table["windows"].combine_chunks()
        kept = np.arange(wide) < np.diff(given.offsets.to_numpy())[:, None]
        windows[kept] = given.flatten().to_numpy(zero_copy_only=False)
    ids = table["vec_id"].to_numpy().astype("<i8").tobytes()
    return {
        "block": number, "label": table["label"][0].as_py(), "n": len(values), "dims": dims, "ids": ids, "values": values.astype("<i8").tobytes(),
        "orders": orders, "windows": windows.astype("<i8").tobytes(), "top": table["length"][0].as_py(),
    }


def _blocks(rows: DataFrame, dims: int, most: int, wide: int = 0, lists: bool = True) -> DataFrame:
    """Blocks of rows of one label in descending order of length; ``wide`` numbers a row are carried as its windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        label, count, made = None, 0, 0

        def out() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            return pa.RecordBatch.from_pylist([_packed(table, table["part"][0].as_py() * 2**32 + made, dims, wide, lists)], _SCHEMA)

        for batch in batches:
            labels = batch.column("label").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(labels)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(cuts, cuts[1:]):
                while a < b:
                    if count and (label != labels[a] or count == most):
                        yield out()
                        held, count, made = [], 0, made + 1
                    label, more = labels[a], min(b - a, most - count)
                    held.append(batch.slice(a, more))
                    a, count = a + more, count + more
        if count:
            yield out()

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, v: a + v * v))
    order = ["label", F.desc("length"), "vec_id"]
    placed = rows.withColumn("length", length).repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stage(placed.withColumn("part", F.spark_partition_id().cast("long")).mapInArrow(run, BLOCKS), "negatives-blocks")


class Block:
    """Vectors with one sorted list per dimension."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.values = np.frombuffer(row["values"], "<i8").reshape(row["n"], row["dims"])
        self.largest = float(np.abs(self.values).max(initial=0))
        self.real = self.values.astype(float)
        if row["orders"]:
            self.orders = np.frombuffer(row["orders"], "<u2").reshape(row["dims"], row["n"])
            self.sorted = np.take_along_axis(self.values.T, self.orders.astype(np.int64), axis=1)

    def read(self, anchor: np.ndarray, name: int, windows: list[Best]) -> int:
        """Offer the rows of other ids to the windows of an anchor, by sorted and random access; how many rows were met."""
        n, dims = len(self.ids), len(anchor)
        other = self.ids != name
        exact = self.largest * float(np.abs(anchor).max(initial=0)) * max(dims, 1) < EXACT
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        met, scores = np.zeros(n, bool), np.zeros(n, np.int64)
        depth = 0
        while True:
            # The threshold of the rows not met yet; a zero component takes no list.
            if depth < n:
                threshold = int(anchor[up] @ self.sorted[up, n - 1 - depth] + anchor[down] @ self.sorted[down, depth])
            if depth >= n or all(threshold < w.least(scores[met & other]) for w in windows):
                break
            further = min(n, max(DEPTH, 4 * depth))
            new = np.zeros(n, bool)
            new[self.orders[up, n - further : n - depth].ravel()] = True
            new[self.orders[down, depth:further].ravel()] = True
            if further == n:
                new[:] = True  # also for an anchor of zeros, which reads no list
            new &= ~met
            some = np.flatnonzero(new)
            scores[some] = (self.real[some] @ anchor.astype(float)).astype(np.int64) if exact else self.values[some] @ anchor
            met |= new
            depth = further
        rows = np.flatnonzero(met & other)
        for w in windows:
            w.take(scores[rows], self.ids[rows])
        return len(rows)


class Best:
    """The k best of the scores between low and high, ties by id."""

    def __init__(self, k: int, low: int, high: int) -> None:
        self.k, self.low, self.high = k, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self, scores: np.ndarray) -> float:
        """What a further row must reach to matter, when these were met."""
        if self.low > self.high:
            return np.inf
        floor = int(self.scores[-1]) if len(self.scores) >= self.k else self.low
        good = scores[(scores >= floor) & (scores <= self.high)]
        good = np.concatenate([self.scores, good])
        return max(floor, int(np.partition(good, len(good) - self.k)[len(good) - self.k])) if len(good) >= self.k else floor

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        floor = int(self.scores[-1]) if len(self.scores) >= self.k else self.low
        good = (scores >= floor) & (scores <= self.high)
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


def _search(anchors: DataFrame, candidates: DataFrame, same: bool, k: int, wide: int, label: str) -> DataFrame:
    """anchor_id, window, vec_id, score: the best of every lot for each window of each anchor.

    A task has a block of anchors, sent once, and after it the candidate blocks of
    a lot, the longest vectors first.
    """
    spark = anchors.sparkSession
    lots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Block | None = None
        windows: list[list[Best]] = []

        def out() -> pa.RecordBatch:
            rows = [(a, w, b) for a, own in zip(asked.ids.tolist(), windows) for w, b in enumerate(own)]
            sizes = [len(b.ids) for _, _, b in rows]
            none = np.zeros(0, np.int64)
            arrays = [np.repeat([a for a, _, _ in rows], sizes), np.repeat([w for _, w, _ in rows], sizes)]
            arrays += [np.concatenate([none, *(b.ids for _, _, b in rows)]), np.concatenate([none, *(b.scores for _, _, b in rows)])]
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in arrays], names=["anchor_id", "window", "vec_id", "score"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["asks"]:
                    if asked is not None:
                        yield out()
                    asked = Block(row)
                    ranges = np.frombuffer(row["windows"], "<i8").reshape(row["n"], -1, 2).tolist() if wide else [[(NONE, -NONE)]] * row["n"]
                    windows = [[Best(k, lo, hi) for lo, hi in own] for own in ranges]
                    continue
                block = Block(row)
                for anchor, name, own in zip(asked.values, asked.ids, windows):
                    block.read(anchor, name, own)
        if asked is not None:
            yield out()

    keys = anchors.select(F.col("block").alias("a_block"), F.col("label").alias("a_label"))
    dealt = candidates.withColumn("lot", F.pmod(F.xxhash64("block"), F.lit(lots)).cast("int"))
    if same:
        met = dealt.join(keys, F.col("label") == F.col("a_label"))
    else:
        met = dealt.join(keys.select("*", F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot")), "lot").where("label != a_label")
    places = stage(met.select("lot", "a_block").distinct(), "negatives-places")
    sent = anchors.join(places.withColumnRenamed("a_block", "block"), "block").select("lot", F.col("block").alias("a_block"), F.lit(True).alias("asks"), *_NAMES)
    both = sent.unionByName(met.select("lot", "a_block", F.lit(False).alias("asks"), *_NAMES))
    placed = both.repartition("lot", "a_block").sortWithinPartitions("lot", "a_block", F.desc("asks"), F.desc("top"), "block")
    return staged_in_batches(placed.select("asks", *_NAMES).mapInArrow(run, "anchor_id long, window long, vec_id long, score long"), label, 4)


def mine(
    table: DataFrame,
    anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    block: int = BLOCK,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor is a row where ``anchor`` (over vec_id) holds. Its positives are the
    ``positives`` best other rows of its label, by integer inner product and then
    by id. Negatives of a positive of score p are the ``negatives`` best rows of
    other labels whose score lies between ``low`` and ``high`` percent of p.

    Rows that take no part are named at ``labelled_vectors``; shorter vectors count
    as filled up with zeros. Rows of the anchor's id are never its positives or
    negatives. Other repeated ids are rows of their own; of a repeated anchor, the
    row of the smallest label and vector asks. Anchors without a positive, and
    windows without a row, give no rows; nor does an empty table. Scores are 64-bit
    integers and must stay within them. Other columns are ignored.
    """
    rows = stage(labelled_vectors(table, label, id_col, vector_col, scale), "negatives-vectors")
    dims = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    asking = rows.where(anchor).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("a")).select("vec_id", "a.label", "a.v")
    asking = stage(asking, "negatives-anchors")
    candidates = _blocks(rows, dims, min(block, 65535))
    found = _search(_blocks(asking, dims, anchor_block, lists=False), candidates, True, positives, 0, "negatives-positives")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id")
    first = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    first = stage(first.select("anchor_id", (F.col("place") - 1).cast("long").alias("window"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-first")
    # ceil(low * p / 100) to floor(high * p / 100), in integers
    p = F.col("positive_score")
    floored = "({0} - pmod({0}, 100L)) div 100L"
    bounds = first.select("anchor_id", "window", (p * -low).alias("lo"), (p * high).alias("hi"))
    ends = F.struct("window", F.expr("-(" + floored.format("lo") + ")").alias("lo"), F.expr(floored.format("hi")).alias("hi"))
    bounds = bounds.select("anchor_id", ends.alias("w"))
    bounds = bounds.groupBy("anchor_id").agg(F.array_sort(F.collect_list("w")).alias("w"))  # at most ``positives`` of them
    flat = F.flatten(F.transform("w", lambda w: F.array(w["lo"], w["hi"])))
    asking = asking.join(bounds, asking["vec_id"] == bounds["anchor_id"]).select("vec_id", "label", "v", flat.alias("windows"))
    found = _search(_blocks(asking, dims, anchor_block, 2 * positives, lists=False), candidates, False, negatives, 2 * positives, "negatives-found")
    best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= negatives)
    return ranked.join(first, ["anchor_id", "window"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
