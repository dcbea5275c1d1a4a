"""Exact top-k by inner product: blocks in descending length, rotated partial sums, residual bounds.

Vectors are integers. Their Gram matrix (summed by Spark, one row per matrix row)
gives the singular directions; in the rotated order the first coordinates carry
most of every product. Candidates lie in blocks of descending length. A block of
queries meets the blocks of candidates from the longest on: a pair survives only
if the product of lengths, and then the partial sum plus the Cauchy-Schwarz bound
of the remaining coordinates, can reach the k-th best score so far. Survivors are
scored exactly in integers, so the bounds decide speed alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locuspark.llm.common import stage

#: Rows of a block of candidates and of queries.
BLOCK, QUERY_BLOCK = 4096, 1024
#: The first part of the rotated coordinates, as a share of all.
HEAD = 0.25

BLOCKS = "block long, n int, dims int, ids binary, values binary, norms binary, top double"


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int = 256) -> DataFrame:
    """vec_id and floor(scale * x) of each component; rows with a null id or vector, or a null or non-finite component, go.

    Empty vectors stay: their products are 0.
    """
    x = F.transform(table[vector_col], lambda v: v.cast("double"))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = table.select(table[id_col].cast("long").alias("vec_id"), x.alias("x"), bad.alias("bad"))
    rows = rows.where("vec_id is not null and x is not null and not bad")
    return rows.select("vec_id", F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of integers, shorter vectors filled up with zeros."""
    out = np.zeros((len(column), dims), np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(column)), lengths)
    at = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, at] = values
    return out


def rotation(vectors: DataFrame, dims: int) -> np.ndarray:
    """Orthogonal directions in descending order of what all vectors have along them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((dims, dims))
        for batch in batches:
            x = _matrix(batch.column("v"), dims).astype(float)
            gram += x.T @ x
        at = [pa.array(np.repeat(np.arange(dims), dims)), pa.array(np.tile(np.arange(dims), dims)), pa.array(gram.ravel())]
        yield pa.RecordBatch.from_arrays(at, names=["i", "j", "g"])

    sums = vectors.select("v").mapInArrow(run, "i long, j long, g double").groupBy("i", "j").agg(F.sum("g").alias("g"))
    gram = np.zeros((dims, dims))
    for i, j, g in sums.collect():  # dims x dims
        gram[i, j] = g
    return np.linalg.eigh(gram)[1][:, ::-1].copy()


def _blocks(vectors: DataFrame, dims: int, rows: int) -> DataFrame:
    """Blocks of about ``rows`` vectors in descending order of length; ``top`` is the largest length."""
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, v: a + v * v))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count = block = 0

        def out() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            ids = t["vec_id"].to_numpy()
            norms = t["length"].to_numpy()
            part = t["part"][0].as_py() * 2**32 + block
            x = _matrix(t["v"].combine_chunks() if t["v"].num_chunks != 1 else t["v"].chunk(0), dims)
            row = {"block": part, "n": len(ids), "dims": dims, "ids": ids.astype("<i8").tobytes(), "values": x.astype("<i8").tobytes(), "norms": norms.tobytes(), "top": float(norms.max())}
            schema = pa.schema([("block", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("values", pa.binary()), ("norms", pa.binary()), ("top", pa.float64())])
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            while batch.num_rows:
                some = batch.slice(0, rows - count)
                held.append(some)
                count += some.num_rows
                batch = batch.slice(some.num_rows)
                if count == rows:
                    yield out()
                    held, count, block = [], 0, block + 1
        if count:
            yield out()

    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = vectors.withColumn("length", length).repartitionByRange(n, F.desc("length"), "vec_id")
    placed = placed.sortWithinPartitions(F.desc("length"), "vec_id").withColumn("part", F.spark_partition_id().cast("long"))
    return stage(placed.mapInArrow(run, BLOCKS), "topk-blocks")


class _Search:
    """Best scores of one block of queries so far."""

    def __init__(self, row: dict, turn: np.ndarray, k: int, least: np.ndarray | None = None) -> None:
        self.ids, self.values, self.norms = unpack(row)
        self.turned = self.values @ turn
        self.k = k
        self.score = np.full((len(self.ids), k), -(2**62))
        self.found = np.full((len(self.ids), k), np.iinfo(np.int64).max)

    def meet(self, ids: np.ndarray, values: np.ndarray, norms: np.ndarray, turned: np.ndarray, head: int) -> None:
        floor = self.score[:, -1].astype(float)
        slack = 1e-6 * (1 + self.norms[:, None] * norms[None])  # rounding of the rotated sums
        bound = self.norms[:, None] * norms[None] + slack >= floor[:, None]
        alive = np.flatnonzero(bound.any(axis=1))
        if not len(alive):
            return
        q = self.turned[alive]
        partial = q[:, :head] @ turned[:, :head].T
        rest_q, rest_c = np.linalg.norm(q[:, head:], axis=1), np.linalg.norm(turned[:, head:], axis=1)
        bound = partial + rest_q[:, None] * rest_c[None] + slack[alive] >= floor[alive][:, None]
        for r, mask in zip(alive.tolist(), bound):
            near = np.flatnonzero(mask & (ids != self.ids[r]))
            if not len(near):
                continue
            exact = values[near] @ self.values[r]
            score = np.concatenate([self.score[r], exact])
            found = np.concatenate([self.found[r], ids[near]])
            order = np.lexsort((found, -score))[: self.k]
            self.score[r], self.found[r] = score[order], found[order]

    def rows(self) -> pd.DataFrame:
        real = self.found.ravel() != np.iinfo(np.int64).max
        return pd.DataFrame({"query_id": np.repeat(self.ids, self.k)[real], "vec_id": self.found.ravel()[real], "score": self.score.ravel()[real]})


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], "<i8")
    return ids, np.frombuffer(row["values"], "<i8").reshape(row["n"], row["dims"]), np.frombuffer(row["norms"], float)


def top_k(table: DataFrame, query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: for every row where ``query`` (over vec_id) holds its ``k`` best others.

    Ties go to the smaller id. Rows that take no part are named at
    ``integer_vectors``; shorter vectors count as filled up with zeros. Repeated
    ids are separate candidates, but never found by a query of the same id; a
    repeated query is answered once for its first row. Fewer candidates than
    ``k`` give fewer rows, an empty table none.
    """
    spark = table.sparkSession
    vectors = stage(integer_vectors(table, id_col, vector_col, scale), "topk-vectors")
    dims = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    queries = vectors.where(query).dropDuplicates(["vec_id"])
    turn = rotation(vectors, dims)
    candidates, questions = _blocks(vectors, dims, BLOCK), _blocks(queries, dims, QUERY_BLOCK)
    head = max(1, int(dims * HEAD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: _Search | None = None
        block = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["q_block"] != block:
                    if state is not None:
                        yield pa.RecordBatch.from_pandas(state.rows(), preserve_index=False)
                    block = row["q_block"]
                    state = _Search({c: row[f"q_{c}"] for c in ("n", "dims", "ids", "values", "norms")}, turn, k)
                if row["top"] * state.norms.max(initial=0) * (1 + 1e-6) + 1 < state.score[:, -1].min():
                    continue
                ids, values, norms = unpack(row)
                state.meet(ids, values, norms, values @ turn, head)
        if state is not None:
            yield pa.RecordBatch.from_pandas(state.rows(), preserve_index=False)

    q = questions.select(*[F.col(c).alias(f"q_{c}") for c in ("block", "n", "dims", "ids", "values", "norms")])
    # Every block of queries meets every block of candidates. Lots of candidate blocks, dealt
    # by their place in the order, share the work; each lot holds long vectors and short ones.
    lots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 2)
    met = candidates.withColumn("lot", F.pmod(F.xxhash64("block"), F.lit(lots))).join(q)
    placed = met.repartition("lot", "q_block").sortWithinPartitions("q_block", F.desc("top"), "block")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    found = stage(placed.mapInArrow(run, "query_id long, vec_id long, score long"), "topk-found")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
