"""Ranked lexical search with the NRA method: impact-sorted lists read in sequence, score intervals per document.

1. One pass over the documents counts, for one block of items, every term of the
   items in every document. Documents are dealt to shards of bounded size.
2. Term and document counts are summed over all shards; with them every
   occurrence has an integer impact, and every shard gets, per term, its
   documents in descending order of impact.
3. For an item a shard reads its terms' lists in sequence, a block of each at a
   time. A document's lower bound is the sum of the impacts read for it, its
   upper bound adds the next unread impact of every list it was not met in.
   Reading ends when no document that was not met yet can reach the limit and
   every document whose upper bound reaches it is settled: both bounds equal.
   The limit is the k-th best lower bound of the shard or, if higher, that of the
   first blocks of all shards, which a pass before gathers. A document at the
   limit stays, so ties are settled too.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from locuspark.llm.common import add, arrow_batches, slices, stage, staged_in_batches, text_of
from locuspark.llm.words import item_blocks, words

#: Item text of one pass over the documents.
BLOCK_BYTES = 2_000_000
#: Postings after which a shard is closed; a document is never divided.
SHARD_POSTINGS = 1_000_000
#: Postings of a list read before bounds are looked at first; each later read is twice as long.
READ = 256


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """floor(1000 ln((2N + 2) / (2 df + 1))) of each term."""
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """What an occurrence adds to the score, in 64-bit integers; n is the document's number of terms."""
    m = 50 + (50 * n * n_docs) // max(total, 1)
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


_SHARD = [("docs", pa.int64()), ("total", pa.int64()), ("n", pa.binary()), ("doc", pa.binary()), ("term", pa.binary()), ("tf", pa.binary())]


def _shards(docs: DataFrame, vocabulary: dict[bytes, int], most: int) -> DataFrame:
    """ids, docs (with a term), total (terms), n, and the postings doc, term, tf (doc is a place in ids) by term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    width = max(1, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        ids: list[pa.Array] = []
        parts: list[np.ndarray] = []  # n of each document
        posts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        docs = total = held = count = 0

        def out() -> pa.RecordBatch:
            doc, term, tf = (np.concatenate(x) for x in zip(*posts))
            order = np.argsort(term, kind="stable")
            binary = [np.concatenate(parts).astype("<i8"), *(x[order].astype("<i4") for x in (doc, term, tf))]
            flat = pa.concat_arrays(ids)
            lists = pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)
            arrays = [lists, pa.array([docs], pa.int64()), pa.array([total], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in binary)]
            return pa.RecordBatch.from_arrays(arrays, names=["ids", *(c for c, _ in _SHARD)])

        for batch in slices(batches, "text", 1_000_000):
            split = [words(t) for t in batch.column("text").to_pylist()]
            n = np.array([len(w) for w in split], np.int64)
            found = np.array([get(x, -1) for w in split for x in w], np.int64)
            key = (np.repeat(np.arange(len(n)), n) * width + found)[found >= 0]
            key, tf = np.unique(key, return_counts=True)
            doc, place = np.unique(key // width, return_inverse=True)  # those with a term of an item
            docs, total = docs + int((n > 0).sum()), total + int(n.sum())
            ids.append(batch.column("doc_id").take(pa.array(doc, pa.int64())))
            parts.append(n[doc])
            posts.append((place + count, key % width, tf))
            count, held = count + len(doc), held + len(key)
            if held >= most:
                yield out()
                ids, parts, posts, docs, total, held, count = [], [], [], 0, 0, 0, 0
        if posts:
            yield out()

    kind = docs.schema["doc_id"].dataType.simpleString()
    shards = stage(docs.mapInArrow(run, f"ids array<{kind}>, docs long, total long, n binary, doc binary, term binary, tf binary"), "search-shards")
    sent.destroy()
    return shards


def _numbers(batch: pa.RecordBatch, row: int, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_py(), kind)


def _frequencies(shards: DataFrame, terms: int) -> tuple[np.ndarray, int, int]:
    """Documents per term (in the order of the vocabulary), documents with a term, terms of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                df = np.bincount(_numbers(batch, row, "term", "<i4"), minlength=terms)
                some = np.flatnonzero(df)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(df[some], pa.int64())], names=["term", "df"])

    counts = staged_in_batches(shards.select("term").mapInArrow(run, "term long, df long"), "search-counts", 1)
    df = np.zeros(terms, np.int64)
    for term, n in counts.groupBy("term").agg(F.sum("df")).collect():  # the vocabulary of one block of items
        df[term] = n
    docs, total = shards.agg(F.sum("docs"), F.sum("total")).first()
    return df, int(docs or 0), int(total or 0)


def _lists(shards: DataFrame, df: np.ndarray, n_docs: int, total: int) -> DataFrame:
    """ids, doc, impact, ends: every shard's lists, one behind the other, each in descending order of impact."""
    w = weights(df, n_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                doc, term, tf = (_numbers(batch, row, c, "<i4").astype(np.int64) for c in ("doc", "term", "tf"))
                gain = impacts(w[term], tf, _numbers(batch, row, "n", "<i8")[doc], n_docs, total)
                order = np.lexsort((doc, -gain, term))
                ends = np.searchsorted(term, np.arange(len(w)), "right")
                packed = [doc[order].astype("<i4"), gain[order].astype("<i8"), ends.astype("<i8")]
                yield pa.RecordBatch.from_arrays([batch.column("ids").slice(row, 1), *(pa.array([x.tobytes()], pa.binary()) for x in packed)], names=["ids", "doc", "impact", "ends"])

    kind = shards.schema["ids"].dataType.simpleString()
    lists = shards.where("size(ids) > 0").mapInArrow(run, f"ids {kind}, doc binary, impact binary, ends binary")
    return staged_in_batches(lists, "search-lists", 1)


class Shard:
    """Impact-sorted lists of some documents."""

    def __init__(self, size: int, doc: np.ndarray, impact: np.ndarray, ends: np.ndarray) -> None:
        self.size, self.doc, self.impact = size, doc, impact
        self.begins, self.ends = np.append(0, ends[:-1]), ends

    def _read(self, terms: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray]:
        lists = [(int(self.begins[t]), int(self.ends[t])) for t in terms]
        lists = [(a, b) for a, b in lists if a < b and self.impact[a] > 0]
        return lists, np.zeros(self.size, np.int64), np.zeros((len(lists), self.size), bool)

    def first_bounds(self, terms: np.ndarray, k: int) -> np.ndarray:
        """The k highest lower bounds after the first read of every list."""
        lists, lower, _ = self._read(terms)
        for a, b in lists:
            b = min(b, a + READ)
            lower[self.doc[a:b]] += self.impact[a:b]
        lower = lower[lower > 0]
        return np.sort(lower)[::-1][:k]

    def search(self, terms: np.ndarray, k: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the k best, and their scores; ``limit`` is a score that k documents reach somewhere."""
        lists, lower, seen = self._read(terms)
        at = [a for a, _ in lists]
        step = READ
        while True:
            for j, (_, end) in enumerate(lists):
                stop = min(end, at[j] + step)
                docs = self.doc[at[j] : stop]
                lower[docs] += self.impact[at[j] : stop]
                seen[j, docs] = True
                at[j] = stop
            step *= 2
            rest = np.array([self.impact[p] if p < end else 0 for p, (_, end) in zip(at, lists)], np.int64)
            floor = max(limit, 1)
            if (lower > 0).sum() >= k:
                floor = max(floor, int(np.partition(lower, self.size - k)[self.size - k]))
            # An unmet document lacks every list; a met one what its unread lists can still give.
            top = int(rest.sum())
            near = np.flatnonzero((lower > 0) & (lower + top >= floor))
            upper = lower[near] + rest @ ~seen[:, near] if len(lists) else lower[near]
            near, upper = near[upper >= floor], upper[upper >= floor]
            if top < floor and (upper == lower[near]).all():
                return near, lower[near]


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    shard_postings: int = SHARD_POSTINGS,
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 for each item.

    Equal scores go by ascending id, null ids last. Null and empty texts have no
    terms and are not counted. Rows with the same id are documents of their own,
    repeated rows too; equal rows of ``items`` are one item. Items without terms,
    or whose terms no document has, give no rows; nor does an empty table. Other
    columns are ignored.
    """
    texts = arrow_batches(text_of(docs, id_col, text_col))
    asked, count = item_blocks(items, item_id, item_text, block_bytes)
    asked = stage(asked.distinct(), "search-items")
    found: DataFrame | None = None
    for block in range(count):
        own = asked.where(F.col("block") == block).select("item_id", "text").collect()  # about block_bytes
        found = add(found, _block(texts, block, [(r.item_id, words(r.text)) for r in own], asked.schema["item_id"].dataType.simpleString(), k, shard_postings))
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _block(texts: DataFrame, block: int, items: Sequence[tuple[object, list[bytes]]], kind: str, k: int, shard_postings: int) -> DataFrame:
    """item (a number over all blocks), item_id, doc_id, score: what every shard has to offer for a block of items."""
    spark = texts.sparkSession
    vocabulary: dict[bytes, int] = {}
    asked = [np.array(sorted({vocabulary.setdefault(w, len(vocabulary)) for w in split}), np.int64) for _, split in items]
    shards = _shards(texts, vocabulary, shard_postings)
    df, n_docs, total = _frequencies(shards, len(vocabulary))
    lists = _lists(shards, df, n_docs, total)
    sent = spark.sparkContext.broadcast(asked)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, Shard]]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids").slice(row, 1).flatten()
                yield ids, Shard(len(ids), _numbers(batch, row, "doc", "<i4"), _numbers(batch, row, "impact", "<i8"), _numbers(batch, row, "ends", "<i8"))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, shard in each(batches):
            bounds = [shard.first_bounds(terms, k) for terms in sent.value]
            item = np.repeat(np.arange(len(bounds)), [len(b) for b in bounds])
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(np.concatenate([np.zeros(0, np.int64), *bounds]), pa.int64())], names=["item", "lower"])

    lower = staged_in_batches(lists.mapInArrow(first, "item long, lower long"), "search-bounds", 1)
    best = Window.partitionBy("item").orderBy(F.desc("lower"))
    kth = lower.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).groupBy("item").agg(F.min("lower").alias("limit"), F.count(F.lit(1)).alias("n"))
    limits = spark.sparkContext.broadcast({r.item: r.limit for r in kth.where(F.col("n") == k).collect()})  # a row an item of the block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, shard in each(batches):
            order = np.empty(len(ids), np.int64)
            order[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
            for item, terms in enumerate(sent.value):
                docs, score = shard.search(terms, k, limits.value.get(item, 0))
                top = np.lexsort((order[docs], -score))[:k]
                if len(top):
                    arrays = [pa.array(np.full(len(top), item), pa.int64()), ids.take(pa.array(docs[top], pa.int64())), pa.array(score[top], pa.int64())]
                    yield pa.RecordBatch.from_arrays(arrays, names=["item", "doc_id", "score"])

    id_kind = texts.schema["doc_id"].dataType.simpleString()
    found = staged_in_batches(lists.mapInArrow(run, f"item long, doc_id {id_kind}, score long"), "search-found", 1)
    sent.destroy()
    limits.destroy()
    names = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(items)], f"item long, item_id {kind}")
    return found.join(names, "item").select((F.col("item") + block * 2**32).alias("item"), "item_id", "doc_id", "score")
