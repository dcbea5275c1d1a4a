"""Quality of texts: histogram gradient-boosted trees over document statistics.

Statistics of every whole text are computed in Arrow tasks. Trees are grown level
by level from histograms of binned statistics, on a bounded sample of labelled
documents, and flattened into arrays: a complete tree of fixed depth is a row of
features, thresholds and leaf values, so numpy walks all trees of a batch at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import arrow_batches, held_out, slices, text_of

#: The documented bound of labelled documents a classifier is fitted on.
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, RIDGE, LEAST = 80, 4, 64, 0.15, 1.0, 5.0

STATISTICS = (
    "chars words lines word_mean word_std word_max short_words long_words distinct_words top_word twice_words "
    "distinct_pairs distinct_lines longest_line upper lower digit space control ascii_punct end_marks symbols "
    "brackets other_bytes bare_words marked_words capital_words top_mark entropy"
).split()


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256)
    t[list(chars.encode())] = 1
    return t


_CLASSES = np.array(
    [
        _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        _table("abcdefghijklmnopqrstuvwxyz"),
        _table("0123456789"),
        _table(" \t\n\r\x0b\x0c"),
        np.array([float(i < 32 and chr(i) not in "\t\n\r\x0b\x0c") for i in range(256)]),
        _table("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"),
        _table(".,;:?!"),
        _table("#$%&*+<=>@\\^_`|~"),
        _table("()[]{}"),
        np.array([float(i >= 128) for i in range(256)]),
    ]
)


def statistics(text: str) -> list[float]:
    """The numbers named in ``STATISTICS``; all are 0 for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    freq = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    total = freq.sum()
    shares = (_CLASSES @ freq) / total
    marks = freq * _CLASSES[5]
    p = freq[freq > 0] / total
    return [
        np.log1p(len(text)),
        np.log1p(n),
        np.log1p(len(lines)),
        sizes.mean(),
        sizes.std(),
        min(sizes.max(), 1000),
        (sizes <= 3).mean(),
        (sizes >= 12).mean(),
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / max(n - 1, 1),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(max(map(len, lines), default=0)),
        *shares,
        sum(not any(map(str.isalnum, w)) for w in counts) / len(counts),
        sum(not w[-1].isalnum() for w in counts) / len(counts),
        sum(w[0].isupper() for w in counts) / len(counts),
        marks.max() / total,
        -(p * np.log2(p)).sum(),
    ]


@dataclass(frozen=True)
class Forest:
    """Complete trees: features and thresholds (trees x inner nodes), leaf values (trees x leaves), start value."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        trees, inner = self.feature.shape if self.feature.size else (0, 0)
        margin = np.full(len(x), self.start)
        if trees:
            at = np.zeros((len(x), trees), np.int64)
            column, row = np.arange(trees), np.arange(len(x))[:, None]
            while at.size and at[0, 0] < inner:
                right = x[row, self.feature[column, at]] > self.threshold[column, at]
                at = 2 * at + 1 + right
            margin += self.leaf[column, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def grow(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Forest:
    """Fit trees to rows of statistics and 0/1 labels by gradient and hessian histograms."""
    n, n_f = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3) if n else 0.5
    start = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(1) for f in range(n_f)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1) if n else np.zeros((0, n_f), int)
    flat = binned + np.arange(n_f) * BINS
    margin = np.full(n, start)
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, leaves))
    for t in range(trees if n else 0):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * (n_f * BINS) + flat).ravel()
            shape = (count, n_f, BINS)
            g = np.bincount(slot, np.repeat(grad, n_f), count * n_f * BINS).reshape(shape).cumsum(axis=2)
            h = np.bincount(slot, np.repeat(hess, n_f), count * n_f * BINS).reshape(shape).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
            gain[(h < LEAST) | (h_all - h < LEAST)] = 0
            for k in range(count):
                f, b = divmod(int(gain[k].argmax()), BINS)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    feature[t, first + k], threshold[t, first + k] = f, edges[f][b]
            at_f, at_t = feature[t, node], threshold[t, node]
            node = 2 * node + 1 + (x[np.arange(n), at_f] > at_t)
        own = node - inner
        g, h = np.bincount(own, grad, leaves), np.bincount(own, hess, leaves)
        leaf[t] = -RATE * g / (h + RIDGE)
        margin += leaf[t][own]
    return Forest(feature, threshold, leaf, start)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Forest:
    """Learn from labelled documents where ``learn`` (over the labels' id) holds, from about ``sample`` at most.

    The sample are the documents with the smallest id hashes; the bound on the
    hash comes from the number of labels, so texts are filtered where they are
    read. Null labels, and labels without a document, teach nothing.
    """
    known = labels.where(learn & labels[label_col].isNotNull() & labels[id_col].isNotNull())
    known = known.groupBy(F.col(id_col).alias("label_id")).agg(F.max(label_col).cast("double").alias("label"))
    n = known.count()
    bound = 2**63 - 1 if n <= sample else int(-(2**63) + sample / n * 2.0**64)
    texts = arrow_batches(text_of(docs, id_col, text_col)).where(F.xxhash64(F.col("doc_id").cast("string")) <= bound)
    known = known.where(F.xxhash64(F.col("label_id").cast("string")) <= bound)
    rows = texts.join(known, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "label")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = [np.array(statistics(t), np.float64).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(found, pa.binary())], names=["label", "x"])

    got = rows.select("text", "label").mapInArrow(run, "label double, x binary").collect()
    got.sort(key=lambda r: (r["x"], r["label"]))
    x = np.frombuffer(b"".join(r["x"] for r in got)).reshape(len(got), len(STATISTICS))
    return grow(x, np.array([r["label"] for r in got]))


def score(docs: DataFrame, model: Forest, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row. Null and empty texts score too; repeated rows score each."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # trees x nodes, fixed by the parameters

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = np.array([statistics(t) for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shared.value.score(x))], names=["doc_id", "score"])

    texts = arrow_batches(text_of(docs, id_col, text_col))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, score double")


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted; labels of the held-out fold are not learned from."""
    model = fit(docs, labels, ~held_out(labels[id_col]), id_col, text_col, label_col)
    scored = score(docs, model, id_col, text_col)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
