"""Language by the nearest of several centroids per language of TF-IDF letter n-grams.

Texts become hashed counts of one to three neighbouring letters (words are set
off by blanks), damped, weighted by inverse document frequency over all learning
documents and normalised. Spherical k-means gives each language a few centroids,
fitted on a bounded sample. A text gets the language of the centroid with the
largest cosine; one that is farther from all centroids than learning documents
of that language and about that length are is rejected. Those distances are to
centroids fitted without the document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import arrow_batches, held_out, slices, text_of

UNKNOWN = "und"
#: Hashed n-grams; the documented sample bound of the centroid fit, per language; centroids per language.
DIMENSIONS, SAMPLE, CENTROIDS = 4096, 1500, 3
#: A text is rejected below this share of the cosine that 99 of 100 learning documents of its length reach.
REJECT_SHARE = 0.8
#: Length classes (powers of two n-grams), and learning documents that are thinned to each of them, per language.
LENGTHS, THINNED = 18, 100
#: Letters counted at once.
PIECE = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngram_counts(text: str) -> np.ndarray | None:
    """Hashed n-gram counts of the whole text; None if it has no letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    # A stretch without letters is one blank.
    keep = letter | np.concatenate([[False], letter[:-1]])
    c = np.where(letter, codes, 32)[keep].astype(np.uint32)
    c = np.concatenate([np.array([32], np.uint32), c, np.array([32], np.uint32)])
    out = np.zeros(DIMENSIONS, np.int64)
    for a in range(0, len(c), PIECE):
        part = c[a : a + PIECE + 2]
        new = part[:PIECE]
        one = new * np.uint32(0x9E3779B1)
        pair = part[:-1] * np.uint32(0x85EBCA6B) + part[1:] * np.uint32(0xC2B2AE35)
        three = pair[:-1] * np.uint32(0x27D4EB2F) + part[2:] * np.uint32(0x165667B1)
        for hashed in (one, pair[:PIECE] + np.uint32(0x5BD1E995), three[:PIECE] ^ np.uint32(0x1B873593)):
            hashed ^= hashed >> np.uint32(15)
            hashed *= np.uint32(0x2C1B3C6D)
            out += np.bincount(hashed >> np.uint32(20), minlength=DIMENSIONS)
    return out


def vectors(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Damped counts of each text, and which texts have letters."""
    out, has = np.zeros((len(texts), DIMENSIONS), np.float32), np.zeros(len(texts), bool)
    for k, t in enumerate(texts):
        counts = ngram_counts(t) if t else None
        if counts is not None:
            out[k], has[k] = np.log1p(counts), True
    return out, has


def _normalised(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit rows; the first ones are picked far from one another."""
    rng = np.random.default_rng(seed)
    centres = x[rng.integers(len(x))][None]
    while len(centres) < min(k, len(x)):
        far = 1 - (x @ centres.T).max(axis=1)
        centres = np.vstack([centres, x[int(np.argmax(far))]])
    for _ in range(rounds):
        own = (x @ centres.T).argmax(axis=1)
        sums = np.vstack([x[own == j].sum(axis=0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = _normalised(sums)
    return centres.astype(np.float32)


def _length(x: np.ndarray) -> np.ndarray:
    """Length class of damped counts."""
    return np.clip(np.log2(np.maximum(np.expm1(x).sum(axis=1), 1)), 0, LENGTHS - 1).astype(np.int64)


def _rejection_limits(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Least cosine of a language by length class, from damped counts of its learning documents.

    Each half is measured against centroids of the other. Short texts reach less,
    and may be rare: some documents are thinned at random to every shorter length.
    """
    unit = _normalised(x * idf)
    halves = [np.arange(k, len(x), 2) if len(x) > 1 else np.arange(len(x)) for k in (0, 1)]
    centres = [spherical_kmeans(unit[h], CENTROIDS) for h in halves]
    rng = np.random.default_rng(9)
    cosines: list[list[np.ndarray]] = [[] for _ in range(LENGTHS)]
    for own, c in zip(halves, centres[::-1]):
        reached, length = (unit[own] @ c.T).max(axis=1), _length(x[own])
        for k in range(LENGTHS):
            cosines[k].append(reached[length == k])
            longer = own[length > k][: THINNED // 2]
            if len(longer):
                counts = np.rint(np.expm1(x[longer])).astype(np.float64)
                thin = rng.multinomial(3 << k >> 1, counts / counts.sum(axis=1, keepdims=True))
                cosines[k].append((_normalised(np.log1p(thin) * idf) @ c.T).max(axis=1))
    limits = [float(np.quantile(np.concatenate(c), 0.01)) if sum(map(len, c)) else np.inf for c in cosines]
    # No class asks for more than a longer one; beyond the longest text, the same as for it.
    limits = np.minimum.accumulate(np.array(limits)[::-1])[::-1]
    return REJECT_SHARE * np.where(np.isinf(limits), limits[np.isfinite(limits)].max(), limits)


@dataclass(frozen=True)
class Model:
    """languages[k] belongs to centroids[k], least[k] are its limits by length; its size is fixed by the parameters and the number of languages."""

    languages: tuple[str, ...]
    idf: np.ndarray
    centroids: np.ndarray
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and whether the text is too far from all centroids."""
        x, has = vectors(texts)
        if not len(self.languages):
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = _normalised(x * self.idf) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.where(has, np.clip(cosine[np.arange(len(texts)), best], 0, 1), 0.0).astype(float)
        return [self.languages[b] if h else UNKNOWN for b, h in zip(best, has)], score, ~has | (score < self.least[best, _length(x)])


def _document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each hashed n-gram occurs; summed by Spark to a row per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS + 1, np.int64)
        for batch in slices(batches, "text"):
            for t in batch.column("text").to_pylist():
                counts = ngram_counts(t)
                if counts is not None:
                    total[:DIMENSIONS] += counts > 0
                    total[DIMENSIONS] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["dim", "n"])

    sums = np.zeros(DIMENSIONS + 1, np.int64)
    for dim, n in texts.select("text").mapInArrow(run, "dim long, n long").groupBy("dim").agg(F.sum("n")).collect():
        sums[dim] = n
    return sums[:DIMENSIONS], int(sums[DIMENSIONS])


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Learn from the rows where ``learn`` holds and text and language are not null.

    Document frequencies are over all of them; the centroids of a language are
    fitted on its ``sample`` documents with the smallest id hashes.
    """
    known = docs.where(learn & docs[text_col].isNotNull() & docs[lang_col].isNotNull())
    texts = arrow_batches(text_of(known, id_col, text_col, lang_col)).withColumnRenamed(lang_col, "lang")
    found, n = _document_frequencies(texts)
    idf = (np.log((1 + n) / (1 + found)) + 1).astype(np.float32)
    counts = {r["lang"]: r["count"] for r in texts.groupBy("lang").count().collect()}  # a row per language
    languages: list[str] = []
    centres, least = [np.zeros((0, DIMENSIONS), np.float32)], []
    for r in sorted(_centred(_samples(texts, counts, sample), idf, sample).collect(), key=lambda r: r["lang"]):
        c = np.frombuffer(r["centres"], np.float32).reshape(-1, DIMENSIONS)
        languages += [r["lang"]] * len(c)
        centres.append(c)
        least += [np.frombuffer(r["least"], np.float64)] * len(c)
    return Model(tuple(languages), idf, np.vstack(centres), np.array(least).reshape(-1, LENGTHS))


def _samples(texts: DataFrame, counts: dict[str, int], sample: int) -> DataFrame:
    """lang, key (id hash), vector: about ``sample`` documents of each language, or a few more, with the smallest id hashes.

    Hashes are uniform: a bound on them that ``sample`` documents are expected to
    meet is known from the counts, so nothing is sorted or shuffled.
    """
    key = F.xxhash64(F.col("doc_id").cast("string"))
    wanted = F.lit(False)
    for lang, n in sorted(counts.items()):
        bound = 2**63 - 1 if n <= sample else int(-(2**63) + sample / n * 2.0**64)
        wanted = wanted | ((F.col("lang") == lang) & (key <= bound))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x, has = vectors(batch.column("text").to_pylist())
            rows = [v.astype(np.float16).tobytes() for v in x[has]]
            mask = pa.array(has)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").filter(mask), batch.column("key").filter(mask), pa.array(rows, pa.binary())], names=["lang", "key", "vector"]
            )

    return texts.where(wanted).select("lang", key.alias("key"), "text").mapInArrow(run, "lang string, key long, vector binary")


def _centred(samples: DataFrame, idf: np.ndarray, sample: int) -> DataFrame:
    """Centroids and limits of each language, fitted in a task that holds its ``sample`` vectors; the driver gets a row per language."""

    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        kept = rows.sort_values(["key", "vector"])[:sample]
        x = np.frombuffer(b"".join(kept["vector"]), np.float16).astype(np.float32).reshape(len(kept), DIMENSIONS)
        c = spherical_kmeans(_normalised(x * idf), CENTROIDS)
        limits = _rejection_limits(x, idf).astype(np.float64)
        return pd.DataFrame({"lang": [kept["lang"].iloc[0]], "centres": [c.tobytes()], "least": [limits.tobytes()]})

    return samples.groupBy("lang").applyInPandas(learn, "lang string, centres binary, least binary")


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_rejected, which replace columns of these names; its others stay.

    A null text, or one without a letter, is ``und``, scores 0 and is rejected.
    Repeated rows stay, an empty table gives an empty result.
    """
    docs = docs.drop("lang_pred", "lang_score", "lang_rejected")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)
    fields = [f"`{c}` {t}" for c, t in docs.dtypes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            langs, score, rejected = shared.value.predict(batch.column(at).to_pylist())
            new = [pa.array(langs, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*names, "lang_pred", "lang_score", "lang_rejected"])

    return arrow_batches(docs).mapInArrow(run, ", ".join([*fields, "lang_pred string", "lang_score double", "lang_rejected boolean"]))


def fit_held_in(docs: DataFrame, id_col: str = "doc_id", **options) -> Model:
    """A model of the documents outside the held-out fold."""
    return fit(docs, ~held_out(docs[id_col]), id_col, **options)


def recognised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is recognised; all columns, whatever their names, unchanged."""
    model = fit_held_in(docs, id_col, text_col=text_col, lang_col=lang_col)
    numbered = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    found = predict(docs.toDF(*numbered.values()), model, numbered[id_col], numbered[text_col]).where(~F.col("lang_rejected"))
    return found.select(*[F.col(k).alias(c) for c, k in numbered.items()])
