"""Licences: TF-IDF cosine of headers and licence files to templates, then inheritance from the nearest directory.

Terms of the templates get their document frequency over all documents; a term
outside the templates counts as the rarest, each occurrence for itself. Every
run of as many terms as a template has is a sparse vector and gets its cosine
with that template, over the whole text: line breaks, comment marks and what
stands before or after do not matter. A file named like a licence is besides
compared as a whole. It hands its best licence to its directory; files without
one of their own take that of the nearest directory above them.

The cosines of all runs of a text come from running sums: when a run moves on
by one term, its squared length changes by what that term occurs within reach.
Texts whose terms hold too little of a template's vector to reach the limit in
any run (Cauchy-Schwarz) are not looked at further for that template.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import arrow_batches, slices, stage
from locuspark.llm.license_texts import TEMPLATES

#: Least cosine of a match.
LEAST = 0.7
_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"

#: cosine, licence, position of the first term of the run that belongs to the template
Hit = tuple[float, str, int]


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def needed(template: str) -> list[str]:
    """Terms between asterisks."""
    return sorted({t for part in re.findall(r"\*([^*]+)\*", template) for t in terms(part)})


class _Runs:
    """The terms of one text and the squared lengths of its runs."""

    def __init__(self, ids: np.ndarray, weight: np.ndarray, reach: int) -> None:
        self.ids, self.n, self.stride = ids, len(ids), len(ids) + reach + 1
        self.weight = weight[ids]
        self.known = np.flatnonzero(ids < len(weight) - 1)
        self.keys = ids[self.known].astype("int64") * self.stride + self.known
        self.sorted = np.sort(self.keys)
        self.place = np.searchsorted(self.sorted, self.keys)

    def sums(self, values: np.ndarray, size: int, leaving: np.ndarray | None = None) -> np.ndarray:
        """Sum of every run of ``size`` terms, by its last term; the first runs are shorter."""
        total = np.cumsum(values)
        gone = total if leaving is None else np.cumsum(leaving)
        if self.n > size:
            total[size:] -= gone[:-size].copy()
        return total

    def squares(self, size: int) -> np.ndarray:
        before = self.place - np.searchsorted(self.sorted, self.keys - (size - 1))
        after = np.searchsorted(self.sorted, self.keys + (size - 1), "right") - self.place - 1
        base = self.weight**2
        enter, leave = base.copy(), base.copy()
        enter[self.known] *= 2 * before + 1
        leave[self.known] *= 2 * after + 1
        return self.sums(enter, size, leave)


class Matcher:
    """Unit vectors of the templates under given document frequencies."""

    def __init__(self, templates: Mapping[str, tuple[str, ...]], frequency: Mapping[str, int], documents: int, least: float) -> None:
        listed = [(name, x) for name, lines in sorted(templates.items()) for x in lines if terms(x)]
        self.least = least
        self.ids = {t: i for i, t in enumerate(sorted({t for _, x in listed for t in terms(x)}))}
        self.words = frozenset(self.ids)
        idf = [float(np.log((1 + documents) / (1 + frequency.get(t, 0))) + 1) for t in self.ids]
        self.weight = np.array([*idf, float(np.log(1 + documents) + 1)])  # the last is that of all other terms
        self.names = [name for name, _ in listed]
        self.sizes = [len(terms(x)) for _, x in listed]
        self.keys = [[self.ids[t] for t in needed(x)] for _, x in listed]
        self.unit = np.zeros((len(listed), len(self.weight)))
        for row, (_, x) in zip(self.unit, listed):
            for t, n in Counter(terms(x)).items():
                row[self.ids[t]] = n * self.weight[self.ids[t]]
            row /= np.sqrt((row**2).sum())
        self.must = np.zeros(self.unit.shape)
        for row, keys in zip(self.must, self.keys):
            row[keys] = 1

    def possible(self, words: list[str]) -> list[int]:
        """Templates that some run of these terms may match."""
        have = np.zeros(len(self.weight))
        have[[self.ids[t] for t in self.words.intersection(words)]] = 1
        enough = (self.unit**2) @ have >= (self.least - 1e-9) ** 2
        return np.flatnonzero(enough & (self.must @ have >= self.must.sum(axis=1))).tolist()

    def scan(self, text: str, whole: bool = False) -> tuple[float, str, int] | None:
        """(cosine, licence, line number from 0) of the best match.

        The highest cosine counts, then the first place, then the name.
        ``whole``: the text as one run is compared too.
        """
        low = text.lower()
        words = _TERM.findall(low)
        hits = self._runs(words, self.possible(words), whole) if words else []
        if not hits:
            return None
        cosine, name, place = min(hits, key=lambda h: (-h[0], h[2], h[1]))
        for i, m in enumerate(_TERM.finditer(low)):
            if i == place:
                return cosine, name, low.count("\n", 0, m.start())
        raise AssertionError("a match lies inside its text")

    def _runs(self, words: list[str], templates: list[int], whole: bool) -> list[Hit]:
        if not templates:
            return []
        other, n = len(self.weight) - 1, len(words)
        ids = np.fromiter((self.ids.get(w, other) for w in words), "int32", n)
        runs = _Runs(ids, self.weight, max(n, *self.sizes) if whole else max(self.sizes))
        squares: dict[int, np.ndarray] = {}
        hits: list[Hit] = []
        for i in templates:
            part = runs.weight * self.unit[i][ids]
            for size in {self.sizes[i], n} if whole else {self.sizes[i]}:
                if size not in squares:
                    squares[size] = runs.squares(size)
                cosine = np.round(runs.sums(part, size) / np.sqrt(squares[size]), 9)
                for key in self.keys[i]:
                    cosine[runs.sums((ids == key).astype("float64"), size) < 0.5] = 0
                end = int(np.argmax(cosine)) if size == self.sizes[i] else n - 1
                if cosine[end] >= self.least:
                    start = max(0, end - size + 1)
                    hits.append((float(cosine[end]), self.names[i], start + int(np.argmax(part[start : end + 1] > 0))))
        return hits


def _frequencies(texts: DataFrame, words: frozenset[str]) -> tuple[dict[str, int], int]:
    """In how many documents each template term occurs, over whole texts; and the number of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in slices(batches, "text"):
            for t in batch.column("text").to_pylist():
                total.update(words.intersection(_TERM.findall(t.lower())))
                total[""] += 1
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["term", "n"])

    rows = texts.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    found = {r["term"]: r["n"] for r in rows}  # bounded by the templates
    return found, found.pop("", 0)


def _named_like_licence() -> Column:
    return F.element_at(F.split("path", "/"), -1).rlike(_LICENCE_FILE)


def scan_licenses(
    files: DataFrame,
    path: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Mapping[str, tuple[str, ...]] = TEMPLATES,
    least: float = LEAST,
) -> DataFrame:
    """doc_id, path, own_license, own_score, own_line, license, inherited_from of every row.

    ``path`` is a text column with ``/`` between names. A null text is empty, a
    null path belongs to no directory. ``own_line`` is the line, from 0, where the
    match begins. Of several matches the highest cosine (to 9 places) counts, then
    the first place, then the name. Of several licence files of a directory
    the one with the highest cosine counts, then the first path. Very long texts
    are compared in whole. Repeated rows stay, other columns are ignored, an empty
    table gives an empty result.
    """
    texts = arrow_batches(files.select(files[id_col].alias("doc_id"), path.cast("string").alias("path"), F.coalesce(files[text_col].cast("string"), F.lit("")).alias("text")))
    texts = texts.withColumn("whole", F.coalesce(_named_like_licence(), F.lit(False)))
    words = frozenset(t for lines in templates.values() for x in lines for t in terms(x))
    matcher = Matcher(templates, *_frequencies(texts, words), least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            files = zip(batch.column("text").to_pylist(), batch.column("whole").to_pylist())
            best = [matcher.scan(text, whole) or (None, None, None) for text, whole in files]
            new = [pa.array(c, k) for c, k in zip(zip(*best), (pa.float64(), pa.string(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("path"), *new], names=["doc_id", "path", "own_score", "own_license", "own_line"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    found = stage(texts.mapInArrow(run, f"doc_id {kind}, path string, own_score double, own_license string, own_line int"), "license-files")
    return inherit(found).select("doc_id", "path", "own_license", "own_score", "own_line", "license", "inherited_from")


def inherit(found: DataFrame) -> DataFrame:
    """Add license and inherited_from (a directory): that of the nearest directory with a licence file.

    Directories, not files, are joined with their ancestors, so a directory with
    very many files is one row there.
    """
    folder = F.when(F.instr("path", "/") > 0, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.when(F.col("path").isNotNull(), ""))
    placed = found.withColumn("folder", folder)
    holders = placed.where(_named_like_licence() & F.col("own_license").isNotNull())
    given = stage(
        holders.groupBy(F.col("folder").alias("above")).agg(F.min(F.struct(-F.col("own_score"), "path", "own_license")).alias("best")).select("above", F.col("best.own_license").alias("license")),
        "license-folders",
    )
    folders = stage(placed.select("folder").where("folder is not null").distinct(), "license-all-folders")
    steps = F.split("folder", "/")
    above = folders.select("folder", F.explode(F.sequence(F.lit(0), F.size(steps))).alias("depth")).withColumn(
        "above", F.array_join(F.slice(F.split("folder", "/"), 1, F.col("depth")), "/")
    )
    nearest = above.join(given, "above").groupBy("folder").agg(F.max(F.struct("depth", "above", "license")).alias("near"))
    nearest = stage(nearest.select("folder", F.col("near.above").alias("from"), F.col("near.license").alias("from_license")), "license-nearest")
    joined = placed.join(nearest, "folder", "left")
    own = F.col("own_license").isNotNull()
    return joined.withColumns({"license": F.coalesce("own_license", "from_license"), "inherited_from": F.when(~own, F.col("from"))})
