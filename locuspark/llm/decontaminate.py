"""Benchmark passages in training documents: a generalised suffix automaton of the items' words.

The automaton of a block of items has a state for every class of word sequences
that end at the same places. The words of the documents run through it, and at
each word it knows the longest sequence ending there that some item contains. A
window (``length`` consecutive words of an item, or a whole shorter item) ends
where that sequence is long enough; the window's state is an ancestor in the
tree of suffix links, found in a table. Transitions are sorted arrays and many
stretches of text take their steps together: a pair of neighbours that no item
has ends a stretch, and long stretches are cut with as many words of overlap as
the longest item has, so that every longest sequence lies inside its piece.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuspark.llm.common import arrow_batches, slices, stage, text_of
from locuspark.llm.words import item_blocks, word_places, words

LENGTH = 10
#: Item text in one automaton; about 20 MB of arrays and 20 MB of words.
BLOCK_BYTES = 2_000_000
FOUND = "n_words long, n_hit long, longest long, spans array<struct<start:long,end:long>>, runs array<struct<first:long,last:long>>, items array<string>"


@dataclass
class Automaton:
    """Arrays of a generalised suffix automaton; transition (state, word) has the key state * width + word."""

    vocabulary: dict[bytes, int]
    width: int
    keys: np.ndarray
    to: np.ndarray
    link: np.ndarray
    length: np.ndarray
    first: np.ndarray

    def step(self, state: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Next states, -1 where there is no transition."""
        key = state * self.width + word
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.to[at], -1)

    def suffix(self, m: int) -> np.ndarray:
        """For every state with sequences of ``m`` words or more, the state of their last ``m`` words."""
        out = np.arange(len(self.link))
        while (far := self.length[self.link[out]] >= m).any():
            out[far] = self.link[out[far]]
        return out

    def longest(self, ids: np.ndarray, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """State and length of the longest known sequence that ends at each word; -1 is a word or border no item has.

        Stretches of fewer than ``least`` words are left at 0.
        """
        n = len(ids)
        states, lengths = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if not n or not len(self.keys):
            return states, lengths
        known = ids >= 0
        joint = np.zeros(n, bool)
        both = np.flatnonzero(known[1:] & known[:-1]) + 1
        joint[both] = self.step(self.first[ids[both - 1]], ids[both]) >= 0
        start = np.flatnonzero(known & ~joint)
        end = np.flatnonzero(known & ~np.append(joint[1:], False)) + 1
        some = end - start >= least
        start, end = start[some], end[some]
        # Pieces: bodies of at most ``body`` words, each with ``reach`` words before it.
        reach = int(self.length.max())
        body = max(reach, 256)
        pieces = -(-(end - start) // body)
        turn = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        run_start, run_end = np.repeat(start, pieces), np.repeat(end, pieces)
        own = run_start + turn * body
        begin, stop = np.maximum(run_start, own - reach), np.minimum(own + body, run_end)
        order = np.argsort(begin - stop, kind="stable")  # long pieces first
        begin, stop, own = begin[order], stop[order], own[order]
        sizes = stop - begin
        state, size = self.first[ids[begin]].copy(), np.ones(len(begin), np.int64)
        t, active = 0, len(begin)
        while active:
            at = begin[:active] + t
            if t:
                todo = np.arange(active)
                while len(todo):
                    new = self.step(state[todo], ids[at[todo]])
                    good = new >= 0
                    done, todo = todo[good], todo[~good]
                    state[done] = new[good]
                    size[done] += 1
                    state[todo] = self.link[state[todo]]  # the root knows every word of the vocabulary
                    size[todo] = self.length[state[todo]]
            keep = at >= own[:active]
            states[at[keep]], lengths[at[keep]] = state[:active][keep], size[:active][keep]
            t += 1
            active = int(np.searchsorted(-sizes, -t, "left"))  # pieces with more than t words
        return states, lengths


def suffix_automaton(items: Sequence[Sequence[bytes]]) -> Automaton:
    """The automaton of word sequences. State 0, the empty sequence, links to itself."""
    vocabulary: dict[bytes, int] = {}
    steps: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def copy(p: int, c: int, q: int) -> int:
        new = len(steps)
        steps.append(dict(steps[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = new
        while p >= 0 and steps[p].get(c) == q:
            steps[p][c] = new
            p = link[p]
        return new

    for item in items:
        last = 0
        for word in item:
            c = vocabulary.setdefault(word, len(vocabulary))
            q = steps[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else copy(last, c, q)
                continue
            new = len(steps)
            steps.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in steps[p]:
                steps[p][c] = new
                p = link[p]
            if p >= 0:
                q = steps[p][c]
                link[new] = q if length[q] == length[p] + 1 else copy(p, c, q)
            last = new
    width = max(1, len(vocabulary))
    sizes = np.fromiter(map(len, steps), np.int64, len(steps))
    word = np.fromiter((c for s in steps for c in s), np.int64, int(sizes.sum()))
    to = np.fromiter((q for s in steps for q in s.values()), np.int64, len(word))
    keys = np.repeat(np.arange(len(steps)), sizes) * width + word
    order = np.argsort(keys)
    link[0] = 0
    first = np.zeros(width, np.int64)
    first[word[: len(steps[0])]] = to[: len(steps[0])]
    return Automaton(vocabulary, width, keys[order], to[order], np.array(link), np.array(length), first)


class Windows:
    """Windows of a block of items as states of its automaton, with the items that have them."""

    def __init__(self, items: Sequence[tuple[str | None, str]], length: int) -> None:
        split = [(i, w) for i, text in items if (w := words(text))]
        self.automaton = suffix_automaton([w for _, w in split])
        self.ids = sorted({i for i, _ in split if i is not None})
        number = {i: k for k, i in enumerate(self.ids)}
        get = self.automaton.vocabulary.__getitem__
        ids = [c for _, w in split for c in (*map(get, w), -1)]  # a border follows each item
        states = self.automaton.longest(np.array(ids, np.int64))[0].tolist()
        rows: dict[int, list[tuple[int, int]]] = {}
        end = 0
        for i, w in split:
            m, begin, end = min(length, len(w)), end, end + len(w) + 1
            rows.setdefault(m, []).extend((s, number.get(i, -1)) for s in states[begin + m - 1 : end - 1])
        #: Per window length: state of the last words, the windows' states in order, and the items of each.
        self.by_length = {}
        for m, pairs in rows.items():
            suffix = self.automaton.suffix(m)
            table = np.unique(np.array([(suffix[s], i) for s, i in pairs]), axis=0)
            states, at = np.unique(table[:, 0], return_index=True)
            self.by_length[m] = (suffix, states, np.append(at, len(table)), table[:, 1])
        self.least = min(rows, default=length)

    def find(self, texts: Sequence[str]) -> list[tuple[int, np.ndarray, int, list[str]]]:
        """Of each text: number of words, hit words (sorted positions), longest sequence, items."""
        split = [words(t) for t in texts]
        get = self.automaton.vocabulary.get
        counts = np.array([len(w) for w in split], np.int64)
        begin = np.cumsum(counts + 1) - counts - 1  # a border follows each text
        ids = np.full(int((counts + 1).sum()), -1, np.int64)
        for w, a in zip(split, begin.tolist()):
            ids[a : a + len(w)] = [get(x, -1) for x in w]
        states, lengths = self.automaton.longest(ids, self.least)
        cover = np.zeros(len(ids) + 1, np.int64)
        seen = []
        for m, (suffix, windows, at, owners) in self.by_length.items():
            end = np.flatnonzero(lengths >= m)
            window = suffix[states[end]]
            place = np.minimum(np.searchsorted(windows, window), len(windows) - 1)
            end, place = (x[windows[place] == window] for x in (end, place))
            np.add.at(cover, end - m + 1, 1)
            np.add.at(cover, end + 1, -1)
            text = np.searchsorted(begin, end, "right") - 1
            for k, p in np.unique(np.stack([text, place], 1), axis=0).tolist():
                seen.append((k, owners[at[p] : at[p + 1]]))
        hit = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        items: dict[int, set[int]] = {}
        for k, own in seen:
            items.setdefault(k, set()).update(own.tolist())
        out = []
        for k, (a, c) in enumerate(zip(begin.tolist(), counts.tolist())):
            lo, hi = np.searchsorted(hit, [a, a + c])
            own = sorted(self.ids[i] for i in items.get(k, ()) if i >= 0)
            out.append((c, hit[lo:hi] - a, int(lengths[a : a + c].max(initial=0)), own))
        return out


def runs_of(positions: np.ndarray) -> np.ndarray:
    """First and last of the runs of consecutive numbers, as rows."""
    if not len(positions):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(np.diff(positions) > 1)
    return np.stack([positions[np.append(0, cut + 1)], positions[np.append(cut, len(positions) - 1)]], 1)


def _code_points(text: str, spans: list[tuple[int, int]]) -> list[dict]:
    raw = np.frombuffer(text.encode(), np.uint8)
    before = np.cumsum((raw & 0xC0) != 0x80)  # code points up to and with each byte
    return [{"start": int(before[a]) - 1, "end": int(before[b - 1])} for a, b in spans]


def _pass(docs: DataFrame, items: Sequence[tuple[str | None, str]], length: int, hits_only: bool) -> DataFrame:
    """Rows of ``docs`` (doc_id, key, text) with what one block of items finds in them."""
    sent = docs.sparkSession.sparkContext.broadcast(Windows(items, length))  # one block of items

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = sent.value
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            rows = []
            for text, (n, hit, longest, own) in zip(texts, windows.find(texts)):
                runs = runs_of(hit)
                places = word_places(text) if len(runs) else []
                spans = _code_points(text, [(places[a][0], places[b][1]) for a, b in runs.tolist()])
                rows.append({"n_words": n, "n_hit": len(hit), "longest": longest, "spans": spans, "runs": [{"first": a, "last": b} for a, b in runs.tolist()], "items": own})
            keep = [k for k, r in enumerate(rows) if r["n_hit"] or not hits_only]
            ids = batch.select(["doc_id", "key"]).take(pa.array(keep, pa.int64()))
            found = pa.RecordBatch.from_pylist([rows[k] for k in keep], _ARROW)
            yield pa.RecordBatch.from_arrays([*ids.columns, *found.columns], names=["doc_id", "key", *_ARROW.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = stage(docs.mapInArrow(run, f"doc_id {kind}, key binary, {FOUND}"), "leak-found")
    sent.destroy()
    return found


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RUN = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
_ARROW = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("longest", pa.int64()), ("spans", _SPAN), ("runs", _RUN), ("items", pa.list_(pa.string()))])


def _united(spans: Column, low: str, high: str, gap: int) -> Column:
    """Sorted spans with those that touch (distance at most ``gap``) joined."""

    def put(done: Column, s: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(last[low].alias(low), F.greatest(last[high], s[high]).alias(high))))
        return F.when((F.size(done) > 0) & (last[high] + gap >= s[low]), joined).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast(f"array<struct<{low}:bigint,{high}:bigint>>"), put)


def _content(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _found(docs: DataFrame, items: DataFrame, length: int, id_col: str, text_col: str, item_id: str, item_text: str, block_bytes: int) -> DataFrame:
    texts = text_of(docs, id_col, text_col)
    texts = arrow_batches(texts.select("doc_id", _content(F.col("text")).alias("key"), "text"))
    asked, count = item_blocks(items, item_id, item_text, block_bytes)
    asked = stage(asked.withColumn("item_id", F.col("item_id").cast("string")), "leak-items")
    parts = []
    for block in range(count):
        own = [tuple(r) for r in asked.where(F.col("block") == block).select("item_id", "text").collect()]  # about block_bytes
        parts.append(_pass(texts, own, length, hits_only=block > 0))
    if count == 1:
        return parts[0]
    # Equal rows have equal results: what the blocks found is joined by id and text.
    hits = parts[0].where("n_hit > 0")
    for part in parts[1:]:
        hits = hits.unionByName(part)
    hits = hits.dropDuplicates(["doc_id", "key", "spans", "items"]).groupBy("doc_id", "key").agg(
        F.max("longest").alias("longest"),
        _united(F.flatten(F.collect_list("spans")), "start", "end", 0).alias("spans"),
        _united(F.flatten(F.collect_list("runs")), "first", "last", 1).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    hits = stage(hits.withColumnsRenamed({"doc_id": "h_id", "key": "h_key"}), "leak-hits")
    all_ = parts[0].select("doc_id", "key", "n_words", F.col("longest").alias("own"))
    joined = all_.join(hits, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("key") == F.col("h_key")), "left")
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1)
    none = {c: F.coalesce(c, F.array().cast(hits.schema[c].dataType)).alias(c) for c in ("spans", "runs", "items")}
    return joined.select("doc_id", "key", "n_words", F.coalesce(n_hit, F.lit(0)).alias("n_hit"), F.greatest("own", "longest").alias("longest"), none["spans"], none["runs"], none["items"])


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    length: int = LENGTH,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_hit, longest, spans, items of every row of ``docs``.

    A document's word is hit if it lies in a window of an item: ``length``
    consecutive words of it, or the whole of a shorter item. ``spans`` are the
    hit passages from first to last word (code points, end exclusive), ``items``
    the ids of items with occurring windows, as sorted strings. ``longest`` is the
    longest sequence of words shared with one item, or 0 where no window fits.

    Null and empty texts have no words and no hits. Repeated rows are searched
    each, null ids stay, other columns are ignored. Items without words have no
    windows; items of the same id count once, those of a null id hit words but
    are not listed. Without items nothing is hit. An empty table gives an empty result.
    """
    return _found(docs, items, length, id_col, text_col, item_id, item_text, block_bytes).drop("key", "runs")


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    length: int = LENGTH,
    coverage: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the passages of ``find_passages``, and without rows whose share of hit words exceeds ``coverage``.

    Columns and other texts stay as they are, null texts as well.
    """
    found = _found(docs, items, length, id_col, text_col, item_id, item_text, block_bytes).where("n_hit > 0")
    share = F.col("n_hit") / F.col("n_words")
    found = found.select(F.struct("doc_id", "key", share.alias("share"), "spans").alias("found")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    text = F.col("row")[text_col]
    own = F.col("row")[id_col].eqNullSafe(F.col("found.doc_id")) & (_content(F.coalesce(text.cast("string"), F.lit(""))) == F.col("found.key"))
    joined = rows.join(found, own, "left").where(F.col("found.share").isNull() | (F.col("found.share") <= coverage))
    begin = F.concat(F.array(F.lit(0).cast("long")), F.col("found.spans.end"))
    end = F.concat(F.col("found.spans.start"), F.array(F.length(text).cast("long")))
    rest = F.array_join(F.zip_with(begin, end, lambda a, b: text.substr(a.cast("int") + 1, (b - a).cast("int"))), "")
    cut = F.when(F.col("found").isNotNull(), rest).otherwise(text)
    return joined.select(*[(cut if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
