"""Token ids of whole texts with a file of the tokenizers library, inside Arrow tasks.

A byte-level tokenizer cuts a text into words before it merges bytes, and no
word crosses a space that follows a character other than white space. So the
texts of a batch are cut at such spaces in Arrow, every distinct piece of the
batch is encoded once, and the ids of all texts are gathered by numpy. Nothing
is kept from batch to batch but the tokenizer itself. For files of any other
kind whole texts are encoded.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text that is cut and looked up together. A worker takes some twenty times that, and an executor has one on each core.
BATCH_BYTES = 6_000_000
#: Texts given to the library at once, and pieces joined into one of them.
GIVEN, JOINED = 4096, 256
#: Pieces whose ids are gathered at once.
STRUNG = 1 << 17
MARKS = ".,;:!?"
# White space before a space: characters of Unicode's White_Space property, and four control characters that Python counts as such.
_BLANKS = r"\t-\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_BLANK_BEFORE_SPACE = f"[{_BLANKS}] "
_BOUNDARY = re.compile(r"(?<=\S)(?= )")


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and file.

    Spark runs a worker on each core. Threads that the library starts beside them
    only wait for one another, and that costs CPU; whoever wants them sets the variable.
    """
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

    return Encoder(Tokenizer.from_file(path))


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of text, one row at least."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        start = 0
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        for k, n in enumerate(np.nan_to_num(sizes.astype(float))):
            if size and size + n > most:
                held.append(batch.slice(start, k - start))
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size, start = [], 0, k
            size += n
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def splits_at_spaces(tokenizer) -> bool:
    """Whether the file is of the kind whose words never cross a space after another character."""
    rules = json.loads(tokenizer.to_str())
    words = rules.get("pre_tokenizer") or {}
    plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"]) for t in rules.get("added_tokens", ()))
    byte_level = words.get("type") == "ByteLevel" and words.get("use_regex", True) and not words.get("add_prefix_space", True)
    return bool(byte_level and plain and rules.get("normalizer") is None and rules["model"].get("type") == "BPE")


def _strung(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray, entry: np.ndarray, mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces and their marks in order, and how many ids there are up to the end of each piece.

    An id's place takes four times the id's own memory or more; only those of ``STRUNG`` pieces exist at once.
    """
    counts = sizes[entry]
    counts[mark >= 0] += sizes[mark[mark >= 0]]
    upto = np.cumsum(counts)
    ids = np.empty(upto[-1], pool.dtype)
    for a in range(0, len(entry), STRUNG):
        own, behind = entry[a : a + STRUNG], mark[a : a + STRUNG]
        has = behind >= 0
        # One unit for each piece and each mark, and then one number for each id of a unit.
        units = np.cumsum(1 + has)
        unit = np.repeat(own, 1 + has)
        unit[units[has] - 1] = behind[has]
        taken = sizes[unit]
        place = np.repeat(starts[unit] - np.cumsum(taken) + taken, taken)
        place += np.arange(len(place))
        end = upto[a + len(own) - 1]
        ids[end - len(place) : end] = pool[place]
    return ids, upto


class Encoder:
    """Encodes batches of texts."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        size = max(vocabulary.values(), default=0) + 1
        self.kind = np.dtype("<u2" if size <= 65536 else "<u4")
        self.cuts = splits_at_spaces(tokenizer)
        # A character of a byte-level token stands for one byte of the text.
        self.token_bytes = np.zeros(size, np.int64)
        for token, i in vocabulary.items():
            self.token_bytes[i] = len(token)

    def _each(self, texts: Sequence[str]) -> list[np.ndarray]:
        """Ids of each text as it is."""
        out = []
        for a in range(0, len(texts), GIVEN):
            found = self.tokenizer.encode_batch_fast(list(texts[a : a + GIVEN]), add_special_tokens=False)
            out += [np.array(f.ids, dtype=self.kind) for f in found]
        return out

    def _learn(self, pieces: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of pieces behind a space, one after the other, and how many each has.

        Many are joined into one text; byte lengths tell whose ids are whose. None
        may end in white space, which the next one would change.
        """
        starts = np.minimum(np.arange(0, len(pieces) + JOINED, JOINED), len(pieces))
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pieces), " ")
        ends = np.cumsum(pc.binary_length(pieces).to_numpy() + 1)
        found: list[np.ndarray] = []
        for a in range(0, len(texts), 16):
            given = [" " + t for t in texts.slice(a, 16).to_pylist() if t]
            found += [np.array(f.ids, dtype=self.kind) for f in self.tokenizer.encode_batch_fast(given, add_special_tokens=False)]
        if not found:
            return [], np.zeros(0, np.int64)
        upto = np.cumsum(np.concatenate([self.token_bytes[ids] for ids in found]))
        return found, np.diff(np.searchsorted(upto, ends, "left") + 1, prepend=0)

    def encode(self, texts: Sequence[str] | pa.Array) -> list[np.ndarray]:
        """Ids of each text, in the encoder's kind of integers."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        if not self.cuts:
            return self._each(texts.to_pylist())
        runs = pc.match_substring_regex(texts, _BLANK_BEFORE_SPACE)
        cut = pc.split_pattern(texts.filter(pc.invert(runs)), " ")
        flat, ends = cut.flatten(), cut.offsets.to_numpy()[1:] - cut.offsets.to_numpy()[0]
        if pc.any(runs).as_py():
            # A space after white space belongs to a longer run and is no place to cut.
            lists = [[first, *[w[1:] for w in rest]] for first, *rest in map(_BOUNDARY.split, texts.filter(runs).to_pylist())]
            more = pa.array(lists, pa.list_(pa.string()))
            flat = pa.concat_arrays([flat, more.flatten()])
            ends = np.concatenate([ends, (ends[-1] if len(ends) else 0) + more.offsets.to_numpy()[1:]])
        begins = np.append(0, ends[:-1])
        # The start of a text has no space before it; its end, or nothing between two spaces, may be white space.
        alone = pc.match_substring_regex(flat, f"^$|[{_BLANKS}]$").to_numpy(zero_copy_only=False)
        first = np.zeros(len(flat), bool)
        first[begins] = True
        alone |= first
        coded = flat.filter(pa.array(~alone)).dictionary_encode()
        # A mark behind a letter is a word of its own: such a piece is the piece without it, then the mark.
        known = coded.dictionary
        marked = pc.match_substring_regex(known, rf"\p{{L}}[{MARKS}]$").to_numpy(zero_copy_only=False)
        bare = pc.if_else(pa.array(marked), pc.utf8_slice_codeunits(known, 0, -1), known).dictionary_encode()
        last = pc.index_in(pc.utf8_slice_codeunits(known, -1), pa.array(list(MARKS))).fill_null(0).to_numpy()
        ids, sizes = self._learn(bare.dictionary)
        # Single pieces and the marks follow the learned ones.
        singles = [("" if f else " ") + p for f, p in zip(first[alone].tolist(), flat.filter(pa.array(alone)).to_pylist())]
        single = self._each(singles + list(MARKS))
        pool = np.concatenate([*ids, *single])
        sizes = np.concatenate([sizes, np.fromiter(map(len, single), np.int64, len(single))])
        starts = np.cumsum(sizes) - sizes
        entry, mark = np.empty(len(flat), np.int32), np.full(len(flat), -1, np.int32)
        entry[alone] = len(bare.dictionary) + np.arange(len(singles))
        code = coded.indices.to_numpy()
        entry[~alone] = bare.indices.to_numpy()[code]
        mark[~alone] = np.where(marked, len(bare.dictionary) + len(singles) + last, -1)[code]
        del cut, flat, coded, known, bare, alone, first, code
        all_ids, upto = _strung(pool, starts, sizes, entry, mark)
        stops = upto[ends - 1]
        runs = runs.to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [pool[:0]] * len(texts)
        for k, a, b in zip(np.argsort(runs, kind="stable").tolist(), np.append(0, stops[:-1]).tolist(), stops.tolist()):
            out[k] = all_ids[a:b]
        return out
