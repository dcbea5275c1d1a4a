"""Secrets in whole texts: keyword automaton, anchored patterns near its hits, embedded checksums.

An Aho-Corasick automaton runs over the lower-cased bytes of each text. Only
where a keyword begins is a pattern tried, anchored there. Runs of hexadecimal
digits have no keyword: a run of 16 covers four places in a row of a grid of
step 4, so the grid is looked up first and the pattern tried around its hits.
Tokens that carry a checksum (CRC-32 in base 62) count only if it is right.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from locuspark.llm.common import arrow_batches, slices, text_of

#: Kinds in the order in which spans at the same place are listed. The first three are the base kinds.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = KINDS[:3]

_ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]+")
_GITHUB = re.compile(rb"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_NPM = re.compile(rb"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
_DIGITS62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KEYWORDS = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), "assign"),
    "akia": "access",
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "github"),
    "npm_": "npm",
}
_PATTERNS = {"assign": _ASSIGN, "access": _ACCESS, "github": _GITHUB, "npm": _NPM}
_HEX_BYTE = np.zeros(256, bool)
_HEX_BYTE[list(b"0123456789abcdef")] = True
HEX_LEAST, STEP = 16, 4

SPANS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_checked long"


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, kind in KEYWORDS.items():
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def base62(number: int, width: int = 6) -> bytes:
    digits = []
    for _ in range(width):
        number, d = divmod(number, 62)
        digits.append(_DIGITS62[d])
    return bytes(digits[::-1])


def checksum_holds(token: bytes) -> bool:
    """Whether the last six characters are the CRC-32 of those between prefix and them."""
    return base62(zlib.crc32(token[4:-6])) == token[-6:]


def _accepts(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= 12
    if kind == "access":
        return len(m[0]) >= 18
    return checksum_holds(m[0])


def _hex_runs(raw: bytes) -> Iterator[tuple[int, int]]:
    """Whole runs of at least 16 lower-case hexadecimal digits, in order."""
    if len(raw) < HEX_LEAST:
        return
    grid = _HEX_BYTE[np.frombuffer(raw, np.uint8)[::STEP]]
    hits = np.flatnonzero(grid[:-3] & grid[1:-2] & grid[2:-1] & grid[3:]) * STEP
    end = 0
    for at in hits.tolist():
        if at < end:
            continue
        start = at
        while start > end and _HEX_BYTE[raw[start - 1]]:
            start -= 1
        end = _HEX.match(raw, start).end()
        if end - start >= HEX_LEAST:
            yield start, end


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start and then by kind."""
    raw = text.encode()
    found: list[tuple[str, int, int]] = [("hex", a, b) for a, b in _hex_runs(raw)]
    done = dict.fromkeys(KINDS, 0)
    for last, (kind, length) in _automaton().iter(raw.lower().decode("latin-1")):
        at = last - length + 1
        if at < done[kind]:
            continue
        m = _PATTERNS[kind].match(raw, at)
        if m:
            done[kind] = m.end()
            if _accepts(kind, m):
                found.append((kind, at, m.end()))
    if found and len(raw) != len(text):
        starts = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)  # code points up to each byte
        found = [(k, int(starts[a]) - 1, int(starts[b - 1])) for k, a, b in found]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        rows = []
        for text in batch.column("text").to_pylist():
            spans = find_spans(text)
            base = [s for s in spans if s[0] in BASE]
            counts = [sum(s[0] == k for s in base) for k in BASE]
            rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), len(spans) - len(base)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        names = [c.split()[0] for c in SPANS.split(", ")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *names])


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_checked (checksummed tokens) of every row.

    A null text is empty and has no spans. Repeated rows are scanned each, null
    ids stay, other columns are ignored. Offsets count code points; ends are exclusive.
    """
    texts = arrow_batches(text_of(docs, id_col, text_col))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_run, f"doc_id {kind}, {SPANS}")
