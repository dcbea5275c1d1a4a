from __future__ import annotations

import json
import os
import random
import subprocess
import sys
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from locuspark.llm import packing, token_files, tokens
from tests.llm.conftest import ODD

TOKENIZER = Tokenizer.from_file(tokens.public_path())


def plain(text, end):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, end], "<u4")


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab é'.,\n\t 　\x1c1<|>s", max_size=40))
def test_chunks_do_not_change_ids(text):
    assert tokens.encoder(tokens.public_path()).encode([text])[0].tolist() == plain(text, 0)[:-1].tolist()


BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u200a\u2028\u2029\u202f\u205f\u3000"


def test_batches_of_texts():
    """Every white space before and behind spaces, texts that are cut and that are not in one batch."""
    rng = random.Random(3)
    texts = [f"a{b} b {b}c {b} d{b}" for b in BLANKS] + ["", " ", "  ", "x", " x", "x ", "<|endoftext|> a <|endoftext|>b"]
    texts += [" ".join(rng.choice(["the", "word", "Wörter,", "12", "it's", "a\n"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    rng.shuffle(texts)
    want = [plain(t, 0)[:-1].tolist() for t in texts]
    enc = tokens.encoder(tokens.public_path())
    for size in (1, 7, 400):
        assert [x.tolist() for a in range(0, len(texts), size) for x in enc.encode(texts[a : a + size])] == want
    assert enc.encode([]) == []


def test_other_tokenizers_encode_whole_texts():
    rules = json.loads(TOKENIZER.to_str())
    assert tokens.splits_at_spaces(TOKENIZER)
    for change in ({"pre_tokenizer": None}, {"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {**rules["pre_tokenizer"], "use_regex": False}}):
        other = Tokenizer.from_str(json.dumps({**rules, **change}))
        assert not tokens.splits_at_spaces(other)
        text = "The  Word the word"
        assert tokens.Encoder(other).encode([text])[0].tolist() == other.encode(text, add_special_tokens=False).ids


def test_gathered_batches_keep_rows_in_order():
    rows = [{"text": "x" * n, "k": i} for i, n in enumerate([5, 0, 40, 3, 3, 3, 100, 1])] + [{"text": None, "k": 8}]
    batches = [pa.RecordBatch.from_pylist(rows[a : a + 4], pa.schema([("text", pa.string()), ("k", pa.int64())])) for a in (0, 4, 8)]
    for most in (1, 10, 45, 1000):
        got = list(tokens.gathered(iter(batches), "text", most))
        assert [r for b in got for r in b.to_pylist()] == rows and all(b.num_rows for b in got)
        assert all(sum(len(r["text"] or "") for r in b.to_pylist()) <= most or b.num_rows == 1 or sum(1 for r in b.to_pylist() if r["text"]) == 1 for b in got)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), max_size=40))
def test_variable_length_round_trip(numbers):
    x = np.array(numbers, "<u4")
    raw = token_files.encode_file(np.array([7]), np.array([len(x)]), x)
    ids, counts, back = token_files.decode_file(raw)
    assert ids.tolist() == [7] and counts.tolist() == [len(x)] and back.tolist() == numbers


def test_token_files_round_trip(table):
    got = token_files.token_files(table(ODD), file_tokens=500).collect()
    rows = sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0))
    start, want = 0, []
    for r in rows:
        x = plain(r[1], 0)
        want.append((r[0], start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert token_files.token_files(table([])).count() == 0


def whole(pieces, rows, capacity, end):
    places, docs = defaultdict(list), defaultdict(list)
    for p in pieces:
        places[p.sequence_id].append((p.offset, p.length))
        docs[p.doc_id].append(p)
    for seq in places.values():
        at = 0
        for offset, length in sorted(seq):
            assert offset == at
            at += length
        assert at <= capacity
    texts = defaultdict(list)
    for r in rows:
        texts[r[0]].append(plain(r[1], end))
    assert set(docs) == set(texts)
    for doc_id, copies in texts.items():
        assert sum(p.length for p in docs[doc_id]) == sum(map(len, copies))
        x = copies[0]
        for p in docs[doc_id]:
            assert zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32
            assert len(x) > capacity or p.length == len(x)
            assert p.piece == 0 or p.length == capacity
    return len(places)


def test_packing_keeps_every_token(table):
    whole(packing.pack(table(ODD)).collect(), ODD, 1024, 2)
    assert packing.pack(table([])).count() == 0


@pytest.mark.parametrize("kind", ["mixed", "same"])
def test_packing_is_near_best_fit(spark, kind):
    rng = random.Random(4)
    sizes = [rng.randint(1, 100) for _ in range(1500)] if kind == "mixed" else [30] * 1500
    rows = spark.createDataFrame(list(enumerate(sizes)), "pid long, length long")
    got = packing.best_fit(rows, 100).collect()
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, sizes[r.pid]))
    assert sorted(r.pid for r in got) == list(range(1500))
    for seq in used.values():
        at = 0
        for offset, size in sorted(seq):
            assert offset == at
            at += size
        assert at <= 100
    gaps = []
    for s in sorted(sizes, reverse=True):
        fit = min((g for g in gaps if g >= s), default=None)
        if fit is None:
            gaps.append(100 - s)
        else:
            gaps.remove(fit)
            gaps.append(fit - s)
    assert len(used) <= 1.03 * len(gaps)


def test_the_library_starts_no_threads_beside_workers():
    code = """if True:
        import os
        from locuspark.llm import tokens
        enc = tokens.encoder(tokens.public_path())
        before = len(os.listdir("/proc/self/task"))
        enc.encode([f"text {i} of a batch, in words{i}" for i in range(3000)])
        print(len(os.listdir("/proc/self/task")) - before)
    """
    clean = {k: v for k, v in os.environ.items() if k not in ("TOKENIZERS_PARALLELISM", "RAYON_NUM_THREADS")}
    done = subprocess.run([sys.executable, "-c", code], env=clean | {"ARROW_NUM_THREADS": "1"}, cwd=Path(__file__).parents[2], capture_output=True, text=True)
    assert done.stdout.split() == ["0"], done.stderr


def test_ids_of_both_widths_are_counted(spark):
    rows = [(np.array([1, 5, 5, 9], "<u2").tobytes(), 2), (np.array([5, 70000], "<u4").tobytes(), 4), (np.array([9], "<u2").tobytes(), 2)]
    found = token_files.frequency_ranks(spark.createDataFrame(rows, "ids binary, width int")).collect()
    assert sorted((r["rank"], r["id"], r["n"]) for r in found) == [(0, 5, 3), (1, 9, 2), (2, 1, 1), (3, 70000, 1)]


def test_a_worker_that_tokenizes_stays_small():
    code = """if True:
        import random, re
        import pyarrow as pa
        from locuspark.llm import tokens
        rng = random.Random(2)
        words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 9))) for _ in range(40000)]
        texts = pa.array([" ".join(rng.choices(words, k=600)) + "." for _ in range(6000)])
        batch = pa.RecordBatch.from_arrays([texts], names=["text"])
        enc = tokens.encoder(tokens.public_path())
        peak = lambda: int(re.search(r"VmHWM:\\s+(\\d+)", open("/proc/self/status").read()).group(1)) / 1024
        before = peak()
        for b in tokens.gathered(iter([batch]), "text"):
            enc.encode(b.column("text"))
        print(batch.nbytes / 1e6 > 18, round(peak() - before))
    """
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"OMP_NUM_THREADS": "1"}, cwd=Path(__file__).parents[2], capture_output=True, text=True)
    large, grown = done.stdout.split()
    assert large == "True" and int(grown) < 120, done.stderr + grown
