"""Removal of repeated windows against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from llm_tables import documents  # noqa: F401
from patronage.llm import substring_dedup as sd
from patronage.llm.fm_index import FMIndex, earlier_windows


def brute(rows, n):
    first, out = {}, []
    own = [(sd.LAST_ID if d is None else d, (t or "").encode().split()) for d, t in rows]
    for d, w in own:
        for i in range(len(w) - n + 1):
            k = tuple(w[i:i + n])
            first[k] = min(first.get(k, (d, i)), (d, i))
    for (d, w), (real, _) in zip(own, rows):
        keep = [True] * len(w)
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < (d, i):
                keep[i:i + n] = [False] * n
        kept = b" ".join(x for x, k in zip(w, keep) if k)
        out.append((real, len(w), len(w) - sum(keep), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [20, 6])
def test_against_all_windows(documents, n, monkeypatch):
    rng = random.Random(n)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for d in range(80):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.choice([5, 30, 90, 200]))]
        if d % 3 == 0:
            a = rng.randrange(30)
            w[10:10] = passage[a:a + rng.choice([19, 20, 30])]
        if d % 7 == 0:
            w += w[:40] + ["x"] * 30
        rows.append((d, rng.choice([" ", "\n", "  "]).join(w)))
    rows += [(200 + i, rows[4][1].replace(" ", "\t")) for i in range(5)] + [rows[6], (300, None), (301, ""), (302, " \n"), (None, rows[9][1]),
                                                                           (303, "é ü " * 400), (304, "long " * 30_000)]
    monkeypatch.setattr(sd, "SHARD_WORDS", 700)
    got = sd.without_repeats(documents(rows), n).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, n)


def test_hot_anchor(documents, monkeypatch):
    monkeypatch.setattr(sd, "HOT", 3)
    rows = [(d, " ".join([f"a{d}"] * 3 + [f"p{i}" for i in range(30)] + [f"b{d % 4}"] * 9)) for d in range(12)]
    got = sd.without_repeats(documents(rows)).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, 20)


def test_empty(documents):
    assert sd.without_repeats(documents([])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=12), min_size=1, max_size=12), st.integers(1, 5))
def test_index(parts, n):
    text = np.array([x for p in parts for x in [*p, 0]], np.int64)
    index = FMIndex(text)
    starts = np.array([i for i in range(len(text) - n + 1) if (text[i:i + n] > 0).all()], np.int64)
    windows = [tuple(text[i:i + n]) for i in starts]
    assert earlier_windows(text, starts, n).tolist() == [windows.index(w) < k for k, w in enumerate(windows)]
    if len(starts):
        length, low, high = index.matching(text, starts + n - 1, n)
        for k in np.flatnonzero(length == n):
            assert sorted(index.locate(np.arange(low[k], high[k]))) == [s for s, w in zip(starts, windows) if w == windows[k]]
