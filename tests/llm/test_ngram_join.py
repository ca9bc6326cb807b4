"""The Jaccard join against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from llm_tables import documents  # noqa: F401
from patronage.llm import ngram_join as nj
from patronage.llm.components import components
from patronage.llm.words import words


def gram_set(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, n, percent):
    sets = [gram_set(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def near_copies(seed, groups=12, size=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = rng.choices(vocabulary, k=25)
    rows, d = [], 0
    for g in range(groups):
        base = rng.choices(vocabulary, k=rng.choice([3, 5, 9, 20, size, 3 * size]))
        for _ in range(rng.choice([1, 2, 5, 12])):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text += passage
            rows.append((d, rng.choice([" ", "\n", " \t "]).join(text).replace("w1", "W1" if rng.random() < 0.5 else "w1")))
            d += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_all_links(spark, documents, n, percent):
    rows = near_copies(n) + [(9001, None), (9002, ""), (9003, " \n\t"), (9004, "one"), (9005, "ONE"), (9006, "one two"),
                             (9007, "x " * 20_000), (9008, "x " * 20_000 + "y"), (None, "one"), (None, None), (9006, "one two")]
    got = nj.ngram_components(documents(rows), n, percent).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, n, percent)


def test_empty(documents):
    assert nj.ngram_components(documents([])).count() == 0


def test_one_stays(documents):
    text = " ".join(f"a{i}" for i in range(80))
    rows = [(3, text), (1, text + " b"), (2, "other words here that differ from all"), (4, None), (None, "null id")]
    kept = nj.without_near_copies(documents(rows))
    assert kept.columns == documents([]).columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == [1, 2, 4, None]


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 300), st.integers(0, 40), st.integers(0, 40), st.randoms(use_true_random=False), st.sampled_from([80, 85, 95]))
def test_similar_sets_share_a_signature(size, less, more, rng, percent):
    a = np.array(sorted({rng.getrandbits(64) for _ in range(size)}), np.uint64)
    b = np.array(sorted(set(a.tolist()[: max(1, size - less)]) | {rng.getrandbits(64) for _ in range(more)}), np.uint64)
    common = len(set(a.tolist()) & set(b.tolist()))
    if 100 * common >= percent * (len(a) + len(b) - common):
        low = nj.band_table(1000)
        content = nj.least_content(percent)
        assert set(nj.signatures(a, percent, low, content).tolist()) & set(nj.signatures(b, percent, low, content).tolist())
        bins = min(len(nj.sketch(a)), len(nj.sketch(b)))
        assert nj.near(nj.folded([nj.sketch(a)], bins)[0], len(a), nj.folded([nj.sketch(b)], bins), np.array([len(b)]), percent)[0]


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (100, 102), (200, 200), (-5, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, 101: 100, 102: 100, 300: -5}


def test_words():
    texts = ["a  bc\td", "", "\x0bé x\x0c", "Zz y \x1cq", "  "]
    w = words(pa.array(texts, pa.large_string()))
    assert [w.joined(w.first[i], w.first[i + 1]) for i in range(len(texts))] == [b" ".join(t.encode().split()) for t in texts]
    assert len(set(words(pa.array(["ab ba aab aba"], pa.large_string())).hashes.tolist())) == 4
    assert words(pa.array(["AbÉ"], pa.large_string()), lower=True).hashes[0] == words(pa.array(["abÉ"], pa.large_string())).hashes[0]
