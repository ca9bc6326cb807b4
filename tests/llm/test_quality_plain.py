"""The quality score of whole texts against a plain version, from bytes to votes."""

import math
import random

import numpy as np
from llm_tables import documents  # noqa: F401
from patronage.llm import quality_knn as qk
from patronage.llm.words import BASE
from pyspark.sql import functions as F

M = 2 ** 64


def mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 % M
    x ^= x >> 27
    x = x * 0x94D049BB133111EB % M
    return x ^ x >> 31


def word_hash(w):
    return mix((sum(mix((b + 1) * BASE % M) * pow(BASE, i, M) for i, b in enumerate(w.lower())) + len(w)) % M)


def shape_hash(w):
    kinds = [65 if 65 <= b <= 90 else 97 if 97 <= b <= 122 or b >= 128 else 48 if 48 <= b <= 57 else b for b in w]
    kept = []
    for i, k in enumerate(kinds):
        same = i > 0 and kinds[i - 1] == k
        second = same and not (i > 1 and kinds[i - 2] == k)
        if not same or second and k not in (97, 48):
            kept.append(k)
    return mix(sum(mix(k + 7) * pow(BASE, min(i, 63), M) for i, k in enumerate(kept)) % M)


def plain_counts(text):
    own = (text or "").encode().split()
    out = np.zeros(qk.WIDTH)
    if not own:
        return out
    shapes = [shape_hash(w) for w in own]
    for w, s in zip(own, shapes):
        out[word_hash(w) % qk.WORDS] += 1
        out[qk.WORDS + s % qk.SHAPES] += 1
    for a, b in zip(shapes, shapes[1:]):
        out[qk.WORDS + qk.SHAPES + mix((b + a * BASE) % M) % qk.PAIRS] += 1
    out = np.log1p(out * 1000 / len(own))
    low = [w.lower() for w in own]
    n = min(3, len(low))
    windows = [tuple(low[i:i + n]) for i in range(len(low) - n + 1)]
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    extra = np.zeros(qk.EXTRA)
    extra[min(7, int((1 - len(set(windows)) / len(windows)) * 12))] = 5
    extra[8 + min(7, int((1 - len(set(lines)) / max(1, len(lines))) * 12))] = 5
    extra[16 + min(7, int(math.log2(len(own)) / 2))] = 2
    out[-qk.EXTRA:] = extra
    return out


def unit(x):
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)


def plain_scores(texts, labelled):
    """Scores of texts by labelled (text, label) rows."""
    def weighted(x):
        parts, at = [], 0
        for size, weight in zip((qk.WORDS, qk.SHAPES, qk.PAIRS, qk.EXTRA), qk.GROUP_WEIGHTS):
            parts.append(unit((x * idf)[:, at:at + size]) * weight)
            at += size
        return np.hstack(parts)
    x = np.array([plain_counts(t) for t, _ in labelled]).astype(np.float16).astype(float)
    y = np.array([y for _, y in labelled], float)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))) + 0.2
    z = weighted(x)
    basis = np.linalg.svd(z, full_matrices=False)[2][:qk.DIMS].T
    known, out = unit(z @ basis), []
    for v in unit(weighted(np.array([plain_counts(t) for t in texts])) @ basis):
        sim = known @ v
        near = np.argsort(-sim)[:qk.NEIGHBOURS]
        s = np.maximum(sim[near], 1e-3) ** qk.POWER
        out.append((s * y[near]).sum() / s.sum())
    return np.array(out)


def test_scores_equal_a_plain_version(spark, documents):
    rnd = random.Random(3)

    def make(good):
        words = [rnd.choice(["Alpha", "beta", "gamma,", "Delta.", "éa", "x9", "Omega", "tau"]) + rnd.choice(["", "", "s"]) for _ in range(rnd.randrange(4, 90))]
        if not good:
            words = [w + rnd.choice(["###", "$$", ""]) for w in words] + words[:rnd.randrange(1, 30)] * 2
        return rnd.choice([" ", "\n"]).join(words)

    rows = [(i, make(i % 3 > 0)) for i in range(140)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(110)], "doc_id long, quality int, toxic int")
    docs = documents(rows)
    model = qk.fit(docs, labels, F.lit(True))
    got = {r.doc_id: r.score for r in qk.scored(docs, model).collect()}
    want = plain_scores([t for _, t in rows], [(t, int(i % 3 > 0)) for i, t in rows[:110]])
    assert np.abs(np.array([got[i] for i, _ in rows]) - want).max() < 0.02
    assert np.corrcoef([got[i] for i, _ in rows], want)[0, 1] > 0.999
    assert np.mean([(got[i] >= 0.5) == (i % 3 > 0) for i in range(110, 140)]) > 0.9
