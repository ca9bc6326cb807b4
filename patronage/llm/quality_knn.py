"""Quality by nearest-neighbour voting in a latent-semantic space.

A text becomes counts of hashed words, of word shapes (runs of letter case, digits and signs)
and of pairs of shapes, and of its repeated lines and phrases. Counts are damped, weighted by
inverse document frequency and projected on the leading singular vectors of a bounded sample
of labelled texts. The labelled vectors go to every task; each document is compared with all
of them, block by block, by exact cosine products, and its nearest ones vote with weights
that grow with similarity.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .toxicity import labelled
from .words import BASE, Words, chunks, mix, runs, words

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE = 6_000     # labelled rows that are learned from and vote, at most
DIMS = 48          # singular vectors
WORDS, SHAPES, PAIRS, EXTRA = 512, 512, 512, 24
WIDTH = WORDS + SHAPES + PAIRS + EXTRA
GROUP_WEIGHTS = (0.3, 1.0, 0.7, 1.0)
NEIGHBOURS = 25
POWER = 4.0        # of the similarity in the votes
BLOCK = 512        # documents compared at once


def shape_hashes(w: Words) -> np.ndarray:
    """Hash of each word's shape: the sequence of byte classes with runs shortened to two."""
    kind = np.arange(256, dtype=np.uint64)
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 65, 97, 48, 97
    if not len(w.starts):
        return np.zeros(0, np.uint64)
    k = kind[w.data]
    fresh = np.zeros(len(k), bool)
    fresh[w.starts] = True
    same = np.concatenate([[False], k[1:] == k[:-1]]) & ~fresh
    second = same & ~np.concatenate([[False], same[:-1]])
    kept = ~same | (second & (k != 97) & (k != 48))
    inside = np.ones(256, bool)
    inside[[32, 9, 10, 11, 12, 13]] = False
    kept &= inside[w.data]
    rank = np.cumsum(kept)
    lengths = np.diff(np.append(w.starts, len(k)))
    rank -= np.repeat(rank[w.starts], lengths)[: len(k)] if w.starts[0] == 0 else np.concatenate(
        [np.zeros(w.starts[0], np.int64), np.repeat(rank[w.starts], lengths)])
    powers = np.full(64, BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    value = np.where(kept, mix(k + np.uint64(7)) * powers[np.clip(rank, 0, 63)], np.uint64(0))
    return mix(np.add.reduceat(value, w.starts))


def counts(texts: pa.Array) -> np.ndarray:
    """Damped counts, one row of WIDTH for each text of a piece; an empty text has zeros."""
    w = words(texts, lower=True)
    n = len(w)
    out = np.zeros((n, WIDTH), np.float32)
    if not len(w.hashes):
        return out
    doc = np.repeat(np.arange(n), np.diff(w.first))
    shapes = shape_hashes(w)

    def add(h: np.ndarray, rows: np.ndarray, at: int, size: int) -> None:
        out[:, at:at + size] += np.bincount(rows * size + (h % np.uint64(size)).astype(np.int64), minlength=n * size).reshape(n, size)

    add(w.hashes, doc, 0, WORDS)
    add(shapes, doc, WORDS, SHAPES)
    both = doc[1:] == doc[:-1]
    add(mix(shapes[1:] + shapes[:-1] * np.uint64(BASE))[both], doc[1:][both], WORDS + SHAPES, PAIRS)
    size = np.maximum(np.diff(w.first), 1).astype(np.float32)
    out = np.log1p(out * (1000.0 / size)[:, None])  # per thousand words, so that length does not count
    for i in range(n):
        out[i, -EXTRA:] = extra(w, i)
    return out.astype(np.float32)


def extra(w: Words, i: int) -> np.ndarray:
    """One-hot steps of: share of repeated phrases, share of repeated lines, length."""
    own, out = w.of(i), np.zeros(EXTRA, np.float32)
    if not len(own):
        return out
    three = runs(own, min(3, len(own)))
    repeated = 1 - len(np.unique(three)) / len(three)
    lines = [x for x in w.data[w.text_from[i]:w.text_from[i + 1]].tobytes().split(b"\n") if x.strip()]
    same = 1 - len(set(lines)) / max(1, len(lines))
    out[min(7, int(repeated * 12))] = 5
    out[8 + min(7, int(same * 12))] = 5
    out[16 + min(7, int(np.log2(len(own)) / 2))] = 2
    return out


@dataclass
class Model:
    """idf of the features, the projection, and the labelled vectors with their labels."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        return unit(weighted(x, self.idf) @ self.basis)

    def vote(self, x: np.ndarray) -> np.ndarray:
        """Score of each row of counts: the similarity-weighted mean label of its neighbours."""
        out = np.empty(len(x))
        if not len(self.labels):
            return np.full(len(x), 0.5)
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(x), BLOCK):
            sim = self.project(x[a:a + BLOCK]) @ self.vectors.T
            near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            s = np.maximum(np.take_along_axis(sim, near, 1), 1e-3) ** POWER
            out[a:a + BLOCK] = (s * self.labels[near]).sum(1) / s.sum(1)
        return np.clip(out, 0.0, 1.0)


def weighted(x: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """idf weights, and unit length within each group of features."""
    x = x * idf
    at = 0
    for size, weight in zip((WORDS, SHAPES, PAIRS, EXTRA), GROUP_WEIGHTS):
        x[:, at:at + size] = unit(x[:, at:at + size]) * np.float32(weight)
        at += size
    return x


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, keep: Column, sample: int = SAMPLE) -> Model:
    """Learn from rows of labels (doc_id, quality) that pass `keep`, at most `sample` of them.

    Counts are made in the tasks; the driver gets one packed row of counts for each sampled
    text (about 6 KB) and factors their Gram matrix, whose size does not depend on the data.
    Without labelled rows every score is 0.5.
    """
    rows = (labelled(docs, labels, "quality", keep, sample).repartition(docs.sparkSession.sparkContext.defaultParallelism * 4)
            .mapInArrow(_packed, "doc_id long, y int, x binary").orderBy("doc_id").collect())
    if not rows:
        return Model(np.ones(WIDTH, np.float32), np.eye(WIDTH, DIMS, dtype=np.float32), np.zeros((0, DIMS), np.float32), np.zeros(0))
    x = np.stack([np.frombuffer(r["x"], np.float16) for r in rows]).astype(np.float32)
    y = np.array([r["y"] for r in rows], float)
    idf = np.log((1 + len(x)) / (1 + (x > 0).sum(0))).astype(np.float32) + np.float32(0.2)
    z = weighted(x.copy(), idf)
    _, vectors = np.linalg.eigh((z.T @ z).astype(np.float64))
    basis = np.ascontiguousarray(vectors[:, ::-1][:, :DIMS]).astype(np.float32)
    return Model(idf, basis, unit(z @ basis), y)


def _packed(batches):
    for b in batches:
        for lo, hi, piece in chunks(b.column(1)):
            x = counts(piece).astype(np.float16)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(2).slice(lo, hi - lo),
                                              pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "y", "x"])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for each row of docs (doc_id, text).

    Whole texts are read. Null, empty and blank texts have no features and are equally near
    to every labelled text: they score the mean label of NEIGHBOURS of them. Repeated rows
    stay; other columns are ignored. The labelled vectors (at most SAMPLE rows of DIMS
    numbers) travel with the tasks; documents are not moved.
    """
    def run(batches):
        for b in batches:
            for lo, hi, piece in chunks(b.column(1)):
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(model.vote(counts(piece)), pa.float64())],
                                                 names=["doc_id", "score"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
