"""The whole pipeline against plain Python versions of its five stages."""

import hashlib
import importlib
import math
import random
from collections import Counter

import numpy as np
from llm_tables import documents  # noqa: F401
from patronage.llm import toxicity
from pyspark.sql import functions as F
from test_decontaminate import plain_leaks
from test_models import plain_features
from test_ngram_join import brute


def text(rnd, n, words=200):
    return " ".join(f"w{rnd.randrange(words)}x" + rnd.choice(["", "", ".", ","]) for _ in range(n))


def corpus():
    """(rows, labels, items, ids of clean documents)"""
    rnd = random.Random(6)
    rows, labels, clean = [], [], set()
    for i in range(60):  # clean, of three sources of different sizes and one without a name
        rows.append((i, text(rnd, rnd.randrange(60, 160), 5000), ["a", "a", "a", "b", "c", None][i % 6]))
        clean.add(i)
        labels.append((i, 1, 0))
    for i in range(100, 130):
        rows.append((i, text(rnd, 15, 5000) + ". you " + rnd.choice(["moron", "dimwit"]) + " and " + rnd.choice(["moron", "dimwit"]) + " " + text(rnd, 5, 5000), "b"))
        labels.append((i, 0, 1))
    for i in range(8):  # near copies of clean documents, exact copies, and copies of copies
        words = rows[i][1].split(" ")
        words[rnd.randrange(len(words))] = "changed"
        rows += [(200 + i, " ".join(words), "c"), (300 + i, rows[i][1].replace(" ", "\n"), "a")]
    items = [(i, " ".join(f"q{i}z{k}" for k in range(24)) + f" gives {i + 3} apples to Alice after {i + 5} days of work?") for i in range(4)]
    rows += [(400 + i, text(rnd, 10, 5000) + " " + t.replace("Alice", "Bob").replace("days", "weeks"), "b") for i, t in items]
    rows += [(500, None, "a"), (501, "", "b"), (502, " \n", None), (None, "a text without an id that is clean " + text(rnd, 20, 5000), "c"), (503, rows[40][1], "b"), (503, rows[40][1], "b")]
    return rows, labels, items, clean | {500, 501, 502, None}


def plain_mix(rows):
    """Copies of each row by the documented rule."""
    size = [len((t or "").encode().split()) for _, t, _ in rows]
    by = Counter()
    for (_, _, s), n in zip(rows, size):
        by[s] += n
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), sum(by.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * by[s]}
        for s in full or open_:
            target[s] = 3.0 * by[s] if full else level * weight[s]
        if not full:
            break
        rest -= sum(3 * by[s] for s in full)
        open_ -= full
    out = []
    for (d, t, s) in rows:
        rate = target[s] / by[s] if by[s] else 0.0
        key = str(d) if d is not None else "text " + hashlib.md5(t.encode()).hexdigest() if t is not None else ""
        coin = int(hashlib.md5(f"mix:{key}".encode()).hexdigest()[:13], 16) / 16 ** 13
        out += [(d, t, s)] * (math.floor(rate) + (coin < rate - math.floor(rate)))
    return out


def plain_shard(d, shards=16):
    def bid(n):
        u = (int(hashlib.md5(f"{'' if d is None else d}:{n}".encode()).hexdigest()[:13], 16) + 0.5) / 16 ** 13
        return 1 / -math.log(u)
    return max(range(shards), key=lambda n: (bid(n), -n))


def test_run_equals_plain_stages(spark, documents, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    rows, labels, items, clean = corpus()
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    labelled.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    model = toxicity.fit(docs, labelled, F.lit(True))
    assert {"moron", "dimwit"} <= set(model.insults)

    def toxic(t):
        x, _ = plain_features(model, t or "")
        return 1 / (1 + np.exp(-(model.bias + np.minimum(x, 4.0) @ model.weights))) >= 0.5
    left = [r for r in rows if not toxic(r[1])]
    assert {r[0] for r in rows} - {r[0] for r in left} == set(range(100, 130))
    groups = {(d, n): c for d, n, c in brute([(d, t) for d, t, _ in left], 5, 80)}
    group = {d: c for (d, n), c in groups.items() if n}
    left = [r for r in left if r[0] is None or group.get(r[0], r[0]) == r[0]]
    assert not {r[0] for r in left} & {*range(200, 208), *range(300, 308), 503}
    held = {d for d, _ in plain_leaks([(i, t) for i, (_, t, _) in enumerate(left) if t], items)}
    left = [r for i, r in enumerate(left) if i not in held]
    assert {r[0] for r in left} == clean
    want = plain_mix(left)

    got = pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.text, r.source, r["shard"]) for r in got) == Counter((d, t, s, plain_shard(d)) for d, t, s in want)
    for s in {r["shard"] for r in got}:
        assert sorted(r.slot for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
