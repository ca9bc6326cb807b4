"""Fingerprints and links against all pairs."""

import random

import pytest
import xxhash
from llm_tables import SF, documents  # noqa: F401
from patronage.llm import simhash
from pyspark.sql import functions as F


def plain_fingerprint(text):
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    own = "".join(c.lower() if c.isascii() else c for c in text).split(" ")
    own = [w for w in own if w]
    shingles = [" ".join(own[i:i + 3]) for i in range(len(own) - 2)] or ([" ".join(own)] if own else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def closure(marks):
    """Smallest member reached by each mark, over all pairs."""
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    for a in marks:
        for b in marks:
            if a < b and (a ^ b).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {m: find(m) for m in marks}


def signed(m):
    return m - (1 << 64) if m >> 63 else m


def test_query_equals_brute_force(spark):
    from patronage.llm.queries import QUERIES
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    marks = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    root = closure(set(marks.values()))
    least = {}
    for d, m in marks.items():
        least[root[m]] = min(d, least.get(root[m], d))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op12_simhash_balls"](spark, SF).collect()}
    assert got == {d: (f"{m:016x}", least[root[m]]) for d, m in marks.items()}


def test_hash_is_that_of_the_engine(spark):
    text = "One two  THREE\tfour Ünï " + "long" * 20
    want = spark.createDataFrame([(t,) for t in ("one two three", "two three four", "three four Ünï", "four Ünï " + "long" * 20)], "s string")
    got = simhash.shingle_hashes(text)
    assert [int(h) for h in got.view("int64")] == [r[0] for r in want.select(F.xxhash64("s")).collect()]


def family(seed):
    """Fingerprints at few bits from each other, and a crowd that agrees outside 21 bits."""
    rnd = random.Random(seed)
    out = {0, 1, (1 << 64) - 1}
    for _ in range(25):
        base = rnd.getrandbits(64)
        for _ in range(8):
            for b in rnd.sample(range(64), rnd.randint(0, 5)):
                base ^= 1 << b
            out.add(base)
    base = rnd.getrandbits(64)
    for low in (0, 21, 42):
        out |= {base ^ rnd.getrandbits(21) << low for _ in range(60)}
        out |= {base ^ rnd.getrandbits(4) << low for _ in range(12)}
    return sorted(out)


@pytest.mark.parametrize("crowd", [32, 2])
def test_links_reach_what_all_pairs_reach(spark, monkeypatch, crowd):
    """Also where nearly every variant counts as a crowd."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    marks = family(crowd)
    df = spark.createDataFrame([(signed(m),) for m in marks], "mark long").repartition(3)
    links = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.fingerprint_links(df).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    root = {m: m for m in marks}

    def find(m):
        while root[m] != m:
            m = root[m]
        return m

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    assert {m: find(m) for m in marks} == closure(marks)


def test_long_runs_come_in_pieces(monkeypatch):
    """One variant that runs over many batches, then a pair."""
    import numpy as np
    import pyarrow as pa
    monkeypatch.setattr(simhash, "CROWD", 4)
    key, mark = np.array([5] * 50 + [6, 6], np.int64), np.concatenate([np.arange(50) * 1000, [8, 9]])
    batches = [pa.RecordBatch.from_arrays([pa.array(key[i:i + 3]), pa.array(mark[i:i + 3])], names=["key", "mark"]) for i in range(0, 52, 3)]
    rows = [r for b in simhash._meet(batches) for r in b.to_pylist()]
    assert {r["a"] for r in rows if r["b"] is None} == set(range(0, 50_000, 1000))
    assert [(r["a"], r["b"]) for r in rows if r["b"] is not None] == [(8, 9)]


def test_odd_rows(spark, documents):
    text = " ".join(f"w{i}" for i in range(80))
    docs = documents([(3, text), (2, text), (None, text), (7, None), (6, ""), (9, " \n"), (10, "One"), (11, "one"), (12, "two words"), (12, "two words"), (None, "alone in the world")])
    got = sorted(((r.doc_id, r.component_id, r.fingerprint) for r in simhash.near_copies(docs).collect()), key=repr)
    by = {}
    for d, c, f in got:
        by.setdefault(d, []).append(c)
    assert len(got) == 11 and by[3] == by[2] == [2] and by[7] == by[6] == by[9] == [6] and by[10] == by[11] == [10] and by[12] == [12, 12]
    assert sorted(by[None], key=repr) == [2, None] and {f for d, _, f in got if d in (6, 7, 9)} == {"0" * 16}
    assert simhash.near_copies(documents([])).count() == 0


def test_very_long_text():
    text = " ".join(f"w{i % 977}" for i in range(200_000))
    assert simhash.fingerprint(simhash.shingle_hashes(text)) % (1 << 64) == plain_fingerprint(text)
