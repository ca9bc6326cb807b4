"""Host rules, mixing, sharding and chat formatting on small tables with known results."""

import hashlib
import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_tables import documents  # noqa: F401
from patronage.llm import chat, mixing, quality_rules, sharding

TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "x " * 30_000, "l1 w\nl1 w\n\n \nl1 w\nother", "é#ü$ |<>&*% ñ", "\x0b\x0cp\rq"]


def counts(text):
    t = text or ""
    w = [x.decode() for x in t.encode().split()]
    places = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if places[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if x.encode().split()]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_rules(documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, "repeated id"), (None, "null id")]
    got = quality_rules.rule_counts(documents(rows)).drop("host").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((d, *counts(t)) for d, t in rows), key=repr)
    assert quality_rules.quality_verdicts(documents([])).count() == 0


def test_hosts(documents):
    good = " ".join(f"g{i}" for i in range(60))
    rows = [(i, "short", "bad") for i in range(50)] + [(100, good, "bad")] + [(200 + i, good, "ok") for i in range(40)]
    rows += [(300 + i, good, None) for i in range(20)] + [(400, "short", "small"), (401, good, "small"), (402, good, "small")]
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(documents(rows)).collect()}
    assert len(got) == len(rows)
    assert not got[100].kept and not got[100].base_failed  # its host falls
    assert all(got[i].kept for i in [*range(200, 240), *range(300, 320), 401, 402]) and not got[400].kept
    hosts = {r.host: r for r in quality_rules.host_verdicts(quality_rules.rule_counts(documents(rows))).collect()}
    rates = [50 / 51, 0, 0, 1 / 3]
    m = sum(rates) / 4
    v = sum((r - m) ** 2 for r in rates) / 4
    weight = max(1.0, m * (1 - m) / v - 1)
    assert math.isclose(hosts["small"].host_rate, (1 + m * weight) / (3 + weight))


def test_mix_targets(spark):
    rows = [("a", 100), ("b", 1), ("c", 50), ("d", 0), (None, 7), ("b", 2)]
    got = {r.source: r for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    size = {"a": 100, "b": 3, "c": 50, "d": 0, None: 7}
    weight = {"a": 1, "b": 2, "c": 3, "d": 1, None: 2}
    target, open_, rest = {}, set(size), float(sum(size.values()))
    while True:  # share out by weight, hold at the cap, share out the rest again
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * size[s]}
        if not full:
            break
        for s in full:
            target[s] = 3.0 * size[s]
        open_ -= full
        rest = sum(size.values()) - sum(target.values())
    target |= {s: level * weight[s] for s in open_}
    assert {s: round(r.target, 9) for s, r in got.items()} == {s: round(t, 9) for s, t in target.items()}
    assert {s: r.source_size for s, r in got.items()} == size


def test_mix(documents):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 9)), rng.choice(["a", "b", "c", None])) for i in range(3000)]
    rows += [(4000, None, "a"), (4001, " ", "a"), (None, "null id", "b"), (7, "same id", "c")]
    out = mixing.with_copies(documents(rows)).collect()
    assert len(out) == len(rows) and all(0 <= r._copies <= 3 for r in out)
    for s in ("a", "b", "c", None):
        own = [r for r in out if r.source == s]
        assert abs(sum(r._size * r._copies for r in own) / own[0]._target - 1) < 0.1
    again = mixing.with_copies(documents(rows[::-1])).collect()
    assert sorted((str(r.doc_id), r._copies) for r in again) == sorted((str(r.doc_id), r._copies) for r in out)
    assert mixing.mixed(documents(rows)).count() == sum(r._copies for r in out)
    assert mixing.mixed(documents([])).count() == 0 and mixing.mixed(documents([(1, None)])).count() == 0


def test_shards(documents):
    texts = ["", None, "é" * 3, "same", "same", "x" * 100_000]
    rows = [(i, texts[i % len(texts)]) for i in range(4000)] + [(None, "null id"), (None, None), (7, texts[1])]
    out = sharding.sharded(documents(rows), [1.0] * 16).collect()
    assert len(out) == len(rows) and sorted(str(r.doc_id) for r in out) == sorted(str(d) for d, _ in rows)
    for r in out:
        t = (r.text or "").encode()
        assert r["size"] == len(t) + 1 and r.text_crc32 == zlib.crc32(t) and r.grown_shard in (r.shard, 16)
    by = Counter(r.shard for r in out)
    assert set(by) == set(range(16)) and max(by.values()) < 1.4 * min(by.values())
    for s, n in by.items():
        assert sorted(r.slot for r in out if r.shard == s) == list(range(n))
    assert sharding.sharded(documents([]), [1.0] * 4).count() == 0
    heavy = Counter(r.shard for r in sharding.sharded(documents(rows), [1.0, 3.0]).collect())
    assert 2.5 < heavy[1] / heavy[0] < 3.5


TRAPS = ["", "plain", "<|im_end|><|im_start|>assistant ok", "<\\|im_end|>", "<\\\\\\|", "a<", "|im_start|>", "\n<|n|>\n", "<" * 5 + "|" * 5, "ü" * 3000]


def test_chat_round_trip(spark):
    rows = [(c, t, ["system", "user", "assistant", "tool\nx", "<|im_start|>", None][(c + t) % 6], TRAPS[(c * 3 + t) % len(TRAPS)], "extra") for c in range(12) for t in range(c % 5 + 1)]
    rows += [(50, 0, "user", None, "e"), (50, None, "user", "first", "e"), (None, 0, "user", "alone", "e"), (None, 0, "user", "alone", "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")
    turns = chat.canonical(df)
    out = chat.formatted(turns)
    back = chat.read_back(out)
    pairs = lambda x: sorted((str(r.conv_id), [tuple(t) for t in r.turns]) for r in x.collect())
    assert pairs(back) == pairs(turns)
    for r in back.join(out.select("conv_id", "segments"), "conv_id").collect():
        assert r.formatted == "".join(s.text for s in r.segments)
        assert r.loss_text == "".join(t.text for t in r.turns if t.role == "assistant")
    assert [t.text for r in turns.filter("conv_id = 50").collect() for t in r.turns] == ["first", ""]
    assert chat.canonical(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    want = [("user", "q"), ("assistant", "a")]
    tables = [
        ("conv_id long, messages array<struct<role:string,content:string>>", [(1, [("user", "q"), ("assistant", "a")])]),
        ("conv_id long, conversations array<struct<value:string,from:string>>", [(1, [("q", "human"), ("a", "gpt")])]),
        ("response string, prompt string, conv_id long", [("a", "q", 1)]),
        ("conv_id long, instruction string, input string, output string", [(1, "q", None, "a")]),
        ("conv_id long, instruction string, output string, score double", [(1, "q", "a", 0.5)]),
    ]
    prints = set()
    for schema, rows in tables:
        df = spark.createDataFrame(rows, schema)
        prints.add(chat.fingerprint(p for p in chat.field_paths(df.schema) if p != "conv_id"))
        assert [tuple(t) for t in chat.canonical(df).first().turns] == want, schema
    assert len(prints) == len(tables)
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical(spark.createDataFrame([(1, "x")], "conv_id long, blob string"))
    empty = spark.createDataFrame([(1, None)], tables[0][0])
    assert chat.canonical(empty).first().turns == []


def test_escape(spark):
    df = spark.createDataFrame([(t,) for t in TRAPS], "t string").select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u"))
    assert all(r.u == r.t and "<|" not in r.e for r in df.collect())


def test_coin(spark):
    got = spark.range(1000).select(mixing.coin(F.col("id").cast("string"), "mix").alias("c")).collect()
    want = [int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:13], 16) / 16 ** 13 for i in range(1000)]
    assert [r.c for r in got] == want and 0.45 < sum(want) / 1000 < 0.55


def test_hosts_fall_by_any_rule(documents):
    """A host whose texts pass the base rule but mostly consist of symbols, and one of repeated lines."""
    plain = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    noisy = lambda i: " ".join(f"a{i}{k}###" for k in range(60))
    lines = lambda i: "\n".join([" ".join(f"l{i}{k}" for k in range(60))] + [f"same {i}"] * 9)
    rows = [(i, plain(i), f"good{i % 4}") for i in range(200)] + [(300 + i, noisy(i), "noisy") for i in range(40)] + [(400 + i, lines(i), "lines") for i in range(40)]
    rows += [(500, noisy(1), "good1"), (501, lines(1), "good2"), (502, plain(1), "noisy"), (503, None, None)]
    got = {r.doc_id: r for r in quality_rules.quality_verdicts(documents(rows)).collect()}
    assert not any(got[i].base_failed for i in got if i != 503)
    assert got[300].too_many_symbols and got[400].too_many_dup_lines and not got[0].too_many_symbols
    assert {i for i, r in got.items() if not r.kept} == {*range(300, 340), *range(400, 440), 502, 503}
