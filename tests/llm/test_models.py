"""Toxicity and quality: the grammar by hand, held-out accuracy, exact votes, odd inputs."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_tables import SF, documents  # noqa: F401
from patronage.llm import quality_knn, toxicity
from patronage.llm.queries import QUERIES, table

MODEL = toxicity.Model({"fool": 1.0, "stink*": 0.8})


def classes(text):
    x, _ = MODEL.features(text)
    return {c: round(v, 3) for c, v in zip(toxicity.CLASSES, x) if v}


@pytest.mark.parametrize("text, want", [
    ("what a fool", {"insult": 1.0}),
    ("you are a fool", {"insult.at": 1.0}),
    ("a fool, that is you", {"insult.at": 1.0}),
    ("he is not a fool", {"insult.neg": 1.0}),
    ("not that it matters to him, really, fool", {"insult.at": 1.0}),
    ("they said fool", {"insult.rep": 1.0}),
    ("they said it. fool", {"insult": 1.0}),
    ("i will kill you", {"threat.at": 1.0}),
    ("never hurt a fly", {"threat.neg": 1.0}),
    ("STINKER! fool fool", {"insult": 1.8}),
    ("foolish stin", {}),
    ("", {}),
])
def test_grammar(text, want):
    assert classes(text) == want


def test_composition_is_the_cascade():
    """The composed table gives what the transducers give one after another."""
    rng = np.random.default_rng(1)
    for _ in range(200):
        word = [toxicity.SYMBOLS[i] for i in rng.integers(0, len(toxicity.SYMBOLS), 12)]
        tape = word
        for t in (toxicity.NEGATION, toxicity.REPORT, toxicity.TARGET):
            state, out = t.start, []
            for x in tape:
                state, y = t.step(state, x)
                out.append(y)
            tape = out
        state, got = toxicity.GRAMMAR.start, []
        for x in word:
            state, y = toxicity.TABLE[state, x]
            got.append(y)
        assert got == tape


def plain_features(model, text):
    """The same clause by clause: tags by looking around in the words, weights of different words added up."""
    import re
    out, matched, clauses = dict.fromkeys(toxicity.CLASSES, 0.0), 0, 0
    for clause in re.split(r"[.;:!?\n]+", text.lower()):
        said = toxicity.WORD.findall(clause)
        clauses += bool(said)
        kinds = []
        for w in said:
            weights = [v for k, v in model.insults.items() if k == w or k.endswith("*") and len(k) - 1 in toxicity.STEMS and w.startswith(k[:-1])]
            kinds.append(("insult", max(weights)) if weights else (model.fixed.get(w, "other"), 1.0))
        for phrase in toxicity.PHRASES:
            parts = phrase.split()
            for i in range(len(said)):
                if said[i:i + len(parts)] == parts:
                    kinds[i + len(parts) - 1] = ("threat", 1.0)
        seen = {}
        for i, (kind, weight) in enumerate(kinds):
            if kind in toxicity.HITS:
                negated = "negation" in [k for k, _ in kinds[max(0, i - toxicity.SCOPE):i]]
                tag = "neg" if negated else "rep" if "report" in [k for k, _ in kinds[:i]] else "at" if "target" in [k for k, _ in kinds] else None
                seen[f"{kind}.{tag}" if tag else kind, said[i]] = weight
        for (tag, _), weight in seen.items():
            out[tag] += weight
        matched += bool(seen)
    x = np.array([*out.values(), 0.0])
    x[-1] = np.log1p(toxicity.SHARE * (x[:-1] @ toxicity.FACTORS) / max(clauses, 1))
    return x, matched


def test_features_and_scores_equal_a_plain_version(spark, documents):
    model = toxicity.Model({"fool": 1.0, "stink*": 0.8, "dolt": 0.55, "fools*": 0.3}, toxicity.PRIOR * 1.3, -2.0)
    rng = np.random.default_rng(4)
    vocabulary = ["fool", "stinker", "stinky", "dolt", "kill", "hurt", "you", "he", "not", "never", "said", "wrote", "calm", "word", "end your life", "make you regret", "x"]
    texts = [" ".join(vocabulary[i] + rng.choice(["", "", "", ".", "!", ",", "\n"]) for i in rng.integers(0, len(vocabulary), rng.integers(0, 40))) for _ in range(300)]
    texts += ["You said he is not a FOOL", "a fool; never said. you stinker", "said not fool you"]
    got = {r.doc_id: (r.score, r.n_clauses) for r in toxicity.scored(documents(list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        x, matched = plain_features(model, text)
        want = 1 / (1 + np.exp(-(model.bias + np.minimum(x, 4.0) @ model.weights)))
        assert np.allclose(model.features(text)[0], x) and got[i] == (pytest.approx(want), matched), text


def test_threats_of_several_words():
    assert classes("i will end your life") == {"threat.at": 1.0} == classes("i will make you regret being born")
    assert classes("end of your life") == {} and classes("the end. your life") == {}


def test_classes_are_ordered():
    plain, at, neg, rep = (MODEL.score(MODEL.features(t)[0]) for t in ("fool", "you fool", "not fool", "said fool"))
    assert at > plain > neg and plain > rep and plain > MODEL.score(MODEL.features("calm")[0])


ODD = [(1, None), (2, ""), (3, " \n"), (4, "fool"), (4, "fool"), (None, "fool"), (5, "word " * 40_000 + "fool"), (6, "\x00 ퟿ é")]


def test_scores_of_odd_texts(documents):
    got = toxicity.scored(documents(ODD), MODEL).collect()
    assert len(got) == len(ODD)
    assert all((r.score > 0.2 and r.n_clauses == 1) == (r.doc_id in (4, 5, None)) for r in got)
    docs = documents(ODD)
    kept = toxicity.without_toxic(docs, MODEL, limit=0.2)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 6]
    assert toxicity.scored(documents([]), MODEL).count() == 0


def test_fit_without_labels(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(ODD), labels, F.lit(True))
    assert model.insults == {} and toxicity.scored(documents(ODD), model).filter("score < 0.5").count() == len(ODD)
    model = quality_knn.fit(documents(ODD), labels, F.lit(True))
    assert {r.score for r in quality_knn.scored(documents(ODD), model).collect()} == {0.5}


def test_fit_learns_only_from_kept_rows(spark, documents):
    rows = [(i, f"calm text number{i} of many " + ("nasty words" if i % 2 else "kind words")) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(60)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(rows), labels, F.lit(True))
    assert "nasty" in model.insults and "kind" not in model.insults
    assert toxicity.fit(documents(rows), labels, F.lit(False)).insults == {}


@pytest.mark.parametrize("name, label, least", [("op2_toxicity", "toxic", 0.9), ("op5_quality_knn", "quality", 0.97)])
def test_held_out(spark, name, label, least):
    folder = SF.replace("sf0.001", "sf0.01")
    out = QUERIES[name](spark, folder).join(table(spark, folder, "labels"), "doc_id").filter("held_out").collect()
    assert out and all(0 <= r.score <= 1 for r in out)
    assert sum(r.predicted == r[label] for r in out) >= least * len(out)


def test_votes_are_exact(monkeypatch):
    """Blocked products and partial sorting against one product and a full sort."""
    monkeypatch.setattr(quality_knn, "BLOCK", 7)
    rng = np.random.default_rng(2)
    x = np.abs(rng.normal(size=(40, quality_knn.WIDTH))).astype(np.float32)
    basis = rng.normal(size=(quality_knn.WIDTH, quality_knn.DIMS)).astype(np.float32)
    idf = np.ones(quality_knn.WIDTH, np.float32)
    model = quality_knn.Model(idf, basis, quality_knn.unit(rng.normal(size=(300, quality_knn.DIMS)).astype(np.float32)), rng.integers(0, 2, 300).astype(float))
    sim = model.project(x.copy()) @ model.vectors.T
    near = np.argsort(-sim, axis=1)[:, :quality_knn.NEIGHBOURS]
    s = np.maximum(np.take_along_axis(sim, near, 1), 1e-3) ** quality_knn.POWER
    assert np.allclose(model.vote(x.copy()), (s * model.labels[near]).sum(1) / s.sum(1), atol=1e-4)


def test_counts_of_odd_texts():
    x = quality_knn.counts(pa.array(["", "  ", "one", "a" * 100_000, "x " * 50_000, "é!! Ü,"], pa.large_string()))
    assert x.shape == (6, quality_knn.WIDTH) and np.isfinite(x).all() and not x[0].any() and not x[1].any() and x[2].any()
    shape = lambda t: quality_knn.shape_hashes(quality_knn.words(pa.array([t], pa.large_string()), lower=True)).tolist()
    assert len(set(shape("of%%% the%% a%%%% Of%%"))) == 2 and shape("abc") == shape("xy") and shape("AB!") != shape("ab!")
