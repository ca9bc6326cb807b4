"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses. Lexical transducers turn words, and threats of several words, into
classes (insult, threat, target, negation, report) with weights; three more transducers, composed
into one automaton, tag the classes of a clause: negation weakens what follows it closely, a verb
of saying weakens the rest of the clause, and a target in the clause sharpens it. A clause weighs
what its different matched words weigh together, by their final class. The score is a logistic
function of the weights of all clauses, never of single words.

Threats, targets, negations and verbs of saying are fixed lists. Insults, whole words or
stems, and the weights of the classes are learned from labelled rows.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .staging import staged
from .words import chunks, mix, runs, words

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Closed word classes in the four languages of the corpus
THREATS = "kill hurt destroy stab shoot burn beat töten umbringen zerstören tuer frapper détruire matar golpear destruir".split()
PHRASES = ("end your life", "make you pay", "make you regret", "make you suffer", "you will regret", "you'll regret", "watch your back", "you are dead", "you're dead",
           "mach dich fertig", "wirst es bereuen", "bist tot", "vas le regretter", "vas le payer", "te vas a arrepentir", "vas a pagar")
TARGETS = "you your yours u ya they them he she him her du dich dir euch ihr tu toi vous te tú usted ustedes ellos".split()
NEGATIONS = "not never no isn't aren't wasn't don't nicht kein keine nie niemals pas jamais ni nunca jamás".split()
REPORTS = "said says told called quoted wrote claims sagte schrieb behauptet dit disait écrit dijo dice escribió".split()

CLAUSE = re.compile(r"[.;:!?\n]+")
WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)*")
STEMS = (4, 5, 6, 7)     # lengths of word beginnings that may be learned as stems
SAMPLE = 20_000          # labelled rows that are learned from, at most
LEAST_TOXIC = 4          # different toxic texts that an insult occurs in
LEAST_SHARE = 0.9        # share of toxic texts among those that it occurs in
SCOPE = 3                # words that a negation reaches
CLASSES = ("insult", "insult.at", "insult.neg", "insult.rep", "threat", "threat.at", "threat.neg", "threat.rep")
FACTORS = np.array([1, 1.5, 0.4, 0.4, 0.3, 1.5, 0.2, 0.3])  # strength of each class before the fit
SHARE = 50.0             # the last feature is the logarithm of the strength of so many clauses, on average
PRIOR = np.append(FACTORS * 2.0, 0.2)  # weights before the fit
CACHE = 50_000           # words whose class is remembered
COUNTED = 100_000        # words that a task counts before it hands them on


@dataclass(frozen=True)
class Transducer:
    """Deterministic letter transducer; step(state, symbol) gives (state, symbol out)."""

    start: object
    step: object

    def then(self, other: "Transducer") -> "Transducer":
        """The composition: the output of this one is the input of the other."""
        def step(state, symbol):
            a, out = self.step(state[0], symbol)
            b, out = other.step(state[1], out)
            return (a, b), out
        return Transducer((self.start, other.start), step)

    def table(self, symbols: list[str]) -> dict:
        """All transitions from the start state, as one table."""
        todo, out = [self.start], {}
        while todo:
            s = todo.pop()
            for x in symbols:
                if (s, x) not in out:
                    out[s, x] = self.step(s, x)
                    todo.append(out[s, x][0])
        return out


HITS = ("insult", "threat")


def _hit(x: str) -> bool:
    """Whether a symbol, tagged or not, is an insult or a threat."""
    return x.partition(".")[0] in HITS


def _negate(left: int, x: str):
    if x == "negation":
        return SCOPE, x
    return max(0, left - 1), f"{x}.neg" if left and _hit(x) else x


def _report(on: bool, x: str):
    return on or x == "report", f"{x}.rep" if on and _hit(x) else x


def _aim(seen: bool, x: str):
    return seen or x == "target", f"{x}.at" if seen and _hit(x) else x


def final_class(tagged: str) -> str:
    """Of several tags the first counts: a negated word is not aimed, a reported one neither."""
    return ".".join(tagged.split(".")[:2])


NEGATION, REPORT, TARGET = Transducer(0, _negate), Transducer(False, _report), Transducer(False, _aim)
GRAMMAR = NEGATION.then(REPORT).then(TARGET)
SYMBOLS = ["insult", "threat", "target", "negation", "report", "other"]
TABLE = GRAMMAR.table(SYMBOLS)


@dataclass
class Model:
    """Learned insults (a stem ends in *) with their weights, and the weights of the classes."""

    insults: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: PRIOR)
    bias: float = -3.0
    fixed: dict[str, str] = field(default_factory=lambda: {
        w: kind for kind, ws in (("report", REPORTS), ("negation", NEGATIONS), ("target", TARGETS), ("threat", THREATS)) for w in ws})
    cache: dict[str, tuple[str, float]] = field(default_factory=dict)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "cache"} | {"cache": {}}

    def lookup(self, w: str) -> tuple[str, float]:
        """Class and weight of one word."""
        if (got := self.cache.get(w)) is not None:
            return got
        weight = max([self.insults.get(w, 0.0), *(self.insults.get(w[:n] + "*", 0.0) for n in STEMS if len(w) >= n)])
        got = ("insult", weight) if weight > 0 else (self.fixed.get(w, "other"), 1.0)
        if len(self.cache) > CACHE:
            self.cache.clear()
        self.cache[w] = got
        return got

    def features(self, text: str) -> tuple[np.ndarray, list[tuple[str, str]]]:
        """Weight by final class and, last, how strong they are among all clauses; and the matched
        clauses with their strongest class."""
        out, matched, clauses = np.zeros(len(CLASSES) + 1), [], 0
        low = text.lower()
        lookup = self.lookup
        if not any(lookup(w)[0] in HITS for w in set(WORD.findall(low))) and not any(p in low for p in PHRASES):
            return out, matched
        for clause in CLAUSE.split(low):
            said = WORD.findall(clause)
            clauses += bool(said)
            found = [(w, *lookup(w)) for w in said]
            for end in _phrase_ends(clause, said):
                found[end] = (said[end], "threat", 1.0)
            if not any(kind in HITS for _, kind, _ in found):
                continue
            aimed = any(kind == "target" for _, kind, _ in found)
            # a target counts wherever it stands in the clause, so it is read first
            state, best, seen = (TABLE[GRAMMAR.start, "target"][0] if aimed else GRAMMAR.start), None, {}
            for w, kind, weight in found:
                state, tag = TABLE[state, kind]
                if _hit(tag):
                    seen.setdefault(final_class(tag), {})[w] = weight
            total = {tag: sum(ws.values()) for tag, ws in seen.items()}
            for tag, weight in total.items():
                out[CLASSES.index(tag)] += weight
                best = tag if best is None or weight > total[best] else best
            if best:
                matched.append((best, clause.strip()))
        out[-1] = np.log1p(SHARE * (out[:-1] @ FACTORS) / max(clauses, 1))
        return out, matched

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-(self.bias + np.minimum(x, 4.0) @ self.weights))))


def _phrase_ends(clause: str, said: list[str]) -> list[int]:
    """Numbers of the words of a clause that end a threat of several words."""
    out = []
    for phrase in PHRASES:
        if phrase in clause:
            parts = phrase.split()
            out += [i + len(parts) - 1 for i in range(len(said) - len(parts) + 1) if said[i:i + len(parts)] == parts]
    return out


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts) == part


def labelled(docs: DataFrame, labels: DataFrame, label: str, keep: Column, sample: int) -> DataFrame:
    """(doc_id, text, y) of at most `sample` labelled rows, the same ones in every run: those
    first in the order of a hash of the id. Rows with a null id, label or text are left out."""
    ids = (labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(keep).dropna()
           .groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return docs.select("doc_id", "text").dropna().join(F.broadcast(ids), "doc_id")  # at most `sample` rows of two numbers


def fit(docs: DataFrame, labels: DataFrame, keep: Column, sample: int = SAMPLE) -> Model:
    """Learn insults and class weights from rows of labels (doc_id, toxic) that pass `keep`.

    Of near copies (equal smallest hashes of five words, under three salts) one counts. The
    sample has at most `sample` rows; its words are counted in the tasks, and what comes to the
    driver is the words and stems that pass the tests, each in LEAST_TOXIC sampled texts or
    more, and one row of class weights for each sampled text. Without labelled rows the model
    has no insults and its weights are PRIOR.
    """
    rows = staged(labelled(docs, labels, "toxic", keep, sample).repartition(docs.sparkSession.sparkContext.defaultParallelism * 4)
                  .mapInArrow(_with_key, "doc_id long, text string, y int, k long")
                  .groupBy("k", "y").agg(F.min_by("text", "doc_id").alias("text")), "toxic-sample")
    counts = rows.select("text", "y").mapInArrow(_count_words, "w string, y int, n long").groupBy("w").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("pos"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("neg"))
    total = rows.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    odds = F.log((F.col("pos") + 0.5) / (total[0] + 1.0)) - F.log((F.col("neg") + 0.5) / (total[1] + 1.0))
    known = (counts.filter(F.col("pos") >= LEAST_TOXIC).filter(F.col("pos") >= LEAST_SHARE * (F.col("pos") + F.col("neg")))
             .withColumn("o", odds).filter("o > 2").collect())
    most = max([r["o"] for r in known], default=1.0)
    model = Model({r["w"]: float(r["o"] / most) for r in known})
    seen = rows.select("text", "y").mapInArrow(_feature_rows(model), "y int, x array<double>").collect()
    if known and seen:
        x = np.minimum(np.array([r["x"] for r in seen]), 4.0)
        y = np.array([r["y"] for r in seen], float)
        model.weights, model.bias = _logistic(x, y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 0.5) -> tuple[np.ndarray, float]:
    """Logistic weights by Newton steps, drawn towards PRIOR by a ridge; no class may
    speak for a clean text."""
    prior = np.append(PRIOR, 0.0)
    a = np.hstack([x, np.ones((len(x), 1))])
    w, pull = prior.copy(), np.append(np.full(x.shape[1], ridge), 1e-3)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + np.diag(pull)
        step = np.linalg.solve(h, a.T @ (y - p) - pull * (w - prior))
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return np.maximum(w[:-1], 0.0), float(w[-1])


def _with_key(batches):
    for b in batches:
        key = []
        for lo, hi, piece in chunks(b.column(1)):
            w = words(piece, lower=True)
            for i in range(hi - lo):
                own = w.of(i)
                least = [runs(own, min(5, len(own)), salt).min() for salt in range(3)] if len(own) else [np.uint64(0)]
                key.append(int(mix(np.bitwise_xor.reduce(mix(np.array(least) + np.arange(len(least), dtype=np.uint64))).reshape(1))[0].view(np.int64)))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(key, pa.int64())], names=["doc_id", "text", "y", "k"])


def _count_words(batches):
    count: Counter = Counter()

    def rows():
        keys = list(count)
        return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                           pa.array([count[k] for k in keys], pa.int64())], names=["w", "y", "n"])
    for b in batches:
        for lo, hi, piece in chunks(b.column(0)):
            for text, y in zip(piece.to_pylist(), b.column(1).slice(lo, hi - lo).to_pylist()):
                own = set(WORD.findall(text.lower()))
                own |= {w[:n] + "*" for w in list(own) for n in STEMS if len(w) >= n}
                count.update((w, y) for w in own)
                if len(count) > COUNTED:
                    yield rows()
                    count.clear()
    if count:
        yield rows()


def _feature_rows(model: Model):
    def run(batches):
        for b in batches:
            x = [model.features(t)[0].tolist() for _, _, piece in chunks(b.column(0)) for t in piece.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(x, pa.list_(pa.float64()))], names=["y", "x"])
    return run


def _score_rows(model: Model, clauses: int):
    def run(batches):
        for b in batches:
            for lo, hi, piece in chunks(b.column(1)):
                score, count, said = [], [], []
                for text in piece.to_pylist():
                    x, matched = model.features(text)
                    score.append(model.score(x))
                    count.append(len(matched))
                    said.append([{"kind": k, "clause": c} for k, c in matched[:clauses]])
                kind = pa.list_(pa.struct([("kind", pa.string()), ("clause", pa.string())]))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(score, pa.float64()), pa.array(count, pa.int64()),
                                                  pa.array(said, kind)], names=["doc_id", "score", "n_clauses", "clauses"])
    return run


def scored(docs: DataFrame, model: Model, clauses: int = 5) -> DataFrame:
    """(doc_id, score, n_clauses, clauses) for each row of docs (doc_id, text).

    Whole texts are read. Null, empty and blank texts have no clause and the score of the
    bias, under 0.5 unless most labelled texts are toxic. n_clauses counts all matched
    clauses; `clauses` shows the first few. Repeated rows stay; other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _score_rows(model, clauses), "doc_id long, score double, n_clauses long, clauses array<struct<kind:string,clause:string>>")


def without_toxic(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """Rows of docs whose score is under the limit, columns as they are. Text is scored where
    it lies: no join and no shuffle."""
    names = docs.columns
    return docs.mapInArrow(_keep(model, limit, names.index("text")), docs.schema).select(*names)


def _keep(model: Model, limit: float, at: int):
    def run(batches):
        for b in batches:
            for lo, hi, piece in chunks(b.column(at)):
                keep = [model.score(model.features(t)[0]) < limit for t in piece.to_pylist()]
                yield b.slice(lo, hi - lo).filter(pa.array(keep, pa.bool_()))
    return run
