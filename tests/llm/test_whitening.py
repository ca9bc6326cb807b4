"""Whitening against a plain eigenvalue routine."""

import math
from fractions import Fraction

import numpy as np
import pytest
from patronage.llm import whitening
from patronage.llm.queries import QUERIES
from pyspark.sql import types as T

from llm_tables import SF

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("white", T.StringType()),
                        T.StructField("component", T.IntegerType()), T.StructField("n", T.IntegerType())])


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows], VECTORS)


def whole(v):
    return [math.floor(1024 * float(np.float32(c))) + 100000 for c in v]


def check(rows, given):
    """Rows of the operator against exact sums and numpy's eigenvalues; given: (id, x) of usable vectors."""
    x = np.array([v for _, v in given], np.int64)
    n, s = len(x), x.sum(0)
    centred = np.array([[float(Fraction(int(n * a - b), n)) for a, b in zip(r, s)] for r in x])
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    got = {}
    for r in rows:
        got.setdefault(r.component, []).append(r)
    for k, part in got.items():
        assert [r.n for r in part] == [n] * len(given)
        mine = {r.vec_id: r.whitened for r in part}
        want = centred @ parts[:, k - 1] / math.sqrt(values[k - 1])
        want = {i: w for (i, _), w in zip(given, want)}
        sign = np.sign(sum(mine[i] * want[i] for i in mine))
        assert max(abs(mine[i] - sign * want[i]) for i in mine) < 1e-6
        assert all(r.explained == pytest.approx(values[k - 1] / values.sum(), rel=1e-9) for r in part)
        assert all(r.identity_error < 1e-9 for r in part)
    exact = {i: sum((n * int(a) - int(b)) ** 2 for a, b in zip(v, s)) for i, v in given}
    assert all(int(r.deviation) == exact[r.vec_id] for r in rows)
    return len(got)


def test_query(spark):
    given = [(r.vec_id, whole(r.embedding)) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    df = QUERIES["op13_whitening"](spark, SF)
    assert dict(df.dtypes)["deviation"] == "bigint" and check(df.collect(), given) == 8


def test_odd_rows(spark):
    rnd = np.random.default_rng(3)
    good = [(i, (rnd.normal(size=5) * [1, 5, 0.1, 300, 2]).astype(np.float32).tolist()) for i in range(40)]
    good += [(40, good[0][1]), (41, [0.0] * 5)]
    odd = [(50, None), (51, [1.0, None, 1.0, 1.0, 1.0]), (52, [1.0, float("nan"), 0.0, 0.0, 0.0]), (53, [float("inf")] + [0.0] * 4), (54, [1.0, 2.0]), (55, [])]
    rows = whitening.whitened(vectors(spark, good + odd).repartition(4)).collect()
    assert {r.vec_id for r in rows} == set(range(42))
    assert check(rows, [(i, whole(v)) for i, v in good]) == 5


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [0.0, 5.0]), (None, [3.0, 3.0])]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 1), (0, 2), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2)]


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    assert whitening.whitened(vectors(spark, rows)).count() == 0


def test_rank_below_dimension(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)]
    got = whitening.whitened(vectors(spark, rows)).collect()
    assert {r.component for r in got} == {1} and all(r.explained == pytest.approx(1) for r in got)


def test_large_entries_are_exact(spark):
    rows = [(i, [float(2 ** 21 * (i % 3)), float(i)]) for i in range(12)]
    assert check(whitening.whitened(vectors(spark, rows)).collect(), [(i, whole(v)) for i, v in rows]) == 2


def test_entries_near_the_limit(spark):
    """Products beyond 38 digits lose last bits only; beyond the limit an entry is not finite."""
    rnd = np.random.default_rng(2)
    good = [(i, (rnd.normal(size=3) * [2.0 ** 50, 2.0 ** 49, 2.0 ** 51]).astype(np.float32).tolist()) for i in range(30)]
    rows = whitening.whitened(vectors(spark, good + [(99, [1.0, 2.0 ** 54, 1.0])])).collect()
    given = [(i, whole(v)) for i, v in good]
    assert {r.vec_id for r in rows} == set(range(30)) and all(r.identity_error < 1e-9 for r in rows)
    x = np.array([v for _, v in given], float)
    values = np.linalg.eigvalsh(np.cov(x.T, bias=True))[::-1]
    assert all(r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9) for r in rows) and len(rows) == 90


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_factor_and_rotation(d):
    rnd = np.random.default_rng(d)
    x = rnd.normal(size=(3 * d, d)) * 10.0 ** rnd.integers(-6, 3, d)
    a = x.T @ x
    factor = whitening.pivoted_cholesky(a)
    assert np.allclose(factor @ factor.T, a, rtol=0, atol=1e-12 * a.max())
    turned = whitening.rotated(factor)
    inner = turned.T @ turned
    norms = np.sqrt(np.diag(inner))
    assert np.abs(inner / np.outer(norms, norms) - np.eye(len(norms))).max() < 1e-13
    assert np.allclose(np.sort(norms ** 2), np.linalg.eigvalsh(a)[-len(norms):], rtol=1e-9, atol=1e-12 * a.max())
