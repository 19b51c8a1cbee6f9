"""Whitened embeddings against exact integers and numpy."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from sedgemill.llm import whitening

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType()),
    T.StructField("row_index", T.IntegerType()), T.StructField("index", T.IntegerType()),
])


def _table(spark, rows):
    return spark.createDataFrame([(i, v, "a", 1, 2) for i, v in rows], SCHEMA).repartition(3)


def _plain(rows):
    """vec_id with exact deviation and whitened coordinates up to sign, from Python integers and numpy."""
    def whole(v):
        return tuple(math.floor(64 * c) + 1_000_000 for c in v)

    kept = [(i, whole(np.array(v, np.float32).astype(float).tolist())) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centre = [Fraction(s, n) for s in sums]
    data = np.array([[float(a - c) for a, c in zip(x, centre, strict=True)] for x in fit])
    cov = data.T @ data / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:16], axes[:, ::-1][:, :16]
    out = []
    for i, x in kept:
        y = np.array([float(a - c) for a, c in zip(x, centre, strict=True)]) @ axes / np.sqrt(values)
        out.append((i, sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True)), y))
    return n, out, values / np.trace(cov)


@pytest.mark.parametrize("width", [3, 20])
def test_whitening_matches_numpy(spark, monkeypatch, width):
    monkeypatch.setattr(whitening, "ROWS", 16)
    monkeypatch.setattr(whitening, "COLUMNS", 8)
    rnd = np.random.default_rng(4)
    mixing = rnd.normal(size=(width, width)) * np.linspace(0.3, 3, width)
    made = [(i, (rnd.normal(size=width) @ mixing).astype(np.float32).tolist()) for i in range(150)]
    rows = made + [(500 + i, made[0][1]) for i in range(60)] + [made[1], (None, made[2][1])]
    rows += [(900, None), (901, [None] * width), (902, [float("nan")] * width), (903, [float("inf")] + [0.0] * (width - 1)), (904, [])]
    n, want, share = _plain(rows)
    got = whitening.whiten(_table(spark, rows)).collect()
    most = min(16, width)
    assert len(got) == len(want) * most and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    by = {}
    for r in got:
        by.setdefault((str(r.vec_id), r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert abs(r.explained / share[r.component - 1] - 1) < 1e-9
    signs = None
    for i, deviation, y in want:
        mine = np.array([by[str(i), deviation][c + 1][0] for c in range(most)])
        signs = np.sign(mine * y) if signs is None else signs
        assert np.allclose(mine * signs, y, rtol=1e-7, atol=1e-9)


def test_odd_tables(spark):
    assert whitening.whiten(_table(spark, [])).collect() == []
    assert whitening.whiten(_table(spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whiten(_table(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    flat = whitening.whiten(_table(spark, [(1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0]), (4, [3e38, 1.0])])).collect()
    assert {r.vec_id for r in flat} == {1, 2, 4} and all((r.whitened is None) == (r.component == 2) for r in flat)
    assert {r.deviation for r in flat} == {None}
