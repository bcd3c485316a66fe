"""Whitening against a plain computation over exact fractions."""

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from barline.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, x string, n long, label int, component string"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "x", 1, 2, "c") for i, v in rows], schema)


def brute(rows, dtype=np.float32):
    """{id: list of (component, n, deviation, |whitened|, explained)} and the covariance, from exact fractions."""
    valid = [(i, [math.floor(256 * float(dtype(c))) for c in v]) for i, v in rows
             if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    listed = sorted({tuple(x) for _, x in valid})
    n, d = len(listed), len(listed[0])
    sums = [sum(x[k] for x in listed) for k in range(d)]
    cov = [[float(sum((x[a] - Fraction(sums[a], n)) * (x[b] - Fraction(sums[b], n)) for x in listed) / n) for b in range(d)] for a in range(d)]
    values, vectors = np.linalg.eigh(np.array(cov))
    values, vectors = values[::-1], vectors[:, ::-1]
    out = defaultdict(list)
    for i, x in valid:
        dev = sum((n * x[k] - sums[k]) ** 2 for k in range(d))
        centred = np.array([float(x[k] - Fraction(sums[k], n)) for k in range(d)])
        for c in range(min(4, d)):
            out[i].append((c + 1, n, dev, abs(centred @ vectors[:, c]) / math.sqrt(values[c]), values[c] / sum(values)))
    return out, np.array(cov), values


def test_whitening_matches_exact_fractions(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(200, 7)) @ rng.normal(size=(7, 7)) + 3
    rows = [(i, v) for i, v in enumerate(base)] + [(1000 + i, base[0]) for i in range(150)]  # a hot vector
    rows += [(7, base[3]), (None, base[4]), (2000, None), (2001, [1.0] * 6 + [None]), (2002, [float("nan")] * 7),
             (2003, [float("inf")] + [0.0] * 6), (2004, [-0.0] * 7), (2005, [1.0, 2.0])]
    want, cov, _ = brute([r for r in rows if r[0] != 2005])
    got = wh.whiten(frame(spark, rows)).collect()
    by = defaultdict(list)
    for r in got:
        by[r["vec_id"]].append(r)
    assert sorted(by, key=str) == sorted(want, key=str)
    first = {i: v for i, v in by.items()}
    for i, rs in first.items():
        rs = sorted(rs, key=lambda r: (r["component"], r["deviation"], abs(r["whitened"])))
        ws = sorted(want[i])
        assert len(rs) == len(ws)
        for r, w in zip(rs, ws):
            assert (r["component"], r["n"], r["deviation"]) == w[:3]
            assert abs(r["whitened"]) == pytest.approx(w[3], rel=1e-8, abs=1e-9) and r["explained"] == pytest.approx(w[4], rel=1e-9)
            assert 0 <= r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in got}) == 1


def test_covariance_is_exact_far_from_zero(spark):
    """A large mean and tiny spread: uncentred products would lose every digit."""
    rng = np.random.default_rng(6)
    rows = [(i, 2.0 ** 40 + rng.integers(0, 9, 3) / 256) for i in range(60)]
    docs = frame(spark, rows, SCHEMA.replace("array<float>", "array<double>"))
    want, cov, values = brute(rows, np.float64)
    listed = wh.whole(docs, "vec_id", "embedding").select("x").distinct()
    found = wh.fit(listed, 3)
    assert np.array_equal(found.covariance, cov)
    assert np.allclose(found.values, values, rtol=1e-12)


def test_huge_values_use_exact_integers(spark):
    rows = [(0, [1e15, -3.0]), (1, [-1e15, 8.0]), (2, [5e14, 1e14]), (3, [1e300, -1e300])]
    docs = frame(spark, rows, SCHEMA.replace("array<float>", "array<double>"))
    got = wh.whiten(docs).collect()
    assert len(got) == 8 and all(r["deviation"] is None for r in got)
    assert all(r["explained"] is not None and r["n"] == 4 for r in got)


def test_flat_directions_equal_vectors_and_empty_tables(spark):
    flat = wh.whiten(frame(spark, [(i, [i, 2 * i, 5]) for i in range(9)])).collect()
    assert sorted({r["component"] for r in flat}) == [1, 2, 3]
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in flat) and all(r["identity_error"] < 1e-9 for r in flat)
    same = wh.whiten(frame(spark, [(1, [1, 2]), (2, [1, 2])])).collect()
    assert len(same) == 4 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None for r in same)
    assert wh.whiten(frame(spark, [])).count() == 0
    assert wh.whiten(frame(spark, [(1, None), (2, [None]), (3, [])])).count() == 0
    assert len(wh.whiten(frame(spark, [(i, np.eye(6)[i % 6] * i) for i in range(20)])).where("vec_id = 3").collect()) == 4
