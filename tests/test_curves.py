"""Threshold curve and calibration against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest

from kinlink.operators import curves

SCHEMA = "nr_documento_1 string, nr_documento_2 string, similarity_score double"


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(3)
    rows = []
    for i in range(600):
        score = round(rng.random(), 2 if i % 2 else 6)
        rows.append((str(i), str(i) if rng.random() < score else "x", score))
    return rows + [("1", None, 0.5), (None, None, 0.9), ("7", "7", None), ("8", "8", 1.0)]


def test_curve_at_every_score(spark, scored):
    truth = spark.createDataFrame([(700,)], "n bigint")
    got = {r.threshold: r for r in curves.threshold_curve(spark.createDataFrame(scored, SCHEMA), truth).collect()}
    rows = [(a == b and a is not None, s) for a, b, s in scored if s is not None]
    assert set(got) == {s for _, s in rows}
    for t, r in got.items():
        tp = sum(same for same, s in rows if s >= t)
        fp = sum(not same for same, s in rows if s >= t)
        assert (r.tp, r.fp, r.fn) == (tp, fp, 700 - tp)
        assert r.precision == pytest.approx(tp / (tp + fp), abs=1e-9) and r.recall == pytest.approx(tp / 700, abs=1e-9)


def test_curve_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert curves.threshold_curve(empty, spark.createDataFrame([(0,)], "n bigint")).count() == 0
    assert curves.calibration(empty).count() == 0
    row = curves.threshold_curve(spark.createDataFrame([("1", "2", 0.5)], SCHEMA), spark.createDataFrame([(0,)], "n bigint")).first()
    assert (row.tp, row.fp, row.precision, row.recall) == (0, 1, 0.0, None)


@pytest.mark.parametrize("digits", [1, 4])
def test_calibration_by_least_and_greatest_means(spark, scored, digits):
    """The isotonic fit at a bin is the greatest, over starts, of the least mean, over ends, of a stretch around it."""
    df = spark.createDataFrame(scored, SCHEMA)
    bins = curves.calibration(df, digits)
    got = [tuple(r) for r in bins.orderBy("bin").collect()]
    counts: dict[int, list[int]] = {}
    for a, b, s in scored:
        if s is not None:
            own = counts.setdefault(int(np.floor(s * 10**digits)), [0, 0])
            own[0] += a == b and a is not None
            own[1] += 1
    order = sorted(counts)
    g = np.concatenate([[0], np.cumsum([counts[b][0] for b in order])])
    n = np.concatenate([[0], np.cumsum([counts[b][1] for b in order])])
    assert [(b, m) for b, m, _ in got] == [(b, counts[b][1]) for b in order]
    for i, (_, _, p) in enumerate(got):
        expected = max(((g[i + 1:] - g[x]) / (n[i + 1:] - n[x])).min() for x in range(i + 1))
        assert p == pytest.approx(expected, abs=1e-9)
    if digits == 4:
        applied = curves.calibrated(df, bins).collect()
        assert len(applied) == len(scored) and all((r.probability is None) == (r.similarity_score is None) for r in applied)
        known = sorted((r.similarity_score, r.probability) for r in applied if r.probability is not None)
        assert all(x[1] <= y[1] for x, y in zip(known, known[1:]))
