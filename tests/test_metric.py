"""Vectors within a distance, against all pairs."""

import math

import numpy as np
import pytest

from kinlink.operators import metric
from kinlink.operators.metric import MetricConfig, vectors_within


def table(spark, rows):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in rows], "vec_id bigint, embedding array<double>")


def all_pairs(rows, radius):
    return sorted((min(i, j), max(i, j)) for a, (i, x) in enumerate(rows) for j, y in rows[a + 1:]
                  if i != j and math.sqrt(((x - y) ** 2).sum()) <= radius)


def clustered(n, centres, dim, spread, seed):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 10, (centres, dim))
    return [(i, middle[rng.integers(centres)] + rng.normal(0, spread, dim)) for i in range(n)]


CONFIGS = [MetricConfig(), MetricConfig(pivots=8, cell_rows=40, copy_cost=0.0), MetricConfig(pivots=1, local_pivots=1, cell_rows=37),
           MetricConfig(pivots=3, local_pivots=5, sample=50, cell_rows=25, copy_cost=0.0)]


@pytest.mark.parametrize("cfg", CONFIGS)
def test_every_pair_once(spark, cfg):
    for rows, radius in ((clustered(400, 6, 5, 0.8, 1), 1.0), (clustered(300, 1, 3, 1.0, 2), 0.5), (clustered(200, 1, 2, 1.0, 3), 9.0)):
        rows = rows + [(1000 + i, rows[i][1]) for i in range(30)]             # copies under other ids
        got = [(r["id_1"], r["id_2"]) for r in vectors_within(table(spark, rows), radius, cfg).collect()]
        assert sorted(got) == all_pairs(rows, radius)


def test_one_point_with_a_third_of_all_rows(spark):
    """Copies of one vector cannot be parted by distance; slices take them, and every pair comes out."""
    rows = clustered(120, 4, 4, 0.5, 4)
    rows += [(500 + i, rows[0][1]) for i in range(60)]
    got = [(r["id_1"], r["id_2"]) for r in vectors_within(table(spark, rows), 0.0, MetricConfig(pivots=4, cell_rows=16, copy_cost=0.0)).collect()]
    assert len(got) == 61 * 60 // 2 and sorted(got) == all_pairs(rows, 0.0)


def test_far_cells_are_not_compared(spark):
    rows = clustered(3000, 40, 16, 0.2, 5)
    cfg = MetricConfig(cell_rows=200, copy_cost=10.0)
    assert metric.comparison_share(table(spark, rows), 1.0, cfg) < 0.1


def test_bounds_hold_on_the_edge(spark):
    """Points on a line at whole distances: partners lie exactly at the radius, across the planes between cells."""
    rows = [(i, np.array([float(i), 0.0])) for i in range(200)]
    for cfg in CONFIGS:
        got = [(r["id_1"], r["id_2"], r["distance"]) for r in vectors_within(table(spark, rows), 3.0, cfg).collect()]
        assert sorted(got) == [(i, j, float(j - i)) for i in range(200) for j in range(i + 1, min(i + 4, 200))]


def test_awkward_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, None]), (3, None), (4, [float("nan"), 0.0]), (None, [0.0, 0.0]), (5, [float("inf"), 1.0]), (6, []), (7, [0.1, 0.0]), (7, [0.1, 0.0]), (1, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted((r["id_1"], r["id_2"]) for r in vectors_within(df, 1.0).collect()) == [(1, 7)] * 4
    assert vectors_within(df.where("false"), 1.0).count() == 0
    with pytest.raises(ValueError):
        vectors_within(df, -1.0)


def test_pivots_are_apart_and_few_where_nothing_can_be_ruled_out():
    rng = np.random.default_rng(6)
    sphere = rng.normal(size=(1000, 64))
    sphere /= np.linalg.norm(sphere, axis=1)[:, None]
    assert len(metric.choose_pivots(sphere, 64, 1.1, 10_000, 300.0)) == 1
    groups = np.stack([x for _, x in clustered(1000, 32, 8, 0.1, 7)])
    pivots = metric.choose_pivots(groups, 64, 1.0, 1_000_000, 300.0)
    assert len(pivots) >= 32 and metric.distances(pivots, pivots)[np.triu_indices(len(pivots), 1)].min() > 0
