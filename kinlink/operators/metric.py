"""Exact pairs of vectors within a Euclidean distance, by metric partitioning.

Pivots part the vectors into cells of nearest pivot. The triangle inequality tells which other cells may hold a
partner of a vector, and it is sent to those alone. Cells with many vectors are parted again by pivots of their own,
and what is still large is laid on a grid of slices, so that no task holds more than two slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kinlink.sources.scratch import written


@dataclass(frozen=True)
class MetricConfig:
    pivots: int = 256         # at most, for all vectors
    local_pivots: int = 16    # at most, for a cell that is parted again
    sample: int = 4096        # vectors that pivots are chosen from, on the driver; so many for all, and shared out among large cells
    cell_rows: int = 4096     # a cell of more is parted again, then sliced
    seed: int = 42
    # What copying a vector to a cell costs, in comparisons of a pair.
    copy_cost: float = 300.0


# --- geometry -----------------------------------------------------------------------------------

def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Distances of rows of x to rows of y by a matrix product; off by rounding, see slack."""
    squares = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0.0))


def slack(x: np.ndarray, y: np.ndarray) -> float:
    """More than the rounding of `distances` can be."""
    largest = max(float(np.abs(x).max(initial=0.0)), float(np.abs(y).max(initial=0.0)), 1e-300)
    return 1e-7 * largest * max(x.shape[1], 1) ** 0.5


def farthest_first(sample: np.ndarray, k: int) -> np.ndarray:
    """Up to k rows of the sample, each the one farthest from those before (Gonzalez 1985); no two are equal."""
    if not len(sample):
        return sample
    chosen, away = [0], distances(sample, sample[:1])[:, 0]
    while len(chosen) < k:
        far = int(away.argmax())
        if away[far] <= slack(sample, sample):
            break
        chosen.append(far)
        away = np.minimum(away, distances(sample, sample[far:far + 1])[:, 0])
    return sample[chosen]


def may_hold(d: np.ndarray, pivots: np.ndarray, radius: float, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For rows with distances d to the pivots: which cells can hold a vector within the radius.

    low and high are the least and largest distance of a cell's own vectors to its pivot. A partner p of q in cell j is
    nearer to pivot j than to q's nearest pivot i, so q lies at most the radius beyond the plane half-way
    between the two, which is (d_j^2 - d_i^2) / (2 |p_i p_j|) away; and it lies in the ring of the cell, widened by the radius.
    """
    near = d.argmin(1)
    off = slack(pivots, pivots) + 1e-9 * d.max(initial=0.0)
    apart = distances(pivots, pivots)[near]
    beyond = d * d - (d.min(1) ** 2)[:, None]
    plane = beyond <= 2.0 * (radius + off) * apart + 4.0 * off * d.max(initial=0.0)
    plane[np.arange(len(d)), near] = True
    return plane & (d >= low - radius - off) & (d <= high + radius + off)


def choose_pivots(sample: np.ndarray, most: int, radius: float, rows: int, copy_cost: float) -> np.ndarray:
    """Pivots from the sample, as many as make comparing and copying cheapest for so many rows, going by the sample.

    Where distances are all alike no cell can be ruled out, and one pivot is best.
    """
    every = farthest_first(sample, most)
    best, cost = every[:1], None
    d_all = distances(sample, every)
    k = 1
    while k <= len(every):
        d = d_all[:, :k]
        own = d.argmin(1)
        homes = np.bincount(own, minlength=k)
        low, high = np.full(k, np.inf), np.full(k, -np.inf)
        np.minimum.at(low, own, d.min(1))
        np.maximum.at(high, own, d.min(1))
        visits = may_hold(d, every[:k], radius, low, high) & (np.arange(k)[None, :] > own[:, None])
        pairs = (homes * (homes / 2.0 + visits.sum(0))).sum() / max(len(sample), 1) ** 2
        now = rows * pairs + copy_cost * visits.sum() / max(len(sample), 1)
        if cost is None or now < cost:
            best, cost = every[:k], now
        k *= 2
    return best


# --- dealing ------------------------------------------------------------------------------------

ROWS = "cell int, sub int, home boolean, id bigint, vec array<double>"


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _dealt(x: np.ndarray, ids: np.ndarray, home: np.ndarray, pivots: np.ndarray, radius: float, rings) -> tuple:
    """(row, cell, home): own cell of home rows; cells that may hold partners otherwise, later ones only for home rows.

    A pair of two cells is so met once, in the later cell.
    """
    d = distances(x, pivots)
    own = d.argmin(1)
    visits = may_hold(d, pivots, radius, *rings)
    visits &= ~home[:, None] | (np.arange(len(pivots))[None, :] > own[:, None])
    row, cell = np.nonzero(visits)
    at_home = np.flatnonzero(home)
    return (np.concatenate([at_home, row]), np.concatenate([own[at_home], cell]),
            np.concatenate([np.ones(len(at_home), bool), np.zeros(len(row), bool)]))


def _rows(cell, sub, home, ids, vectors: pa.Array, take) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(cell, pa.int32()), pa.array(sub, pa.int32()), pa.array(home), pa.array(ids[take]), vectors.take(pa.array(take))],
        ["cell", "sub", "home", "id", "vec"])


#: Rows given out at a time.
_SLICE = 2_000


def _deal_all(pivots: np.ndarray, radius: float, rings):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                ids = batch.column(0).to_numpy()
                row, cell, home = _dealt(_matrix(batch.column(1)), ids, np.ones(len(ids), bool), pivots, radius, rings)
                for a in range(0, len(row), _SLICE):
                    b = slice(a, a + _SLICE)
                    yield _rows(cell[b], np.zeros(len(cell[b]), np.int32), home[b], ids, batch.column(1), row[b])
    return task


def _deal_again(pivots: dict[int, np.ndarray], radius: float, rings: dict):
    """Rows of the cells in pivots go to the cells within; the others stay as they are."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE):
                batch = whole.slice(at, _SLICE)
                cells, homes, ids = batch.column(0).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()
                x = _matrix(batch.column(4))
                stay = np.flatnonzero(~np.isin(cells, list(pivots)))
                yield batch.take(pa.array(stay))
                for c in np.unique(cells[np.isin(cells, list(pivots))]).tolist():
                    mine = np.flatnonzero(cells == c)
                    row, sub, home = _dealt(x[mine], ids[mine], homes[mine], pivots[c], radius, rings[c])
                    for a in range(0, len(row), _SLICE):
                        b = slice(a, a + _SLICE)
                        yield _rows(np.full(len(row[b]), c), sub[b], home[b], ids, batch.column(4), mine[row[b]])
    return task


def _rings_of(rows: DataFrame, pivots: dict[int, np.ndarray]) -> dict:
    """{cell: (least, largest)} distance of its vectors, one entry for each pivot; rows have cell and vec, all at home."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            cells, x = batch.column(0).to_numpy(), _matrix(batch.column(1))
            for c in np.unique(cells).tolist():
                d = distances(x[cells == c], pivots[c])
                own, least = d.argmin(1), d.min(1)
                for j in np.unique(own).tolist():
                    a, b = least[own == j].min(), least[own == j].max()
                    low, high = seen.get((c, j), (a, b))
                    seen[c, j] = min(low, a), max(high, b)
        if seen:
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
                                              pa.array([seen[k][0] for k in keys]), pa.array([seen[k][1] for k in keys])], ["c", "j", "a", "b"])

    found = (rows.mapInArrow(task, "c int, j int, a double, b double").groupBy("c", "j").agg(F.min("a").alias("a"), F.max("b").alias("b")))
    rings = {c: (np.full(len(p), np.inf), np.full(len(p), -np.inf)) for c, p in pivots.items()}
    for r in found.collect():      # one row a pivot
        rings[r["c"]][0][r["j"]], rings[r["c"]][1][r["j"]] = r["a"], r["b"]
    return rings


def _to_matrix(rows: list) -> np.ndarray:
    return np.array([r["vec"] for r in rows], float) if rows else np.zeros((0, 1))


def _cells(vectors: DataFrame, radius: float, cfg: MetricConfig) -> DataFrame | None:
    """Rows (cell, sub, home, id, vec) in which every pair within the radius meets once; None without vectors."""
    rows = vectors.count()
    sample = _to_matrix(vectors.orderBy(F.xxhash64("id", F.lit(cfg.seed)), "id").limit(cfg.sample).select("vec").collect())
    if not len(sample):
        return None
    pivots = choose_pivots(sample, cfg.pivots, radius, rows, cfg.copy_cost)
    rings = _rings_of(vectors.select(F.lit(0).alias("cell"), "vec"), {0: pivots})[0]
    dealt = written(vectors.select("id", "vec").mapInArrow(_deal_all(pivots, radius, rings), ROWS), "cells")
    sizes = {r["cell"]: r["n"] for r in dealt.where("home").groupBy("cell").agg(F.count("*").alias("n")).collect()}   # one row a pivot
    large = [c for c, n in sizes.items() if n > cfg.cell_rows]
    if not large or len(pivots) == 1 and len(sample) <= cfg.local_pivots:
        return dealt
    within = dealt.where(F.col("home") & F.col("cell").isin(large))
    each = max(cfg.local_pivots, cfg.sample // len(large))
    first = Window.partitionBy("cell").orderBy(F.xxhash64("id", F.lit(cfg.seed + 1)), "id")
    picked = within.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= each).select("cell", "vec").collect()
    by_cell: dict[int, list] = {}
    for r in picked:      # no more than sample rows, or local_pivots for each large cell
        by_cell.setdefault(r["cell"], []).append(r)
    local = {c: choose_pivots(_to_matrix(s), cfg.local_pivots, radius, sizes[c], cfg.copy_cost) for c, s in by_cell.items()}
    local = {c: p for c, p in local.items() if len(p) > 1}
    if not local:
        return dealt
    rings = _rings_of(within.where(F.col("cell").isin(list(local))).select("cell", "vec"), local)
    return written(dealt.mapInArrow(_deal_again(local, radius, rings), ROWS), "cells")


# --- comparing ----------------------------------------------------------------------------------

PAIRS = "id_1 bigint, id_2 bigint, distance double, compared bigint"
_BLOCK = 256


def close_pairs(x: np.ndarray, y: np.ndarray, radius: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row numbers and distances of the pairs within the radius, and how many pairs were compared.

    Both sides are put in the order of their distance to one point; a block meets the stretch of the other side that the
    triangle inequality leaves. same: x and y are the same rows, and each pair counts once.
    """
    off = slack(x, y)
    point = x[:1]
    dx, dy = distances(x, point)[:, 0], distances(y, point)[:, 0]
    ox, oy = np.argsort(dx, kind="stable"), np.argsort(dy, kind="stable")
    x, y, sx, sy = x[ox], y[oy], dx[ox], dy[oy]
    found, compared = [], 0
    for a in range(0, len(x), _BLOCK):
        b = min(a + _BLOCK, len(x))
        low = a if same else int(np.searchsorted(sy, sx[a] - radius - 2 * off, "left"))
        high = int(np.searchsorted(sy, sx[b - 1] + radius + 2 * off, "right"))
        if low >= high:
            continue
        compared += (b - a) * (high - low) - ((b - a) * (b - a + 1) // 2 if same else 0)
        i, j = np.nonzero(distances(x[a:b], y[low:high]) <= radius + off)
        i, j = i + a, j + low
        if same:
            i, j = i[i < j], j[i < j]
        exact = np.sqrt(((x[i] - y[j]) ** 2).sum(1))
        keep = exact <= radius
        found.append((ox[i[keep]], oy[j[keep]], exact[keep]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), compared
    return (*(np.concatenate(part) for part in zip(*found)), compared)


def _compare(radius: float):
    def group(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        side = table.column("side").to_numpy()
        ids, x = table.column("id").to_numpy(), _matrix(table.column("vec").combine_chunks())
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        same = not len(two) and bool(table.column("same")[0].as_py())
        if not len(one) or not (same or len(two)):
            left = right = np.zeros(0, np.int64)
            away, compared = np.zeros(0), 0
        else:
            i, j, away, compared = close_pairs(x[one], x[one if same else two], radius, same)
            left, right = ids[one[i]], ids[(one if same else two)[j]]
        other = left != right
        left, right, away = left[other], right[other], away[other]
        n = len(left)
        return pa.table([pa.array(np.append(np.minimum(left, right), 0), mask=np.arange(n + 1) == n), pa.array(np.append(np.maximum(left, right), 0), mask=np.arange(n + 1) == n),
                         pa.array(np.append(away, 0.0), mask=np.arange(n + 1) == n), pa.array(np.append(np.zeros(n, np.int64), compared))],
                        names=["id_1", "id_2", "distance", "compared"])
    return group


def _compared(vectors: DataFrame, radius: float, cfg: MetricConfig, id_column: str, vector_column: str) -> DataFrame:
    """Pairs, and one row a group with null ids and the number of pairs compared in it."""
    if not radius >= 0:
        raise ValueError("the distance must not be negative")
    vec = F.col(vector_column).cast("array<double>")
    sound = vec.isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), vec.alias("vec")).where(sound & F.col(id_column).isNotNull())
    cells = _cells(rows, radius, cfg)
    if cells is None:
        return vectors.sparkSession.createDataFrame([], PAIRS)
    # One row a cell; at most pivots times local_pivots of them, so the table may be broadcast.
    counts = F.broadcast(cells.groupBy("cell", "sub").agg(
        F.ceil(F.count_if("home") / cfg.cell_rows).cast("int").alias("slices"),
        F.ceil(F.count_if(~F.col("home")) / cfg.cell_rows).cast("int").alias("visiting")))
    sliced = cells.join(counts, ["cell", "sub"]).where("slices > 0")
    own = F.expr("cast(pmod(xxhash64(id, vec), if(home, slices, visiting)) AS int)")
    sliced = sliced.withColumn("own", own)

    def meeting(first, last, i, j, side, kind) -> DataFrame:
        return F.transform(F.sequence(first, last), lambda n: F.struct(
            i(n).alias("i"), j(n).alias("j"), F.lit(side).alias("side"), F.lit(kind).alias("same")))

    me, it, nothing = lambda n: F.col("own"), lambda n: n, F.array().cast("array<struct<i:int,j:int,side:int,same:boolean>>")
    slices = F.col("slices")
    # Slices of a cell's own rows: each with itself, and with each later one; then each with the slices of visitors.
    itself = F.array(F.struct(F.col("own").alias("i"), F.col("own").alias("j"), F.lit(0).alias("side"), F.lit(True).alias("same")))
    later = F.when(F.col("own") + 1 < slices, meeting(F.col("own") + 1, slices - 1, me, it, 0, False)).otherwise(nothing)
    sooner = F.when(F.col("own") > 0, meeting(F.lit(0), F.col("own") - 1, it, me, 1, False)).otherwise(nothing)
    guests = F.when(F.col("visiting") > 0, meeting(F.lit(0), F.col("visiting") - 1, me, lambda n: -1 - n, 0, False)).otherwise(nothing)
    guest = meeting(F.lit(0), slices - 1, it, lambda n: -1 - F.col("own"), 1, False)
    places = F.when(F.col("home"), F.concat(itself, later, sooner, guests)).otherwise(guest)
    keyed = sliced.select("cell", "sub", F.explode(places).alias("at"), "id", "vec").select("cell", "sub", "at.*", "id", "vec")
    return keyed.groupBy("cell", "sub", "i", "j").applyInArrow(_compare(radius), PAIRS)


def vectors_within(vectors: DataFrame, max_distance: float, cfg: MetricConfig = MetricConfig(),
                   id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id_1, id_2, distance): every pair of rows with id_1 < id_2 whose vectors lie within the distance, once.

    Rows without an id, or whose vector is null, empty, or has null or non-finite components, take no part. All vectors
    have one length. Copies of a row give a pair each.
    """
    found = _compared(vectors, max_distance, cfg, id_column, vector_column)
    return found.where("id_1 IS NOT NULL").drop("compared")


def comparison_share(vectors: DataFrame, max_distance: float, cfg: MetricConfig = MetricConfig(),
                     id_column: str = "vec_id", vector_column: str = "embedding") -> float:
    """The share of all pairs that `vectors_within` compares."""
    n = vectors.count()
    compared = _compared(vectors, max_distance, cfg, id_column, vector_column).agg(F.sum("compared")).first()[0] or 0
    return compared / max(n * (n - 1) / 2, 1)
