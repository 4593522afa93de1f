"""Exact top-k inner products by dual-tree search over cover trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kinlink.llm.store import written

SCALE = 1024
#: Vectors in a block of candidates; queries come to it in blocks of as many.
BLOCK = 4096
#: The upper levels of the tree: at most so many centers, chosen from a sample of so many vectors; they decide on work, not on results.
CENTERS, SAMPLE = 1024, 4096
LEAF = 16
_LONG = -2.0**63


@dataclass
class Node:
    """Points within `radius` of `center`. Each is in one of the children, or is a child of radius 0 itself: one of `singles`."""

    center: np.ndarray
    radius: float
    norm: float
    points: np.ndarray
    children: list[Node] = field(default_factory=list)
    singles: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def nodes(self) -> Iterator[Node]:
        yield self
        for child in self.children:
            yield from child.nodes()


def _square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0.0)


def cover_tree(x: np.ndarray, points: np.ndarray | None = None, center: int | None = None) -> Node:
    """A cover tree over rows of x.

    Children's centers are more than half the node's radius apart and cover their points at that distance. A child of
    one point has radius 0. Nodes of up to LEAF points, or of one place, are leaves: all their points are singles.
    """
    points = np.arange(len(x)) if points is None else points
    center = int(points[0]) if center is None else center
    norm = float(np.sqrt((x[center] ** 2).sum()))
    node = Node(x[center], float(np.sqrt(((x[points] - x[center]) ** 2).sum(1).max())), norm, points)
    if len(points) <= LEAF or node.radius == 0.0:
        node.singles = points
        return node
    left, limit, singles = np.concatenate([[center], points[points != center]]), node.radius ** 2 / 4, []
    while len(left):
        first = left[:64]
        near = _square_distances(x[first], x[left]) <= limit
        near[np.arange(len(first)), np.arange(len(first))] = True
        chosen: list[int] = []
        for i in range(len(first)):
            if not near[chosen, i].any():
                chosen.append(i)
        owner = np.where(near[chosen].any(0), near[chosen].argmax(0), -1)
        sizes = np.bincount(owner[owner >= 0], minlength=len(chosen))
        singles += [int(left[i]) for i, size in zip(chosen, sizes) if size == 1]
        node.children += [cover_tree(x, left[owner == n], int(left[i])) for n, (i, size) in enumerate(zip(chosen, sizes)) if size > 1]
        left = left[owner < 0]
    node.singles = np.array(singles, np.int64)
    return node


def dual_search(queries: np.ndarray, candidates: np.ndarray, query_ids: np.ndarray, ids: np.ndarray, k: int,
                least: np.ndarray | None = None, tally: dict[str, int] | None = None, tree: Node | None = None) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of the k best of each query among the candidates, ties to smaller ids, without itself.

    Rows are of integers held in float64 whose products stay exact. A pair of nodes is left out when no product of
    its points can reach the least k-th score of the node's queries:
    q.c <= center.center + r_c |center_q| + r_q |center_c| + r_q r_c.
    `tree` is a tree of the candidates, if there is one already. `least` holds scores below which nothing is wanted of a query. The tally counts pairs of vectors that are scored, and pairs of
    nodes that are left out.
    """
    best: list[list[tuple[int, int]]] = [[] for _ in range(len(queries))]
    kth = np.full(len(queries), -np.inf) if least is None else least.astype(np.float64)
    lengths = np.sqrt((candidates ** 2).sum(1))
    tally = {} if tally is None else tally
    tally.update({x: tally.get(x, 0) for x in ("scored", "pruned")})

    def bounds(q: Node, centers: np.ndarray, radii: np.ndarray, norms: np.ndarray) -> np.ndarray:
        value = centers @ q.center + radii * q.norm + q.radius * norms + q.radius * radii
        return value + 1e-9 * np.abs(value) + 1e-6

    def score(rows: np.ndarray, columns: np.ndarray) -> None:
        tally["scored"] += len(rows) * len(columns)
        scores = queries[rows] @ candidates[columns].T
        floor = kth[rows]
        if scores.shape[1] > k + 1:  # no more than k of these, but for ties and the query itself, can matter
            floor = np.maximum(floor, np.partition(scores, -(k + 1), axis=1)[:, -(k + 1)])
        at, hits = np.nonzero(scores >= floor[:, None])
        for i, row, j in zip(rows[at].tolist(), at.tolist(), hits.tolist()):
            other, value = int(ids[columns[j]]), int(scores[row, j])
            if other == query_ids[i] or value < kth[i]:
                continue
            entry = (value, -other)
            if len(best[i]) < k:
                heapq.heappush(best[i], entry)
            elif entry > best[i][0]:
                heapq.heapreplace(best[i], entry)
            if len(best[i]) == k:
                kth[i] = max(kth[i], best[i][0][0])

    def visit_singles(q: Node, own: np.ndarray) -> None:
        """The query node with candidates that are nodes of radius 0."""
        if len(own):
            reach = bounds(q, candidates[own], np.zeros(1), lengths[own]) >= kth[q.points].min()
            tally["pruned"] += int((~reach).sum())
            own = own[reach]
        if len(own):
            if len(q.singles):
                score(q.singles, own)
            for child in q.children:
                visit_singles(child, own)

    def visit(q: Node, c: Node) -> None:
        if not c.children:
            visit_singles(q, c.singles)
        elif q.radius > c.radius and (q.children or len(q.singles) > 1):
            parts = q.children + [Node(queries[i], 0.0, float(np.sqrt((queries[i] ** 2).sum())), np.array([i]), [], np.array([i])) for i in q.singles]
            for part in parts:
                if bounds(part, c.center[None], np.array([c.radius]), np.array([c.norm]))[0] >= kth[part.points].min():
                    visit(part, c)
                else:
                    tally["pruned"] += 1
        else:
            radii, norms = np.array([x.radius for x in c.children]), np.array([x.norm for x in c.children])
            value = bounds(q, np.array([x.center for x in c.children]), radii, norms)
            for i in np.argsort(-value, kind="stable").tolist():
                if value[i] >= kth[q.points].min():
                    visit(q, c.children[i])
                else:
                    tally["pruned"] += 1
            visit_singles(q, c.singles)

    if len(queries) and len(candidates):
        visit(cover_tree(queries), tree or cover_tree(candidates))
    return [(int(query_ids[i]), -other, value) for i, own in enumerate(best) for value, other in own]


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Rows of long integers, filled with zeros up to the width."""
    ends = np.asarray(lists.offsets, np.int64)
    lengths, values = np.diff(ends), np.asarray(lists.flatten(), np.int64)
    if (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], lengths)] = values
    return out


def _plain(own: int, query: list[int], ids: list[int], candidates: list[list[int]], k: int) -> list[tuple[int, int, int]]:
    """The k best of one query by Python integers, for products that float64 does not hold; scores stop at the ends of a long."""
    scores = ((max(-2**63, min(2**63 - 1, sum(map(int.__mul__, query, v)))), -i) for i, v in zip(ids, candidates) if i != own)
    return [(own, -i, score) for score, i in heapq.nlargest(k, scores)]


def scaled(vector: Column) -> Column:
    """floor(1024 x) of each component; null for a vector that is null or holds nulls, NaN or infinities."""
    number = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(vector.isNotNull() & F.coalesce(finite, F.lit(False)), number)


def upper_centers(x: np.ndarray, wanted: int) -> np.ndarray:
    """Up to `wanted` centers of the tree's upper levels: the row farthest from the chosen ones comes next, so any prefix covers and keeps apart alike."""
    chosen, away = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < wanted and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def _nearest(centers: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1024) for i in range(0, batch.num_rows, 1024)):
                x = _matrix(part.column("v"), centers.shape[1]).astype(np.float64)
                place = _square_distances(x, centers).argmin(1)
                away = np.sqrt(((x - centers[place]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(3)), pa.array(place, pa.int32()), pa.array(away)], ["vec_id", "v", "is_query", "c", "away"])
    return task


def _other_centers(centers: np.ndarray, radii: np.ndarray):
    """Each query with the centers, but for its own, whose points may reach its k-th score."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                x = _matrix(part.column("v"), centers.shape[1]).astype(np.float64)
                norms, least = np.sqrt((x ** 2).sum(1)), _scores(part.column("least"), _LONG)
                reach = norms[:, None] * radii[None]
                value = x @ centers.T + reach
                value = np.maximum(value + 1e-9 * (norms[:, None] * np.sqrt((centers ** 2).sum(1))[None] + reach) + 1e-6, _LONG)
                wanted = value >= least[:, None]
                wanted[np.arange(len(x)), part.column("c").to_numpy()] = False
                at, other = np.nonzero(wanted)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(name).take(pa.array(at)) for name in ("vec_id", "v", "least", "c")), pa.array(other, pa.int32())],
                    ["vec_id", "v", "least", "c", "other"])
    return task


def _scores(column: pa.Array, none: float) -> np.ndarray:
    return np.where(np.asarray(column.is_null()), none, np.asarray(column.fill_null(0), np.float64))


def _search_blocks(k: int, width: int, block: int):
    """Rows come by block, candidates first. The candidates' tree is built once, then searched by blocks of queries."""
    def largest(m: np.ndarray) -> int:
        return max(int(m.max(initial=0)), -int(m.min(initial=0)))

    def search(index: list[tuple], asked: list[tuple], built: dict) -> pa.RecordBatch:
        if not built:
            ids, m = (np.concatenate(x) for x in list(zip(*index))[:2])
            built.update(ids=ids, m=m.astype(np.float64), exact=m, largest=largest(m))
            built["tree"] = cover_tree(built["m"]) if len(m) else None
        query_ids, m, least = (np.concatenate(x) for x in zip(*asked))
        if max(built["largest"], largest(m)) ** 2 * max(1, width) < 2**53:
            found = dual_search(m.astype(np.float64), built["m"], query_ids, built["ids"], k, least, tree=built["tree"])
        else:
            found = [hit for own, q in zip(query_ids.tolist(), m.tolist()) for hit in _plain(own, q, built["ids"].tolist(), built["exact"].tolist(), k)]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in range(3)], ["query_id", "vec_id", "score"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, index, asked, built, waiting = None, [], [], {}, 0
        for batch in batches:
            other, j, asks, ids = (np.asarray(batch.column(i)) for i in range(4))
            m, least = _matrix(batch.column(4), width), _scores(batch.column(5), -np.inf)
            cuts = np.flatnonzero((np.diff(other) != 0) | (np.diff(j) != 0) | (asks[1:] != asks[:-1])) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)]):
                if lo == hi:
                    continue
                if key != (other[lo], j[lo]):
                    if asked and index:
                        yield search(index, asked, built)
                    key, index, asked, built, waiting = (other[lo], j[lo]), [], [], {}, 0
                (asked if asks[lo] else index).append((ids[lo:hi], m[lo:hi], least[lo:hi]))
                waiting += hi - lo if asks[lo] else 0
                if waiting >= block and index:
                    yield search(index, asked, built)
                    asked, waiting = [], 0
        if asked and index:
            yield search(index, asked, built)
    return task


def _in_blocks(asked: DataFrame, index: DataFrame, blocks: int, k: int, width: int, block: int) -> DataFrame:
    """The k best of each query in each block of candidates (other, j) that it comes to: (query_id, vec_id, score)."""
    columns = ["other", "j", "asks", "vec_id", "v", "least", "c"]
    rows = asked.withColumn("asks", F.lit(True)).select(columns).union(
        index.select("other", "j", F.lit(False), "vec_id", "v", F.lit(None).cast("bigint"), F.lit(0)))
    return (rows.repartition(max(1, min(blocks, 10_000)), "other", "j").sortWithinPartitions("other", "j", "asks", "c")
            .mapInArrow(_search_blocks(k, width, block), "query_id bigint, vec_id bigint, score bigint"))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, is_query: Column, k: int, block: int = BLOCK, tally: dict[str, int] | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest integer inner products with each query, itself excluded.

    vectors has vec_id and embedding. Components become floor(1024 x). Vectors that are null or hold null or
    non-finite components, and null ids, take no part; shorter vectors are filled with zeros; rows repeated with an
    id are candidates once (the largest vector in array order). Ties go to the smaller vec_id. An empty table gives no rows.

    Vectors go to the nearest center of the tree's upper levels; those of a center are cut into blocks by a hash of
    the id. A query is first searched in its own center's blocks. Its k-th score there rules out other centers by
    their radii, before anything is shuffled to them. A block holds the tree of its candidates, which is searched with
    trees of the queries that come to it, and the best k of all blocks are merged. Candidates are shuffled once a step, whatever
    the number of queries. The tally counts `reached` (query, other center) pairs of `possible` ones.
    """
    rows = (vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), scaled(F.col("embedding")).alias("v"))
            .where("vec_id IS NOT NULL AND v IS NOT NULL").groupBy("vec_id").agg(F.max("v").alias("v")))
    rows = written(rows.withColumn("is_query", F.coalesce(is_query, F.lit(False))), "vectors")
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    sample = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").select("v").limit(SAMPLE).collect()]  # bounded
    centers = upper_centers(_matrix(pa.array(sample or [[]], pa.list_(pa.int64())), width).astype(np.float64), min(CENTERS, -(-n // block)))
    placed = written(rows.mapInArrow(_nearest(centers), "vec_id bigint, v array<bigint>, is_query boolean, c int, away double"), "vectors-placed")
    stats = placed.groupBy("c").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect()  # CENTERS rows
    blocks, radii = np.ones(len(centers), int), np.full(len(centers), -np.inf)
    for r in stats:
        blocks[r["c"]], radii[r["c"]] = -(-r["n"] // block), r["radius"]
    layout = F.broadcast(rows.sparkSession.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "other int, blocks int"))  # CENTERS rows
    in_blocks = lambda asked: _in_blocks(
        asked.join(layout, "other").withColumn("j", F.explode(F.expr("sequence(0, blocks - 1)"))),
        placed.withColumnRenamed("c", "other").join(layout, "other").withColumn("j", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int")),
        int(blocks.sum()), k, width, block)

    asked = placed.where("is_query").select("c", F.col("c").alias("other"), "vec_id", "v", F.lit(None).cast("bigint").alias("least"))
    own = _best(in_blocks(asked), k)
    if len(centers) > 1:
        own = written(own.select("query_id", "vec_id", "score"), "vectors-own")
        least = own.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") == k, F.min("score")).alias("least"))
        queries = placed.where("is_query").join(least, "vec_id", "left").select("vec_id", "v", "least", "c")
        reached = queries.mapInArrow(_other_centers(centers, radii), "vec_id bigint, v array<bigint>, least bigint, c int, other int")
        if tally is not None:
            tally.update(reached=reached.count(), possible=(len(centers) - 1) * queries.count())
        own = _best(own.union(in_blocks(reached)), k)
    return own.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
