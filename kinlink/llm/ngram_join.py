"""Jaccard self-join of documents on word 5-grams as a T-occurrence search with DivideSkip."""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kinlink.llm import kernels as K
from kinlink.llm.buckets import star_pairs
from kinlink.llm.cells import cell_rows, minority_cells
from kinlink.llm.components import connected_components
from kinlink.llm.store import written

WIDTH, PERCENT = 5, 80
#: Documents in a block, and so in either side of a cell.
BLOCK = 128
PIVOTS = 4
#: DivideSkip's weight of the logarithm of the longest list when it chooses how many lists to probe.
MU = 0.0085


def required(n: int) -> int:
    """Shingles that a set of n must share with any set it links to."""
    return -(-PERCENT * n // 100)


def shared_at_least(n: int) -> int:
    return max(1, n // 10)


def prefix_length(n: int) -> int:
    """So many of a set's smallest hashes hold shared_at_least(n) of those shared with any linked set as large."""
    return n - required(n) + shared_at_least(n)


def divide_skip(lists: list[list[int]], least: int) -> Iterator[tuple[int, int]]:
    """(document, occurrences) of the documents in at least `least` of the sorted lists.

    The longest lists are set aside. The others are merged with a heap that leaps over documents that cannot
    reach what is then required; documents that do are looked up in the lists set aside by binary search.
    """
    lists = sorted(lists, key=len)
    longest = len(lists[-1]) if lists else 0
    aside = min(least - 1, int(least / (MU * math.log2(longest + 1) + 1)))
    probed, merged = lists[len(lists) - aside:], lists[:len(lists) - aside]
    need = least - aside
    heap = [(own[0], i, 0) for i, own in enumerate(merged)]
    heapq.heapify(heap)
    while len(heap) >= need:
        top, popped = heap[0][0], []
        while heap and heap[0][0] == top:
            popped.append(heapq.heappop(heap))
        if len(popped) >= need:
            count = len(popped)
            for left, own in zip(range(len(probed), 0, -1), probed):
                if count + left < least:
                    break
                at = bisect_left(own, top)
                count += at < len(own) and own[at] == top
            if count >= least:
                yield top, count
            following = top + 1
        else:
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap))
            if not heap:
                return
            following = heap[0][0]
        for _, i, at in popped:
            at = bisect_left(merged[i], following, at)
            if at < len(merged[i]):
                heapq.heappush(heap, (merged[i][at], i, at))


def search_cell(queries: list[tuple[int, int, np.ndarray]], index: list[tuple[int, int, np.ndarray]]) -> list[tuple[int, int]]:
    """Linked pairs of ids, one row (id, label, sorted hashes) of each side; rows of one label are not compared."""
    lists: dict[int, list[int]] = defaultdict(list)
    index = sorted(index, key=lambda row: row[0])
    for i, (_, _, tokens) in enumerate(index):
        for token in tokens.tolist():
            lists[token].append(i)
    found = []
    for own, label, tokens in queries:
        n = len(tokens)
        for i, shared in divide_skip([lists[t] for t in tokens.tolist() if t in lists], required(n)):
            other, other_label, theirs = index[i]
            if other != own and other_label != label and (100 + PERCENT) * shared >= PERCENT * (n + len(theirs)):
                found.append((min(own, other), max(own, other)))
    return found


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each cell; rows (cell, query, id, label, tokens) come sorted by cell. query: 0 index, 1 query, 2 both."""
    cell, queries, index = None, [], []

    def search() -> pa.RecordBatch:
        links = set(search_cell(queries, index))
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    for batch in batches:
        tokens = batch.column(4)
        flat, cuts = tokens.values.to_numpy(), tokens.offsets.to_numpy()
        for i, (key, kind, own, label) in enumerate(zip(*(batch.column(j).to_pylist() for j in range(4)))):
            if key != cell and cell is not None:
                yield search()
                queries, index = [], []
            cell = key
            row = (own, label, flat[cuts[i]:cuts[i + 1]].copy())
            if kind != 0:
                queries.append(row)
            if kind != 1:
                index.append(row)
    if cell is not None:
        yield search()


def _in_cells(rows: DataFrame) -> DataFrame:
    """Links of the rows (cell, query, id, label, tokens), one cell after the other in each task."""
    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(_cells, "a bigint, b bigint")


def _sets(column: pa.Array) -> list[np.ndarray]:
    return [own for _, own in K.shingle_sets(column, WIDTH)]


def _class(own: np.ndarray) -> int:
    """A 64-bit hash of a sorted set."""
    steps = K.mix(own + np.arange(1, len(own) + 1, dtype=K.U) * K.U(0x9E3779B97F4A7C15))
    return int(K.mix(np.array([steps.sum() + K.U(len(own))]))[0].view(np.int64))


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = _sets(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array([_class(x) if len(x) else None for x in sets], pa.int64())],
            ["doc_id", "n_shingles", "class"])


def _prefixes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The prefix hashes of each document, with its class."""
    sets = [x for x in _sets(batch.column(1)) if len(x)]
    if not sets:
        return (np.zeros(0, np.int64),) * 2
    heads = [x[:prefix_length(len(x))] for x in sets]
    return np.concatenate(heads).view(np.int64), np.repeat(np.array([_class(x) for x in sets]), [len(x) for x in heads])


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, set) of each text that has words."""
    for batch in batches:
        own = [x for x in _sets(batch.column(0)) if len(x)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([_class(x) for x in own], pa.int64()), pa.array([x.view(np.int64) for x in own], pa.list_(pa.int64()))], ["id", "tokens"])


def similar_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs: components of links at Jaccard 0.8 or more, exactly.

    1. Documents with equal sets form a class, a node of the search, and the text of its smallest id goes on.
    2. In hash order, the first 0.2 n + 0.1 n hashes of two linked sets share 0.08 n at least. Classes with fewer
       hashes in any other class's prefix have no link.
    3. The rest is grouped by its rarest hashes: two linked sets share one of the first 0.2 n + 1 hashes of each,
       the rarest first. Hashes in no other document take places there but bring nobody together.
    4. Groups are searched in cells of at most about 128 queries and 128 indexed documents by DivideSkip. A larger
       group is first searched with about four pivots; then only documents outside its largest component are
       queries, against all its blocks.
    Shingles are 64-bit hashes. Fewer than five words make one shingle; null, empty and blank texts have none and
    are alone. A null doc_id takes no part in links and has component null. Rows with one id count as one
    document with the links of each, but those without words are alone. Other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    classes = written(docs.mapInArrow(_classes, "doc_id bigint, n_shingles bigint, class bigint"), "sets")
    first = classes.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n")).where("id IS NOT NULL")

    shared = (star_pairs(docs.where("doc_id IS NOT NULL"), _prefixes)
              .select("bucket", F.explode(F.array("hub", "member")).alias("class")).distinct()
              .groupBy("class").agg(F.count("*").alias("shared")))
    enough = F.greatest(F.lit(1), F.expr(f"((n * {PERCENT} + 99) div 100) div 10"))
    survivors = written(first.join(shared, "class").withColumn("enough", enough).where("shared >= enough")
                        .select(F.col("class").alias("id"), F.col("id").alias("doc_id"), "n"), "survivors")
    # Of an id with several texts the others come along; classes that have no link are left out again where prefixes are made.
    # The ids alone are a table of their own: what Spark compares with its limit of a broadcast is the size of the file.
    chosen = docs.join(written(survivors.select("doc_id"), "survivor-ids"), "doc_id", "left_semi").select("text")
    survivors = survivors.drop("doc_id")
    sets = written(chosen.mapInArrow(_token_rows, "id bigint, tokens array<bigint>").dropDuplicates(["id"]), "survivor-sets")

    tokens = written(sets.select("id", F.explode("tokens").alias("token")), "tokens")
    lists = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    by_rarity, own = Window.partitionBy("id").orderBy("df", "token"), Window.partitionBy("id")
    prefix = (tokens.join(lists, "token").withColumn("place", F.row_number().over(by_rarity)).withColumn("common", F.count("*").over(own))
              .join(survivors, "id").where(f"n - common + place <= n - (n * {PERCENT} + 99) div 100 + 1").select("token", "id"))
    prefix = written(prefix, "prefixes")
    hubs = prefix.groupBy("token").agg(F.min("id").alias("hub"))
    edges = prefix.join(hubs, "token").where("id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    groups = connected_components(edges.distinct()).toDF("id", "grp")
    sizes = groups.groupBy("grp").agg(F.count("*").alias("m"))
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    members = written(groups.join(sizes, "grp").withColumn("blocks", blocks)
                      .withColumn("block", F.expr("cast(pmod(xxhash64(id), blocks) AS int)")).join(sets, "id"), "members")

    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    small, large = members.where(f"m <= {BLOCK}"), members.where(f"m > {BLOCK}")
    zero = F.lit(0)
    pivots = large.where(f"pmod(xxhash64(id, 1), m) < {PIVOTS}").withColumn("each", each)
    round_one = (cell_rows(small, zero, zero, 2, F.col("id"), "tokens")
                 .union(cell_rows(large, F.lit(-1), F.col("block"), 0, F.col("id"), "tokens"))
                 .union(cell_rows(pivots, F.lit(-1), F.col("each"), 1, F.col("id"), "tokens")))
    links = written(_in_cells(round_one), "links")
    if not large.isEmpty():
        labels = connected_components(links).toDF("id", "label")
        labelled = large.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
        links = links.union(written(_in_cells(minority_cells(labelled, "tokens", BLOCK)), "more-links"))
    # The classes of one id belong together.
    own = written(classes.where("doc_id IS NOT NULL AND class IS NOT NULL").groupBy("doc_id")
                  .agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a < b").select("doc_id", "a"), "several-texts")
    same = classes.join(own, "doc_id").where("class != a").select("a", F.col("class").alias("b")).distinct()
    joined = written(connected_components(links.union(same)).toDF("class", "label").join(first.select("class", "id"), "class"), "components")
    linked = joined.join(joined.groupBy("label").agg(F.min("id").alias("component_id")), "label").select("class", "component_id")
    return (classes.join(first.select("class", "id"), "class", "left").join(linked, "class", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "id", "doc_id")).alias("component_id")))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs whose id is its component's; rows with null ids stay."""
    gone = similar_documents(docs).where("doc_id != component_id").select(F.col("doc_id").alias("gone_doc_id")).distinct()
    return docs.join(gone, F.col("doc_id").cast("bigint") == F.col("gone_doc_id"), "left_anti")
