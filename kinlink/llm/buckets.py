"""Rows that share a bucket, as pairs of a hub and a member, without gathering any bucket in one task.

Each task first pairs its own rows of a bucket with the first of them, and sends on only that one. So a
bucket reaches the shuffle at most once from each task, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinlink.llm import kernels as K
from kinlink.llm.components import connected_components

SCHEMA = "bucket bigint, hub bigint, member bigint"
NAMES = ["bucket", "hub", "member"]
#: Rows (bucket, id) that a task holds before it pairs and sends them.
HELD = 1_000_000
#: What is sent is packed, by hash of the bucket: 16 bytes a hub, 24 a member, in so many parts, of which tasks get several.
PACKED, PARTS = "part int, hubs binary, members binary", 4096   # 2^12
#: Members in one packed row. They are dealt to all parts, as a bucket can have many.
MEMBERS = 256


def _local(buckets: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """The smallest id of each bucket, its hub, and (bucket, hub, member) for the other ids, packed."""
    mixed = K.mix(buckets.view(K.U))
    order = np.argsort(mixed)
    buckets, ids, part = buckets[order], ids[order], (mixed[order] >> K.U(52)).astype(np.int32)
    first = np.ones(len(buckets), bool)
    first[1:] = buckets[1:] != buckets[:-1]
    start = np.flatnonzero(first)
    hub = np.minimum.reduceat(ids, start) if len(ids) else ids
    own = np.repeat(hub, np.diff(start, append=len(ids)))
    links = np.stack([buckets, own, ids])[:, ids != own]
    links = links[:, np.lexsort(links[[2, 0]])]
    links = links[:, np.append(np.ones(min(1, links.shape[1]), bool), (links[:, 1:] != links[:, :-1]).any(0))]
    part, buckets, ids = part[first], buckets[first], hub
    at = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    hubs = [buckets[i:j].tobytes() + ids[i:j].tobytes() for i, j in zip(at, at[1:])]
    members = [links[:, i:i + MEMBERS].tobytes() for i in range(0, links.shape[1], MEMBERS)]
    # From the part of the first one on: tasks that send few rows do not all send them to the same parts.
    turn = (int(part[0]) + int(ids[0] % PARTS) + np.arange(len(members))) % PARTS if members else []
    return pa.RecordBatch.from_arrays([
        pa.array([*part[at[:-1]], *turn], pa.int32()), pa.array([*hubs, *[None] * len(members)], pa.binary()),
        pa.array([*[None] * len(hubs), *members], pa.binary())], ["part", "hubs", "members"])


def _pairs(hubs: list[bytes]) -> pa.RecordBatch:
    """The hubs of each bucket, paired with the first of them."""
    bucket, own = np.concatenate([np.frombuffer(x, np.int64).reshape(2, -1) for x in hubs], axis=1)
    least = np.sort(bucket)
    again = np.unique(least[1:][least[1:] == least[:-1]])   # most buckets have one hub
    if len(again):
        place = np.minimum(np.searchsorted(again, bucket), len(again) - 1)
        bucket, own = bucket[again[place] == bucket], own[again[place] == bucket]
    else:
        bucket, own = bucket[:0], own[:0]
    order = np.lexsort((own, bucket))
    bucket, own = bucket[order], own[order]
    first = np.ones(len(bucket), bool)
    first[1:] = bucket[1:] != bucket[:-1]
    start = own[first][np.cumsum(first) - 1]
    pair = start != own
    return pa.RecordBatch.from_arrays([pa.array(x[pair]) for x in (bucket, start, own)], NAMES)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs the hubs of packed rows sorted by part; unpacks members."""
    last, held = None, []
    for batch in batches:
        for part, hubs, members in zip(*(c.to_pylist() for c in batch.columns)):
            if members is not None:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.frombuffer(members, np.int64).reshape(3, -1)], NAMES)
                continue
            if part != last and held:
                yield _pairs(held)
                held = []
            last = part
            held.append(hubs)
    if held:
        yield _pairs(held)


def star_pairs(rows: DataFrame, keys: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(bucket, hub, member): every row of a bucket with two or more different ids is linked to its hub, at one remove at most.

    `keys` gives buckets and ids (int64 arrays of one length) of a batch of rows.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            bucket, own = keys(batch)
            if len(bucket):
                held.append((bucket, own))
                n += len(bucket)
            if n >= HELD:
                yield _local(*map(np.concatenate, zip(*held)))
                held, n = [], 0
        if held:
            yield _local(*map(np.concatenate, zip(*held)))

    return rows.mapInArrow(task, PACKED).repartition("part").sortWithinPartitions("part").mapInArrow(_runs, SCHEMA)


def unresolved_groups(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """(grp, id, label): the rows of buckets that hold different components, grouped so that no bucket is parted.

    label is the row's component. Two rows of one bucket and different components are in one group.
    """
    known = components.toDF("id", "component")

    def labelled(rows: DataFrame, column: str) -> DataFrame:
        return rows.join(known.toDF(column, f"{column}_label"), column, "left").withColumn(f"{column}_label", F.coalesce(f"{column}_label", column))

    edges = labelled(labelled(pairs.select("hub", "member").distinct(), "hub"), "member")
    groups = connected_components(edges.select(F.col("hub_label").alias("a"), F.col("member_label").alias("b"))).toDF("label", "grp")
    rows = edges.select(F.explode(F.array(*(F.struct(F.col(c).alias("id"), F.col(f"{c}_label").alias("label")) for c in ("hub", "member")))).alias("r"))
    return rows.select("r.*").distinct().join(groups, "label").select("grp", "id", "label")
