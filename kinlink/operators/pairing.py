"""Equi-joins that survive hot keys.

Every join of this engine that pairs rows inside groups (blocks, LSH buckets) goes through
`pair_rows`. Each row carries one key or several (passes); two rows meet in the first pass
whose keys agree, so no de-duplication shuffle is needed afterwards.

A key is hot when its number of pairs is above a budget. Every hot key is treated as one, however
many there are: the list is counted, and broadcast only up to a bounded length; a longer one is
joined like any table. Without hot keys the join is the plain one. Rows with hot keys are first given finer keys where the caller knows some, then
laid out on a grid: the left rows of a hot key are cut into slices, the right rows too, and each
cell of the grid is a join key of its own.

What depends on few columns need not be worked out for every pair of rows. With `Bundles`, rows of a key that
agree in those columns are put into bundles of a bounded size, bundles are paired and compared, and the pairs of
their rows are listed only where the bundles pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinlink.sources.scratch import written

STRATEGIES = ("auto", "plain", "broadcast", "shuffle_hash", "salted")

# Names of the technical columns.
PASS, KEY, KEYS, SUB, SUBKEY, CELL = "_pass", "_key", "_keys", "_sub", "_subkey", "_cell"
ROWS, SLICE = "_rows", "_slice"


@dataclass(frozen=True)
class SkewConfig:
    pair_budget: int = 25_000_000   # a key with more pairs than this is hot
    slice_rows: int = 5_000         # rows of one side in one grid cell
    max_hot_keys: int = 10_000      # longest list of hot keys that is broadcast
    tiny_bytes: int = 1 << 20       # a side below this needs no look for hot keys
    spread_bytes: int = 256 << 20   # a side below this has few splits and is spread over the cores


@dataclass(frozen=True)
class FinerKeys:
    """Attributes of which at least one must agree in any pair worth keeping."""

    names: list[str] = field(default_factory=list)   # column names present on both sides


@dataclass(frozen=True)
class Bundles:
    """Rows that agree in `by`, put together. `summary` holds aggregates over the rows of a bundle, by name.

    `bound(left, right)` is a test that bundles pass if any two of their rows can; it may use `by` and `summary`.
    `extend` maps names to functions of (left, right), which may use `by`: columns worked out once a pair of bundles.
    """

    by: list[str]
    summary: dict[str, Column] = field(default_factory=dict)
    bound: Callable | None = None
    extend: dict[str, Callable] = field(default_factory=dict)
    derive: dict[str, Column] = field(default_factory=dict)   # worked out once a bundle, for `bound`
    max_rows: int = 64


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; runs nothing."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """The session's limit in bytes; a negative setting means never."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip()
    if text.startswith("-"):
        return -1
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def with_passes(df: DataFrame, keys: list[Column] | Column) -> DataFrame:
    """One row per pass, in columns `_pass` and `_key`, plus `_keys` when there are several.

    `keys` is a list of columns or one array column; a row has no part in passes whose key is NULL.
    """
    if isinstance(keys, list) and len(keys) == 1:
        return df.withColumns({PASS: F.lit(0), KEY: keys[0]}).where(F.col(KEY).isNotNull())
    keyed = df.withColumn(KEYS, F.array(*keys) if isinstance(keys, list) else keys)
    # The outer form: for the plain one Spark adds a filter on the array's size, which computes
    # the keys a second time.
    return keyed.select("*", F.posexplode_outer(KEYS).alias(PASS, KEY)).where(F.col(KEY).isNotNull())


def _first_agreeing(left: list[Column], right: list[Column]) -> Column:
    """Index of the first pair of columns that agrees."""
    chain = F
    for i, (x, y) in enumerate(zip(left, right)):
        chain = chain.when(x == y, i)
    return chain


def hot_keys(a: DataFrame, b: DataFrame, keys: list[str], cfg: SkewConfig) -> DataFrame:
    """The keys with more pairs than the budget; a bundle counts as the rows in it."""
    n1, n2 = (F.size(ROWS) if ROWS in df.columns else F.lit(1) for df in (a, b))
    sides = a.select(*keys, n1.alias("l"), F.lit(0).alias("r")).unionByName(
        b.select(*keys, F.lit(0).alias("l"), n2.alias("r"))
    )
    counts = sides.groupBy(*keys).agg(F.sum("l").alias("n1"), F.sum("r").alias("n2"))
    pairs = F.col("n1").cast("double") * F.col("n2")
    return counts.where(pairs > cfg.pair_budget)


def hot_small_side(small: DataFrame, keys: list[str], cfg: SkewConfig) -> DataFrame:
    """Keys with many rows on the side that is broadcast; found without reading the other side."""
    counts = small.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > cfg.slice_rows)


def _listed(hot: DataFrame, cfg: SkewConfig) -> DataFrame | None:
    """The list of hot keys, written once and marked for broadcast if it is short; None without any."""
    hot = written(hot, "hot-keys")
    n = hot.count()
    return None if n == 0 else F.broadcast(hot) if n <= cfg.max_hot_keys else hot


def _refine(df: DataFrame, hot: DataFrame, finer: FinerKeys) -> DataFrame:
    """Rows of hot keys: one copy per finer attribute they have. Other rows: one copy, sub -1."""
    marked = df.join(hot.withColumn("_hot", F.lit(True)).select(PASS, KEY, "_hot"), [PASS, KEY], "left")
    entry = lambda i, value: F.struct(F.lit(i).alias(SUB), value.alias(SUBKEY))
    fine = F.array(*[entry(i, F.col(c)) for i, c in enumerate(finer.names)])
    whole = F.array(entry(-1, F.lit("")))
    exploded = marked.withColumn("_e", F.explode_outer(F.when(F.col("_hot"), fine).otherwise(whole)))
    return (
        exploded.withColumns({SUB: F.col(f"_e.{SUB}"), SUBKEY: F.col(f"_e.{SUBKEY}")})
        .drop("_e", "_hot").where(F.col(SUBKEY).isNotNull())
    )


def _on_grid(df: DataFrame, hot: DataFrame, keys: list[str], side: int, cfg: SkewConfig,
             spread_by: list[str]) -> DataFrame:
    """Cell numbers for rows of hot keys: own slice fixed by a hash, all slices of the other side."""
    mine, other = ("n1", "n2") if side == 1 else ("n2", "n1")
    slices = lambda n: F.ceil(F.coalesce(F.col(n), F.lit(1)) / F.lit(cfg.slice_rows)).cast("int")
    # The input partition is part of the hash, so that exact copies of a row spread as well, and a
    # task that is run again assigns the same slices whatever the order of its rows.
    draw = F.xxhash64(*spread_by, F.spark_partition_id())
    spread = (
        df.withColumn("_draw", draw)
        .join(hot, keys, "left")
        .withColumn("_own", F.pmod(F.col("_draw"), slices(mine).cast("long")))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), slices(other) - 1)))
    )
    first, second = ("_own", "_other") if side == 1 else ("_other", "_own")
    return spread.withColumn(
        CELL, F.concat_ws(":", F.col(first).cast("string"), F.col(second).cast("string"))
    ).drop("_draw", "_own", "_other", "n1", "n2")


def _bundled(df: DataFrame, keys: list[str], cols: list[str], bundles: Bundles, max_rows: int, parts: int) -> DataFrame:
    """One row per bundle: keys, `by`, number, summary and `_rows` with the other columns. One shuffle."""
    group = keys + bundles.by
    rest = [c for c in cols if c not in bundles.by]
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*rest))
    # The pass is left out of the hash: where it is a constant the window and the sums do not ask for it, and
    # Spark would shuffle once more, into as few partitions as the bytes need.
    sliced = df.repartition(parts, *[c for c in group if c != PASS]).withColumn(SLICE, F.floor((place - 1) / max_rows))
    gathered = [F.collect_list(F.struct(*rest)).alias(ROWS)] + [c.alias(n) for n, c in bundles.summary.items()]
    return sliced.groupBy(*group, SLICE).agg(*gathered).withColumns(bundles.derive)


def pair_rows(
    a: DataFrame,
    b: DataFrame,
    keys_a: list[Column] | Column,
    keys_b: list[Column] | Column,
    residual=None,
    strategy: str = "auto",
    finer: FinerKeys | None = None,
    skew: SkewConfig = SkewConfig(),
    passes: int | None = None,
    bundles: Bundles | None = None,
) -> DataFrame:
    """All (left, right) pairs that agree in some pass and satisfy `residual(left, right)`.

    The result has two struct columns `l` and `r`, `_pass` and, without bundles, `_key`. `residual` takes two functions
    from column name to Column and is part of the join condition, so rejected pairs are never
    emitted. `passes` is the length of array keys. With `bundles`, the columns of `extend` follow.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}, got {strategy!r}")
    if not isinstance(keys_a, list) and passes is None:
        raise ValueError("array keys need their length in `passes`")
    copies = len(keys_a) if isinstance(keys_a, list) else passes
    cols_a, cols_b = a.columns, b.columns
    left, right = with_passes(a, keys_a), with_passes(b, keys_b)
    join_on = [PASS, KEY]
    has_finer = bool(finer and finer.names)
    refined, broadcast_right = False, None
    cores = a.sparkSession.sparkContext.defaultParallelism
    if strategy in ("auto", "broadcast"):
        # The estimate does not know that exploding the passes multiplies the rows.
        size_l, size_r = estimated_bytes(left) * copies, estimated_bytes(right) * copies
        fits = min(size_l, size_r) <= broadcast_limit(left)
        if not fits:
            strategy = "salted"
        else:
            # The small side is broadcast, which leaves the other one where it is: no shuffle, no
            # skewed task. Only the work per row can grow, within a hot key of the small side.
            small_is_right = size_r <= size_l
            if has_finer and min(size_l, size_r) > skew.tiny_bytes:
                hot = _listed(hot_small_side(right if small_is_right else left, join_on, skew), skew)
                if hot is not None:
                    left, right, refined = _refine(left, hot, finer), _refine(right, hot, finer), True
            # Pair work grows with the square of the rows, so a table of one or two splits would
            # keep one or two cores busy. It is spread; larger ones come in many splits anyway.
            if bundles is None and max(size_l, size_r) <= skew.spread_bytes:
                left, right = (left.repartition(cores), right) if small_is_right else (left, right.repartition(cores))
            broadcast_right = small_is_right
    hot = _listed(hot_keys(left, right, join_on, skew), skew) if strategy == "salted" else None
    if hot is not None and has_finer:
        left, right, refined = _refine(left, hot, finer), _refine(right, hot, finer), True
    if refined:
        join_on = join_on + [SUB, SUBKEY]
    if bundles is not None:
        # Pairs are the work, so their tasks are dealt by cores, not by bytes.
        parts = max(cores * 4, int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        group = join_on + ([KEYS] if KEYS in left.columns else [])
        left, right = (_bundled(df, group, cols, bundles, min(bundles.max_rows, skew.slice_rows), parts) for df, cols in ((left, cols_a), (right, cols_b)))
        kept = hot is not None
        if kept:
            left, right = written(left, "bundles"), written(right, "bundles")
    if hot is not None and (has_finer or bundles is not None):
        hot = _listed(hot_keys(left, right, join_on, skew), skew)
    if hot is not None:
        spread = (lambda cols: bundles.by + [SLICE, ROWS]) if bundles is not None else (lambda cols: cols)
        left = _on_grid(left, hot, join_on, 1, skew, spread(cols_a))
        right = _on_grid(right, hot, join_on, 2, skew, spread(cols_b))
        join_on = join_on + [CELL]
    if broadcast_right is not None:
        left, right = (left, F.broadcast(right)) if broadcast_right else (F.broadcast(left), right)
    elif bundles is not None:
        # A constant is no key of the join either; read back from a table, the pass is one.
        dealt = [c for c in join_on if c != PASS or copies > 1 or kept]
        left, right = left.repartition(parts, *dealt), right.repartition(parts, *dealt)
    if strategy == "shuffle_hash":
        right = right.hint("shuffle_hash")

    x, y = left.alias("x"), right.alias("y")
    l, r = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    condition = l(join_on[0]) == r(join_on[0])
    for c in join_on[1:]:
        condition = condition & (l(c) == r(c))
    if KEYS in left.columns:
        places = [F.lit(i) for i in range(copies)]
        first = _first_agreeing([F.get(l(KEYS), i) for i in places], [F.get(r(KEYS), i) for i in places])
        condition = condition & (l(PASS) == first)
    def of_rows(l, r) -> list[Column]:
        tests = []
        if refined:
            first = _first_agreeing([l(c) for c in finer.names], [r(c) for c in finer.names])
            tests.append((F.col(f"x.{SUB}") == -1) | (F.col(f"x.{SUB}") == first))
        return tests + ([residual(l, r)] if residual is not None else [])

    if bundles is None:
        for test in of_rows(l, r):
            condition = condition & test
        return x.join(y, condition, "inner").select(
            F.struct(*[l(c) for c in cols_a]).alias("l"),
            F.struct(*[r(c) for c in cols_b]).alias("r"),
            l(PASS).alias(PASS), l(KEY).alias(KEY),
        )
    if bundles.bound is not None:
        condition = condition & bundles.bound(l, r)
    met = x.join(y, condition, "inner").select(
        F.struct(*[l(c) for c in bundles.by + [ROWS]]).alias("l"), F.struct(*[r(c) for c in bundles.by + [ROWS]]).alias("r"),
        F.struct(*[l(c) for c in (PASS, SUB) if c in left.columns]).alias("x"))
    shared = [fn(lambda c: F.col(f"l.{c}"), lambda c: F.col(f"r.{c}")).alias(n) for n, fn in bundles.extend.items()]
    pairs = met.select("*", *shared)
    names = list(bundles.extend)
    pairs = pairs.select("l", "r", "x", *names, F.explode(f"l.{ROWS}").alias("lr"))
    pairs = pairs.select("l", "r", "x", *names, "lr", F.explode(f"r.{ROWS}").alias("rr"))
    side = lambda n: (lambda c: F.col(f"{n}.{c}" if c in bundles.by else f"{n}r.{c}"))
    for test in of_rows(side("l"), side("r")):
        pairs = pairs.where(test)
    return pairs.select(
        F.struct(*[side("l")(c).alias(c) for c in cols_a]).alias("l"), F.struct(*[side("r")(c).alias(c) for c in cols_b]).alias("r"),
        F.col(f"x.{PASS}").alias(PASS), *names)
