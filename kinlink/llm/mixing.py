"""Temperature mixing of sources, in DataFrame operations only: exponent, weights, budgets, block permutations."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinlink.llm.store import written

WORD = r"[^\x20\x09-\x0D]+"
#: Halvings of the exponent's interval; four are done by one query.
HALVINGS = 40
WEIGHT_UNITS = 1_000_000
BLOCK_ROWS, SUPER_BLOCKS = 4096, 1024


def keyed_hash(*parts: Column) -> Column:
    """60 bits of an MD5 of the parts, joined by colons; a null part is empty."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def token_table(docs: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens), one row per id: words of the text; rows repeated with one id count as one."""
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_tokens"))
            .where("n_tokens > 0").groupBy("doc_id").agg(F.min(F.struct("source", "n_tokens")).alias("row"))
            .select("doc_id", F.col("row.source").alias("source"), F.col("row.n_tokens").alias("n_tokens")))


def exponent(shares: DataFrame, target_entropy: float | None, max_repeats: float | None) -> float:
    """The exponent a in [0, 1] of the weights share^a / sum, by bisection over the table of shares.

    target_entropy: the largest exponent whose weights have this entropy, as a fraction of the logarithm of the
    number of sources. max_repeats: the smallest exponent at which, while every source is passed over once, none
    is passed over more often than this.
    """
    if (target_entropy is None) == (max_repeats is None):
        raise ValueError("give a target entropy or a limit of repeats")
    low, high = 0.0, 1.0
    a = F.col("a")
    for _ in range(HALVINGS // 4):
        points = [low + (high - low) * k / 16 for k in range(1, 16)]
        spread = shares.withColumn("a", F.explode(F.array(*map(F.lit, points))))
        if target_entropy is not None:
            z, moment = F.sum(F.pow("share", a)), F.sum(F.pow("share", a) * F.log("share"))
            met = F.log(z) - a * moment / z >= target_entropy * F.log(F.count("*"))
        else:
            met = F.max(F.pow("share", a - 1)) <= max_repeats * F.min(F.pow("share", a - 1))
        held = {r["a"]: r["met"] for r in spread.groupBy("a").agg(met.alias("met")).collect()}
        if target_entropy is not None:  # true up to the exponent sought
            low = max([low, *(p for p in points if held.get(p))])
            high = min([high, *(p for p in points if not held.get(p))])
        else:  # true from the exponent sought on
            high = min([high, *(p for p in points if held.get(p))])
            low = max([low, *(p for p in points if not held.get(p))])
    return low if target_entropy is not None else high


def source_budgets(tokens: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None,
                   budget: int | None = None, cover: bool = False) -> DataFrame:
    """(source, n_docs, n_tokens, weight, quota) of each source; weights in millionths, quotas in tokens.

    The budget is shared out by weight. It is the number of tokens there are, unless given; with `cover` it is
    the smallest that passes over every source once.
    """
    sources = written(tokens.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")), "sources")
    total = sources.agg(F.sum("n_tokens")).first()[0] or 0
    shares = sources.withColumn("share", F.col("n_tokens") / F.lit(float(total or 1)))
    a = exponent(shares, target_entropy, max_repeats) if total else 1.0
    z = shares.agg(F.sum(F.pow("share", F.lit(a)))).first()[0] or 1.0
    weighted = shares.withColumn("weight", F.greatest(F.lit(1), F.round(F.pow("share", F.lit(a)) / z * WEIGHT_UNITS)).cast("bigint"))
    if cover:
        budget = weighted.agg(F.max(F.ceil(F.col("n_tokens").cast("decimal(38,0)") * WEIGHT_UNITS / F.col("weight")))).first()[0]
    budget = F.lit(Decimal(int(total if budget is None else budget))).cast("decimal(30,0)")
    quota = F.floor(budget * F.col("weight").cast("decimal(8,0)") / WEIGHT_UNITS).cast("bigint")
    if cover:
        quota = F.greatest(quota, "n_tokens")
    return weighted.select("source", "n_docs", "n_tokens", "weight", quota.alias("quota"))


def draws(tokens: DataFrame, budgets: DataFrame, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(source, epoch, block, doc_id, n_tokens, start): the documents drawn for each source's quota.

    An epoch is one permutation of a source, made of blocks that a hash of (seed, epoch, id) deals out, in hash
    order within a block. Full epochs come as often as the quota holds the source's tokens; the last one ends
    with the document that reaches the quota. `start` is the number of tokens before the document in its epoch.
    Running sums are taken within blocks, over the blocks of a super-block and over super-blocks, so no task
    holds a source.
    """
    plan = budgets.select(F.col("source").alias("own"), F.col("n_tokens").alias("all_tokens"), "quota",
                          F.ceil(F.col("n_docs") / block_rows).alias("blocks"))
    epochs = F.expr("sequence(0, cast(quota div all_tokens AS int))")
    placed = (tokens.join(plan, F.col("source").eqNullSafe(F.col("own"))).drop("own").withColumn("epoch", F.explode(epochs))
              .withColumn("h", keyed_hash(F.lit(seed), F.col("epoch"), F.col("doc_id")))
              .withColumn("block", F.expr("h % blocks")).withColumn("super", F.expr(f"block div {SUPER_BLOCKS}")))
    placed = placed.where("epoch < quota div all_tokens OR quota % all_tokens > 0")
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = placed.groupBy("source", "epoch", "super", "block").agg(F.sum("n_tokens").alias("n"))
    supers = blocks.groupBy("source", "epoch", "super").agg(F.sum("n").alias("n"))
    supers = supers.select("source", "epoch", "super", before(Window.partitionBy("source", "epoch").orderBy("super")).alias("super_start"))
    blocks = blocks.withColumn("block_start", before(Window.partitionBy("source", "epoch", "super").orderBy("block"))).drop("n")

    def same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        named = right.select(*(F.col(k).alias(f"_{k}") for k in keys), *(c for c in right.columns if c not in keys))
        on = [left[k].eqNullSafe(named[f"_{k}"]) for k in keys]
        return left.join(named, on).drop(*(f"_{k}" for k in keys))

    starts = same(blocks, supers, ["source", "epoch", "super"]).select("source", "epoch", "block", (F.col("block_start") + F.col("super_start")).alias("block_start"))
    in_block = Window.partitionBy("source", "epoch", "block").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    running = placed.withColumn("in_block", F.coalesce(F.sum("n_tokens").over(in_block), F.lit(0)))
    return (same(running, starts, ["source", "epoch", "block"])
            .withColumn("start", F.col("in_block") + F.col("block_start"))
            .where("epoch < quota div all_tokens OR start < quota % all_tokens")
            .select("source", "epoch", "block", "doc_id", "n_tokens", "start"))


def mix(docs: DataFrame, target_entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None,
        cover: bool = False, seed: int = 0) -> DataFrame:
    """The draws of docs for weights share^a / sum, with the exponent a bisected to the target.

    Documents without words take no part. A null source is a source of its own, a null id an id. Rows repeated
    with one id count as one document. Other columns are not read; an empty table gives no rows.
    """
    tokens = written(token_table(docs), "token-counts")
    return draws(tokens, source_budgets(tokens, target_entropy, max_repeats, budget, cover), seed)


def mixed_documents(docs: DataFrame, **target) -> DataFrame:
    """docs, all columns, each row as often as `mix` draws its id."""
    copies = mix(docs, **target).groupBy(F.col("doc_id").alias("drawn_id")).agg(F.count("*").cast("int").alias("drawn_copies"))
    return (docs.join(copies, F.col("doc_id").cast("bigint").eqNullSafe(F.col("drawn_id")))
            .withColumn("drawn_copies", F.explode(F.expr("sequence(1, drawn_copies)"))).select(*(docs[c] for c in docs.columns)))
