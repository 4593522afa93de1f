"""Choice of a threshold: precision and recall at every score, and scores calibrated to probabilities."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from kinlink.sources.scratch import written


def _in_ranges(counts: DataFrame, by: str) -> DataFrame:
    """Rows with `part`, the range of `by` they lie in, larger parts higher; written once, as ranges are drawn by sampling."""
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(counts.repartitionByRange(parts, by).withColumn("part", F.spark_partition_id()), "ranges")


def threshold_curve(pairs: DataFrame, true_pairs: DataFrame, is_true: str = "nr_documento_1 = nr_documento_2") -> DataFrame:
    """(threshold, tp, fp, fn, precision, recall) at every distinct score, as if pairs from that score on were matches.

    `true_pairs` is one row with the number of all true pairs. Rows are counted by score before they move; running
    sums are taken inside ranges of scores, to which the totals of the higher ranges are added, one row a range, so no
    task sees all scores. Pairs without a score take no part; a pair whose truth is null counts as false. Recall is
    null without true pairs; an empty table gives no rows.
    """
    good = F.coalesce(F.expr(is_true), F.lit(False))
    counts = (pairs.where("similarity_score IS NOT NULL").groupBy(F.col("similarity_score").alias("threshold"))
              .agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad")))
    placed = _in_ranges(counts, "threshold")
    higher = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)  # over one row a range
    above = (placed.groupBy("part").agg(F.sum("good").alias("g"), F.sum("bad").alias("b"))
             .select("part", F.coalesce(F.sum("g").over(higher), F.lit(0)).alias("good_above"), F.coalesce(F.sum("b").over(higher), F.lit(0)).alias("bad_above")))
    within = Window.partitionBy("part").orderBy(F.desc("threshold")).rowsBetween(Window.unboundedPreceding, 0)
    truth = true_pairs.toDF("true_pairs").agg(F.max("true_pairs").alias("true_pairs"))
    summed = (placed.withColumn("tp", F.sum("good").over(within)).withColumn("fp", F.sum("bad").over(within))
              .join(F.broadcast(above), "part").withColumn("tp", F.col("tp") + F.col("good_above")).withColumn("fp", F.col("fp") + F.col("bad_above"))
              .join(F.broadcast(truth)))  # a single row
    return summed.select(
        "threshold", "tp", "fp", (F.col("true_pairs") - F.col("tp")).alias("fn"),
        F.round(F.col("tp") / (F.col("tp") + F.col("fp")), 9).alias("precision"),
        F.when(F.col("true_pairs") > 0, F.round(F.col("tp") / F.col("true_pairs"), 9)).alias("recall"))


def pooled(good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """First place of the block of each place after pooling adjacent violators: shares good / n of blocks rise strictly."""
    first, sums = [], []
    for i, (g, m) in enumerate(zip(good.tolist(), n.tolist())):
        own = i
        while sums and sums[-1][0] * m >= g * sums[-1][1]:
            g, m = g + sums[-1][0], m + sums[-1][1]
            sums.pop()
            own = first.pop()
        first.append(own)
        sums.append((g, m))
    return np.repeat(np.array(first, np.int64), np.diff([*first, len(good)]))


def calibration(pairs: DataFrame, digits: int = 4, is_true: str = "nr_documento_1 = nr_documento_2") -> DataFrame:
    """(bin, n, probability): isotonic regression of truth on scores cut to `digits` digits; bin is floor(score * 10^digits).

    Adjacent violators are pooled inside each range of bins, then the blocks of all ranges, at most 10^digits + 1
    whatever the number of pairs. Pairs without a score take no part; a pair whose truth is null counts as false; an
    empty table gives no rows.
    """
    good = F.coalesce(F.expr(is_true), F.lit(False))
    counts = (pairs.where("similarity_score IS NOT NULL").groupBy(F.floor(F.col("similarity_score") * 10**digits).cast("bigint").alias("bin"))
              .agg(F.count_if(good).alias("good"), F.count("*").alias("n")))

    def inside(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("bin", ignore_index=True)
        block = pooled(rows["good"].to_numpy(), rows["n"].to_numpy())
        return rows.assign(block=rows["bin"].to_numpy()[block])[["bin", "good", "n", "block"]]

    def across(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("block", ignore_index=True)
        block = pooled(rows["good"].to_numpy(), rows["n"].to_numpy())
        sums = rows.groupby(block)[["good", "n"]].transform("sum")
        return pd.DataFrame({"block": rows["block"], "probability": sums["good"] / sums["n"]})

    local = written(_in_ranges(counts, "bin").groupBy("part").applyInPandas(inside, "bin bigint, good bigint, n bigint, block bigint"), "blocks")
    blocks = local.groupBy("block").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    merged = blocks.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(across, "block bigint, probability double")
    return local.join(merged, "block").select("bin", "n", F.round("probability", 9).alias("probability"))


def calibrated(pairs: DataFrame, bins: DataFrame, digits: int = 4) -> DataFrame:
    """`pairs` with `probability` of their score's bin; null where the bin had no pairs. All columns and rows stay."""
    own = F.floor(F.col("similarity_score") * 10**digits).cast("bigint")
    known = bins.select(F.col("bin").alias("_bin"), "probability")
    return pairs.join(known, own == F.col("_bin"), "left").drop("_bin")
