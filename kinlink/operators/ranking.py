"""Deterministic top-k and latest-row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinlink.sources.scratch import written


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_per_group(df: DataFrame, group: list[str], k: int, *order: Column) -> DataFrame:
    """The first k rows per group. Spark keeps k per group before the shuffle already."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def best_matches(matches: DataFrame, k: int) -> DataFrame:
    """The k best matches per left record; the whole record is the group, as documents may repeat."""
    left = [c for c in matches.columns if c.endswith("_1")]
    tie = [F.col(c) for c in ("nr_documento_2", "nome_completo_2", "data_nascimento_2", "status_2")]
    return top_per_group(matches, left, k, F.desc("similarity_score"), *tie)


def sort_matches(matches: DataFrame) -> DataFrame:
    """A sort reads its rows twice, once for the ranges, so they are written first."""
    return written(matches, "matches").orderBy(F.desc("similarity_score"), "nr_documento_1", "nr_documento_2")
