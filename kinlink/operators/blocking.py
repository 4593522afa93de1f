"""Blocking keys and what they cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinlink.functions.people import phonetic_code
from kinlink.functions.text import fold_accents
from kinlink.schema import BIRTH, NAME


def prefix_key(name: Column, birth: Column, normalize: bool = False) -> Column:
    """First three characters of the name and the birth year; NULL parts are skipped."""
    name = F.upper(fold_accents(name)) if normalize else name
    return F.concat_ws("_", F.substring(name, 1, 3), F.substring(birth, 1, 4))


def phonetic_key(name: Column, birth: Column, normalize: bool = False) -> Column:
    """Soundex of the name and the birth year and month; NULL parts are skipped."""
    code = phonetic_code(name) if normalize else F.soundex(name)
    return F.concat_ws("_", code, F.substring(birth, 1, 7))


def year_prefix_key(name: Column, birth: Column, normalize: bool = False) -> Column:
    """Two levels at once: birth year, then first letter."""
    name = F.upper(fold_accents(name)) if normalize else name
    return F.concat_ws("_", F.substring(birth, 1, 4), F.substring(name, 1, 1))


# Block name -> (key function, evidence attributes that already agree inside a block).
BLOCKS = {
    "prefix": (prefix_key, {"year"}),
    "phonetic": (phonetic_key, {"code", "month", "year"}),
    "year_prefix": (year_prefix_key, {"year"}),
}


def add_blocking_key(df: DataFrame, block: str = "prefix", normalize: bool = False,
                     output: str = "blocking_key") -> DataFrame:
    return df.withColumn(output, BLOCKS[block][0](F.col(NAME), F.col(BIRTH), normalize))


def distinct_block_keys(df: DataFrame, key: str = "blocking_key") -> DataFrame:
    return df.select(key).distinct()


def block_skew_report(a: DataFrame, b: DataFrame, key: str = "blocking_key", top: int = 20) -> DataFrame:
    """Rows per side and pairs of the blocks with the most pairs; the empty key shows as ''."""
    one, zero = F.lit(1), F.lit(0)
    sides = a.select(key, one.alias("l"), zero.alias("r")).unionByName(
        b.select(key, zero.alias("l"), one.alias("r"))
    )
    return (
        sides.groupBy(key)
        .agg(F.sum("l").cast("long").alias("n1"), F.sum("r").cast("long").alias("n2"))
        .withColumn("pairs", F.col("n1") * F.col("n2"))
        .orderBy(F.desc("pairs"), F.desc("n1"), key)
        .limit(top)
    )


def partition_row_counts(df: DataFrame) -> DataFrame:
    """Rows per partition, to see whether a repartition is worth it."""
    return df.groupBy(F.spark_partition_id().alias("partition_id")).agg(F.count("*").alias("rows"))
