"""From matches to the served match table."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from kinlink.functions.people import age_on, match_id, parse_date
from kinlink.operators.ranking import top_per_group
from kinlink.operators.scoring import MatchConfig
from kinlink.plans.match import incremental_match, match
from kinlink.schema import DOC, PERSON_COLUMNS, SERVED_COLUMNS, SERVED_SCHEMA
from kinlink.sources.scratch import written
from kinlink.sources.tables import is_missing

LOAD = "load_seq"


def first_present(df: DataFrame, names: list[str], default) -> Column:
    """The first of these columns that the table has, else a default."""
    found = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*found, F.lit(default)) if found else F.lit(default)


def served_documents(matches: DataFrame, as_of: date, indexed_at: datetime | None = None,
                     optional: tuple[str, ...] = ()) -> DataFrame:
    """One document per match: scores under served names, ages at `as_of`, id, time stamp.

    `optional` may name further match columns to keep, such as status_1 or date_score.
    """
    day = F.lit(as_of)
    born = {n: parse_date(F.col(f"data_nascimento_{n}")) for n in (1, 2)}
    stamp = F.lit(indexed_at).cast("timestamp") if indexed_at else F.current_timestamp()
    docs = matches.select(
        match_id(F.col("nr_documento_1"), F.col("nr_documento_2")).alias("match_id"),
        "nome_completo_1", "nome_completo_2",
        born[1].alias("data_nascimento_1"), born[2].alias("data_nascimento_2"),
        "nr_documento_1", "nr_documento_2", "similarity_score",
        first_present(matches, ["name_lev_score", "levenshtein_sim"], 0.0).alias("levenshtein_sim"),
        first_present(matches, ["name_jaro_score", "jaro_winkler_sim"], 0.0).alias("jaro_winkler_sim"),
        age_on(born[1], day).alias("idade_1"), age_on(born[2], day).alias("idade_2"),
        stamp.alias("indexed_at"), *optional,
    )
    gap = F.abs(F.col("idade_1") - F.col("idade_2")).alias("idade_diff")
    return docs.select("*", gap).select(*SERVED_COLUMNS, *optional)


def _content_order(df: DataFrame) -> list[Column]:
    """Order of rows with one id: best score first, then the content, so the winner is fixed."""
    rest = [c for c in df.columns if c not in ("similarity_score", "match_id", LOAD)]
    return [F.desc("similarity_score")] + [F.col(c) for c in rest]


def one_per_id(docs: DataFrame) -> DataFrame:
    """Rows with the same id replace each other; a later load wins, then the higher score.

    The documents make up the id. Naming them as keys as well lets a search by document reach the
    scan below, before rows are compared.
    """
    rows = docs.where(F.col("match_id").isNotNull())
    later = [F.desc(LOAD)] if LOAD in docs.columns else []
    keys = ["match_id", "nr_documento_1", "nr_documento_2"]
    return top_per_group(rows, keys, 1, *later, *_content_order(docs))


def _repeated(persons: DataFrame) -> DataFrame:
    """The documents of several rows."""
    counts = persons.where(F.col(DOC).isNotNull()).groupBy(DOC).agg(F.count("*").alias("n"))
    return written(counts.where("n > 1").select(DOC), "repeated")


def served_matches(a: DataFrame, b: DataFrame, as_of: date, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """`one_per_id` of the documents of all matches of two tables.

    Two matches have one id only where a document stands in several rows of its table. Matches of other rows, which are
    nearly all, are passed on without being shuffled and sorted; those of these rows are compared. Every pair of rows is matched
    once, in one part or the other. A limit per left record needs all its matches together, so nothing is parted then.
    """
    if cfg.max_matches is not None:
        return one_per_id(served_documents(match(a, b, cfg), as_of))
    parts = [_repeated(df) for df in (a, b)]
    if all(p.isEmpty() for p in parts):
        docs = served_documents(match(a, b, cfg), as_of)
        return docs.where(F.col("match_id").isNotNull())
    several = [written(df.join(p, DOC, "left_semi").select(*PERSON_COLUMNS), "several") for df, p in zip((a, b), parts)]
    single = [df.join(p, DOC, "left_anti").select(*PERSON_COLUMNS) for df, p in zip((a, b), parts)]
    alone = served_documents(match(*single, cfg), as_of)
    compared = served_documents(incremental_match(single[0], several[0], single[1], several[1], cfg), as_of)
    return alone.where(F.col("match_id").isNotNull()).unionByName(one_per_id(compared))


def rejected(docs: DataFrame) -> DataFrame:
    """Documents without an id, which the table cannot hold."""
    return docs.where(F.col("match_id").isNull())


def load_served(docs: DataFrame, path: str, mode: str = "overwrite", batch_size: int = 10000,
                load_seq: int = 0) -> tuple[int, int]:
    """Writes a load of documents and returns (written, rejected).

    `overwrite` drops what the table held, `append` adds a load whose rows replace those of
    earlier loads with the same id when the table is read. Rows without an id are counted and
    written next to the table. Bloom filters on the documents let a lookup skip row groups.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    target = f"{path}/{LOAD}={load_seq}"
    if mode == "append" and not is_missing(docs.sparkSession, target):
        raise ValueError(f"load {load_seq} is in the table already")
    docs = written(docs, "load")   # rows to keep and rows to reject come from one run of the source
    out = one_per_id(docs).withColumn(LOAD, F.lit(load_seq))
    (
        out.write.mode(mode).partitionBy(LOAD)
        .option("maxRecordsPerFile", batch_size)
        .option("parquet.bloom.filter.enabled#nr_documento_1", "true")
        .option("parquet.bloom.filter.enabled#nr_documento_2", "true")
        .parquet(path)
    )
    bad = f"{path}_rejected/{LOAD}={load_seq}"
    rejected(docs).write.mode("overwrite").parquet(bad)
    read = docs.sparkSession.read
    # Both counts come from the footers of what was written. A load of no rows leaves no folder of its own.
    kept = read.schema(out.schema).parquet(path).where(F.col(LOAD) == load_seq)
    return kept.count(), read.schema(docs.schema).parquet(bad).count()


def several_loads(table: DataFrame) -> bool:
    return table.select(LOAD).distinct().limit(2).count() > 1


def read_served(spark: SparkSession, path: str) -> DataFrame:
    """The table as searches see it: one row per id."""
    load = StructField(LOAD, IntegerType())
    rows = spark.read.schema(StructType([*SERVED_SCHEMA.fields, load])).parquet(path)
    if several_loads(rows):
        rows = one_per_id(rows)
    return rows.select(*SERVED_COLUMNS)


def compact_served(spark: SparkSession, path: str, target: str, load_seq: int = 0) -> tuple[int, int]:
    """Writes the current rows as a single load to another path, so that reads compare nothing."""
    return load_served(read_served(spark, path), target, "overwrite", load_seq=load_seq)


def empty_served(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SERVED_SCHEMA)
