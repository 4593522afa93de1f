"""The same functions under SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession

from kinlink.functions.similarity import jaro_winkler

# SQL bodies; jaro_winkler is the Arrow UDF.
_SQL_FUNCTIONS = {
    "levenshtein_similarity": (
        "a STRING, b STRING",
        "CASE WHEN length(a) > 0 AND length(b) > 0 THEN "
        "1D - levenshtein(lower(a), lower(b)) / greatest(length(a), length(b)) ELSE 0D END",
    ),
    "date_similarity": (
        "a STRING, b STRING",
        "CASE WHEN NOT coalesce(length(a) > 0 AND length(b) > 0, false) THEN 0D "
        "WHEN a = b THEN 1D WHEN left(a, 7) = left(b, 7) THEN 0.8D "
        "WHEN left(a, 4) = left(b, 4) THEN 0.5D ELSE 0D END",
    ),
    "combined_similarity": (
        "a STRING, b STRING",
        "CASE WHEN NOT coalesce(length(a) > 0 AND length(b) > 0, false) THEN 0D "
        "WHEN lower(a) = lower(b) THEN 1D ELSE "
        "levenshtein_similarity(a, b) * 0.4D + jaro_winkler(lower(a), lower(b)) * 0.6D END",
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    """Make jaro_winkler, levenshtein_similarity, date_similarity, combined_similarity usable in SQL."""
    spark.udf.register("jaro_winkler", jaro_winkler)
    for name, (args, body) in _SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS DOUBLE RETURN {body}")
