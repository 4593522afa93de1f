"""Data quality of a person table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kinlink.functions.people import cpf_is_valid, parse_date
from kinlink.schema import BIRTH, DOC, NAME, PERSON_COLUMNS, STATUS, STATUSES


def person_quality_profile(persons: DataFrame) -> DataFrame:
    """One row per measure: missing values, bad dates and documents, unknown status, repeats."""
    measures = {"rows": F.count("*")}
    for c in PERSON_COLUMNS:
        measures[f"{c}_null"] = F.count_if(F.col(c).isNull())
        measures[f"{c}_empty"] = F.count_if(F.col(c) == "")
    measures["birth_date_invalid"] = F.count_if((F.length(BIRTH) > 0) & parse_date(F.col(BIRTH)).isNull())
    measures["document_invalid"] = F.count_if((F.length(DOC) > 0) & ~cpf_is_valid(F.col(DOC)))
    measures["status_unknown"] = F.count_if((F.length(STATUS) > 0) & ~F.col(STATUS).isin(STATUSES))
    rows = persons.agg(*[m.alias(n) for n, m in measures.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in measures])
    flat = rows.select(F.explode(pairs).alias("p")).select("p.*")
    repeats = (
        persons.where(F.length(DOC) > 0).groupBy(DOC).agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("value"))
        .select(F.lit("document_repeated").alias("measure"), "value")
    )
    return flat.unionByName(repeats)


def cpf_validation(persons: DataFrame) -> DataFrame:
    return persons.select(NAME, DOC, cpf_is_valid(F.col(DOC)).alias("cpf_valid"))
