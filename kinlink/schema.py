"""Column names and schemas shared by every stage."""

from __future__ import annotations

from pyspark.sql import types as T

NAME, BIRTH, DOC, STATUS = "nome_completo", "data_nascimento", "nr_documento", "status"
PERSON_COLUMNS = [NAME, BIRTH, DOC, STATUS]

# The domain of the status column.
STATUSES = ["Ativo", "Inativo", "Pendente", "Bloqueado"]

# Birth dates stay strings: the date score compares string prefixes.
PERSON_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in PERSON_COLUMNS])

MATCH_COLUMNS = [
    "nr_documento_1", "nome_completo_1", "data_nascimento_1", "status_1",
    "nr_documento_2", "nome_completo_2", "data_nascimento_2", "status_2",
    "similarity_score", "name_lev_score", "name_jaro_score", "date_score",
]

MATCH_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in MATCH_COLUMNS[:8]]
    + [T.StructField(c, T.DoubleType()) for c in MATCH_COLUMNS[8:]]
)

SERVED_SCHEMA = T.StructType([
    T.StructField("match_id", T.StringType()),
    T.StructField("nome_completo_1", T.StringType()),
    T.StructField("nome_completo_2", T.StringType()),
    T.StructField("data_nascimento_1", T.DateType()),
    T.StructField("data_nascimento_2", T.DateType()),
    T.StructField("nr_documento_1", T.StringType()),
    T.StructField("nr_documento_2", T.StringType()),
    T.StructField("similarity_score", T.DoubleType()),
    T.StructField("levenshtein_sim", T.DoubleType()),
    T.StructField("jaro_winkler_sim", T.DoubleType()),
    T.StructField("idade_1", T.IntegerType()),
    T.StructField("idade_2", T.IntegerType()),
    T.StructField("idade_diff", T.IntegerType()),
    T.StructField("indexed_at", T.TimestampType()),
])
SERVED_COLUMNS = SERVED_SCHEMA.fieldNames()

FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("last_modified", T.StringType()),
    T.StructField("etag", T.StringType()),
])
