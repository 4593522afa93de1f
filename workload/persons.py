"""Two person tables derived from `customer`, in Spark and in DuckDB SQL.

The supplied tables hold no people. Integer arithmetic on the customer key gives every customer a
name, birth date, document and status. Table A is every customer. Table B has as many rows: three
in ten are people of A with noise, the rest are others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Invented names, twenty of each; some have the letters that phonetic codes treat apart (H, W, Pf, shcr).
FIRST = ("Adovir Belmina Cardelo Dulvira Enastor Filomar Gundelo Hermira Ilvano Jocasta Kelmiro Ludonia "
         "Marsilo Nerissa Ofelmo Pradina Quintelo Rosmira Wandelmo Zulmar").split()
LAST = ("Ashcroft Bordalvo Cintrago Drumelo Estrevano Fargundes Galvaneto Hortelano Ibarruna Jaquemino "
        "Lobrando Mirandolo Norvaes Ostermano Pfistermo Quentalo Ravasco Salgarelo Tibaldo Wolfrano").split()
STATUS = ["Ativo", "Inativo", "Pendente", "Bloqueado"]
OTHER = 1000003   # key offset of the people of B that are not in A


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(words: list[str], index: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), index.cast("int"))


def _div(k: Column, n: int) -> Column:
    return F.floor(k / F.lit(n)).cast("long")


def _person_parts(k: Column) -> dict[str, Column]:
    return {
        "first": _pick(FIRST, (k * 31) % 20),
        "middle": _pick(LAST, (_div(k, 20) * 17 + k % 3) % 20),
        "last": _pick(LAST, (_div(k, 400) * 13 + k % 7) % 20),
        "birth": F.date_add(F.lit("1950-01-01").cast("date"), ((k * 7919) % 20453).cast("int")),
        "doc": F.lpad(((k * 104729 + 12345) % 100000000000).cast("string"), 11, "0"),
        "stat": _pick(STATUS, k % 4),
    }


def _finish(df: DataFrame, name: Column, birth: Column) -> DataFrame:
    return df.select(
        name.alias("nome_completo"), birth.alias("data_nascimento"),
        F.col("doc").alias("nr_documento"), F.col("stat").alias("status"),
    )


def _full_name(first="first", middle="middle", last="last") -> Column:
    return F.concat_ws(" ", F.col(first), F.col(middle), F.col(last))


def persons_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = _person_parts(F.col("c_custkey"))
    df = read(spark, sf_dir, "customer").select(*[c.alias(n) for n, c in parts.items()])
    return _finish(df, _full_name(), F.date_format("birth", "yyyy-MM-dd"))


def persons_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    shared = k % 10 < 3
    df = read(spark, sf_dir, "customer").select(
        k.alias("k"), shared.alias("shared"), F.when(shared, k).otherwise(k + OTHER).alias("p")
    )
    df = df.select("k", "shared", *[c.alias(n) for n, c in _person_parts(F.col("p")).items()])
    k = F.col("k")
    noisy_name = F.col("shared") & (_div(k, 10) % 10 < 3)
    kind = _div(k, 100) % 3
    typo = F.concat(F.substring("first", 1, 1), F.lit("z"), F.substr("first", F.lit(3)))
    name = (
        F.when(noisy_name & (kind == 0), F.concat_ws(" ", typo, F.col("middle"), F.col("last")))
        .when(noisy_name & (kind == 1), F.concat_ws(
            " ", F.col("first"), F.concat(F.substring("middle", 1, 1), F.lit(".")), F.col("last")))
        .when(noisy_name, _full_name(middle="last", last="middle"))
        .otherwise(_full_name())
    )
    noisy_date = F.col("shared") & ((k * 7) % 20 < 3)
    year, month, day = F.date_format("birth", "yyyy"), F.month("birth"), F.dayofmonth("birth")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    by_day = F.concat_ws("-", year, two(month), two(F.least(day + 1, F.lit(28))))
    by_month = F.concat_ws("-", year, two(F.least(month + 1, F.lit(12))), two(day))
    birth = (
        F.when(noisy_date & (k % 2 == 0), by_day).when(noisy_date, by_month)
        .otherwise(F.date_format("birth", "yyyy-MM-dd"))
    )
    return _finish(df, name, birth)


def with_gaps(df: DataFrame) -> DataFrame:
    """The same rows with missing values, decided by the document number."""
    d = F.col("nr_documento").cast("long")
    gap = d % 50 == 0
    return df.select(
        F.when(~gap, F.col("nome_completo")).alias("nome_completo"),
        F.when(~gap, F.col("data_nascimento")).alias("data_nascimento"),
        F.when(d % 11 != 0, F.col("nr_documento")).alias("nr_documento"),
        "status",
    )


# --- the same in DuckDB SQL -------------------------------------------------------------------

def _list(words: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _parts_sql(p: str) -> str:
    return f"""
    {_list(FIRST)}[(({p}) * 31) % 20 + 1] AS first,
    {_list(LAST)}[((({p}) // 20) * 17 + ({p}) % 3) % 20 + 1] AS middle,
    {_list(LAST)}[((({p}) // 400) * 13 + ({p}) % 7) % 20 + 1] AS last,
    DATE '1950-01-01' + CAST((({p}) * 7919) % 20453 AS INTEGER) AS birth,
    lpad(CAST((({p}) * 104729 + 12345) % 100000000000 AS VARCHAR), 11, '0') AS doc,
    {_list(STATUS)}[({p}) % 4 + 1] AS stat"""


PERSONS_SQL = f"""
pa AS (SELECT {_parts_sql("c_custkey")} FROM customer),
a AS (SELECT first || ' ' || middle || ' ' || last AS nome_completo,
        strftime(birth, '%Y-%m-%d') AS data_nascimento, doc AS nr_documento, stat AS status FROM pa),
pk AS (SELECT c_custkey AS k, c_custkey % 10 < 3 AS shared,
        CASE WHEN c_custkey % 10 < 3 THEN c_custkey ELSE c_custkey + {OTHER} END AS p FROM customer),
pb AS (SELECT k, shared, {_parts_sql("p")} FROM pk),
b AS (SELECT
    CASE WHEN shared AND (k // 10) % 10 < 3 AND (k // 100) % 3 = 0
           THEN substr(first, 1, 1) || 'z' || substr(first, 3) || ' ' || middle || ' ' || last
         WHEN shared AND (k // 10) % 10 < 3 AND (k // 100) % 3 = 1
           THEN first || ' ' || substr(middle, 1, 1) || '. ' || last
         WHEN shared AND (k // 10) % 10 < 3 THEN first || ' ' || last || ' ' || middle
         ELSE first || ' ' || middle || ' ' || last END AS nome_completo,
    CASE WHEN shared AND (k * 7) % 20 < 3 AND k % 2 = 0
           THEN strftime(birth, '%Y-%m-') || lpad(CAST(least(day(birth) + 1, 28) AS VARCHAR), 2, '0')
         WHEN shared AND (k * 7) % 20 < 3
           THEN strftime(birth, '%Y-') || lpad(CAST(least(month(birth) + 1, 12) AS VARCHAR), 2, '0')
                || strftime(birth, '-%d')
         ELSE strftime(birth, '%Y-%m-%d') END AS data_nascimento,
    doc AS nr_documento, stat AS status FROM pb)"""


def gaps_sql(source: str, target: str) -> str:
    return f"""{target} AS (SELECT
    CASE WHEN CAST(nr_documento AS BIGINT) % 50 <> 0 THEN nome_completo END AS nome_completo,
    CASE WHEN CAST(nr_documento AS BIGINT) % 50 <> 0 THEN data_nascimento END AS data_nascimento,
    CASE WHEN CAST(nr_documento AS BIGINT) % 11 <> 0 THEN nr_documento END AS nr_documento,
    status FROM {source})"""
