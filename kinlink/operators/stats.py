"""Statistics over matches and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def match_stats(served: DataFrame) -> DataFrame:
    """Average, maximum and minimum score, and the usual statistics of the age difference."""
    return served.agg(
        F.avg("similarity_score").alias("avg_similarity"),
        F.max("similarity_score").alias("max_similarity"),
        F.min("similarity_score").alias("min_similarity"),
        F.count("idade_diff").alias("age_diff_count"),
        F.min("idade_diff").alias("age_diff_min"),
        F.max("idade_diff").alias("age_diff_max"),
        F.avg("idade_diff").alias("age_diff_avg"),
        F.sum("idade_diff").alias("age_diff_sum"),
    )


def score_bucket(score: Column) -> Column:
    """Tenths; rounding first keeps 0.7 in [0.7, 0.8). Only just below a tenth, or on it, can rounding matter; it is slow."""
    tenths = score * 10
    return F.when(F.ceil(tenths) - tenths > 1e-8, F.floor(tenths)).otherwise(F.floor(F.round(tenths, 9))).cast("int")


def score_histogram(matches: DataFrame) -> DataFrame:
    """Matches per tenth of score, empty tenths between the first and the last included.

    Scores lie in [0, 1], so the counts are at most eleven rows and fit one map.
    """
    counts = matches.where(F.col("similarity_score").isNotNull()).groupBy(
        score_bucket(F.col("similarity_score")).alias("b")
    ).agg(F.count("*").alias("n"))
    whole = counts.agg(
        F.map_from_entries(F.collect_list(F.struct("b", "n"))).alias("m"),
        F.min("b").alias("lo"), F.max("b").alias("hi"),
    ).where(F.col("lo").isNotNull())
    every = whole.select("m", F.explode(F.sequence("lo", "hi")).alias("b"))
    return every.select(
        (F.col("b") / 10).alias("bucket"),
        F.coalesce(F.try_element_at("m", F.col("b")), F.lit(0)).cast("long").alias("matches"),
    )


def run_report(elapsed_seconds: float, matches: DataFrame) -> DataFrame:
    """Matches, seconds and whole matches per second of a run, over its whole output."""
    seconds = max(int(elapsed_seconds), 1)
    return matches.agg(F.count("*").alias("matches")).select(
        "matches", F.lit(int(elapsed_seconds)).alias("seconds"),
        F.floor(F.col("matches") / seconds).cast("long").alias("matches_per_second"),
    )


def run_counts(a: DataFrame, b: DataFrame, candidates: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows of both inputs, candidate pairs and matches, one row per measure.

    `candidates` is one row with their number, as `candidate_count` gives it.
    """
    parts = [("rows_1", a), ("rows_2", b), ("candidates", candidates), ("matches", matches)]
    number = lambda m: F.max("candidates") if m == "candidates" else F.count("*")
    counted = [df.agg(number(m).alias("n")).select(F.lit(m).alias("measure"), "n") for m, df in parts]
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out


def pair_quality(
    a: DataFrame, b: DataFrame, matches: DataFrame, thresholds: list[float],
    candidates: DataFrame, doc: str = "nr_documento",
) -> DataFrame:
    """Per threshold: true and false positives, misses, precision, recall; and the pair reduction.

    Truth is equality of documents. `matches` must go down to the lowest threshold. `candidates` is
    one row with their number, as `candidate_count` gives it.
    """
    def docs(df, n):
        return df.where(F.col(doc).isNotNull()).groupBy(F.col(doc).alias("d")).agg(F.count("*").alias(n))

    truth = docs(a, "n1").join(docs(b, "n2"), "d").agg(
        F.coalesce(F.sum(F.col("n1") * F.col("n2")), F.lit(0)).alias("true_pairs")
    )
    same = F.col("nr_documento_1") == F.col("nr_documento_2")
    sums = []
    for i, t in enumerate(thresholds):
        hit = F.col("similarity_score") >= t
        sums += [F.count_if(hit & same).alias(f"tp{i}"), F.count_if(hit & ~same).alias(f"fp{i}")]
    totals = [a.agg(F.count("*").alias("rows_1")), b.agg(F.count("*").alias("rows_2")),
              candidates.select("candidates"), truth, matches.agg(*sums)]
    # Five single rows, put into one.
    stacked = totals[0]
    for total in totals[1:]:
        stacked = stacked.unionByName(total, allowMissingColumns=True)
    one = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    per = F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
        for i, t in enumerate(thresholds)
    ])).alias("p")
    rows = one.select("rows_1", "rows_2", "candidates", "true_pairs", per).select("*", "p.*")
    tp, fp = F.col("tp"), F.col("fp")
    return rows.select(
        "threshold", "tp", "fp", (F.col("true_pairs") - tp).alias("fn"),
        F.when(tp + fp > 0, F.round(tp / (tp + fp), 9)).alias("precision"),
        F.when(F.col("true_pairs") > 0, F.round(tp / F.col("true_pairs"), 9)).alias("recall"),
        F.round(
            1 - F.col("candidates") / (F.col("rows_1").cast("double") * F.col("rows_2")), 9
        ).alias("reduction"),
    )
