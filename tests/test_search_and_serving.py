from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from kinlink.functions import combined_similarity
from kinlink.operators import search, stats
from kinlink.operators.pairing import SkewConfig
from kinlink.operators.scoring import MatchConfig
from kinlink.plans import serve
from kinlink.plans.match import match
from kinlink.schema import MATCH_SCHEMA, SERVED_SCHEMA
from tests.conftest import rows

AS_OF = date(2025, 6, 30)


@pytest.fixture(scope="module")
def matches(spark, persons):
    return spark.createDataFrame(match(*persons, MatchConfig(threshold=0.5)).collect(), MATCH_SCHEMA)


@pytest.fixture(scope="module")
def served(spark, matches):
    docs = serve.one_per_id(serve.served_documents(matches, AS_OF, datetime(2025, 7, 1)))
    return spark.createDataFrame(docs.collect(), SERVED_SCHEMA)


def match_row(spark, *changes):
    base = dict(zip(MATCH_SCHEMA.fieldNames(), [
        "1", "Maria Souza Lima", "1985-03-15", "Ativo", "2", "Mario Souza Lima", "1985-03-15", "Ativo", 0.9, 0.8, 0.7, 1.0]))
    return spark.createDataFrame([tuple({**base, **c}.values()) for c in changes or ({},)], MATCH_SCHEMA)


def test_similar_names_without_blocking_equals_scoring_all(persons):
    a, _ = persons
    score = combined_similarity(F.lit("Maria Silva"), F.col("nome_completo"))
    every = a.withColumn("similarity", score).where("similarity >= 0.5").orderBy(F.desc("similarity"), "nr_documento")
    got = search.search_similar_names(a, "Maria Silva", use_blocking=False)
    assert [r["nr_documento"] for r in got.collect()] == [r["nr_documento"] for r in every.limit(10).collect()]


def test_similar_names_blocking_and_exact_hit(persons):
    a, _ = persons
    name = a.first()["nome_completo"]
    got = search.search_similar_names(a, name.upper()).collect()
    assert got[0]["nome_completo"] == name and got[0]["similarity"] == 1.0


def test_similar_names_of_null_rows(make):
    assert search.search_similar_names(make((None, None, None, None)), "Ana", use_blocking=False).count() == 0


def test_name_search_in_matches_prefers_side_one_on_ties(spark):
    df = match_row(spark, {"nome_completo_2": "Maria Souza Lima"})
    got = search.search_in_matches(df, "Maria Souza Lima").first()
    assert got["best_similarity"] == 1.0 and got["matched_name"] == "Maria Souza Lima"
    df = match_row(spark, {"nome_completo_1": None})
    got = search.search_in_matches(df, "Mario Souza Lima").first()
    assert got["matched_name"] == "Mario Souza Lima" and got["other_name"] is None


@pytest.mark.parametrize("strategy", ["auto", "salted"])
def test_batch_equals_single_searches(persons, spark, strategy):
    a, b = persons
    asked = b.limit(8).selectExpr("nr_documento AS query_id", "nome_completo AS query_name")
    batch = search.search_names_batch(asked, a, top=3, strategy=strategy, skew=SkewConfig(pair_budget=5, slice_rows=2))
    for q in asked.collect():
        one = search.search_similar_names(a, q["query_name"], top=3)
        assert rows(one) == rows(batch.where(F.col("query_id") == q["query_id"]).select(*one.columns))


def test_document_batch_equals_single_searches(served, spark):
    docs = [r[0] for r in served.select("nr_documento_2").limit(5).collect()]
    asked = spark.createDataFrame([(d,) for d in docs] + [(docs[0],), (None,)], "document string")
    batch = search.search_documents_batch(asked, served)
    for d in set(docs):
        one = search.search_by_document(served, d)
        assert rows(one) == rows(batch.where(F.col("document") == d).select(*one.columns))


def test_document_on_both_sides_is_found_once(spark):
    df = serve.served_documents(match_row(spark, {"nr_documento_2": "1"}), AS_OF)
    assert search.search_by_document(df, "1").count() == 1
    assert search.search_documents_batch(spark.createDataFrame([("1",)], "document string"), df).count() == 1


def test_fuzzy_phrase_and_folding(spark):
    df = serve.served_documents(match_row(spark, {"nome_completo_1": "João Conceição"}), AS_OF)
    assert search.search_by_name(df, "joao").count() == 1
    assert search.search_by_name(df, "joao", fold=False).count() == 1      # one edit
    assert search.search_by_name(df, "conceicao", fuzzy=False).count() == 1
    assert search.search_by_name(df, "conceicao", fuzzy=False, fold=False).count() == 0
    assert search.search_by_name(df, "conceicao joao", fuzzy=False).count() == 0
    assert search.search_by_name(df, "...").count() == 0


def test_zero_bounds_are_bounds(served):
    assert search.search_high_quality(served, 0.0, 10**6).count() == served.count()
    assert search.search_by_age_range(served, 0, 200, 10**6).count() == served.count()


def test_sorted_with_fixed_ties(served):
    got = [(-r["similarity_score"], r["match_id"]) for r in search.search_high_quality(served, 0.5, 50).collect()]
    assert got == sorted(got)


def test_served_document(spark):
    got = serve.served_documents(match_row(spark, {"data_nascimento_2": "1985-02-30"}), AS_OF).first()
    assert got["match_id"] == "1_2" and got["idade_1"] == 40 and got["idade_2"] == 0 and got["idade_diff"] == 40
    assert got["data_nascimento_2"] is None and got["levenshtein_sim"] == 0.8 and got["jaro_winkler_sim"] == 0.7


def test_score_columns_under_other_names_or_missing(spark):
    df = match_row(spark).withColumnRenamed("name_lev_score", "levenshtein_sim").drop("name_jaro_score")
    got = serve.served_documents(df, AS_OF).first()
    assert got["levenshtein_sim"] == 0.8 and got["jaro_winkler_sim"] == 0.0


def test_load_replace_append_and_reject(spark, folder):
    low = serve.served_documents(match_row(spark, {"similarity_score": 0.7}, {"similarity_score": 0.8}, {"nr_documento_1": None}), AS_OF)
    assert serve.load_served(low, f"{folder}/t", "overwrite", load_seq=1) == (1, 1)
    assert serve.read_served(spark, f"{folder}/t").first()["similarity_score"] == 0.8
    later = serve.served_documents(match_row(spark, {"similarity_score": 0.6}, {"nr_documento_1": "9"}), AS_OF)
    assert serve.load_served(later, f"{folder}/t", "append", load_seq=2) == (2, 0)
    got = {r["match_id"]: r["similarity_score"] for r in serve.read_served(spark, f"{folder}/t").collect()}
    assert got == {"1_2": 0.6, "9_2": 0.9}
    with pytest.raises(ValueError):
        serve.load_served(later, f"{folder}/t", "append", load_seq=2)
    found = search.search_by_document(serve.read_served(spark, f"{folder}/t"), "1")
    pushed = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(EqualTo(nr_documento_1,1),EqualTo(nr_documento_2,1))" in pushed.replace("IsNotNull(match_id), ", "")
    assert serve.compact_served(spark, f"{folder}/t", f"{folder}/u") == (2, 0)
    assert rows(serve.read_served(spark, f"{folder}/u")) == rows(serve.read_served(spark, f"{folder}/t"))
    assert serve.load_served(later, f"{folder}/t", "overwrite", load_seq=3) == (2, 0)
    assert serve.read_served(spark, f"{folder}/t").count() == 2


def test_histogram(spark):
    scores = [0.7, 0.7, 0.79999999999, 0.95, 1.0]
    df = match_row(spark, *[{"similarity_score": s} for s in scores])
    got = {r["bucket"]: r["matches"] for r in stats.score_histogram(df).collect()}
    assert got == {0.7: 2, 0.8: 1, 0.9: 1, 1.0: 1}
    gap = match_row(spark, {"similarity_score": 0.71}, {"similarity_score": 0.95})
    assert [r["matches"] for r in stats.score_histogram(gap).orderBy("bucket").collect()] == [1, 0, 1]
    assert stats.score_histogram(df.limit(0)).count() == 0


def test_stats_and_report(served):
    got = stats.match_stats(served).first()
    assert got["age_diff_count"] == served.count() and got["min_similarity"] <= got["avg_similarity"] <= got["max_similarity"]
    report = stats.run_report(2.9, served).first()
    assert report["seconds"] == 2 and report["matches_per_second"] == served.count() // 2


def test_total_hits_counts_without_a_limit(served):
    total = search.total_hits(search.quality_hits(served, 0.8))
    plan = total._jdf.queryExecution().toString()
    assert "Limit" not in plan and "Sort" not in plan and "rangepartitioning" not in plan
    assert total.first()[0] == served.where("similarity_score >= 0.8").count()


def test_an_id_stands_for_one_pair(spark):
    from kinlink.functions.people import match_id
    rows = [("1_2", "3"), ("1", "2_3"), ("1\\", "2"), ("1", "\\2"), ("12", "3")]
    got = [r[0] for r in spark.createDataFrame(rows, "a string, b string").select(match_id(F.col("a"), F.col("b"))).collect()]
    assert len(set(got)) == 5 and got[4] == "12_3"


def test_a_load_of_no_rows(spark, served, folder):
    assert serve.load_served(served.where("false"), f"{folder}/t") == (0, 0)
    assert serve.read_served(spark, f"{folder}/t").count() == 0
    assert serve.load_served(served, f"{folder}/t", "append", load_seq=1) == (served.count(), 0)
    assert serve.read_served(spark, f"{folder}/t").count() == served.count()


def test_matches_are_compared_only_where_documents_repeat(persons, make):
    """Without repeated documents nothing is shuffled by id; with some, the best match of each id is kept as before."""
    a, b = persons
    cfg = MatchConfig(score_digits=9)
    plan = serve.served_matches(a, b, AS_OF, cfg)._jdf.queryExecution().optimizedPlan().toString()
    assert "match_id" in plan and not any("Window" in line and "match_id" in line for line in plan.splitlines())
    people = [("Ana Lima", "1980-01-01", "1", "Ativo"), ("Ana Lina", "1980-01-02", "1", "Ativo"), ("Ana Lima", "1980-01-01", "2", "Ativo"),
              ("Ana Lima", "1980-01-01", None, "Ativo"), ("Ana Lima", "1980-01-01", "2", "Ativo")]
    others = [("Ana Lima", "1980-01-01", "1", "Ativo"), ("Ana Lima", "1980-01-01", "3", "Ativo"), ("Ana Lime", "1980-01-01", "3", "Ativo"),
              ("Ana Lima", "1980-01-01", "4", "Inativo"), ("Ana Lima", "1980-01-01", None, "Ativo")]
    for c, e in ((make(*people), make(*others)), (make(*people), b), (a, make(*others)), (make(*people[:1]), make(*others[:2]))):
        expect = serve.one_per_id(serve.served_documents(match(c, e, cfg), AS_OF)).drop("indexed_at")
        assert rows(serve.served_matches(c, e, AS_OF, cfg).drop("indexed_at")) == rows(expect)
