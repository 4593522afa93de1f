"""The store of two copies and the name indexes, against scans of the served table."""

import itertools
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from kinlink.functions.text import fuzzy_any, query_tokens
from kinlink.operators import search
from kinlink.operators.scoring import MatchConfig
from kinlink.plans import name_index as N, serve, store as S
from kinlink.plans.match import match
from kinlink.schema import SERVED_COLUMNS, SERVED_SCHEMA
from tests.conftest import rows

BEFORE = [c for c in SERVED_COLUMNS if c != "indexed_at"]


@pytest.fixture(scope="module")
def docs(spark, persons):
    made = serve.served_documents(match(*persons, MatchConfig(threshold=0.5)), date(2025, 6, 30))
    rows_ = made.collect()
    first = rows_[0]
    odd = [first.asDict() | {"match_id": f"x_{i}", "nr_documento_1": "x", "nr_documento_2": d, "nome_completo_1": n, "nome_completo_2": m}
           for i, (d, n, m) in enumerate([("x", "Ána D'Ávila d'avila", None), ("y", "", "Jo Li"), (first["nr_documento_1"], "ab ba ab ba", "aab abb bab")])]
    return spark.createDataFrame([r.asDict() for r in rows_] + odd, SERVED_SCHEMA)


@pytest.fixture(scope="module")
def place(spark, docs, tmp_path_factory):
    """Three loads: all rows with another score, some with another name, all as they are but for a few."""
    st = S.Store(str(tmp_path_factory.mktemp("store")), 8)
    part = lambda n: F.crc32(F.col("match_id").cast("binary")) % n
    S.add_load(spark, st, docs.withColumn("similarity_score", F.lit(0.123)), 1)
    S.add_load(spark, st, docs.where(part(3) == 0).withColumn("nome_completo_1", F.lit("Replaced Later")), 2)
    S.add_load(spark, st, docs.where(part(5) != 0), 7)
    return st


@pytest.fixture(scope="module")
def current(spark, docs):
    part = lambda n: F.crc32(F.col("match_id").cast("binary")) % n
    old = docs.where(part(5) == 0)
    return (docs.where(part(5) != 0).unionByName(old.where(part(3) == 0).withColumn("nome_completo_1", F.lit("Replaced Later")))
            .unionByName(old.where(part(3) != 0).withColumn("similarity_score", F.lit(0.123)))).select(*BEFORE)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_later_load_wins(spark, place, current):
    for side in S.SIDES:
        assert rows(S.read_store(spark, place, side).select(*BEFORE)) == rows(current)


def test_loads_are_put_together_without_a_shuffle(spark, place):
    for side in S.SIDES:
        plan = plan_of(S.read_store(spark, place, side))
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 3


def test_a_lookup_reads_one_bucket_of_each_copy(spark, place):
    plan = plan_of(S.store_document_hits(spark, place, "x"))
    assert plan.count("SelectedBucketsCount: 1 out of 8") == 6 and "SelectedBucketsCount: 8" not in plan


def test_lookups(spark, place, current):
    served = current.withColumn("indexed_at", F.lit(None).cast("timestamp"))
    some = [r[0] for r in current.select("nr_documento_2").limit(5).collect()] + ["x", "y", "nothing", ""]
    for document in some:
        for floor in (None, 0.6):
            assert rows(S.search_store(spark, place, document, 5, floor).select(*BEFORE)) == rows(search.search_by_document(served, document, 5, floor).select(*BEFORE))
    asked = spark.createDataFrame([(x,) for x in [*some, *some, None]], "document string")
    assert rows(S.search_store_batch(spark, place, asked, 3).select("document", *BEFORE)) == rows(search.search_documents_batch(asked, served, 3).select("document", *BEFORE))


def test_another_session_finds_the_buckets(spark, place):
    for load, side in itertools.product((1, 2, 7), S.SIDES):
        spark.sql(f"DROP TABLE {place.table(load, side)}")       # external tables: the files stay
    plan = plan_of(S.store_document_hits(spark, place, "x"))
    assert plan.count("SelectedBucketsCount: 1 out of 8") == 6
    assert S.store_document_hits(spark, place, "x").count() == 3


def test_loads_come_in_order(spark, docs, place, folder):
    with pytest.raises(ValueError, match="after 7"):
        S.add_load(spark, place, docs, 7)
    with pytest.raises(ValueError, match="8 buckets"):
        S.read_store(spark, S.Store(place.path, 16))
    assert S.read_store(spark, S.Store(folder, 4)).count() == 0
    none = S.Store(f"{folder}/nulls", 4)
    bad = docs.limit(2).withColumn("match_id", F.lit(None).cast("string"))
    assert S.add_load(spark, none, bad, 1) == (0, 2) and S.read_store(spark, none).count() == 0


# --- names --------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def index(spark, place, tmp_path_factory):
    ix = N.NameIndex(str(tmp_path_factory.mktemp("names")), 64)
    N.build_name_index(S.read_store(spark, place), ix)
    return ix


QUESTIONS = ["Blemina", "jo", "Li", "ab", "aab", "abab", "davila", "D'Avila", "nothing like it", "", "Replaced", "Replcaed Lter", "x", "Ána"]


def names_of(current):
    return sorted({w for r in current.select("nome_completo_1", "nome_completo_2").collect() for n in r for w in query_tokens(n or "")})


def changed(word, seed):
    """The word with letters swapped, dropped, doubled or replaced in turn."""
    i = seed % max(len(word) - 1, 1)
    return [word[:i] + word[i + 1:i + 2] + word[i:i + 1] + word[i + 2:], word[:i] + word[i + 1:], word[:i + 1] + word[i:], word[:i] + "q" + word[i + 1:]][seed % 4]


def test_similar_names_are_those_of_the_scan(spark, place, index, current):
    words = names_of(current)
    questions = QUESTIONS + [changed(changed(w, k), k + 3) for k, w in enumerate(words)][:12]
    for name in questions:
        got = {r["match_id"] for r in N.fuzzy_hits(spark, index, name).collect()}
        assert got == {r["match_id"] for r in search.name_hits(current, name).collect()}, name


def test_similar_names_of_many_questions(spark, place, index, current):
    words = names_of(current)
    questions = QUESTIONS + words + [changed(w, k) for k, w in enumerate(words)] + [changed(changed(w, k), k + 1) for k, w in enumerate(words)]
    asked = spark.createDataFrame(list(enumerate(questions)) + [(-1, None)], "query_id int, query_name string")
    got = {(r["query_id"], r["match_id"]) for r in N.fuzzy_hits_batch(spark, index, asked).collect()}
    table = [(r["match_id"], N.query_tokens(" ".join(n for n in (r["nome_completo_1"], r["nome_completo_2"]) if n))) for r in current.collect()]
    tokens = spark.createDataFrame([(t,) for t in sorted({t for _, ts in table for t in ts})], "token string")
    for k, name in enumerate(questions[:40]):
        near = {r["token"] for r in tokens.where(fuzzy_any(F.array("token"), name)).collect()}
        assert {m for q, m in got if q == k} == {m for m, ts in table if near & set(ts)}, name


def test_near_words_agrees_with_the_test_for_one_question(spark):
    words = sorted({"".join(w) for n in (1, 2, 3, 4) for w in itertools.product("ab", repeat=n)} | {"abcdef", "bacdef", "bacdfe", "abcdfe", "abdcef", "acbdfe", "bcdef", "abcef", "abcdefgh", "badcef", "badcfe"})
    both = spark.createDataFrame([(x, y) for x in words for y in words], "token string, word string")
    got = {(r["token"], r["word"]) for r in both.where(N.near_words(F.col("token"), F.col("word"))).collect()}
    for w in words:
        expect = {r["token"] for r in spark.createDataFrame([(x,) for x in words], "token string").where(fuzzy_any(F.array("token"), w)).collect()}
        assert {t for t, v in got if v == w} == expect, w


def test_variants_are_the_same_in_both_forms(spark):
    words = ["a", "ab", "abc", "abcd", "abcde", "abcdef", "aaaaaa", "ünïcödé"]
    for w, got in zip(words, (r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(
            N.variant_column(F.col("w"), F.when(F.length("w") <= 2, 0).when(F.length("w") <= 5, 1).otherwise(2))).collect())):
        assert N.variants_of(w) >= set(got)
        assert {v for v in N.variants_of(w) if len(v) >= 4 or len(w) - len(v) < 2} == set(got)


def test_every_phrase_of_the_table(spark, place, index, current):
    """All sequences of one to four words of all names, at once, and some alone."""
    table = [(r["match_id"], query_tokens(n)) for r in current.collect() for n in (r["nome_completo_1"], r["nome_completo_2"]) if n]
    phrases = sorted({" ".join(ts[i:i + k]) for _, ts in table for k in (1, 2, 3, 4) for i in range(len(ts) - k + 1)})
    phrases += ["ab ab", "ba ba", "ab ba ab ba ab", "not there", "ab nothere", ""]
    asked = spark.createDataFrame(list(enumerate(phrases)) + [(-1, None)], "query_id int, query_name string")
    got = {}
    for r in N.phrase_hits_batch(spark, index, asked).collect():
        got.setdefault(r["query_id"], set()).add(r["match_id"])
    for k, p in enumerate(phrases):
        expect = {m for m, ts in table if p and f" {p} " in f" {' '.join(ts)} "}
        assert got.get(k, set()) == expect, p
    for k in [*range(0, len(phrases), max(1, len(phrases) // 6)), *range(len(phrases) - 6, len(phrases))]:
        assert {r["match_id"] for r in N.phrase_hits(spark, index, phrases[k]).collect()} == got.get(k, set())


def test_ranked_searches(spark, place, index, current):
    served = current.withColumn("indexed_at", F.lit(None).cast("timestamp"))
    known = current.orderBy("match_id").first()["nome_completo_2"]
    for name, fuzzy in ((changed(known, 5), True), (known, False), ("nothing", True), ("d'avila d'avila", False)):
        for top, floor in ((3, None), (4, 0.6)):
            got = N.search_indexed(spark, place, index, name, top, fuzzy, floor).select(*BEFORE)
            assert rows(got) == rows(search.search_by_name(served, name, top, fuzzy, floor).select(*BEFORE))
    asked = spark.createDataFrame([(1, "Replcaed"), (2, "nothing"), (3, "Replaced Later")], "query_id int, query_name string")
    got = N.search_indexed_batch(spark, place, index, asked, top=2).select("query_id", *BEFORE)
    expect = [(q, *r) for q, n in ((1, "Replcaed"), (3, "Replaced Later")) for r in search.search_by_name(served, n, 2).select(*BEFORE).collect()]
    assert rows(got) == sorted(map(tuple, expect), key=repr)


def test_many_questions_take_only_the_best_matches_of_a_word(spark, folder):
    """A word or a couple of words that stands in every name gives a question as many hits as it asks for, and the right ones."""
    docs = [(f"d{i:03d}", f"e{i:03d}", f"Ana Maria Silva {'Souza' if i % 2 else 'Lopes'}", "Ana Maria", (i * 37 % 100) / 100) for i in range(100)]
    given = spark.createDataFrame(docs, "nr_documento_1 string, nr_documento_2 string, nome_completo_1 string, nome_completo_2 string, similarity_score double")
    place, ix = S.Store(f"{folder}/store", 4), N.NameIndex(f"{folder}/names", 4)
    S.add_load(spark, place, serve.served_documents(given.withColumns({f"data_nascimento_{n}": F.lit("1980-01-01") for n in (1, 2)}), date(2025, 6, 30)), 1)
    N.build_name_index(S.read_store(spark, place), ix)
    asked = spark.createDataFrame([(k, n) for k, n in enumerate(("Ana", "Maria Silva", "Ana Maria Silva Souza"))], "query_id int, query_name string")
    for hits_of, fuzzy in ((N.fuzzy_hits_batch, True), (N.phrase_hits_batch, False)):
        for top, floor in ((3, None), (2, 0.5)):
            hits = hits_of(spark, ix, asked, top, floor)
            best = lambda df: rows(df.where(f"similarity_score >= {floor or 0}").groupBy("query_id").agg(F.slice(F.sort_array(F.collect_set(F.struct((-F.col("similarity_score")).alias("s"), "match_id"))), 1, top)))
            assert best(hits) == best(hits_of(spark, ix, asked))
            assert hits.count() <= 3 * top * 4 < 100
            got = N.search_indexed_batch(spark, place, ix, asked, top, fuzzy, floor)
            assert got.groupBy("query_id").count().where(f"count = {top}").count() == 3


def test_a_question_reads_only_its_folders(spark, index, current):
    """Every scan of an index table is bounded by the folders of its keys."""
    name = current.orderBy("match_id").first()["nome_completo_2"]
    for rows_ in (N.phrase_hits(spark, index, name), N.fuzzy_hits(spark, index, name), N.similar_words(spark, index, name)):
        scans = [line for line in plan_of(rows_).splitlines() if "FileScan" in line and "bucket#" in line.split("Batched")[0]]
        assert scans, plan_of(rows_)
        assert all(re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (INSET|IN|=) ", line) for line in scans), scans
    assert len(index.read(spark, "variants").inputFiles()) > 30
