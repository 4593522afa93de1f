import math
import random
from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kinlink.functions import cpf_is_valid
from kinlink.operators import entities, learning, lsh, quality, stats
from kinlink.operators.pairing import SkewConfig
from kinlink.operators.scoring import MatchConfig
from kinlink.plans.match import candidate_count, match, score, scored_pairs
from kinlink.plans.serve import read_served
from kinlink.schema import MATCH_SCHEMA
from kinlink.sources import generate, sinks
from kinlink.streaming import jobs
from tests.conftest import rows


def components(edges):
    parent = {}
    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for u, v in edges:
        a, b = find(u), find(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


NODE = st.integers(0, 25).map(lambda i: f"n{i:02d}")


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(NODE, NODE), min_size=1, max_size=30))
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u string, v string")
    got = {r["node"]: r["entity"] for r in entities.connected_components(df).collect()}
    assert got == components(edges)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(120)]
    hub = [("hub", f"s{i:03d}") for i in range(150)]
    random.Random(1).shuffle(chain)
    got = {r["node"]: r["entity"] for r in entities.connected_components(
        spark.createDataFrame(chain + hub, "u string, v string")).collect()}
    assert got == components(chain + hub)


def test_golden_record_fills_gaps(spark, make):
    a = make(("", "1985-03-15", "1", None))
    b = make(("Maria", "1985-03-16", "1", "Ativo"))
    clusters = spark.createDataFrame([("1:1", "e"), ("2:1", "e")], "node string, entity string")
    got = entities.golden_records(a, b, clusters).first()
    assert tuple(got) == ("e", 2, "Maria", "1985-03-15", "1", "Ativo")


def test_lsh_finds_all_copies_and_only_close_names(persons):
    a, b = persons
    got = lsh.lsh_candidate_pairs(a, b)
    same = a.join(b, "nome_completo").count()
    assert got.where("nome_completo_1 = nome_completo_2").count() == same
    assert got.where("distance > 0.3").count() == 0
    near = a.select("nome_completo").distinct().crossJoin(b.select(F.col("nome_completo").alias("m")).distinct()).where(
        lsh.jaccard_distance(lsh.trigrams(F.col("nome_completo")), lsh.trigrams(F.col("m"))) <= 0.3).count()
    assert lsh.similar_names(a, b).count() >= 0.9 * near


def test_lsh_salted_gives_the_same(persons):
    hot = lsh.MinHashConfig(strategy="salted", skew=SkewConfig(pair_budget=1, slice_rows=2))
    assert rows(lsh.similar_names(*persons, hot)) == rows(lsh.similar_names(*persons))


def test_lsh_skips_short_names(make):
    a = make(("Al", None, "1", None), (None, None, "2", None), ("Ana", None, "3", None))
    assert [r["nr_documento_1"] for r in lsh.lsh_candidate_pairs(a, a).collect()] == ["3"]


def test_embeddings(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = lsh.embedding_matches(vectors, 1.1, 0.5).collect()
    values = {r["vec_id"]: r["embedding"] for r in vectors.collect()}
    distance = lambda i, j: math.dist(values[i], values[j])
    ids = sorted(values)
    true = {(i, j) for x, i in enumerate(ids) for j in ids[x + 1:] if distance(i, j) <= 1.1}
    pairs = {(r["id_1"], r["id_2"]) for r in got}
    assert len(pairs) == len(got) and pairs <= true and len(pairs) >= 0.8 * len(true)
    assert all(r["distance"] == pytest.approx(distance(r["id_1"], r["id_2"])) for r in got)


def test_near_copies_of_vectors(spark, sf):
    """Only pairs within the distance, each once; near copies are found."""
    rows_in = spark.read.parquet(f"{sf}/embeddings.parquet").limit(200).collect()
    values = {r["vec_id"]: [float(x) for x in r["embedding"]] for r in rows_in}
    noise = random.Random(5)
    copies = {10**6 + i: [x + noise.gauss(0, 0.02) for x in v] for i, v in list(values.items())[:60]}
    values.update(copies)
    df = spark.createDataFrame(list(values.items()), "vec_id long, embedding array<double>")
    got = lsh.embedding_matches(df, 1.1, 0.25, bands=16, rows=8).collect()
    pairs = {(r["id_1"], r["id_2"]) for r in got}
    assert len(pairs) == len(got) and all(i < j for i, j in pairs)
    for r in got:
        assert r["distance"] == pytest.approx(math.dist(values[r["id_1"]], values[r["id_2"]])) and r["distance"] <= 1.1
    assert sum((i - 10**6, i) in pairs for i in copies) >= 57
    salted = lsh.embedding_matches(df, 1.1, 0.25, bands=16, rows=8, strategy="salted", skew=SkewConfig(pair_budget=50, slice_rows=10))
    assert {(r["id_1"], r["id_2"]) for r in salted.collect()} == pairs


def test_fellegi_sunter_fits_a_planted_mixture():
    share, m, u = 0.2, [[0.02, 0.08, 0.9], [0.1, 0.9], [0.02, 0.03, 0.15, 0.8], [0.15, 0.85]], \
        [[0.9, 0.08, 0.02], [0.8, 0.2], [0.5, 0.3, 0.15, 0.05], [0.99, 0.01]]
    vectors = []
    for a in range(3):
        for b in range(2):
            for c in range(4):
                for d in range(2):
                    p = share * m[0][a] * m[1][b] * m[2][c] * m[3][d] + (1 - share) * u[0][a] * u[1][b] * u[2][c] * u[3][d]
                    vectors.append(((a, b, c, d), round(p * 10**7)))
    got, m2, u2 = learning.expectation_maximisation(vectors, 500)
    assert got == pytest.approx(share, abs=0.01)
    for x, y in zip(sum(m, []) + sum(u, []), sum(m2, []) + sum(u2, [])):
        assert x == pytest.approx(y, abs=0.02)


def test_learning(persons):
    scored = scored_pairs(*persons, MatchConfig(blocks=("year_prefix",))).unionByName(score(learning.random_pairs(*persons)))
    weights = {r["feature"]: r["weight"] for r in learning.learned_weights(scored).collect()}
    assert sum(weights.values()) == pytest.approx(1.0) and weights["date_score"] > 0
    fitted = {(r["field"], r["level"]): r for r in learning.fellegi_sunter(scored).collect()}
    assert fitted["document", 1]["match_weight"] > 0 > fitted["document", 0]["match_weight"]
    counted = learning.comparison_vectors(scored)
    assert counted.agg(F.sum("pairs")).first()[0] == scored.count()


def test_pair_quality(persons):
    a, b = persons
    found = match(a, b, MatchConfig(threshold=0.5))
    got = {r["threshold"]: r for r in stats.pair_quality(a, b, found, [0.5, 0.9], candidate_count(a, b)).collect()}
    truth = a.join(b, "nr_documento").count()
    assert all(r["tp"] + r["fn"] == truth for r in got.values())
    assert got[0.5]["recall"] >= got[0.9]["recall"] and got[0.9]["precision"] >= got[0.5]["precision"]


def test_quality(make):
    a = make(("Ana", "1985-02-30", "52998224725", "Ativo"), (None, "bad", "52998224725", "Outro"), ("", "", "", ""))
    got = {r["measure"]: r["value"] for r in quality.person_quality_profile(a).collect()}
    assert got["rows"] == 3 and got["nome_completo_null"] == 1 and got["nome_completo_empty"] == 1
    assert got["birth_date_invalid"] == 2 and got["document_invalid"] == 0
    assert got["status_unknown"] == 1 and got["document_repeated"] == 1


def test_generator(spark):
    cfg = generate.GeneratorConfig(seed=7)
    a, b = generate.generate_pair(spark, 1000, cfg)
    assert a.count() == b.count() == 1000
    both = a.alias("a").join(b.alias("b"), "nr_documento")
    assert both.count() == 300
    assert a.where(~cpf_is_valid(F.col("nr_documento"))).count() == 0
    changed = both.agg(
        F.count_if(F.col("a.nome_completo") != F.col("b.nome_completo")),
        F.count_if(F.col("a.data_nascimento") != F.col("b.data_nascimento")),
        F.count_if(F.substring("a.data_nascimento", 1, 4) != F.substring("b.data_nascimento", 1, 4))).first()
    assert 50 <= changed[0] <= 120 and 15 <= changed[1] <= 80 and changed[2] == 0
    days = a.agg(F.min("data_nascimento"), F.max("data_nascimento")).first()
    assert "1950-01-01" <= days[0] and days[1] <= "2005-12-30"
    again = generate.generate_from_ids(spark.range(50).repartition(7), cfg)
    assert [rows(x) for x in again] == [rows(x) for x in generate.generate_from_ids(spark.range(50), cfg)]
    assert rows(generate.shuffled(a, 1)) == rows(a) and generate.with_stored_key(a).columns[-1] == "blocking_key"


def test_generator_noise_is_typo_initial_or_swap(spark):
    ids = spark.range(400)
    clean = generate.random_persons(ids, 3)
    noisy = generate.varied(clean, generate.GeneratorConfig(variation=1.0, seed=3))
    for r in clean.join(noisy.select("id", "nome_completo"), "id").collect():
        f, m, l, n = r["first"], r["middle"], r["last"], r["nome_completo"]
        typo = n.endswith(f" {m} {l}") and len(n.split()[0]) == len(f) and n[0] == f[0] and n.split()[0][-1] == f[-1]
        assert typo or n in (f"{f} {m[0]}. {l}", f"{f} {l} {m}")


# --- streaming --------------------------------------------------------------------------------

def test_file_stream_equals_batch_and_replay_adds_nothing(spark, persons, folder):
    a, b = persons
    sinks.write_persons(a.repartition(3), f"{folder}/in")
    run = lambda: jobs.run_available(
        jobs.match_stream(jobs.stream_files(spark, f"{folder}/in"), b), f"{folder}/out", f"{folder}/cp")
    run()
    read = lambda: rows(spark.read.schema(MATCH_SCHEMA).parquet(f"{folder}/out"))
    assert read() == rows(match(a, b))
    run()
    assert read() == rows(match(a, b))
    with pytest.raises(ValueError):
        jobs.match_stream(a, b, MatchConfig(strategy="salted"))


def test_batches_of_a_stream_split_hot_keys(spark, persons, folder):
    a, b = persons
    sinks.write_persons(a.repartition(2), f"{folder}/in")
    assert jobs.read_batches(spark, f"{folder}/out").count() == 0
    cfg = MatchConfig(strategy="salted", skew=SkewConfig(pair_budget=20, slice_rows=3))
    for _ in range(2):
        source = jobs.stream_files(spark, f"{folder}/in", max_files=1)
        jobs.match_batches(source, b, f"{folder}/out", f"{folder}/cp", cfg)
        assert rows(jobs.read_batches(spark, f"{folder}/out")) == rows(match(a, b))


def test_arrivals_are_served_by_load(spark, persons, folder):
    a, b = persons
    sinks.write_persons(a.repartition(2), f"{folder}/in")
    source = jobs.stream_files(spark, f"{folder}/in", max_files=1)
    jobs.match_arrivals(source, b, f"{folder}/t", f"{folder}/cp", as_of=date(2025, 1, 1))
    ids = match(a, b).selectExpr("nr_documento_1 || '_' || nr_documento_2 AS match_id").distinct()
    assert rows(read_served(spark, f"{folder}/t").select("match_id")) == rows(ids)


def test_repeats_within_a_day_are_dropped_and_late_rows_too(spark, folder):
    schema = "nr_documento_1 string, nr_documento_2 string, similarity_score double, event_time timestamp"
    def send(part, *sent):
        data = [(d, "x", 0.9, t) for d, t in sent]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = jobs.stream_files(spark, f"{folder}/in", spark.createDataFrame([], schema).schema)
        jobs.run_available(jobs.drop_repeated(stream).select("match_key", "event_time"), f"{folder}/out", f"{folder}/cp")
        return rows(spark.read.parquet(f"{folder}/out").select("match_key"))
    first = datetime(2025, 1, 1, 0)
    assert send(1, ("a", first), ("a", datetime(2025, 1, 1, 5))) == [("a:x:0.9",)]
    assert send(2, ("a", datetime(2025, 1, 1, 20)), ("b", datetime(2025, 1, 5))) == [("a:x:0.9",), ("b:x:0.9",)]
    got = send(3, ("a", datetime(2025, 1, 6)), ("c", datetime(2025, 1, 2)))
    assert got == [("a:x:0.9",), ("a:x:0.9",), ("b:x:0.9",)]   # a again after a day; c came too late


def test_hourly_counts_in_two_batches(spark, folder):
    def send(*events):
        spark.createDataFrame(list(events), "user_id long, ts timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = jobs.stream_files(spark, f"{folder}/in", spark.createDataFrame([], "user_id long, ts timestamp").schema)
        jobs.run_hourly_counts(source, f"{folder}/out", f"{folder}/cp")
    send((1, datetime(2025, 1, 1, 0, 5)), (1, datetime(2025, 1, 1, 0, 50)))
    send((1, datetime(2025, 1, 1, 0, 55)), (2, datetime(2025, 1, 1, 1, 0)))
    got = jobs.latest_hourly_counts(spark, f"{folder}/out")
    assert rows(got.select("user_id", "n_events")) == [(1, 3), (2, 1)]
