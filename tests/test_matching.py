from dataclasses import replace

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kinlink.functions import phonetic_code
from kinlink.functions.similarity import rounded
from kinlink.operators.pairing import SkewConfig
from kinlink.operators.scoring import MatchConfig, Weights, finer_attributes
from kinlink.plans.match import candidate_count, candidate_pairs, incremental_match, match, merge_increment, scored_pairs
from kinlink.operators.stats import score_histogram
from kinlink.schema import MATCH_COLUMNS
from tests import reference as R
from tests.conftest import rows

HOT = SkewConfig(pair_budget=3, slice_rows=2, max_hot_keys=50)


def brute_force(a, b, threshold=0.7, key=lambda r: "_".join(x for x in (r[0] and r[0][:3], r[1] and r[1][:4]) if x is not None)):
    """All pairs of two lists of persons with codes, in one block, scoring the threshold."""
    out = []
    for x in a:
        for y in b:
            if key(x) == key(y):
                s = R.score(x[0], x[1], x[2], x[4], y[0], y[1], y[2], y[4])
                if s is not None and s >= threshold:
                    out.append((x[2], x[0], x[1], y[2], y[0], y[1], round(s, 9)))
    return sorted(out, key=repr)


def coded(df):
    return [tuple(r) for r in df.withColumn("code", phonetic_code(F.col("nome_completo"))).collect()]


def found(df):
    cols = ["nr_documento_1", "nome_completo_1", "data_nascimento_1", "nr_documento_2", "nome_completo_2",
            "data_nascimento_2", F.round("similarity_score", 9)]
    return rows(df.select(*cols))


NAMES = st.sampled_from(["Maria Silva", "Maria Sylva", "maria silva", "Mario Silva", "Marina Souza", "Mar", "", None, "Érica"])
DATES = st.sampled_from(["1985-03-15", "1985-03-20", "1985-07-01", "1985-02-30", "1986-01-01", "", None])
DOCS = st.sampled_from(["1", "2", "3", "", None])
PEOPLE = st.lists(st.tuples(NAMES, DATES, DOCS, st.just("Ativo")), min_size=1, max_size=15)


@settings(max_examples=8, deadline=None)
@given(PEOPLE, PEOPLE, st.sampled_from([0.05, 0.4, 0.5, 0.7, 0.85]))
def test_every_strategy_equals_brute_force(spark, make, a, b, threshold):
    """NULLs, empty values, copies and hot keys; the bound and the finer keys lose nothing."""
    left, right = make(*a), make(*b)
    expect = brute_force(coded(left), coded(right), threshold)
    for strategy in ("auto", "salted"):
        cfg = MatchConfig(threshold=threshold, strategy=strategy, skew=HOT)
        assert found(match(left, right, cfg)) == expect, strategy


def test_broadcast_side_with_hot_keys(make):
    a = make(*[("Maria Silva", "1985-03-15", str(i), "Ativo") for i in range(30)])
    hot = replace(HOT, tiny_bytes=0, slice_rows=5)
    plain = match(a, a, MatchConfig(strategy="plain"))
    refined = match(a, a, MatchConfig(skew=hot))
    assert plain.count() == 900 and rows(plain) == rows(refined)


@pytest.mark.parametrize("strategy", ["plain", "broadcast", "shuffle_hash", "salted"])
@pytest.mark.parametrize("blocks", [("prefix",), ("phonetic",), ("prefix", "phonetic")])
def test_strategies_agree(persons, strategy, blocks):
    cfg = MatchConfig(threshold=0.5, blocks=blocks)
    expect = rows(match(*persons, replace(cfg, strategy="plain")))
    assert rows(match(*persons, replace(cfg, strategy=strategy, skew=HOT))) == expect


def test_one_key_with_a_third_of_all_rows_is_cut_up(spark, make):
    from kinlink.operators import pairing
    people = [("Maria Silva", "1985-03-15", str(i), "Ativo") for i in range(200)]
    others = [(f"{chr(65 + i % 26)}xy Lima", f"19{50 + i % 50}-01-01", str(1000 + i), "Ativo") for i in range(400)]
    df = make(*people, *others).repartition(20)
    keyed = pairing.with_passes(df, [F.col("nome_completo")])
    hot = pairing.hot_keys(keyed, keyed, ["_pass", "_key"], SkewConfig(pair_budget=1000, slice_rows=10))
    assert [(r["_key"], r["n1"], r["n2"]) for r in hot.collect()] == [("Maria Silva", 200, 200)]
    grid = pairing._on_grid(keyed, hot, ["_pass", "_key"], 1, SkewConfig(pair_budget=1000, slice_rows=10), df.columns)
    cells = grid.where("_key = 'Maria Silva'").groupBy("_cell").count().agg(F.max("count"), F.count("*")).first()
    assert cells[1] == 400 and cells[0] <= 30   # 20 x 20 cells of about ten rows each


def test_exact_copies_are_spread_over_slices(make):
    from kinlink.operators import pairing
    df = make(*[("Maria Silva", "1985-03-15", "1", "Ativo")] * 200).repartition(20)
    keyed = pairing.with_passes(df, [F.col("nome_completo")])
    cfg = SkewConfig(pair_budget=1000, slice_rows=20)
    hot = pairing.hot_keys(keyed, keyed, ["_pass", "_key"], cfg)
    grid = pairing._on_grid(keyed, hot, ["_pass", "_key"], 1, cfg, df.columns)
    assert grid.select("_cell").distinct().count() > 50
    assert match(df, df, MatchConfig(strategy="salted", skew=cfg)).count() == 200 * 200


def test_finer_attributes():
    assert finer_attributes(MatchConfig()) == ["document", "date", "code"]
    assert finer_attributes(MatchConfig(threshold=0.85)) == ["code"]
    assert finer_attributes(MatchConfig(blocks=("phonetic",))) == []   # the block says it all already
    assert finer_attributes(MatchConfig(threshold=0.1)) == []


def test_output_columns_and_types(persons):
    df = match(*persons)
    assert df.columns == MATCH_COLUMNS
    assert [t for _, t in df.dtypes] == ["string"] * 8 + ["double"] * 4


def test_null_documents(make):
    a = make(("Maria Silva", "1985-03-15", None, "Ativo"))
    b = make(("Maria Silva", "1985-03-15", "1", "Ativo"))
    assert match(a, b).count() == 0
    assert match(a, b, MatchConfig(null_document="zero")).first()["similarity_score"] == pytest.approx(0.9)


def test_empty_documents_match(make):
    a = make(("Maria Silva", "1985-03-15", "", "Ativo"))
    assert match(a, a).first()["similarity_score"] == pytest.approx(1.0)


def test_accents_and_blocks(make):
    a = make(("João Silva", "1985-03-15", "1", "Ativo"))
    b = make(("Joao Silva", "1985-03-15", "1", "Ativo"))
    assert match(a, b).count() == 0
    assert match(a, b, MatchConfig(normalize=True)).count() == 1


def test_bad_dates_do_not_fail(make):
    a = make(("Maria Silva", "1985-02-30", "1", "Ativo"), ("Maria Silva", "bad", "2", "Ativo"))
    assert match(a, a).count() == 2
    assert match(a, a, MatchConfig(max_age_gap=5)).count() == 0


def test_empty_key_block_is_a_candidate_block(make):
    a = make((None, None, "1", "Ativo"), (None, None, "2", "Ativo"))
    assert candidate_pairs(a, a).count() == candidate_count(a, a).first()[0] == 4
    assert match(a, a).count() == 0


def test_candidates_are_counted_without_pairing(persons, make):
    for cfg in (MatchConfig(), MatchConfig(max_age_gap=0, blocks=("phonetic",)), MatchConfig(status="Ativo", max_age_gap=2),
                MatchConfig(blocks=("prefix", "phonetic", "year_prefix"), max_age_gap=1),
                MatchConfig(blocks=("prefix", "phonetic"))):
        counted = candidate_count(*persons, cfg)
        assert [r["candidates"] for r in counted.collect()] == [candidate_pairs(*persons, cfg).count()]
    assert candidate_count(persons[0], persons[1].limit(0)).first()[0] == 0
    odd = make((None, "bad", "1", "Ativo"), ("Ana", None, "2", None), ("Ana", None, None, "Ativo"), ("", "", "", ""))
    for cfg in (MatchConfig(), MatchConfig(max_age_gap=5, blocks=("prefix", "phonetic"))):
        assert candidate_count(odd, odd, cfg).first()[0] == candidate_pairs(odd, odd, cfg).count()


def test_multi_pass_contains_single_passes(persons):
    one = set(rows(match(*persons, MatchConfig(blocks=("prefix",)))))
    two = set(rows(match(*persons, MatchConfig(blocks=("phonetic",)))))
    many = rows(match(*persons, MatchConfig(blocks=("prefix", "phonetic"))))
    assert set(many) == one | two and len(many) == len(one | two)


def test_max_matches(persons):
    cfg = MatchConfig(threshold=0.4, max_matches=1)
    best = match(*persons, cfg)
    every = match(*persons, replace(cfg, max_matches=None))
    top = every.groupBy("nr_documento_1").agg(F.max("similarity_score").alias("s"))
    assert rows(best.select("nr_documento_1", "similarity_score")) == rows(top)


def test_incremental_equals_full(persons):
    a, b = persons
    n = F.col("nr_documento").cast("long")
    a_old, a_new, b_old, b_new = a.where(n % 3 > 0), a.where(n % 3 == 0), b.where(n % 4 > 0), b.where(n % 4 == 0)
    before = match(a_old, b_old)
    full = merge_increment(before, incremental_match(a_old, a_new, b_old, b_new))
    assert rows(full) == rows(match(a, b))


def test_stale_records_are_taken_out(persons):
    a, b = persons
    gone = a.where(F.col("nr_documento").cast("long") % 2 == 0)
    kept = merge_increment(match(a, b), match(a.limit(0), b), stale_1=gone)
    assert rows(kept) == rows(match(a.exceptAll(gone), b))


def test_weights(persons):
    with pytest.raises(ValueError):
        Weights(levenshtein=0.5)
    cfg = MatchConfig(weights=Weights(0.3, 0.3, 0.15, 0.25, 0.0))
    got = scored_pairs(*persons, cfg).first()
    expect = 0.3 * got["name_lev_score"] + 0.3 * got["name_jaro_score"] + 0.15 * got["name_soundex_score"] + 0.25 * got["date_score"]
    assert got["similarity_score"] == pytest.approx(expect)


def test_plan_has_one_arrow_udf_and_bounds_in_the_join(persons, spark):
    df = match(*persons, MatchConfig(strategy="plain", max_age_gap=5))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in text
    join = next(line for line in text.splitlines() if "Join" in line)
    assert "levenshtein" in join and "abs(" in join


def test_unknown_strategy(persons):
    with pytest.raises(ValueError):
        match(*persons, MatchConfig(strategy="magic"))


def test_broadcasts_switched_off(spark, persons):
    expect = rows(match(*persons, MatchConfig(strategy="plain")))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(match(*persons, MatchConfig(strategy="auto"))) == expect
        assert rows(match(*persons, MatchConfig(strategy="broadcast"))) == expect
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_more_hot_keys_than_the_list_that_is_broadcast(persons):
    expect = rows(match(*persons, MatchConfig(strategy="plain")))
    cfg = SkewConfig(pair_budget=1, slice_rows=2, max_hot_keys=1)
    assert rows(match(*persons, MatchConfig(strategy="salted", skew=cfg))) == expect


def test_names_are_compared_once_a_bundle(spark, make):
    """Rows of one name meet those of another as one pair of bundles, whatever their number; every pair of rows comes out, cut at any size."""
    from kinlink.operators import pairing, scoring
    from kinlink.plans import match as plan
    days = ["1980-01-01", "1980-01-02", "1980-02-01", "1981-01-01", "", None]
    people = lambda name, tag, n: [(name, days[i % 6], f"{tag}{i % 40}" if i % 9 else None, "Ativo") for i in range(n)]
    a = make(*people("Ana Maria Souza", "x", 150), *people("Ana Mario Souza", "y", 3), *people(None, "x", 7), *people("", "z", 5))
    b = make(*people("Ana Maria Sousa", "x", 130), *people("Ana Maria Souza", "y", 4), *people(None, "x", 7), *people("", "z", 5))
    every = MatchConfig(strategy="plain")
    left, right = (plan._prepared(df, every, True) for df in (a, b))
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def met(_):
        seen.add(1)
        return True

    bundles = pairing.Bundles([*scoring.name_bundles(every).by], bound=lambda l, r: met(F.concat(l("_lower"), r("_lower"))))
    key = [F.lit("k")]
    pairs = pairing.pair_rows(left, right, key, key, strategy="plain", bundles=bundles)
    n = left.count() * right.count()
    assert pairs.count() == n and 0 < seen.value < n / 50
    for null in ("drop", "zero"):
        for threshold in (0.3, 0.7):
            expect = None
            for strategy, skew in (("plain", pairing.SkewConfig()), ("auto", pairing.SkewConfig()), ("shuffle_hash", pairing.SkewConfig()),
                                   ("salted", pairing.SkewConfig(pair_budget=20, slice_rows=7))):
                cfg = MatchConfig(threshold=threshold, null_document=null, strategy=strategy, skew=skew)
                got = rows(plan.match(a, b, cfg))
                by_score = plan.scored_pairs(a, b, cfg).where(F.col("similarity_score") >= threshold)
                expect = expect or rows(by_score.select(*plan.MATCH_COLUMNS))
                assert got == expect and expect


def test_rows_of_bundles_are_shuffled_once(persons):
    """With one block the pass is a constant, which the window does not ask for; the rows stay in as many tasks as they were dealt to."""
    text = match(*persons, MatchConfig(strategy="plain"))._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert dealt and all("REPARTITION_BY_NUM" in line for line in dealt)


TEXTS = st.text(alphabet="abcéÉİ MZzñ🙂", max_size=14)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=1, max_size=40))
def test_bounds_by_characters_never_exceed_the_scores(spark, pairs):
    """Characters without a partner bound edits from below and common characters from above."""
    from kinlink.functions.similarity import jaro_winkler, letter_bags, letters_apart
    low = spark.createDataFrame(pairs, "a string, b string").select(F.lower("a").alias("a"), F.lower("b").alias("b")).where("a != '' AND b != ''")
    la, lb = F.length("a"), F.length("b")
    got = low.withColumn("apart", letters_apart(letter_bags(F.col("a")), letter_bags(F.col("b")))).select(
        "a", "b", "apart", F.levenshtein("a", "b").alias("edits"), jaro_winkler(F.col("a"), F.col("b")).alias("jaro"),
        ((F.col("apart") + F.abs(la - lb)) / 2).alias("least"), (0.6 + (la + lb) * (la + lb - F.col("apart")) * 0.1 / (la * lb)).alias("most"))
    for r in got.collect():
        assert r["edits"] >= r["least"] and r["jaro"] <= r["most"] + 1e-9, r
        assert r["a"] != r["b"] or r["apart"] == 0


def test_few_pairs_of_names_have_their_edits_counted(spark, make):
    """Names of one block that share too few letters are ruled out before; those that could match are kept."""
    from kinlink.operators import scoring
    from kinlink.plans import match as plan
    names = ["Ana Quirino Bastos", "Ana Teles Fagundes", "Ana Wolf Xerxes", "Ana Prado Cunha"]
    people = make(*[(n, f"1980-0{i + 1}-01", f"{i}", "Ativo") for i, n in enumerate(names)])
    cfg = MatchConfig(strategy="plain")
    bundles = scoring.name_bundles(cfg)
    rows_ = plan._prepared(people, cfg, True)
    side = lambda n: rows_.groupBy(*bundles.by).agg(*[c.alias(k) for k, c in bundles.summary.items()]).withColumns(bundles.derive).alias(n)
    test = bundles.bound(lambda c: F.col(f"x.{c}"), lambda c: F.col(f"y.{c}"))
    kept = side("x").crossJoin(side("y")).where(test).select(F.col("x._lower").alias("p"), F.col("y._lower").alias("q"))
    assert rows(kept) == sorted((n.lower(), n.lower()) for n in names)
    by_score = plan.scored_pairs(people, people, cfg).where("similarity_score >= 0.7")
    assert rows(match(people, people, cfg)) == rows(by_score.select(*MATCH_COLUMNS))


def test_rounding_without_text_equals_rounding(spark):
    values = [0.0, 1.0, 0.5, 0.7, 1 / 3, 2 / 3, 0.1234567895, 0.1234567885, 0.9999999995, 0.9999999994999, 4e-10, 5e-10, -0.25, 1.75, None]
    values += [i / 7919 for i in range(0, 7919, 13)] + [(i + 0.5) / 1e9 for i in range(0, 10 ** 9, 3_333_333)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 3, 9, 12):
        assert df.where(~rounded(F.col("x"), digits).eqNullSafe(F.round("x", digits))).isEmpty()


def test_scores_are_worked_out_once_a_pair(persons):
    """Edits are not counted again to test for NULL, nor is the total put into each filter and aggregate that names it."""
    counts = score_histogram(match(*persons, MatchConfig(threshold=0.5, score_digits=9)))
    lines = counts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    after = lines[:next(i for i, line in enumerate(lines) if "ArrowEvalPython" in line)]
    assert sum(line.count("levenshtein(") for line in after) == 1
    assert sum("name_soundex_score" in line and "* 0.15" in line for line in after) == 1
    assert not any("decimal" in line for line in after)


def test_jaro_winkler_of_many_pairs_and_of_few(spark):
    """Many short texts go side by side, few long ones row by row, with the same scores as in plain Python."""
    import random

    from kinlink.functions.similarity import jaro_winkler
    draw = random.Random(3)
    text = lambda letters, most: "".join(draw.choice(letters) for _ in range(draw.randint(0, most)))
    pairs = [(text(letters, most), text(letters, most)) for letters, most, n in (("abcé", 12, 900), ("abł漢", 9, 300), ("ab ", 90, 20)) for _ in range(n)]
    df = spark.createDataFrame(pairs + [(None, "a"), ("", "a")], "a string, b string")
    many = {(r["a"], r["b"]): r["j"] for r in df.coalesce(1).select("a", "b", jaro_winkler("a", "b").alias("j")).collect()}
    few = {(r["a"], r["b"]): r["j"] for r in df.repartition(60).select("a", "b", jaro_winkler("a", "b").alias("j")).collect()}
    assert many == few
    assert all(abs(many[a, b] - R.jaro_winkler(a, b)) < 1e-12 for a, b in pairs if a and b)


def test_tenths_are_those_of_rounded_scores(spark):
    from kinlink.operators.stats import score_bucket
    scores = [0.0, 1.0, None, -0.25] + [i / 10 + e for i in range(11) for e in (0, 4e-11, -4e-11, 5e-11, -5e-11, -6e-11, 1e-9, -1e-9, 2e-9, -2e-9, 0.05)]
    df = spark.createDataFrame([(s,) for s in scores], "s double")
    got = df.select(score_bucket(F.col("s")).alias("fast"), F.floor(F.round(F.col("s") * 10, 9)).cast("int").alias("plain"))
    assert all(r["fast"] == r["plain"] for r in got.collect())
    assert "CASE WHEN" in got._jdf.queryExecution().optimizedPlan().toString()


def test_candidates_take_their_key_from_the_join(persons):
    for blocks in (("prefix",), ("prefix", "phonetic")):
        found = candidate_pairs(*persons, MatchConfig(blocks=blocks, max_age_gap=5))
        lines = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
        above = lines[:next(i for i, line in enumerate(lines) if "Join" in line)]
        assert above and not [line for line in above if "concat_ws" in line]
