from datetime import date

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kinlink import functions as K
from kinlink.functions import text
from tests import reference as R

TEXT = st.text(alphabet="abcdeABCD ãÉç.'", max_size=12)


def values(spark, rows, column, schema="a string, b string"):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def both(fn):
    return fn(F.col("a"), F.col("b"))


def test_levenshtein(spark):
    rows = [("João", "Joao"), (None, "a"), ("", "a"), ("Ana", "ANA"), ("a", "b" * 20)]
    assert values(spark, rows, both(K.levenshtein_similarity)) == [0.75, 0.0, 0.0, 1.0, 0.0]


def test_jaro_winkler_classics(spark):
    rows = [("martha", "marhta"), ("dwayne", "duane"), ("dixon", "dicksonx"), ("abcdefghij", "abzzzzzzzz"),
            (None, "x"), ("", ""), ("a", "a"), ("A", "b")]
    got = values(spark, rows, both(K.jaro_winkler_similarity))
    assert [round(x, 4) for x in got] == [0.9611, 0.84, 0.8133, 0.4667, 0.0, 0.0, 1.0, 0.0]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=40))
def test_names_agree_with_plain_python(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", both(K.levenshtein_similarity), both(K.jaro_winkler_similarity)).collect()
    for a, b, lev, jw in got:
        assert lev == pytest.approx(R.lev(a, b), abs=1e-12)
        assert jw == pytest.approx(R.jaro_winkler(a, b), abs=1e-12)
        assert -1e-12 <= jw <= 1 + 1e-12


def test_jaro_winkler_with_one_very_long_text(spark):
    rows = [("ab" * 3000, "ba" * 3000), ("maria", "mario")]
    got = values(spark, rows, both(K.jaro_winkler_similarity))
    assert got == pytest.approx([R.jaro_winkler(*r) for r in rows], abs=1e-12)


def test_dates(spark):
    d = "1985-03-15"
    rows = [(d, d), (d, "1985-03-20"), (d, "1985-07-01"), (d, "1986-03-15"), (None, d), ("", "")]
    assert values(spark, rows, both(K.date_similarity)) == [1.0, 0.8, 0.5, 0.0, 0.0, 0.0]


def test_documents(spark):
    rows = [("1", "1"), ("1", "2"), (None, "1"), ("", "")]
    assert values(spark, rows, both(K.document_match)) == [1.0, 0.0, None, 1.0]
    assert values(spark, rows, K.document_match(F.col("a"), F.col("b"), True)) == [1.0, 0.0, 0.0, 1.0]


def test_phonetic_code(spark):
    names = ["Ana Maria", "João Silva", "Ashcraft", "Érica Lima", "Erica Lima", "Conceição", " Ana", "", None, "Pfister"]
    got = values(spark, [(n, None) for n in names], K.phonetic_code(F.col("a")))
    assert got[:3] == ["A556", "J241", "A261"]
    assert got[3] == got[4]
    assert got[6] == " 500"   # a first character that is no letter is kept
    assert got[7] == "" and got[8] is None
    assert got[9] == "P236"
    assert values(spark, [("Érica", "erica"), ("", ""), (None, "a")], both(K.soundex_match)) == [1.0, 0.0, 0.0]


def test_ages(spark):
    cases = [("2000-02-29", "2025-02-28"), ("2000-02-29", "2025-03-01"), ("bad", "2025-03-01"),
             ("1985-02-30", "2025-03-01"), (None, "2025-03-01"), ("1985", "2025-03-01")]
    got = values(spark, cases, K.age_on(K.parse_date(F.col("a")), F.col("b").cast("date")))
    assert got == [24, 25, 0, 0, 0, 0]


def test_cpf(spark):
    # 529.982.247-25 and 111.444.777-35 are common examples of valid numbers.
    rows = [("52998224725", None), ("11144477735", None), ("52998224724", None), ("123", None), (None, None)]
    assert values(spark, rows, K.cpf_is_valid(F.col("a"))) == [True, True, False, False, False]


def test_match_id(spark):
    assert values(spark, [("1", "2"), (None, "2")], both(K.match_id)) == ["1_2", None]


def test_fold_table_is_one_to_one(spark):
    assert len(text._FROM) == len(text._TO)
    assert values(spark, [("ÀÉîõüÇñ Šž", None)], K.fold_accents(F.col("a"))) == ["AEiouCn Sz"]


def test_tokens(spark):
    rows = [("João D'Ávila S. Souza-Lima", None), (None, None), ("", None)]
    got = values(spark, rows, K.name_tokens(F.col("a")))
    assert got == [["joao", "d'avila", "s", "souza", "lima"], [], []]
    assert text.query_tokens("João D'Ávila S. Souza-Lima") == got[0]


WORD = st.text(alphabet="abcd", min_size=1, max_size=8)


@settings(max_examples=25, deadline=None)
@given(WORD, st.lists(WORD, min_size=1, max_size=30))
def test_fuzzy_is_bounded_edit_distance_with_swaps(spark, query, words):
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = df.select("w", K.fuzzy_any(F.array("w"), query)).collect()
    budget = {1: 0, 2: 0, 3: 1, 4: 1, 5: 1}.get(len(query), 2)
    for word, hit in got:
        assert hit == (R.edit_distance(query, word, swaps=True) <= budget), (query, word)


def test_phrase(spark):
    rows = [("Maria Souza Lima", None), ("Maria Lima Souza", None), ("Mariana Souza Lima", None)]
    test = K.has_phrase(K.name_tokens(F.col("a")), "maria SOUZA")
    assert values(spark, rows, test) == [True, False, False]


def test_sql_functions(spark):
    K.register_sql_functions(spark)
    got = spark.sql("""SELECT round(jaro_winkler('martha', 'marhta'), 4), levenshtein_similarity('João', 'Joao'),
        combined_similarity('Ana', 'ANA'), combined_similarity(NULL, 'a'), date_similarity('1985-03-15', '1985-03-20')""").first()
    assert tuple(got) == (0.9611, 0.75, 1.0, 0.0, 0.8)


def test_age_on_a_leap_day_itself(spark):
    got = values(spark, [("2000-02-29", "2024-02-29")], K.age_on(F.col("a").cast("date"), F.col("b").cast("date")))
    assert got == [date(2024, 2, 29).year - 2000]
