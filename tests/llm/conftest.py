import pytest

from pyspark.sql import types as T

#: Nulls in every column, empty and long texts, repeated rows, ties, and columns named like those of results.
AWKWARD = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                        T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                        *(T.StructField(c, T.StringType()) for c in ("id", "score", "kept", "n_tokens", "label", "class", "component_id", "bucket"))])


@pytest.fixture(scope="session")
def awkward(spark):
    words = " ".join(f"wort{i * 7919 % 1000}" for i in range(20_000))
    line = "a passage that stands in more than one of these documents, as it is"
    rows = [(1, None), (2, ""), (3, "  \n\t\n"), (4, words), (5, words), (6, line), (6, line), (None, line), (7, "x" * 50_000), (8, line + "\n" + line), (9, "short")]
    return spark.createDataFrame([(i, t, None if i == 2 else "en", None if i == 4 else "s", None, *(["x"] * 8)) for i, t in rows], AWKWARD)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
