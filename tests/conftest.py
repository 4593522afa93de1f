import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="run-")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def persons(spark, sf):
    """Tables A and B of the fixture, as rows that are cheap to read again and again."""
    from kinlink.schema import PERSON_SCHEMA
    from workload.persons import persons_a, persons_b
    return tuple(
        spark.createDataFrame(df.collect(), PERSON_SCHEMA) for df in (persons_a(spark, sf), persons_b(spark, sf))
    )


@pytest.fixture(scope="session")
def make(spark):
    from kinlink.schema import PERSON_SCHEMA

    def build(*rows):
        return spark.createDataFrame([tuple(r) for r in rows], PERSON_SCHEMA)
    return build


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)
