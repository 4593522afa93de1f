import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from kinlink.operators.blocking import add_blocking_key, block_skew_report
from kinlink.operators.scoring import MatchConfig
from kinlink.plans.match import match
from kinlink.plans.refresh import refresh, refresh_increment
from kinlink.schema import MATCH_SCHEMA, PERSON_SCHEMA
from kinlink.sources import files, sinks, tables
from kinlink.sources.scratch import scratch_path, written
from tests.conftest import rows


def at(minute):
    return datetime(2025, 1, 1, 0, minute, tzinfo=timezone.utc)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_score_bands_prune(spark, persons, folder):
    found = match(*persons)
    sinks.write_by_score_band(found, f"{folder}/m")
    assert set(os.listdir(f"{folder}/m")) <= {f"score_band={b}" for b in ("0.7", "0.8", "0.9", "1.0")} | {"_SUCCESS", "._SUCCESS.crc"}
    part = spark.read.parquet(f"{folder}/m").where("score_band = 1.0")
    assert "PartitionFilters: [isnotnull(score_band" in plan(part)
    assert part.count() == found.where("similarity_score >= 1.0").count()


def test_key_prefix_folders_and_file_size(spark, persons, folder):
    keyed = add_blocking_key(persons[0], "phonetic")
    sinks.write_by_key_prefix(keyed, f"{folder}/p", max_records=5)
    assert rows(spark.read.parquet(f"{folder}/p").select(*keyed.columns)) == rows(keyed)
    sizes = spark.read.parquet(f"{folder}/p").groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert sizes <= 5


def test_number_of_files(spark, persons, folder):
    sinks.write_matches(match(*persons), f"{folder}/m", files=10)
    parts = [f for f in os.listdir(f"{folder}/m") if f.endswith(".parquet")]
    assert len(parts) <= 10 and rows(tables.read_matches(spark, f"{folder}/m")) == rows(match(*persons))


def test_csv_and_json(spark, persons, folder):
    sinks.write_csv_sample(persons[0], f"{folder}/c", "nr_documento")
    assert spark.read.option("header", True).csv(f"{folder}/c").count() == 100
    sinks.write_json_lines(match(*persons), f"{folder}/j")
    assert rows(sinks.read_json_lines(spark, f"{folder}/j", MATCH_SCHEMA)) == rows(match(*persons))


def test_catalog_and_schema_changes(spark, persons, folder):
    a, _ = persons
    a.write.partitionBy("status").parquet(f"{folder}/v1")
    tables.register_table(spark, "default.people", f"{folder}/v1", PERSON_SCHEMA, ("status",))
    try:
        got = tables.read_catalog_table(spark, "default", "people", "status = 'Ativo'")
        assert rows(got) == rows(a.where("status = 'Ativo'")) and "PartitionFilters: [isnotnull(status" in plan(got)
        a.drop("nr_documento").withColumn("email", F.lit("x")).write.parquet(f"{folder}/v2")
        assert tables.evolve_table(spark, "default.people", f"{folder}/v2") == (["email"], ["nr_documento"])
        assert "email" in spark.table("default.people").columns
    finally:
        spark.sql("DROP TABLE default.people")


def test_schema_merge(spark, persons, folder):
    a, _ = persons
    sinks.write_persons(a.drop("status"), f"{folder}/v=1")
    sinks.write_persons(a, f"{folder}/v=2")
    got = tables.read_merged(spark, folder)
    assert got.count() == 2 * a.count() and got.where("status IS NULL").count() == a.count()


def test_listing_reads_no_content_and_checksum_sees_it(spark, persons, folder):
    sinks.write_persons(persons[0].coalesce(1), f"{folder}/d")
    listing = files.list_files(spark, f"{folder}/d", "*.parquet")
    assert "content" not in plan(listing).split("ReadSchema")[-1]
    path = listing.first()["path"].replace("file:", "", 1)
    before, sums = listing.collect(), files.list_files(spark, f"{folder}/d", "*.parquet", checksum=True).collect()
    os.utime("/" + path.lstrip("/"), (1, 1))
    assert files.list_files(spark, f"{folder}/d", "*.parquet").collect() != before
    assert files.list_files(spark, f"{folder}/d", "*.parquet", checksum=True).first()["etag"] == sums[0]["etag"]


def metadata(spark, *entries):
    return spark.createDataFrame(
        [("d", p, 1, "t", e) for p, e in entries], "dataset_id string, path string, size long, last_modified string, etag string")


def test_fingerprint_ignores_order_and_sees_every_change(spark):
    hash_of = lambda df: files.dataset_fingerprint(df).first()["metadata_hash"]
    base = hash_of(metadata(spark, ("a", "1"), ("b", "2")))
    assert base == hash_of(metadata(spark, ("b", "2"), ("a", "1")).repartition(3))
    assert len({base, hash_of(metadata(spark, ("a", "1"))), hash_of(metadata(spark, ("a", "2"), ("b", "1"))),
                hash_of(metadata(spark, ("a", "1"), ("b", "3")))}) == 4


def test_changed_and_deleted(spark):
    now, then = metadata(spark, ("a", "1"), ("b", "9"), ("c", "3")), metadata(spark, ("a", "1"), ("b", "2"), ("x", "0"))
    got = {r["path"]: r["change"] for r in files.changed_files(now, then).collect()}
    assert got == {"b": "modified", "c": "new"}
    assert [r["path"] for r in files.deleted_files(now, then).collect()] == ["x"]


def test_state_counts_only_when_committed(spark, folder):
    assert files.latest_heads(spark, folder).count() == 0 and files.previous_files(spark, folder).count() == 0
    run, kept = files.stage_listing(spark, folder, metadata(spark, ("a", "1")))
    assert kept.count() == 1 and files.previous_files(spark, folder).count() == 0
    files.commit_state(spark, folder, run, at(1))
    assert [r["path"] for r in files.previous_files(spark, folder).collect()] == ["a"]
    run, _ = files.stage_listing(spark, folder, metadata(spark, ("b", "1")))
    files.commit_state(spark, folder, run, at(2))
    assert [r["path"] for r in files.previous_files(spark, folder).collect()] == ["b"]


def test_refresh_and_increment(spark, persons, folder):
    a, b = persons
    n = F.col("nr_documento").cast("long")
    p1, p2, state, out = (f"{folder}/{x}" for x in ("a", "b", "state", "out"))
    sinks.write_persons(a.where(n % 3 > 0), p1)
    sinks.write_persons(b, p2)
    first = refresh(spark, p1, p2, state, out, at=at(1))
    assert rows(tables.read_matches(spark, first)) == rows(match(a.where(n % 3 > 0), b))
    assert refresh(spark, p1, p2, state, out, at=at(2)) is None
    assert refresh_increment(spark, p1, p2, state, first, out, at=at(2)) is None
    a.where(n % 3 == 0).write.mode("append").parquet(p1)
    second = refresh_increment(spark, p1, p2, state, first, out, at=at(3))
    assert rows(tables.read_matches(spark, second)) == rows(match(a, b))
    sinks.write_persons(b.where(n % 2 == 0), p2)   # the former files are gone: a full run
    third = refresh_increment(spark, p1, p2, state, second, out, at=at(4))
    assert rows(tables.read_matches(spark, third)) == rows(match(a, b.where(n % 2 == 0)))


def test_increment_shuffles_only_what_it_found(spark, persons, folder, monkeypatch):
    from kinlink.plans import refresh as module
    p1, p2, state, out = (f"{folder}/{n}" for n in ("a", "b", "state", "out"))
    a, b = persons
    early = F.col("nr_documento").cast("long") % 3 > 0
    sinks.write_persons(a.where(early), p1)
    sinks.write_persons(b, p2)
    first = refresh(spark, p1, p2, state, out, at=at(1))
    a.where(~early).write.mode("append").parquet(p1)
    seen = []
    monkeypatch.setattr(module, "write_matches", lambda df, *rest, **how: (seen.append((df, how)), sinks.write_matches(df, *rest, **how)))
    second = refresh_increment(spark, p1, p2, state, first, out, at=at(2))
    (df, how), = seen
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    assert how == {"even": False} and logical.count("RebalancePartitions") == 1
    assert logical.index("Union") < logical.index("RebalancePartitions")
    assert rows(tables.read_matches(spark, second)) == rows(match(a, b))


def test_failed_run_is_tried_again(spark, persons, folder, monkeypatch):
    from kinlink.plans import refresh as module
    sinks.write_persons(persons[0], f"{folder}/a")
    monkeypatch.setattr(module, "write_matches", lambda *_: (_ for _ in ()).throw(IOError("disk")))
    with pytest.raises(IOError):
        refresh(spark, f"{folder}/a", f"{folder}/a", f"{folder}/s", f"{folder}/o", at=at(1))
    monkeypatch.undo()
    assert refresh(spark, f"{folder}/a", f"{folder}/a", f"{folder}/s", f"{folder}/o", MatchConfig(0.9), at=at(2))


def test_skew_report_shows_the_empty_block(make):
    a = make(*[(None, None, str(i), None) for i in range(5)], ("Maria", "1985-01-01", "9", None))
    keyed = add_blocking_key(a)
    got = block_skew_report(keyed, keyed).first()
    assert (got["blocking_key"], got["pairs"]) == ("", 25)


def test_scratch_uses_the_folder_the_cluster_names(spark, folder):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert scratch_path(spark, "x").startswith(before.rstrip("/"))
    df = written(spark.range(5), "numbers")
    assert df.count() == 5


def test_listed_files_are_all_read(spark, persons, folder):
    from kinlink.sources import files, tables
    a = persons[0]
    root = f"{folder}/in put"
    for part, where in enumerate(("", "/sub", "/sub/day=2024-01-01 00%3A00")):
        a.where(f"pmod(hash(nr_documento), 3) = {part}").coalesce(1).write.mode("append").parquet(f"{root}{where}")
    listed = files.list_files(spark, root, "*.parquet")
    stored = spark.createDataFrame(listed.collect(), listed.schema)
    assert stored.count() == 3
    assert sorted(map(str, tables.rows_of_files(spark, root, stored).collect())) == sorted(map(str, a.collect()))
    one = stored.where("path LIKE '%/sub/part%'")
    assert tables.rows_of_files(spark, root, one).count() == a.where("pmod(hash(nr_documento), 3) = 1").count()
    assert tables.rows_of_files(spark, root, stored.where("false")).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.rows_of_files(spark, root, stored.withColumn("path", F.concat("path", F.lit("x"))))
