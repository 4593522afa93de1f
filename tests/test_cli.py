"""The command line from generated tables to a search."""

import pytest

from kinlink import cli
from kinlink.plans.serve import read_served


def run(spark, *argv):
    args = cli.parser().parse_args([str(a) for a in argv])
    return [r.asDict() for r in cli.RUN[args.command](spark, args).collect()]


def test_from_generated_tables_to_a_search(spark, folder):
    run(spark, "generate", "--records", 400, "--output", folder)
    a, b = f"{folder}/dataset1", f"{folder}/dataset2"
    report, = run(spark, "match", "--dataset1", a, "--dataset2", b, "--output", f"{folder}/m")
    assert report["matches"] == spark.read.parquet(f"{folder}/m").count() > 50
    person = spark.read.parquet(a).first()
    hits = run(spark, "names", "--dataset", a, "--name", person["nome_completo"])
    assert hits[0]["similarity"] == 1.0
    assert run(spark, "names", "--matches", f"{folder}/m", "--name", person["nome_completo"].split()[0], "--threshold", 0.1)
    loaded, = run(spark, "serve", "--matches", f"{folder}/m", "--table", f"{folder}/t", "--as-of", "2025-06-30")
    assert loaded == {"written": read_served(spark, f"{folder}/t").count(), "rejected": 0}
    document = read_served(spark, f"{folder}/t").first()["nr_documento_1"]
    assert run(spark, "search", "--table", f"{folder}/t", "--document", document)
    assert len(run(spark, "search", "--table", f"{folder}/t", "--min-score", 0, "--top", 7)) == 7
    assert run(spark, "search", "--table", f"{folder}/t", "--age-min", 0, "--age-max", 120)
    assert run(spark, "search", "--table", f"{folder}/t", "--stats")[0]["age_diff_count"] == loaded["written"]
    refresh = ("refresh", "--dataset1", a, "--dataset2", b, "--state", f"{folder}/s", "--output", f"{folder}/r")
    assert run(spark, *refresh)[0]["changed"] and not run(spark, *refresh)[0]["changed"]


def test_options_of_a_match_and_a_stream(spark, folder):
    run(spark, "generate", "--records", 200, "--output", folder)
    a, b = f"{folder}/dataset1", f"{folder}/dataset2"
    batch, = run(spark, "match", "--dataset1", a, "--dataset2", b, "--output", f"{folder}/m", "--max-matches", 1000)
    for more in ((), ("--serve", "--as-of", "2025-06-30")):
        done, = run(spark, "stream", "--arrivals", a, "--known", b, "--output", f"{folder}/s{len(more)}", "--checkpoint", f"{folder}/c{len(more)}", *more)
        assert done["matches"] == batch["matches"] > 0
    some, = run(spark, "match", "--dataset1", a, "--dataset2", b, "--output", f"{folder}/n", "--status", "Ativo", "--normalize", "--null-document", "zero",
                "--weights", 0.2, 0.2, 0.2, 0.2, 0.2)
    assert some["matches"] < batch["matches"]
    assert {r["status_1"] for r in spark.read.parquet(f"{folder}/n").collect()} == {"Ativo"}
    with pytest.raises(ValueError):
        run(spark, "match", "--dataset1", a, "--dataset2", b, "--output", f"{folder}/n", "--weights", 1, 1, 0, 0, 0)


def test_missing_criteria_are_refused(spark, folder):
    with pytest.raises(SystemExit):
        run(spark, "names", "--name", "Ana")
