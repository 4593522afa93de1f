"""Command line: python -m kinlink.cli <command>. Submit with spark-submit on a cluster."""

from __future__ import annotations

import argparse
import time
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinlink.operators import search, stats
from kinlink.operators.pairing import STRATEGIES
from kinlink.operators.blocking import BLOCKS
from kinlink.operators.ranking import top_n
from kinlink.operators.scoring import MatchConfig, Weights
from kinlink.plans import match as plan, refresh, serve
from kinlink.schema import MATCH_COLUMNS, MATCH_SCHEMA
from kinlink.sources import generate, sinks, tables
from kinlink.streaming import jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinlink")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, text):
        return commands.add_parser(name, help=text)

    def matching(p):
        p.add_argument("--threshold", type=float, default=0.7)
        p.add_argument("--block", nargs="+", choices=list(BLOCKS), default=["phonetic"])
        p.add_argument("--max-age-gap", type=int, default=5)
        p.add_argument("--strategy", choices=STRATEGIES, default="auto")
        p.add_argument("--status", help="only rows with this status")
        p.add_argument("--normalize", action="store_true", help="fold accents and case in the blocking key")
        p.add_argument("--null-document", choices=["drop", "zero"], default="drop")
        p.add_argument("--weights", nargs=5, type=float, metavar=("LEV", "JARO", "SOUNDEX", "DATE", "DOCUMENT"), help="sum 1")

    p = command("match", "match two person tables")
    p.add_argument("--dataset1", required=True, help="Parquet path, or database.table with --catalog")
    p.add_argument("--dataset2", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--catalog", action="store_true")
    p.add_argument("--filter", help="condition on catalog partitions")
    p.add_argument("--max-matches", type=int, default=5)
    p.add_argument("--files", type=int, help="number of output files")
    p.add_argument("--by-score", action="store_true", help="one output folder per tenth of score")
    matching(p)

    p = command("refresh", "match again when input files changed")
    for name in ("--dataset1", "--dataset2", "--state", "--output"):
        p.add_argument(name, required=True)
    p.add_argument("--previous", help="output of the last run: match new files only")
    matching(p)

    p = command("stream", "match the files that arrive in a folder; what is there is taken, then it stops")
    p.add_argument("--arrivals", required=True, help="folder of new Parquet files")
    p.add_argument("--known", required=True, help="person table to match against")
    p.add_argument("--output", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--max-files", type=int, help="files in one batch")
    p.add_argument("--serve", action="store_true", help="write each batch as a load of a served table")
    p.add_argument("--as-of", type=date.fromisoformat, default=None)
    matching(p)

    p = command("names", "search names in a person table or in matches")
    p.add_argument("--name", required=True)
    p.add_argument("--dataset")
    p.add_argument("--matches")
    p.add_argument("--top", type=int, default=10)
    p.add_argument("--threshold", type=float, default=0.5)
    p.add_argument("--no-blocking", action="store_true")

    p = command("serve", "load matches into the served table")
    p.add_argument("--matches", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    p.add_argument("--batch-size", type=int, default=10000)
    p.add_argument("--load", type=int, default=0)
    p.add_argument("--as-of", type=date.fromisoformat, default=None)

    p = command("search", "search the served table")
    p.add_argument("--table", required=True)
    p.add_argument("--document")
    p.add_argument("--name")
    p.add_argument("--phrase", action="store_true")
    p.add_argument("--min-score", type=float)
    p.add_argument("--age-min", type=int)
    p.add_argument("--age-max", type=int)
    p.add_argument("--stats", action="store_true")
    p.add_argument("--top", type=int)

    p = command("generate", "generate two person tables with overlap and noise")
    p.add_argument("--records", type=int, default=10000)
    p.add_argument("--overlap", type=float, default=0.3)
    p.add_argument("--variations", type=float, default=0.3)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--output", required=True)
    return top


def _config(args, **more) -> MatchConfig:
    return MatchConfig(
        threshold=args.threshold, blocks=tuple(args.block), max_age_gap=args.max_age_gap,
        strategy=args.strategy, status=args.status, normalize=args.normalize, null_document=args.null_document,
        weights=Weights(*args.weights) if args.weights else Weights(), **more,
    )


def _read(spark: SparkSession, args, name: str) -> DataFrame:
    if not args.catalog:
        return tables.read_persons(spark, name)
    database, table = name.split(".", 1)
    return tables.read_catalog_table(spark, database, table, args.filter)


def run_match(spark: SparkSession, args) -> DataFrame:
    start = time.perf_counter()
    cfg = _config(args, max_matches=args.max_matches)
    found = plan.match(_read(spark, args, args.dataset1), _read(spark, args, args.dataset2), cfg)
    if args.by_score:
        sinks.write_by_score_band(found, args.output)
    else:
        sinks.write_matches(found, args.output, args.files)
    done = spark.read.schema(MATCH_SCHEMA).parquet(args.output)
    report = stats.run_report(time.perf_counter() - start, done)
    top_n(done, 10, F.desc("similarity_score"), *[F.col(c) for c in MATCH_COLUMNS]).show(10, truncate=False)
    return report


def run_refresh(spark: SparkSession, args) -> DataFrame:
    if args.previous is not None:
        output = refresh.refresh_increment(
            spark, args.dataset1, args.dataset2, args.state, args.previous, args.output, _config(args))
    else:
        output = refresh.refresh(spark, args.dataset1, args.dataset2, args.state, args.output, _config(args))
    return spark.createDataFrame([(output is not None, output)], "changed boolean, output string")


def run_stream(spark: SparkSession, args) -> DataFrame:
    new, known = jobs.stream_files(spark, args.arrivals, max_files=args.max_files), tables.read_persons(spark, args.known)
    if args.serve:
        as_of = args.as_of or datetime.now(timezone.utc).date()
        jobs.match_arrivals(new, known, args.output, args.checkpoint, _config(args), as_of)
        found = serve.read_served(spark, args.output)
    else:
        jobs.match_batches(new, known, args.output, args.checkpoint, _config(args))
        found = jobs.read_batches(spark, args.output)
    return found.agg(F.count("*").alias("matches"))


def run_names(spark: SparkSession, args) -> DataFrame:
    if args.matches is not None:
        return search.search_in_matches(tables.read_matches(spark, args.matches), args.name, args.top, args.threshold)
    if args.dataset is None:
        raise SystemExit("give --dataset or --matches")
    return search.search_similar_names(
        tables.read_persons(spark, args.dataset), args.name, args.top, args.threshold, not args.no_blocking)


def run_serve(spark: SparkSession, args) -> DataFrame:
    as_of = args.as_of or datetime.now(timezone.utc).date()
    docs = serve.served_documents(tables.read_matches(spark, args.matches), as_of, datetime.now(timezone.utc))
    written, rejected = serve.load_served(docs, args.table, args.mode, args.batch_size, args.load)
    return spark.createDataFrame([(written, rejected)], "written long, rejected long")


def run_search(spark: SparkSession, args) -> DataFrame:
    table = serve.read_served(spark, args.table)
    top = {} if args.top is None else {"top": args.top}
    if args.stats:
        stats.score_histogram(table).show(11)
        return stats.match_stats(table)
    if args.document is not None:
        return search.search_by_document(table, args.document, min_score=args.min_score, **top)
    if args.name is not None:
        return search.search_by_name(
            table, args.name, fuzzy=not args.phrase, min_score=args.min_score, **top)
    if args.age_min is not None and args.age_max is not None:
        return search.search_by_age_range(table, args.age_min, args.age_max, min_score=args.min_score, **top)
    if args.min_score is not None:
        return search.search_high_quality(table, args.min_score, **top)
    raise SystemExit("give at least one search criterion")


def run_generate(spark: SparkSession, args) -> DataFrame:
    cfg = generate.GeneratorConfig(args.overlap, args.variations, args.seed)
    for name, persons in zip(("dataset1", "dataset2"), generate.generate_pair(spark, args.records, cfg)):
        path = f"{args.output}/{name}"
        sinks.write_persons(generate.with_stored_key(generate.shuffled(persons, args.seed)), path)
        sinks.write_csv_sample(spark.read.parquet(path), f"{args.output}/{name}_sample", "nr_documento")
    return spark.read.parquet(f"{args.output}/dataset1").limit(5)


RUN = {"match": run_match, "refresh": run_refresh, "stream": run_stream, "names": run_names, "serve": run_serve,
       "search": run_search, "generate": run_generate}


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"kinlink-{args.command}").getOrCreate()
    RUN[args.command](spark, args).show(100, truncate=False)


if __name__ == "__main__":
    main()
