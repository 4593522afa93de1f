"""The registered queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinlink.functions import cpf_check_digits, register_sql_functions
from kinlink.operators import blocking, curves, entities, graphs, learning, linkage, lsh, metric, pairing, quality, search, stats
from kinlink.operators.ranking import sort_matches, top_n
from kinlink.operators.scoring import MatchConfig
from kinlink.plans import match as plan, name_index, refresh, serve, store
from kinlink.schema import MATCH_COLUMNS, MATCH_SCHEMA, PERSON_SCHEMA
from kinlink.sources import files, generate, sinks, tables
from kinlink.sources.scratch import scratch_path, written
from kinlink.streaming import jobs
from workload import oracle as sql
from workload.persons import persons_a, persons_b, read, with_gaps

QUERIES: dict[str, object] = {}
ORACLE: dict[str, str] = {}

# Scores are rounded before the threshold, on both sides: the engines differ in the last bit.
ROUNDED = MatchConfig(score_digits=9)
PHONETIC = MatchConfig(score_digits=9, blocks=("phonetic",), max_age_gap=5)
AS_OF = date(2025, 6, 30)
NAME, DOCUMENT = "Belmina Drumelo Hortelano", "00004306234"


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return add


def both(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return persons_a(spark, d), persons_b(spark, d)


def prefix_matches(spark: SparkSession, d: str) -> DataFrame:
    return plan.match(*both(spark, d), ROUNDED)


def served(spark: SparkSession, d: str) -> DataFrame:
    """The served table as a search sees it, without the time stamp."""
    return serve.served_matches(*both(spark, d), AS_OF, ROUNDED).drop("indexed_at")


# --- matching ---------------------------------------------------------------------------------

PREFIX_SQL = sql.base(sql.matches(sql.BY_PREFIX)) + "\nSELECT * FROM m"


@query("match_phonetic_block",
       sql.base(sql.matches(f"{sql.BY_PHONETIC} AND {sql.AGE_GAP}")) + "\nSELECT * FROM m")
def match_phonetic_block(spark, d):
    return plan.match(*both(spark, d), PHONETIC)


@query("match_prefix_block", PREFIX_SQL)
def match_prefix_block(spark, d):
    return sort_matches(prefix_matches(spark, d))


@query("match_salted", PREFIX_SQL)
def match_salted(spark, d):
    # Budgets far below the defaults, so that keys count as hot at test size as well.
    skew = pairing.SkewConfig(pair_budget=20, slice_rows=3)
    cfg = MatchConfig(score_digits=9, strategy="salted", skew=skew)
    return plan.match(*both(spark, d), cfg)


@query("match_broadcast", PREFIX_SQL)
def match_broadcast(spark, d):
    return plan.match(*both(spark, d), MatchConfig(score_digits=9, strategy="broadcast"))


@query("match_shuffle_hash", PREFIX_SQL)
def match_shuffle_hash(spark, d):
    return plan.match(*both(spark, d), MatchConfig(score_digits=9, strategy="shuffle_hash"))


@query("match_top_k_per_record", sql.base(sql.matches(sql.BY_PREFIX, 0.5)) + f"""
SELECT {sql.MATCH} FROM (SELECT *, row_number() OVER (PARTITION BY nr_documento_1
    ORDER BY similarity_score DESC, nr_documento_2) AS r FROM m) WHERE r <= 2""")
def match_top_k_per_record(spark, d):
    return plan.match(*both(spark, d), MatchConfig(threshold=0.5, score_digits=9, max_matches=2))


@query("match_status_filtered", sql.base(
    sql.matches(sql.BY_PREFIX + " AND a.status = 'Ativo' AND b.status = 'Ativo'")) + "\nSELECT * FROM m")
def match_status_filtered(spark, d):
    return plan.match(*both(spark, d), MatchConfig(score_digits=9, status="Ativo"))


@query("match_null_documents", sql.base(
    sql.gaps_sql("a", "ga"), sql.gaps_sql("b", "gb"),
    sql.matches(sql.BY_PREFIX, 0.5, "ga", "gb")) + "\nSELECT * FROM m")
def match_null_documents(spark, d):
    a, b = both(spark, d)
    return plan.match(with_gaps(a), with_gaps(b), MatchConfig(threshold=0.5, score_digits=9))


@query("match_missing_document_as_zero", sql.base(
    sql.gaps_sql("a", "ga"), sql.gaps_sql("b", "gb"),
    sql.matches(sql.BY_PREFIX, 0.6, "ga", "gb").replace(
        "(nr_documento_1 = nr_documento_2)::DOUBLE", "coalesce((nr_documento_1 = nr_documento_2)::DOUBLE, 0)")
) + "\nSELECT * FROM m")
def match_missing_document_as_zero(spark, d):
    a, b = both(spark, d)
    cfg = MatchConfig(threshold=0.6, score_digits=9, null_document="zero")
    return plan.match(with_gaps(a), with_gaps(b), cfg)


@query("match_multi_pass", sql.base(
    sql.matches(f"({sql.BY_PREFIX}) OR ({sql.BY_PHONETIC})")) + "\nSELECT * FROM m")
def match_multi_pass(spark, d):
    return plan.match(*both(spark, d), MatchConfig(score_digits=9, blocks=("prefix", "phonetic")))


@query("match_two_level_keys", sql.base(sql.matches(
    "substr(a.data_nascimento, 1, 4) = substr(b.data_nascimento, 1, 4) "
    "AND substr(a.nome_completo, 1, 1) = substr(b.nome_completo, 1, 1)")) + "\nSELECT * FROM m")
def match_two_level_keys(spark, d):
    return plan.match(*both(spark, d), MatchConfig(score_digits=9, blocks=("year_prefix",)))


@query("match_normalized_keys", sql.base(sql.matches(
    "upper(substr(a.nome_completo, 1, 3)) = upper(substr(b.nome_completo, 1, 3)) "
    "AND substr(a.data_nascimento, 1, 4) = substr(b.data_nascimento, 1, 4)")) + "\nSELECT * FROM m")
def match_normalized_keys(spark, d):
    return plan.match(*both(spark, d), MatchConfig(score_digits=9, normalize=True))


@query("candidate_pairs_age_filter", sql.base() + f"""
SELECT {sql.PAIR_COLUMNS}, {sql.prefix('a')} AS blocking_key
FROM a JOIN b ON {sql.BY_PREFIX} AND {sql.AGE_GAP}""")
def candidate_pairs_age_filter(spark, d):
    return plan.candidate_pairs(*both(spark, d), MatchConfig(max_age_gap=5))


@query("scores_all_components", sql.base(sql.scored(sql.BY_PREFIX)) + f"""
SELECT {sql.MATCH}, name_soundex_score, doc_match FROM scored""")
def scores_all_components(spark, d):
    return plan.scored_pairs(*both(spark, d), ROUNDED).select(
        *MATCH_COLUMNS, "name_soundex_score", "doc_match"
    )


@query("sql_functions", sql.base(sql.scored(sql.BY_PREFIX)) + """
SELECT nr_documento_1, nr_documento_2, name_jaro_score AS jw, name_lev_score AS lev, date_score AS dt FROM scored""")
def sql_functions(spark, d):
    register_sql_functions(spark)
    pairs = plan.candidate_pairs(*both(spark, d))
    return pairs.selectExpr(
        "nr_documento_1", "nr_documento_2",
        "round(jaro_winkler(lower(nome_completo_1), lower(nome_completo_2)), 9) AS jw",
        "round(levenshtein_similarity(nome_completo_1, nome_completo_2), 9) AS lev",
        "date_similarity(data_nascimento_1, data_nascimento_2) AS dt",
    )


@query("block_keys_distinct", sql.base() + f"\nSELECT DISTINCT {sql.phonetic('a')} AS blocking_key FROM a")
def block_keys_distinct(spark, d):
    return blocking.distinct_block_keys(blocking.add_blocking_key(persons_a(spark, d), "phonetic"))


@query("block_skew_report", sql.base(
    sql.gaps_sql("a", "ga"), sql.gaps_sql("b", "gb"),
    f"ca AS (SELECT {sql.prefix('ga')} AS blocking_key, count(*) AS n FROM ga GROUP BY 1)",
    f"cb AS (SELECT {sql.prefix('gb')} AS blocking_key, count(*) AS n FROM gb GROUP BY 1)") + """
SELECT coalesce(ca.blocking_key, cb.blocking_key) AS blocking_key, coalesce(ca.n, 0) AS n1,
    coalesce(cb.n, 0) AS n2, coalesce(ca.n, 0) * coalesce(cb.n, 0) AS pairs
FROM ca FULL JOIN cb ON ca.blocking_key = cb.blocking_key
ORDER BY pairs DESC, n1 DESC, blocking_key LIMIT 20""")
def block_skew_report(spark, d):
    keyed = [blocking.add_blocking_key(with_gaps(p)) for p in both(spark, d)]
    return blocking.block_skew_report(*keyed)


NEW_A, NEW_B = "CAST(nr_documento_1 AS BIGINT) % 7 = 0", "CAST(nr_documento_2 AS BIGINT) % 5 = 0"


@query("incremental_match", PREFIX_SQL + f" WHERE {NEW_A} OR {NEW_B}")
def incremental_match(spark, d):
    a, b = both(spark, d)
    n = F.col("nr_documento").cast("long")
    return plan.incremental_match(
        a.where(n % 7 != 0), a.where(n % 7 == 0), b.where(n % 5 != 0), b.where(n % 5 == 0), ROUNDED
    )


@query("incremental_merge", PREFIX_SQL)
def incremental_merge(spark, d):
    a, b = both(spark, d)
    n = F.col("nr_documento").cast("long")
    before = plan.match(a.where(n % 7 != 0), b.where(n % 5 != 0), ROUNDED)
    return plan.merge_increment(before, incremental_match(spark, d))


# --- search -----------------------------------------------------------------------------------

def _similar(where: str) -> str:
    return sql.base() + f"""
SELECT nome_completo, data_nascimento, nr_documento, similarity FROM (
    SELECT *, {sql.combined(f"'{NAME}'", 'nome_completo')} AS similarity FROM a {where})
WHERE similarity >= 0.5 ORDER BY similarity DESC, nr_documento LIMIT 10"""


@query("name_search_phonetic", _similar(f"WHERE {sql.soundex('nome_completo')} = {sql.soundex(repr(NAME))}"))
def name_search_phonetic(spark, d):
    return search.search_similar_names(persons_a(spark, d), NAME, score_digits=9)


@query("name_search_full", _similar(""))
def name_search_full(spark, d):
    return search.search_similar_names(persons_a(spark, d), NAME, use_blocking=False, score_digits=9)


@query("name_search_matches", sql.base(sql.matches(sql.BY_PREFIX), f"""
s AS (SELECT *, {sql.combined(f"'{NAME}'", 'nome_completo_1')} AS s1,
    {sql.combined(f"'{NAME}'", 'nome_completo_2')} AS s2 FROM m)""") + """
SELECT CASE WHEN s1 >= s2 THEN nome_completo_1 ELSE nome_completo_2 END AS matched_name,
    CASE WHEN s1 >= s2 THEN nome_completo_2 ELSE nome_completo_1 END AS other_name,
    similarity_score, greatest(s1, s2) AS best_similarity
FROM s WHERE greatest(s1, s2) >= 0.5
ORDER BY best_similarity DESC, similarity_score DESC, nr_documento_1, nr_documento_2 LIMIT 10""")
def name_search_matches(spark, d):
    return search.search_in_matches(prefix_matches(spark, d), NAME, score_digits=9)


@query("name_search_batch", sql.base(f"""
hits AS (SELECT b.nr_documento AS query_id, b.nome_completo AS query_name, a.nome_completo,
    a.data_nascimento, a.nr_documento, {sql.combined('b.nome_completo', 'a.nome_completo')} AS similarity
    FROM b JOIN a ON {sql.soundex('b.nome_completo')} = {sql.soundex('a.nome_completo')})""") + """
SELECT query_id, query_name, nome_completo, data_nascimento, nr_documento, similarity FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, nr_documento) AS r
    FROM hits WHERE similarity >= 0.8) WHERE r <= 3""")
def name_search_batch(spark, d):
    asked = persons_b(spark, d).selectExpr("nr_documento AS query_id", "nome_completo AS query_name")
    return search.search_names_batch(asked, persons_a(spark, d), top=3, threshold=0.8, score_digits=9)


@query("served_documents", sql.SERVED + "\nSELECT * FROM served")
def served_documents(spark, d):
    return served(spark, d)


def _hits(where: str, top: int) -> str:
    return sql.SERVED + f"\nSELECT * FROM served WHERE {where} ORDER BY similarity_score DESC, match_id LIMIT {top}"


@query("search_document", _hits(f"nr_documento_1 = '{DOCUMENT}' OR nr_documento_2 = '{DOCUMENT}'", 10))
def search_document(spark, d):
    return search.search_by_document(served(spark, d), DOCUMENT)


@query("search_document_min_score", _hits(
    f"(nr_documento_1 = '{DOCUMENT}' OR nr_documento_2 = '{DOCUMENT}') AND similarity_score >= 0.9", 10))
def search_document_min_score(spark, d):
    return search.search_by_document(served(spark, d), DOCUMENT, min_score=0.9)


@query("search_document_batch", sql.SERVED + f"""
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY document
    ORDER BY similarity_score DESC, match_id) AS r FROM (
        SELECT nr_documento_1 AS document, * FROM served WHERE nr_documento_1 IN (SELECT nr_documento FROM b)
        UNION SELECT nr_documento_2, * FROM served)) WHERE r <= 10""")
def search_document_batch(spark, d):
    asked = persons_b(spark, d).select(F.col("nr_documento").alias("document"))
    return search.search_documents_batch(asked, served(spark, d))


# "Blemina" needs a swap, "Hortelanno" one letter less.
FUZZY, FUZZY_WORDS = "Blemina Hortelanno", [("blemina", 2), ("hortelanno", 2)]


@query("search_name_fuzzy", _hits(
    " OR ".join(sql.fuzzy(f"nome_completo_{n}", FUZZY_WORDS) for n in (1, 2)), 10))
def search_name_fuzzy(spark, d):
    return search.search_by_name(served(spark, d), FUZZY)


@query("search_name_phrase", _hits(
    " OR ".join(sql.phrase(f"nome_completo_{n}", "drumelo hortelano") for n in (1, 2)), 10))
def search_name_phrase(spark, d):
    return search.search_by_name(served(spark, d), "Drumelo Hortelano", fuzzy=False)


def stored(spark: SparkSession, d: str, buckets: int = 8) -> store.Store:
    """A store of two loads: some matches under other scores and names first, then all as they are."""
    place = store.Store(scratch_path(spark, "store"), buckets)
    docs = written(serve.served_documents(prefix_matches(spark, d), AS_OF), "served")   # both loads come from one run of the matching
    some = F.crc32(F.col("match_id").cast("binary")) % 2 == 0
    store.add_load(spark, place, docs.where(some).withColumns({"similarity_score": F.lit(1.0), "nome_completo_1": F.lit("Belmina Old")}), 1)
    store.add_load(spark, place, docs, 2)
    return place


def indexed(spark: SparkSession, d: str) -> tuple[store.Store, name_index.NameIndex]:
    place = stored(spark, d)
    index = name_index.NameIndex(scratch_path(spark, "names"), 16)
    name_index.build_name_index(store.read_store(spark, place), index)
    return place, index


@query("store_two_loads", sql.SERVED + "\nSELECT * FROM served")
def store_two_loads(spark, d):
    return store.read_store(spark, stored(spark, d)).drop("indexed_at")


@query("store_lookup", _hits(f"nr_documento_1 = '{DOCUMENT}' OR nr_documento_2 = '{DOCUMENT}'", 10))
def store_lookup(spark, d):
    return store.search_store(spark, stored(spark, d), DOCUMENT).drop("indexed_at")


@query("store_lookup_batch", sql.SERVED + """
SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY document
    ORDER BY similarity_score DESC, match_id) AS r FROM (
        SELECT nr_documento_1 AS document, * FROM served WHERE nr_documento_1 IN (SELECT nr_documento FROM b)
        UNION SELECT nr_documento_2, * FROM served)) WHERE r <= 10""")
def store_lookup_batch(spark, d):
    asked = persons_b(spark, d).select(F.col("nr_documento").alias("document"))
    return store.search_store_batch(spark, stored(spark, d), asked).drop("indexed_at")


@query("indexed_name_fuzzy", _hits(
    " OR ".join(sql.fuzzy(f"nome_completo_{n}", FUZZY_WORDS) for n in (1, 2)), 10))
def indexed_name_fuzzy(spark, d):
    return name_index.search_indexed(spark, *indexed(spark, d), FUZZY).drop("indexed_at")


@query("indexed_name_phrase", _hits(
    " OR ".join(sql.phrase(f"nome_completo_{n}", "drumelo hortelano") for n in (1, 2)), 10))
def indexed_name_phrase(spark, d):
    return name_index.search_indexed(spark, *indexed(spark, d), "Drumelo Hortelano", fuzzy=False).drop("indexed_at")


@query("indexed_name_batch", sql.SERVED + sql.INDEXED_WORDS + """
SELECT query_id, match_id, similarity_score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity_score DESC, match_id) AS r
FROM (SELECT DISTINCT query_id, match_id, similarity_score FROM asked JOIN near USING (word) JOIN places USING (token))) WHERE r <= 3""")
def indexed_name_batch(spark, d):
    """The three best matches with a word near to one of the name, for every name of table B."""
    asked = persons_b(spark, d).selectExpr("nr_documento AS query_id", "nome_completo AS query_name")
    found = name_index.search_indexed_batch(spark, *indexed(spark, d), asked, top=3)
    return found.select("query_id", "match_id", "similarity_score")


@query("indexed_phrase_batch", sql.SERVED + sql.INDEXED_PHRASES + """
SELECT query_id, match_id, similarity_score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity_score DESC, match_id) AS r
FROM (SELECT DISTINCT query_id, match_id, similarity_score FROM asked JOIN names ON contains(words, phrase))) WHERE r <= 3""")
def indexed_phrase_batch(spark, d):
    """The three best matches with the last two words of the name side by side, for every name of table B."""
    words = F.regexp_extract("nome_completo", r"(\w+ \w+)$", 1)
    asked = persons_b(spark, d).select(F.col("nr_documento").alias("query_id"), words.alias("query_name"))
    found = name_index.search_indexed_batch(spark, *indexed(spark, d), asked, top=3, fuzzy=False)
    return found.select("query_id", "match_id", "similarity_score")


@query("search_min_score", _hits("similarity_score >= 0.8", 100))
def search_min_score(spark, d):
    return search.search_high_quality(served(spark, d))


@query("search_age_range", _hits("idade_1 BETWEEN 30 AND 40 AND idade_2 BETWEEN 30 AND 40", 50))
def search_age_range(spark, d):
    return search.search_by_age_range(served(spark, d), 30, 40)


@query("search_total_hits", sql.SERVED + "\nSELECT count(*) AS total_hits FROM served WHERE similarity_score >= 0.8")
def search_total_hits(spark, d):
    return search.total_hits(search.quality_hits(served(spark, d), 0.8))


@query("match_stats", sql.SERVED + """
SELECT round(avg(similarity_score), 9) AS avg_similarity, max(similarity_score) AS max_similarity,
    min(similarity_score) AS min_similarity, count(idade_diff) AS age_diff_count,
    min(idade_diff) AS age_diff_min, max(idade_diff) AS age_diff_max,
    round(avg(idade_diff), 9) AS age_diff_avg, CAST(sum(idade_diff) AS BIGINT) AS age_diff_sum FROM served""")
def match_stats(spark, d):
    return stats.match_stats(served(spark, d)).withColumns({
        c: F.round(c, 9) for c in ("avg_similarity", "age_diff_avg")
    })


@query("score_histogram", sql.base(sql.matches(sql.BY_PREFIX, 0.5), """
h AS (SELECT CAST(floor(round(similarity_score * 10, 9)) AS INTEGER) AS b, count(*) AS n FROM m GROUP BY 1)""") + """
SELECT g / 10.0::DOUBLE AS bucket, coalesce(n, 0) AS matches
FROM (SELECT unnest(generate_series((SELECT min(b) FROM h), (SELECT max(b) FROM h))) AS g) LEFT JOIN h ON h.b = g""")
def score_histogram(spark, d):
    return stats.score_histogram(plan.match(*both(spark, d), MatchConfig(threshold=0.5, score_digits=9)))


# --- changes ----------------------------------------------------------------------------------

def snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two file listings derived from `orders`: the last of three datasets did not change."""
    k = F.col("o_orderkey")
    rows = read(spark, d, "orders").select(
        k, F.concat(F.lit("dataset"), (k % 3).cast("string")).alias("dataset_id"),
        F.concat(F.lit("part-"), F.lpad(k.cast("string"), 12, "0"), F.lit(".parquet")).alias("path"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("size"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("last_modified"),
        F.md5(k.cast("string")).alias("etag"),
    )
    fixed = k % 3 == 2
    current = rows.where(fixed | (k % 19 != 0)).drop("o_orderkey")
    retagged = F.when(
        ~fixed & (k % 13 == 0), F.md5(F.concat(k.cast("string"), F.lit("x")))
    ).otherwise(F.col("etag"))
    previous = rows.where(fixed | (k % 17 != 0)).withColumn("etag", retagged).drop("o_orderkey")
    return current, previous


@query("dataset_fingerprint", f"WITH {sql.SNAPSHOTS.strip()}, {sql.fingerprint('cur', 'p').strip()}\nSELECT * FROM p")
def dataset_fingerprint(spark, d):
    return files.dataset_fingerprint(snapshots(spark, d)[0])


@query("changed_files", f"""WITH {sql.SNAPSHOTS.strip()}
SELECT cur.*, CASE WHEN prev.path IS NULL THEN 'new' ELSE 'modified' END AS change
FROM cur LEFT JOIN prev ON cur.dataset_id = prev.dataset_id AND cur.path = prev.path
WHERE prev.path IS NULL OR prev.etag <> cur.etag""")
def changed_files(spark, d):
    return files.changed_files(*snapshots(spark, d), keys=("dataset_id", "path"))


@query("deleted_files", f"""WITH {sql.SNAPSHOTS.strip()}
SELECT prev.* FROM prev ANTI JOIN cur ON cur.dataset_id = prev.dataset_id AND cur.path = prev.path""")
def deleted_files(spark, d):
    return files.deleted_files(*snapshots(spark, d), keys=("dataset_id", "path"))


@query("datasets_changed", f"""WITH {sql.SNAPSHOTS.strip()}, {sql.fingerprint('cur', 'p').strip()},
{sql.fingerprint('prev', 'o').strip()}
SELECT p.*, o.metadata_hash IS DISTINCT FROM p.metadata_hash AS changed FROM p LEFT JOIN o USING (dataset_id)""")
def datasets_changed(spark, d):
    current, previous = (files.dataset_fingerprint(s) for s in snapshots(spark, d))
    return files.datasets_changed(current, previous)


FIRST_RUN, SECOND_RUN = (datetime(2025, 6, day, 12, tzinfo=timezone.utc) for day in (29, 30))


def state_of_two_runs(spark: SparkSession, d: str) -> str:
    """A state folder with two committed runs, and a third whose listing was staged only."""
    current, previous = snapshots(spark, d)
    path = scratch_path(spark, "state")
    for run_id, listing, at in (("r1", previous, FIRST_RUN), ("r2", current, SECOND_RUN)):
        files.stage_listing(spark, path, listing, run_id)
        files.commit_state(spark, path, run_id, at)
    files.stage_listing(spark, path, previous, "r3")
    return path


@query("state_roundtrip", f"""WITH {sql.SNAPSHOTS.strip()}, {sql.fingerprint('cur', 'p').strip()}
SELECT p.*, '{SECOND_RUN.isoformat()}' AS last_processed, 'r2' AS run_id FROM p""")
def state_roundtrip(spark, d):
    """The last committed head of each dataset, as read back."""
    return files.latest_heads(spark, state_of_two_runs(spark, d))


@query("state_files_roundtrip", f"WITH {sql.SNAPSHOTS.strip()}\nSELECT * FROM cur")
def state_files_roundtrip(spark, d):
    """The files of the last committed run, as read back."""
    return files.previous_files(spark, state_of_two_runs(spark, d))


@query("refresh_roundtrip", PREFIX_SQL)
def refresh_roundtrip(spark, d):
    """Detect, match, commit: a full run over a part of table A, then an increment for the files added to it."""
    a, b = both(spark, d)
    base = scratch_path(spark, "refresh")
    one, two, state, out = (f"{base}/{folder}" for folder in ("side 1", "side 2", "state", "matches"))
    early = F.coalesce(F.crc32(F.col("nr_documento").cast("binary")) % 2 == 0, F.lit(True))
    a.where(early).write.parquet(f"{one}/first files")
    b.write.parquet(f"{two}/all/files")
    first = refresh.refresh(spark, one, two, state, out, ROUNDED, FIRST_RUN)
    a.where(~early).write.parquet(f"{one}/later files")
    last = refresh.refresh_increment(spark, one, two, state, first, out, ROUNDED, SECOND_RUN)
    return tables.read_matches(spark, last)


LISTED = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@query("file_listing", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in LISTED))
def file_listing(spark, d):
    """Rows of the listed files of each table, found by the names in the listing; a file that no table reads has none."""
    listed = files.list_files(spark, d, "*.parquet").select("path")
    table = F.regexp_extract("path", r"/([a-z]+)\.parquet", 1)
    rows = None
    for t in LISTED:
        own = read(spark, d, t).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
        rows = own if rows is None else rows.unionByName(own)
    return listed.join(rows, "path", "left").groupBy(table.alias("table_name")).agg(F.sum("n").alias("n_rows"))


# --- sinks, read back -------------------------------------------------------------------------

@query("partitioned_roundtrip", PREFIX_SQL.replace("SELECT * FROM m", """
SELECT *, printf('%.1f', floor(round(similarity_score * 10, 9)) / 10) AS score_band FROM m"""))
def partitioned_roundtrip(spark, d):
    path = scratch_path(spark, "bands")
    sinks.write_by_score_band(prefix_matches(spark, d), path)
    schema = MATCH_SCHEMA.simpleString()[len("struct<"):-1].replace(":", " ") + ", score_band string"
    return spark.read.schema(schema).parquet(path)


@query("key_prefix_partition", sql.base() + f"""
SELECT *, {sql.phonetic('a')} AS blocking_key, 'M' AS blocking_key_prefix FROM a WHERE {sql.phonetic('a')} LIKE 'M%'""")
def key_prefix_partition(spark, d):
    path = scratch_path(spark, "prefixes")
    sinks.write_by_key_prefix(blocking.add_blocking_key(persons_a(spark, d), "phonetic"), path)
    return spark.read.parquet(path).where("blocking_key_prefix = 'M'")


@query("csv_sample", sql.base() + "\nSELECT * FROM a ORDER BY nr_documento LIMIT 100")
def csv_sample(spark, d):
    path = scratch_path(spark, "sample")
    sinks.write_csv_sample(persons_a(spark, d), path, "nr_documento")
    return spark.read.schema(PERSON_SCHEMA).option("header", True).csv(path)


@query("json_roundtrip", PREFIX_SQL)
def json_roundtrip(spark, d):
    path = scratch_path(spark, "staged")
    sinks.write_json_lines(prefix_matches(spark, d), path)
    return sinks.read_json_lines(spark, path, MATCH_SCHEMA)


@query("schema_merge", sql.base() + """
SELECT nome_completo, data_nascimento, nr_documento, CASE WHEN CAST(nr_documento AS BIGINT) % 2 = 1 THEN status END AS status FROM a""")
def schema_merge(spark, d):
    path, a = scratch_path(spark, "merge"), persons_a(spark, d)
    odd = F.col("nr_documento").cast("long") % 2 == 1
    sinks.write_persons(a.where(~odd).drop("status"), f"{path}/v=1")
    sinks.write_persons(a.where(odd), f"{path}/v=2")
    return tables.read_merged(spark, path).drop("v")


@query("catalog_partition_scan", sql.base() + "\nSELECT * FROM b WHERE status = 'Ativo'")
def catalog_partition_scan(spark, d):
    path = scratch_path(spark, "catalog")
    name = "persons_" + path[-12:]
    persons_b(spark, d).write.partitionBy("status").parquet(path)
    tables.register_table(spark, f"default.{name}", path, PERSON_SCHEMA, ("status",))
    return tables.read_catalog_table(spark, "default", name, "status = 'Ativo'")


@query("served_reload", sql.SERVED + "\nSELECT * FROM served")
def served_reload(spark, d):
    """A full load of half the matches, then a second load of all; readers see each id once."""
    path = scratch_path(spark, "served")
    docs = serve.served_documents(prefix_matches(spark, d), AS_OF)
    serve.load_served(docs.where("similarity_score >= 0.9"), path, "overwrite", load_seq=1)
    serve.load_served(docs, path, "append", load_seq=2)
    return serve.read_served(spark, path).drop("indexed_at")


# --- quality, generation ----------------------------------------------------------------------

def persons_with_check_digits(spark: SparkSession, d: str) -> DataFrame:
    """Table A with documents whose check digits hold for even customers and fail for odd ones."""
    k = F.col("c_custkey")
    raw = F.lpad(((k * 104729 + 12345) % 100000000000).cast("string"), 11, "0")
    chk = cpf_check_digits(raw)
    wrong = F.concat(F.substring(chk, 1, 1), ((F.substring(chk, 2, 1).cast("int") + 1) % 10).cast("string"))
    docs = read(spark, d, "customer").select(
        raw.alias("raw"), F.concat(F.substring(raw, 1, 9), F.when(k % 2 == 0, chk).otherwise(wrong)).alias("doc")
    )
    a = persons_a(spark, d)
    return a.join(docs, a.nr_documento == docs.raw).select(
        "nome_completo", "data_nascimento", F.col("doc").alias("nr_documento"), "status"
    )


@query("cpf_validation", sql.base(sql.CPF) + f"""
SELECT nome_completo, nr_documento, {sql.cpf_valid('nr_documento')} AS cpf_valid FROM cpf""")
def cpf_validation(spark, d):
    return quality.cpf_validation(persons_with_check_digits(spark, d))


@query("person_quality_profile", sql.quality_profile())
def person_quality_profile(spark, d):
    return quality.person_quality_profile(with_gaps(persons_with_check_digits(spark, d)))


@query("partition_row_counts")
def partition_row_counts(spark, d):
    return blocking.partition_row_counts(persons_a(spark, d))


GENERATOR = generate.GeneratorConfig()


@query("generated_persons", sql.generated(GENERATOR.overlap, GENERATOR.variation, GENERATOR.seed))
def generated_persons(spark, d):
    """Generated tables with one id per customer."""
    ids = read(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    a, b = generate.generate_from_ids(ids, GENERATOR)
    side = lambda df, n: df.select(F.lit(n).alias("side"), *PERSON_SCHEMA.fieldNames())
    return side(a, "A").unionByName(side(b, "B"))


# --- streaming --------------------------------------------------------------------------------

def staged_persons(spark: SparkSession, d: str, parts: int = 3) -> str:
    path = scratch_path(spark, "arrivals")
    sinks.write_persons(persons_a(spark, d).repartition(parts), path)
    return path


@query("file_stream_match", PREFIX_SQL)
def file_stream_match(spark, d):
    out, new = scratch_path(spark, "stream"), jobs.stream_files(spark, staged_persons(spark, d))
    jobs.match_batches(new, persons_b(spark, d), f"{out}/data", f"{out}/checkpoint", ROUNDED)
    return jobs.read_batches(spark, f"{out}/data")


@query("stream_served_upsert", sql.SERVED + "\nSELECT * FROM served")
def stream_served_upsert(spark, d):
    out = scratch_path(spark, "stream")
    new = jobs.stream_files(spark, staged_persons(spark, d, 2), max_files=1)
    jobs.match_arrivals(new, persons_b(spark, d), f"{out}/data", f"{out}/checkpoint", ROUNDED, AS_OF)
    return serve.read_served(spark, f"{out}/data").drop("indexed_at")


@query("dedup_ttl_stream", PREFIX_SQL.replace("SELECT * FROM m", """
SELECT DISTINCT nr_documento_1 || ':' || nr_documento_2 || ':' || CAST(similarity_score AS VARCHAR) AS match_key FROM m"""))
def dedup_ttl_stream(spark, d):
    """Every match is sent twice, an hour apart; each key comes out once."""
    out, sent = scratch_path(spark, "dedup"), scratch_path(spark, "sent")
    found = written(prefix_matches(spark, d), "found")   # read twice
    at = lambda hour: F.lit(datetime(2025, 1, 1, hour)).alias("event_time")
    found.select("*", at(1)).unionByName(found.select("*", at(2))).write.parquet(sent)
    stream = jobs.stream_files(spark, sent, spark.read.parquet(sent).schema)
    jobs.run_available(jobs.drop_repeated(stream).select("match_key"), f"{out}/data", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data")


@query("hourly_user_counts", """
SELECT user_id, date_trunc('hour', ts) AS hour_start, count(*) AS n_events FROM events GROUP BY ALL""")
def hourly_user_counts(spark, d):
    out = scratch_path(spark, "hourly")
    schema = read(spark, d, "events").schema
    stream = jobs.stream_files(spark, d, schema, "events.parquet")
    stream = stream.withColumn("ts", F.col("ts").cast("timestamp"))   # a watermark needs an instant
    jobs.run_hourly_counts(stream, f"{out}/data", f"{out}/checkpoint")
    counts = jobs.latest_hourly_counts(spark, f"{out}/data")
    return counts.withColumn("hour_start", F.col("hour_start").cast("timestamp_ntz"))


@query("hourly_user_counts_batch", """
SELECT user_id, date_trunc('hour', ts) AS hour_start, count(*) AS n_events FROM events GROUP BY ALL""")
def hourly_user_counts_batch(spark, d):
    return jobs.hourly_counts(read(spark, d, "events"))


# --- approximate candidates, entities, learning -----------------------------------------------

LSH = lsh.MinHashConfig()


@query("lsh_candidates", sql.lsh(LSH))
def lsh_candidates(spark, d):
    return lsh.lsh_candidate_pairs(*both(spark, d), LSH).withColumn("distance", F.round("distance", 9))


@query("embedding_matches", """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)
SELECT a.vec_id AS id_1, b.vec_id AS id_2, round(list_distance(a.x, b.x), 9) AS distance
FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_distance(a.x, b.x) <= 1.1::DOUBLE""")
def embedding_matches(spark, d):
    return metric.vectors_within(read(spark, d, "embeddings"), 1.1).withColumn("distance", F.round("distance", 9))


EDGES = sql.base(sql.matches(sql.BY_PREFIX), """
e AS (SELECT '1:' || nr_documento_1 AS u, '2:' || nr_documento_2 AS v FROM m),
s AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
r AS (SELECT u AS node, u AS other FROM s UNION SELECT r.node, s.v FROM r JOIN s ON r.other = s.u),
c AS (SELECT node, min(other) AS entity FROM r GROUP BY node)""")


@query("entity_clusters", EDGES + "\nSELECT * FROM c")
def entity_clusters(spark, d):
    return entities.entity_clusters(prefix_matches(spark, d))


@query("golden_records", EDGES + """,
p AS (SELECT '1:' || nr_documento AS node, * FROM a UNION ALL SELECT '2:' || nr_documento, * FROM b),
j AS (SELECT * FROM p JOIN c USING (node))
SELECT entity, count(*) AS records, arg_min(nome_completo, node) AS nome_completo,
    arg_min(data_nascimento, node) AS data_nascimento, arg_min(nr_documento, node) AS nr_documento,
    arg_min(status, node) AS status FROM j GROUP BY entity""")
def golden_records(spark, d):
    a, b = both(spark, d)
    return entities.golden_records(a, b, entities.entity_clusters(prefix_matches(spark, d)))


@query("relationship_degree", sql.base(sql.matches(sql.BY_PREFIX, 0.5), """
n AS (SELECT '1:' || nr_documento_1 AS node, similarity_score FROM m
    UNION ALL SELECT '2:' || nr_documento_2, similarity_score FROM m)""") + """
SELECT node, count(*) AS degree, max(similarity_score) AS best_score,
    round(avg(similarity_score), 6) AS mean_score FROM n GROUP BY node""")
def relationship_degree(spark, d):
    found = plan.match(*both(spark, d), MatchConfig(threshold=0.5, score_digits=9))
    return entities.relationship_degree(found).withColumn("mean_score", F.round("mean_score", 6))


def linked_documents(spark: SparkSession, d: str) -> DataFrame:
    return graphs.document_links(plan.match(*both(spark, d), MatchConfig(threshold=0.5, score_digits=9)), repeats=True)


# The recursive queries run a number of rounds that is more than enough; settled values stay as they are.
LINKS = sql.base(sql.matches(sql.BY_PREFIX, 0.5), """
l AS MATERIALIZED (SELECT DISTINCT least(nr_documento_1, nr_documento_2) AS u, greatest(nr_documento_1, nr_documento_2) AS v
    FROM m WHERE nr_documento_1 <> nr_documento_2),
s AS MATERIALIZED (SELECT u, v FROM l UNION ALL SELECT v, u FROM l)""")


@query("pivot_clusters", LINKS + """,
w AS MATERIALIZED (SELECT u, v, md5(v) < md5(u) AS ahead FROM s UNION ALL SELECT DISTINCT u, u, false FROM s),
p AS (SELECT 0 AS round, u AS node, 'open' AS state FROM (SELECT DISTINCT u FROM s)
    UNION ALL
    SELECT round + 1, u, CASE WHEN own <> 'open' THEN own WHEN taken THEN 'out' WHEN waits THEN 'open' ELSE 'pivot' END
    FROM (SELECT p.round, w.u, max(CASE WHEN u = v THEN state END) AS own, bool_or(u <> v AND state = 'pivot') AS taken,
            bool_or(ahead AND state = 'open') AS waits
        FROM p JOIN w ON p.node = w.v WHERE p.round < 30 GROUP BY p.round, w.u)),
f AS (SELECT node, state FROM p WHERE round = 30)
SELECT node, node AS cluster FROM f WHERE state = 'pivot'
UNION ALL SELECT s.u, arg_min(s.v, md5(s.v)) FROM s JOIN f ON f.node = s.v AND f.state = 'pivot'
    JOIN f o ON o.node = s.u AND o.state = 'out' GROUP BY s.u""")
def pivot_clusters(spark, d):
    return graphs.pivot_clusters(linked_documents(spark, d))


@query("clusters_refreshed", LINKS.replace("FROM m WHERE", "FROM m WHERE similarity_score >= 0.7::DOUBLE AND") + """,
w AS MATERIALIZED (SELECT u, v, md5(v) < md5(u) AS ahead FROM s UNION ALL SELECT DISTINCT u, u, false FROM s),
p AS (SELECT 0 AS round, u AS node, 'open' AS state FROM (SELECT DISTINCT u FROM s)
    UNION ALL
    SELECT round + 1, u, CASE WHEN own <> 'open' THEN own WHEN taken THEN 'out' WHEN waits THEN 'open' ELSE 'pivot' END
    FROM (SELECT p.round, w.u, max(CASE WHEN u = v THEN state END) AS own, bool_or(u <> v AND state = 'pivot') AS taken,
            bool_or(ahead AND state = 'open') AS waits
        FROM p JOIN w ON p.node = w.v WHERE p.round < 30 GROUP BY p.round, w.u)),
f AS (SELECT node, state FROM p WHERE round = 30),
k AS (SELECT node, node AS cluster FROM f WHERE state = 'pivot'
    UNION ALL SELECT s.u, arg_min(s.v, md5(s.v)) FROM s JOIN f ON f.node = s.v AND f.state = 'pivot'
        JOIN f o ON o.node = s.u AND o.state = 'out' GROUP BY s.u),
r AS (SELECT u AS node, u AS other FROM s UNION SELECT r.node, s.v FROM r JOIN s ON r.other = s.u)
SELECT node, min(other) AS entity, any_value(cluster) AS cluster FROM r JOIN k USING (node) GROUP BY node""")
def clusters_refreshed(spark, d):
    """Clusters of the matches of 0.7 and more, from stored clusters of those of 0.75 and more and of a tenth of the documents that has left since."""
    found = written(plan.match(*both(spark, d), MatchConfig(threshold=0.5, score_digits=9)).where("similarity_score >= 0.65"), "found")   # read twice
    now = written(graphs.document_links(found.where("similarity_score >= 0.7")), "links-now")
    before = written(graphs.document_links(found.where("similarity_score >= 0.75 OR (similarity_score >= 0.65 AND nr_documento_1 LIKE '%7')")), "links-before")
    stored = written(graphs.cluster_table(before), "clusters")
    return graphs.refresh_clusters(stored, now, now.exceptAll(before).union(before.exceptAll(now)))


@query("relationship_triangles", LINKS + """,
t AS (SELECT x.u AS a, x.v AS b, y.v AS c FROM l x JOIN l y ON x.v = y.u JOIN l z ON z.u = x.u AND z.v = y.v),
n AS (SELECT u AS node, count(*) AS degree FROM s GROUP BY u),
k AS (SELECT node, count(*) AS triangles FROM (SELECT unnest([a, b, c]) AS node FROM t) GROUP BY node)
SELECT node, degree, coalesce(triangles, 0) AS triangles,
    CASE WHEN degree > 1 THEN round(coalesce(triangles, 0) / (degree * (degree - 1) / 2), 9) END AS closed
FROM n LEFT JOIN k USING (node)""")
def relationship_triangles(spark, d):
    return graphs.closeness(linked_documents(spark, d)).withColumn("closed", F.round("closed", 9))


@query("relationship_cores", LINKS + """,
h AS (SELECT 0 AS round, u AS node, count(*) AS core FROM s GROUP BY u
    UNION ALL
    SELECT round + 1, u, max(least(core, place)) FROM (
        SELECT h.round, s.u, h.core, row_number() OVER (PARTITION BY h.round, s.u ORDER BY h.core DESC) AS place
        FROM h JOIN s ON s.v = h.node WHERE h.round < 60) GROUP BY round, u)
SELECT node, core FROM h WHERE round = 60""")
def relationship_cores(spark, d):
    return graphs.core_numbers(linked_documents(spark, d))


@query("shared_documents", sql.base() + """
SELECT nr_documento, count(DISTINCT lower(nome_completo)) AS names, count(*) AS records
FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY nr_documento HAVING count(DISTINCT lower(nome_completo)) > 1""")
def shared_documents(spark, d):
    return entities.shared_documents(*both(spark, d))


@query("review_queue", sql.base(sql.matches(sql.BY_PREFIX, 0.5)) + f"""
SELECT {sql.MATCH}, round(abs(similarity_score - 0.7::DOUBLE), 9) AS margin FROM m
ORDER BY margin, nr_documento_1, nr_documento_2 LIMIT 50""")
def review_queue(spark, d):
    found = plan.match(*both(spark, d), MatchConfig(threshold=0.5, score_digits=9))
    return learning.review_queue(found)


THRESHOLDS = [0.5, 0.6, 0.7, 0.8, 0.9]


@query("pair_quality", sql.base(sql.matches(sql.BY_PREFIX, 0.5), f"""
t AS (SELECT unnest({THRESHOLDS})::DOUBLE AS threshold),
z AS (SELECT (SELECT count(*) FROM a) AS na, (SELECT count(*) FROM b) AS nb, (SELECT count(*) FROM cand) AS nc,
    (SELECT count(*) FROM a JOIN b USING (nr_documento)) AS truth),
k AS (SELECT threshold, count(*) FILTER (nr_documento_1 = nr_documento_2) AS tp,
    count(*) FILTER (nr_documento_1 <> nr_documento_2) AS fp
    FROM t JOIN m ON similarity_score >= threshold GROUP BY threshold)""") + """
SELECT threshold, tp, fp, truth - tp AS fn, round(tp::DOUBLE / (tp + fp), 9) AS precision,
    round(tp::DOUBLE / truth, 9) AS recall, round(1 - nc / (na::DOUBLE * nb), 9) AS reduction FROM k, z""")
def pair_quality(spark, d):
    a, b = both(spark, d)
    found = plan.match(a, b, MatchConfig(threshold=0.5, score_digits=9))
    return stats.pair_quality(a, b, found, THRESHOLDS, plan.candidate_count(a, b))


SCORED_TRUTH = sql.base(sql.matches(sql.BY_PREFIX, 0.5), "z AS (SELECT count(*) AS truth FROM a JOIN b USING (nr_documento))")


@query("threshold_curve", SCORED_TRUTH + """,
c AS (SELECT similarity_score AS threshold, count(*) FILTER (nr_documento_1 = nr_documento_2) AS good, count(*) AS n FROM m GROUP BY 1),
r AS (SELECT threshold, sum(good) OVER w AS tp, sum(n - good) OVER w AS fp FROM c WINDOW w AS (ORDER BY threshold DESC))
SELECT threshold, tp::BIGINT AS tp, fp::BIGINT AS fp, (truth - tp)::BIGINT AS fn, round(tp::DOUBLE / (tp + fp), 9) AS precision,
    round(tp::DOUBLE / nullif(truth, 0), 9) AS recall FROM r, z""")
def threshold_curve(spark, d):
    """Precision and recall at every score that occurs."""
    a, b = both(spark, d)
    docs = lambda df, n: df.groupBy("nr_documento").agg(F.count("*").alias(n))
    truth = docs(a, "n1").join(docs(b, "n2"), "nr_documento").agg(F.coalesce(F.sum(F.col("n1") * F.col("n2")), F.lit(0)).alias("n"))
    return curves.threshold_curve(plan.match(a, b, MatchConfig(threshold=0.5, score_digits=9)), truth)


@query("score_calibration", SCORED_TRUTH + """,
c AS (SELECT floor(similarity_score * 100)::BIGINT AS bin, count(*) FILTER (nr_documento_1 = nr_documento_2) AS good, count(*) AS n FROM m GROUP BY 1),
s AS (SELECT bin, n, sum(good) OVER w AS g, sum(n) OVER w AS k, sum(good) OVER w - good AS g0, sum(n) OVER w - n AS k0 FROM c WINDOW w AS (ORDER BY bin)),
low AS (SELECT i.bin, i.n, min((y.g - x.g0)::DOUBLE / (y.k - x.k0)) AS least FROM s i JOIN s x ON x.bin <= i.bin JOIN s y ON y.bin >= i.bin GROUP BY i.bin, i.n, x.bin)
SELECT bin, n, round(max(least), 9) AS probability FROM low GROUP BY bin, n""")
def score_calibration(spark, d):
    """Probability that a pair is true by score in hundredths; the SQL takes the greatest of the least means from either side."""
    return curves.calibration(plan.match(*both(spark, d), MatchConfig(threshold=0.5, score_digits=9)), digits=2)


@query("learned_weights")
def learned_weights(spark, d):
    """From the pairs of the blocks and random ones."""
    a, b = both(spark, d)
    return learning.learned_weights(plan.scored_pairs(a, b).unionByName(plan.score(learning.random_pairs(a, b))))


@query("fellegi_sunter")
def fellegi_sunter(spark, d):
    return learning.fellegi_sunter(plan.scored_pairs(*both(spark, d)))


LINKAGE = linkage.LinkageModel(
    0.2, {"name": (0.02, 0.08, 0.9), "soundex": (0.1, 0.9), "date": (0.01, 0.04, 0.15, 0.8), "document": (0.2, 0.8)},
    {"name": (0.6, 0.3, 0.1), "soundex": (0.4, 0.6), "date": (0.3, 0.4, 0.2, 0.1), "document": (0.999, 0.001)})
CUTS = linkage.cut_offs(LINKAGE, 0.001, 0.05)


@query("linked_pairs", sql.base(sql.scored(sql.BY_PREFIX)) + sql.linked(LINKAGE, CUTS))
def linked_pairs(spark, d):
    """Candidate pairs with match weight by rarity of the name, probability and decision, by a given model."""
    a, b = both(spark, d)
    weighed = linkage.weigh_pairs(plan.scored_pairs(a, b, ROUNDED), LINKAGE, CUTS, linkage.name_frequencies(a, b))
    return weighed.select("nr_documento_1", "nr_documento_2", "match_weight", F.round("probability", 9).alias("probability"), "decision")


@query("run_report", sql.base(sql.matches(sql.BY_PREFIX)) + """
SELECT 'rows_1' AS measure, count(*) AS n FROM a UNION ALL SELECT 'rows_2', count(*) FROM b
UNION ALL SELECT 'candidates', count(*) FROM cand UNION ALL SELECT 'matches', count(*) FROM m""")
def run_report(spark, d):
    a, b = both(spark, d)
    return stats.run_counts(a, b, plan.candidate_count(a, b), plan.match(a, b, ROUNDED))


@query("run_rate", sql.base(sql.matches(sql.BY_PREFIX)) + """
SELECT count(*) AS matches, 7::BIGINT AS seconds, count(*) // 7 AS matches_per_second FROM m""")
def run_rate(spark, d):
    """The report of a run that took 7.9 seconds: matches, whole seconds, matches a second."""
    return stats.run_report(7.9, prefix_matches(spark, d)).withColumn("seconds", F.col("seconds").cast("bigint"))


@query("run_top_matches", PREFIX_SQL + """
ORDER BY similarity_score DESC, nr_documento_1, nr_documento_2, nome_completo_1 NULLS FIRST, nome_completo_2 NULLS FIRST
LIMIT 10""")
def run_top_matches(spark, d):
    """The ten best matches, as a run's report shows them."""
    ties = ("nr_documento_1", "nr_documento_2", "nome_completo_1", "nome_completo_2")
    return top_n(prefix_matches(spark, d), 10, F.desc("similarity_score"), *[F.col(c) for c in ties])
