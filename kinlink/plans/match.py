"""The match pipeline: block, pair, score, threshold. Where no side fits a broadcast, hot keys are counted first."""

from __future__ import annotations

from dataclasses import replace
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from kinlink.functions.people import phonetic_code
from kinlink.operators.blocking import BLOCKS
from kinlink.operators.pairing import KEY, FinerKeys, pair_rows
from kinlink.operators.ranking import best_matches
from kinlink.operators.scoring import (
    BIRTH_YEAR, NAME_SCORES, MatchConfig, add_finer_columns, add_row_features, finer_attributes, name_bundles,
    pair_condition, reachable, score_pairs,
)
from kinlink.schema import BIRTH, DOC, MATCH_COLUMNS, NAME, PERSON_COLUMNS, STATUS


def _prepared(df: DataFrame, cfg: MatchConfig, thresholded: bool) -> DataFrame:
    rows = df.select(*PERSON_COLUMNS)
    if cfg.status is not None:
        rows = rows.where(F.col(STATUS) == cfg.status)
    if thresholded:
        rows = rows.where(reachable(cfg))
    return add_row_features(rows, cfg)


def _paired(a: DataFrame, b: DataFrame, cfg: MatchConfig, thresholded: bool, scored: bool = True) -> DataFrame:
    """Pairs as structs `l` and `r`, with the scores of their names if `scored`; rows of a stream cannot be bundled for that."""
    left, right = _prepared(a, cfg, thresholded), _prepared(b, cfg, thresholded)
    finer = None
    if thresholded:
        left, names = add_finer_columns(left, finer_attributes(cfg))
        right, _ = add_finer_columns(right, finer_attributes(cfg))
        finer = FinerKeys(names)
    keys = [BLOCKS[block][0](F.col(NAME), F.col(BIRTH), cfg.normalize) for block in cfg.blocks]
    bundles = name_bundles(cfg, thresholded) if scored and not (a.isStreaming or b.isStreaming) else None
    # Bundles are bounded as such, and the score itself settles what is left.
    residual = pair_condition(cfg, thresholded and bundles is None)
    return pair_rows(left, right, keys, keys, residual, cfg.strategy, finer, cfg.skew, bundles=bundles)


def _name_scores(pairs: DataFrame) -> list[str]:
    return [c for c in NAME_SCORES if c in pairs.columns]


def _side_columns(extra: list[str]) -> list:
    ordered = [DOC, NAME, BIRTH, STATUS] + extra
    return [F.col(f"l.{c}").alias(f"{c}_1") for c in ordered] + [
        F.col(f"r.{c}").alias(f"{c}_2") for c in ordered
    ]


def candidate_pairs(a: DataFrame, b: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """Pairs that share a block (and pass the age filter), unscored, with the block key."""
    pairs = _paired(a, b, cfg, thresholded=False, scored=False)
    return pairs.select(*_side_columns([]), F.col(KEY).alias("blocking_key"))


def candidate_count(a: DataFrame, b: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """One row, `candidates`: how many pairs `candidate_pairs` gives, without pairing any rows.

    Rows are counted per key and the counts multiplied. A pair that shares several blocks counts
    once: each set of blocks is counted by all its keys, even sets with a minus (inclusion and
    exclusion). With an age filter the counts are per birth year as well, and the years within
    reach of one side meet those of the other.
    """
    gap, places = cfg.max_age_gap, range(len(cfg.blocks))
    sets = [s for n in places for s in combinations(places, n + 1)]

    def counted(df: DataFrame, n: str) -> DataFrame:
        rows = _prepared(df, cfg, thresholded=False)
        keys = [BLOCKS[block][0](F.col(NAME), F.col(BIRTH), cfg.normalize) for block in cfg.blocks]
        shared = F.explode(F.array(*[
            F.struct(F.lit(i).alias("blocks"), F.lit(len(s) % 2 * 2 - 1).alias("sign"),
                     F.array(*[keys[k] for k in s]).alias("key"))
            for i, s in enumerate(sets)
        ])).alias("s")
        year = F.lit(0) if gap is None else F.col(BIRTH_YEAR).cast("int")
        by = rows.select(shared, year.alias("year")).select("s.*", "year").where("year IS NOT NULL")
        return by.groupBy("blocks", "sign", "key", "year").agg(F.count("*").alias(n))

    left, right = counted(a, "n1"), counted(b, "n2").drop("sign")
    if gap is not None:
        years = F.sequence(F.col("year") - gap, F.col("year") + gap)
        left = left.withColumn("year", F.explode(years))
    pairs = F.sum(F.col("sign") * F.col("n1") * F.col("n2"))
    return left.join(right, ["blocks", "key", "year"]).agg(F.coalesce(pairs, F.lit(0)).alias("candidates"))


def scored_pairs(a: DataFrame, b: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """Every candidate pair with all component scores, no threshold."""
    pairs = _paired(a, b, cfg, thresholded=False)
    return score_pairs(pairs.select(*_side_columns(["_code"]), *_name_scores(pairs)), cfg).drop("_code_1", "_code_2")


def score(pairs: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """Pairs from elsewhere, in `_1`/`_2` columns, as `scored_pairs` gives them."""
    coded = pairs.withColumns({f"_code_{n}": phonetic_code(F.col(f"{NAME}_{n}")) for n in (1, 2)})
    return score_pairs(coded.select(*[f"{c}_{n}" for n in (1, 2) for c in (DOC, NAME, BIRTH, STATUS, "_code")]), cfg).drop("_code_1", "_code_2")


def match(a: DataFrame, b: DataFrame, cfg: MatchConfig = MatchConfig()) -> DataFrame:
    """Pairs of persons scoring at least the threshold, with the 12 match columns."""
    pairs = _paired(a, b, cfg, thresholded=True)
    found = score_pairs(pairs.select(*_side_columns(["_code"]), *_name_scores(pairs)), cfg, thresholded=True)
    found = found.select(*MATCH_COLUMNS)
    return best_matches(found, cfg.max_matches) if cfg.max_matches is not None else found


def incremental_match(
    a_old: DataFrame, a_new: DataFrame, b_old: DataFrame, b_new: DataFrame,
    cfg: MatchConfig = MatchConfig(),
) -> DataFrame:
    """The pairs of a full run in which at least one side is new.

    A limit per left record does not apply here: it needs all matches of the record, see
    `merge_increment`.
    """
    every = replace(cfg, max_matches=None)
    return match(a_new, b_old.unionByName(b_new), every).unionByName(match(a_old, b_new, every))


def merge_increment(
    previous: DataFrame, increment: DataFrame,
    stale_1: DataFrame | None = None, stale_2: DataFrame | None = None,
    max_matches: int | None = None,
) -> DataFrame:
    """Previous matches without those of changed or deleted records, plus the new ones.

    `stale_1` and `stale_2` hold the person columns of records that no longer stand.
    """
    kept = previous
    for side, stale in ((1, stale_1), (2, stale_2)):
        if stale is not None:
            gone = stale.select(*PERSON_COLUMNS).distinct().alias("s")
            same = [F.col(f"k.{c}_{side}").eqNullSafe(F.col(f"s.{c}")) for c in PERSON_COLUMNS]
            test = same[0]
            for t in same[1:]:
                test = test & t
            kept = kept.alias("k").join(gone, test, "left_anti")
    merged = kept.unionByName(increment)
    return best_matches(merged, max_matches) if max_matches is not None else merged
