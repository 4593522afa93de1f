"""Pair scores, their lossless bounds, and the evidence a match needs."""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations, product

from pyspark.sql import Column, DataFrame, functions as F

from kinlink.functions.people import parse_date, phonetic_code
from kinlink.functions.similarity import (
    SLACK, codes_match, date_similarity, document_match, edits_similarity, jaro_winkler, jaro_winkler_similarity,
    letter_bags, letters_apart, levenshtein_similarity, rounded,
)
from kinlink.operators.pairing import Bundles, SkewConfig
from kinlink.schema import BIRTH, DOC, NAME


@dataclass(frozen=True)
class Weights:
    levenshtein: float = 0.25
    jaro_winkler: float = 0.25
    soundex: float = 0.15
    date: float = 0.25
    document: float = 0.10

    def __post_init__(self):
        if abs(sum(vars(self).values()) - 1.0) > 1e-9:
            raise ValueError("weights must sum to 1")
        if min(vars(self).values()) < 0:
            raise ValueError("weights must not be negative")


@dataclass(frozen=True)
class MatchConfig:
    threshold: float = 0.7
    blocks: tuple[str, ...] = ("prefix",)    # several: a pair may agree in any of them
    normalize: bool = False                  # fold accents and case in the blocking key
    weights: Weights = field(default_factory=Weights)
    max_age_gap: int | None = None           # years; drops pairs with a missing or bad date
    null_document: str = "drop"              # or "zero": a missing document scores 0
    max_matches: int | None = None           # best matches kept per left record
    status: str | None = None                # only rows with this status
    strategy: str = "auto"
    score_digits: int | None = None          # round scores before the threshold
    skew: SkewConfig = field(default_factory=SkewConfig)

    def __post_init__(self):
        if self.null_document not in ("drop", "zero"):
            raise ValueError("null_document must be 'drop' or 'zero'")

    @property
    def needs_document(self) -> bool:
        return self.null_document == "drop"


# Derived once per row, before the join.
CODE, MONTH, YEAR_TEXT, BIRTH_YEAR = "_code", "_month", "_year", "_birth_year"
LOWER, LENGTH = "_lower", "_length"
# Derived once per bundle of rows with one name: 64 bits for the dates, their beginnings and the documents.
DATES, MONTHS, YEARS, DOCS = "_dates", "_months", "_years", "_docs"
# The characters of the lower-cased name, their number, that of the name itself, and its code; of no name none, 0, 0 and "".
BAGS, LOWER_LENGTH, NAME_LENGTH, FILLED_CODE = ("_bag_1", "_bag_2"), "_lower_length", "_name_length", "_filled_code"
NAME_SCORES = ("name_lev_score", "name_jaro_score", "name_soundex_score")
_DATE_LEVELS = {1.0: {"date", "month", "year"}, 0.8: {"month", "year"}, 0.5: {"year"}, 0.0: set()}
_ATTRIBUTE_COLUMN = {"document": DOC, "date": "_date", "code": CODE, "month": MONTH, "year": YEAR_TEXT}
_COARSENESS = {"document": 1, "date": 2, "code": 4, "month": 8, "year": 50}


def add_row_features(df: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Phonetic code, lower-cased name and its length per row, and the birth year where the age filter needs it."""
    features = {CODE: phonetic_code(F.col(NAME)), LOWER: F.lower(NAME), LENGTH: F.length(NAME)}
    if cfg.max_age_gap is not None:
        features[BIRTH_YEAR] = F.year(parse_date(F.col(BIRTH)))
    return df.withColumns(features)


def reachable(cfg: MatchConfig) -> Column:
    """Can this row reach the threshold with the best possible partner?

    Rows without a name or a date lose those parts of the score for certain, so blocks made of
    empty keys never get to the join at usual thresholds.
    """
    w = cfg.weights
    named = F.coalesce(F.length(NAME) > 0, F.lit(False))
    dated = F.coalesce(F.length(BIRTH) > 0, F.lit(False))
    best = (
        F.when(named, w.levenshtein + w.jaro_winkler + w.soundex).otherwise(0.0)
        + F.when(dated, w.date).otherwise(0.0)
        + F.when(F.col(DOC).isNotNull(), w.document).otherwise(0.0)
    )
    test = best >= cfg.threshold - SLACK - _rounding(cfg)
    return test & F.col(DOC).isNotNull() if cfg.needs_document else test


def _rounding(cfg: MatchConfig) -> float:
    return 0.0 if cfg.score_digits is None else 10.0 ** -cfg.score_digits


def finer_attributes(cfg: MatchConfig) -> list[str]:
    """Columns of which at least one must agree in any pair that reaches the threshold.

    Walks over what document, phonetic code and date can contribute. Where the code differs the
    names differ, so the name part stays below its full weight. Of all sets of attributes that
    meet every combination still able to match, the finest is taken; empty when only sets that
    hold inside the whole block anyway would do.
    """
    w = cfg.weights
    name = w.levenshtein + w.jaro_winkler
    needed = []
    for doc, code, (date, agreed) in product((0, 1), (0, 1), _DATE_LEVELS.items()):
        ceiling = name + w.document * doc + w.soundex * code + w.date * date
        if ceiling + _rounding(cfg) >= cfg.threshold - SLACK:
            full_name_needed = ceiling - cfg.threshold + _rounding(cfg) <= SLACK
            if full_name_needed and not code and w.levenshtein > 0:
                continue
            needed.append(agreed | ({"document"} if doc else set()) | ({"code"} if code else set()))
    implied = set.intersection(*[_implied(b) for b in cfg.blocks])
    usable = [a for a in _COARSENESS if a not in implied]
    covers = [
        set(c) for n in range(1, len(usable) + 1) for c in combinations(usable, n)
        if all(set(c) & agreed for agreed in needed)
    ]
    if not covers:
        return []
    best = min(covers, key=lambda c: sum(_COARSENESS[a] for a in c))
    return [a for a in _COARSENESS if a in best]


def _implied(block: str) -> set[str]:
    from kinlink.operators.blocking import BLOCKS
    return BLOCKS[block][1]


def add_finer_columns(df: DataFrame, attributes: list[str]) -> tuple[DataFrame, list[str]]:
    """The attributes as string columns, NULL where they cannot agree with anything."""
    filled = lambda c: F.when(F.length(c) > 0, c)
    made = {
        "date": ("_date", filled(F.col(BIRTH))),
        "month": (MONTH, filled(F.substring(BIRTH, 1, 7))),
        "year": (YEAR_TEXT, filled(F.substring(BIRTH, 1, 4))),
    }
    out = df.withColumns({made[a][0]: made[a][1] for a in attributes if a in made})
    if "code" in attributes:
        out = out.withColumn(CODE, filled(F.col(CODE)))
    return out, [_ATTRIBUTE_COLUMN[a] for a in attributes]


def _cheap_parts(l, r, cfg: MatchConfig) -> tuple[Column, Column, Column]:
    return (
        codes_match(l(CODE), r(CODE)),
        date_similarity(l(BIRTH), r(BIRTH)),
        document_match(l(DOC), r(DOC), null_as_zero=not cfg.needs_document),
    )


def _reaches(l, r, cfg: MatchConfig, date: Column, doc: Column) -> Column:
    """Can names add what is missing to these scores, with Jaro-Winkler, unknown yet, taken as 1?"""
    w = cfg.weights
    floor = cfg.threshold - SLACK - _rounding(cfg)
    rest = date * w.date + doc * w.document
    code = codes_match(l(CODE), r(CODE))
    named = (l(LENGTH) > 0) & (r(LENGTH) > 0)
    if w.levenshtein > 0:
        # What edit distance has to add, as a similarity; the most edits follow from the lengths.
        needed = (F.lit(floor - w.jaro_winkler) - rest - code * w.soundex) / w.levenshtein
        allowed = F.floor((1.0 - needed) * F.greatest(l(LENGTH), r(LENGTH)) + SLACK).cast("int")
        gap = F.abs(F.length(l(LOWER)) - F.length(r(LOWER)))
        by_name = (gap <= allowed) & (F.call_function("levenshtein", l(LOWER), r(LOWER), allowed) >= 0)
    else:
        by_name = rest + code * w.soundex + w.jaro_winkler >= floor
    return F.when(named, by_name).otherwise(rest >= floor)


def can_reach(l, r, cfg: MatchConfig) -> Column:
    """Can the pair of rows reach the threshold?"""
    _, date, doc = _cheap_parts(l, r, cfg)
    return _reaches(l, r, cfg, date, doc)


def bundles_can_reach(l, r, cfg: MatchConfig) -> Column:
    """Can two rows of the bundles reach the threshold?

    Dates and documents are known by a bit of their hash, and the best may come from different rows, so this lets too
    many pass, never too few. What the names can add is bounded by their characters first: of two texts of `la` and `lb`
    characters of which `apart` have no partner, at most (la + lb - apart) / 2 are common, and at least
    (apart + |la - lb|) / 2 edits lead from one to the other. Edits are counted only where both bounds leave a chance, and
    only if their number can matter. None of the columns read is NULL, which keeps the compiled test short.
    """
    w = cfg.weights
    floor = cfg.threshold - SLACK - _rounding(cfg)
    meet = lambda c: l(c).bitwiseAND(r(c)) != 0
    rest = (F.when(meet(DATES), w.date).when(meet(MONTHS), 0.8 * w.date).when(meet(YEARS), 0.5 * w.date).otherwise(0.0)
            + F.when(meet(DOCS), w.document).otherwise(0.0))
    code = F.when((l(FILLED_CODE) == r(FILLED_CODE)) & (l(FILLED_CODE) != ""), w.soundex).otherwise(0.0)
    la, lb = l(LOWER_LENGTH), r(LOWER_LENGTH)
    apart = letters_apart([l(c) for c in BAGS], [r(c) for c in BAGS])
    # All common characters in order, and four of them at the beginning.
    jaro = 0.6 + (la + lb) * (la + lb - apart) * 0.1 / (la * lb)
    if w.levenshtein > 0:
        allowed = (1.0 + (rest + code + jaro * w.jaro_winkler - floor) / w.levenshtein) * F.greatest(l(NAME_LENGTH), r(NAME_LENGTH)) + SLACK
        most = F.floor(allowed).cast("int")
        edits = F.call_function("levenshtein", l(LOWER), r(LOWER), most)
        by_name = (apart + F.abs(la - lb) <= 2.0 * allowed) & ((most >= F.greatest(la, lb)) | (edits >= 0))
    else:
        by_name = rest + code + jaro * w.jaro_winkler >= floor
    return F.when((la > 0) & (lb > 0), by_name).otherwise(rest >= floor)


def name_bundles(cfg: MatchConfig, thresholded: bool = True) -> Bundles:
    """Rows of one name are compared with those of another by name once."""
    bit = lambda c: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(c), F.lit(64)).cast("int"))
    dated = lambda n: F.bit_or(F.when(F.length(BIRTH) > 0, bit(F.substring(BIRTH, 1, n))))
    # An empty date agrees with none, an empty document with an empty one.
    summary = {DATES: F.bit_or(F.when(F.length(BIRTH) > 0, bit(F.col(BIRTH)))), MONTHS: dated(7), YEARS: dated(4),
               DOCS: F.bit_or(F.when(F.col(DOC).isNotNull(), bit(F.col(DOC))))}
    scores = {
        # Never NULL; said so, Spark adds no test of it, which would count the edits twice.
        "name_lev_score": lambda l, r: F.coalesce(edits_similarity(F.levenshtein(l(LOWER), r(LOWER)), l(LENGTH), r(LENGTH)), F.lit(0.0)),
        "name_jaro_score": lambda l, r: jaro_winkler(l(LOWER), r(LOWER)),
        "name_soundex_score": lambda l, r: codes_match(l(CODE), r(CODE)),
    }
    by = [NAME, CODE, LOWER, LENGTH]
    if not thresholded:
        return Bundles(by, extend=scores)
    filled = lambda c, empty: F.coalesce(c, F.lit(empty))
    letters = {n: filled(c, 0) for n, c in zip(BAGS, letter_bags(F.col(LOWER)))} | {n: filled(F.col(n), 0) for n in summary} | {
        LOWER_LENGTH: filled(F.length(LOWER), 0), NAME_LENGTH: filled(F.col(LENGTH), 0), FILLED_CODE: filled(F.col(CODE), "")}
    return Bundles(by, summary, lambda l, r: bundles_can_reach(l, r, cfg), scores, letters)


def pair_condition(cfg: MatchConfig, thresholded: bool = True):
    """What pairs of rows have to meet beside their block: the age gap, and a bound of the score."""
    def residual(l, r) -> Column:
        test = F.lit(True)
        if cfg.max_age_gap is not None:
            test = F.abs(l(BIRTH_YEAR) - r(BIRTH_YEAR)) <= cfg.max_age_gap
        return test & can_reach(l, r, cfg) if thresholded else test

    return residual


def _total(cfg: MatchConfig) -> Column:
    w = cfg.weights
    return (
        F.col("name_lev_score") * w.levenshtein
        + F.col("name_jaro_score") * w.jaro_winkler
        + F.col("name_soundex_score") * w.soundex
        + F.col("date_score") * w.date
        + F.col("doc_match") * w.document
    )


def _once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`withColumns` by a generator of one row. What follows cannot be merged with it, so that a score is worked out once a
    pair however often filters and aggregates name it, and the compiled method stays below what the JVM compiles (8,000 bytes).
    """
    made = F.inline(F.array(F.struct(*[c.alias(f"_once_{n}") for n, c in columns.items()])))
    rows = df.select("*", made)
    return rows.select(*[c for c in df.columns if c not in columns], *[F.col(f"_once_{n}").alias(n) for n in columns])


def score_pairs(pairs: DataFrame, cfg: MatchConfig, thresholded: bool = False) -> DataFrame:
    """Adds the five component scores and `similarity_score` to `_1`/`_2` columns; those of names may be there already.

    With `thresholded`, pairs below the threshold are left out before scores are rounded, which costs more than the rest.
    """
    side = lambda n: (lambda c: F.col(f"{c}_{n}"))
    l, r = side(1), side(2)
    code, date, doc = _cheap_parts(l, r, cfg)
    names = {
        "name_lev_score": lambda: levenshtein_similarity(l(NAME), r(NAME)),
        "name_jaro_score": lambda: jaro_winkler_similarity(l(NAME), r(NAME)),
        "name_soundex_score": lambda: code,
    }
    scored = pairs.withColumns({n: made() for n, made in names.items() if n not in pairs.columns})
    scored = _once(scored, {"date_score": date, "doc_match": doc})
    scored = _once(scored, {"similarity_score": _total(cfg)})
    if thresholded:
        scored = scored.where(F.col("similarity_score") >= cfg.threshold - SLACK - _rounding(cfg))
    if cfg.score_digits is not None:
        scored = _once(scored, {c: rounded(F.col(c), cfg.score_digits) for c in ("similarity_score", "name_lev_score", "name_jaro_score")})
    return scored.where(F.col("similarity_score") >= cfg.threshold) if thresholded else scored
