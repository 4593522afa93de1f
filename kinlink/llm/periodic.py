"""Runs of repeated words, found with a dictionary of basic factors.

For each length that is a power of two, every place of a text gets the number of the factor of that length that
begins there: equal numbers are equal factors. The number for twice the length comes from a pair of numbers. The
next occurrence of a factor proposes a period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Words of documents that are worked on together.
SEGMENT_WORDS = 200_000
#: A run has at least so many words, and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _numbered(keys: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors that occur again: (places in order of factor and place, their numbers, next occurrence or -1)."""
    order = np.argsort(keys, kind="stable")
    keys, place = keys[order], place[order]
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[1:] == keys[:-1]
    keep = same[:-1] | same[1:]
    number = np.cumsum(~same[:-1])
    after = np.full(len(keys), -1, np.int64)
    after[:-1][same[1:-1]] = place[1:][same[1:-1]]
    return place[keep], number[keep], after[keep]


def find_runs(words: np.ndarray, ends: np.ndarray, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """Rows (start, length, period) of the runs, by start and period. words are numbers of words; ends, the end of each word's text.

    min_periods is 3 or more, so that a run holds two occurrences of a factor of length L < 2 d. Level by level, only factors that occur again in their text are kept, as only these can
    occur again at twice the length. Places i, i + 1, ... whose factors of length L all occur next at the same
    distance d, with L / 2 < d <= L, so both within twice that length, have words d apart equal throughout: they make
    up one run of period d from the first of them to the end of the last factor's second occurrence. A smaller period
    would bring a nearer occurrence (Fine and Wilf), and each d belongs to one length alone, so every run
    is proposed once.
    """
    none = np.zeros((0, 3), np.int64)
    n = len(words)
    if n == 0:
        return none
    base = np.int64(ends.max()) + 1
    place = np.arange(n, dtype=np.int64)
    found, length = [], 1
    place, number, after = _numbered(words * base + ends, place)
    longest = int((ends - np.concatenate([[0], ends[:-1]])).max())  # no text is longer
    while len(place):
        near = after >= 0
        i, d = place[near], after[near] - place[near]
        pick = (d <= length) & (2 * d > length)
        i, d = i[pick], d[pick]
        if len(i):
            order = np.argsort(i)
            i, d = i[order], d[order]
            new = np.ones(len(i), bool)
            new[1:] = (i[1:] != i[:-1] + 1) | (d[1:] != d[:-1])
            first = np.flatnonzero(new)
            last = np.concatenate([first[1:], [len(i)]]) - 1
            size = i[last] - i[first] + length + d[first]
            keep = size >= np.maximum(min_words, min_periods * d[first])
            found.append(np.stack([i[first], size, d[first]], axis=1)[keep])
        if min_periods * (length + 1) > longest:    # no text holds a run of a longer period
            break
        # Twice the length: the pair of this factor and the one that begins where it ends, within one text.
        at = np.full(n + 1, 0, np.int64)
        at[place] = number
        second = place + length
        fits = second + length <= ends[place]
        place, number, second = place[fits], number[fits], second[fits]
        both = at[second] > 0
        place, number, second = place[both], number[both], second[both]
        order = np.argsort(place)
        place, number, second = place[order], number[order], second[order]
        length *= 2
        place, number, after = _numbered(number * np.int64(n + 1) + at[second], place)
    runs = np.concatenate(found) if found else none
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that some run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def _segment(ids: list, texts: list[list[bytes]], min_words: int, min_periods: int) -> pa.RecordBatch:
    counts = np.array([len(t) for t in texts], np.int64)
    every = [w for t in texts for w in t]
    words = pa.array(every, pa.binary()).dictionary_encode().indices.to_numpy().astype(np.int64) if every else np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    runs = find_runs(words, np.repeat(ends, counts), min_words, min_periods)
    begins = ends - counts
    row = np.searchsorted(ends, runs[:, 0], "right")
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(texts)))]).astype(np.int32)
    drop = _dropped(runs, len(words))
    touched = np.zeros(len(texts), bool)
    touched[row] = True
    collapsed = []
    for i, t in enumerate(texts):
        kept = [w for w, d in zip(t, drop[begins[i]:ends[i]].tolist()) if not d] if touched[i] else t
        collapsed.append(b" ".join(kept))
    structs = pa.StructArray.from_arrays([pa.array(runs[:, 0] - begins[row]), pa.array(runs[:, 1].copy()), pa.array(runs[:, 2].copy())],
                                         ["start", "length", "period"])
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), structs).cast(_RUNS),
                                       pa.array(collapsed, pa.binary()).view(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])


def word_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row: its runs by start and period, and its words without the repeats.

    A run is a stretch of words with a smallest period, of min_words words and min_periods periods at least, that
    cannot be extended to either side. collapsed has one space between words and leaves out those that a run holds
    after its first period. Null and empty texts have no words and no runs; null ids stay null; repeated rows give
    a row each; other columns are not read; an empty table gives no rows.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, n = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []   # splits at the six white bytes
                ids.append(doc_id)
                texts.append(words)
                n += len(words)
                if n >= SEGMENT_WORDS:
                    yield _segment(ids, texts, min_words, min_periods)
                    ids, texts, n = [], [], 0
            if ids:
                yield _segment(ids, texts, min_words, min_periods)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(task, SCHEMA)


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text), where one document in ten repeats a stretch of its words from some place to its end.

    With h the crc32 of the id in decimal and g = h div 10, documents with h mod 10 = 0 and n > 0 words have word
    a + (i - a) mod p in place i from a = g mod n on, p = 1 + (n - a) div (3 + g mod 8). Null ids have no h.
    """
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    g = F.expr("h div 10")
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    n = F.size("words").cast("bigint")
    rows = (docs.select("doc_id", "text").withColumn("h", h).withColumn("words", words).withColumn("n", n)
            .withColumn("a", F.when(F.col("n") > 0, g % F.col("n")))
            .withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)")))

    def word(i: Column) -> Column:
        place = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get("words", place.cast("int"))

    repeated = F.concat_ws(" ", F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), word))
    return rows.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """One row a document: the number of runs, the longest (ties: first start, then period), and hashes of runs and kept words."""
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    hashed = lambda c: F.sha2(c.cast("binary"), 256)
    return (found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        hashed(lines).alias("runs_sha256"), hashed(F.col("collapsed")).alias("collapsed_sha256"), "n_words"))
