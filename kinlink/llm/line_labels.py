"""Quality rules: a conditional random field marks lines as content or boilerplate; the content share decides."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinlink.llm import crf, kernels as K

SCHEMA = ("doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "base_failed boolean, content_share double, boilerplate array<struct<line: int, start: bigint, end: bigint>>, kept boolean")
MIN_WORDS, MAX_REPEATED, MIN_CONTENT = 20, 30, 0.5


def judge(column: pa.Array, model: crf.Model, min_content: float) -> Iterator[tuple[crf.Lines, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per segment: lines, Viterbi labels, base failures, content shares, verdicts."""
    for seg in K.segments(column):
        own = crf.read_lines(seg, model.neighbours)
        bad = crf.viterbi(model, own.features, own.row)
        share = crf.content_share(bad, own.chars, own.row, seg.rows)
        failed = (own.counts["n_words"] < MIN_WORDS) | (100 * own.counts["n_repeat_words"] > MAX_REPEATED * own.counts["n_words"])
        yield own, bad, failed, share, ~failed & (share >= min_content)


def label_lines(docs: DataFrame, model: crf.Model, min_content: float = MIN_CONTENT) -> DataFrame:
    """One row per row of docs: counts, content share, spans of boilerplate lines (code points), verdict.

    A document fails the base rules with fewer than 20 words, or with over 30 % of its words in 8-word
    windows that occur twice. Otherwise it is kept if its content lines hold `min_content` of its characters.
    Null and empty texts have no words and fail; a null doc_id stays null; repeated rows are judged one by
    one; other columns are not read; an empty table gives no rows.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for own, bad, failed, share, kept in judge(batch.column(1), model, min_content):
                seg, points = own.seg, K.char_counts(own.seg.data)
                first_line = np.searchsorted(own.row, np.arange(seg.rows))
                at = np.flatnonzero(bad)
                base = points[seg.offsets[own.row[at]]]
                spans = pa.StructArray.from_arrays(
                    [pa.array(at - first_line[own.row[at]], pa.int32()), pa.array(points[own.start[at]] - base, pa.int64()),
                     pa.array(points[own.end[at]] - base, pa.int64())], ["line", "start", "end"])
                cuts = np.searchsorted(own.row[at], np.arange(seg.rows + 1))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(seg.first, seg.rows), *(pa.array(own.counts[c], pa.int64()) for c in crf_counts),
                     pa.array(failed), pa.array(share), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), spans), pa.array(kept)], names)

    crf_counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    names = ["doc_id", *crf_counts, "base_failed", "content_share", "boilerplate", "kept"]
    return docs.selectExpr("cast(doc_id AS bigint) doc_id", "text").mapInArrow(task, SCHEMA)


def keep_good(docs: DataFrame, model: crf.Model, min_content: float = MIN_CONTENT) -> DataFrame:
    """The rows of docs, with all their columns, that the rules of label_lines keep."""
    text = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts = [kept for *_, kept in judge(batch.column(text), model, min_content)]
            if verdicts:
                yield batch.filter(pa.array(np.concatenate(verdicts)))

    return docs.mapInArrow(task, docs.schema)
