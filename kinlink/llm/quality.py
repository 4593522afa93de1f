"""Quality classifier: line marginals of a conditional random field, weighted by length, per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kinlink.llm import crf, kernels as K


def score_quality(docs: DataFrame, model: crf.Model) -> DataFrame:
    """(doc_id, n_lines, content_share, score) for each row of docs.

    The model labels every line from its own features and those of the lines before and after. The
    forward-backward marginals, weighted by characters, give the expected content share; the calibration
    fitted in training turns it into a probability of good quality. Null and empty texts have share 1.
    A null doc_id stays null; repeated rows are scored one by one; other columns are not read.
    """
    a, b = model.calibration

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seg in K.segments(batch.column(1)):
                own = crf.read_lines(seg, model.neighbours)
                share = crf.content_share(crf.marginals(model, own.features, own.row), own.chars, own.row, seg.rows)
                score = 1 / (1 + np.exp(-np.clip(a + b * share, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(seg.first, seg.rows), pa.array(np.bincount(own.row, minlength=seg.rows), pa.int64()),
                     pa.array(share), pa.array(score)], ["doc_id", "n_lines", "content_share", "score"])

    return (docs.selectExpr("cast(doc_id AS bigint) doc_id", "text")
            .mapInArrow(task, "doc_id bigint, n_lines bigint, content_share double, score double"))
