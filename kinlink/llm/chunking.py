"""Substring de-duplication by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kinlink.llm import kernels as K
from kinlink.llm.store import written

#: A chunk ends at the largest rolling hash among REACH bytes on either side, or at MAX_BYTES.
REACH, MAX_BYTES = 24, 1024
#: Repeated chunks side by side are reported together if they have so many bytes.
MIN_REPEAT = 64
SCHEMA = "doc_id bigint, start bigint, end bigint, bytes bigint, digest bigint, digest_rest bigint"

_GEAR = np.random.Generator(np.random.PCG64(99)).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: sum of gear[byte j back] << j, by doubling the window five times; 24 bits, so 24 bytes count."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h & np.uint32(0xFFFFFF)


def _largest_after(h: np.ndarray, reach: int) -> np.ndarray:
    """Maximum of h[i + 1:i + 1 + reach]; 0 where nothing follows."""
    best = np.concatenate([h[1:], np.zeros(1, h.dtype)]) if len(h) else h
    width = 1
    while width < reach:
        step = min(width, reach - width)
        best[:-step] = np.maximum(best[:-step], best[step:])
        width += step
    return best


def cut_points(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text.

    Whether a chunk ends at a byte depends on the bytes near it alone, not on earlier cuts, so equal passages are
    cut alike but for their ends. Where that leaves more than MAX_BYTES, as in long runs of one character, further
    cuts follow from the chunk's start. No cut parts a UTF-8 character.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    begins = np.ones(n + 1, bool)
    begins[:n] = (data & 0xC0) != 0x80
    h = np.where(begins[1:], gear(data), np.uint32(0))
    peak = (h > _largest_after(h[::-1].copy(), REACH)[::-1]) & (h >= _largest_after(h.copy(), REACH))
    ends = np.flatnonzero(peak) + 1
    ends = np.concatenate([ends[ends < n], [n]])
    if np.diff(ends, prepend=0).max() <= MAX_BYTES:
        return ends
    out, last = [], 0
    for end in ends.tolist():
        while end - last > MAX_BYTES:
            last += MAX_BYTES
            while not begins[last]:
                last -= 1
            out.append(last)
        out.append(end)
        last = end
    return np.array(out, np.int64)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        for seg in K.segments(batch.column(1)):
            points = K.char_counts(seg.data)
            rows, starts, ends = [], [], []
            for i in range(seg.rows):
                a, b = int(seg.offsets[i]), int(seg.offsets[i + 1])
                cuts = cut_points(seg.data[a:b]) + a
                rows.append(np.full(len(cuts), i))
                starts.append(np.concatenate([[a], cuts[:-1]]) if len(cuts) else cuts)
                ends.append(cuts)
            row, start, end = (np.concatenate(x).astype(np.int64) for x in (rows, starts, ends))
            raw = seg.data.tobytes()
            digests = [hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist())]
            base = points[seg.offsets[row]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[seg.first:seg.last][row], pa.int64()), pa.array(points[start] - base), pa.array(points[end] - base),
                 pa.array(end - start), *(pa.array(half.copy()) for half in np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2).T)],
                ["doc_id", "start", "end", "bytes", "digest", "digest_rest"])


def chunk_table(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, bytes, digest, digest_rest) of the chunks of each text; places in code points, a 128-bit digest in two halves."""
    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").selectExpr("cast(doc_id AS bigint) doc_id", "text").mapInArrow(_chunks, SCHEMA)


def repeated_chunks(docs: DataFrame, min_bytes: int = REACH) -> DataFrame:
    """(doc_id, start, end, bytes, first_doc_id, first_start): each chunk that stands before elsewhere.

    Texts are cut by content, so a passage that moves, or stands in other text, is cut alike but for its ends. The
    first place of a digest, by (doc_id, start), is the original and gives no row. Chunks shorter than min_bytes,
    which are ends of texts, take no part. Null ids and null or empty texts have no chunks; rows repeated with one
    id are one document; other columns are not read; an empty table gives no rows.
    """
    chunks = written(chunk_table(docs).where(F.col("bytes") >= min_bytes), "chunks")
    often = chunks.groupBy("digest").agg(F.count("*").alias("n")).where("n > 1").select("digest")
    rows = written(chunks.join(often, "digest"), "repeats")
    first = rows.groupBy("digest", "digest_rest").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    return (rows.join(first, ["digest", "digest_rest"]).where("first != struct(doc_id, start)")
            .select("doc_id", "start", "end", "bytes", F.col("first.doc_id").alias("first_doc_id"), F.col("first.start").alias("first_start")))


def repeated_spans(docs: DataFrame, min_repeat: int = MIN_REPEAT) -> DataFrame:
    """(doc_id, start, end, bytes, n_chunks, first_doc_ids): repeated chunks side by side, of min_repeat bytes in all.

    first_doc_ids lists the documents that hold the originals. Same cases as repeated_chunks.
    """
    own = Window.partitionBy("doc_id").orderBy("start")
    rows = repeated_chunks(docs).dropDuplicates(["doc_id", "start"])
    runs = (rows.withColumn("new", F.when(F.lag("end").over(own) == F.col("start"), 0).otherwise(1))
            .withColumn("run", F.sum("new").over(own)))
    return (runs.groupBy("doc_id", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("bytes").alias("bytes"), F.count("*").alias("n_chunks"),
        F.array_sort(F.collect_set("first_doc_id")).alias("first_doc_ids")).where(F.col("bytes") >= min_repeat).drop("run"))
