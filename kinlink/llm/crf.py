"""Linear-chain conditional random field over the lines of documents: features, inference, training.

States: 0 content, 1 boilerplate. Chains are multiplied out with parallel scans of 2 x 2 matrices,
so a batch takes log2(longest chain) vectorised steps, however the lines are spread over documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinlink.llm import kernels as K

SYMBOLS = b"#*$%&|<>"
FEATURES = ("bias symbols pipes bangs upper digits repeats_previous repeats_in_line log_words seen_before "
            "in_repeated_window word_length ends_sentence").split()


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _PIPE, _BANG = _class(SYMBOLS), _class(b"|"), _class(b"!")
_UPPER, _LOWER, _DIGIT = _class(bytes(range(65, 91))), _class(bytes(range(97, 123))), _class(b"0123456789")
WINDOW = 8


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it occurs twice or more, and whether an equal one stands before it."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    again, often = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    again[order[1:]] = same
    often[order[1:]] |= same
    often[order[:-1]] |= same
    return often, again


@dataclass
class Lines:
    """Lines of one segment: place, row, number of words, features, and counts of each row."""

    seg: K.Segment
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    features: np.ndarray
    chars: np.ndarray
    counts: dict[str, np.ndarray] = field(default_factory=dict)


def read_lines(seg: K.Segment, neighbours: bool = False) -> Lines:
    data, rows = seg.data, seg.rows
    start, end, row = K.lines(seg)
    w0, w1, wrow = K.words(seg)
    hashes = K.span_hashes(data, w0, w1)
    line_of = np.searchsorted(start, w0, "right") - 1
    n = np.bincount(line_of, minlength=len(start))
    # several empty lines may share a place; words belong to the last line that starts there, which is the one that holds them
    salt = K.mix(wrow.astype(K.U) + K.U(1))
    twice, at = K.windows(hashes, wrow, WINDOW)
    often, _ = repeated(twice ^ salt[at])
    cover = np.zeros(len(w0) + WINDOW + 1, np.int32)
    np.add.at(cover, at[often], 1)
    np.add.at(cover, at[often] + WINDOW, -1)
    covered = np.cumsum(cover)[:len(w0)] > 0
    line_hash = K.span_hashes(data, start, end) ^ K.mix(row.astype(K.U) + K.U(1))
    seen = np.zeros(len(start), bool)
    full = np.flatnonzero(n)
    seen[full] = repeated(line_hash[full])[1]

    def total(table: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(table[data], out=sums[1:])
        return sums[end] - sums[start]

    symbols, upper, lower = total(_SYMBOL), total(_UPPER), total(_LOWER)
    code_points = K.char_counts(data)
    chars = code_points[end] - code_points[start]
    word_chars = code_points[w1] - code_points[w0]
    per_line = lambda x: np.bincount(line_of, weights=x, minlength=len(start))
    previous = np.zeros(len(w0), bool)
    previous[1:] = (hashes[1:] == hashes[:-1]) & (line_of[1:] == line_of[:-1])
    _, again = repeated(hashes ^ K.mix(line_of.astype(K.U) + K.U(1)))
    words, size = np.maximum(n, 1), np.maximum(end - start, 1)
    last = np.zeros(len(start), bool)
    ends = w1[np.maximum(np.cumsum(n) - 1, 0)] if len(w1) else np.zeros(len(start), np.int64)
    last[full] = np.isin(data[ends[full] - 1], list(b".!?"))
    x = np.stack([
        np.ones(len(start)), np.minimum(symbols / words, 1), np.minimum(total(_PIPE) / words, 1),
        np.minimum(total(_BANG) / words, 1), upper / np.maximum(upper + lower, 1), total(_DIGIT) / size,
        per_line(previous) / words, per_line(again) / words, np.log1p(n) / 8, seen,
        per_line(covered) / words, np.minimum(per_line(word_chars) / words / 20, 1), last,
    ], axis=1)
    if neighbours:
        same = row[1:] == row[:-1]
        before, after = np.zeros_like(x[:, 1:]), np.zeros_like(x[:, 1:])
        before[1:][same] = x[:-1, 1:][same]
        after[:-1][same] = x[1:, 1:][same]
        x = np.hstack([x, before, after])
    counts = {
        "n_words": np.bincount(wrow, minlength=rows), "word_chars": K.per_row(word_chars, wrow, rows),
        "n_symbols": K.per_row(symbols, row, rows), "n_dup_lines": K.per_row(seen, row, rows),
        "n_repeat_words": K.per_row(covered, wrow, rows),
    }
    return Lines(seg, start, end, row, x, chars, counts)


@dataclass
class Model:
    """Weights of state 1 against state 0, transition scores [from, to], start score of state 1, calibration."""

    weights: np.ndarray
    transitions: np.ndarray
    start: float
    calibration: tuple[float, float] = (0.0, 1.0)
    neighbours: bool = False

    def matrices(self, x: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Log scores [line, from, to]; the first line of a chain has the same row twice."""
        out = np.repeat(self.transitions[None], len(x), 0)
        first = np.ones(len(x), bool)
        first[1:] = row[1:] != row[:-1]
        out[first] = [0.0, self.start]
        out[:, :, 1] += (x @ self.weights)[:, None]
        return out


def _longest(row: np.ndarray) -> int:
    return int(np.bincount(row - row.min()).max()) if len(row) else 0


def _scan(m: np.ndarray, longest: int, maximum: bool) -> np.ndarray:
    """Running products m[0] m[1] ... m[i] of log matrices; a chain's first matrix makes what stands before it a constant."""
    join = np.maximum if maximum else np.logaddexp
    m, step = m.copy(), 1
    while step < longest:
        a, b = m[:-step], m[step:].copy()
        m[step:] = join(a[:, :, 0:1] + b[:, 0:1, :], a[:, :, 1:2] + b[:, 1:2, :])
        m -= m.max(axis=(1, 2), keepdims=True)
        step *= 2
    return m


def messages(m: np.ndarray, row: np.ndarray, maximum: bool) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log messages [line, state], up to a constant of each line."""
    longest = _longest(row)
    forward = _scan(m, longest, maximum)[:, 0, :]
    after = np.zeros_like(m)
    if len(m) > 1:
        inner = row[1:] == row[:-1]
        after[:-1][inner] = m[1:][inner]
    backward = _scan(after.transpose(0, 2, 1)[::-1], longest, maximum)[::-1]
    return forward, np.logaddexp(backward[:, 0], backward[:, 1]) if not maximum else backward.max(1)


def viterbi(model: Model, x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """True for the boilerplate lines of the best path; a tie is content."""
    if not len(x):
        return np.zeros(0, bool)
    forward, backward = messages(model.matrices(x, row), row, maximum=True)
    best = forward + backward
    return best[:, 1] > best[:, 0] + 1e-12


def marginals(model: Model, x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Probability of boilerplate for each line, by forward and backward sums."""
    if not len(x):
        return np.zeros(0)
    forward, backward = messages(model.matrices(x, row), row, maximum=False)
    both = forward + backward
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))


def _fit(x: np.ndarray, row: np.ndarray, y: np.ndarray, weight: np.ndarray, neighbours: bool, rounds: int = 70, penalty: float = 1e-3) -> Model:
    """Weighted maximum likelihood with a quadratic penalty, by Adam."""
    model = Model(np.zeros(x.shape[1]), np.zeros((2, 2)), 0.0, neighbours=neighbours)
    inner = np.flatnonzero(row[1:] == row[:-1]) + 1
    first = np.setdiff1d(np.arange(len(row)), inner)
    scale = weight.sum()
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner - 1], y[inner]), weight[inner])
    theta, mean, square = np.zeros(x.shape[1] + 5), 0.0, 0.0
    for turn in range(1, rounds + 1):
        m = model.matrices(x, row)
        forward, backward = messages(m, row, maximum=False)
        both = forward + backward
        p = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500)))
        pair = forward[inner - 1][:, :, None] + m[inner] + backward[inner][:, None, :]
        pair = np.exp(pair - pair.max(axis=(1, 2), keepdims=True))
        pair /= pair.sum(axis=(1, 2), keepdims=True)
        slope = np.concatenate([
            x.T @ (weight * (y - p)), (seen - (pair * weight[inner][:, None, None]).sum(0)).ravel(),
            [(weight[first] * (y[first] - p[first])).sum()]]) / scale - penalty * theta
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        theta = theta + 0.2 * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        model = Model(theta[:-5], theta[-5:-1].reshape(2, 2), float(theta[-1]), neighbours=neighbours)
    return model


def content_share(boilerplate: np.ndarray, chars: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Share of each row's characters that is content; a row without characters is content."""
    size = np.bincount(row, weights=chars, minlength=rows)
    bad = np.bincount(row, weights=chars * boilerplate, minlength=rows)
    return np.where(size > 0, 1 - bad / np.maximum(size, 1), 1.0)


def _calibrate(share: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the content share, by Newton steps."""
    z, beta = np.stack([np.ones_like(share), share], 1), np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        curve = (z * (weight * p * (1 - p))[:, None]).T @ z + np.diag([1e-3, 1e-3]) * weight.sum()
        beta = beta + np.linalg.solve(curve, z.T @ (weight * (good - p)) - 1e-3 * weight.sum() * beta)
    return float(beta[0]), float(beta[1])


TRAINING_DOCUMENTS, TRAINING_CHARS = 800, 20_000


def train(docs: DataFrame, labels: DataFrame, neighbours: bool, documents: int = TRAINING_DOCUMENTS, chars: int = TRAINING_CHARS) -> Model:
    """Fits the field on labelled documents: at most `documents` of each label, of at most `chars` characters.

    Only rows with crc32(doc_id) mod 5 != 0 are learnt from. Lines start with their document's label;
    then lines of bad documents take the label that the first fit finds for them, and a second fit follows.
    The sample is the first by a hash of the id, so it is the same at each run. Without documents of
    both labels the model calls every line content and every document good.
    """
    known = (labels.where("doc_id IS NOT NULL AND quality IN (0, 1) AND crc32(cast(doc_id AS string)) % 5 != 0")
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    totals = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    sample = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents) for q in (0, 1)]
    chosen = F.broadcast(sample[0].union(sample[1]).toDF("chosen_id", "chosen_quality"))
    rows = (docs.select("doc_id", "text").where(F.length("text") <= chars)
            .join(chosen, F.col("doc_id") == F.col("chosen_id")).select("doc_id", "chosen_quality", "text")
            .orderBy("doc_id", "text").collect())
    width = len(FEATURES) + (2 * (len(FEATURES) - 1) if neighbours else 0)
    quality = np.array([r["chosen_quality"] for r in rows])
    if not len(rows) or quality.min() == quality.max():
        return Model(np.concatenate([[-20.0], np.zeros(width - 1)]), np.zeros((2, 2)), 0.0, neighbours=neighbours)
    x, row, size, base = [], [], [], 0
    for seg in K.segments(pa.array([r["text"] for r in rows], pa.string())):
        own = read_lines(seg, neighbours)
        x.append(own.features)
        row.append(own.row + base)
        size.append(own.chars)
        base += seg.rows
    x, row, size = np.vstack(x), np.concatenate(row), np.concatenate(size)
    y = 1 - quality[row]
    class_weight = np.array([totals[q] / max(1, (quality == q).sum()) for q in (0, 1)])
    lines_of = np.bincount(row, minlength=len(rows))
    weight = (1 / lines_of)[row]  # every document counts once
    model = _fit(x, row, y, weight, neighbours)
    p = marginals(model, x, row)
    worst = np.zeros(len(rows))
    np.maximum.at(worst, row, p)
    y = np.where(y == 1, (p > 0.5) | (p >= worst[row] - 1e-9), 0).astype(int)
    model = _fit(x, row, y, weight, neighbours)
    share = content_share(marginals(model, x, row), size, row, len(rows))
    model.calibration = _calibrate(share, quality.astype(float), class_weight[quality] / class_weight.mean())
    return model
