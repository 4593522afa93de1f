"""Toxicity: noisy-channel restoration of disguised words, then a scored lexicon learnt from labels."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinlink.llm import kernels as K

#: Symbols of the character model: 0 word edge, 1-26 a-z, 27-59 the letters ß to ÿ, 60 anything else.
ALPHABET = 61
#: Letters that a written character may stand for.
DISGUISES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
             "!": "il", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "*": "abcdefghijklmnopqrstuvwxyz", "#": "abcdefghijklmnopqrstuvwxyz"}
SEPARATORS = ".-_~'`·*"
#: Marks among DISGUISES that also open words.
OPENING = "(#"
#: Log probabilities of a character as it stands, as one of its letters, as nothing; the last for marks that may be letters.
KEEP, SWAP, DROP, DROP_MARK = np.log(0.9), np.log(0.3), np.log(0.4), np.log(0.1)
#: Lengths of words looked for inside a spelt-out run, beside those that reach its end.
SPELT = (3, 4, 5, 6, 7, 8)
#: Characters of a word that are gone through before states are kept.
PIECE = 512
PREFIXES = (4, 5, 6)
TRAINING_DOCUMENTS, TRAINING_CHARS = 3000, 20_000
#: Least log-likelihood ratio of a feature in the lexicon.
EVIDENCE = 20.0
#: Restored words that a task remembers, and their greatest length.
CACHED, CACHED_CHARS = 200_000, 64
#: Words restored side by side, and tails of words held.
LOT = 2048

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DISGUISE = np.zeros(256, bool)
_DISGUISE[list(b"0123456789@$!|+(*#") + [0xE2, 0xC2]] = True
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[list(b".-_~'`*")] = True
_TRAIL = np.zeros(256, bool)
_TRAIL[list(b".,;:!?\"')]}>")] = True
_CLOSING = _TRAIL.copy()
_CLOSING[ord("!")] = False
_MARK = np.zeros(256, bool)
_MARK[list(b"@$!|+")] = True
_WIDE = re.compile("[*#]{3}")
_SYMBOLS = np.arange(ALPHABET)


def symbol(points: np.ndarray) -> np.ndarray:
    """Symbols of lower-cased code points; blanks are word edges."""
    out = np.full(len(points), 60, np.int64)
    lower = np.where((points >= 65) & (points <= 90), points + 32, np.where((points >= 0xC0) & (points <= 0xDE), points + 32, points))
    plain, accent = (lower >= 97) & (lower <= 122), (lower >= 0xDF) & (lower <= 0xFF)
    out[plain], out[accent] = lower[plain] - 96, lower[accent] - 0xDF + 27
    out[np.isin(points, [32, 9, 10, 11, 12, 13])] = 0
    return out


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(ALPHABET**3, np.int64)
    for batch in batches:
        for seg in K.segments(batch.column(0)):
            points = np.frombuffer(seg.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.int64)
            s = np.concatenate([[0, 0], symbol(points), [0]])
            starts = K.char_counts(seg.data)[seg.offsets[1:-1]] + 2
            one, two = s[1:-1], s[:-2].copy()
            two[one == 0] = 0
            code = (two * ALPHABET + one) * ALPHABET + s[2:]
            inner = (one != 0) | (s[2:] != 0)
            inner[starts[starts < len(inner) + 2] - 2] = False  # across two texts
            counts += np.bincount(code[inner], minlength=ALPHABET**3)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability [before last, last, next] of characters, counted over all words of all texts.

    The table has a fixed size, whatever the corpus; trigrams are smoothed with bigrams, those with letters.
    """
    rows = docs.select("text").mapInArrow(_count_trigrams, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).collect()
    c3 = np.zeros(ALPHABET**3)
    for r in rows:
        c3[r["code"]] = r["n"]
    c3 = c3.reshape((ALPHABET,) * 3)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + ALPHABET)
    p2 = (c2 + 20 * p1) / (c2.sum(1, keepdims=True) + 20)
    table = np.log((c3 + 20 * p2[None]) / (c3.sum(2, keepdims=True) + 20)).astype(np.float32)
    return np.ascontiguousarray(table.transpose(2, 0, 1)).transpose(1, 2, 0)  # the pairs before one symbol lie side by side


@lru_cache(1 << 16)
def _readings(c: str, again: bool, first: bool) -> tuple[dict[int, str], float, float | None]:
    """What a lower-case character may stand for: letters by symbol, the log probability of each, that of nothing.

    `again` tells that it repeats the one before it. A mark that begins a word is a letter, unless it often opens words.
    """
    if c.isalpha():
        letters, cost = c, KEEP
    elif c in DISGUISES:
        letters, cost = DISGUISES[c], SWAP - np.log(len(DISGUISES[c]))
    else:
        letters, cost = "" if c in SEPARATORS else c, KEEP
    drop = None
    if c in SEPARATORS or again or not c.isalnum() and c not in DISGUISES:
        drop = DROP
    elif not c.isalnum() and c not in "@$" and (not first or c in OPENING):
        drop = DROP_MARK
    return {int(symbol(np.array([ord(x)]))[0]): x for x in letters}, cost, drop


def _advance(states: np.ndarray, reading: tuple, model: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray], np.ndarray | None]:
    """States after one more character, the best symbol before last by symbol read, and where it is read as nothing."""
    letters, cost, drop = reading
    after = np.full(states.shape, -np.inf)
    before = {}
    for x in letters:
        total = states + model[:, :, x]
        before[x] = total.argmax(0)
        after[:, x] = total[before[x], _SYMBOLS] + cost
    if drop is None:
        return after, before, None
    nothing = states + drop >= after
    return np.where(nothing, states + drop, after), before, nothing


def restore(word: str, model: np.ndarray) -> str:
    """The likeliest spelling of a written word: Viterbi over the lattice of what its characters may stand for.

    A character stands for itself, for a letter of DISGUISES, or, if it separates letters or repeats the one before
    it, for nothing. States are all pairs of last symbols, none is cut. Long words are gone through in pieces whose
    first states are kept and read again backwards, so that memory grows with the number of pieces only.
    """
    word = word.lower()
    readings = [_readings(c, i > 0 and c == word[i - 1], i == 0) for i, c in enumerate(word)]
    states = np.full((ALPHABET, ALPHABET), -np.inf)
    states[0, 0] = 0.0
    pieces = [readings[i:i + PIECE] for i in range(0, len(readings), PIECE)] or [[]]
    first = [states]
    for piece in pieces[:-1]:
        for reading in piece:
            states, _, _ = _advance(states, reading, model)
        first.append(states)
    letters, place = [], None
    for states, piece in zip(reversed(first), reversed(pieces)):
        back = []
        for reading in piece:
            states, *pointers = _advance(states, reading, model)
            back.append(pointers)
        if place is None:
            place = divmod(int((states + model[:, :, 0]).argmax()), ALPHABET)
        for (options, _, _), (before, nothing) in zip(reversed(piece), reversed(back)):
            two, one = place
            if nothing is None or not nothing[two, one]:
                letters.append(options[one])
                place = int(before[one][two]), two
    return "".join(reversed(letters))


def _tail_scores(tail: str, begins: bool, model: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The best score of reading a tail and the word's end after each pair of symbols, and the choice at each place (0 nothing).

    `begins` tells that the tail is the whole word.
    """
    scores, choices = model[:, :, 0].astype(np.float64), []
    for i in range(len(tail) - 1, -1, -1):
        letters, cost, drop = _readings(tail[i], i > 0 and tail[i] == tail[i - 1], begins and i == 0)
        ways = np.stack([np.full(scores.shape, -np.inf) if drop is None else scores + drop, *(model[:, :, x] + cost + scores[:, x] for x in letters)])
        choices.append(ways.argmax(0).astype(np.uint8))
        scores = ways.max(0)
    return scores.ravel(), choices[::-1]


def _tail_text(tail: str, begins: bool, choices: list[np.ndarray], state: int) -> str:
    two, one = divmod(state, ALPHABET)
    text = ""
    for i, choice in enumerate(choices):
        if choice[two, one]:
            x, letter = list(_readings(tail[i], i > 0 and tail[i] == tail[i - 1], begins and i == 0)[0].items())[choice[two, one] - 1]
            two, one, text = one, x, text + letter
    return text


def restore_all(words: list[str], model: np.ndarray, tails: dict[tuple, tuple] | None = None) -> list[str]:
    """`restore` of many words side by side, with equal results.

    All words advance by one character at a time; only states that occur are held. What follows a word's last letter or
    digit, the same few marks in many words, is scored once, from its end. Long words, and those with three stars or crosses
    side by side before one, go one by one.
    """
    tails = {} if tails is None else tails
    if len(words) > LOT:
        return [x for i in range(0, len(words), LOT) for x in restore_all(words[i:i + LOT], model, tails)]
    words = [w.lower() for w in words]
    out = [""] * len(words)
    ends = [max((i + 1 for i, c in enumerate(w) if c.isalnum()), default=0) for w in words]
    alone = [i for i, w in enumerate(words) if len(w) > CACHED_CHARS or _WIDE.search(w, 0, ends[i])]
    for i in alone:
        out[i] = restore(words[i], model)
    aside = set(alone)
    order = np.array([i for i in range(len(words)) if i not in aside], np.int64)
    if not len(order):
        return out
    size = np.array(ends, np.int64)[order]
    kinds: dict[tuple[str, bool, bool], int] = {}
    reading = np.zeros((len(order), int(size.max())), np.int64)
    for row, i in enumerate(order.tolist()):
        last = ""
        for t, c in enumerate(words[i][:ends[i]]):
            reading[row, t] = kinds.setdefault((c, c == last, t == 0), len(kinds))
            last = c
    known = [_readings(*kind) for kind in kinds]
    ways = np.array([len(x[0]) for x in known], np.int64)
    begin = np.cumsum(ways) - ways
    symbols = np.array([x for r in known for x in r[0]], np.int64)
    letter = np.array([ord(x) for r in known for x in r[0].values()], np.uint32)
    cost = np.array([x[1] for x in known])
    drop = np.array([-np.inf if x[2] is None else x[2] for x in known])

    word, code, score = np.arange(len(order)), np.zeros(len(order), np.int64), np.zeros(len(order))
    steps, final = [], np.zeros(len(order), np.int64)
    final_state = np.zeros(len(order), np.int64)
    own_tails = [(words[i][ends[i]:], not ends[i]) for i in order.tolist()]
    fresh = set(own_tails) - tails.keys()
    if len(fresh) + len(tails) > LOT:
        tails.clear()
        fresh = set(own_tails)
    for tail in fresh:
        tails[tail] = _tail_scores(*tail, model)
    of_tail = {tail: i for i, tail in enumerate(dict.fromkeys(own_tails))}
    table = np.stack([tails[t][0] for t in of_tail])
    tail_of = np.array([of_tail[t] for t in own_tails], np.int64)
    for t in range(reading.shape[1] + 1):
        done = np.flatnonzero(size[word] == t)
        if len(done):
            best = done[np.lexsort((-(score[done] + table[tail_of[word[done]], code[done]]), word[done]))]
            best = best[np.concatenate([[True], np.diff(word[best]) > 0])]
            final[word[best]], final_state[word[best]] = best, code[best]
        going = np.flatnonzero(size[word] > t)
        if not len(going):
            break
        kind = reading[word[going], t]
        skip = np.isfinite(drop[kind])
        n = ways[kind]
        at = np.repeat(np.arange(len(going)), n)
        option = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n) + begin[kind][at]
        two, one = np.divmod(code[going][at], ALPHABET)
        parent = np.concatenate([going[skip], going[at]])
        chosen = np.concatenate([np.full(int(skip.sum()), -1), option])
        score = np.concatenate([score[going[skip]] + drop[kind[skip]], score[going[at]] + model[two, one, symbols[option]] + cost[kind[at]]])
        code = np.concatenate([code[going[skip]], one * ALPHABET + symbols[option]])
        key = word[parent] * ALPHABET**2 + code
        by = np.argsort(key, kind="stable")
        group = np.concatenate([[True], np.diff(key[by]) != 0])
        best = np.maximum.reduceat(score[by], np.flatnonzero(group))[np.cumsum(group) - 1]
        by, which = by[score[by] == best], (np.cumsum(group) - 1)[score[by] == best]
        by = by[np.concatenate([[True], np.diff(which) != 0])]
        word, code, score = word[parent[by]], code[by], score[by]
        steps.append((parent[by], chosen[by]))
    text = np.zeros(reading.shape, np.uint32)
    for t in range(len(steps) - 1, -1, -1):
        live = np.flatnonzero(size > t)
        parent, chosen = steps[t]
        option = chosen[final[live]]
        text[live, t] = np.where(option < 0, 0, letter[np.maximum(option, 0)])
        final[live] = parent[final[live]]
    whole = text[text > 0].tobytes().decode("utf-32-le")
    cuts = np.concatenate([[0], np.cumsum((text > 0).sum(1))]).tolist()
    for row, i in enumerate(order.tolist()):
        out[i] = whole[cuts[row]:cuts[row + 1]]
        tail = own_tails[row]
        if tail[0]:
            out[i] += _tail_text(*tail, tails[tail][1], int(final_state[row]))
    return out


class Reader:
    """Hashes of the words and word beginnings of texts, with disguised words restored."""

    def __init__(self, model: np.ndarray):
        self.model, self.known, self.tails = model, {}, {}

    def restored(self, words: list[str]) -> list[str]:
        """The likeliest spellings; those found before are remembered."""
        fresh = list(dict.fromkeys(w for w in words if w not in self.known))
        own = dict(zip(fresh, restore_all(fresh, self.model, self.tails)))
        out = [own[w] if w in own else self.known[w] for w in words]
        if len(self.known) + len(own) > CACHED:
            self.known.clear()
        self.known.update((w, x) for w, x in own.items() if len(w) <= CACHED_CHARS)
        return out

    def features(self, seg: K.Segment) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash): each word without closing marks, and its first 4, 5 and 6 bytes, of the text and of restored words.

        Restored are words with a disguise, a separator inside or a character twice in a row, and runs of two and
        more single characters, read as one word from each of its places to its end, and for 3 to 8 letters. Words
        without a letter are numbers unless they hold two disguises that are no digits.
        """
        data = K.LOWER[seg.data]
        start, end, row = K.words(seg)
        close = end.copy()
        for _ in range(2):
            shorter = (close - start > 1) & _CLOSING[data[close - 1]]
            close[shorter] -= 1
        white = np.concatenate([[True], K.WHITE[data], [True]])
        twice = np.concatenate([data[1:] == data[:-1], [False]]) if len(data) else np.zeros(0, bool)
        if len(data) > 3:
            twice[:-3] |= (data[2:-1] == data[:-3]) & (data[3:] == data[1:-2]) & (data[:-3] >= 0xC0)
        letters, marks, hidden, inside, doubled = (np.concatenate([[0], np.cumsum(x)]) for x in (
            _LETTER[data], _MARK[data], _DISGUISE[data], _SEPARATOR[data] & ~white[:-2] & ~white[2:], twice))
        has = lambda x, b=close: x[b] - x[start]
        odd = np.flatnonzero(((has(letters) > 0) | (has(marks) > 1)) & ((has(hidden) > 0) | (has(inside) > 0) | (has(doubled, close - 1) > 0)))
        parts = [(data, start, end, row, True)]
        if len(odd):
            _, at, which = np.unique(K.span_hashes(data, start[odd], close[odd]), return_index=True, return_inverse=True)
            written = [data[start[i]:close[i]].tobytes().decode("utf-8", "replace").lower() for i in odd[at].tolist()]
            spelt, a, b = _joined(["" if own == w.rstrip("!") else own for w, own in zip(written, self.restored(written))])
            some = b[which] > a[which]
            parts.append((spelt, a[which][some], b[which][some], row[odd][some], True))
        points = K.char_counts(data)
        single = (points[end] - points[start] == 1) & (_LETTER[data[start]] | _DISGUISE[data[start]]) if len(start) else np.zeros(0, bool)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.where(single, row + 1, 0), [0]])))
        runs = [(a, b) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())
                if b - a > 1 and single[a] and (letters[end[b - 1]] > letters[start[a]] or marks[end[b - 1]] - marks[start[a]] > 1)]
        if runs:
            spelt, a, b = _joined(self.restored(["".join(data[start[i]:end[i]].tobytes().decode("utf-8", "replace") for i in range(*run)) for run in runs]))
            size = b - a
            place = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
            last, owner = np.repeat(b, size), np.repeat(row[[run[0] for run in runs]], size)
            begins = (spelt[place] & 0xC0) != 0x80
            place, last, owner = place[begins], last[begins], owner[begins]
            parts.append((spelt, place, last, owner, True))
            for n in SPELT:
                inner = place + n < last
                parts.append((spelt, place[inner], place[inner] + n, owner[inner], False))
        rows, hashes = [], []
        for d, a, b, r, beginnings in parts:
            if not len(a):
                continue
            b = b.copy()
            for _ in range(2):
                shorter = (b - a > 1) & _TRAIL[d[b - 1]]
                b[shorter] -= 1
            for k, upto in ((0, b), *((k, np.minimum(a + k, b)) for k in PREFIXES if beginnings)):
                whole = upto == b if k else np.zeros(len(a), bool)
                own = K.span_hashes(d, a, upto) ^ K.U(k * 0x9E37)
                rows.append(r[~whole])
                hashes.append(own[~whole])
        return (np.concatenate(rows), np.concatenate(hashes)) if rows else (np.zeros(0, np.int64), np.zeros(0, K.U))


def _joined(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of words one after another, and where each begins and ends."""
    parts = [x.encode() for x in words]
    cuts = np.concatenate([[0], np.cumsum([len(x) for x in parts], dtype=np.int64)]).astype(np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), cuts[:-1], cuts[1:]


@dataclass
class Scorer:
    """Sorted feature hashes with their log odds, and the calibration of (1, largest odds, number of words found)."""

    characters: np.ndarray
    hashes: np.ndarray
    odds: np.ndarray
    calibration: np.ndarray

    def evidence(self, reader: Reader, seg: K.Segment) -> np.ndarray:
        row, own = reader.features(seg)
        best, found = np.zeros(seg.rows), np.zeros(seg.rows)
        if len(self.hashes) and len(own):
            near = np.zeros(1 << 20, bool)
            near[(self.hashes >> K.U(44)).astype(np.int64)] = True
            maybe = near[(own >> K.U(44)).astype(np.int64)]
            row, own = row[maybe], own[maybe]
            at = np.minimum(np.searchsorted(self.hashes, own), len(self.hashes) - 1)
            hit = self.hashes[at] == own
            np.maximum.at(best, row[hit], self.odds[at[hit]])
            np.add.at(found, row[hit], 1)
        return np.stack([np.ones(seg.rows), best, np.minimum(found, 5)], axis=1)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.calibration, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-3) -> np.ndarray:
    beta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * weight.sum() * np.eye(x.shape[1])
        beta = beta + np.linalg.solve(curve, x.T @ (weight * (y - p)) - penalty * weight.sum() * beta)
    return beta


def train(docs: DataFrame, labels: DataFrame, documents: int = TRAINING_DOCUMENTS, chars: int = TRAINING_CHARS) -> Scorer:
    """Character model of all texts; lexicon and calibration from labelled documents.

    Labels are learnt only from rows with crc32(doc_id) mod 5 != 0: at most `documents` of each label, the first by
    a hash of the id, of at most `chars` characters. A feature enters the lexicon if toxic documents hold it more
    often than others with a log-likelihood ratio of 20 or more, nine tenths of its documents being toxic. Without both labels every score is a half.
    """
    characters = character_model(docs)
    known = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(cast(doc_id AS string)) % 5 != 0")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    sample = [known.where(F.col("toxic") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(documents) for q in (0, 1)]
    chosen = F.broadcast(sample[0].union(sample[1]).toDF("chosen_id", "toxic"))
    rows = (docs.select("doc_id", "text").where(F.length("text") <= chars).join(chosen, F.col("doc_id") == F.col("chosen_id"))
            .select("toxic", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(characters)
        for batch in batches:
            toxic = batch.column(0).to_numpy()
            for seg in K.segments(batch.column(1)):
                row, own = reader.features(seg)
                pairs = np.unique(np.stack([row.astype(K.U), own]), axis=1) if len(own) else np.zeros((2, 0), K.U)
                label = toxic[seg.first:seg.last][pairs[0].astype(np.int64)]
                feature, at = np.unique(pairs[1], return_inverse=True)
                bad = np.bincount(at, weights=label, minlength=len(feature)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(feature.view(np.int64)), pa.array(bad), pa.array(np.bincount(at, minlength=len(feature)) - bad, pa.int64())],
                    ["feature", "bad", "good"])

    empty = Scorer(characters, np.zeros(0, K.U), np.zeros(0), np.zeros(3))
    if not totals.get(0) or not totals.get(1):
        return empty
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_bad, n_good = n.get(1, 0), n.get(0, 0)
    if not n_bad or not n_good:
        return empty
    base = n_bad / (n_bad + n_good)
    seen = (rows.mapInArrow(count, "feature bigint, bad bigint, good bigint").groupBy("feature")
            .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).where("bad >= 3")
            .withColumn("p", F.expr("bad / (bad + good)")))
    part = lambda x, p, b: F.when(F.col(x) > 0, F.col(x) * F.log(p / F.lit(b))).otherwise(0.0)
    strong = (seen.where(F.col("p") > base)
              .where(2 * (part("bad", F.col("p"), base) + part("good", 1 - F.col("p"), 1 - base)) >= EVIDENCE)
              .where("p >= 0.9").collect())
    hashes = np.array([r["feature"] for r in strong], np.int64).view(K.U)
    odds = np.array([np.log((r["bad"] + 0.5) / (r["good"] + 0.5) * n_good / n_bad) for r in strong])
    order = np.argsort(hashes)
    scorer = Scorer(characters, hashes[order], odds[order], np.zeros(3))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(characters)
        for batch in batches:
            for seg in K.segments(batch.column(1)):
                found = scorer.evidence(reader, seg)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(seg.first, seg.rows), pa.array(found[:, 1]), pa.array(found[:, 2])], ["toxic", "best", "found"])

    fit = rows.mapInArrow(weigh, "toxic int, best double, found double").groupBy("toxic", "best", "found").count().collect()
    x = np.array([[1.0, r["best"], r["found"]] for r in fit])
    y = np.array([r["toxic"] for r in fit], float)
    weight = np.array([r["count"] * totals[r["toxic"]] / n[r["toxic"]] for r in fit])
    scorer.calibration = _logistic(x, y, weight / weight.mean(), 1e-4)
    return scorer


def score_toxicity(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """(doc_id, n_found, score) for each row of docs: words of the lexicon found, probability of being toxic.

    Null and empty texts have the score of a text without such words. A null doc_id stays null; repeated rows are
    scored one by one; other columns are not read; an empty table gives no rows.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(scorer.characters)
        for batch in batches:
            for seg in K.segments(batch.column(1)):
                found = scorer.evidence(reader, seg)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(seg.first, seg.rows), pa.array(found[:, 2].astype(np.int64)), pa.array(scorer.score(found))], ["doc_id", "n_found", "score"])

    return docs.selectExpr("cast(doc_id AS bigint) doc_id", "text").mapInArrow(task, "doc_id bigint, n_found bigint, score double")
