"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kinlink.llm import kernels as K

SPACE = "▁"
DROPOUT, SEED = 0.1, 0
#: States of chunks that a task keeps, and skips in the past of a state up to which what follows is kept.
CACHED, KEPT_SKIPS = 200_000, 2
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
_MASK = (1 << 64) - 1


class Vocabulary:
    """Pieces and scores of a BPE model with byte fallback; spaces are kept as spaces."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.scores = scores
        self.merged = {p.replace(SPACE, " "): i for i, p in enumerate(pieces) if kinds[i] == "normal"}
        self.bytes = [0] * 256
        self.table = [b""] * len(pieces)
        for i, (piece, kind) in enumerate(zip(pieces, kinds)):
            if kind == "byte":
                self.bytes[int(piece[1:-1], 16)] = i
                self.table[i] = bytes([int(piece[1:-1], 16)])
            elif kind == "normal":
                self.table[i] = piece.replace(SPACE, " ").encode()
        if any(re.search("[^ ] ", p) for p in self.merged):
            raise ValueError("pieces that go on after a space are not supported")

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        kind = lambda i: "byte" if model.is_byte(i) else "special" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else "normal"
        return cls([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], [kind(i) for i in range(n)])

    @cached_property
    def rank(self) -> dict[str, int]:
        """Place of each piece in the order of merging: by score from the highest, then by id."""
        order = sorted(self.merged.items(), key=lambda e: (-self.scores[e[1]], e[1]))
        return {piece: i for i, (piece, _) in enumerate(order)}

    @cached_property
    def arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Id of each code point or -1; sorted pairs of ids that make a piece, with its rank; id of each rank."""
        characters = np.full(0x110000, -1, np.int32)
        made = {}
        for piece, own in self.merged.items():
            if len(piece) == 1:
                characters[ord(piece)] = own
            for i in range(1, len(piece)):
                left, right = self.merged.get(piece[:i]), self.merged.get(piece[i:])
                if left is not None and right is not None:
                    made[left << 32 | right] = self.rank[piece]
        pairs = np.array(sorted(made) or [-2], np.int64)
        ranks = np.array([made[p] for p in sorted(made)] or [0], np.int64)
        return characters, pairs, ranks, np.array([self.merged[p] for p in self.rank] or [0], np.int64)

    @cached_property
    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in self.table])
        return np.frombuffer(b"".join(self.table), np.uint8), np.concatenate([[0], np.cumsum(size)])[:-1], size


_C1, _C2, _C3, _C4, _C5 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _text_hashes(points: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A hash of each run of code points, from each point and its place in the run."""
    place = np.arange(len(points)) - np.repeat(start, size)
    return np.add.reduceat(K.mix(points.astype(K.U) + (place.astype(K.U) << K.U(32))), start)


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def encode_chunk(vocabulary: Vocabulary, chunk: str, key: int = 0, dropout: float = 0.0) -> list[int]:
    """Ids of one chunk. The best merge of the agenda, by score and then from the left, comes next; it is skipped,
    for good, if the hash of (key, chunk, place, piece) falls under the dropout."""
    rank, merged, limit = vocabulary.rank, vocabulary.merged, int(dropout * (1 << 32))
    own_hash = int(_text_hashes(_code_points(chunk), np.array([0]), np.array([len(chunk)]))[0])
    text, n = list(chunk), len(chunk)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    agenda: list[tuple[int, int, int, int]] = []

    def propose(left: int, right: int) -> None:
        if left >= 0 and right >= 0 and (own := rank.get(text[left] + text[right])) is not None:
            heapq.heappush(agenda, (own, left, right, len(text[left]) + len(text[right])))

    for i in range(n - 1):
        propose(i, i + 1)
    while agenda:
        _, left, right, size = heapq.heappop(agenda)
        if not text[left] or after[left] != right or len(text[left]) + len(text[right]) != size:
            continue  # a part has been merged with another since
        both = text[left] + text[right]
        h = ((own_hash + left * _C2 + merged[both] * _C3 & _MASK) ^ key) * _C4 & _MASK
        if ((h ^ h >> 29) * _C5 & _MASK) >> 32 < limit:
            continue
        text[left], text[right] = both, ""
        after[left] = after[right]
        if after[left] >= 0:
            before[after[left]] = left
        propose(before[left], left)
        propose(left, after[left])
    out = []
    for part in filter(None, text):
        own = merged.get(part)
        out += [own] if own is not None else [vocabulary.bytes[b] for b in part.encode("utf-8", "surrogatepass")]
    return out


def _skipped(salt: np.ndarray, keys: np.ndarray, limit: np.uint64) -> np.ndarray:
    """Whether merges, known by the hash of their chunk, place and piece, are skipped under the keys."""
    h = (salt ^ keys) * K.U(_C4)
    return (((h ^ (h >> K.U(29))) * K.U(_C5)) >> K.U(32)) < limit


def _merged(vocabulary: Vocabulary, chunks: list[str], skips: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the chunks, one after the other, and where each chunk's end.

    Each step does, or skips, the best merge of every chunk's agenda; `skips` says which, from the number of the
    step, the chunks that have a merge left and the hashes of their merges.
    """
    characters, pairs, pair_rank, rank_piece = vocabulary.arrays
    none = np.int64(1) << 62
    points = _code_points("".join(chunks))
    size = np.fromiter(map(len, chunks), np.int64, len(chunks))
    end = np.cumsum(size)
    start = end - size
    n = len(points)
    ids = characters[points].astype(np.int64)
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[end - 1] = -1
    before[start] = -1
    hashes = _text_hashes(points, start, size)

    def agenda_of(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and place of merging the symbols at two places, `none` if they make no piece."""
        out = np.full(len(left), none)
        two = np.flatnonzero((left >= 0) & (right >= 0))
        a, b = ids[left[two]], ids[right[two]]
        key = np.where((a >= 0) & (b >= 0), a << 32 | b, -1)
        at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        hit = pairs[at] == key
        out[two[hit]] = pair_rank[at[hit]] << 32 | left[two[hit]]
        return out

    agenda = np.append(agenda_of(np.arange(n), after), none)
    gone, active, step = np.zeros(n, bool), np.arange(len(chunks)), 0
    while len(active):
        edges = np.empty(2 * len(active), np.int64)
        edges[0::2], edges[1::2] = start[active], end[active]
        best = np.minimum.reduceat(agenda, edges)[::2]
        left_over = best < none
        active, best = active[left_over], best[left_over]
        left, piece = best & 0xFFFFFFFF, rank_piece[best >> 32]
        skip = skips(step, active, hashes[active] + (left - start[active]).astype(K.U) * K.U(_C2) + piece.astype(K.U) * K.U(_C3))
        agenda[left[skip]] = none
        left, piece = left[~skip], piece[~skip]
        right = after[left]
        ids[left], gone[right], agenda[right] = piece, True, none
        following, previous = after[right], before[left]
        after[left] = following
        before[following[following >= 0]] = left[following >= 0]
        agenda[left] = agenda_of(left, following)
        agenda[previous[previous >= 0]] = agenda_of(previous, left)[previous >= 0]
        step += 1
    width = (~gone).astype(np.int64)
    unknown = np.flatnonzero(~gone & (ids < 0))
    as_bytes = [chr(p).encode("utf-8", "surrogatepass") for p in points[unknown].tolist()]
    width[unknown] = [len(b) for b in as_bytes]
    cuts = np.concatenate([[0], np.cumsum(width)])
    out = np.repeat(ids, width).astype(np.int32)
    for at, own in zip(cuts[unknown].tolist(), as_bytes):
        out[at:at + len(own)] = [vocabulary.bytes[b] for b in own]
    return out, cuts[end]


def encode_chunks(vocabulary: Vocabulary, chunks: list[str], keys: np.ndarray, dropout: float) -> list[bytes]:
    """encode_chunk for many chunks at once, as packed int32."""
    limit = K.U(int(dropout * (1 << 32)))
    ids, ends = _merged(vocabulary, chunks, lambda _, active, salt: _skipped(salt, keys[active], limit))
    packed, cuts = ids.tobytes(), [0, *(4 * ends).tolist()]
    return [packed[a:b] for a, b in zip(cuts, cuts[1:])]


class _Rows:
    """An array that grows at its end."""

    def __init__(self, kind: type):
        self.held, self.n = np.zeros(1024, kind), 0

    @property
    def all(self) -> np.ndarray:
        return self.held[:self.n]

    def add(self, more: np.ndarray) -> None:
        if self.n + len(more) > len(self.held):
            self.held = np.concatenate([self.all, np.zeros(self.n + 2 * len(more), self.held.dtype)])
        self.held[self.n:self.n + len(more)] = more
        self.n += len(more)


def _places(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... size[0] of them, then those of first[1], and so on."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class States:
    """What is left to do for a chunk once certain of its merges were skipped, for any occurrence of it.

    A state is a chunk and the steps that it skipped. It has the merges that come up from there on if none of them
    is skipped, the ids that this gives, and for each of these merges the state that skipping it leads to, or -1.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.first, self.chunks = vocabulary, {}, []
        self.chunk, self.skips, self.depth = _Rows(np.int64), _Rows(np.uint64), _Rows(np.int64)
        self.merges, self.n_merges, self.ids_at, self.n_ids = (_Rows(np.int64) for _ in range(4))
        self.salt, self.step, self.following, self.ids = _Rows(np.uint64), _Rows(np.int64), _Rows(np.int64), _Rows(np.int32)

    def add(self, chunk: np.ndarray, skips: np.ndarray, depth: int) -> np.ndarray:
        """Numbers of new states of the chunks with these numbers; bit t of `skips` is set if step t was skipped."""
        seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def told(t: int, active: np.ndarray, salt: np.ndarray) -> np.ndarray:
            left = skips[active] >> K.U(t)
            open_ = left == 0
            seen.append((active[open_], np.full(int(open_.sum()), t), salt[open_]))
            return (left & K.U(1)) == 1

        ids, ends = _merged(self.vocabulary, [self.chunks[c] for c in chunk.tolist()], told)
        own, step, salt = (np.concatenate(x) for x in zip(*seen))
        order = np.argsort(own, kind="stable")
        n = np.bincount(own, minlength=len(chunk))
        new = self.chunk.n + np.arange(len(chunk))
        starts = np.concatenate([[0], ends])
        for rows, more in ((self.merges, self.salt.n + np.cumsum(n) - n), (self.n_merges, n), (self.ids_at, self.ids.n + starts[:-1]),
                           (self.n_ids, np.diff(starts)), (self.chunk, chunk), (self.skips, skips), (self.depth, np.full(len(chunk), depth)),
                           (self.salt, salt[order]), (self.step, step[order]), (self.following, np.full(len(own), -1)), (self.ids, ids)):
            rows.add(more)
        return new

    def beginnings(self, chunks: list[str]) -> None:
        numbers = np.arange(len(self.chunks), len(self.chunks) + len(chunks))
        self.chunks += chunks
        self.first.update(zip(chunks, self.add(numbers, np.zeros(len(chunks), K.U), 0).tolist()))

    def after_skip(self, state: np.ndarray, merge: np.ndarray) -> np.ndarray:
        """The states that skipping a merge leads to."""
        missing, at = np.unique(merge[self.following.all[merge] < 0], return_index=True)
        if len(missing):
            own = state[self.following.all[merge] < 0][at]
            skips = self.skips.all[own] | (K.U(1) << self.step.all[missing].astype(K.U))
            new = self.add(self.chunk.all[own], skips, int(self.depth.all[own[0]]) + 1)
            self.following.all[missing] = new
        return self.following.all[merge]


def occurrence_keys(seed: int, doc_ids: list[int | None], copies: list[int], chunks: np.ndarray) -> np.ndarray:
    """A key for each chunk of each document, from the seed, the document's id and copy, and the chunk's place in it."""
    null = np.array([d is None for d in doc_ids], bool)
    ids = np.array([d or 0 for d in doc_ids], np.int64).view(K.U)
    own = K.mix(np.full(len(doc_ids), K.U(seed & _MASK)) + K.U(_C1))
    for part in (null.astype(K.U), ids, np.array(copies, np.int64).view(K.U)):
        own = K.mix(own * K.U(_C1) + part + K.U(_C2))
    return K.mix(np.repeat(own, chunks) + _places(np.zeros(len(chunks), np.int64), chunks).astype(K.U) * K.U(_C1))


class Encoder:
    """Encodes texts. Each occurrence of a chunk draws its own skips; what chunks come to after skips is kept."""

    CHUNKS = re.compile(r" *[^ \n]+|\n| +")
    #: Chunks of more characters are merged one by one.
    LONG = 200
    #: Chunks of at most so many characters have states: they propose three merges a character at most, one bit each.
    SHORT = 21

    def __init__(self, vocabulary: Vocabulary, dropout: float, seed: int):
        self.vocabulary, self.dropout, self.seed = vocabulary, dropout, seed
        self.limit = K.U(int(dropout * (1 << 32)))
        self.states = States(vocabulary)

    def _drawn(self, state: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The last state of each occurrence, from its first; -1 if more merges are skipped than states are kept for."""
        states, last, at = self.states, state.copy(), np.arange(len(state))
        for depth in range(KEPT_SKIPS + 1):
            own = last[at]
            n = states.n_merges.all[own]
            merge = _places(states.merges.all[own], n)
            hit = np.flatnonzero(_skipped(states.salt.all[merge], np.repeat(keys[at], n), self.limit))
            which = np.searchsorted(np.cumsum(n), hit, "right")
            new = np.ones(len(which), bool)
            new[1:] = which[1:] != which[:-1]  # the first skip of each
            at, own, merge = at[which[new]], own[which[new]], merge[hit[new]]
            if not len(at):
                break
            last[at] = states.after_skip(own, merge) if depth < KEPT_SKIPS else -1
        return last

    def encode(self, texts: list[str], doc_ids: list[int | None], copies: list[int] | None = None) -> list[np.ndarray]:
        """Ids of each text after a space, as SentencePiece adds one; an empty text has none."""
        if self.states.chunk.n > CACHED:
            self.states = States(self.vocabulary)
        cut = [self.CHUNKS.findall(" " + text) if text else [] for text in texts]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        chunks = [c for own in cut for c in own]
        if not chunks:
            return [np.zeros(0, np.int32) for _ in texts]
        keys = occurrence_keys(self.seed, doc_ids, copies or [0] * len(texts), n)
        known = self.states.first
        missing = [c for c in dict.fromkeys(chunks) if c not in known and len(c) <= self.SHORT]
        if missing:
            self.states.beginnings(missing)
        state = np.fromiter((known.get(c, -1) for c in chunks), np.int64, len(chunks))
        kept = np.flatnonzero(state >= 0)
        if self.limit and len(kept):
            state[kept] = self._drawn(state[kept], keys[kept])
        apart = np.flatnonzero(state < 0)
        short = [i for i in apart.tolist() if len(chunks[i]) <= self.LONG]
        own_ids = dict(zip(short, encode_chunks(self.vocabulary, [chunks[i] for i in short], keys[short], self.dropout))) if short else {}
        for i in apart.tolist():
            if i not in own_ids:
                own_ids[i] = np.array(encode_chunk(self.vocabulary, chunks[i], int(keys[i]), self.dropout), np.int32).tobytes()
        more = [np.frombuffer(own_ids[i], np.int32) for i in apart.tolist()]
        size, first = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64)
        held = state >= 0
        size[held], first[held] = self.states.n_ids.all[state[held]], self.states.ids_at.all[state[held]]
        size[apart] = [len(x) for x in more]
        out = np.empty(int(size.sum()), np.int32)
        place = np.cumsum(size) - size
        out[_places(place[held], size[held])] = self.states.ids.all[_places(first[held], size[held])]
        for i, x in zip(place[apart].tolist(), more):
            out[i:i + len(x)] = x
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])].tolist()
        return [out[a:b] for a, b in zip(ends, ends[1:])]


def decode_ids(vocabulary: Vocabulary, ids: np.ndarray) -> bytes:
    """UTF-8 bytes of the text that the ids stand for, without the added space."""
    data, first, size = vocabulary.flat
    own = size[ids]
    if not len(ids):
        return b""
    starts = np.cumsum(own) - own
    return data[np.repeat(first[ids] - starts, own) + np.arange(int(own.sum()))].tobytes()[1:]


def _encoded(doc_ids: pa.Array, ids: list[np.ndarray], **more: pa.Array) -> pa.RecordBatch:
    cuts = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
    flat = pa.array(np.concatenate(ids), pa.int32())
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(np.diff(cuts), pa.int64()), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat), *more.values()],
        ["doc_id", "n_tokens", "ids", *more])


def encode(docs: DataFrame, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED, copy: str = "0") -> DataFrame:
    """(doc_id, n_tokens, ids) for each row of docs.

    Texts are cut before runs of spaces and around line feeds, where no piece of the model crosses. Each chunk is
    merged from characters by an agenda ordered by score, then place; each merge that comes up is skipped with
    probability `dropout` by a hash keyed by the seed, the doc_id, the number that the expression `copy` gives, the
    chunk's place in the text, its text, the merge's place in it and the piece: every occurrence draws its own.
    Characters outside the vocabulary, and U+2581 itself, become byte pieces, so `decode` gives the text back for
    any seed. Null and empty texts have no ids. A null doc_id stays null and has a key of its own; repeated rows get
    the same ids unless `copy` tells them apart; other columns are not read; an empty table gives no rows.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, dropout, seed)
        for batch in batches:
            own_ids, copies = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for seg in K.segments(batch.column(1)):
                ids = encoder.encode([seg.text(i) for i in range(seg.rows)], own_ids[seg.first:seg.last], copies[seg.first:seg.last])
                yield _encoded(batch.column(0).slice(seg.first, seg.rows), ids)

    return docs.selectExpr("cast(doc_id AS bigint) doc_id", "text", f"cast({copy} AS bigint) copy").mapInArrow(task, "doc_id bigint, n_tokens bigint, ids array<int>")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids, text) for rows with doc_id and ids; null ids give an empty text."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1)
            texts = [decode_ids(vocabulary, x.values.to_numpy()).decode("utf-8", "replace") if x.is_valid else "" for x in ids]
            sizes = [len(x) if x.is_valid else 0 for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), ids, pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(task, "doc_id bigint, n_tokens bigint, ids array<int>, text string")


def numbered_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, text, copy): rows of one id and text are numbered from 0, so that `encode` can tell them apart."""
    same = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    return docs.selectExpr("cast(doc_id AS bigint) doc_id", "text").withColumn("copy", F.row_number().over(same) - 1)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """(doc_id, n_tokens, ids, lossless): encodes as `encode` does, decodes, and compares with the text."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary, dropout, seed)
        for batch in batches:
            own_ids = batch.column(0).to_pylist()
            for seg in K.segments(batch.column(1)):
                ids = encoder.encode([seg.text(i) for i in range(seg.rows)], own_ids[seg.first:seg.last])
                back = [decode_ids(vocabulary, x) == seg.data[seg.offsets[i]:seg.offsets[i + 1]].tobytes() for i, x in enumerate(ids)]
                yield _encoded(batch.column(0).slice(seg.first, seg.rows), ids, lossless=pa.array(back, pa.bool_()))

    return (docs.selectExpr("cast(doc_id AS bigint) doc_id", "text")
            .mapInArrow(task, "doc_id bigint, n_tokens bigint, ids array<int>, lossless boolean"))
