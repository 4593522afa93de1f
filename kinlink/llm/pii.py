"""Personal data: fixed patterns as seeds, then bootstrapped contextual extraction of identifiers they miss."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinlink.llm import kernels as K
from kinlink.llm.store import written

KINDS = ("email", "ip", "card", "phone")
ROUNDS, MIN_SEEDS, MIN_SHARE, CONFIDENCE = 4, 4, 0.25, 0.8
#: Bits of a hash filter for each value in it, and the bounds of its size as powers of two (32 MB). Joins after it are exact.
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 16, 28

# The patterns that define the base entities.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_OPENING, _CLOSING = "\"'([{<", "\"')]}>.,;:!?"
#: Number-like words are of digits and these; a mark after the last word of a run is no part of it.
_JOINING, _ENDING = "+().-/", ",;:!?\"'"
_NUMBER = r"[+()./-]*[0-9][0-9+()./-]*"
_RUN = re.compile(rf"(?<![^\x20\x09-\x0D]){_NUMBER}(?:[\x20\x09-\x0D]+{_NUMBER})+(?=[,;:!?\"']*(?:[\x20\x09-\x0D]|$))")


def _marks(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


_OPEN, _CLOSE, _END, _LIKE = _marks(_OPENING), _marks(_CLOSING), _marks(_ENDING), _marks(_JOINING) | _DIGIT
#: What words of a language, and short numbers, are made of.
_PLAIN = _DIGIT | _marks("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-'")
_PLAIN[128:] = True


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        own = ord(d) - 48
        total += own if i % 2 == 0 else own * 2 - 9 * (own > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each @ outwards, so that long runs of letters cost no second look."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the base entities, by start, then kind in the order of KINDS; code points."""
    found = [(a, 0, b) for a, b in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x[-4:].lstrip("0") or 0) <= 255 for x in m.group().split("."))]
    for m in CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= sum(c in "0123456789" for c in m.group()) <= 15]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


_BEFORE = re.compile(r"[^\x20\x09-\x0D]+")
_AFTER = re.compile(r"[^\x20\x09-\x0D]*[\x20\x09-\x0D]+([^\x20\x09-\x0D]+)")


def _words_before(text: str, start: int) -> list[str]:
    """The last three words that end before `start`, a glued label such as `tel:` included."""
    reach = 64
    while True:
        words = _BEFORE.findall(text, max(0, start - reach), start)
        if len(words) > 3 or reach >= start:
            return words[-3:]
        reach *= 4


def _word_hashes(words: list[str]) -> np.ndarray:
    parts = [w.encode("utf-8", "replace") for w in words]
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    return K.span_hashes(K.LOWER[np.frombuffer(b"".join(parts), np.uint8)], cuts[:-1], cuts[1:])


def _pattern(kind: int, *hashes: np.ndarray) -> np.ndarray:
    """Hash of a lexical pattern: its kind and the hashes of its words, in order."""
    own = np.full_like(hashes[0], K.U(kind))
    for h in hashes:
        own = K.mix(own * K.U(0x9E3779B97F4A7C15) + h)
    return own


def _patterns(text: str, start: int, end: int) -> list[int]:
    """Patterns around a place: two words before (2); three before (3); one before and one after (1)."""
    before = _words_before(text, start)
    after = _AFTER.match(text, end)
    h = _word_hashes([*before, after.group(1) if after else ""])[:, None]
    n, out = len(before), []
    if n >= 2:
        out.append(_pattern(2, h[n - 2], h[n - 1]))
    if n == 3:
        out.append(_pattern(3, h[0], h[1], h[2]))
    if n and after:
        out.append(_pattern(1, h[n - 1], h[n]))
    return [int(x[0]) for x in np.array(out, K.U).reshape(-1, 1).view(np.int64)]


def _identifiers(text: str, taken: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Words with a digit outside the base entities and runs of numbers, five characters or more without marks around them."""
    out, taken = [], taken + [(m.start(), "", m.end()) for m in _RUN.finditer(text)]
    for m in re.finditer(r"[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", text):
        a, b = m.span()
        label = max(m.group().rfind("="), m.group().rfind(":"))
        a += label + 1 if 0 <= label < len(m.group()) - 1 else 0
        while a < b and text[a] in _OPENING:
            a += 1
        while b > a and text[b - 1] in _CLOSING:
            b -= 1
        if b - a >= 5 and not any(a < y and x < b for x, _, y in taken):
            out.append((a, b))
    return out


SCHEMA = ("doc_id bigint, text_hash bigint, base array<struct<kind:string,start:bigint,end:bigint>>, "
          "places array<struct<kind:string,start:bigint,end:bigint,instance:string,patterns:array<bigint>>>")
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_PLACE = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("patterns", pa.list_(pa.int64()))])


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for seg in K.segments(batch.column(1)):
            mark = np.concatenate([[0], np.cumsum(_DIGIT[seg.data] | (seg.data == 64))])
            busy = mark[seg.offsets[1:]] > mark[seg.offsets[:-1]]
            hashes = K.span_hashes(seg.data, seg.offsets[:-1], seg.offsets[1:]).view(np.int64)
            bases, places = [], []
            for i in range(seg.rows):
                base, own = [], []
                if busy[i]:
                    text = seg.text(i)
                    base = base_spans(text)
                    spots = [(kind, a, b) for a, kind, b in base] + [(None, a, b) for a, b in _identifiers(text, base)]
                    for kind, a, b in spots:
                        patterns = _patterns(text, a, b)
                        if patterns:
                            own.append({"kind": kind, "start": a, "end": b, "instance": text[a:b], "patterns": patterns})
                bases.append([{"kind": kind, "start": a, "end": b} for a, kind, b in base])
                places.append(own)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(seg.first, seg.rows), pa.array(hashes), pa.array(bases, pa.list_(_SPAN)), pa.array(places, pa.list_(_PLACE))],
                ["doc_id", "text_hash", "base", "places"])


class HashFilter:
    """A set of 64-bit hashes as three bits each; holds all of its values, and few others."""

    def __init__(self, bits: int, cells: np.ndarray):
        self.bits, self.cells = bits, cells

    @classmethod
    def of(cls, values: DataFrame) -> HashFilter:
        """Of one column of different longs. Spark sets the bits; the driver puts together at most 2^MOST_BITS of them."""
        name, n = values.columns[0], values.count()
        bits = min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * n).bit_length()))
        places = F.explode(F.array(*(F.expr(f"(({e}) & {(1 << bits) - 1}) + 1") for e in (f"shiftrightunsigned({name}, {64 - bits})", f"shiftrightunsigned({name}, 18)", name))))
        rows = (values.select(places.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket"))
                .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("cells")).collect())
        cells = np.zeros(max(1, (1 << bits) >> 15) * 4096, np.uint8)
        for r in rows:
            cells[(r["bucket"] - 1) * 4096:r["bucket"] * 4096] = np.frombuffer(r["cells"], np.uint8)
        return cls(bits, cells)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        mask, found = K.U((1 << self.bits) - 1), np.ones(len(hashes), bool)
        for shift in (64 - self.bits, 18, 0):
            at = ((hashes >> K.U(shift)) & mask).astype(np.int64)
            found &= (self.cells[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return found


def _stripped(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray | None, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words without the marks around them."""
    start, end = start.copy(), end.copy()
    while before is not None and (cut := (start < end) & before[data[np.minimum(start, len(data) - 1)]]).any():
        start += cut
    while (cut := (start < end) & after[data[end - 1]]).any():
        end -= cut
    return start, end


PLACES = "doc_id bigint, text_hash bigint, start bigint, end bigint, instance string, word bigint, free boolean, patterns array<bigint>"


def _contexts(seg: K.Segment, allowed: HashFilter) -> tuple:
    """Words; the first and last word of what can stand at a place: one word, or number-like words side by side; its patterns, and which are in the filter."""
    start, end, row = K.words(seg)
    n = len(start)
    h = K.span_hashes(K.LOWER[seg.data], start, end)
    bare = _stripped(seg.data, start, end, None, _END)[1]
    likes, digits = (np.concatenate([[0], np.cumsum(x[seg.data])]) for x in (_LIKE, _DIGIT))
    number = (likes[bare] - likes[start] == bare - start) & (digits[bare] > digits[start])
    goes_on = np.zeros(n, bool)
    goes_on[1:] = number[1:] & number[:-1] & (row[1:] == row[:-1]) & (bare[:-1] == end[:-1])
    first = np.flatnonzero(~goes_on)
    last = np.concatenate([first[1:], [n]])[:len(first)] - 1
    near = lambda at: (at >= 0) & (at < n) & (row[np.clip(at, 0, n - 1)] == row[first])
    word = lambda at: h[np.clip(at, 0, n - 1)]
    kinds = [(_pattern(2, word(first - 2), word(first - 1)), near(first - 2)),
             (_pattern(3, word(first - 3), word(first - 2), word(first - 1)), near(first - 3)),
             (_pattern(1, word(first - 1), word(last + 1)), near(first - 1) & near(last + 1))]
    return start, end, row, bare, first, last, kinds, [there & allowed.holds(own) for own, there in kinds]


def _context_counts(allowed: HashFilter):
    """How often the patterns in the filter stand anywhere, whatever is at their place."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seg in K.segments(batch.column(0)):
                *_, kinds, hits = _contexts(seg, allowed)
                own, n = np.unique(np.concatenate([k[hit] for (k, _), hit in zip(kinds, hits)]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n, pa.int64())], ["pattern", "n"])
    return task


def _places(allowed: HashFilter):
    """Whatever stands at a place of a pattern in the filter: a word of any characters, or number-like words side by side.

    `free` is false for what holds a base entity or an identifier that is a place already; `word` is the lower-cased hash of a single
    word of letters, digits, hyphens and apostrophes only, which other places may use as a common word.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for seg in K.segments(batch.column(1)):
                start, end, row, bare, first, last, kinds, hits = _contexts(seg, allowed)
                lower = K.LOWER[seg.data]
                at = np.flatnonzero(np.logical_or.reduce(hits))
                if not len(at):
                    continue
                a, b = start[first[at]], bare[last[at]]
                single = first[at] == last[at]
                a[single], b[single] = _stripped(seg.data, start[first[at]][single], end[last[at]][single], _OPEN, _CLOSE)
                own_word, points, raw = K.span_hashes(lower, a, b).view(np.int64), K.char_counts(seg.data), seg.data.tobytes()
                hashes = K.span_hashes(seg.data, seg.offsets[:-1], seg.offsets[1:]).view(np.int64)
                plain = np.concatenate([[0], np.cumsum(_PLAIN[seg.data])])
                single &= plain[b] - plain[a] == b - a
                known, rows = (-1, [], []), []
                for i, x, y, common, own in zip(at.tolist(), a.tolist(), b.tolist(), single.tolist(), own_word.tolist()):
                    r = int(row[first[i]])
                    if known[0] != r:
                        text = seg.text(r)
                        base = base_spans(text)
                        known = (r, [(p, q) for p, _, q in base], _identifiers(text, base))
                    p, q = int(points[x] - points[seg.offsets[r]]), int(points[y] - points[seg.offsets[r]])
                    free = x < y and not any(p < v and u < q for u, v in known[1] + known[2])
                    rows.append((ids[seg.first + r].as_py(), int(hashes[r]), p, q, raw[x:y].decode("utf-8", "replace"), own if common else None, free,
                                 [int(k.view(np.int64)[i]) for (k, _), hit in zip(kinds, hits) if hit[i]]))
                types = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                                 ["doc_id", "text_hash", "start", "end", "instance", "word", "free", "patterns"])
    return task


def _word_counts(allowed: HashFilter):
    """How often the words in the filter stand anywhere."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seg in K.segments(batch.column(0)):
                start, end, _ = K.words(seg)
                if len(start):
                    h = K.span_hashes(K.LOWER[seg.data], *_stripped(seg.data, start, end, _OPEN, _CLOSE))
                    own, n = np.unique(h[allowed.holds(h)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(n, pa.int64())], ["word", "n"])
    return task


def discovered(docs: DataFrame, extracted: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_share: float = MIN_SHARE, confidence: float = CONFIDENCE) -> DataFrame:
    """(doc_id, text_hash, start, end, kind): identifiers that confident patterns point at.

    A pattern is a candidate for a kind if at least `min_seeds` different seeds of it stand in it and make up `min_share` of
    its occurrences; so places of candidates grow with the seeds, not with the words that patterns are found by chance in. Whatever stands at
    its place is an instance. Its score is the mass of its instances over all its occurrences. Seeds have mass 1; another
    instance's mass is one minus the product of one minus the scores of its patterns, times the share of its
    occurrences in the corpus that stand in candidate patterns: what also stands elsewhere, as common words do, is no
    identifier. Words with a mark inside, longer ones with a digit, and runs of numbers have a share of 1. Scores and masses are computed in turn,
    `rounds` times, as joins and sums over the pattern-instance graph.
    """
    seeds = extracted.select("doc_id", "text_hash", F.explode("places").alias("p")).select("doc_id", "text_hash", "p.*")
    empty = seeds.where("false").select("doc_id", "text_hash", "start", "end", "kind")
    candidates = written(seeds.where("kind IS NOT NULL").select(F.explode("patterns").alias("pattern"), "instance", "kind")
                         .groupBy("pattern", "kind", "instance").agg(F.count("*").alias("n"))
                         .groupBy("pattern", "kind").agg(F.count("*").alias("seeds"), F.sum("n").alias("n"))
                         .where(F.col("seeds") >= min_seeds).select("pattern", "kind", "n"), "pii-patterns")
    if candidates.isEmpty():
        return empty
    everywhere = (docs.select("text").mapInArrow(_context_counts(HashFilter.of(candidates.select("pattern").distinct())), "pattern bigint, n bigint")
                  .groupBy("pattern").agg(F.sum("n").alias("occurrences")))
    patterns = written(candidates.join(everywhere, "pattern", "left").withColumn("occurrences", F.coalesce("occurrences", F.lit(0)))
                       .where(F.col("n") >= min_share * F.col("occurrences")).select("pattern", "kind", "occurrences"), "pii-counts")
    if patterns.isEmpty():
        return empty
    names = patterns.select("pattern").distinct()
    there = (docs.select("doc_id", "text").mapInArrow(_places(HashFilter.of(names)), PLACES).where("free")
             .withColumn("pattern", F.explode("patterns")).join(names, "pattern").withColumn("kind", F.lit(None).cast("string")))

    columns = ["doc_id", "text_hash", "start", "end", "instance", "word", "kind", "pattern"]
    spots = (seeds.withColumn("pattern", F.explode("patterns")).join(names, "pattern").withColumn("word", F.lit(None).cast("bigint")).select(columns)
             .union(there.select(columns)))
    spots = written(spots, "pii-spots")
    words = written(spots.where("word IS NOT NULL").groupBy("word").agg(F.count_distinct("doc_id", "text_hash", "start").alias("here")), "pii-words")
    counted = docs.select("text").mapInArrow(_word_counts(HashFilter.of(words.select("word"))), "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    shares = words.join(counted, "word").select("word", F.least(F.lit(1.0), F.col("here") / F.col("n")).alias("share"))
    grouped = written(spots.withColumnRenamed("kind", "seed_kind").join(patterns, "pattern").groupBy("pattern", "kind", "instance", "word")
                      .agg(F.count("*").alias("n"), F.max(F.expr("CASE WHEN seed_kind = kind THEN 1.0D ELSE 0.0D END")).alias("seed"),
                           F.first("occurrences").alias("occurrences")), "pii-groups")
    graph = written(grouped.where("word IS NOT NULL").join(shares, "word").select(*grouped.columns, "share")
                    .union(grouped.where("word IS NULL").withColumn("share", F.lit(1.0))), "pii-graph")
    mass = graph.groupBy("instance", "kind").agg(F.max("seed").alias("mass"))
    scores = None
    for _ in range(rounds):
        scores = written(graph.join(mass, ["instance", "kind"]).groupBy("pattern", "kind")
                         .agg((F.sum(F.col("n") * F.col("mass")) / F.greatest(F.sum("n"), F.max("occurrences"))).alias("score")), "pii-scores")
        mass = (graph.join(scores, ["pattern", "kind"]).groupBy("instance", "kind")
                .agg(F.greatest(F.max("seed"), F.min("share") * (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-12), 1 - F.col("score"))))))).alias("mass")))
        mass = written(mass, "pii-masses")
    good = scores.where(F.col("score") >= confidence).select("pattern", F.col("kind").alias("found_kind"))
    sure = mass.where(F.col("mass") >= confidence).select("instance", F.col("kind").alias("found_kind"))
    return (spots.where("kind IS NULL").select("doc_id", "text_hash", "start", "end", "instance", "pattern")
            .join(good, "pattern").join(sure, ["instance", "found_kind"])
            .groupBy("doc_id", "text_hash", "start", "end").agg(F.min("found_kind").alias("kind")))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, base, found) for each row of docs: spans (kind, start, end) of base entities and of discovered ones.

    Base entities are the leftmost non-overlapping matches of each kind that pass its check. Discovered ones are
    words of any characters, or number-like words side by side, that stand in patterns learnt from the base entities; their
    kinds are found_email and so on.
    Code points, end exclusive. Null and empty texts have none. A null doc_id stays null; repeated rows get the same
    spans; other columns are not read; an empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    extracted = written(docs.mapInArrow(_extract, SCHEMA), "pii")
    found = (discovered(docs, extracted).groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
             .agg(F.collect_list(F.struct(F.concat(F.lit("found_"), "kind").alias("kind"), "start", "end")).alias("found")))
    return (extracted.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
            .select("doc_id", "base", F.coalesce("found", F.expr("cast(array() AS array<struct<kind:string,start:bigint,end:bigint>>)")).alias("found")))


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) from the spans of find_personal_data."""
    order = F.array(*(F.lit(k) for k in [*KINDS, *(f"found_{k}" for k in KINDS)]))

    def joined(spans):
        rows = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(order, s["kind"]).alias("k"), s["end"].alias("end"))))
        return F.concat_ws(",", F.transform(rows, lambda s: F.concat_ws(":", F.element_at(order, s["k"].cast("int")), s["start"].cast("string"), s["end"].cast("string"))))

    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "found")).alias("spans"))
