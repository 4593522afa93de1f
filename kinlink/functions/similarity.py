"""Pair similarity as column expressions; only Jaro-Winkler leaves the JVM, in Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from kinlink.functions.people import phonetic_code

# Slack for bounds computed in another summation order than the exact score.
SLACK = 1e-9


def rounded(score: Column, digits: int) -> Column:
    """`F.round`, to the last bit, without its way over decimal text for scores from 0 to 1.

    The nearest integer of score * 10^digits is sure unless that lies within a millionth of a half, which is more than
    the product can be off for up to nine digits; a whole number over 10^digits is the double nearest to the decimal.
    """
    if not 0 <= digits <= 9:
        return F.round(score, digits)
    scale = F.lit(10.0 ** digits)
    sure = (F.abs(score * scale - F.rint(score * scale)) < 0.499999) & (score >= 0.0) & (score <= 1.0)
    return F.when(sure, F.rint(score * scale) / scale).otherwise(F.round(score, digits))


def _both(a: Column, b: Column) -> Column:
    return (F.length(a) > 0) & (F.length(b) > 0)


def levenshtein_similarity(a: Column, b: Column) -> Column:
    """1 - edits / longer length, on lower-cased text; 0.0 for NULL or empty."""
    longest = F.greatest(F.length(a), F.length(b))
    edits = F.levenshtein(F.lower(a), F.lower(b))
    return F.when(_both(a, b), F.lit(1.0) - edits / longest).otherwise(0.0)


def levenshtein_at_least(a: Column, b: Column, similarity: Column) -> Column:
    """Is the similarity of two non-empty texts at least this?

    The most edits allowed follow from the lengths; a larger length gap decides at once.
    """
    longest = F.greatest(F.length(a), F.length(b))
    allowed = F.floor((1.0 - similarity) * longest + SLACK).cast("int")
    gap = F.abs(F.length(F.lower(a)) - F.length(F.lower(b)))
    return (gap <= allowed) & (F.levenshtein(F.lower(a), F.lower(b)) <= allowed)


def edits_similarity(edits: Column, length_a: Column, length_b: Column) -> Column:
    """`levenshtein_similarity` from the edits between the lower-cased texts and the lengths of the texts."""
    some = (length_a > 0) & (length_b > 0)
    return F.when(some, F.lit(1.0) - edits / F.greatest(length_a, length_b)).otherwise(0.0)


def letter_bags(text: Column) -> tuple[Column, Column]:
    """How often each of 32 classes of characters occurs in a text, up to four times, as that many bits each of two longs."""
    of = F.transform(F.split(text, ""), lambda c: F.pmod(F.ascii(c), F.lit(32)))
    shifted = lambda n, by: F.call_function("shiftleft", n, by)

    def bag(first: int) -> Column:
        def add(bits: Column, letter: Column) -> Column:
            place = (letter - first) * 4
            mask = shifted(F.lit(15).cast("long"), place)
            return bits.bitwiseOR(shifted(bits.bitwiseAND(mask), F.lit(1)).bitwiseAND(mask)).bitwiseOR(shifted(F.lit(1).cast("long"), place))

        return F.aggregate(F.filter(of, lambda c: (c >= first) & (c < first + 16)), F.lit(0).cast("long"), add)

    return bag(0), bag(16)


def letters_apart(a: tuple[Column, Column], b: tuple[Column, Column]) -> Column:
    """At least how many characters of either of two texts find no partner in the other, by their bags: never too many."""
    apart = [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a, b)]
    return apart[0] + apart[1]


def _jaro_winkler_udf():
    # Nested, so that the function travels to the workers by value.
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    cell_budget = 200_000   # characters compared at once; small enough for the processor's cache

    def code_points(column):
        column = pc.fill_null(column, "")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        lengths = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
        whole = pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)
        text = pc.binary_join(whole, "")[0].as_py()
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        return points, lengths

    def padded(points, starts, lengths, rows, width, fill):
        out = np.full((len(rows), width), fill, dtype=points.dtype)
        cols = np.arange(width)
        inside = cols < lengths[rows][:, None]
        out[inside] = points[(starts[rows][:, None] + cols)[inside]]
        return out

    def places_by_row(a, b, window):
        """Which characters of either side are common; one pass over all pairs per character of the left side."""
        n, wa = a.shape
        wb = b.shape[1]
        reach = int(window.max())
        used_a = np.zeros(a.shape, dtype=bool)
        used_b = np.zeros(b.shape, dtype=bool)
        every = np.arange(n)
        for i in range(wa):
            lo, hi = max(0, i - reach), min(wb, i + reach + 1)
            if lo >= hi:
                break
            free = (b[:, lo:hi] == a[:, i:i + 1]) & ~used_b[:, lo:hi]
            free &= np.abs(np.arange(lo, hi, dtype=np.int32) - i) <= window[:, None]
            at = free.argmax(axis=1)
            hit = free[every, at]
            used_a[hit, i] = True
            used_b[every[hit], at[hit] + lo] = True
        return used_a, used_b

    def places_by_column(a, b, window):
        """The same with all pairs side by side, which takes whole runs of bytes: for many pairs of short texts."""
        a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
        wa, wb = len(a), len(b)
        near, far = int(window.min()), int(window.max())
        inside = {d: window >= d for d in range(near + 1, far + 1)}
        used_a = np.zeros(a.shape, dtype=bool)
        free = np.ones(b.shape, dtype=bool)
        for i in range(wa):
            lo, hi = max(0, i - far), min(wb, i + far + 1)
            if lo >= hi:
                break
            found, same = used_a[i], b[lo:hi] == a[i]
            same &= free[lo:hi]
            for j, hit in enumerate(same, lo):
                np.greater(hit, found, out=hit)
                if abs(i - j) > near:
                    hit &= inside[abs(i - j)]
                found |= hit
                free[j] ^= hit
        return np.ascontiguousarray(used_a.T), ~free.T

    def jaro_winkler(a, b, la, lb):
        # Pads differ between the sides, so they never count as common characters.
        n, wa = a.shape
        wb = b.shape[1]
        window = np.maximum(np.maximum(la, lb) // 2 - 1, 0).astype(np.int32)
        places = places_by_column if n > 8 * max(wa, wb) else places_by_row
        used_a, used_b = places(a, b, window)
        common = used_a.sum(axis=1)
        row_of = np.nonzero(used_a)[0]
        moved = np.bincount(row_of, weights=a[used_a] != b[used_b], minlength=n)
        some = np.maximum(common, 1)
        weight = (common / la + common / lb + (common - moved // 2) / some) / 3
        weight[common == 0] = 0.0
        head = min(4, wa, wb)
        prefix = np.cumprod(a[:, :head] == b[:, :head], axis=1).sum(axis=1)
        return np.where(weight > 0.7, weight + prefix * 0.1 * (1.0 - weight), weight)

    def score(left, right):
        pa_, la = code_points(left)
        pb_, lb = code_points(right)
        sa, sb = np.cumsum(la) - la, np.cumsum(lb) - lb
        pad_a, pad_b = 0xFFFFFFFF, 0xFFFFFFFE
        if max(pa_.max(initial=0), pb_.max(initial=0)) < 0xFE:   # one byte per character will do
            pa_, pb_, pad_a, pad_b = pa_.astype(np.uint8), pb_.astype(np.uint8), 0xFF, 0xFE
        out = np.zeros(len(la))
        todo = np.nonzero((la > 0) & (lb > 0))[0]
        longest = np.maximum(la, lb)
        todo = todo[np.argsort(longest[todo], kind="stable")]
        while len(todo):
            # As many rows as fit the budget at the width of the longest of them.
            cost = longest[todo] * np.arange(1, len(todo) + 1)
            take = max(1, int(np.searchsorted(cost, cell_budget, side="right")))
            rows, todo = todo[:take], todo[take:]
            out[rows] = jaro_winkler(
                padded(pa_, sa, la, rows, int(la[rows].max()), pad_a),
                padded(pb_, sb, lb, rows, int(lb[rows].max()), pad_b),
                la[rows], lb[rows],
            )
        return pa.array(out, pa.float64())

    # Marked nondeterministic so that a filter on the score does not plan it a second time.
    return F.arrow_udf(score, T.DoubleType()).asNondeterministic()


jaro_winkler = _jaro_winkler_udf()


def jaro_winkler_similarity(a: Column, b: Column) -> Column:
    """Jaro-Winkler of lower-cased text; 0.0 for NULL or empty."""
    return jaro_winkler(F.lower(a), F.lower(b))


def soundex_match(a: Column, b: Column) -> Column:
    """1.0 when the phonetic codes agree, else 0.0; 0.0 for NULL or empty."""
    return codes_match(phonetic_code(a), phonetic_code(b))


def codes_match(a: Column, b: Column) -> Column:
    return F.when(_both(a, b) & (a == b), 1.0).otherwise(0.0)


def date_similarity(a: Column, b: Column) -> Column:
    """Equal 1.0, same year and month 0.8, same year 0.5, else 0.0; 0.0 for NULL or empty."""
    return (
        F.when(_both(a, b) & (a == b), 1.0)
        .when(_both(a, b) & (F.substring(a, 1, 7) == F.substring(b, 1, 7)), 0.8)
        .when(_both(a, b) & (F.substring(a, 1, 4) == F.substring(b, 1, 4)), 0.5)
        .otherwise(0.0)
    )


def document_match(a: Column, b: Column, null_as_zero: bool = False) -> Column:
    """1.0 or 0.0; NULL when a document is NULL, unless asked for 0.0."""
    same = (a == b).cast("double")
    return F.coalesce(same, F.lit(0.0)) if null_as_zero else same


def combined_similarity(a: Column, b: Column) -> Column:
    """Name search score: equal 1.0, else 0.4 edit distance + 0.6 Jaro-Winkler; 0.0 for NULL or empty."""
    blend = levenshtein_similarity(a, b) * 0.4 + jaro_winkler_similarity(a, b) * 0.6
    return F.when(_both(a, b) & (F.lower(a) == F.lower(b)), 1.0).otherwise(
        F.when(_both(a, b), blend).otherwise(0.0)
    )


def combined_possible(a: Column, b: Column, threshold: float) -> Column:
    """Can the above reach the threshold? Jaro-Winkler, at most 1, is left out."""
    needed = F.lit((threshold - 0.6) / 0.4)
    if threshold <= 0:
        return F.lit(True)
    return _both(a, b) & levenshtein_at_least(a, b, needed)
