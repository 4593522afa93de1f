"""Name analysis: accent folding, tokens, fuzzy and phrase tests."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Accented Latin letters and the plain letter each folds to.
_FOLD = {
    "a": "àáâãäåāăą", "c": "çćĉċč", "d": "ďđ", "e": "èéêëēĕėęě", "g": "ĝğġģ", "h": "ĥħ",
    "i": "ìíîïĩīĭį", "j": "ĵ", "k": "ķ", "l": "ĺļľł", "n": "ñńņň", "o": "òóôõöøōŏő",
    "r": "ŕŗř", "s": "śŝşš", "t": "ţťŧ", "u": "ùúûüũūŭůűų", "w": "ŵ", "y": "ýÿŷ", "z": "źżž",
}
_FROM = "".join(_FOLD.values()) + "".join(v.upper() for v in _FOLD.values())
_TO = "".join(k * len(v) for k, v in _FOLD.items())
_TO += _TO.upper()

# A word: letters, digits and underscores, with inner apostrophes or dots kept ("d'avila").
_WORD = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"
_PY_WORD = re.compile(r"\w+(?:['’.]\w+)*")


def fold_accents(c: Column) -> Column:
    return F.translate(c, _FROM, _TO)


def name_tokens(c: Column, fold: bool = True) -> Column:
    """Lower-case word tokens of a name; an empty array for NULL."""
    text = F.lower(fold_accents(c) if fold else c)
    return F.coalesce(
        F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>")
    )


def query_tokens(text: str, fold: bool = True) -> list[str]:
    """The same analysis for one query string."""
    if fold:
        text = text.translate(str.maketrans(_FROM, _TO))
    return _PY_WORD.findall(text.lower())


def auto_edits(token: str) -> int:
    """Edits allowed for a query token of this length: up to 2 letters 0, up to 5 letters 1, else 2."""
    return 0 if len(token) <= 2 else 1 if len(token) <= 5 else 2


def _swapped(word: str, start: int = 0) -> list[tuple[int, str]]:
    return [
        (i, word[:i] + word[i + 1] + word[i] + word[i + 2:])
        for i in range(start, len(word) - 1)
        if word[i] != word[i + 1]
    ]


def _token_near(token: Column, word: str) -> Column:
    """Is `token` within the edit budget of `word`, an adjacent swap counting as one edit?

    Spark's levenshtein has no swaps, so they are applied to the constant query word and
    each swap used up lowers the budget for the rest.
    """
    budget = auto_edits(word)
    if budget == 0:
        return token == F.lit(word)
    near = F.levenshtein(token, F.lit(word), budget) >= 0
    once = _swapped(word)
    if budget == 1:
        return near | token.isin([w for _, w in once]) if once else near
    for _, variant in once:
        near = near | (F.levenshtein(token, F.lit(variant), budget - 1) >= 0)
    twice = sorted({w2 for i, w in once for _, w2 in _swapped(w, i + 2)})
    return near | token.isin(twice) if twice else near


def fuzzy_any(tokens: Column, query: str, fold: bool = True) -> Column:
    """Does any query token match any name token within its edit budget?"""
    words = sorted(set(query_tokens(query, fold)))
    if not words:
        return F.lit(False)

    def near_any(token: Column) -> Column:
        test = _token_near(token, words[0])
        for word in words[1:]:
            test = test | _token_near(token, word)
        return test

    return F.exists(tokens, near_any)


def has_phrase(tokens: Column, query: str, fold: bool = True) -> Column:
    """Do the query tokens appear next to each other, in order?"""
    words = query_tokens(query, fold)
    if not words:
        return F.lit(False)
    padded = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    return padded.contains(" " + " ".join(words) + " ")
