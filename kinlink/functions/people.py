"""Person attributes: phonetic code, dates, ages, document numbers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from kinlink.functions.text import fold_accents

_DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}$"


def phonetic_code(name: Column) -> Column:
    """Soundex of the accent-folded name; depends on the lower-cased name only.

    Spark's soundex returns its input when the first character is no letter; such names
    keep that character and take the digits from the rest.
    """
    plain = F.lower(name)
    for accented, base in (("ç", "c"), ("ñ", "n")):  # the mark separates equal consonants
        plain = F.replace(plain, F.lit(accented), F.lit(base + "~"))
    plain = fold_accents(plain)
    first = F.substring(plain, 1, 1)
    rest = F.concat(F.lit("a"), F.substr(plain, F.lit(2)))
    return F.when(first.between("a", "z"), F.soundex(plain)).when(
        F.length(plain) > 0, F.concat(first, F.substring(F.soundex(rest), 2, 3))
    ).otherwise(plain)


def parse_date(text: Column) -> Column:
    """`YYYY-MM-DD` to date; anything else, and days that do not exist, to NULL."""
    return F.when(text.rlike(_DATE_SHAPE), text.try_cast("date"))


def age_on(birth: Column, as_of: Column) -> Column:
    """Completed years at `as_of`; 0 when the birth date is missing or no date."""
    had_birthday = F.date_format(as_of, "MMdd") >= F.date_format(birth, "MMdd")
    years = F.year(as_of) - F.year(birth) - F.when(had_birthday, 0).otherwise(1)
    return F.coalesce(years, F.lit(0)).cast("int")


def match_id(doc_1: Column, doc_2: Column) -> Column:
    """`doc1_doc2`; NULL when a document is missing, as such a pair has no key.

    An underscore or backslash inside a document gets a backslash before it, so that an id stands for
    one pair of documents.
    """
    plain = lambda doc: F.regexp_replace(doc, r"([_\\])", r"\\$1")
    return F.concat(plain(doc_1), F.lit("_"), plain(doc_2))


def cpf_check_digits(base: Column) -> Column:
    """The two modulo-11 check digits for nine leading digits, as a two-character string."""
    digits = [F.substring(base, i + 1, 1).try_cast("int") for i in range(9)]

    def check(digits: list[Column]) -> Column:
        # 11 - sum % 11, with 10 and 11 as 0.
        weighted = [d * (len(digits) + 1 - i) for i, d in enumerate(digits)]
        return reduce(lambda x, y: x + y, weighted) * 10 % 11 % 10

    first = check(digits)
    second = check(digits + [first])
    return F.concat(first.cast("string"), second.cast("string"))


def cpf_is_valid(doc: Column) -> Column:
    """Eleven digits whose last two are the check digits; False for NULL."""
    return F.coalesce(
        doc.rlike(r"^\d{11}$") & (F.substring(doc, 10, 2) == cpf_check_digits(doc)), F.lit(False)
    )
