from kinlink.functions.people import (
    age_on, cpf_check_digits, cpf_is_valid, match_id, parse_date, phonetic_code,
)
from kinlink.functions.registry import register_sql_functions
from kinlink.functions.similarity import (
    combined_similarity, date_similarity, document_match, jaro_winkler_similarity,
    levenshtein_similarity, soundex_match,
)
from kinlink.functions.text import fold_accents, fuzzy_any, has_phrase, name_tokens, query_tokens

__all__ = [
    "age_on", "combined_similarity", "cpf_check_digits", "cpf_is_valid", "date_similarity",
    "document_match", "fold_accents", "fuzzy_any", "has_phrase", "jaro_winkler_similarity",
    "levenshtein_similarity", "match_id", "name_tokens", "parse_date", "phonetic_code",
    "query_tokens", "register_sql_functions", "soundex_match",
]
