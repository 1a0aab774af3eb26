from opinio.functions.columns import (
    LETTER_RUN,
    hash_bucket,
    label_int,
    lenient_double,
    letter_tokens,
    match_flag,
    polarity,
    two_standard_errors,
    whitespace_tokens,
)

__all__ = [
    "LETTER_RUN", "hash_bucket", "label_int", "lenient_double",
    "letter_tokens", "match_flag", "polarity", "two_standard_errors",
    "whitespace_tokens",
]
