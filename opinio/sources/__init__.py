from opinio.sources.readers import (
    corpus_count,
    land,
    land_csv,
    load_stop_words,
    read_lexicon,
    read_review_csv,
    read_word_list,
    write_csv,
)

__all__ = [
    "corpus_count", "land", "land_csv", "load_stop_words", "read_lexicon",
    "read_review_csv", "read_word_list", "write_csv",
]
