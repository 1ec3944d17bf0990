from tillwise.functions.expressions import (
    count_if,
    day_offset,
    make_pairs,
    ratio,
    sum_if,
    virtual_seconds,
)
from tillwise.functions.text import (
    CAPITALISED_RUN,
    NEGATIVE_WORDS,
    POSITIVE_WORDS,
    default_lexicon,
    sentences,
    words,
)

__all__ = [
    "CAPITALISED_RUN",
    "NEGATIVE_WORDS",
    "POSITIVE_WORDS",
    "count_if",
    "day_offset",
    "default_lexicon",
    "make_pairs",
    "ratio",
    "sentences",
    "sum_if",
    "virtual_seconds",
    "words",
]
