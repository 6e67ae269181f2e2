"""Token expressions shared by the text model and the explanations.

Tokens are runs of two or more letters, digits or underscores of the
lower-cased text (the same pattern works in Java regex and RE2). Stop words
are Spark ML's built-in English list.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


@functools.lru_cache(maxsize=None)
def english_stop_words() -> tuple[str, ...]:
    from pyspark.ml.feature import StopWordsRemover
    from pyspark.sql import SparkSession
    SparkSession.builder.getOrCreate()  # the list comes from Spark's JVM
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


def tokens(text: Column) -> Column:
    """ARRAY<STRING> of tokens in order (NULL text gives an empty array)."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), 0)


def is_stop_word(term: Column) -> Column:
    """Membership in the stop list (a literal list compiles to a hash-set test)."""
    return term.isin(list(english_stop_words()))
