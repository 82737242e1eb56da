"""Text expressions. All run in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from reviewloom.functions.words import CORPUS_STOP_WORDS, STOP_WORDS


def tokenize(col: str | Column) -> Column:
    """Lower-case words, split at non-word characters. `\\W` is ASCII, so accented letters split words."""
    return F.filter(F.split(F.lower(col), r"\W+"), lambda w: w != "")


def drop_stopwords(col: str | Column, words: Sequence[str] = STOP_WORDS) -> Column:
    """Token array without stop words; duplicates of other tokens stay."""
    listed = [w.lower() for w in words]
    return F.filter(col, lambda w: ~F.lower(w).isin(listed))


def simple_tokens(col: str | Column, words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower-case alphabetic tokens of 2 to 15 characters that are not stop words."""
    found = F.regexp_extract_all(F.lower(col), F.lit(r"([\p{L}_]+)"), F.lit(1))
    listed = list(words)
    return F.filter(found, lambda w: F.length(w).between(2, 15) & ~w.startswith("_") & ~w.isin(listed))


def _branches(words: Sequence[str]) -> str:
    """Pattern of the words with common beginnings written once; longer words are tried first."""
    heads: dict[str, list[str]] = {}
    for word in sorted(set(words)):
        heads.setdefault(word[:1], []).append(word[1:])
    ends = "" in heads
    parts = [re.escape(head) + _branches(rest) for head, rest in heads.items() if head]
    if not parts:
        return ""
    body = parts[0] if len(parts) == 1 and not ends else "(?:" + "|".join(parts) + ")"
    return body + "?" if ends else body


def stop_word_pattern(words: Sequence[str] = CORPUS_STOP_WORDS) -> str:
    """Pattern of the stop words as whole words (Unicode word boundaries), the longest one at each place."""
    return r"(?U)\b" + _branches(words) + r"\b"


def corpus_text(col: str | Column, words: Sequence[str] = CORPUS_STOP_WORDS) -> Column:
    """Lower case, digits out, stop words out, punctuation out, blanks squeezed, in this order.

    Stop words go before punctuation, so that "don't" is still one word when it is looked up.
    """
    text = F.regexp_replace(F.lower(col), "[0-9]+", "")
    text = F.regexp_replace(text, stop_word_pattern(words), "")
    text = F.regexp_replace(text, r"\p{Punct}+", "")
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def blank_words(col: str | Column) -> Column:
    """Words between single blanks."""
    return F.filter(F.split(col, " "), lambda w: w != "")


def ngrams(tokens: str | Column, n: int = 2) -> Column:
    """n consecutive tokens joined by a blank."""
    def grams(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - n)
        pieces = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(n)]))
        return F.when(F.size(words) >= n, pieces).otherwise(F.array().cast("array<string>"))

    # the one-element array computes the tokens once
    return F.get(F.transform(F.array(tokens), grams), F.lit(0))


def explode_words(df: DataFrame, tokens: str | Column, name: str, *cols: str) -> DataFrame:
    """One row per token. The outer form keeps Spark from computing the tokens twice to filter empty arrays."""
    return df.select(*cols, F.explode_outer(tokens).alias(name)).filter(F.col(name).isNotNull())
