"""Search-index helpers over names: keyword form and padded n-grams."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Separators of a keyword (white space in the sense of Unicode, with
# the four information separators), their replacement, the padding of n-grams.
SEPARATORS = r"(?U)[\s\x1c-\x1f\"'.,()\-_\\\/]"
REPLACEMENT = "_"
PADDING = "__"


def keyword(text: Column | str) -> Column:
    """Lower-case text with each separator replaced."""
    return F.lower(F.regexp_replace(text, SEPARATORS, REPLACEMENT))


def ngrams(text: Column | str, n: int = 3) -> Column:
    """All n-grams of the padded text, blank-separated.

    A gram starts at every character except those of the closing padding.
    """

    def grams(chars: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(chars) - len(PADDING) - 1)
        gram = F.transform(starts, lambda i: F.concat_ws("", *[F.get(chars, i + k) for k in range(n)]))
        return F.array_join(gram, " ")

    # Inside the outer array the characters are a variable, split once per text.
    chars = F.split(F.concat(F.lit(PADDING), text, F.lit(PADDING)), "")
    return F.get(F.transform(F.array(chars), grams), F.lit(0))
