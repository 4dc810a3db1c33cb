"""String columns: normal forms, phonetic keys, term tests, sequence ratio."""

from __future__ import annotations

from collections.abc import Iterable
from difflib import SequenceMatcher
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from stackroom.functions.numbers import let

# Unicode white space plus the four ASCII separators.
SPACE = r"[\s\x1c-\x1f]"
# Stands for the dotless i while case is changed; a code point that no text holds.
DOTLESS = "\ufdd0"


def stripped(text: Column) -> Column:
    """Strip Unicode white space at both ends (``trim`` only strips spaces)."""
    return F.regexp_replace(text, rf"(?U)^{SPACE}+|{SPACE}+$", "")


def caseless(text: Column) -> Column:
    """Lower of upper, by way of the capital sharp s, without which it would be simplified to lower."""
    return F.lower(F.replace(F.upper(text), F.lit("ẞ"), F.lit("SS")))


def folded(text: Column) -> Column:
    """Case-folded, white space collapsed, stripped.

    Lower of upper is the full case folding but for the dotless i, which stays, and the final sigma.
    """
    folds = caseless(F.replace(text, F.lit("ı"), F.lit(DOTLESS)))
    for folded_to, letter in (("ς", "σ"), (DOTLESS, "ı")):
        folds = F.replace(folds, F.lit(folded_to), F.lit(letter))
    return F.trim(F.regexp_replace(folds, rf"(?U){SPACE}+", " "))


def word_text(text: Column) -> Column:
    """Lower-case words separated by single spaces; everything else removed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "))


def title_key(title: Column) -> Column:
    return stripped(F.lower(title))


def any_term(text: Column, terms: Iterable[str]) -> Column:
    """True when one of the fixed terms occurs as a substring."""
    wanted = [F.lit(term) for term in terms]
    return let(text, lambda t: reduce(lambda a, b: a | b, [F.contains(t, term) for term in wanted]))


def token_text_match(haystack: Column, query: str) -> Column:
    """Every white-space token of the query occurs; an empty query or ``*`` matches all."""
    tokens = [] if query.strip() in ("", "*") else [F.lit(t) for t in query.lower().split()]
    if not tokens:
        return F.lit(True)
    return let(haystack, lambda h: reduce(lambda a, b: a & b, [F.contains(h, t) for t in tokens]))


# Sound group of each letter A-Z; 0 separates equal neighbours.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SOUND_GROUPS = "01230120022455012623010202"


def _keys_of_words(letters: Column) -> Column:
    """Phonetic key per blank-separated upper-case word, from one pass over the string."""
    groups = F.regexp_replace(F.translate(letters, LETTERS, SOUND_GROUPS), r"([0-6])\1+", "$1")
    return F.zip_with(
        F.split(letters, " "),
        F.split(groups, " "),
        lambda word, group: F.when(
            word != "",
            F.rpad(F.concat(F.substring(word, 1, 1), F.translate(F.substr(group, F.lit(2)), "0", "")), 4, "0"),
        ).otherwise(F.lit("")),
    )


def phonetic_key(word: Column) -> Column:
    """Four-character sound key; vowels, H and W separate equal groups; ``""`` without letters."""
    return F.element_at(_keys_of_words(F.regexp_replace(F.upper(word), "[^A-Z]", "")), 1)


def phonetic_terms(text: Column) -> Column:
    """Sorted distinct phonetic keys of the ASCII words of a text."""
    letters = F.trim(F.upper(F.regexp_replace(text, "[^A-Za-z]+", " ")))
    return F.array_sort(F.array_distinct(F.filter(_keys_of_words(letters), lambda k: k != "")))


@F.pandas_udf(DoubleType())
def sequence_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Matching-block ratio of two strings; null when either is null."""

    def ratio(a: str | None, b: str | None) -> float | None:
        return None if a is None or b is None else SequenceMatcher(None, a, b).ratio()

    return pd.Series([ratio(a, b) for a, b in zip(left, right)], dtype="float64")


# Keeps the optimizer from copying the call into pushed-down filters.
sequence_ratio = sequence_ratio.asNondeterministic()


def ratio_bound(left: Column, right: Column) -> Column:
    """Upper bound of :func:`sequence_ratio`: the shorter text can match in full at most."""
    a, b = F.length(left), F.length(right)
    return F.when(a + b > 0, 2.0 * F.least(a, b) / (a + b)).otherwise(F.lit(1.0))


def joined_or_empty(values: Column) -> Column:
    return F.coalesce(F.array_join(values, ", "), F.lit(""))
