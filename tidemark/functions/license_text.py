"""License expressions as text: clean-up, terms and how the terms are joined.

A license expression is a run of words.  Parentheses carry no meaning here,
``AND``/``OR``/``WITH`` (any letter case) join words, and every other word of
letters, digits, ``.``, ``-`` and ``+`` names a license.  ``WITH`` and all up to
and including the next name is an exception clause and is cut out.  A character
outside that alphabet makes the whole expression unreadable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.strings import SPACE, strip_whitespace

_FOREIGN = r"(?U)[^\s\x1c-\x1f()A-Za-z0-9.+-]"
_WORD = r"(?i)\b(?:and|or|with)\b|[a-z0-9.+-]+"
# On words with one blank before and after each.
_EXCEPTION = r"(?i) with(?: (?:and|or|with)(?= ))*(?: [^ ]+)?(?= )"
_JOINER = r"(?i) (?:and|or)(?= )"
_LATER = r"\++(?= )"


def collapse_whitespace(text: Column) -> Column:
    return F.regexp_replace(strip_whitespace(text), rf"(?U){SPACE}+", " ")


def plain_words(expression: Column) -> Column:
    """The words outside exception clauses, a blank before and after each.

    A single blank when there are none or the expression is unreadable.
    """
    words = F.array_join(F.regexp_extract_all(expression, F.lit(_WORD), F.lit(0)), " ")
    spaced = F.concat(F.lit(" "), words, F.lit(" "))
    return F.when(expression.rlike(_FOREIGN) | (words == ""), F.lit(" ")).when(
        expression.isNotNull(), F.regexp_replace(spaced, _EXCEPTION, "")
    )


def words_terms(words: Column) -> Column:
    """License names among plain words in written order, trailing ``+`` removed."""
    names = F.regexp_replace(F.regexp_replace(words, _JOINER, ""), _LATER, "")
    inner = F.substring(names, F.lit(2), F.length(names) - 2)
    return F.when(F.length(names) > 1, F.split(inner, " ")).when(
        names.isNotNull(), F.array().cast("array<string>")
    )


def words_combinator(words: Column) -> Column:
    """``AND``, ``OR``, ``MIXED`` when both occur, null when neither does."""
    lower = F.lower(words)
    has_and, has_or = F.contains(lower, F.lit(" and ")), F.contains(lower, F.lit(" or "))
    return (
        F.when(has_and & has_or, F.lit("MIXED"))
        .when(has_and, F.lit("AND"))
        .when(has_or, F.lit("OR"))
    )


def term_words(expression: Column) -> Column:
    """License names of an expression; empty when it is unreadable or names none."""
    return words_terms(plain_words(expression))


def terms_combinator(expression: Column) -> Column:
    """How the names of an expression are joined."""
    return words_combinator(plain_words(expression))
