"""Tokens, and why a token is dropped."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.functions.text import drop_spaced_letters

# possessive, as in ``text``: chains of any length match without recursion
DOT_TOKEN = r"\p{L}++(?:-\p{L}++)*+\.?"
JOINED_TOKEN = r"\p{L}++(?:[-–_\n]\p{L}++)*+"

#: In the order in which they are tried.
DROP_RULES = (
    ("single_letter", r"^.$"),
    ("abbreviation", r"\."),
    ("upper_cyrillic", r"^[А-ЯЁ]{2,5}$"),
    ("latin", r"^[A-Za-z]+$"),
    ("roman", r"(?iu)^[ivxlcdm]+$"),
)
#: All rules in one expression, so a token is looked at once.
DROPPED = r"^(?:.|.*\..*|[А-ЯЁ]{2,5}|[A-Za-z]+|(?iu:[ivxlcdm]+))$"


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\p{L}+"))


def dot_tokens(text: Column) -> Column:
    """Words, with inner hyphens and a full stop that follows."""
    return F.regexp_extract_all(text, F.lit(DOT_TOKEN), F.lit(0))


def joined_tokens(text: Column) -> Column:
    """Words, with inner hyphens, dashes, underscores and line feeds."""
    return F.regexp_extract_all(text, F.lit(JOINED_TOKEN), F.lit(0))


def drop_by(tokens: Column, rule: str) -> Column:
    """Tokens that one rule lets stand."""
    pattern = dict(DROP_RULES)[rule]
    return F.filter(tokens, lambda w: ~F.rlike(w, F.lit(pattern)))


def drop_reason(token: Column) -> Column:
    """The first rule that drops a token, else null."""
    out = None
    for name, pattern in DROP_RULES:
        hit = F.rlike(token, F.lit(pattern))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def valid_tokens(text: Column) -> Column:
    return F.filter(dot_tokens(drop_spaced_letters(text)), lambda w: ~F.rlike(w, F.lit(DROPPED)))


def filter_invalid_words(text: Column) -> Column:
    return F.array_join(valid_tokens(text), " ")
