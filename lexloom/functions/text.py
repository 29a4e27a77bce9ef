"""Character-level operators as Column expressions. ``(?U)`` makes \\s, \\b and \\w Unicode-aware in Java.

Repeated groups are possessive: Java's engine recurses once for every repetition that it may have to give back, which
overflows the stack on long runs, and none of these ever has to.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.constants import ANCHORS, BLOCK_MARKER, CYRILLIC, MAX_CONSONANTS, MAX_WORD_LENGTH, OLD_MARKER, VOWELS

SPACED_LETTERS = r"(?U)\b\p{L}(?:\s++\p{L}\b)++"
LINE_HYPHEN = r"(?U)(\p{L}+)-\s*\n\s*(\p{L}+)"
FALSE_HYPHEN = rf"(?iuU)(?=\w*[{CYRILLIC}])(\w+)-\n+(?=\w*[{CYRILLIC}])(\w+)|(\w+-\n+\w+)"
CONSONANT = f"(?![{VOWELS}])[{CYRILLIC}]"


def squeeze(text: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.btrim(F.regexp_replace(text, r"(?U)\s+", " "))


def remove_special(text: Column) -> Column:
    """Keep letters, spaces, line feeds and hyphens."""
    return F.regexp_replace(text, r"[^\p{L} \n-]", "")


def count_spaced_letters(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACED_LETTERS))


def drop_spaced_letters(text: Column) -> Column:
    """Drop runs of single letters with white space between them."""
    return squeeze(F.regexp_replace(text, SPACED_LETTERS, ""))


def protect_boundaries(text: Column) -> Column:
    """Two or more white-space characters become a block marker."""
    return F.regexp_replace(text, r"(?U)\s{2,}", f" {BLOCK_MARKER} ")


def restore_boundaries(text: Column) -> Column:
    """Markers go; runs of white space become one space."""
    bare = F.replace(F.replace(text, F.lit(BLOCK_MARKER), F.lit("")), F.lit(OLD_MARKER), F.lit(""))
    return F.regexp_replace(bare, r"(?U)\s+", " ")


def merge_line_hyphens(text: Column) -> Column:
    """Join words that a hyphen splits at a line's end."""
    return F.regexp_replace(text, LINE_HYPHEN, "$1$2")


def count_line_hyphens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(LINE_HYPHEN))


def remove_false_hyphens(text: Column) -> Column:
    """Join words split by hyphen and line feeds, if both hold a Cyrillic letter."""
    return F.regexp_replace(text, FALSE_HYPHEN, "$1$2$3")


def phonetically_valid(word: Column) -> Column:
    """False if MAX_CONSONANTS Cyrillic letters in a row are no vowels."""
    return ~F.rlike(word, F.lit(f"(?iu)(?:{CONSONANT}){{{MAX_CONSONANTS}}}"))


def length_valid(word: Column) -> Column:
    """Words with a lower-case anchor letter may be longer than MAX_WORD_LENGTH."""
    return F.rlike(word, F.lit(f"[{ANCHORS}]")) | (F.length(word) <= MAX_WORD_LENGTH)


def badness(text: Column) -> Column:
    """Single-character tokens as a share of all; 0 for blank texts."""
    tokens = F.regexp_count(text, F.lit(r"(?U)\S++"))
    single = F.regexp_count(text, F.lit(r"(?U)(?<!\S)\S(?!\S)"))
    # each count stands once, as a lambda's body has no common parts
    return F.coalesce(F.try_divide(single, tokens), F.when(text.isNotNull(), F.lit(0.0)))
