"""A word's language by a cascade of rules, as one CASE expression with the rule that decided."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexloom.config import DEFAULT, Config
from lexloom.constants import ANCHORS, DIPHTHONGS, RUSSIAN_ENDINGS, RUSSIAN_MARKERS, SAKHA_ENDINGS
from lexloom.functions.tokens import joined_tokens

#: Deciding rules that delete a word.
DELETING = ("rules", "marker", "russian_ending", "dictionary", "fallback")

_RUSSIAN_END = f"(?:{'|'.join(RUSSIAN_ENDINGS)})$"
_SAKHA_END = f"(?:{'|'.join(SAKHA_ENDINGS)})$"


def _flags(config: Config, ignore_case: bool) -> tuple[str, str, str]:
    case = "(?iu)" if ignore_case else ""
    markers = RUSSIAN_MARKERS if config.use_v_as_russian_marker else RUSSIAN_MARKERS.replace("в", "")
    return f"{case}[{ANCHORS}]", f"{case}(?:{'|'.join(DIPHTHONGS)})", f"{case}[{markers}]"


def has_anchor(word: Column) -> Column:
    return F.rlike(word, F.lit(f"[{ANCHORS}]"))


def has_diphthong(word: Column) -> Column:
    return F.rlike(word, F.lit("|".join(DIPHTHONGS)))


def has_russian_marker(word: Column, config: Config = DEFAULT) -> Column:
    return F.rlike(word, F.lit(_flags(config, False)[2]))


def has_russian_ending(word: Column) -> Column:
    return F.rlike(F.lower(word), F.lit(_RUSSIAN_END))


def has_sakha_ending(word: Column) -> Column:
    return F.rlike(F.lower(word), F.lit(_SAKHA_END))


def deciding_rule(word: Column, config: Config = DEFAULT, in_rules: Column | None = None, fallback: Column | None = None, ignore_case: bool = False) -> Column:
    """empty, anchor, diphthong, rules, marker, sakha_ending, russian_ending, fallback or undecided, the first that holds.

    ``in_rules`` says whether the user's word lists match; ``fallback`` whether an outside detector calls the word Russian.
    """
    anchor, diphthong, marker = _flags(config, ignore_case)
    out = F.when(F.regexp_replace(word, r"(?U)\s+", "") == "", "empty").when(F.rlike(word, F.lit(anchor)), "anchor").when(F.rlike(word, F.lit(diphthong)), "diphthong")
    if in_rules is not None:
        out = out.when(in_rules, "rules")
    out = out.when(F.rlike(word, F.lit(marker)), "marker").when(has_sakha_ending(word), "sakha_ending").when(has_russian_ending(word), "russian_ending")
    if fallback is not None:
        out = out.when(fallback, "fallback")
    return out.otherwise("undecided")


def is_russian(word: Column, config: Config = DEFAULT, **kw) -> Column:
    return deciding_rule(word, config, **kw).isin(*DELETING)


def deleted_by_form(word: Column, config: Config = DEFAULT) -> Column:
    """Whether the cascade without word lists and detector deletes a word.

    The first test lets most words pass without another look.
    """
    anchor, diphthong, marker = _flags(config, False)
    suspect = F.rlike(word, F.lit(f"{marker}|(?iu:{_RUSSIAN_END})"))
    return suspect & ~F.rlike(word, F.lit(f"{anchor}|{diphthong}")) & (F.rlike(word, F.lit(marker)) | ~F.rlike(word, F.lit(f"(?iu:{_SAKHA_END})")))


def spaced_out(token: Column) -> Column:
    """A kept token's inner dashes, underscores and line feeds become spaces."""
    return F.regexp_replace(token, "[–_\n]+", " ")


def kept_tokens(text: Column, config: Config = DEFAULT) -> Column:
    """Tokens that are not Russian, with inner dashes, underscores and line feeds as spaces."""
    return F.transform(F.filter(joined_tokens(text), lambda w: ~deleted_by_form(w, config)), spaced_out)


def remove_russian_words(text: Column, config: Config = DEFAULT) -> Column:
    return F.array_join(kept_tokens(text, config), " ")
