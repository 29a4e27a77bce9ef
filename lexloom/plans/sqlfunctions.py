"""The operators under names for SQL. ``matches_rules`` takes a word and an array of listed words."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lexloom.config import DEFAULT, Config
from lexloom.constants import ALL_ENDINGS, ANCHORS, BLOCK_MARKER, DIPHTHONGS, MAX_CONSONANTS, MAX_WORD_LENGTH, OLD_MARKER, RUSSIAN_ENDINGS, RUSSIAN_MARKERS, SAKHA_ENDINGS
from lexloom.functions import healing, tokens
from lexloom.functions import text as T
from lexloom.operators.rules import MAX_REST, MIN_STEM
from lexloom.session import ship


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n") + "'"


def _stems(word: str) -> str:
    cuts = ", ".join(f"CASE WHEN endswith(lower({word}), '{e}') AND length({word}) - {len(e)} >= {MIN_STEM} THEN substring(lower({word}), 1, length({word}) - {len(e)}) END" for e in ALL_ENDINGS)
    return f"array_distinct(filter(array(lower({word}), {cuts}), s -> s IS NOT NULL))"


_CASCADE = f"""CASE WHEN btrim(x) = '' THEN 'empty' WHEN x rlike '[{ANCHORS}]' THEN 'anchor' WHEN x rlike '{"|".join(DIPHTHONGS)}' THEN 'diphthong' WHEN x rlike '[{RUSSIAN_MARKERS}]' THEN 'marker'
WHEN lower(x) rlike '(?:{"|".join(SAKHA_ENDINGS)})$' THEN 'sakha_ending' WHEN lower(x) rlike '(?:{"|".join(RUSSIAN_ENDINGS)})$' THEN 'russian_ending' ELSE 'undecided' END"""
#: Whether a word matches an array of listed words: by a stem, or by a listed stem and a fitting rest.
_MATCH = f"""arrays_overlap({_stems("x")}, flatten(transform(listed, l -> {_stems("l")})))
OR exists(flatten(transform(listed, l -> {_stems("l")})), s -> length(s) >= {MIN_STEM} AND startswith(lower(x), s) AND (length(x) - length(s) <= {MAX_REST} OR substring(lower(x), length(s) + 1) rlike '^(?:{"|".join(SAKHA_ENDINGS)})'))"""


def _definitions() -> dict[str, tuple[str, str]]:
    q = _literal
    squeezed = lambda x: f"btrim(regexp_replace({x}, {q(chr(40) + '?U)' + chr(92) + 's+')}, ' '))"
    spaces = q(r"(?U)\s+")
    bare = f"replace(replace(x, {q(BLOCK_MARKER)}, ''), {q(OLD_MARKER)}, '')"
    return {
        "remove_special": ("STRING", f"regexp_replace(x, {q(r'[^\p{L} \n-]')}, '')"),
        "drop_spaced_letters": ("STRING", squeezed(f"regexp_replace(x, {q(T.SPACED_LETTERS)}, '')")),
        "protect_boundaries": ("STRING", f"regexp_replace(x, {q(r'(?U)\s{2,}')}, {q(f' {BLOCK_MARKER} ')})"),
        "restore_boundaries": ("STRING", f"regexp_replace({bare}, {spaces}, ' ')"),
        "merge_line_hyphens": ("STRING", f"regexp_replace(x, {q(T.LINE_HYPHEN)}, '$1$2')"),
        "remove_false_hyphens": ("STRING", f"regexp_replace(x, {q(T.FALSE_HYPHEN)}, '$1$2$3')"),
        "dot_tokens": ("ARRAY<STRING>", f"regexp_extract_all(x, {q(tokens.DOT_TOKEN)}, 0)"),
        "joined_tokens": ("ARRAY<STRING>", f"regexp_extract_all(x, {q(tokens.JOINED_TOKEN)}, 0)"),
        "is_dropped_token": ("BOOLEAN", f"x rlike {q(tokens.DROPPED)}"),
        "has_anchor": ("BOOLEAN", f"x rlike {q(f'[{ANCHORS}]')}"),
        "has_diphthong": ("BOOLEAN", f"x rlike {q('|'.join(DIPHTHONGS))}"),
        "has_russian_marker": ("BOOLEAN", f"x rlike {q(f'[{RUSSIAN_MARKERS}]')}"),
        "has_russian_ending": ("BOOLEAN", f"lower(x) rlike {q('(?:' + '|'.join(RUSSIAN_ENDINGS) + ')$')}"),
        "has_sakha_ending": ("BOOLEAN", f"lower(x) rlike {q('(?:' + '|'.join(SAKHA_ENDINGS) + ')$')}"),
        "phonetically_valid": ("BOOLEAN", f"NOT x rlike {q(f'(?iu)(?:{T.CONSONANT}){{{MAX_CONSONANTS}}}')}"),
        "badness": ("DOUBLE", f"CASE WHEN regexp_count(x, {q(chr(40) + '?U)' + chr(92) + 'S++')}) = 0 THEN 0D ELSE regexp_count(x, {q(r'(?U)(?<!\S)\S(?!\S)')}) / regexp_count(x, {q(r'(?U)\S++')}) END"),
        "deciding_rule": ("STRING", _CASCADE),
        "is_russian": ("BOOLEAN", f"({_CASCADE}) IN ('marker', 'russian_ending')"),
        "stems": ("ARRAY<STRING>", _stems("x")),
        "length_valid": ("BOOLEAN", f"x rlike {q(f'[{ANCHORS}]')} OR length(x) <= {MAX_WORD_LENGTH}"),
    }


def register(spark: SparkSession, config: Config = DEFAULT, prefix: str = "lexloom_") -> list[str]:
    """Define all functions for this session; those but normalizing, repairing and healing are plain SQL."""
    ship(spark)
    names = []
    for name, (kind, body) in _definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(x STRING) RETURNS {kind} RETURN {body}")
        names.append(prefix + name)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}matches_rules(x STRING, listed ARRAY<STRING>) RETURNS BOOLEAN RETURN {_MATCH}")
    names.append(f"{prefix}matches_rules")
    n = config.word_healer_passes
    for name, function in (("smart_normalize", healing.normalize), ("repair_broken_words", lambda t: healing.repair(t, n)), ("heal_text", lambda t: healing.heal(t, n))):
        spark.udf.register(prefix + name, healing._batch(function))
        names.append(prefix + name)
    return names
