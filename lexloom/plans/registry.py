"""Every query over the driver's tables, with the SQL it is compared with.

The tables hold no Cyrillic, so Cyrillic operators run over whole documents that are transliterated letter by letter in
the same way on both sides. Queries without SQL need look-around or iteration that SQL lacks; tests cover them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.config import DEFAULT
from lexloom.constants import ANCHORS, CYRILLIC, DIPHTHONGS, MAX_CONSONANTS, RUSSIAN_ENDINGS, RUSSIAN_MARKERS, SAKHA_ENDINGS
from lexloom.functions import classify, healing, scalar, tokens
from lexloom.functions import text as T
from lexloom.operators import dictionary, flatten, rules, stats
from lexloom.plans import healing_sql, pipeline
from lexloom.session import ship
from lexloom.sources import files, textfiles
from lexloom.sources.scratch import materialize, scratch_path
from lexloom.streaming import clean_stream as streaming

LATIN = "abcdefghijklmnopqrstuvwxyz"
TO_CYRILLIC = "абҕдаөгхийклмнопүрстувэыьъ"
TO_ANCHORS = "абсдефгһийклмнөпҕрстуүхыэя"
_MIXED = [(a, b) for a, b in zip(LATIN, TO_CYRILLIC, strict=True) if a not in "hoy"]
LATIN_MIXED, TO_MIXED = "".join(a for a, _ in _MIXED), "".join(b for _, b in _MIXED)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _view(change):
    return lambda spark, sf_dir: documents(spark, sf_dir).withColumn("text", change(F.col("text")))


cyrillic = _view(lambda t: F.translate(F.lower(t), LATIN, TO_CYRILLIC))
anchored = _view(lambda t: F.translate(F.lower(t), LATIN, TO_ANCHORS))
upper_cyrillic = _view(lambda t: F.translate(F.lower(t), LATIN, TO_CYRILLIC.upper()))
mixed = _view(lambda t: F.translate(F.lower(t), LATIN_MIXED, TO_MIXED))
spaced = _view(lambda t: F.regexp_replace(F.translate(F.lower(t), LATIN, TO_CYRILLIC), r"(\p{L})", "$1 "))
hyphenated = _view(lambda t: F.regexp_replace(F.translate(F.lower(t), LATIN, TO_CYRILLIC), "([а-я]) ([а-я])", "$1-\n$2"))
wide = _view(lambda t: F.replace(t, F.lit(". "), F.lit(".  ")))

SQL_CYRILLIC = f"translate(lower(text), '{LATIN}', '{TO_CYRILLIC}')"
SQL_ANCHORED = f"translate(lower(text), '{LATIN}', '{TO_ANCHORS}')"
SQL_SPACED = rf"regexp_replace({SQL_CYRILLIC}, '(\p{{L}})', '\1 ', 'g')"
SQL_HYPHENATED = rf"regexp_replace({SQL_CYRILLIC}, '([а-я]) ([а-я])', '\1-' || chr(10) || '\2', 'g')"
SQL_WIDE = "replace(text, '. ', '.  ')"
_JOINED = r"'\p{L}+(?:[-–_' || chr(10) || ']\p{L}+)*'"
_DOT = r"'\p{L}+(?:-\p{L}+)*\.?'"
_RU_END = f"'(?:{'|'.join(RUSSIAN_ENDINGS)})$'"
_SA_END = f"'(?:{'|'.join(SAKHA_ENDINGS)})$'"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, run, sql: str | None = None) -> None:
    QUERIES[name] = run
    if sql:
        ORACLES[name] = sql


def per_document(name: str, view, value, sql: str | None = None, column: str = "value") -> None:
    query(name, lambda spark, sf_dir: view(spark, sf_dir).select("doc_id", value(F.col("text")).alias(column)), sql)


def distinct_words(view, spark, sf_dir) -> DataFrame:
    return view(spark, sf_dir).select(F.explode(tokens.joined_tokens(F.col("text"))).alias("word")).distinct()


def per_word(name: str, value, sql_value: str | None, column: str = "flag", view=cyrillic, sql_text: str = SQL_CYRILLIC) -> None:
    sql = sql_value and f"SELECT word, {sql_value} AS {column} FROM (SELECT DISTINCT unnest(regexp_extract_all({sql_text}, {_JOINED})) AS word FROM documents)"
    query(name, lambda spark, sf_dir: distinct_words(view, spark, sf_dir).select("word", value(F.col("word")).alias(column)), sql)


# projections

per_document("remove_special", documents, T.remove_special, r"SELECT doc_id, regexp_replace(text, '[^\p{L} ' || chr(10) || '-]', '', 'g') AS value FROM documents")
# in SQL every word gets marks around it first, as its engine knows no boundary without a character
_WHITE_SQL = r"[\x09-\x0d\x85\p{Z}]+"
_RUN_SQL = rf"(?:\x01\p{{L}}\x02{_WHITE_SQL})+\x01\p{{L}}\x02"


def _spaced_sql(text: str) -> tuple[str, str]:
    """SQL for the number of spaced-letter runs of a text, and for the text without them."""
    marked = rf"regexp_replace({text}, '([\p{{L}}\p{{M}}\p{{Nd}}\p{{Pc}}]+)', chr(1) || '\1' || chr(2), 'g')"
    bare = f"replace(replace(regexp_replace({marked}, '{_RUN_SQL}', '', 'g'), chr(1), ''), chr(2), '')"
    return f"CAST(len(regexp_extract_all({marked}, '{_RUN_SQL}')) AS BIGINT)", f"trim(regexp_replace({bare}, '{_WHITE_SQL}', ' ', 'g'), ' ')"


query(
    "spaced_letters",
    lambda spark, sf_dir: spaced(spark, sf_dir).select("doc_id", T.count_spaced_letters(F.col("text")).cast("long").alias("runs"), T.drop_spaced_letters(F.col("text")).alias("value")),
    "SELECT doc_id, {} AS runs, {} AS value FROM documents".format(*_spaced_sql(SQL_SPACED)),
)
per_document("word_count", documents, lambda t: tokens.count_words(t).cast("long"), r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\p{L}+')) AS BIGINT) AS value FROM documents")
per_document("tokenize_words", documents, lambda t: F.array_join(tokens.dot_tokens(t), "|"), f"SELECT doc_id, array_to_string(regexp_extract_all(text, {_DOT}), '|') AS value FROM documents")
per_document("tokenize_joined", documents, lambda t: F.array_join(tokens.joined_tokens(t), "|"), f"SELECT doc_id, array_to_string(regexp_extract_all(text, {_JOINED}), '|') AS value FROM documents")

_RULE_SQL = {
    "single_letter": "length(w) > 1",
    "abbreviation": "NOT contains(w, '.')",
    "upper_cyrillic": "NOT regexp_matches(w, '^[А-ЯЁ]{2,5}$')",
    "latin": "NOT regexp_matches(w, '^[A-Za-z]+$')",
    "roman": "NOT regexp_matches(w, '^[IVXLCDMivxlcdm]+$')",
}
_RULE_VIEW = {"upper_cyrillic": (upper_cyrillic, f"translate(lower(text), '{LATIN}', '{TO_CYRILLIC.upper()}')")}
for _name, _sql in _RULE_SQL.items():
    _of, _text = _RULE_VIEW.get(_name, (documents, "text"))
    per_document(
        f"filter_{_name}", _of, lambda t, rule=_name: F.array_join(tokens.drop_by(tokens.dot_tokens(t), rule), " "), f"SELECT doc_id, array_to_string(list_filter(regexp_extract_all({_text}, {_DOT}), lambda w: {_sql}), ' ') AS value FROM documents"
    )
_ALL_RULES = " AND ".join(_RULE_SQL.values())
per_document(
    "filter_invalid_tokens", cyrillic, lambda t: F.array_join(F.filter(tokens.dot_tokens(t), lambda w: ~F.rlike(w, F.lit(tokens.DROPPED))), " "), f"SELECT doc_id, array_to_string(list_filter(regexp_extract_all({SQL_CYRILLIC}, {_DOT}), lambda w: {_ALL_RULES}), ' ') AS value FROM documents"
)
per_document("filter_invalid_words", documents, tokens.filter_invalid_words, f"SELECT doc_id, array_to_string(list_filter(regexp_extract_all({_spaced_sql('text')[1]}, {_DOT}), lambda w: {_ALL_RULES}), ' ') AS value FROM documents")
_REASON = "CASE " + " ".join(f"WHEN NOT ({sql}) THEN '{name}'" for name, sql in _RULE_SQL.items()) + " END"
query(
    "invalid_reason_counts",
    lambda spark, sf_dir: documents(spark, sf_dir).select(F.explode(tokens.dot_tokens(F.col("text"))).alias("w")).select(tokens.drop_reason(F.col("w")).alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("n")),
    f"SELECT reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM (SELECT unnest(regexp_extract_all(text, {_DOT})) AS w FROM documents)) WHERE reason IS NOT NULL GROUP BY reason",
)
query(
    "removal_counts",
    lambda spark, sf_dir: stats.removal_counts(documents(spark, sf_dir)),
    f"SELECT reason, count(*) AS n FROM (SELECT {_REASON} AS reason FROM (SELECT unnest(regexp_extract_all({_spaced_sql('text')[1]}, {_DOT})) AS w FROM documents)) WHERE reason IS NOT NULL GROUP BY reason UNION ALL SELECT 'spaced_letters', CAST(coalesce(sum({_spaced_sql('text')[0]}), 0) AS BIGINT) FROM documents",
)

# the language cascade

_ANCHOR_SQL, _DIPHTHONG_SQL = f"regexp_matches(word, '[{ANCHORS}]')", f"regexp_matches(word, '{'|'.join(DIPHTHONGS)}')"
_MARKER_SQL, _NO_V_SQL = f"regexp_matches(word, '[{RUSSIAN_MARKERS}]')", f"regexp_matches(word, '[{RUSSIAN_MARKERS.replace('в', '')}]')"
_RULE_CASE = f"CASE WHEN {_ANCHOR_SQL} THEN 'anchor' WHEN {_DIPHTHONG_SQL} THEN 'diphthong' WHEN {_MARKER_SQL} THEN 'marker' WHEN regexp_matches(lower(word), {_SA_END}) THEN 'sakha_ending' WHEN regexp_matches(lower(word), {_RU_END}) THEN 'russian_ending' ELSE 'undecided' END"
per_word("anchor_flag", classify.has_anchor, _ANCHOR_SQL)
per_word("diphthong_flag", classify.has_diphthong, _DIPHTHONG_SQL)
per_word("marker_flag", classify.has_russian_marker, _MARKER_SQL)
per_word("marker_flag_no_v", lambda w: classify.has_russian_marker(w, DEFAULT.with_(use_v_as_russian_marker=False)), _NO_V_SQL)
per_word("russian_ending_flag", classify.has_russian_ending, f"regexp_matches(lower(word), {_RU_END})")
per_word("sakha_ending_flag", classify.has_sakha_ending, f"regexp_matches(lower(word), {_SA_END})")
per_word("classify_reason", classify.deciding_rule, _RULE_CASE, "rule")
per_word("classify_reason_anchored", classify.deciding_rule, _RULE_CASE, "rule", anchored, SQL_ANCHORED)
query(
    "classify_reason_counts",
    lambda spark, sf_dir: cyrillic(spark, sf_dir).select(F.explode(tokens.joined_tokens(F.col("text"))).alias("word")).groupBy(classify.deciding_rule(F.col("word")).alias("rule")).agg(F.count("*").alias("n")),
    f"SELECT {_RULE_CASE} AS rule, count(*) AS n FROM (SELECT unnest(regexp_extract_all({SQL_CYRILLIC}, {_JOINED})) AS word FROM documents) GROUP BY 1",
)
_RUSSIAN_SQL = f"(({_RULE_CASE}) IN ('marker', 'russian_ending'))"
_KEPT_SQL = f"list_filter(regexp_extract_all({SQL_CYRILLIC}, {_JOINED}), lambda word: NOT {_RUSSIAN_SQL})"
per_document("remove_russian_words", cyrillic, classify.remove_russian_words, f"SELECT doc_id, array_to_string(list_transform({_KEPT_SQL}, lambda word: regexp_replace(word, '[–_' || chr(10) || ']+', ' ', 'g')), ' ') AS value FROM documents")
query(
    "kept_and_removed",
    lambda spark, sf_dir: stats.kept_and_removed(cyrillic(spark, sf_dir)),
    f"SELECT CAST(count(*) FILTER (WHERE NOT {_RUSSIAN_SQL}) AS BIGINT) AS kept, CAST(count(*) FILTER (WHERE {_RUSSIAN_SQL}) AS BIGINT) AS removed FROM (SELECT unnest(regexp_extract_all({SQL_CYRILLIC}, {_JOINED})) AS word FROM documents)",
)
query(
    "removed_sample",
    lambda spark, sf_dir: stats.removed_sample(cyrillic(spark, sf_dir)),
    f"SELECT doc_id, array_to_string(gone[1:20], ' ') AS sample, CAST(len(gone) AS BIGINT) AS removed FROM (SELECT doc_id, list_filter(regexp_extract_all({SQL_CYRILLIC}, {_JOINED}), lambda word: {_RUSSIAN_SQL}) AS gone FROM documents)",
)

# word lists


def rule_words(spark, sf_dir) -> DataFrame:
    text = F.translate(F.lower("text"), LATIN, TO_CYRILLIC)
    return table(spark, sf_dir, "benchmark").select(F.explode(tokens.joined_tokens(text)).alias("word")).distinct()


def _stem_sql(word: str) -> str:
    cuts = ", ".join(f"CASE WHEN lower({word}) LIKE '%{e}' AND length({word}) - {len(e)} >= {rules.MIN_STEM} THEN substr(lower({word}), 1, length({word}) - {len(e)}) END" for e in rules.ALL_ENDINGS)
    return f"list_distinct([lower({word}), {cuts}])"


_WORDS_SQL = f"(SELECT DISTINCT unnest(regexp_extract_all({SQL_CYRILLIC}, {_JOINED})) AS word FROM documents)"
_LISTED_SQL = f"(SELECT DISTINCT unnest(regexp_extract_all({SQL_CYRILLIC}, {_JOINED})) AS word FROM benchmark)"
_LISTED_STEMS_SQL = f"(SELECT DISTINCT stem FROM (SELECT unnest({_stem_sql('word')}) AS stem FROM {_LISTED_SQL}) WHERE stem IS NOT NULL)"
_EXACT_SQL = f"SELECT word FROM {_WORDS_SQL} WHERE lower(word) IN (SELECT lower(word) FROM {_LISTED_SQL})"
_STEM_SQL = f"SELECT DISTINCT word FROM (SELECT word, unnest({_stem_sql('word')}) AS stem FROM {_WORDS_SQL}) WHERE stem IN (SELECT stem FROM {_LISTED_STEMS_SQL})"
_PREFIX_SQL = f"""SELECT DISTINCT word FROM (SELECT word, substr(lower(word), 1, cut) AS stem, substr(lower(word), cut + 1) AS rest FROM (SELECT word, unnest(range({rules.MIN_STEM}, length(word) + 1)) AS cut FROM {_WORDS_SQL}))
WHERE (length(rest) <= {rules.MAX_REST} OR regexp_matches(rest, '^(?:{"|".join(SAKHA_ENDINGS)})')) AND stem IN (SELECT stem FROM {_LISTED_STEMS_SQL})"""
per_word("extract_stems", lambda w: F.array_join(F.array_sort(rules.stems(w)), "|"), f"array_to_string(list_sort(list_filter({_stem_sql('word')}, lambda s: s IS NOT NULL)), '|')", "stems")
query("rules_exact", lambda spark, sf_dir: rules.exact_matches(distinct_words(cyrillic, spark, sf_dir), rules.rule_tables(rule_words(spark, sf_dir))[0]), _EXACT_SQL)
query("rules_stem_overlap", lambda spark, sf_dir: rules.stem_matches(distinct_words(cyrillic, spark, sf_dir), rules.rule_tables(rule_words(spark, sf_dir))[1]), _STEM_SQL)
query("rules_prefix", lambda spark, sf_dir: rules.prefix_matches(distinct_words(cyrillic, spark, sf_dir), rules.rule_tables(rule_words(spark, sf_dir))[1]), _PREFIX_SQL)
query(
    "rules_match",
    lambda spark, sf_dir: rules.match_rules(distinct_words(cyrillic, spark, sf_dir), rule_words(spark, sf_dir)),
    f"SELECT word, CASE min(r) WHEN 1 THEN 'exact' WHEN 2 THEN 'stem' ELSE 'prefix' END AS way FROM (SELECT word, 1 AS r FROM ({_EXACT_SQL}) UNION ALL SELECT word, 2 FROM ({_STEM_SQL}) UNION ALL SELECT word, 3 FROM ({_PREFIX_SQL})) GROUP BY word",
)


_UNHEALED_SQL = rf"regexp_replace({SQL_CYRILLIC}, '[^\p{{L}} ' || chr(10) || '-]', '', 'g')"
_VALID_SQL = f"array_to_string(list_filter(regexp_extract_all({_spaced_sql(_UNHEALED_SQL)[1]}, {_DOT}), lambda w: {_ALL_RULES}), ' ')"


def _with_rules_sql(valid: str) -> str:
    """SQL for the texts that ``valid`` (doc_id, value) leaves, without Russian and listed words."""
    return f"""WITH t AS (SELECT doc_id, regexp_extract_all(value, {_JOINED}) AS ws FROM ({valid})),
k AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM t),
w AS (SELECT DISTINCT word FROM k),
stems AS MATERIALIZED (SELECT stem FROM {_LISTED_STEMS_SQL}),
hit AS (SELECT word FROM w WHERE lower(word) IN (SELECT lower(word) FROM {_LISTED_SQL})
  UNION SELECT word FROM (SELECT word, unnest({_stem_sql('word')}) AS stem FROM w) WHERE stem IN (SELECT stem FROM stems)
  UNION SELECT word FROM (SELECT word, substr(lower(word), 1, cut) AS stem, substr(lower(word), cut + 1) AS rest FROM (SELECT word, unnest(range({rules.MIN_STEM}, length(word) + 1)) AS cut FROM w))
    WHERE (length(rest) <= {rules.MAX_REST} OR regexp_matches(rest, '^(?:{"|".join(SAKHA_ENDINGS)})')) AND stem IN (SELECT stem FROM stems)),
kept AS (SELECT word FROM w WHERE {_ANCHOR_SQL} OR {_DIPHTHONG_SQL} OR (NOT {_RUSSIAN_SQL} AND word NOT IN (SELECT word FROM hit)))
SELECT d.doc_id, coalesce(s.text, '') AS text FROM documents d LEFT JOIN (SELECT doc_id, string_agg(regexp_replace(word, '[–_' || chr(10) || ']+', ' ', 'g'), ' ' ORDER BY pos) AS text FROM k JOIN kept USING (word) GROUP BY doc_id) s ON d.doc_id = s.doc_id"""


# without healing here; clean_with_rules_healed is the whole pipeline
query(
    "clean_with_rules",
    lambda spark, sf_dir: pipeline.clean_with_rules(cyrillic(spark, sf_dir), rule_words(spark, sf_dir), DEFAULT.with_(word_healer_enabled=False)),
    _with_rules_sql(f"SELECT doc_id, {_VALID_SQL} AS value FROM documents"),
)
per_document("exceptions_match", cyrillic, scalar.matches_exception, f"SELECT doc_id, (contains(t, 'г.') OR contains(t, 'стр.') OR contains(t, 'т.д.') OR contains(t, 'и т.д.')) AS value FROM (SELECT doc_id, lower({SQL_CYRILLIC}) AS t FROM documents)")

# healing

_PROTECTED_SQL = rf"regexp_replace({SQL_WIDE}, '\s{{2,}}', ' [[BLOCK]] ', 'g')"
per_document("protect_boundaries", wide, T.protect_boundaries, f"SELECT doc_id, {_PROTECTED_SQL} AS value FROM documents")
per_document("restore_boundaries", wide, lambda t: T.restore_boundaries(T.protect_boundaries(t)), rf"SELECT doc_id, regexp_replace(replace({_PROTECTED_SQL}, '[[BLOCK]]', ''), '\s+', ' ', 'g') AS value FROM documents")


def _over_documents(text: str, steps: healing_sql.Steps, value: str = "coalesce(t, '')", column: str = "value") -> str:
    """SQL over every document: ``text``, put through steps that start from the table base."""
    ctes, last = steps
    return f"WITH base AS (SELECT doc_id, {text} AS t FROM documents), {', '.join(ctes)} SELECT d.doc_id, {value} AS {column} FROM documents d LEFT JOIN {last} l ON d.doc_id = l.doc_id"


def shipped(name: str, view, value, sql: str) -> None:
    def run(spark, sf_dir) -> DataFrame:
        ship(spark)
        return view(spark, sf_dir).select("doc_id", value(F.col("text")).alias("value"))

    query(name, run, sql)


PASSES = DEFAULT.word_healer_passes
SQL_MIXED = f"translate(lower(text), '{LATIN_MIXED}', '{TO_MIXED}')"
shipped("smart_normalize", mixed, healing.smart_normalize, _over_documents(SQL_MIXED, healing_sql.normalized("base")))
per_document("native_normalize", mixed, healing.native_normalize, ORACLES["smart_normalize"])
shipped("repair_broken_words", spaced, healing.repair_broken_words, _over_documents(SQL_SPACED, healing_sql.repaired("base", PASSES)))
shipped("heal_text", mixed, healing.heal_text, _over_documents(SQL_MIXED, healing_sql.healed("base", PASSES)))
per_word("phonetic_valid", T.phonetically_valid, f"NOT regexp_matches(word, '[{healing_sql.CONSONANTS}{healing_sql.CONSONANTS.upper()}]{{{MAX_CONSONANTS}}}')")
per_word("length_valid", T.length_valid, f"({_ANCHOR_SQL} OR length(word) <= 25)")
per_document("false_hyphens", hyphenated, T.remove_false_hyphens, rf"SELECT doc_id, regexp_replace({SQL_HYPHENATED}, '([\p{{L}}\p{{N}}_]+)-\n+([\p{{L}}\p{{N}}_]+)', '\1\2', 'g') AS value FROM documents")
_MERGE = r"'(\p{L}+)-\s*\n\s*(\p{L}+)'"
per_document("pdf_hyphen_merge", hyphenated, T.merge_line_hyphens, rf"SELECT doc_id, regexp_replace({SQL_HYPHENATED}, {_MERGE}, '\1\2', 'g') AS value FROM documents")
per_document("hyphen_merge_count", hyphenated, lambda t: T.count_line_hyphens(t).cast("long"), f"SELECT doc_id, CAST(len(regexp_extract_all({SQL_HYPHENATED}, {_MERGE})) AS BIGINT) AS value FROM documents")

# statistics


def _badness_sql(text: str) -> str:
    parts = rf"string_split(trim(regexp_replace({text}, '\s+', ' ', 'g')), ' ')"
    return f"(CASE WHEN trim(regexp_replace({text}, '\\s+', ' ', 'g')) = '' THEN 0.0 ELSE CAST(len(list_filter({parts}, lambda w: length(w) = 1)) AS DOUBLE) / len({parts}) END)"


per_document("badness_score", spaced, T.badness, f"SELECT doc_id, {_badness_sql(SQL_SPACED)} AS value FROM documents")
_HALF = r"([а-п])"


def attempts(spark, sf_dir) -> DataFrame:
    """(page, attempts): an array of (level, text) for each document as a page."""
    base = cyrillic(spark, sf_dir).select(F.col("doc_id").alias("page"), "text")
    levels = [F.regexp_replace("text", r"(\p{L})", "$1 "), F.regexp_replace("text", _HALF, "$1 "), F.regexp_replace("text", "([а-в])", "$1 ")]
    return base.select("page", F.array(*(F.struct(F.lit(n).alias("level"), t.alias("text")) for n, t in enumerate(levels))).alias("attempts"))


query(
    "best_tolerance",
    lambda spark, sf_dir: attempts(spark, sf_dir).select("page", F.inline(F.array(stats.best_in_row(F.col("attempts"))))).select("page", F.col("level").cast("long").alias("level"), F.length("text").cast("long").alias("n_chars"), F.col("warning").isNotNull().alias("warned")),
    rf"""WITH a AS (SELECT doc_id AS page, 0 AS level, {SQL_SPACED} AS t FROM documents UNION ALL SELECT doc_id, 1, regexp_replace({SQL_CYRILLIC}, '{_HALF}', '\1 ', 'g') FROM documents UNION ALL SELECT doc_id, 2, regexp_replace({SQL_CYRILLIC}, '([а-в])', '\1 ', 'g') FROM documents),
s AS (SELECT page, level, t, {_badness_sql('t')} AS score FROM a),
r AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY score > 0.3, CASE WHEN score > 0.3 THEN score ELSE 0 END, level) AS n FROM s WHERE t <> '' AND score < 1)
SELECT p.page, CAST(coalesce(r.level, p.level) AS BIGINT) AS level, CAST(length(coalesce(r.t, p.t)) AS BIGINT) AS n_chars, r.level IS NULL AS warned FROM (SELECT * FROM a WHERE level = 1) p LEFT JOIN r ON p.page = r.page AND r.n = 1""",
)
query("corpus_stats", lambda spark, sf_dir: stats.corpus_stats(documents(spark, sf_dir)), r"SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS n_chars, CAST(sum(len(regexp_extract_all(text, '\p{L}+'))) AS BIGINT) AS n_words, CAST(sum(strlen(text)) AS BIGINT) AS n_bytes FROM documents")
query(
    "warning_counts",
    lambda spark, sf_dir: stats.warning_counts(documents(spark, sf_dir).select(F.when(F.length("text") < 100, "short").when(F.contains("text", F.lit("***")), "symbols").otherwise("none").alias("message"))),
    "SELECT CASE WHEN length(text) < 100 THEN 'short' WHEN contains(text, '***') THEN 'symbols' ELSE 'none' END AS message, count(*) AS n FROM documents GROUP BY 1",
)
query(
    "merge_corpus",
    lambda spark, sf_dir: stats.merge_corpus(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc"), F.struct("turn", "role").alias("pos"), "text")),
    "SELECT conv_id AS doc, string_agg(text, chr(10) ORDER BY turn, role, text) AS text FROM conversations GROUP BY conv_id",
)

# flattening, sources and formats

query(
    "row_text_flatten",
    lambda spark, sf_dir: flatten.row_text(table(spark, sf_dir, "customer"), keep=("c_custkey",)),
    "SELECT c_custkey, text FROM (SELECT c_custkey, concat_ws(' ', nullif(trim(c_name), ''), nullif(trim(c_mktsegment), '')) AS text FROM customer) WHERE text <> ''",
)
query(
    "manifest_counts",
    lambda spark, sf_dir: files.manifest("parquet", table(spark, sf_dir, "documents").select(F.col("source").alias("file"), "text", F.lit(None).cast("string").alias("error"))).drop("ts", "counts"),
    "SELECT 'parquet' AS processor, source AS file, CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS n_chars, CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS n_bytes, CAST(count(text) AS INTEGER) AS n_units, CAST(NULL AS VARCHAR) AS error FROM documents GROUP BY source",
)
query(
    "row_text_parity",
    lambda spark, sf_dir: flatten.row_text(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.to_date("o_orderdate").alias("day"), (F.col("o_totalprice") > 2e5).alias("dear"), "o_orderpriority"), parity=True, keep=("o_orderkey",)),
    "SELECT o_orderkey, concat_ws(' ', nullif(trim(o_orderstatus), ''), CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CASE WHEN o_totalprice > 200000 THEN 'True' ELSE 'False' END, nullif(trim(o_orderpriority), '')) AS text FROM orders WHERE o_orderkey IS NOT NULL",
)
query(
    "array_text_flatten",
    lambda spark, sf_dir: flatten.row_text(documents(spark, sf_dir).select("doc_id", F.split("text", "\n", -1).alias("lines")), keep=("doc_id",)),
    r"SELECT doc_id, v AS text FROM (SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> ''), ' ') AS v FROM documents) WHERE v <> ''",
)
query(
    "union_sources",
    lambda spark, sf_dir: documents(spark, sf_dir)
    .select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    .unionByName(table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("origin"), F.col("item_id").alias("id"), "text"))
    .unionByName(table(spark, sf_dir, "pages").select(F.lit("pages").alias("origin"), F.col("page_id").alias("id"), F.col("html").alias("text"))),
    "SELECT 'documents' AS origin, doc_id AS id, text FROM documents UNION ALL SELECT 'benchmark', item_id, text FROM benchmark UNION ALL SELECT 'pages', page_id, html FROM pages",
)
_SIZE_SQL = "CASE " + " ".join(f"WHEN b < {1024 ** (n + 1)} THEN printf('%.1f {u}', b / {1024**n}.0)" for n, u in enumerate(("B", "KB", "MB", "GB"))) + f" ELSE printf('%.1f TB', b / {1024**4}.0) END"
query(
    "format_file_size",
    lambda spark, sf_dir: table(spark, sf_dir, "orders").select("o_orderkey", scalar.format_file_size(F.col("o_orderkey") * F.col("o_orderkey") * F.pmod("o_orderkey", F.lit(977))).alias("value")),
    f"SELECT o_orderkey, {_SIZE_SQL} AS value FROM (SELECT o_orderkey, CAST(o_orderkey * o_orderkey * (o_orderkey % 977) AS DOUBLE) AS b FROM orders)",
)
query(
    "format_duration",
    lambda spark, sf_dir: table(spark, sf_dir, "orders").select("o_orderkey", scalar.format_duration(F.col("o_orderkey") / 4).alias("value")),
    "SELECT o_orderkey, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%dm %ds', CAST(floor(floor(s) / 60) AS BIGINT), CAST(floor(s) AS BIGINT) % 60) ELSE printf('%dh %dm', CAST(floor(s / 3600) AS BIGINT), CAST(floor((CAST(floor(s) AS BIGINT) % 3600) / 60) AS BIGINT)) END AS value FROM (SELECT o_orderkey, o_orderkey / 4.0 AS s FROM orders)",
)
query(
    "timestamps",
    lambda spark, sf_dir: table(spark, sf_dir, "events").select("event_id", scalar.timestamp_text(F.col("ts")).alias("stamp"), scalar.timestamp_folder(F.col("ts")).alias("folder")),
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS stamp, strftime(ts, '%d-%m-%y-%H-%M-%S') AS folder FROM events",
)

# whole pipelines


def clean_pipeline(spark, sf_dir) -> DataFrame:
    cleaned = pipeline.clean(cyrillic(spark, sf_dir))
    return cleaned.select("doc_id", F.col("text").alias("clean_text"), F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", " "))).cast("long").alias("n_words"))


def run_counters(spark, sf_dir) -> DataFrame:
    """What cleaning removes and keeps, counted in the pass that writes the cleaned documents."""
    rows, seen = pipeline.observed(pipeline.clean_counted(cyrillic(spark, sf_dir), None, DEFAULT.with_(word_healer_enabled=False)))
    rows.write.parquet(scratch_path(spark, "run-counters"))
    return spark.createDataFrame(list(seen.get.items()), "counter string, n long")


def ordered_text(spark, sf_dir) -> DataFrame:
    """All documents in one text file, in the order of their ids, and its lines read back in splits."""
    path = f"{scratch_path(spark, 'ordered-text')}.txt"
    textfiles.write_text_file(documents(spark, sf_dir), path, ["doc_id"])
    return textfiles.with_offsets(textfiles.read_pieces(spark, path)).select("start", "text")


def stream_clean(spark, sf_dir) -> DataFrame:
    """The documents as a stream of files, cleaned into the shared folder."""
    ship(spark)
    out = scratch_path(spark, "stream-clean")
    arriving = streaming.read_stream(spark, f"{sf_dir}/documents.parque[t]").withColumn("text", F.translate(F.lower("text"), LATIN, TO_CYRILLIC))
    streaming.clean_stream(arriving, f"{out}/texts", f"{out}/checkpoint").awaitTermination()
    return spark.read.schema(streaming.DOCUMENTS).parquet(f"{out}/texts")


#: Tables whose texts arrive: name, column, schema.
ARRIVING = (("documents", "text", "text string"), ("benchmark", "text", "text string"))


def base_forms(spark, sf_dir) -> DataFrame:
    """Words of the benchmark's passages as base forms of two languages, those of every third passage of both."""
    text = F.translate(F.lower("text"), LATIN, TO_CYRILLIC)
    languages = F.when(F.col("item_id") % 3 == 0, F.array(F.lit("ru"), F.lit("sah"))).when(F.col("item_id") % 3 == 1, F.array(F.lit("ru"))).otherwise(F.array(F.lit("sah")))
    return table(spark, sf_dir, "benchmark").select(F.explode(tokens.joined_tokens(text)).alias("base"), languages.alias("l")).select("base", F.explode("l").alias("language")).distinct()


def dictionary_words(spark, sf_dir) -> DataFrame:
    """The step of the cascade that decides each distinct word of the documents, with a dictionary for what no rule decides."""
    return pipeline.decided_words(materialize(distinct_words(cyrillic, spark, sf_dir), "dictionary-words"), dictionary=base_forms(spark, sf_dir))


def clean_with_dictionary(spark, sf_dir) -> DataFrame:
    return pipeline.clean_with_rules(cyrillic(spark, sf_dir), None, DEFAULT.with_(word_healer_enabled=False), dictionary=base_forms(spark, sf_dir))


def stream_unique_texts(spark, sf_dir) -> DataFrame:
    """The documents and benchmark passages as streams of files, of which a text that came before is dropped."""
    out = scratch_path(spark, "stream-unique")
    arriving = [streaming.read_stream(spark, f"{sf_dir}/{name}.parque[t]", schema).select(F.col(column).alias("text")) for name, column, schema in ARRIVING]
    both = arriving[0].unionAll(arriving[1]).where("text is not null")
    digested = both.select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), F.length("text").cast("long").alias("n_chars"), F.current_timestamp().alias("arrived"))
    unique = streaming.first_arrivals(digested).select("digest", "n_chars")
    unique.writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{out}/texts").awaitTermination()
    return spark.read.schema("digest string, n_chars long").parquet(f"{out}/texts")


def _valid_sql(text: str) -> str:
    return f"array_to_string(list_filter(regexp_extract_all({_spaced_sql(text)[1]}, {_DOT}), lambda w: {_ALL_RULES}), ' ')"


_CLEAN_SQL = f"array_to_string(list_transform(list_filter(regexp_extract_all({_valid_sql("coalesce(t, '')")}, {_JOINED}), lambda word: NOT {_RUSSIAN_SQL}), lambda word: regexp_replace(word, '[–_' || chr(10) || ']+', ' ', 'g')), ' ')"
_HEALED = healing_sql.healed("base", PASSES, look_alikes=False)
query("clean_pipeline", clean_pipeline, f"SELECT doc_id, clean_text, CASE WHEN clean_text = '' THEN 0 ELSE len(string_split(clean_text, ' ')) END::BIGINT AS n_words FROM ({_over_documents(_UNHEALED_SQL, _HEALED, _CLEAN_SQL, 'clean_text')})")
query("stream_clean", stream_clean, _over_documents(_UNHEALED_SQL, _HEALED, _CLEAN_SQL, "text"))
query("clean_with_rules_healed", lambda spark, sf_dir: pipeline.clean_with_rules(cyrillic(spark, sf_dir), rule_words(spark, sf_dir)), _with_rules_sql(_over_documents(_UNHEALED_SQL, _HEALED, _valid_sql("coalesce(t, '')"))))
query("undecided_words", lambda spark, sf_dir: pipeline.undecided_words(cyrillic(spark, sf_dir)), f"SELECT word FROM {_WORDS_SQL} WHERE ({_RULE_CASE}) = 'undecided'")
_COUNTED_SQL = f"""WITH base AS (SELECT {_UNHEALED_SQL} AS t FROM documents),
counted AS (
  SELECT 'spaced_letters' AS counter, CAST(coalesce(sum({_spaced_sql('t')[0]}), 0) AS BIGINT) AS n FROM base
  UNION ALL SELECT reason, count(*) FROM (SELECT {_REASON} AS reason FROM (SELECT unnest(regexp_extract_all({_spaced_sql('t')[1]}, {_DOT})) AS w FROM base)) WHERE reason IS NOT NULL GROUP BY reason
  UNION ALL SELECT CASE WHEN {_RUSSIAN_SQL} THEN 'removed' ELSE 'kept' END, count(*) FROM (SELECT unnest(regexp_extract_all({_valid_sql('t')}, {_JOINED})) AS word FROM base) GROUP BY 1)
SELECT c.counter, coalesce(n, 0) AS n FROM (SELECT unnest({list(pipeline.COUNTERS)}) AS counter) c LEFT JOIN counted ON c.counter = counted.counter"""
query("run_counters", run_counters, _COUNTED_SQL)
query(
    "ordered_text",
    ordered_text,
    """SELECT CAST(coalesce(sum(strlen(text) + 1) OVER (ORDER BY doc_id, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start, text
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)""",
)
query("stream_unique_texts", stream_unique_texts, "SELECT DISTINCT sha256(text) AS digest, length(text) AS n_chars FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark) WHERE text IS NOT NULL")


def _paradigm_sql(word: str, endings: tuple[str, ...]) -> str:
    cuts = ", ".join(f"CASE WHEN lower({word}) LIKE '%{e}' AND length({word}) - {len(e)} >= {rules.MIN_STEM} THEN substr(lower({word}), 1, length({word}) - {len(e)}) END" for e in endings)
    return f"list_filter(list_distinct([lower({word}), {cuts}]), lambda s: s IS NOT NULL)"


def _dictionary_sql(words: str) -> str:
    """CTEs up to ``decided`` (word, rule) for the distinct words of a CTE or table."""
    language = "CASE item_id % 3 WHEN 0 THEN ['ru', 'sah'] WHEN 1 THEN ['ru'] ELSE ['sah'] END"
    stems = lambda word: f"CASE language WHEN 'ru' THEN {_paradigm_sql(word, dictionary.PARADIGMS['ru'])} ELSE {_paradigm_sql(word, dictionary.PARADIGMS['sah'])} END"
    return f"""bases AS (SELECT DISTINCT base, unnest(l) AS language FROM (SELECT unnest(regexp_extract_all({SQL_CYRILLIC}, {_JOINED})) AS base, {language} AS l FROM benchmark)),
known AS (SELECT language, stem, bool_or(stem = lower(base)) AS is_base FROM (SELECT base, language, unnest({stems('base')}) AS stem FROM bases) GROUP BY language, stem),
ruled AS (SELECT word, {_RULE_CASE} AS rule FROM {words}),
keys AS (SELECT word, language, unnest({stems('word')}) AS stem FROM (SELECT word, unnest(['ru', 'sah']) AS language FROM ruled WHERE rule = 'undecided')),
nearest AS (SELECT word, arg_min(k.language, CASE WHEN k.stem = lower(word) AND is_base THEN 0 ELSE 2 END + CASE WHEN k.language = 'ru' THEN 1 ELSE 0 END) AS language FROM keys k JOIN known n ON k.language = n.language AND k.stem = n.stem GROUP BY word),
decided AS (SELECT r.word, CASE WHEN language = 'ru' THEN 'dictionary' WHEN language IS NOT NULL THEN 'dictionary_other' ELSE rule END AS rule FROM ruled r LEFT JOIN nearest n ON r.word = n.word)"""


query("dictionary_words", dictionary_words, f"WITH {_dictionary_sql(_WORDS_SQL)} SELECT word, rule FROM decided")
query(
    "clean_with_dictionary",
    clean_with_dictionary,
    f"""WITH t AS (SELECT doc_id, regexp_extract_all({_VALID_SQL}, {_JOINED}) AS ws FROM documents),
k AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM t),
w AS (SELECT DISTINCT word FROM k),
{_dictionary_sql('w')}
SELECT d.doc_id, coalesce(s.text, '') AS text FROM documents d LEFT JOIN (SELECT doc_id, string_agg(regexp_replace(k.word, '[–_' || chr(10) || ']+', ' ', 'g'), ' ' ORDER BY pos) AS text FROM k JOIN decided e ON k.word = e.word WHERE rule NOT IN ('marker', 'russian_ending', 'dictionary') GROUP BY doc_id) s ON d.doc_id = s.doc_id""",
)
