"""Healing as relational SQL, for comparison with the queries that heal: texts become rows of characters or words.

Every function takes the name of a table (doc_id, t) and returns common table expressions and the name of the last one,
which is such a table again. The engine that runs them has no look-around, so context comes from window functions.
"""

from __future__ import annotations

from lexloom.constants import ANCHORS, BLOCK_MARKER, CYRILLIC, LOOK_ALIKES, MAX_CONSONANTS, MAX_WORD_LENGTH, MERGE_LENGTH, VOWELS

LETTERS = "абвгдежзийклмнопрстуфхцчшщъыьэюяё" + ANCHORS
CONSONANTS = "".join(c for c in LETTERS if c not in VOWELS)
WHITE = r"[\x09-\x0d\x1c-\x20\x85\p{Z}]"
_BOTH = CYRILLIC + "А-ЯЁ" + ANCHORS.upper()
_MARK = "\ue000" * len(BLOCK_MARKER)  # a private character; stands for the marker while characters are looked at, being as long

Steps = tuple[list[str], str]


def repaired(source: str, passes: int) -> Steps:
    """Pairs of word parts joined from left to right, in so many passes.

    Words with nothing but white space between them are a run; a run's words are looked at two by two, whether they join
    or not.
    """
    steps = []
    for n in range(passes):
        name = f"{source}_pass{n}"
        fits = f"(length(before) = 1 OR length(s) = 1 OR length(before) + length(s) <= {MERGE_LENGTH}) AND NOT contains(gap, chr(10)) AND NOT contains(gap, '  ')"
        valid = f"(length(before) + length(s) <= {MAX_WORD_LENGTH} OR regexp_matches(before || s, '[{ANCHORS}]')) AND NOT regexp_matches(before || s, '[{CONSONANTS}{CONSONANTS.upper()}]{{{MAX_CONSONANTS}}}')"
        steps.append(f"""{name} AS (
  SELECT doc_id, string_agg(CASE WHEN joins_next THEN '' ELSE s END, '' ORDER BY i) AS t FROM (
    SELECT doc_id, i, s, coalesce(lead(joins) OVER (PARTITION BY doc_id ORDER BY i), false) AS joins_next FROM (
      SELECT doc_id, i, s, word AND nth % 2 = 0 AND {fits} AND {valid} AS joins FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id, run, word ORDER BY i) AS nth, lag(s, 1) OVER (PARTITION BY doc_id ORDER BY i) AS gap, lag(s, 2) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM (
          SELECT *, regexp_matches(s, '^[{_BOTH}]') AS word, sum(CASE WHEN regexp_matches(s, '^(?:[{_BOTH}]|{WHITE}+$)') THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
            SELECT doc_id, unnest(x) AS s, generate_subscripts(x, 1) AS i FROM (SELECT doc_id, regexp_extract_all(t, '[{_BOTH}]+|[^{_BOTH}]+') AS x FROM {source}))))))
  GROUP BY doc_id)""")
        source = name
    return steps, source


def normalized(source: str) -> Steps:
    """Look-alike characters near Cyrillic ones replaced, a pass for each entry of the table.

    White space is no distance. A replaced character is context for those after it in the same pass: characters that reach
    each other form an island, in which all from the first with context of its own on are replaced.
    """
    first = f"{source}_chars"
    near = " OR ".join(f"coalesce(regexp_matches({f}(c, {k}) OVER o, '[0-9]'), false)" for f in ("lag", "lead") for k in (1, 2))
    steps = [
        f"""{first}_all AS (SELECT doc_id, unnest(x) AS c, generate_subscripts(x, 1) AS pos FROM (SELECT doc_id, regexp_extract_all(replace(t, '{BLOCK_MARKER}', '{_MARK}'), '(?s).') AS x FROM {source}))""",
        f"""{first} AS (
  SELECT *, CASE WHEN regexp_matches(c, '[{_BOTH}]') THEN 'c' WHEN contains('.,;:!?', c) THEN 's' ELSE 'o' END AS kind, c IN ('6', '8') AND (coalesce(after IN ('-', '.'), false) OR {near}) AS fixed
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS v FROM (SELECT *, lead(c) OVER (PARTITION BY doc_id ORDER BY pos) AS after FROM {first}_all) WHERE NOT regexp_matches(c, '{WHITE}'))
  WINDOW o AS (PARTITION BY doc_id ORDER BY v))""",
    ]
    table = first

    def sees(function: str) -> str:
        cases = " ".join(f"WHEN {function}(kind, {k}) OVER o <> 'o' THEN {function}(kind, {k}) OVER o = 'c'" for k in range(1, 6))
        return f"(CASE {cases} ELSE false END)"

    for n, (wrong, right) in enumerate(LOOK_ALIKES):
        name = f"{first}_{n}"
        steps.append(f"""{name}_own AS (
  SELECT doc_id, v, {sees('lag')} OR {sees('lead')} AS own, c = '{wrong}' AND NOT fixed AS wanted, sum(CASE WHEN kind = 's' THEN 1 ELSE 0 END) OVER o AS stops FROM {table} WINDOW o AS (PARTITION BY doc_id ORDER BY v))""")
        steps.append(f"""{name}_hit AS (
  SELECT doc_id, v FROM (
    SELECT doc_id, v, max(own) OVER (PARTITION BY doc_id, island ORDER BY v) AS hit FROM (
      SELECT *, sum(CASE WHEN reached THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY v) AS island FROM (
        SELECT *, coalesce(v - lag(v) OVER w <= 5 AND stops = lag(stops) OVER w, false) AS reached FROM {name}_own WHERE wanted WINDOW w AS (PARTITION BY doc_id ORDER BY v))))
  WHERE hit)""")
        steps.append(f"""{name} AS (
  SELECT a.doc_id, a.pos, a.v, a.fixed, CASE WHEN h.v IS NULL THEN a.c ELSE '{right}' END AS c, CASE WHEN h.v IS NULL THEN a.kind ELSE 'c' END AS kind
  FROM {table} a LEFT JOIN {name}_hit h ON a.doc_id = h.doc_id AND a.v = h.v)""")
        table = name
    last = f"{source}_normal"
    steps.append(f"""{last} AS (
  SELECT a.doc_id, replace(string_agg(coalesce(b.c, a.c), '' ORDER BY a.pos), '{_MARK}', '{BLOCK_MARKER}') AS t
  FROM {first}_all a LEFT JOIN {table} b ON a.doc_id = b.doc_id AND a.pos = b.pos GROUP BY a.doc_id)""")
    return steps, last


def guarded(source: str) -> Steps:
    name = f"{source}_guarded"
    return [f"{name} AS (SELECT doc_id, regexp_replace(t, '{WHITE}{{2,}}', ' {BLOCK_MARKER} ', 'g') AS t FROM {source})"], name


def squeezed(source: str) -> Steps:
    """Without markers, white space squeezed. Line-end hyphens between Cyrillic words, which the tables lack, are not joined."""
    name = f"{source}_squeezed"
    return [f"{name} AS (SELECT doc_id, trim(regexp_replace(replace(t, '{BLOCK_MARKER}', ''), '{WHITE}+', ' ', 'g'), ' ') AS t FROM {source})"], name


def healed(source: str, passes: int, look_alikes: bool = True) -> Steps:
    """The whole healing; texts of nothing but letters, hyphens and white space have no look-alikes to replace."""
    every: list[str] = []
    for step in (guarded, *((normalized,) if look_alikes else ()), lambda s: repaired(s, passes), squeezed):
        more, source = step(source)
        every += more
    return every, source
