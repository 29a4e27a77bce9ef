"""Secret scans with a trigram inverted index, with DataFrame operations only.

Each rule's regular expression is turned into a Boolean query over lower-cased trigrams: any match needs all
trigrams of at least one conjunction. The index holds postings (trigram, document) of the trigrams that some query
names; intersecting them gives each rule's candidates, which the full expression then verifies. A rule whose
expression has no mandatory trigram (runs of hexadecimal digits) scans every document.

One pass over the texts writes the index's entries, the spans of rules that scan all, and the texts whose own entries
satisfy some query: only those travel to what the index returns for them.

Matches are leftmost and non-overlapping for each rule; spans count code points, with exclusive ends.

Cases: a null text counts as empty; the candidates of equal ids are the union of theirs and each row is verified by
itself, so repeated ids and rows are right; null ids are matched null-safe, so candidate rows without an id all meet under one join
key; a text without secrets has counts 0 and
an empty span string; a text of any length is scanned whole; an empty table gives an empty table; other columns are not
read. Spans of one document and rule are gathered in that document's row.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.sources.scratch import materialize


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0  # whose length counts
    least: int = 1  # code points that it has at least
    base: bool = False


#: The base rules, in their order, then the rules that this operator adds. Runs of a class are maximal, so a minimal
#: length can stand in the pattern where every shorter match fails by itself.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("hubtoken", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

_MANY = 256  # ways through an expression beyond which its parts count as anything


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The conjunctions of trigrams one of which every match has; None if a match may lack them all."""
    found = {frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2)) for runs in _ways(pattern)}
    return None if frozenset() in found else sorted((f for f in found if not any(o < f for o in found)), key=sorted)


def _ways(pattern: str) -> set[frozenset[str]]:
    """For every way through an expression, the runs of at least three literals on it, in lower case."""
    return {runs | _kept(run) for run, runs in _walk(rp.parse(pattern), [("", frozenset())])}


def _kept(run: str) -> frozenset[str]:
    return frozenset([run] if len(run) > 2 else [])


def _broken(ways):
    return list({("", runs | _kept(run)) for run, runs in ways})


def _walk(items, ways):
    """ways: (the literal run so far, the runs before it), for every way through what came before."""
    for op, arg in items:
        if op is rc.LITERAL:
            ways = [(run + chr(arg).lower(), runs) for run, runs in ways]
        elif op is rc.SUBPATTERN:
            ways = _walk(arg[3], ways)
        elif op is rc.BRANCH:
            forked = [w for branch in arg[1] for w in _walk(branch, ways)]
            ways = forked if len(forked) <= _MANY else _broken(ways)
        elif op is rc.IN and all(k is rc.LITERAL for k, _ in arg) and len(ways) * len(arg) <= _MANY:
            ways = [(run + chr(c).lower(), runs) for run, runs in ways for _, c in arg]
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[:2] == (0, 1) and len(arg[2]) == 1 and arg[2][0][0] is rc.LITERAL:
            ways = [*ways, *_walk(arg[2], ways)]
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] >= 1:
            ways = _broken(_walk(arg[2], ways))
        elif op is not rc.AT:
            ways = _broken(ways)
    return ways


def _clauses(rules: tuple[Rule, ...]) -> list[tuple[str, frozenset[str]]]:
    """(kind, conjunction of trigrams) of all indexable rules."""
    return [(r.kind, clause) for r in rules for clause in trigram_query(r.pattern) or []]


def held_trigrams(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Which of the trigrams that some rule's query names a text holds: its entries in the index."""
    low = F.lower(text)
    wanted = sorted({gram for _, clause in _clauses(rules) for gram in clause})
    # array_except drops the nulls in generated code, which computes the lower-cased text once for all trigrams
    return F.array_except(F.array(*(F.when(F.contains(low, F.lit(g)), F.lit(g)) for g in wanted)).cast("array<string>"), F.array(F.lit(None).cast("string")))


def candidates(indexed: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, grams) -> (doc_id, kinds): the rules whose trigram query the document's postings satisfy."""
    needed = [(kind, f"{kind}-{n}", gram, 1 << bit, (1 << len(clause)) - 1) for n, (kind, clause) in enumerate(_clauses(rules)) for bit, gram in enumerate(sorted(clause))]
    # one row per trigram of a rule, so this side may be broadcast
    needs = F.broadcast(indexed.sparkSession.createDataFrame(needed, "kind string, clause string, gram string, bit long, every long"))
    postings = indexed.select("doc_id", F.explode("grams").alias("gram"))
    met = postings.join(needs, "gram").groupBy("doc_id", "kind", "clause").agg((F.bit_or("bit") == F.first("every")).alias("all"))
    return met.where("all").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


_SPANS = "array<struct<start:int,rule:int,end:int>>"
_AT_ONCE = 256  # spans gathered before they are added to the document's, which copies those


def _spans(rule: Rule, number: int) -> str:
    """From the columns m_ (matches), v_ (the measured groups) and g_ (what stands between): the document's spans."""
    m, v, g = f"m_{rule.kind}", f"{'v' if rule.group else 'm'}_{rule.kind}", f"g_{rule.kind}"
    start = f"a.at + length({g}[i])"
    return f"""
        if(size({m}) > 0,
          aggregate(sequence(0, (size({m}) - 1) div {_AT_ONCE}), named_struct('at', 0, 'spans', cast(array() as {_SPANS})), (acc, c) ->
            aggregate(sequence(cast(c * {_AT_ONCE} as int), cast(least(size({m}) - 1, c * {_AT_ONCE} + {_AT_ONCE - 1}) as int)), named_struct('at', acc.at, 'spans', cast(array() as {_SPANS})), (a, i) ->
              named_struct('at', {start} + length({m}[i]), 'spans',
                if(length({v}[i]) >= {rule.least}, concat(a.spans, array(named_struct('start', {start}, 'rule', {number}, 'end', {start} + length({m}[i])))), a.spans)),
              a -> named_struct('at', a.at, 'spans', concat(acc.spans, a.spans))),
            acc -> acc.spans),
          cast(array() as {_SPANS}))"""


def _located(rows: DataFrame, keep: list[str], rules: list[tuple[int, Rule]], guarded: bool) -> DataFrame:
    """keep... and a column of spans for each rule, found in ``body``; if ``guarded``, only for the rules named in ``kinds``."""
    matches, gaps = {}, {}
    for _, rule in rules:
        wanted = {f"{c}_{rule.kind}": F.regexp_extract_all("body", F.lit(rule.pattern), F.lit(group)) for c, group in (("m", 0), ("v", rule.group)) if c == "m" or group}
        matches |= {name: F.when(F.array_contains("kinds", rule.kind), column) if guarded else column for name, column in wanted.items()}
        gaps[f"g_{rule.kind}"] = F.when(F.size(f"m_{rule.kind}") > 0, F.split("body", rule.pattern, -1))
    found = rows.select(*dict.fromkeys([*keep, "body"]), *(c.alias(n) for n, c in matches.items()))
    found = found.select(*dict.fromkeys([*keep, "body"]), *matches, *(c.alias(n) for n, c in gaps.items()))
    return found.select(*keep, *(F.expr(_spans(rule, number)).alias(rule.kind) for number, rule in rules))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_<kind> for each rule, and ``found``: the spans of all rules as sorted (start, rule's number, end)."""
    numbered = list(enumerate(rules))
    everywhere = [(n, r) for n, r in numbered if trigram_query(r.pattern) is None]
    by_index = [(n, r) for n, r in numbered if trigram_query(r.pattern) is not None]
    full = [r.kind for _, r in everywhere]
    # the one pass over all texts: index entries, spans of the rules that scan all, and the texts that a query can return
    plain = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    scanned = _located(plain.withColumn("grams", held_trigrams(F.col("body"), rules)), ["doc_id", "body", "grams"], everywhere, False)
    possible = F.lit(False)
    for clause in sorted({c for _, c in _clauses(rules)}, key=sorted):
        possible = possible | (F.size(F.array_intersect("grams", F.array(*map(F.lit, sorted(clause))))) == len(clause))
    index = materialize(scanned.withColumn("body", F.when(possible, F.col("body"))), "secrets")
    met = candidates(index, rules).withColumnRenamed("doc_id", "_cid")
    joined = index.where("body is not null").join(met, F.col("doc_id").eqNullSafe(F.col("_cid")), "left")
    verified = _located(joined, ["doc_id", *full], by_index, True)
    rest = index.where("body is null").select("doc_id", *full, *(F.expr(f"cast(array() as {_SPANS})").alias(r.kind) for _, r in by_index))
    located = verified.unionByName(rest)
    return located.select("doc_id", *(F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in rules), F.array_sort(F.concat(*(r.kind for r in rules))).alias("found"))


def span_text(found: Column, rules: tuple[Rule, ...]) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _oracle() -> str:
    """SQL that scans every text with every rule; spans come from the lengths of matches and of what stands between."""

    def spans(number: int, rule: Rule) -> str:
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        start = "list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
        found = f"list_transform(list_filter(range(1, len(m) + 1), lambda i: length(v[i]) >= {rule.least}), lambda i: {{'s': CAST({start} AS BIGINT), 'k': {number}, 'e': CAST({start} + length(m[i]) AS BIGINT)}})"
        return f"SELECT doc_id, {number} AS k, {found} AS spans FROM (SELECT doc_id, regexp_extract_all(t, {pattern}) AS m, regexp_extract_all(t, {pattern}, {rule.group}) AS v, regexp_split_to_array(t, {pattern}) AS g FROM texts)"

    kinds = "[" + ", ".join(f"'{r.kind}'" for r in RULES) + "]"
    text = f"array_to_string(list_transform(list_sort({{}}), lambda x: {kinds}[x.k + 1] || ':' || x.s || ':' || x.e), ',')"
    base = sum(r.base for r in RULES)
    count = ", ".join(f"len(list_filter(every, lambda x: x.k = {n})) AS n_{r.kind}" for n, r in enumerate(RULES) if r.base)
    return f"""WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(spans(n, r) for n, r in enumerate(RULES))}),
gathered AS (SELECT doc_id, flatten(list(spans)) AS every FROM found GROUP BY doc_id)
SELECT doc_id, {count}, sha256({text.format(f'list_filter(every, lambda x: x.k < {base})')}) AS base_sha256, {text.format('every')} AS spans FROM gathered"""


def op6_secrets(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    got = find_secrets(table(spark, sf_dir, "documents"))
    n_base = sum(r.base for r in RULES)
    return got.select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(span_text(F.filter("found", lambda s: s["rule"] < n_base), RULES).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("found"), RULES).alias("spans"),
    )


ORACLE = _oracle()
