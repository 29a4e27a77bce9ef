"""Repair of OCR damage. Context-dependent rewriting runs in Arrow batches; ``native_repair`` is its pure-SQL form.

The five regular-expression passes of ``native_repair`` took nine times as long as the batch function (see the README), so
the batch function is the default.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexloom.config import DEFAULT, Config
from lexloom.constants import ANCHORS, BLOCK_MARKER, CYRILLIC, LOOK_ALIKES, MAX_CONSONANTS, MAX_WORD_LENGTH, MERGE_LENGTH, OLD_MARKER, VOWELS
from lexloom.functions import text as T

_NUMBER = re.compile(r"\d+[\s\-.]?\d*")
_MARKERS = re.compile("|".join(map(re.escape, (BLOCK_MARKER, OLD_MARKER))))
_REACH = 5  # visible characters within which a Cyrillic letter counts, with no punctuation up to it
_WORDS = re.compile(rf"([{CYRILLIC}]+)", re.I)
_PARTS, _STAYS, _VANISHES = 0, 1, 2
_CLUSTER = re.compile(rf"(?:(?![{VOWELS}])[{CYRILLIC}]){{{MAX_CONSONANTS}}}", re.I)
_ANCHOR = re.compile(f"[{ANCHORS}]")
_WIDE = re.compile(r"\s{2,}")
_SPLIT_HYPHEN = re.compile(r"(\w+)-\n+(\w+)")
_LETTER = re.compile(f"[{CYRILLIC}]", re.I)
_AFFECTED = re.compile("[" + "".join(a for a, _ in LOOK_ALIKES) + "]")
_OTHER, _CYRILLIC, _STOP = 0, 1, 2
_KINDS = {c: _CYRILLIC for c in range(0x10000) if _LETTER.match(chr(c))} | {ord(c): _STOP for c in ".,;:!?"}
_VISIBLE = re.compile(r"\S+")


def _visible(text: str, places: range, count: int) -> list[str]:
    """The first ``count`` characters at these places that are no white space."""
    out = []
    for i in places:
        if not text[i].isspace():
            out.append(text[i])
            if len(out) == count:
                break
    return out


def _number_guarded(text: str, match: re.Match) -> bool:
    """Whether a number's characters must stay: all but a lone 6 or 8 without digits nearby."""
    found, at = match.group(), match.start()
    if sum(map(str.isdigit, found)) > 1 or "-" in found or "." in found or found[0] not in "68":
        return True
    near = _visible(text, range(at - 1, -1, -1), 2) + _visible(text, range(at + 1, len(text)), 2)
    return any(map(str.isdigit, near))


def _near_cyrillic(kinds: bytearray, at: int) -> bool:
    for side in (range(at - 1, max(-1, at - 1 - _REACH), -1), range(at + 1, min(len(kinds), at + 1 + _REACH))):
        for i in side:
            if kinds[i] != _OTHER:
                if kinds[i] == _CYRILLIC:
                    return True
                break
    return False


def normalize(text: str) -> str:
    """Replace look-alike characters next to Cyrillic ones, in the table's order and from left to right.

    White space does not count as distance, so the work is on the visible characters alone, and of those only look-alikes
    are visited; a replaced character is Cyrillic context for those after it.
    """
    if not (_AFFECTED.search(text) and _LETTER.search(text)):
        return text
    spans = [m.span() for m in _VISIBLE.finditer(text)]
    before = [0, *accumulate(b - a for a, b in spans)]  # visible characters before each span
    seen = "".join([text[a:b] for a, b in spans])
    fixed = [m.span() for m in _MARKERS.finditer(text)]
    if "6" in seen or "8" in seen:
        fixed = sorted(fixed + [m.span() for m in _NUMBER.finditer(text) if _number_guarded(text, m)])
    fixed_starts = [a for a, _ in fixed]

    def place(at: int) -> int:
        span = bisect_right(before, at) - 1
        return spans[span][0] + at - before[span]

    def free(at: int) -> bool:
        i = bisect_right(fixed_starts, place(at)) - 1
        return i < 0 or place(at) >= fixed[i][1]

    kinds = bytearray([_KINDS.get(ord(c), _OTHER) for c in seen])
    found: dict[str, list[int]] = {}
    for m in _AFFECTED.finditer(seen):
        found.setdefault(m[0], []).append(m.start())
    changed = {}
    for wrong, right in LOOK_ALIKES:
        for at in found.get(wrong, ()):
            if _near_cyrillic(kinds, at) and (not fixed or free(at)):
                kinds[at] = _CYRILLIC
                changed[at] = right
    if not changed:
        return text
    out = list(text)
    for at, right in changed.items():
        out[place(at)] = right
    return "".join(out)


def _joins(left: str, right: str) -> bool:
    n = len(left) + len(right)
    if n > MERGE_LENGTH and len(left) > 1 and len(right) > 1:
        return False
    if n < MAX_CONSONANTS:
        return True
    joined = left + right
    return not _CLUSTER.search(joined) and (n <= MAX_WORD_LENGTH or _ANCHOR.search(joined) is not None)


class _Gaps(dict):
    """What stands between two words -> whether it parts them, keeps a pair apart, or may vanish."""

    def __missing__(self, gap: str) -> int:
        found = self[gap] = _PARTS if not gap.isspace() else _STAYS if "\n" in gap or "  " in gap else _VANISHES
        return found


def _repair_block(block: str, passes: int) -> str:
    """A pass looks at two neighbouring words at a time, and goes on behind them whether they join or not."""
    head, *rest = _WORDS.split(block)
    words, gaps = rest[::2], rest[1::2]
    of = _Gaps()
    kinds = [of[g] for g in gaps]
    for _ in range(passes):
        count = len(words)
        if count < 2:
            break
        kinds[-1] = _PARTS
        new_words, new_gaps, new_kinds = [], [], []
        i = 0
        while i < count:
            kind = kinds[i]
            if kind == _VANISHES and _joins(words[i], words[i + 1]):
                new_words.append(words[i] + words[i + 1])
                i += 1
            else:
                new_words.append(words[i])
                if kind != _PARTS:
                    new_gaps.append(gaps[i])
                    new_kinds.append(kind)
                    i += 1
                    new_words.append(words[i])
            new_gaps.append(gaps[i])
            new_kinds.append(kinds[i])
            i += 1
        words, gaps, kinds = new_words, new_gaps, new_kinds
        if len(words) == count:
            break
    rest = [""] * (2 * len(words))
    rest[::2], rest[1::2] = words, gaps
    return head + "".join(rest)


def repair(text: str, passes: int) -> str:
    """Join pairs of word parts, left to right, in up to ``passes`` passes per block."""
    return BLOCK_MARKER.join([_repair_block(block, passes) for block in text.split(BLOCK_MARKER)])


def join_hyphens(text: str) -> str:
    return _SPLIT_HYPHEN.sub(lambda m: m[1] + m[2] if _LETTER.search(m[1]) and _LETTER.search(m[2]) else m[0], text)


def heal(text: str, passes: int) -> str:
    """Guard word boundaries, normalize, repair, join hyphens, and squeeze white space."""
    guarded = _WIDE.sub(f" {BLOCK_MARKER} ", text)
    whole = join_hyphens(repair(normalize(guarded), passes))
    return " ".join(_MARKERS.sub("", whole).split())


AT_ONCE = 64  # texts that stand as Python strings at a time


def _batch(function):
    """A string function over Arrow batches; nulls stay null, equal texts of a batch are done once.

    A batch may hold many long texts, so few of them are Python strings at a time.
    """

    @F.arrow_udf(StringType())
    def run(column: pa.Array) -> pa.Array:
        coded = column.dictionary_encode()
        texts, indices = coded.dictionary, coded.indices
        parts = [pa.array([function(t) for t in texts.slice(at, AT_ONCE).to_pylist()], pa.string()) for at in range(0, len(texts), AT_ONCE)]
        done = pa.concat_arrays(parts) if parts else pa.array([], pa.string())
        in_order = len(texts) == len(column)  # no nulls and no equal texts
        del coded, texts, parts
        out = done if in_order else done.take(indices)
        pa.default_memory_pool().release_unused()
        return out

    return run


def smart_normalize(text: Column) -> Column:
    """Texts without a look-alike, or without a Cyrillic letter, come out as they are."""
    return _batch(normalize)(text)


_JAVA_WHITE = r"\s\x1c-\x1f"
_JAVA_DIGIT = r"[\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒]"
_STOPS = ".,;:!?"
FAR_WHITE = 100  # white space over which ``native_normalize`` looks back for a digit


def _look_alike_pattern(wrong: str) -> str:
    """Java's pattern for the places of a look-alike that are to be replaced; what stands before them is its group.

    Such a place sees a Cyrillic letter over at most ``_REACH`` - 1 other visible characters, none of them a stop. To the left it
    may also see a place that this pattern has just matched, where the matcher's last match ended.
    """
    white, letter = f"[{_JAVA_WHITE}]", f"(?iu:[{CYRILLIC}])"
    seen, other = f"[^{_JAVA_WHITE}]", f"[^{_JAVA_WHITE}{_STOPS}{CYRILLIC}{CYRILLIC.upper()}]"
    if wrong.isdigit():
        back = "|".join(f"(?<={_JAVA_DIGIT}{between})" for between in (f"{white}{{0,{FAR_WHITE}}}", f"{white}{{0,{FAR_WHITE}}}{seen}{white}{{0,{FAR_WHITE}}}"))
        target = rf"(?={wrong})(?!{back}){wrong}(?![-.]|{white}*+{_JAVA_DIGIT}|{white}*+{seen}{white}*+{_JAVA_DIGIT})"
    else:
        held = [(marker[:at], marker[at:]) for marker in (BLOCK_MARKER, OLD_MARKER) for at, c in enumerate(marker) if c == wrong]
        target = f"(?={wrong})" + "".join(rf"(?!(?<=\Q{a}\E)\Q{b}\E)" for a, b in held) + wrong
    gap = f"(?:{white}*+(?:(?!{wrong}){other}|(?!{target}){wrong})){{0,{_REACH - 1}}}+{white}*+"
    return rf"(?U)(?:((?:(?!\A)\G|{letter}){gap}){target}|{target}(?=(?:{white}*+{other}){{0,{_REACH - 1}}}+{white}*+{letter}))"


def native_normalize(text: Column) -> Column:
    """``smart_normalize`` as one expression for each entry of the table, without Python.

    It differs only where more than ``FAR_WHITE`` white-space characters part a digit from a 6 or 8. The batch function is
    the default because it is faster (see the README).
    """
    for wrong, right in LOOK_ALIKES:
        # bound as a variable, as an expression that is named twice in every step would grow by powers of two
        step = lambda t, wrong=F.lit(wrong), pattern=_look_alike_pattern(wrong), right=right: F.when(F.contains(t, wrong), F.regexp_replace(t, pattern, f"$1{right}")).otherwise(t)
        text = F.get(F.transform(F.array(text), _one_argument(step)), F.lit(0))
    return text


def _one_argument(function):
    """Spark tells by the number of a function's arguments whether it wants an item's place too."""
    return lambda item: function(item)


def repair_broken_words(text: Column, passes: int | None = None, config: Config = DEFAULT) -> Column:
    n = passes or config.word_healer_passes
    return _batch(lambda t: repair(t, n))(text)


def heal_text(text: Column, config: Config = DEFAULT) -> Column:
    if not config.word_healer_enabled:
        return text
    n = config.word_healer_passes
    return _batch(lambda t: heal(t, n))(text)


def _merge_pattern() -> str:
    c, k = f"[{CYRILLIC}]", f"(?:{T.CONSONANT})"
    most = MERGE_LENGTH
    short = "|".join([f"{c} ", f"{c}+ {c}(?!{c})", *(f"{c}{{{a}}} {c}{{2,{most - a}}}(?!{c})" for a in range(2, most - 1))])
    cluster = "|".join([f"{c}*{k}{{{MAX_CONSONANTS}}}", f"{c}+ {c}*{k}{{{MAX_CONSONANTS}}}", *(f"{c}*{k}{{{a}}} {k}{{{MAX_CONSONANTS - a}}}" for a in range(1, MAX_CONSONANTS))])
    too_long = "|".join([f"{c}{{{MAX_WORD_LENGTH + 1},}} {c}", *(f"{c}{{{a}}} {c}{{{MAX_WORD_LENGTH + 1 - a}}}" for a in range(1, MAX_WORD_LENGTH + 1))])
    anchor = f"{c}*(?-i:[{ANCHORS}])|{c}+ {c}*(?-i:[{ANCHORS}])"
    return rf"(?iu)(?={short})(?!{cluster})(?:(?={anchor})|(?!{too_long}))({c}+) ({c}+)|({c}+\s+{c}+)"


def native_repair(text: Column, passes: int = DEFAULT.word_healer_passes) -> Column:
    """``repair_broken_words`` in SQL, for texts whose white space is single spaces and line feeds."""
    for _ in range(passes):
        text = F.when(F.rlike(text, F.lit(rf"(?iu)[{CYRILLIC}] [{CYRILLIC}]")), F.regexp_replace(text, _merge_pattern(), "$1$2$3")).otherwise(text)
    return text
