"""Example vectors of each operator, and random texts against a plain statement of the rules."""

import random
import re

import pytest
import regex
from pyspark.sql import functions as F

from lexloom.config import DEFAULT, Config
from lexloom.constants import ALL_ENDINGS, BLOCK_MARKER, DIPHTHONGS
from lexloom.errors import ConfigurationError
from lexloom.functions import classify, healing, scalar, tokens
from lexloom.functions import text as T
from lexloom.operators import rules
from lexloom.plans import pipeline


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", function(F.col("v")).alias("x")).orderBy("i").collect()]


VECTORS = [
    (T.remove_special, "Hello123!@# World456", "Hello World"),
    (T.remove_special, "Сахалыы тыл уонна русскай", "Сахалыы тыл уонна русскай"),
    (healing.smart_normalize, "ба6ар", "баҕар"),
    (healing.smart_normalize, "баhар", "баһар"),
    (healing.smart_normalize, "oлор", "өлор"),
    (healing.smart_normalize, "о 8 о", "о ө о"),
    (healing.smart_normalize, "2006 год", "2006 год"),
    (healing.smart_normalize, "тел. 123-456", "тел. 123-456"),
    (healing.smart_normalize, "стр. 6", "стр. 6"),
    (healing.smart_normalize, "hello world", "hello world"),
    (healing.smart_normalize, "о 6 о л о р 2006 год тел. 123-456 ба6ар", "о ҕ о л о р 2006 год тел. 123-456 баҕар"),
    (healing.smart_normalize, "hello ба", "һellө ба"),
    (healing.repair_broken_words, "о ҕ о л о р", "оҕолор"),
    (healing.repair_broken_words, "б а ҕ а р", "баҕар"),
    (healing.repair_broken_words, "саха тыла", "саха тыла"),
    (healing.repair_broken_words, "бу дьон", "будьон"),
    (healing.repair_broken_words, "бу кинигэ", "бу кинигэ"),
    (healing.heal_text, "с а х а т ы л а", "саха тыла"),
    (healing.heal_text, "о ҕ о л о р  ба ҕ а р", "оҕолор баҕар"),
    (healing.heal_text, "о 6 о л о р  баhар  привет", "оҕолор баһар привет"),
    (healing.heal_text, "оҕо-\nлор баҕар", "оҕолор баҕар"),
    (healing.heal_text, "бу  кинигэ", "бу кинигэ"),
    (healing.heal_text, "hello ба", "һellөба"),
    (healing.heal_text, "", ""),
    (healing.heal_text, None, None),
    (T.remove_false_hyphens, "оҕо-\nлор", "оҕолор"),
    (T.remove_false_hyphens, "некото-\nрый", "некоторый"),
    (T.remove_false_hyphens, "слово-\n\n\nслово", "словослово"),
    (T.remove_false_hyphens, "кыра-балыста", "кыра-балыста"),
    (T.remove_false_hyphens, "some-\nword", "some-\nword"),
    (T.merge_line_hyphens, "some-\n word", "someword"),
    (T.protect_boundaries, "a  b\n\nc d", f"a {BLOCK_MARKER} b {BLOCK_MARKER} c d"),
    (T.length_valid, "о" + 30 * "ҕ", True),
    (T.length_valid, 30 * "а", False),
    (T.phonetically_valid, "бвгджзклмн", False),
    (T.phonetically_valid, "бвгджзклм", True),
    (T.badness, "а б вг", 2 / 3),
    (T.badness, " \n ", 0.0),
    (tokens.filter_invalid_words, "Слово а б в г. США Latin XIV оҕо-лор", "Слово оҕо-лор"),
    (scalar.format_file_size, "500", "500.0 B"),
    (scalar.format_file_size, "1280", "1.2 KB"),
    (scalar.format_file_size, str(1536 * 1024), "1.5 MB"),
    (scalar.format_file_size, str(5 * 1024**4), "5.0 TB"),
    (scalar.format_duration, "5.2", "5.2s"),
    (scalar.format_duration, "125", "2m 5s"),
    (scalar.format_duration, "3599", "59m 59s"),
    (scalar.format_duration, "5400", "1h 30m"),
    (scalar.format_duration, "7265", "2h 1m"),
    *((scalar.matches_exception, t, True) for t in ("г. Якутск", "стр. 5", "т.д.")),
    (scalar.matches_exception, "саха", False),
    *((classify.has_anchor, w, True) for w in "баҕар үөрэн өлөр һаһыл ҥыһаан".split()),
    *((classify.has_anchor, w, False) for w in ("привет", "hello", "ҔАР")),
    *((classify.has_diphthong, w, True) for w in "уонна иэ ыа үө".split()),
    *((classify.has_russian_marker, w, True) for w in "щит царь объявление флаг".split()),
    (classify.has_russian_marker, "баҕар", False),
    *((classify.has_russian_ending, w, True) for w in "читается читаешь читал красивый красивая красивое".split()),
    *((classify.has_sakha_ending, w, True) for w in "оҕолор киһилэр киһитэр киһитэ киһита".split()),
    *((classify.is_russian, w, True) for w in "щит царь флаг читается красивый".split()),
    *((classify.is_russian, w, False) for w in ("баҕар", "үөрэн", "өлөр", "уонна", "оҕолор", "киһитэ", "")),
    (classify.deciding_rule, "тыл", "russian_ending"),
    (classify.deciding_rule, "", "empty"),
    (classify.remove_russian_words, "баҕар щит оҕо–лор", "баҕар оҕо лор"),
]


def test_vectors(spark):
    by_function = {}
    for function, value, wanted in VECTORS:
        by_function.setdefault(function, []).append((value, wanted))
    for function, cases in by_function.items():
        assert apply(spark, function, [v for v, _ in cases]) == [w for _, w in cases], function.__name__


def random_texts(alphabet: str, n: int, most: int = 40, seed: int = 1):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(n)]


def test_tokens_match_plain_regex(spark):
    texts = random_texts("абҕ aZé-_–\n.1", 1500)
    assert apply(spark, tokens.dot_tokens, texts) == [regex.findall(r"\p{L}+(?:-\p{L}+)*\.?", t) for t in texts]
    assert apply(spark, tokens.joined_tokens, texts) == [regex.findall(r"\p{L}+(?:[-–_\n]\p{L}+)*", t) for t in texts]
    assert apply(spark, T.drop_spaced_letters, texts) == [re.sub(r"\s+", " ", regex.sub(r"\b(?:\p{L}\s+)+\p{L}\b", "", t)).strip() for t in texts]


def plain_merge(text: str) -> str:
    """One pass over pairs of words with single gaps, stated directly."""
    letters = re.compile("[а-яёҕҥөһү]", re.I)
    words, out, i = re.findall(r"[а-яёҕҥөһү]+|[^а-яёҕҥөһү]+", text, re.I), [], 0
    while i < len(words):
        if letters.match(words[i]) and i + 2 < len(words) and words[i + 1].isspace():
            a, gap, b = words[i : i + 3]
            run = max((len(m) for m in re.findall("[бвгджзйклмнпрстфхцчшщъьҕҥһ]+", a + b, re.I)), default=0)
            fine = (len(a) == 1 or len(b) == 1 or len(a + b) <= 7) and "\n" not in gap and "  " not in gap and (len(a + b) <= 25 or re.search("[ҕҥөһү]", a + b)) and run < 10
            out.append(a + b if fine else a + gap + b)
            i += 3
        else:
            out.append(words[i])
            i += 1
    return "".join(out)


def test_repair_matches_plain_statement_and_native_form(spark):
    texts = random_texts("абвгҕөклмн   \n.", 800, 60) + random_texts("бвгклмн ", 200, 60, 2)
    texts = [re.sub(r"\s{2,}", "\n", t) for t in texts]
    wanted = []
    for t in texts:
        for _ in range(5):
            t = plain_merge(t)
        wanted.append(t)
    assert apply(spark, healing.repair_broken_words, texts) == wanted
    assert apply(spark, healing.native_repair, texts) == wanted


def plain_normalize(text: str) -> str:
    chars, fixed = list(text), set()
    for m in re.finditer(r"\d+[\s\-.]?\d*", text):
        near = [c for c in text[: m.start()] if not c.isspace()][-2:] + [c for c in text[m.start() + 1 :] if not c.isspace()][:2]
        lone = sum(c.isdigit() for c in m[0]) == 1 and m[0][0] in "68" and not set(m[0]) & set("-./") and not any(c.isdigit() for c in near)
        if not lone:
            fixed |= set(range(*m.span()))

    def context(side):
        others = 0
        for c in side:
            if c in ".,;:!?":
                return False
            if c.isspace():
                continue
            if re.match("[а-яёҕҥөһү]", c, re.I):
                return True
            others += 1
            if others == 5:
                return False
        return False

    for wrong, right in zip("6hHoOyY8", "ҕһҺөӨүҮө", strict=True):
        for i in range(len(chars)):
            if chars[i] == wrong and i not in fixed and (context(reversed(chars[:i])) or context(chars[i + 1 :])):
                chars[i] = right
    return "".join(chars)


def test_normalize_matches_plain_statement():
    for text in random_texts("68hHoOyYаҕ xzq .,-12\n", 4000, 25, 3):
        assert healing.normalize(text) == plain_normalize(text), text


def test_long_chains_do_not_overflow_the_stack(spark):
    """Two hundred thousand repetitions of what a pattern repeats."""
    n = 200_000
    assert apply(spark, T.drop_spaced_letters, ["а б " * (n // 2)]) == [""] and apply(spark, T.count_spaced_letters, ["а б " * (n // 2)]) == [1]
    chains = ["аб-" * n, "аб\n" * n]
    assert [[len(t) for t in found] for found in apply(spark, tokens.dot_tokens, chains[:1])] == [[3 * n - 1]]
    assert [[len(t) for t in found] for found in apply(spark, tokens.joined_tokens, chains)] == [[3 * n - 1]] * 2
    assert [len(t) for t in apply(spark, pipeline.clean_text, chains)] == [3 * n - 1] * 2
    unhealed = Config(word_healer_enabled=False)
    assert apply(spark, lambda c: pipeline.clean_text(c, unhealed), ["а б " * (n // 2)]) == [""]


def test_spaced_letters_match_plain_statement(spark):
    texts = random_texts("аб5_ ,\n\xa0z-", 1500, 30, 6)
    pattern = regex.compile(r"\b(?:\p{L}\s+)+\p{L}\b")
    assert apply(spark, T.count_spaced_letters, texts) == [len(pattern.findall(t)) for t in texts]
    assert apply(spark, T.drop_spaced_letters, texts) == [re.sub(r"\s+", " ", pattern.sub("", t)).strip(" ") for t in texts]


def test_stems_match_plain_statement(spark):
    words = random_texts("лартэынбостьиеёая", 600, 9, 4)
    wanted = [{w} | {w[: -len(e)] for e in ALL_ENDINGS if w.endswith(e) and len(w) - len(e) >= 2} for w in words]
    assert list(map(set, apply(spark, rules.stems, words))) == wanted


def test_rules_in_an_expression_match_the_joins(spark):
    words = sorted(set(random_texts("сахлртэы", 400, 8, 5)))
    listed = ["саха", "тылэ", "рст", "лхлар"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    joined = {r.word for r in rules.match_rules(df, spark.createDataFrame([(w,) for w in listed], "word string")).collect()}
    inline = {r.word for r in df.where(rules.in_rules(F.col("word"), listed)).collect()}
    assert joined == inline and "сахалар" not in listed


def test_cascade_order(spark):
    words = ["ҕщ", "уощ", "щлар", "тлар", "белый", "дом"]
    assert apply(spark, classify.deciding_rule, words) == ["anchor", "diphthong", "marker", "sakha_ending", "russian_ending", "undecided"]
    assert apply(spark, lambda w: classify.deciding_rule(w, in_rules=F.lit(True)), words)[2:] == ["rules"] * 4
    assert apply(spark, lambda w: classify.is_russian(w, fallback=F.lit(True)), ["дом"]) == [True]
    assert apply(spark, lambda w: classify.deciding_rule(w, DEFAULT.with_(use_v_as_russian_marker=False)), ["вода"]) == ["undecided"]
    assert len(DIPHTHONGS) == 4


def test_config_is_checked():
    assert Config().validate() == Config()
    for wrong in ({"word_healer_passes": 0}, {"pdf_badness_threshold": 1.5}, {"pdf_x_tolerance": -1}, {"word_healer_exceptions_file": "/"}):
        with pytest.raises(ConfigurationError):
            Config(**wrong).validate()


def test_native_normalization_matches_the_batch_function(spark):
    pieces = [*"аҕбүяЁҺ", *"6688hhHooOyY", *"xz-.,;:! \n\t_[]", "  ", BLOCK_MARKER, "__WORD_BOUNDARY__", "5", "²", f" {BLOCK_MARKER} ", "[[BLO", "\x1c", "«"]
    rng = random.Random(11)
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 25))) for _ in range(5000)] + ["", "h" * 2000 + "а", "а" + "o " * 2000, "а 6" + " " * 90 + "5"]
    assert apply(spark, healing.native_normalize, texts) == [healing.normalize(t) for t in texts]
    plan = spark.createDataFrame([("а",)], "t string").select(healing.native_normalize(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_few_texts_of_a_batch_are_strings_at_a_time(monkeypatch):
    import pyarrow as pa

    from lexloom.functions import healing

    sizes = []

    class Column:  # an Arrow array whose conversions to Python strings are noted
        def __init__(self, array):
            self.array = array

        def __len__(self):
            return len(self.array)

        def dictionary_encode(self):
            coded = self.array.dictionary_encode()
            return type("Coded", (), {"dictionary": Column(coded.dictionary), "indices": coded.indices})()

        def slice(self, at, size):
            return Column(self.array.slice(at, size))

        def to_pylist(self):
            sizes.append(len(self.array))
            return self.array.to_pylist()

    texts = [None if n % 7 == 0 else f"t{n % 900}" for n in range(2000)]
    for column in (texts, [f"t{n}" for n in range(500)], []):
        done = healing._batch(str.upper).func(Column(pa.array(column, pa.string())))
        assert done.to_pylist() == [t and t.upper() for t in column]
    assert max(sizes) <= 64
