"""Spelling variants, token files and collocations, against plain versions."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexloom.llm import collocations, spelling, token_files
from lexloom.llm.queries import QUERIES


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


# spelling variants


def one_apart(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(rows):
    words = plain_words(rows)
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and one_apart(v, w)] for w in words}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def as_tuples(df):
    return [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]


def misspelt_rows():
    """Words that occur about 4,000, 330, 27 and 2 times, each one letter from the one before, with ties and Latin-1 letters."""
    random.seed(5)
    out = []
    for stem in ("learning", "Überfluß", "niñerías", "aaaaaaaaaa", "abababab"):
        word, n = stem, 4000
        while n >= 2:
            out += [word] * n
            at = random.randrange(len(word))
            word = random.choice([word[:at] + "x" + word[at + 1 :], word[:at] + "z" + word[at:]])
            n //= 12
    for tie in ("mountain", "mountair", "mountais"):
        out += [tie] * 30
    out += ["mountai"] * 2 + ["mountainxy"] * 3 + ["ÀÉÎÕÜßÿ"] * 2
    random.shuffle(out)
    return [(i, " ".join(out[at : at + 50])) for i, at in enumerate(range(0, len(out), 50))]


@pytest.mark.parametrize(("shard_bytes", "at_once"), [(150, 3), (1 << 20, 8)])
def test_variants_match_a_plain_statement(spark, shard_bytes, at_once):
    rows = misspelt_rows()
    got = as_tuples(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), shard_bytes=shard_bytes, at_once=at_once))
    assert len(got) == len(set(got)) and set(got) == plain_variants(rows)
    assert any(r[1] and r[2] != r[1] for r in got)  # chains longer than one step


def test_variants_query(spark, small, texts):
    assert set(as_tuples(QUERIES["op11_spelling"](spark, small))) == plain_variants(texts.items())


def test_variant_edges(spark, edges):
    rows = [(r.doc_id, r.text) for r in edges.select("doc_id", "text").collect()]
    got = as_tuples(spelling.variants(edges))
    assert set(got) == plain_variants(rows) and len(got) > 3
    assert spelling.variants(edges.where("false")).count() == 0
    assert spelling.variants(edges.where("text is null")).count() == 0
    long = "a" * 5000 + "b" * 5000
    rows = [(1, f"{long} {long} {long[1:]} {long[1:]} {long[:-1]}x {long[:-1]}x")]
    found = as_tuples(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert set(found) == plain_variants(rows) and sorted(r[4] for r in found) == [1, 1, 2]


def test_tries_find_all_neighbours():
    random.seed(1)
    words = sorted({"".join(random.choice("abc") for _ in range(random.randint(1, 7))).encode() for _ in range(400)})
    trie = spelling.Trie.unpacked(spelling.Trie.of(words, list(range(1, len(words) + 1))).packed())
    for word in [*words, b"abcabcabc", b"", b"zzz"]:
        wanted = {w: i + 1 for i, w in enumerate(words) if one_apart(w.decode(), word.decode())}
        assert trie.near(word) == wanted
    assert spelling.Trie.of([], []).near(b"word") == {}


# token files


def tokenizer():
    out = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    out.encode_special_tokens = True
    return out


def vocabulary():
    with open(public_tokenizers.path(token_files.VOCABULARY), "rb") as f:
        return f.read()


ODD = ["", " ", "  a", "a  ", "a \n b", "a\n b", "x <|endoftext|> y", "« mot » ici", "a　b ​ c \x1c d\x85 e", "it's   fine \t\t ok\n", "🙂 🙂  🙂", "\n", "'s 's", "don't\n\n  we'll", "é é", "a\rb c\r\n d"]


def test_pieces_are_encoded_as_their_texts(texts):
    own = tokenizer()
    pieces = token_files.Pieces(own)
    for _ in range(2):  # the second time all pieces are known
        every = [*texts.values(), *ODD]
        numbers = [pieces.of(t) for t in every]
        starts, sizes, flat = pieces.settle()
        got = [np.concatenate([np.zeros(0, np.uint32), *(flat[starts[i] : starts[i] + sizes[i]] for i in n)]).tolist() for n in numbers]
        del starts, sizes, flat
        assert got == [own.encode(t, add_special_tokens=False).ids for t in every]


def test_lines_are_pieces_of_their_own(monkeypatch):
    """Texts of very many short lines, with blank ones or without; a text of letters, marks and line ends asks only the model for its words."""
    own = tokenizer()
    texts = ["x\n" * 5000, "\n".join(["a,b"] * 5000) + "\n\n" + "\n".join("ab" * 3000), "\0a\nb\0 c", "Ԁ Ԯ ԱԲ, ß.\nΩ é"]
    lines = "\n".join(f"one {a}{b}, Été\nwö{b}{a}." for a in "abcdef" for b in "ghijkl")
    pieces = token_files.Pieces(own)
    sent = []
    run = token_files.Pieces._encoded
    monkeypatch.setattr(token_files.Pieces, "_encoded", lambda self, some: sent.extend(some) or run(self, some))
    for part in ([lines], texts):
        numbers = [pieces.of(t) for t in part]
        starts, sizes, flat = pieces.settle()
        assert [np.concatenate([flat[starts[i] : starts[i] + sizes[i]] for i in n]).tolist() for n in numbers] == [own.encode(t, add_special_tokens=False).ids for t in part]
        del starts, sizes, flat
        assert part is texts or set(sent) == {"\n", ",", "."}


def test_texts_look_up_their_distinct_pieces(texts):
    """Many texts at once, with nulls and bytes that are no UTF-8: what occurs again is not looked up again."""

    class Counted(token_files.Pieces):
        asked = 0

        def get(self, *piece):
            self.asked += 1
            return super().get(*piece)

        def __getitem__(self, piece):
            self.asked += 1
            return super().__getitem__(piece)

    own = tokenizer()
    raws = [b"before", None, b"\xc3", b"\xa9 a\xd4 \x80.", b"\xff\n\xe2\x82", *(t.encode() for t in [*ODD, *texts.values()]), b"one two\nthree, four\n\nfive. one" * 20000]
    pieces = Counted(own)
    numbers, first = pieces.of_each(pa.array(raws, pa.binary()).slice(1))
    assert len(first) == len(raws) and pieces.asked < len(numbers)
    starts, sizes, flat = pieces.settle()
    for raw, a, b in zip(raws[1:], first[:-1], first[1:], strict=True):
        got = [i for n in numbers[a:b] for i in flat[starts[n] : starts[n] + sizes[n]].tolist()]
        assert got == own.encode((raw or b"").decode("utf-8", "replace"), add_special_tokens=False).ids
    del starts, sizes, flat
    pieces.asked = 0
    pieces.of_each(pa.array([b" one two\nthree" * 50000], pa.binary()))
    assert pieces.asked < 20


def test_numbers_of_all_sizes():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        numbers = (rng.integers(0, 2**32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        control, data = token_files.encode_numbers(numbers)
        assert len(control) == -(-n // 4)
        assert (token_files.decode_numbers(control, data, n) == numbers).all()
    assert len(token_files.encode_numbers(np.array([0, 255, 256, 65535, 65536, 1 << 24, 0, 0], np.uint32))[1]) == 1 + 1 + 2 + 2 + 3 + 4 + 1 + 1


def test_packed_ids_have_two_or_four_bytes():
    for ids in (np.zeros(0, np.uint16), np.array([0, 50256, 65535], np.uint16), np.array([0, 1 << 16, 2**32 - 1], np.uint32)):
        got = token_files._unpacked(token_files._packed(ids))
        assert got.dtype == ids.dtype and got.tolist() == ids.tolist()


def test_token_file_query(spark, small, texts):
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_token_files"](spark, small).collect()}
    own, start = tokenizer(), 0
    for i, text in sorted(texts.items()):
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 2]
        assert got[i] == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(texts)


def test_token_file_edges(spark, edges, tmp_path):
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    docs = edges.select("doc_id", "text").union(odd)
    rows, own = [tuple(r) for r in docs.collect()], tokenizer()
    token_files.write(token_files.tokenize(docs, vocabulary()), f"{tmp_path}/files", block_ids=50)
    got = token_files.read(spark, f"{tmp_path}/files").orderBy("start").collect()
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in got]
    assert Counter((r.doc_id, *x) for r, x in zip(got, ids, strict=True)) == Counter((i, *own.encode(t or "", add_special_tokens=False).ids, 2) for i, t in rows)
    assert [r.start for r in got] == np.cumsum([0, *(len(x) for x in ids)])[:-1].tolist()
    order = [r.doc_id for r in got]
    assert order == sorted((i for i in order if i is not None)) + [None] * order.count(None)
    numbers = {r.number: r.id for r in spark.read.parquet(f"{tmp_path}/files/ids").collect()}
    counts = Counter(i for x in ids for i in x)
    assert [numbers[i] for i in range(len(numbers))] == sorted(counts, key=lambda i: (-counts[i], i))
    token_files.write(token_files.tokenize(docs.where("false"), vocabulary()), f"{tmp_path}/none")
    assert token_files.read(spark, f"{tmp_path}/none").count() == 0


# collocations


def plain_collocations(rows, longest=3, least=10, percent=50, first=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        kept = [p for p, n in f.items() if len(p) > 1 and n >= least]
        held = defaultdict(int)
        for p in kept:
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    held[p[i : i + m]] = max(held[p[i : i + m]], f[p])
        found = []
        for p in kept:
            if 100 * held[p] < percent * f[p]:
                score, k = min((10**6 * f[p] ** 2 // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, totals[lang], -score) for i, (score, a, p, left, right) in enumerate(sorted(found)[:first])]
    return set(out)


def ranked(df):
    out = [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


def phrase_rows():
    random.seed(3)
    common = ["the", "of", "and", "new", "york", "city", "hall", "Ünï", "x\x1cy", "a b"]
    out = []
    for i in range(300):
        words = [random.choice(common) for _ in range(30)]
        for _ in range(3):
            words.insert(random.randrange(len(words)), random.choice(["new york city", "city hall,", "The New\tYork", "hall. of", "one two three four five"]))
        out.append((None if i % 7 == 0 else ["en", "de", "und"][i % 3], " ".join(words) + ("\n" if i % 2 else ";") + "new york"))
    return [*out, ("fr", None), ("fr", ""), ("es", " .,; "), (None, "ab " * 5000), ("en", "x" * 100_000)]


@pytest.mark.parametrize(("options", "block_words"), [({}, 500), ({"longest": 5, "least": 4, "percent": 80, "first": 40}, 2000), ({"least": 300}, 10**6)])
def test_collocations_match_a_plain_statement(spark, options, block_words):
    rows = phrase_rows()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert ranked(collocations.collocations(docs, block_words=block_words, buckets=1 << 10, **options)) == plain_collocations(rows, **options)


def test_collocations_query(spark, small, documents):
    rows = [(r.lang, r.text) for r in documents.collect()]
    assert ranked(QUERIES["op13_collocations"](spark, small)) == plain_collocations(rows)


def test_collocation_edges(edges):
    rows = [(r.lang, r.text) for r in edges.select("lang", "text").collect()]
    assert ranked(collocations.collocations(edges, least=2)) == plain_collocations(rows, least=2)
    assert collocations.collocations(edges.where("false")).count() == 0
    assert collocations.collocations(edges.where("text is null")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    phrases = spark.createDataFrame([("en", "a b", big, 2), ("en", "a", big + 7, 1), ("en", "b", big + 9, 1)], "lang string, phrase string, n long, m int")
    assert collocations.scored(phrases).first().score == 10**6 * big * big // ((big + 7) * (big + 9))


def test_bucket_counts_of_tasks_add_up(spark):
    hashes = np.arange(100, dtype=np.uint64)

    def one(_):
        buckets = collocations.Buckets(10, 1 << 12)
        buckets.add(np.repeat(hashes, np.arange(100) % 5 + 1))
        yield from buckets.rows()

    bits = collocations.bitmap(spark.range(0, 3, 1, 3).mapInArrow(one, collocations.PASS), 10, 1 << 12)
    found = np.flatnonzero(np.unpackbits(bits))
    assert found.tolist() == [i for i in range(100) if 3 * (i % 5 + 1) >= 10]


@pytest.mark.parametrize("name", ["op11_spelling", "op12_token_files", "op13_collocations"])
def test_queries_return_their_columns(spark, small, name):
    types = dict(QUERIES[name](spark, small).dtypes)
    texts = {"word", "form", "root", "lang", "phrase"}
    assert all(t == ("string" if c in texts else "bigint") for c, t in types.items())


def test_files_of_a_pass_hold_few_rows(spark, monkeypatch):
    written = {}
    store = collocations.materialize

    def noted(df, tag, *args, **kwargs):
        out = written[tag] = store(df, tag, *args, **kwargs)
        return out

    monkeypatch.setattr(collocations, "materialize", noted)
    docs = spark.createDataFrame([("en", f"one two three w{n % 7} x{n % 5}") for n in range(400)], "lang string, text string").coalesce(1)
    found = collocations.frequent_phrases(docs, block_words=100, buckets=1 << 12).where("m = 3 and phrase = 'one two three'").collect()
    assert [r.n for r in found] == [400]
    for tag in ("phrases-1", "phrases-2", "phrases-3"):
        sizes = [r["count"] for r in written[tag].groupBy(F.input_file_name()).count().collect()]
        assert sum(sizes) > collocations.ROWS_A_FILE >= max(sizes)
