"""Each operator on whole small tables and on edge cases, against plain versions, round trips or held-out accuracy."""

import hashlib
import itertools
import math
import random
import tempfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import plain
import public_tokenizers
import pytest
import tiktoken
from oracle import assert_matches
from pyspark.sql import functions as F

from lexloom.llm import audio, bpe, common, lattice_lm, line_dedup, linking, mixing, near_dup, order_minhash, quality_knn, secrets, shards, wordblocks
from lexloom.llm.queries import ORACLES, QUERIES


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def empty(df):
    return df.where("false")


def by_row(rows, *columns):
    return Counter(tuple(r[c] for c in columns) for r in rows)


# 1


def encoding():
    ranks = bpe.parse_ranks(bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY)))
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def bpe_rows(rows):
    enc = encoding()
    out = Counter()
    for i, text in rows:
        ids = enc.encode_ordinary(text or "")
        out[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
    return out


def test_bpe_query(spark, small, texts):
    assert by_row(QUERIES["op1_bpe"](spark, small).collect(), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == bpe_rows(texts.items())


def test_bpe_edges(edges):
    ranks = bpe.load_ranks(public_tokenizers.path(bpe.VOCABULARY))
    got = bpe.digests(bpe.decode(bpe.encode(edges, ranks, block_bytes=1000), ranks))
    assert by_row(got.collect(), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == bpe_rows(pairs(edges))
    assert bpe.digests(bpe.decode(bpe.encode(empty(edges), ranks), ranks)).count() == 0


def test_pieces_match_the_reference_pattern():
    rng, enc = random.Random(7), encoding()
    alphabet = "ab  \n\t\r'stmredl19.,!\x1c\x85\xa0 　 éßЖ中́🙂_"
    ranks = enc._mergeable_ranks
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        block = wordblocks.Block(bpe.split_pieces)
        block.add(1, text.encode(), False)
        ids = [i for n in block.texts[0] for i in ([ranks[block.words[n]]] if block.words[n] in ranks else enc._encode_single_piece(block.words[n]))]
        assert ids == enc.encode_ordinary(text), text


def test_block_numbers_fall_into_one_bucket(spark):
    values = [0, 1, -1, 7 << 32, (1 << 62) + 12345]
    hashed = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v long").select(F.hash("v")).collect()]
    assert common.spark_hash(np.array(values, np.int64)).tolist() == hashed
    seen = set()
    for task in (0, 5, 1000):
        numbers = list(itertools.islice(common.block_numbers(task, 7), 3000))
        assert {h % 7 for h in common.spark_hash(np.array(numbers)).tolist()} == {task % 7} and not seen & set(numbers)
        seen |= set(numbers)


def test_packing_keeps_arrays():
    arrays = [np.arange(5, dtype=np.uint32), np.zeros(0, np.int64), np.array([1.5, -2.0])]
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(arrays, wordblocks.unpack(wordblocks.pack(*arrays)), strict=True))


# 2


def test_sharding_query(spark, small, texts):
    got = QUERIES["op2_sharding"](spark, small).collect()
    assert by_row(got, "doc_id", "text_sha256") == Counter((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in texts.items())


def test_sharding_query_compacts(spark, small, texts, monkeypatch):
    """The query's arrivals are merged: as many rows in fewer files, each of which holds what the query says."""
    made = []
    whole = shards.ShardStore.append
    monkeypatch.setattr(shards.ShardStore, "append", lambda self, df: made.append(self) or whole(self, df))
    got = QUERIES["op2_sharding"](spark, small).collect()
    store = made[-1]
    assert len(made) == shards.ARRIVALS and store.shards(shards.ARRIVALS).count() >= shards.ARRIVALS
    files = {r.file.removeprefix("data/"): r.rows for r in store.shards().collect()}
    assert len(files) < store.shards(shards.ARRIVALS).count() and Counter(r.shard for r in got) == files
    assert {r.doc_id: r.stored_chars for r in got} == {i: None if t is None else len(t) for i, t in texts.items()}


def test_schemas_grow_or_conflict(spark):
    store = shards.ShardStore(spark, tempfile.mkdtemp() + "/store")
    store.append(spark.createDataFrame([(1, "a")], "doc_id long, text string").coalesce(1))
    store.append(spark.createDataFrame([(2, "b", [1.5])], "doc_id long, text string, scores array<double>").coalesce(1))
    store.append(spark.createDataFrame([("c", 3)], "text string, doc_id long").coalesce(1))
    store.append(spark.createDataFrame([(4,)], "doc_id long").coalesce(1))
    wanted = [(1, "a", None), (2, "b", [1.5]), (3, "c", None), (4, None, None)]
    assert sorted(map(tuple, store.read().collect())) == wanted and store.read(1).columns == ["doc_id", "text"]
    for kind in ("doc_id string", "Doc_id long", "doc_id long, scores array<int>"):
        with pytest.raises(shards.SchemaConflict):
            store.append(spark.createDataFrame([], kind))
    assert store.versions() == [1, 2, 3, 4]
    for _ in range(shards.FAN):
        store.append(spark.createDataFrame([(4,)], "doc_id long").coalesce(1))
    assert store.compact() == 9 and store.shards().count() < store.shards(8).count()
    assert sorted(map(tuple, store.read().collect())) == wanted + wanted[-1:] * shards.FAN


def test_lists_that_lost_shards_are_read_by_file(spark):
    store = shards.ShardStore(spark, tempfile.mkdtemp() + "/store")
    store.append(spark.range(200_000).repartition(1), shard_rows=50_000)
    store.append(spark.range(8).repartition(8))
    before = store.manifest()["lists"]
    store.compact(target_bytes=10_000)
    after = store.manifest()["lists"]
    assert before[0] in after and before[1] not in after  # the large shards' list stays as it is
    assert store.read().count() == 200_008 and store.shards().agg(F.sum("rows")).first()[0] == 200_008


def test_sharding_versions(spark, edges):
    store = shards.ShardStore(spark, tempfile.mkdtemp() + "/store")
    assert store.manifest()["version"] == 0
    for _ in range(3):
        store.append(edges, shard_rows=3)
    before = store.shards().count()
    assert store.compact(target_bytes=1 << 20) == 4
    after = store.manifest()
    assert store.shards().count() < before / 3 and store.shards(3).count() == before
    order = sorted(map(repr, edges.collect()))
    assert sorted(map(repr, store.read().collect())) == sorted(map(repr, store.read(3).collect())) == sorted(order * 3)
    assert store.compact(target_bytes=1 << 20) in (4, 5)
    with pytest.raises(shards.CommitConflict):
        store._commit({"version": 1}, after["schema"], [])
    assert store.expire(keep=1) > 0 and len(store.versions()) == 1
    assert store.read().count() == 3 * len(order)


def test_compaction_over_arrivals(spark, documents, monkeypatch):
    """Many arrivals, compacted now and then in runs of few shards: sizes grow to the target, and no row changes."""
    monkeypatch.setattr(shards, "RUN", 7)
    store = shards.ShardStore(spark, tempfile.mkdtemp() + "/store")
    for n in range(5):
        store.append(documents.where(f"doc_id % 5 = {n}").coalesce(1), shard_rows=4)
        if n % 2:
            store.compact(target_bytes=40_000)
    store.compact(target_bytes=40_000)
    left = [r.bytes for r in store.shards().collect()]
    tiers = Counter(int(math.log(b, shards.FAN)) for b in left if b < 40_000)
    assert max(tiers.values(), default=0) < shards.FAN and max(left) < 4 * 40_000
    assert sorted(map(repr, store.read().collect())) == sorted(map(repr, documents.collect()))
    assert store.shards().agg(F.sum("rows")).first()[0] == documents.count()


def test_sharding_of_nothing(spark, edges):
    store = shards.ShardStore(spark, tempfile.mkdtemp() + "/store")
    store.append(empty(edges))
    assert store.compact() == 1 and store.read().columns == edges.columns and store.read().count() == 0


def test_shards_near_the_target_are_left_alone(spark):
    store = shards.ShardStore(spark, tempfile.mkdtemp() + "/store")
    store.append(spark.range(100).coalesce(1))
    assert store.compact(target_bytes=10) == 1


# 3


def test_line_dedup_query(spark, small, texts):
    rows = sorted(texts.items())
    wanted = dict(zip((i for i, _ in rows), plain.dedup_lines(rows), strict=True))
    got = QUERIES["op3_line_dedup"](spark, small).collect()
    assert {r.doc_id: r.text for r in got} == wanted
    assert sum(r.n_lines - r.n_kept for r in got) > 0


def test_line_dedup_edges(edges):
    rows = pairs(edges)
    out = line_dedup.dedup_lines(edges)
    assert out.columns == edges.columns
    assert Counter(pairs(out)) == Counter(zip((i for i, _ in rows), plain.dedup_lines(rows), strict=True))
    left = line_dedup.dedup_lines(edges, drop_empty=True)
    assert {3, 4, 2, 7} <= {i for i, _ in pairs(left)} and 11 not in {i for i, _ in pairs(left)}
    assert line_dedup.dedup_lines(empty(edges)).count() == 0


def test_line_dedup_of_repeated_rows_and_ids(spark):
    """One of two equal rows keeps its lines; ids that stand for several texts, and null ids, are told apart."""
    rows = [(1, "one line that is here twice"), (1, "one line that is here twice"), (2, "a\na\n\nb"), (2, "b\nc"), (None, "c\nd"), (None, "d"), (None, "d"), (3, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = pairs(line_dedup.dedup_lines(docs))
    assert Counter(got) == Counter(zip((i for i, _ in rows), plain.dedup_lines(rows), strict=True))
    assert sorted(t for i, t in got if i == 1) == ["", rows[0][1]]
    assert Counter(pairs(line_dedup.dedup_lines(docs, drop_empty=True))) == Counter((i, t) for i, t in got if t)


def test_line_dedup_over_many_small_blocks(spark, texts, monkeypatch):
    monkeypatch.setattr(line_dedup.cut_blocks, "__defaults__", (2000,))
    rows = sorted(texts.items())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert dict(pairs(line_dedup.dedup_lines(docs))) == dict(zip((i for i, _ in rows), plain.dedup_lines(rows), strict=True))


def test_line_dedup_of_a_long_document(spark):
    """100,000 lines, half of them repeated, and one very long line."""
    rng = random.Random(9)
    lines = ["".join(rng.choices("abcdefghijklmnop", k=24)) for _ in range(50_000)]
    long = " ".join(lines[:20_000])
    docs = spark.createDataFrame([(1, "\n".join([*lines, *lines])), (2, long), (3, long + "x")], "doc_id long, text string")
    assert dict(pairs(line_dedup.dedup_lines(docs))) == {1: "\n".join(lines), 2: long, 3: ""}


def test_line_dedup_recall():
    """Pairs at the threshold meet in a band as often as the docstring says."""
    rng, met, n = random.Random(10), 0, 0
    while n < 1500:
        line = "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=300))
        other = list(line)
        for at in rng.sample(range(300), 4):
            other[at] = "#"
        h, sizes = line_dedup.shingle_hashes([line.encode(), "".join(other).encode()])
        a, b = np.unique(h[: sizes[0]]), np.unique(h[sizes[0] :])
        both = len(np.intersect1d(a, b))
        if not 0.8 <= both / (len(a) + len(b) - both) <= 0.82:
            continue
        n += 1
        keys = line_dedup.band_keys([line.encode(), "".join(other).encode()])
        met += bool((keys[0] == keys[1]).any())
    assert met / n > 0.99


# 4


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_dup_tables(documents, texts, k, percent):
    wanted = plain.near_duplicates([(i, i, t) for i, t in texts.items()], k, percent)
    got = near_dup.near_duplicates(documents, k, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, small, name):
    assert_matches(QUERIES[name](spark, small), ORACLES[name], small)


def test_near_dup_edges(edges):
    rows = [(n, i, t) for n, (i, t) in enumerate(pairs(edges))]
    wanted = plain.near_duplicates(rows, 3, 85)
    wanted_rows = Counter()
    for n, i, _ in rows:
        size, component = wanted[n]
        wanted_rows[i, size, i if component is None else component] += 1
    got = near_dup.near_duplicates(edges, 3, 85).collect()
    assert by_row(got, "doc_id", "n_shingles", "component_id") == wanted_rows
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert near_dup.near_duplicates(empty(edges)).count() == 0


def test_near_dup_connects_a_large_group_of_varied_copies(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(400):
        copy = list(base)
        for _ in range(rng.randint(0, 9)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10_000)}"
        rows.append((i, " ".join(copy)))
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.near_duplicates([(i, i, t) for i, t in rows], 3, 85)


def test_texts_stay_in_their_blocks(spark, documents):
    """Only what is asked of the blocks is shuffled for the comparison, and places without a request send nothing."""
    blocks = near_dup.cut_blocks(common.id_and_bytes(documents.repartition(3)), 3, block_bytes=20_000)
    features = near_dup.features_of(blocks)
    assert features.count() == documents.count() and blocks.count() > 10
    wanted = features.where("doc_id < 5").select("block", "row", F.col("doc_id").alias("id"), F.lit(7).cast("long").alias("root"), F.lit(1).cast("long").alias("n"), F.lit(2).cast("long").alias("weight"))
    sets = near_dup.wanted_sets(blocks, wanted, 3)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    left = plan[plan.index("SortMergeJoin") :]
    assert left.count("Exchange") <= 1 and "Bucketed: true" in left and "BroadcastHashJoin" not in plan
    assert sorted(r.id for r in sets.collect()) == sorted(r.doc_id for r in documents.where("doc_id < 5").collect())
    hashes = common.WordHashes()
    raw = {r.doc_id: r.text.encode() for r in documents.where("doc_id < 5").collect()}
    assert all(r.payload == common.word_shingles(hashes.of(common.lower_words(raw[r.id])), 3).astype("<u8").tobytes() for r in sets.collect())


def test_large_sets_are_compared_in_small_chunks(spark, monkeypatch, texts):
    """Groups whose sets are too large for one task fall into many, with the same links."""
    monkeypatch.setattr(linking, "CHUNK_WEIGHT", 600)
    rng = random.Random(14)
    rows = []
    for i in range(60):
        words = [f"w{n}" for n in range(150)]
        for at in range(rng.randint(0, 3) + i // 6):
            words[rng.randrange(150)] = f"x{i}-{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = plain.near_duplicates([(i, i, t) for i, t in rows], 3, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs, 3, 85).collect()} == wanted and 2 < len({c for _, c in wanted.values()}) < 60
    some = sorted(texts.items())[:60]
    lines = spark.createDataFrame(some, "doc_id long, text string")
    assert dict(pairs(line_dedup.dedup_lines(lines))) == dict(zip((i for i, _ in some), plain.dedup_lines(some), strict=True))


def test_signature_guarantee():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, near_dup.VALUES).astype("<u2")
    for _ in range(300):
        b = a.copy()
        b[rng.choice(near_dup.VALUES, near_dup.SURE, replace=False)] ^= 1
        assert set(near_dup.chunk_keys(a[None])[0].tolist()) & set(near_dup.chunk_keys(b[None])[0].tolist())


def test_near_dup_compares_all_that_meet(spark):
    """8 of 10 words are shared, yet 21 of 40 signature values differ; the two meet under a key."""
    shared = [f"{c}1491" for c in "abcdefgh"]
    rows = [(n, " ".join([*shared, last])) for n, last in enumerate(("y1491", "z1491"), 1)]
    hashes = near_dup.WordHashes()
    a, b = (near_dup.signature(near_dup.word_shingles(hashes.of(near_dup.lower_words(t.encode())), 1)) for _, t in rows)
    assert (a != b).sum() == 21 and set(near_dup.chunk_keys(a[None])[0].tolist()) & set(near_dup.chunk_keys(b[None])[0].tolist())
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 1, 80).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False)}


def test_near_dup_takes_no_sets_of_texts_whose_sizes_rule_links_out(spark, monkeypatch):
    """Each text begins the next one, which is longer by a third; they meet, but as chance meetings do."""
    asked = []
    run = near_dup.wanted_sets
    monkeypatch.setattr(near_dup, "wanted_sets", lambda blocks, wanted, words: asked.append(wanted.count()) or run(blocks, wanted, words))
    words = [f"w{n}" for n in range(700)]
    rows = [(i, " ".join(words[: int(60 * 1.35**i)])) for i in range(8)] + [(20, " ".join(words[:100])), (21, " ".join(words[1:100]))]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == plain.near_duplicates([(i, i, t) for i, t in rows], 3, 85)
    assert asked[0] < len(rows) - 2


def test_outlines_rule_out_no_linked_sets():
    rng = np.random.default_rng(2)
    for percent in (80, 85):
        assert near_dup.most_differing(percent) > near_dup.SURE
        for _ in range(300):
            a = rng.integers(0, 1 << 63, 600, dtype=np.uint64)
            b = np.concatenate([a[: -(-2 * percent * 600 // (100 + percent))], rng.integers(0, 1 << 63, 600, dtype=np.uint64)])[:600]
            outlines = [near_dup.signature(np.unique(x)).tobytes() + len(x).to_bytes(8, "big") for x in (a, b, a[:300])]
            assert near_dup.outline_matcher(percent)(outlines)(0, np.array([1, 2])).tolist() == [True, False]


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    union = plain.Union()
    for a, b in links:
        union.join(a, b)
    got = linking.components(spark.createDataFrame(links, "a long, b long"), "test").collect()
    assert {r.id: r.root for r in got} == {x: union.find(x) for a, b in links if a != b for x in (a, b)}
    assert linking.components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_components_when_tasks_hold_few_nodes(spark, monkeypatch):
    """A long path, a hub and a dense tangle; tasks forget what they hold again and again."""
    run = linking._contract.__wrapped__

    def forgetful(batches):
        linking.NODES_HELD = 7
        yield from run(batches)

    monkeypatch.setattr(linking, "_contract", forgetful)
    monkeypatch.setattr(linking, "EDGES_A_TASK", 50)
    rng = random.Random(15)
    path = list(range(400))
    rng.shuffle(path)
    links = [*zip(path, path[1:], strict=False), *((1000, 1001 + n) for n in range(200)), *((2000 + rng.randrange(90), 2000 + rng.randrange(90)) for _ in range(400))]
    union = plain.Union()
    for a, b in links:
        union.join(a, b)
    got = linking.components(spark.createDataFrame(links, "a long, b long").repartition(6), "test").collect()
    assert {r.id: r.root for r in got} == {x: union.find(x) for a, b in links if a != b for x in (a, b)}


def test_key_links(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(400), rng.randrange(60)) for _ in range(900)]
    members = defaultdict(set)
    for key, i in rows:
        members[key].add(i)
    got, wanted = plain.Union(), plain.Union()
    for r in linking.key_links(spark.createDataFrame(rows, "key long, id long")).collect():
        got.join(r.a, r.b)
    for m in members.values():
        for i in m:
            wanted.join(i, min(m))
    assert {i: got.find(i) for _, i in rows} == {i: wanted.find(i) for _, i in rows}
    assert linking.key_links(spark.createDataFrame([(n, n) for n in range(50)] * 3, "key long, id long")).count() == 0


# 5


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op5_quality_knn"](spark, folder).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [(r.predicted, label[r.doc_id]) for r in got if r.held_out and r.doc_id in label]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (plain.fold(r.doc_id, 4) == 2) for r in got)


def test_votes_match_a_plain_statement(spark, texts):
    """Scores of all documents from their term counts, a full decomposition and a vote written out."""
    folder = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    label = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None and plain.fold(r.doc_id, 4) != 2}
    learnt = [i for i in label if i in texts]
    vectors, goods = plain.latent_vectors([texts[i] for i in learnt], list(texts.values()), quality_knn.FEATURES, quality_knn.DIMS), [label[i] for i in learnt]
    model = quality_knn.fit(docs, labels)
    scores = {r.doc_id: r._score for r in quality_knn.score_documents(docs, model).collect()}
    wanted = plain.votes(*vectors, goods, quality_knn.NEIGHBOURS, quality_knn.POWER)
    assert np.allclose([scores[i] for i in texts], wanted, atol=0.02) and np.median(np.abs(np.array([scores[i] for i in texts]) - wanted)) < 1e-3


def test_shapes_of_long_words_are_whole():
    terms = quality_knn.Terms()
    assert terms[b"a" * 70 + b"9-9"][1] == terms[b"b" * 3 + b"7-77"][1] != terms[b"a" * 70][1]
    for n in range(3 * quality_knn.CACHED_BYTES >> 20):
        terms[b"%d-" % n + b"x" * (1 << 20)]
        assert sum(map(len, terms)) <= quality_knn.CACHED_BYTES + (2 << 20)


def test_quality_edges(spark, small, edges):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    model = quality_knn.fit(spark.read.parquet(f"{small}/documents.parquet"), labels)
    got = quality_knn.score_documents(edges, model, keep=tuple(edges.columns))
    assert got.columns == [*edges.columns, "_score"] or len(got.columns) == len(edges.columns) + 1
    rows = got.toDF(*(f"x{i}" for i in range(len(got.columns)))).collect()
    assert Counter((r[0], r[1]) for r in rows) == Counter(pairs(edges))
    assert all(math.isclose(r[-1], model.prior) for r in rows if not (r[1] or "").split())
    assert quality_knn.score_documents(empty(edges), model).count() == 0
    nobody = quality_knn.fit(edges.select("doc_id", "text"), empty(labels))
    assert {r[-1] for r in quality_knn.score_documents(edges, nobody).collect()} == {0.5}


# 6


def test_secrets_query(spark, small, texts):
    for r in QUERIES["op6_secrets"](spark, small).collect():
        spans, counts = plain.secrets(texts[r.doc_id])
        assert ([r.n_assign, r.n_access, r.n_hex], r.base_sha256) == (counts, hashlib.sha256(spans.encode()).hexdigest())
        assert set(spans.split(",")) - {""} <= set(r.spans.split(","))


def test_secrets_edges(spark, edges):
    rng = random.Random(8)
    parts = ["password", "PassWD", "token", "secret", "api_key", "ApiKey", "=", ":", " ", '"', "'", "abcdef012345", "AKIA", "ABCDEFGHIJKLMN0123", "🙂", "short", "0123456789abcdef", "\n", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN ", "PRIVATE KEY-----", "ghp_", "ghx_", "a1B2" * 9, "eyJhbGciOiJI", "eyJzdWIiOiIx", ".", "c2lnbmF0dXJl"]
    rows = [(100 + n, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for n in range(400)]
    rows += [(600 + n, rng.choice(["x", " ", ""]) + "".join(rng.choice(group) for _ in range(5))) for n, group in enumerate([parts[-10:-7], parts[-7:-4]] * 60)]
    rows += [(800 + n, "".join([rng.choice(["", "x"]), "eyJhbGciOiJI", rng.choice("..,"), "eyJzdWIiOiIx", rng.choice(["..", ".", ""]), "c2lnbmF0dXJl"])) for n in range(40)]
    rows.append((999, "0123456789abcdef z🙂 " * 700))  # more matches than are gathered at once
    docs = edges.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    got = secrets.find_secrets(docs)
    kinds = [r.kind for r in secrets.RULES]
    found = Counter((r.doc_id, *(r[f"n_{k}"] for k in kinds), r.spans) for r in got.select("*", secrets.span_text(F.col("found"), secrets.RULES).alias("spans")).collect())
    wanted, total = Counter(), np.zeros(len(kinds), int)
    for i, t in pairs(docs):
        spans, counts = plain.secrets(t, plain.SECRETS + plain.MORE_SECRETS)
        wanted[i, *counts, spans] += 1
        total += counts
    assert found == wanted and total.min() > 3
    assert secrets.find_secrets(empty(edges)).count() == 0


def test_trigram_queries():
    query = secrets.trigram_query
    assert query(r"(abcd|xyz)[0-9]+") == [frozenset({"abc", "bcd"}), frozenset({"xyz"})]
    assert query(r"colou?r") == [frozenset({"col", "olo", "lor"}), frozenset({"col", "olo", "lou", "our"})]
    assert query(r"[0-9a-f]{16,}") is None and query(r"ab|abcd") is None
    assert query(r"(?i)TOKEN\s*=") == [frozenset({"tok", "oke", "ken"})]


def test_secret_plan_has_no_python(spark, small):
    plan = QUERIES["op6_secrets"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


# 7


def test_mixing_edges(spark, edges):
    got = mixing.plan_mix(edges).collect()
    sizes = defaultdict(int)
    source = {(r.doc_id, r.text): r.source for r in edges.collect()}
    for r in got:
        sizes[r.sk] += r.size
        assert 0 <= r.times <= 3 and len(r.shards) == r.times and r.size * r.times <= 3 * r.size
    assert sum(sizes.values()) == sum(len(plain.words(t)) for _, t in pairs(edges)) and len(source) > 1
    assert math.isclose(sum({r.sk: r.target for r in got}.values()), sum(sizes.values()))
    assert all(r.source_size == sizes[r.sk] and r.target <= 3 * r.source_size + 1e-9 for r in got)
    mixed = mixing.mix(edges)
    assert mixed.columns == [*(c for c in edges.columns if c != "mix_order"), "mix_shard", "mix_order"]
    assert mixed.count() == sum(r.times for r in got)
    again = mixing.plan_mix(edges.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    assert mixing.plan_mix(empty(edges)).count() == 0 and mixing.mix(empty(edges)).count() == 0


def one_word_blocks(spark, quotas):
    """Sources of ``mixing.BLOCKS`` blocks of one word, of which so many words are wanted."""
    blocks = spark.createDataFrame([(sk, b, 1) for sk in quotas for b in range(mixing.BLOCKS)], "sk string, block int, words long")
    return blocks, spark.createDataFrame([(sk, mixing.BLOCKS, float(n)) for sk, n in quotas.items()], "sk string, source_size long, target double")


def nearness(rows, source_of):
    """By source: words taken, target, and the largest document's words."""
    taken, target, largest = Counter(), {}, Counter()
    for r in rows:
        source = source_of[r.doc_id]
        taken[source] += r.taken
        target[source] = r.target
        largest[source] = max(largest[source], r.size)
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0
    return [(taken[s], target[s], largest[s]) for s in target]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_taken_words_come_near_their_targets(spark, folder):
    sf_dir = f"/root/testdata/{folder}"
    source_of = {r.doc_id: r.source for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source").collect()}
    found = nearness(QUERIES["op7_mixing"](spark, sf_dir).collect(), source_of)
    assert all(abs(taken - target) <= largest / 2 + 1 for taken, target, largest in found)
    assert folder != "sf0.1" or all(abs(taken - target) <= 0.02 * target for taken, target, _ in found)


def test_splitting_tree_deals_all_blocks_evenly(spark):
    quotas = {"a": 1000, "b": 37, "c": 0, "d": 1, "e": 2 * mixing.BLOCKS + 5}
    drawn = mixing.drawn_blocks(*one_word_blocks(spark, quotas)).cache()
    rows = [tuple(r)[:3] for r in drawn.collect()]
    assert Counter(sk for sk, _, _ in rows) == {k: v for k, v in quotas.items() if v} and len(set(rows)) == len(rows)
    assert {(e, b) for sk, e, b in rows if sk == "e" and e < 2} == {(e, b) for e in (0, 1) for b in range(mixing.BLOCKS)}
    dealt = [tuple(r) for r in mixing.splitting_tree(drawn).collect()]
    assert sorted(r[:3] for r in dealt) == sorted(rows)
    dealt = [(*r[:3], r[4]) for r in dealt]
    per_shard = Counter(r[3] for r in dealt)
    assert sorted(per_shard) == list(range(8)) and max(per_shard.values()) - min(per_shard.values()) <= 3
    spread = Counter(r[3] for r in dealt if r[0] == "a")
    assert 90 < min(spread.values()) and max(spread.values()) < 165
    # the blocks of a partial pass and of a shard are no run of numbers
    assert len([b for sk, e, b in rows if (sk, e) == ("a", 0) and b < 512]) < 512 and len({r[2] % 2 for r in dealt if r[3] == 0}) == 2


def test_splits_are_hypergeometric(spark):
    """How many of a source's blocks go left varies as drawing without replacement does."""
    drawn = mixing.drawn_blocks(*one_word_blocks(spark, {"a": 300, "b": 700})).cache()
    left = [mixing.splitting_tree(drawn, 2, seed).where("shard = 0 and sk = 'a'").count() for seed in range(30)]
    variance = 500 * 0.3 * 0.7 * 500 / 999
    assert abs(np.mean(left) - 150) < 4 * (variance / 30) ** 0.5 and 0.4 < np.var(left) / variance < 2


def test_mixing_plan_has_no_python(spark, small):
    plan = QUERIES["op7_mixing"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


# 8


def test_lattice_query(spark, small, texts):
    got = QUERIES["op8_lattice_lm"](spark, small).collect()
    tokens = {i: [*plain.words(t), None] for i, t in texts.items()}
    counts = Counter(w for i, ws in tokens.items() if plain.fold(i, 5) != 1 for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    for r in got:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (plain.fold(r.doc_id, 5) == 1, len(tokens[r.doc_id]), sum(counts[w] > 0 for w in tokens[r.doc_id]), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0


def test_lattice_edges(edges):
    vocabulary = public_tokenizers.path(lattice_lm.VOCABULARY)
    got = lattice_lm.lattice_scores(edges, vocabulary).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in pairs(edges))
    assert len({r.score for r in got if r.doc_id in (1, 5)}) == 1 and all(math.isfinite(r.score) and r.score < 0 for r in got)
    assert lattice_lm.lattice_scores(empty(edges), vocabulary).count() == 0
    held = edges.where("doc_id = 7 and false or crc32(cast(cast(doc_id as string) as binary)) % 5 = 1")
    assert {(r.train_tokens, r.base_score) for r in lattice_lm.lattice_scores(held, vocabulary).collect()} <= {(0, 0.0)}


def test_lattice_scores_match_a_plain_statement(spark, texts):
    """Refitted weights, the arc over whole words and the end, over part of the documents."""
    rows = sorted(texts.items())[:40] + [(1000, "élan 🙂x THE the"), (1001, "")]
    pieces = lattice_lm.Pieces(public_tokenizers.path(lattice_lm.VOCABULARY))
    wanted = plain.lattice_scores([plain.words(t) for _, t in rows], [plain.fold(i, 5) != 1 for i, _ in rows], pieces, lattice_lm.PRIOR)
    got = lattice_lm.lattice_scores(spark.createDataFrame(rows, "doc_id long, text string"), public_tokenizers.path(lattice_lm.VOCABULARY))
    found = {r.doc_id: r.score for r in got.collect()}
    for (i, _), score in zip(rows, wanted, strict=True):
        assert math.isclose(found[i], score, rel_tol=1e-6)


def test_forward_sums_all_segmentations():
    pieces = lattice_lm.Pieces(public_tokenizers.path(lattice_lm.VOCABULARY))
    log = np.log(pieces.first)

    def ways(text):
        if not text:
            return 1.0
        total = 0.0
        for j in range(1, len(text) + 1):
            found = pieces.numbers.get(text[:j])
            if found is not None:
                total += pieces.first[found] * ways(text[j:])
            elif j == 1:
                total += math.prod(pieces.first[pieces.bytes[b]] for b in text[0].encode()) * ways(text[1:])
        return total

    words = ["the", "thonre", "élan", "🙂x", "a", "internationally"]
    found = lattice_lm.Lattice(pieces, [w.encode() for w in words]).forward(log)
    assert np.allclose(found, [math.log(ways("▁" + w)) for w in words], rtol=1e-9)
    uses = lattice_lm.Lattice(pieces, [b"thonre", b"the", b"internationally"]).expectations(log, np.array([2, 1, 3]))
    assert math.isclose(sum(v * len(pieces.names[p]) for p, v in enumerate(uses)), 2 * 7 + 4 + 3 * 16, rel_tol=1e-9)
    long = b"0123456789abcdef" * 500 + b"\xff\xfe"
    assert np.isfinite(lattice_lm.Lattice(pieces, [long, b"x"]).forward(log)).all()


def test_batches_hold_every_word_once():
    words = [b"a" * (n % 7 + 1) + str(n).encode() for n in range(300)] + [b"z" * 5000]
    for at_once in (10, 200, 1 << 20):
        parts = list(lattice_lm.batched(words, at_once))
        assert sorted(np.concatenate(parts).tolist()) == list(range(len(words))) and all(len(p) for p in parts)
    assert not list(lattice_lm.batched([], 10))


# 9


def test_audio_query(spark, small, texts):
    for r in QUERIES["op9_audio"](spark, small).collect():
        raw = (texts[r.doc_id] or "").encode()
        payload = raw + b"\0" * (-len(raw) % 64 if raw else 64)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(payload) + 44, hashlib.sha256(audio.to_wav(payload)).hexdigest())


def test_audio_edges(edges):
    got = audio.audio_features(audio.encode_audio(edges)).collect()
    assert Counter((r.doc_id, r.n_bytes) for r in got) == Counter((i, len((t or "").encode())) for i, t in pairs(edges))
    assert len({r.feature for r in got if r.doc_id in (1, 5)}) == 1
    for r in got:
        stored = audio.read_tensors(r.tensors)
        assert stored.num_rows == r.n_tensors and stored.schema.field("tensor").type.shape == [audio.WINDOW, audio.MELS]
        assert all(a < b for a, b in zip(stored["start"].to_pylist(), stored["end"].to_pylist(), strict=True)) and all(a < b for a, b in r.active_spans)
    assert audio.audio_features(audio.encode_audio(empty(edges))).count() == 0


def test_audio_analyses_every_sample():
    tools = audio.resampling_filter(), audio.mel_bank(), audio.frame_window()
    for size in (64, 640, 704, 896, 960, 1024, 5440, 6144):
        quiet = bytes([128]) * size
        for at in (0, size - 1):
            tensors, times, _, _ = audio.analyse(quiet, *tools)
            changed, _, _, _ = audio.analyse(quiet[:at] + b"\xff" + quiet[at + 1 :], *tools)
            frames = np.flatnonzero((tensors != changed).reshape(-1, audio.MELS).any(axis=1))
            wanted = 0 if at == 0 else max(0, math.ceil((size * audio.UP / audio.DOWN - audio.FRAME) / audio.HOP))
            assert wanted in frames
            assert times[0][0] == 0 and times[-1][1] == size / audio.RATE and all(a[1] == b[0] for a, b in zip(times, times[1:], strict=False))
    loud = np.random.default_rng(1).integers(0, 256, 640).astype(np.uint8).tobytes()
    _, _, active, _ = audio.analyse(bytes([128]) * 1280 + loud, *tools)
    assert active[-1][1] == 1920 / audio.RATE
    one, two = bytes([128]) * 683 + bytes(277), bytes([128]) * 683 + loud[:277]
    assert audio.analyse(one, *tools)[3] != audio.analyse(two, *tools)[3]


def test_audio_matches_a_plain_statement(spark, texts):
    """Tensors as stored, their spans and the active ones, against sums written out."""
    rows = [(i, t[:2500]) for i, t in sorted(texts.items())[:6]] + [(-1, "quiet " * 300 + "ÿ\x01~" * 200), (-2, "")]
    for r in audio.audio_features(audio.encode_audio(spark.createDataFrame(rows, "doc_id long, text string"))).collect():
        mel, active = plain.log_mel(bytes(r.payload))
        stored = audio.read_tensors(r.tensors)
        flat = stored["tensor"].combine_chunks().to_numpy_ndarray().reshape(-1, audio.MELS)
        assert np.allclose(flat[: len(mel)], mel, atol=2e-3) and not flat[len(mel) :].any() and len(flat) - len(mel) < audio.WINDOW
        assert np.allclose(np.array(r.active_spans).ravel(), np.array(active).ravel(), atol=1e-6)
        assert stored["start"].to_pylist() == [n * audio.WINDOW * 128 / 3000 for n in range(r.n_tensors)] and math.isclose(stored["end"][-1].as_py(), len(r.payload) / audio.RATE)
        said = dict(part.split("=") for part in r.feature.split(";"))
        assert (said["frames"], said["active"]) == (str(len(mel)), str(len(active))) and math.isclose(float(said["seconds"]), sum(b - a for a, b in active), abs_tol=1e-3)
        for name, values in (("mean", mel.mean(axis=0)), ("std", mel.std(axis=0))):
            assert np.allclose([float(v) for v in said[name].split(",")], values, atol=2e-3)


def test_resampling_keeps_tones_and_drops_high_ones():
    phases, t = audio.resampling_filter(), np.arange(4000)
    level = lambda hz: np.std(audio.resample(np.sin(2 * np.pi * hz * t / audio.RATE).astype(np.float32), phases)[50:-50])
    assert level(200) > 0.6 and level(3500) < 0.05
    assert len(audio.resample(np.zeros(64, np.float32), phases)) == 24


def test_wav_is_read_by_the_standard_library():
    import io
    import wave

    payload = bytes(range(64))
    with wave.open(io.BytesIO(audio.to_wav(payload))) as f:
        assert (f.getsampwidth(), f.getnchannels(), f.readframes(64)) == (1, 1, payload)


# 10


def share(a, b):
    if not a or not b:
        return float(a == b)
    return sum(a[i : i + 8] == b[i : i + 8] for i in range(0, len(a), 8)) / (len(a) // 8)


def plain_print(text):
    return plain.order_fingerprint(text, order_minhash.K, order_minhash.PICK, order_minhash._A.tolist(), order_minhash._B.tolist())


def check_neighbours(rows, fingerprint=None):
    """rows: (doc_id, text) in descending order."""
    own_print = fingerprint or (lambda t: order_minhash.fingerprint(order_minhash.code_points(t.encode())).astype(">u4").tobytes().hex())
    for n, (i, text) in enumerate(rows):
        text, after = text or "", rows[(n + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own, changed, following = own_print(text), own_print(edited), own_print(after)
        yield (i, len(text), hashlib.sha256(edited.encode()).hexdigest(), own, changed, share(own, changed), share(own, following))


def test_order_fingerprints_match_a_plain_statement(spark, texts):
    rows = [(i, t[:3000]) for i, t in sorted(texts.items(), reverse=True)[:12]] + [(-1, "ababababab" * 30), (-2, "short"), (-3, ""), (-4, "Ünï 🙂 " * 9)]
    got = order_minhash.neighbour_fingerprints(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter(map(tuple, got)) == Counter(check_neighbours(rows, plain_print))


def test_order_minhash_query(spark, small, texts):
    got = QUERIES["op10_order_minhash"](spark, small).collect()
    rows = sorted(texts.items(), reverse=True)
    assert Counter(map(tuple, got)) == Counter(check_neighbours(rows))
    assert np.mean([r.near_edited for r in got]) > 0.15 and np.mean([r.near_next for r in got]) < 0.05
    assert all(math.isclose(r.near_edited, share(r.fingerprint, r.edited_fingerprint)) for r in got)


def test_order_minhash_edges(spark, edges):
    rows = edges.select("doc_id", "text").orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64(F.col("text").cast("binary")), F.col("text")).collect()
    got = order_minhash.neighbour_fingerprints(edges).collect()
    assert Counter(map(tuple, got)) == Counter(check_neighbours([tuple(r) for r in rows]))
    assert order_minhash.neighbour_fingerprints(empty(edges)).count() == 0
    alone = order_minhash.neighbour_fingerprints(edges.where("doc_id = 7")).first()
    assert alone.near_next == 1.0


def test_order_matters_and_equal_texts_agree():
    def of(text):
        return order_minhash.fingerprint(order_minhash.code_points(text.encode()))

    halves = ["".join(random.Random(s).choice("abcdefgh ") for _ in range(600)) for s in (1, 2)]
    whole, turned = of(halves[0] + halves[1]), of(halves[1] + halves[0])
    assert order_minhash.likeness(whole, of(halves[0] + halves[1])) == 1.0
    assert 0.2 < order_minhash.likeness(whole, turned) < 0.8  # the same k-mers in another order
    assert len(of("")) == 0 and len(of("ab")) == order_minhash.SKETCHES


def test_occurrence_numbers():
    h = np.array([5, 7, 5, 5, 7, 9], np.uint64) << np.uint64(40)
    assert order_minhash.occurrences(h).tolist() == [0, 0, 1, 2, 1, 0]
