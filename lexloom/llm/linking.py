"""Linking members of candidate groups, and connected components, without pairs of all members.

``connect_groups`` connects what all links of a group's pairs connect. A group of up to ``chunk`` members is compared in one
task. A larger one is cut into chunks of CHUNK members (fewer if their sets are large). First each chunk is compared with
itself and with the first one; this sends every member to two tasks. What follows depends on the components of those links:

* If the members outside the group's largest component fill few chunks (APART at most), they are compared with all chunks, which
  sends every member to twice as many more tasks at most. So all pairs are compared that could join two components.
* Else the group is a chain of members that have little in common, as grows with any corpus: two texts that share one key each
  with a third. To send its members to all chunks would take the power 1.5 of its size. They are compared where
  they met instead: with all members that have a key in common, in groups of their own, so that a pair is missed exactly
  if it never met. Keys whose members are one component already are left out, and of keys with equal members one is taken.
  What is stored is in proportion to the members.

A key with very many members is a group of about sqrt(n) chunks at most, and its members outside its largest component meet all
of them. Rows are members, never pairs, and no task holds a whole group.

``components`` is union-find in rounds: a large-star step over all edges, then a union-find within every task over the
edges of its nodes, which does what a small-star step does and more. Each round's edges are written to the shared folder; a
hub's many edges meet its label in a join that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lexloom.llm.common import frugal, gather, rows_of
from lexloom.session import ship
from lexloom.sources.scratch import materialize

EDGES_A_TASK = 500_000  # of a graph whose components are sought
NODES_HELD = 200_000  # that a task joins at a time
CHUNK = 256  # members of a chunk; in a key's group the root of its size if that is more
KEYED_BYTES = 1 << 17  # of payloads whose keys are taken at a time, unless one has more
APART = 4  # chunks of members outside a group's largest component, up to which they meet all chunks; a member has more keys
CHUNK_WEIGHT = 2_000_000  # elements of a chunk's sets, unless one set has more

#: Takes the members' payloads; returns a function that gives, for one member and others, which of those it links to.
Matcher = Callable[[list[bytes]], Callable[[int, np.ndarray], np.ndarray]]
#: Takes members' payloads; returns a row of 64-bit keys for each: those by which members met.
Keys = Callable[[list[bytes]], np.ndarray]


def hashed_sets(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Payloads that are 64-bit hashes: all of them, and how many each payload has."""
    return np.frombuffer(b"".join(payloads), "<u8"), np.array([len(p) // 8 for p in payloads], np.int64)


def set_matcher(percent: int, hashes_of: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]] = hashed_sets) -> Matcher:
    """Payloads stand for sets, whose elements' hashes ``hashes_of`` gives; linked if 100 * |both| >= percent * |either|."""

    def prepare(payloads: list[bytes]):
        hashes, counts = hashes_of(payloads)
        # elements numbered from 0, then each member's distinct ones
        order = np.argsort(hashes)
        ranked = hashes[order]
        number = np.empty(len(hashes), np.int64)
        number[order] = np.cumsum(np.concatenate([[False], ranked[1:] != ranked[:-1]]))
        pairs = (np.repeat(np.arange(len(counts)), counts) << 32) | number
        pairs.sort()
        pairs = pairs[np.concatenate([[True], pairs[1:] != pairs[:-1]])]
        flat = pairs & 0xFFFFFFFF
        sizes = np.bincount(pairs >> 32, minlength=len(counts))
        starts = np.cumsum(sizes) - sizes
        mark = np.zeros(int(flat.max()) + 1, np.int32)

        def linked(i: int, others: np.ndarray) -> np.ndarray:
            out = np.zeros(len(others), bool)
            # sets whose sizes are too far apart cannot be that similar
            near = (100 * sizes[others] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[others])
            some = others[near]
            if not len(some):
                return out
            own = flat[starts[i] : starts[i] + sizes[i]]
            mark[own] = 1
            ends = np.cumsum(sizes[some])
            shared = np.add.reduceat(mark[flat[gather(starts[some], sizes[some])]], ends - sizes[some])
            mark[own] = 0
            out[near] = 100 * shared >= percent * (sizes[i] + sizes[some] - shared)
            return out

        return linked

    return prepare


def spanning_links(ids: list[int], payloads: list[bytes], leads: int, matcher: Matcher, roots: list[int]) -> list[tuple[int, int]]:
    """Links (larger id, smaller id) that connect what all links of the first ``leads`` members connect, beyond equal roots."""
    label, out = np.unique(np.array(roots, np.int64), return_inverse=True)[1], []
    if label.max() == 0:
        return out
    linked = matcher(payloads)
    for i in range(leads):
        others = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        if not len(others):
            continue
        hits = others[linked(i, others)]
        found, first = np.unique(label[hits], return_index=True)
        if len(found):
            out += [(max(ids[i], ids[j]), min(ids[i], ids[j])) for j in hits[first].tolist() if ids[i] != ids[j]]
            label[np.isin(label, found)] = label[i]
    return out


def _link(matcher: Matcher):
    """Over rows sorted by task and role: links within each task's rows."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, payloads, roots, leads = None, [], [], [], 0

        def done() -> list[tuple[int, int]]:
            return spanning_links(ids, payloads, leads, matcher, roots) if len(ids) > 1 else []

        for batch in batches:
            links = []
            for group, j, k, role, node, payload, root in rows_of(batch, "group", "j", "k", "role", "id", "payload", "root"):
                if (group, j, k) != key:
                    links += done()
                    key, ids, payloads, roots, leads = (group, j, k), [], [], [], 0
                ids.append(node)
                payloads.append(payload)
                roots.append(root)
                leads += role == 0
            yield _edges(links)
        yield _edges(done())

    return run


def _edges(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], ["a", "b"])


def _run_tasks(rows: DataFrame, matcher: Matcher) -> DataFrame:
    tasks = rows.repartition("group", "j", "k").sortWithinPartitions("group", "j", "k", "role", "id")
    return tasks.mapInArrow(_link(matcher), "a long, b long")


def _keyed(keys_of: Keys):
    """Members -> (key, id, root, size), a row for each of a member's keys."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: list[tuple]) -> pa.RecordBatch:
            keys = keys_of([h[2] for h in held])
            each = [np.repeat(np.array(v, np.int64), keys.shape[1]) for v in ([h[0] for h in held], [h[1] for h in held], [len(h[2]) for h in held])]
            return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(keys).ravel().view(np.int64)), *map(pa.array, each)], ["key", "id", "root", "size"])

        held, size = [], 0
        for batch in batches:
            for row in rows_of(batch, "id", "root", "payload"):
                held.append(row)
                size += len(row[2])
                if size >= KEYED_BYTES:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)

    return run


def by_keys(members: DataFrame, keys_of: Keys, tag: str) -> DataFrame:
    """(id, root, payload, weight) -> members of ``connect_groups``, a group for each key that joins two components or more."""
    rows = materialize(members.select("id", "root", "payload").mapInArrow(_keyed(keys_of), "key long, id long, root long, size long").distinct(), f"{tag}-keys")
    groups = materialize(distinct_groups(rows), f"{tag}-mixed")
    placed = rows.select("key", "id").join(groups, "key")
    return members.select("id", "payload", "root").join(placed, "id").select(F.col("key").alias("group"), "id", "payload", "root", "n", "weight")


def distinct_groups(rows: DataFrame) -> DataFrame:
    """(key, id, root, size) -> (key, n, weight): keys that join two components or more, one of those with equal members."""
    mixed = rows.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("weight"), F.min("root").alias("low"), F.max("root").alias("high"), F.min("id").alias("first"), F.max("id").alias("last"), *(F.sum(F.xxhash64("id", F.lit(i)).cast("decimal(38,0)")).alias(f"sum{i}") for i in (2, 3)))
    # keys of equal members are told by two sums of hashes
    groups = mixed.where("low < high").groupBy("n", "first", "last", "sum2", "sum3").agg(F.min("key").alias("key"), F.first("weight").alias("weight"))
    return groups.select("key", "n", "weight")


def connect_groups(members: DataFrame, matcher: Matcher, tag: str, keys_of: Keys | None = None, chunk: int = CHUNK, known: DataFrame | None = None) -> DataFrame:
    """members: (group, id, payload, n, weight): n is the group's number of members, weight of elements of all their sets.

    A task holds two chunks, of about CHUNK_WEIGHT elements at most. ``keys_of`` gives the keys by which members met; without
    it all pairs of a group are compared, whatever the group. ``known`` (a, b) are links that hold; then members also have the
    root that these give them, and members of one root are not compared.

    (id, root): every member that a link joins to another, with the smallest member of its component.
    """
    ship(members.sparkSession)
    size = F.greatest(F.lit(float(chunk)), F.sqrt("n")) if keys_of is None else F.when(F.col("n") > chunk, float(CHUNK)).otherwise(float(chunk))
    chunks = F.greatest(F.ceil(F.col("n") / size), F.least("n", F.ceil(F.col("weight") / F.lit(float(CHUNK_WEIGHT)))))
    chunked = members.where("n > 1").withColumn("m", chunks.cast("int"))
    if known is None:
        chunked = chunked.withColumn("root", F.col("id"))
    chunked = chunked.withColumn("c", F.pmod(F.xxhash64("id"), F.col("m")).cast("int"))
    own = chunked.select("group", F.col("c").alias("j"), F.lit(0).alias("k"), F.lit(0).alias("role"), "id", "payload", "root")
    first = chunked.where("m > 1 and c = 0").select("group", F.explode(F.expr("sequence(1, m - 1)")).alias("j"), F.lit(0).alias("k"), F.lit(1).alias("role"), "id", "payload", "root")
    links = _run_tasks(own.unionByName(first), matcher)
    roots = components(links if known is None else links.unionByName(known), tag)
    large = chunked.where("m > 1").drop("root")
    # a member of several groups stands once in ``roots``
    placed = large.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    placed = materialize(placed.select("group", "id", "payload", "m", "c", "root"), f"{tag}-large")
    leading = placed.groupBy("group", "m", "root").count().groupBy("group", "m").agg(F.max_by("root", F.struct("count", "root")).alias("lead"), F.sum("count").alias("n"), F.max("count").alias("top"))
    # members outside the largest component, in chunks of the same size
    outside = leading.where("n > top").select("group", "lead", F.ceil((F.col("n") - F.col("top")) * F.col("m") / F.col("n")).cast("int").alias("ms"))
    outside = materialize(outside, f"{tag}-outside")
    if outside.isEmpty():
        return roots
    known = roots.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    scattered = outside.where(F.col("ms") > APART).select("group")
    if keys_of is not None and not scattered.isEmpty():
        apart = placed.join(scattered, "group", "left_semi")
        met = connect_groups(materialize(by_keys(apart, keys_of, tag), f"{tag}-met"), matcher, f"{tag}-met", chunk=chunk, known=known)
        known = met.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
        outside = outside.where(F.col("ms") <= APART)
    apart = placed.join(outside, "group").withColumn("s", F.pmod(F.xxhash64("id", F.lit(1)), F.col("ms")).cast("int"))
    stragglers = apart.where("root <> lead").select("group", F.explode(F.expr("sequence(0, m - 1)")).alias("j"), F.col("s").alias("k"), F.lit(0).alias("role"), "id", "payload", "root")
    others = apart.select("group", F.col("c").alias("j"), F.explode(F.expr("sequence(0, ms - 1)")).alias("k"), F.lit(1).alias("role"), "id", "payload", "root")
    more = _run_tasks(stragglers.unionByName(others), matcher)
    return components(more.unionByName(known), f"{tag}-more")


def components(links: DataFrame, tag: str) -> DataFrame:
    """(id, root): every node of ``links`` (a, b), with the smallest node of its component."""
    ship(links.sparkSession)

    def stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
        seen = Observation()
        contracted = edges.mapInArrow(_contract, "a long, b long")
        out = materialize(contracted.observe(seen, F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")), f"{tag}-edges")
        return out, (seen.get.get("n", 0), seen.get.get("sum"))

    edges, now = stored(links)
    before = None
    while now[0] and now != before:
        # the smaller the graph, the fewer tasks it is worth
        tasks = -(-now[0] // EDGES_A_TASK)
        # large-star: each node's larger neighbours move to its smallest neighbour. The smallest comes from an aggregate
        # that is combined before its shuffle, and a hub's many neighbours meet it in a join that can be split.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")).coalesce(tasks), f"{tag}-low")
        large = edges.withColumnRenamed("b", "u").join(smallest.withColumnRenamed("a", "u"), "u").select("a", F.col("low").alias("b")).coalesce(tasks)
        before = now
        # a node's edges come together, so that contracting leaves it one
        edges, now = stored(large.repartition("a").sortWithinPartitions("a", "b").coalesce(tasks))
    # a star for each component: every node but the root has one edge, to the root
    centres = edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct().coalesce(max(1, -(-now[0] // EDGES_A_TASK)))
    return materialize(edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(centres), f"{tag}-roots")


@frugal
def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges -> stars that connect the same nodes, as far as the task knows them: (node, smallest).

    Union-find over up to NODES_HELD nodes. When they are told and forgotten, the last edge's node is taken along, so a
    node whose edges come together ends with all of them joined.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x], x = root, up
        return root

    def stars() -> pa.RecordBatch:
        nodes = [x for x in parent if find(x) != x]
        return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([parent[x] for x in nodes], pa.int64())], ["a", "b"])

    for batch in batches:
        for a, b in rows_of(batch, "a", "b"):
            low, high = sorted((find(a), find(b)))
            parent.setdefault(low, low)
            parent[high] = low
            if len(parent) > NODES_HELD:
                yield stars()
                last = find(a)
                parent = {last: last, a: last}
    if parent:
        yield stars()


def key_links(pairs: DataFrame) -> DataFrame:
    """(key, id) -> (a, b): every id of a key with one of that key's ids, which connects what shares a key.

    A key's rows stream past in order; only one of its ids is held.
    """
    ship(pairs.sparkSession)
    return pairs.repartition("key").sortWithinPartitions("key").mapInArrow(_to_one, "a long, b long")


@frugal
def _to_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held_key, one = None, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys, ids = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("key", "id"))
        begins = np.concatenate([[held_key is None or keys[0] != held_key], keys[1:] != keys[:-1]])
        ones = np.concatenate([[one], ids[begins]])[np.cumsum(begins)]
        held_key, one = keys[-1], ones[-1]
        wanted = ids != ones  # an id that several tasks sent stands there more than once
        yield pa.RecordBatch.from_arrays([pa.array(ids[wanted], pa.int64()), pa.array(ones[wanted], pa.int64())], ["a", "b"])


def shared_keys(pairs: DataFrame) -> DataFrame:
    """(key, id) -> the distinct ones of them whose key another id has too. Rows stream past in order; the last one is held."""
    ship(pairs.sparkSession)
    return pairs.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_shared, "key long, id long")


@frugal
def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, told = np.zeros((2, 0), np.int64), False  # the last row, and whether it is out
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = np.concatenate([held, [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("key", "id")]], axis=1)
        rows = rows[:, np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(axis=0)])]
        same = rows[0, 1:] == rows[0, :-1]
        wanted = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        held, ended = rows[:, -1:], bool(wanted[-1]) or (told and rows.shape[1] == 1)
        wanted[0] &= not told
        told = ended
        yield pa.RecordBatch.from_arrays([pa.array(rows[0, wanted]), pa.array(rows[1, wanted])], ["key", "id"])
