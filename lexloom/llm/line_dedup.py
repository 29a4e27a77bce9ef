"""Line dedup: near-equal lines by MinHash, one line kept per component.

Equal lines share a 64-bit hash and are one line from the start. Each distinct line's set of ``SHINGLE``-character
shingles has ``BANDS * ROWS`` minima; lines that agree in all rows of a band are candidates. Candidates form rough
components, within which full sets are compared exactly (in large ones that are mere chains, those of candidates): linked at a Jaccard similarity of ``PERCENT``/100. A distributed
union-find gives the final components. Of every component's lines the first one stays, by document id, then by a hash of
the document's text, then by place; the others leave their documents.

At a similarity of 0.8 a pair meets in some band with probability 0.998, at 0.85 with 0.9999.

Texts move once: documents are cut into blocks of about ``BLOCK_BYTES`` of text, stored in the shared folder and bucketed
by block (a task's blocks lie in one bucket, as one file). Lines are looked up in their blocks, and what leaves a document is brought to its block, so every join has hashes
and places on its moving side. A hot line is one row per block that holds it.

Cases: a null text stays null; blank lines are never compared and stay; white space at a line's ends is not compared;
of rows equal in id and text one keeps its lines, which one being undefined; null ids come after all others; a line
shorter than a shingle is one shingle; lines of any length, and documents of any number of lines, are compared whole; a
document may be left with no line (``drop_empty`` removes it, but never one that was blank before); an empty table gives
an empty table; all other columns pass through, and columns that hold the texts' length are the caller's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.common import block_numbers, frugal, gather, mix64, rows_of, seeds
from lexloom.llm.linking import components, connect_groups, key_links, set_matcher
from lexloom.llm.wordblocks import pack, unpack
from lexloom.session import ship
from lexloom.sources.scratch import materialize, materialize_bucketed

SHINGLE = 8  # characters; a power of two
PERCENT = 80
BANDS, ROWS = 12, 4
BLOCK_BYTES = 6_000_000
AT_ONCE = 1 << 17  # characters hashed at a time, unless one line is longer
SEEN = 1 << 18  # lines that a task remembers to have sent
EDGES = b" \t\r"  # not compared at a line's ends

_VALUES = BANDS * ROWS
_A = (seeds(_VALUES, 31) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_FOLDS = seeds(SHINGLE.bit_length(), 33) | np.uint64(1)
_BLOCKS = "block long, lines binary, texts binary, rest binary"


def line_shingles(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of all lines, with those that cross lines between them; each line's first and end."""
    chars = [line.decode("utf-8", "replace").ljust(SHINGLE, "\0") for line in lines]
    sizes = np.array([len(c) for c in chars], np.int64)
    h = np.frombuffer("".join(chars).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    width = 1
    with np.errstate(over="ignore"):
        for fold in _FOLDS[:-1]:  # from hashes of ``width`` characters to those of twice as many
            h = h[:-width] * fold + h[width:]
            width *= 2
        h = (h ^ (h >> np.uint64(32))) * _FOLDS[-1]
        h ^= h >> np.uint64(29)
    first = np.cumsum(sizes) - sizes
    return h, first, first + sizes - SHINGLE + 1


def shingle_hashes(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of all lines, and how many each line has."""
    h, first, end = line_shingles(lines)
    return h[gather(first, end - first)], end - first


def band_keys(lines: list[bytes]) -> np.ndarray:
    """lines x BANDS keys."""
    h, first, end = line_shingles(lines)
    x = (h >> np.uint64(32)).astype(np.uint32)
    # every second segment is what crosses from a line to the next; the last line has none
    cuts = np.stack([first, end], axis=1).ravel()[:-1]
    scaled, minima = np.empty_like(x), np.empty((_VALUES, len(lines)), np.uint64)
    for j in range(_VALUES):
        np.multiply(x, _A[j], out=scaled)
        minima[j] = np.minimum.reduceat(scaled, cuts)[::2]
    minima = minima.reshape(BANDS, ROWS, len(lines))
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None]
    with np.errstate(over="ignore"):
        for row in range(ROWS):
            keys = mix64(keys * np.uint64(0xD1342543DE82EF95) + minima[:, row])
    return keys.T


def line_node(line: bytes) -> int:
    """A line's hash, never 0, which stands for blank lines."""
    value = xxhash.xxh64_intdigest(line) or 1
    return value - (1 << 64) if value >> 63 else value


# blocks


def _to_ipc(batches: list[pa.RecordBatch]) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batches[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for batch in batches:
            out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_all().combine_chunks().to_batches(max_chunksize=None)[0]


def _cut(text_at: int, id_at: int, block_bytes: int, buckets: int):
    """Batches of rows, their text last as bytes -> blocks."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = block_numbers(TaskContext.get().partitionId(), buckets)
        held, size = [], 0

        def block() -> pa.RecordBatch:
            counts, nodes, lengths, ids, ties = [], [], [], [], []
            for part in held:
                ids.append(part.column(id_at))
                for raw in part.column(part.num_columns - 1):
                    raw = raw.as_py()
                    lines = [] if raw is None else [line.strip(EDGES) for line in raw.split(b"\n")]
                    counts.append(len(lines))
                    nodes += [line_node(line) if line else 0 for line in lines]
                    lengths += map(len, lines)
                    ties.append(xxhash.xxh64_intdigest(raw or b""))
            named = pa.chunked_array(ids).combine_chunks()
            arrays = (np.array(counts, np.uint32), np.array(nodes, np.int64), np.array(lengths, np.uint32), named.is_null().to_numpy(zero_copy_only=False).astype(np.uint8), named.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.array(ties, np.uint64).view(np.int64))
            columns = [i for i in range(held[0].num_columns - 1) if i != text_at]
            row = [[next(numbers)], [pack(*arrays)], [_to_ipc([p.select([p.num_columns - 1]) for p in held])], [_to_ipc([p.select(columns) for p in held])]]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, (pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)], ["block", "lines", "texts", "rest"])

        for batch in batches:
            sizes = np.cumsum([0, *(n or 0 for n in pa.compute.binary_length(batch.column(batch.num_columns - 1)).to_pylist())])
            at = 0
            while at < batch.num_rows:
                # up to and with the row that fills the block
                to = min(batch.num_rows, int(np.searchsorted(sizes, sizes[at] + block_bytes - size)))
                to = max(to, at + 1)
                held.append(batch.slice(at, to - at))
                size += int(sizes[to] - sizes[at])
                at = to
                if size >= block_bytes:
                    yield block()
                    held, size = [], 0
        if held:
            yield block()

    return run


def _numbered(docs: DataFrame) -> DataFrame:
    """Names of our own, so that no column of docs can clash with ours."""
    return docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))


def cut_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, lines, texts, rest): rows in blocks; ``lines`` packs line counts and hashes, ids and ties of all rows."""
    numbered = _numbered(docs)
    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")
    plain = numbered.withColumn(f"c{id_at}", F.col(f"c{id_at}").cast("long")).withColumn("raw", F.col(f"c{text_at}").cast("binary"))
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the text itself travels once, as bytes
    plain = plain.withColumn(f"c{text_at}", F.lit(None).cast("string"))
    return materialize_bucketed(plain.mapInArrow(_cut(text_at, id_at, block_bytes, buckets), _BLOCKS), "block", "line_blocks", compression="none")


def _line_starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])


@frugal
def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: set[int] = set()

    def out(lines: list[bytes], ids: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(band_keys(lines).ravel().view(np.int64)), pa.array(np.repeat(np.array(ids, np.int64), BANDS))], ["key", "id"])

    for batch in batches:
        for packed, texts in rows_of(batch, "lines", "texts"):
            nodes, at = unpack(packed)[1].tolist(), 0
            lines, ids, held = [], [], 0
            for raw in _from_ipc(texts).column(0):
                raw = raw.as_py()
                if raw is None:
                    continue
                for line in raw.split(b"\n"):
                    node = nodes[at]
                    at += 1
                    if node == 0 or node in seen:
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(node)
                    lines.append(line.strip(EDGES))
                    ids.append(node)
                    held += len(line)
                    if held >= AT_ONCE:
                        yield out(lines, ids)
                        lines, ids, held = [], [], 0
            if lines:
                yield out(lines, ids)


@frugal
def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks -> a row for each distinct line of a block: its first place there, and how often it stands there."""
    for batch in batches:
        for block, packed in rows_of(batch, "block", "lines"):
            counts, nodes, lengths, late, ids, ties = unpack(packed)
            starts = _line_starts(counts)
            rank = np.empty(len(counts), np.int64)
            rank[np.lexsort((np.arange(len(counts)), ties, ids, late))] = np.arange(len(counts))
            row = np.repeat(np.arange(len(counts)), counts)
            line = np.arange(len(nodes)) - starts[:-1][row]
            order = np.lexsort((line, rank[row], nodes))
            order = order[nodes[order] != 0]
            sorted_ = nodes[order]
            head = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]])) if len(order) else np.zeros(0, np.int64)
            first = order[head]
            of = row[first]
            n = np.diff(np.append(head, len(order)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[first]), pa.array(np.full(len(first), block, np.int64)), pa.array(n.astype(np.int32)), pa.array(late[of].astype(bool)), pa.array(ids[of]), pa.array(ties[of]), pa.array(line[first].astype(np.int32)), pa.array(of.astype(np.int32)), pa.array(lengths[first].astype(np.int64))],
                ["node", "block", "n", "late", "doc", "tie", "line", "row", "size"],
            )


@frugal
def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the lines wanted of them -> (group, id, payload, n, weight)."""
    for batch in batches:
        for texts, wanted in rows_of(batch, "texts", "wanted"):
            column, found, held, lines = _from_ipc(texts).column(0), [], -1, []
            for w in sorted(wanted, key=lambda w: w["row"]):
                if w["row"] != held:
                    held, lines = w["row"], column[w["row"]].as_py().split(b"\n")
                found.append((w["root"], w["id"], lines[w["line"]].strip(EDGES), w["n"], w["weight"]))
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], ["group", "id", "payload", "n", "weight"])


def near_lines(blocks: DataFrame, places: DataFrame) -> DataFrame:
    """(id, root): distinct lines that are linked with others, and their components' names."""
    met = key_links(blocks.select("lines", "texts").mapInArrow(_bands, "key long, id long"))
    rough = components(met, "lines-rough")
    # each line's first place and size in bytes; sizes bound what is compared in one task
    some = materialize(places.join(rough, F.col("node") == F.col("id")).groupBy("id", "root").agg(F.min(F.struct("block", "row", "line")).alias("at"), F.max("size").alias("size")), "lines-some")
    # written, as a join of two plain shuffles can be split where one component has many of the lines
    sizes = materialize(some.groupBy("root").agg(F.count("*").alias("n"), F.sum("size").alias("weight")), "lines-sizes")
    sized = some.join(sizes, "root")
    asked = sized.groupBy("at.block").agg(F.collect_list(F.struct("at.row", "at.line", "id", "root", "n", "weight")).alias("wanted"))
    compared = blocks.select("block", "texts").join(asked, "block").select("texts", "wanted").mapInArrow(_fetch, "group long, id long, payload binary, n long, weight long")
    return connect_groups(materialize(compared, "lines-compared"), set_matcher(PERCENT, shingle_hashes), "lines-exact", band_keys, chunk=1024)


def removed_lines(blocks: DataFrame) -> DataFrame:
    """(block, gone): hashes of lines that leave the block, each with the one place (row, line) where it stays, if it does."""
    placed = blocks.select("block", "lines").mapInArrow(_places, "node long, block long, n int, late boolean, doc long, tie long, line int, row int, size long")
    places = materialize_bucketed(placed.repartition("node"), "node", "line_places")
    roots = near_lines(blocks, places)
    order = F.struct("late", "doc", "tie", "line", "block", "row")
    total = places.groupBy("node").agg(F.min(order).alias("first"), F.sum("n").alias("n"))
    known = materialize(total.join(roots.withColumnRenamed("id", "node"), "node", "left").where("n > 1 or root is not null"), "lines-known")
    firsts = known.where("root is not null").groupBy("root").agg(F.min("first").alias("leader"))
    linked = known.where("root is not null").join(firsts, "root").select("node", F.col("leader").alias("first"))
    judged = known.where("root is null").select("node", "first").unionByName(linked)
    here = (F.col("block") == F.col("first.block")) & (F.col("row") == F.col("first.row")) & (F.col("line") == F.col("first.line"))
    gone = places.join(judged, "node").where(~here | (F.col("n") > 1))
    entry = F.struct("node", F.when(here, F.col("row")).otherwise(-1).alias("row"), F.when(here, F.col("line")).otherwise(-1).alias("line"))
    return gone.groupBy("block").agg(F.collect_list(entry).alias("gone"))


def _finish(text_at: int, width: int, drop_empty: bool):
    """Blocks with what leaves them -> their rows, in the columns' order, with counts of lines before and after."""

    @frugal
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed, texts, rest, gone in rows_of(batch, "lines", "texts", "rest", "gone"):
                counts, nodes, *_ = unpack(packed)
                starts, raws = _line_starts(counts), _from_ipc(texts).column(0)
                leaves = np.zeros(len(nodes), bool)
                if gone:
                    leaves = np.isin(nodes, np.array([g["node"] for g in gone], np.int64))
                    leaves[[starts[g["row"]] + g["line"] for g in gone if g["row"] >= 0]] = False
                row = np.repeat(np.arange(len(counts)), counts)
                tally = lambda mask: np.bincount(row[mask], minlength=len(counts)).astype(np.int64)
                before, after = tally(nodes != 0), tally((nodes != 0) & ~leaves)
                lost = tally(leaves) > 0
                out = []
                for i, raw in enumerate(raws):
                    raw = raw.as_py()
                    if lost[i]:
                        mask = leaves[starts[i] : starts[i + 1]].tolist()
                        raw = b"\n".join([line for line, go in zip(raw.split(b"\n"), mask, strict=True) if not go])
                    out.append(raw)
                binary = pa.array(out, pa.binary())
                text = pa.Array.from_buffers(pa.string(), len(binary), binary.buffers())  # as it came, valid UTF-8 or not
                columns = list(_from_ipc(rest).columns)
                columns.insert(text_at, text)
                result = pa.RecordBatch.from_arrays([*columns, pa.array(before), pa.array(after)], [*(f"c{i}" for i in range(width)), "n_lines", "n_kept"])
                if drop_empty:
                    result = result.filter(pa.array((after > 0) | (before == 0)))
                yield result

    return run


def dedup_lines(docs: DataFrame, drop_empty: bool = False, counts: bool = False) -> DataFrame:
    """docs (doc_id, text and any other columns) with the surviving lines as ``text``.

    With ``counts`` also n_lines and n_kept, the lines that were not blank before and after.
    """
    ship(docs.sparkSession)
    blocks = cut_blocks(docs)
    gone = removed_lines(blocks)
    kept = blocks.join(gone, "block", "left").select("lines", "texts", "rest", "gone")
    schema = _numbered(docs).withColumn(f"c{docs.columns.index('doc_id')}", F.lit(None).cast("long")).schema.add("n_lines", "long").add("n_kept", "long")
    found = kept.mapInArrow(_finish(docs.columns.index("text"), len(docs.columns), drop_empty), schema)
    columns = [F.col(f"c{i}").cast(f.dataType).alias(f.name) for i, f in enumerate(docs.schema.fields)]
    return found.select(*columns, *(["n_lines", "n_kept"] if counts else []))


def op3_line_dedup(spark, sf_dir) -> DataFrame:
    from lexloom.llm.common import table

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, counts=True).select("doc_id", "n_lines", "n_kept", "text")


#: Exact for tables with distinct ids: two lines that are similar enough share one of the rarest fifth of their shingles.
ORACLE = r"""
WITH RECURSIVE
lines AS (SELECT doc_id, n, raw, trim(raw, ' ' || chr(9) || chr(13)) AS line FROM (SELECT doc_id, unnest(ls) AS raw, generate_subscripts(ls, 1) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))),
nodes AS (SELECT row_number() OVER (ORDER BY first) AS id, line, first FROM (SELECT line, min({'late': doc_id IS NULL, 'd': doc_id, 'n': n}) AS first FROM lines WHERE line <> '' GROUP BY line)),
sets AS (SELECT id, list_distinct(list_transform(range(1, greatest(length(line) - 7, 1) + 1), lambda i: substr(line, i, 8))) AS s FROM nodes),
shingles AS (SELECT id, len(s) AS size, unnest(s) AS g FROM sets),
known AS (SELECT g, count(*) AS f FROM shingles GROUP BY g HAVING count(*) > 1),
ranked AS (SELECT id, size, s.g, row_number() OVER (PARTITION BY id ORDER BY coalesce(f, 1), s.g) AS nth FROM shingles s LEFT JOIN known k ON s.g = k.g),
rare AS (SELECT id, size, g FROM ranked WHERE nth <= size - (80 * size + 99) // 100 + 1),
met AS (SELECT DISTINCT a.id AS a, b.id AS b FROM rare a JOIN rare b ON a.g = b.g AND a.id < b.id AND 100 * a.size >= 80 * b.size AND 100 * b.size >= 80 * a.size),
links AS (SELECT a, b FROM (SELECT a, b, len(list_intersect(x.s, y.s)) AS shared, len(x.s) + len(y.s) AS total FROM met JOIN sets x ON x.id = a JOIN sets y ON y.id = b) WHERE 100 * shared >= 80 * (total - shared)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT id AS a, id AS b FROM nodes UNION SELECT r.a, e.b FROM reach r JOIN either e ON r.b = e.a),
roots AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
stays AS (SELECT n.line, f.first FROM nodes n JOIN roots r ON r.id = n.id JOIN nodes f ON f.id = r.root),
kept AS (SELECT l.doc_id, count(s.line) AS n_lines, count(s.line) FILTER (WHERE s.first = {'late': l.doc_id IS NULL, 'd': l.doc_id, 'n': l.n}) AS n_kept,
  string_agg(raw, chr(10) ORDER BY n) FILTER (WHERE s.line IS NULL OR s.first = {'late': l.doc_id IS NULL, 'd': l.doc_id, 'n': l.n}) AS text
  FROM lines l LEFT JOIN stays s ON s.line = l.line GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(k.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(k.n_kept, 0) AS BIGINT) AS n_kept, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id IS NOT DISTINCT FROM d.doc_id
"""
