"""Each stage of the pipeline on its own input, against plain versions."""

import hashlib
from collections import Counter

import corpus_pipeline as pipeline
import numpy as np
import plain
from test_operators import encoding

from lexloom.llm import mixing, quality_knn

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in pipeline.STAGES:
        out = pipeline.materialize(stage(spark, docs, FOLDER), f"test-{name}")
        seen[name] = (docs.collect(), out.collect())
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out

    before, after = seen["quality"]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r.doc_id for r in after}
    assert set(after) <= set(before) and all(r.doc_id in kept for r in before if label.get(r.doc_id) == 1)
    assert sum(label.get(i) == 0 for i in kept) <= 0.3 * sum(v == 0 for v in label.values()) + 1
    assert 0 < quality_knn.THRESHOLD < 1

    before, after = seen["line_dedup"]
    rows = sorted((r.doc_id, r.text) for r in before)
    wanted = {i: t for (i, old), t in zip(rows, plain.dedup_lines(rows), strict=True) if t.strip(" \t\r\n") or not old.strip(" \t\r\n")}
    assert {r.doc_id: r.text for r in after} == wanted and all(r.n_chars == len(r.text) for r in after)

    before, after = seen["near_dup"]
    groups = plain.near_duplicates([(r.doc_id, r.doc_id, r.text) for r in before], 5, 80)
    assert {r.doc_id for r in after} == {i for i, (_, c) in groups.items() if i == c}

    before, after = seen["mixing"]
    drawn, count = Counter(after), Counter(before)
    assert set(drawn) <= set(count) and max(drawn[r] / count[r] for r in drawn) <= mixing.MOST

    before, after = seen["bpe"]
    enc, wanted = encoding(), Counter()
    for r in before:
        ids = enc.encode_ordinary(r.text or "")
        wanted[r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in after) == wanted


def test_near_dup_stage_tells_rows_apart(spark):
    """Rows with equal ids or none: one row of every group stays, and a duplicate under a kept row's id goes."""
    one, two, three, four = (" ".join(f"{letter}{n}" for n in range(12)) for letter in "abcd")
    rows = [(1, one), (1, one), (2, one), (2, two), (None, three), (None, three), (4, four), (None, four), (3, None), (3, None)]
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], "doc_id long, text string, row string, c0 string, component_id string").repartition(3)
    out = pipeline.near_duplicates(spark, docs, FOLDER)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect()) == {(1, one): 1, (2, two): 1, (None, three): 1, (4, four): 1, (3, None): 2}


def test_stages_take_edges(spark, edges):
    """Nulls, empty and long texts, repeated rows and clashing columns go through every stage."""
    docs = edges
    for name, stage in pipeline.STAGES:
        out = pipeline.materialize(stage(spark, docs, FOLDER), f"edges-{name}")
        if name != "bpe":
            assert out.columns == edges.columns
            docs = out
    assert out.count() == docs.count()
    assert pipeline.tokens(spark, pipeline.mix(spark, docs.where("false"), FOLDER), FOLDER).count() == 0
