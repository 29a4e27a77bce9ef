"""Groups whose members hang together by chance: what is compared and stored grows with the members."""

from __future__ import annotations

import numpy as np
import pytest

from lexloom.llm import linking

PAIRS = 600
MEMBERS = "group long, id long, payload binary, n long, weight long"


def _keys():
    def run(payloads: list[bytes]) -> np.ndarray:
        """Two keys for each member: its pair, and one that it shares with another pair."""
        pair = np.array([np.frombuffer(p, "<u8")[0] for p in payloads], np.uint64) // np.uint64(100)
        return np.stack([pair * np.uint64(2), pair // np.uint64(2) * np.uint64(2) + np.uint64(1)], axis=1)

    return run  # a function of its own, as workers cannot import this module


def _chain(spark, pairs=PAIRS):
    rows = []
    for i in range(2 * pairs):
        elements = np.arange(10) + 100 * (i // 2) + (i % 2)  # 9 of 11 in common within a pair
        rows.append((0, i, elements.astype("<u8").tobytes(), 2 * pairs, 20 * pairs))
    return spark.createDataFrame(rows, MEMBERS)


@pytest.fixture
def sent(monkeypatch):
    rows = []
    run = linking._run_tasks
    monkeypatch.setattr(linking, "_run_tasks", lambda members, matcher: rows.append(members.count()) or run(members, matcher))
    return rows


def test_a_chain_of_pairs_is_compared_key_by_key(spark, sent):
    found = linking.connect_groups(_chain(spark), linking.set_matcher(80), "chain", _keys(), chunk=64).collect()
    assert {(r.id, r.root) for r in found} == {(i, i // 2 * 2) for i in range(2 * PAIRS)}
    assert sum(sent) <= 5 * 2 * PAIRS


def test_keys_of_one_component_are_left_out(spark, sent):
    members = _chain(spark)
    roots = members.selectExpr("id", "id div 2 * 2 as root", "payload")
    left = linking.by_keys(roots, _keys(), "chain").select("group", "id", "n").collect()
    assert len({r.group for r in left}) == PAIRS // 2 and {r.n for r in left} == {4}


def test_few_chunks_of_members_apart_send_no_keys(spark, sent, monkeypatch):
    """Where they meet all chunks, they are sent less often than once for each of their keys."""
    monkeypatch.setattr(linking, "by_keys", None)
    found = linking.connect_groups(_chain(spark, 300), linking.set_matcher(80), "few", _keys(), chunk=64).collect()
    assert {(r.id, r.root) for r in found} == {(i, i // 2 * 2) for i in range(600)}
    assert sum(sent) <= (2 + 2 * linking.APART) * 600


def test_shared_keys(spark):
    rng = np.random.default_rng(8)
    rows = [(int(k), int(i)) for k, i in zip(rng.integers(0, 300, 500), rng.integers(0, 40, 500), strict=True)] + [(1000, i) for i in range(90)] + [(2000, 7)] * 30
    wanted = {(k, i) for k, i in rows if len({j for key, j in rows if key == k}) > 1}
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for n in (1, 3, 10_000):  # keys end within batches, and with them
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
            found = [(r.key, r.id) for r in linking.shared_keys(spark.createDataFrame(rows, "key long, id long")).collect()]
            assert len(found) == len(wanted) and set(found) == wanted
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
