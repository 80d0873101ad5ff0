import re
from collections import Counter

import numpy as np
import pytest

from flowplan.llm import mixing as M
from flowplan.llm.queries import QUERIES, table

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def brute_targets(sizes):
    """Resharing by hand, one source at a time."""
    order = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    fixed = {}
    while True:
        left = 1.5 * sum(sizes.values()) - sum(fixed.values())
        rest = [s for s in order if s not in fixed]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return fixed | share
        fixed |= {s: 2 * sizes[s] for s in over}


def check(rows, found):
    size = {}
    for i, (_, text, source) in enumerate(rows):
        size[i] = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    sizes = Counter()
    for i, r in enumerate(rows):
        sizes[r[2]] += size[i]
    goal = brute_targets(sizes)
    by_id = {r[0]: (size[i], r[2]) for i, r in enumerate(rows)}
    assert len(found) == len(rows)
    got, largest = Counter(), Counter()
    for r in found:
        n, source = by_id[r.doc_id]
        assert r.size == n and r.source_size == sizes[source] and r.target == pytest.approx(goal[source])
        assert r.taken in (0, n, 2 * n)
        got[source] += r.taken
        largest[source] = max(largest[source], n)
    for s in sizes:
        assert abs(got[s] - goal[s]) <= largest[s] / 2 + 1e-6, s


def test_quotas_are_split_exactly():
    quotas = np.asarray([1000, 3, 0, 517])
    for shards in (1, 2, 7, 64):
        counts = M.split_quotas(quotas, shards, 3)
        assert (counts.sum(0) == quotas).all() and (counts >= 0).all()
        assert counts.sum(1).max() - counts.sum(1).min() <= 1
        assert (counts == M.split_quotas(quotas, shards, 3)).all()


@pytest.mark.parametrize("blocks", [2, 4, 1024])
def test_sources_near_targets(spark, docs, blocks):
    rng = np.random.default_rng(blocks)
    rows = [(i, "w " * int(rng.integers(0, 60)), ["a", "b", "c", "é", None, "hot"][min(5, int(rng.integers(0, 12)))]) for i in range(400)]
    rows += [(1000, None, "a"), (1001, "", "empty only"), (1002, "x " * 5000, "b"), (1003, " \t\n", None)]
    found = M.taken(docs(rows).repartition(3), blocks=blocks).collect()
    check(rows, found)
    assert sorted(found) == sorted(M.taken(docs(rows[::-1]).repartition(2), blocks=blocks).collect())


def test_mix_has_the_taken_rows(spark, docs):
    rows = [(i, f"w{i} " * (i % 17), "abc"[i % 3 and (1 + i % 2)]) for i in range(200)]
    frame = docs(rows)
    found = M.mixed(frame, shard_words=150)
    assert found.columns == frame.columns
    count = Counter(r.doc_id for r in found.collect())
    for r in M.taken(frame, shard_words=150).collect():
        assert count[r.doc_id] * r.size == r.taken
    assert [r.doc_id for r in found.collect()] == [r.doc_id for r in M.mixed(frame, shard_words=150).collect()]


def test_odd_tables(spark, docs):
    assert M.taken(docs([])).count() == 0 and M.mixed(docs([])).count() == 0
    assert [r.taken for r in M.taken(docs([(1, None), (2, "")])).collect()] == [0, 0]
    found = M.taken(docs([(None, "a b"), (3, "c d"), (3, "c d")])).collect()
    assert len(found) == 3 and all(r.taken <= 2 * r.size for r in found)


def test_many_sources(spark, docs):
    """2,000 sources of one document each, more than one task or fixed plan would split."""
    rows = [(i, "w " * (i % 9), f"s{i:04d}") for i in range(2000)]
    check(rows, M.taken(docs(rows).repartition(3), shard_words=500).collect())


def test_repeated_rows_meet_the_target(spark, docs):
    rows = [(5, "a b c", "hot")] * 3000 + [(i, "d e", "cold") for i in range(300)] + [(None, "f", "other")] * 500
    found = M.taken(docs(rows).repartition(3)).collect()
    goal = brute_targets({"hot": 9000, "cold": 600, "other": 500})
    got, of = Counter(), {9000: "hot", 600: "cold", 500: "other"}
    for r in found:
        got[of[r.source_size]] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    assert len(found) == len(rows) and all(abs(got[s] - goal[s]) <= 1.5 for s in goal)


def test_counts_come_from_the_tree(spark, docs, monkeypatch):
    monkeypatch.setattr(M, "_tree", lambda *_: iter(()))
    assert {r.taken for r in M.taken(docs([(i, "a b") for i in range(9)])).collect()} == {0}


def test_query_over_whole_table(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text", "source").collect()]
    check(rows, QUERIES["op9_mixing"](spark, FOLDER).collect())
