import random
import re
import time
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from flowplan.llm import ngram_join as J
from flowplan.llm.components import components
from flowplan.llm.queries import QUERIES, table

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 75 * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(s), least[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets)))


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 40), (40, 45)], "a long, b long")
    found = dict(tuple(r) for r in components(links).collect())
    assert found == {**{i: 0 for i in range(31)}, 40: 40, 45: 40, 50: 40}
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_random_groups(spark, docs, seed):
    rng = random.Random(seed)
    rows = []
    for g in range(8):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([6, 30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 12])):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 18))):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
            if rng.random() < 0.3:
                w = w[: len(w) * rng.randint(70, 100) // 100]
            rows.append((len(rows) * 3 + rng.randint(0, 2), (" ".join(w)).upper() if rng.random() < 0.2 else " ".join(w)))
    shared = " ".join(f"s{i}" for i in range(60))
    rows += [(2000 + i, shared + " " + " ".join(f"u{i}_{k}" for k in range(rng.randint(2, 40)))) for i in range(25)]
    rows += [(3000, None), (3001, ""), (3002, " \n"), (3003, "one two"), (3004, "ONE  two"), (3005, "one"), (3006, "a b c d e"), (3007, "a b c d e f")]
    found = J.jaccard_components(docs(rows).repartition(5)).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_empty_table_nulls_and_repeats(spark, docs):
    assert J.jaccard_components(docs([])).count() == 0
    found = J.jaccard_components(docs([(None, "a b c"), (4, "A b c"), (4, "A b c"), (None, "z"), (None, None), (6, "q r")])).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == [
        ("4", 1, "4"), ("4", 1, "4"), ("6", 1, "6"), ("None", 0, "None"), ("None", 1, "4"), ("None", 1, "None"),
    ]


def test_many_rows_without_doc_id(spark, docs):
    """5,000 rows share the missing doc_id; each pair of neighbours is linked and one text stands 1,000 times."""
    words = [[f"g{i // 2}w{k}" for k in range(40)] + ([f"x{i}"] if i % 2 else []) for i in range(4000)]
    rows = [(None, " ".join(w)) for w in words] + [(None, "one text that stands a thousand times")] * 1000 + [(7, "g5w0 g5w1"), (8, " ".join(words[0]))]
    found = J.jaccard_components(docs(rows).repartition(4)).collect()
    assert len(found) == 5002
    named = Counter((r.n_shingles, r.component_id) for r in found if r.component_id is not None)
    assert named == {(36, 8): 2, (37, 8): 1, (1, 7): 1}
    assert sum(r.n_shingles == 3 for r in found) == 1000


def grouped(tables, column, function):
    whole = pa.concat_tables(tables)
    return [function(whole.filter(pc.equal(whole.column(column), k))) for k in pc.unique(whole.column(column))]


@pytest.mark.parametrize("percent", [50, 75, 90, 100])
def test_every_link_between_groups_is_listed(percent):
    rng = np.random.default_rng(percent)
    sets, label = [], []
    common = rng.integers(0, 1 << 64, 60, np.uint64)
    for g in range(25):
        base = np.unique(np.concatenate([common[: rng.integers(0, 60)], rng.integers(0, 1 << 64, rng.integers(1, 60), np.uint64)]))
        for _ in range(rng.integers(1, 9)):
            kept = base[rng.random(len(base)) > rng.choice([0.0, 0.05, 0.2])]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 1 << 64, rng.integers(1, 8), np.uint64)])))
            label.append(int(rng.choice([g, 100 + len(sets)])))
    label, hi = np.asarray(label), np.arange(len(sets)) + 1000
    n = np.asarray([len(s) for s in sets])
    spread = []
    for batch, ids in enumerate(np.array_split(np.arange(len(sets)), 3)):
        docs = np.stack([hi[ids], label[ids], label[ids], n[ids], 0 * ids, np.arange(len(ids))])
        spread.append(pa.Table.from_batches([J._spread(batch, 4, 1.0, label[ids], [sets[i] for i in ids], docs, False)]))
    early = grouped(grouped(spread, "fragment", J._often), "batch", J._early(percent))
    listed = {p for t in grouped(early, "fragment", J._between_groups(percent)) for p in zip(t["a"].to_pylist(), t["b"].to_pylist())}
    links = set()
    for i, j in combinations(range(len(sets)), 2):
        both = len(np.intersect1d(sets[i], sets[j]))
        if label[i] != label[j] and 100 * both >= percent * (n[i] + n[j] - both):
            links.add((int(hi[i]), int(hi[j])))
    assert links <= listed
    assert percent == 100 or links
    assert all(label[a - 1000] != label[b - 1000] for a, b in listed)


def test_common_passage_does_not_list_all_pairs(spark, docs):
    """Most of every document is one passage, a part is shared with one other document, so all stay and none link."""

    def crowd(size):
        rows = [
            (i, " ".join([*(f"c{k}" for k in range(44)), *(f"p{i // 2}x{k}" for k in range(9)), *(f"u{i}x{k}" for k in range(12))]))
            for i in range(size)
        ]
        rows.append((-1, rows[0][1] + " end"))
        table = docs(rows).repartition(4).localCheckpoint()
        began = time.time()
        found = sorted(tuple(r) for r in J.jaccard_components(table).collect())
        assert found == sorted([(-1, 62, -1), (0, 61, -1), *((i, 61, i) for i in range(1, size))])
        return time.time() - began

    few, many = crowd(500), crowd(9000)
    assert many < 2 * few, (few, many)


def test_query_over_whole_table(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op4_ngram_join"](spark, FOLDER).collect()) == brute(rows)
