import random
import re

import numpy as np
import pytest

import __spark_entry__ as registered
import compare
from flowplan.llm import decontamination as D

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.01"


def brute(rows, items):
    def words(t):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    def grams(w, k):
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}

    out = []
    for i, t in items:
        w = words(t)
        if not w:
            continue
        g = grams(w, min(5, len(w)))
        for d, text in rows:
            n = len(g & grams(words(text), min(5, len(w))))
            if n and 100 * n >= 75 * len(g):
                out.append((d, i, len(g), n))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 400])
def test_random_inserts(spark, docs, block_bytes):
    rng = random.Random(5)
    items = [(i, " ".join(f"w{rng.randint(0, 300)}" for _ in range(rng.choice([5, 7, 12, 40, 90])))) for i in range(30)]
    items += [(100, None), (101, ""), (102, " \n"), (103, "two words"), (104, "Solo"), (105, items[0][1].upper()), (105, items[3][1])]
    rows = []
    for d in range(150):
        w = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([0, 3, 60, 400, 3000]))]
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items)[1] or "x").split() or ["x"]
            for _ in range(rng.randint(0, 2)):
                part[rng.randrange(len(part))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = part
        rows.append((d, " ".join(w)))
    rows += [(900, None), (901, ""), (902, "SOLO"), (903, "a two   WORDS b"), (None, items[0][1]), (905, "longer " * 100000 + items[4][1])]
    frame = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = D.contaminated(docs(rows).repartition(3), frame, block_bytes=block_bytes).collect()
    assert sorted((tuple(r)[:4] for r in found), key=str) == brute(rows, items)
    kept = {r.doc_id for r in D.clean(docs(rows), frame).collect()}
    assert kept == {d for d, _ in rows} - {x[0] for x in brute(rows, items)}


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contaminated(docs([]), items).count() == 0
    assert D.contaminated(docs([(1, "a b c d e f")]), items.limit(0)).count() == 0
    assert D.clean(docs([(1, "a b c d e f"), (None, "z")]), items).count() == 1


def test_recall_of_bands_for_short_items_in_long_documents():
    rng = np.random.default_rng(0)
    hits = 0
    for k in range(200):
        item = [f"i{k}_{j}" for j in range(9)]
        index = D.ItemIndex([(1, " ".join(item).encode())], 5)
        words = [f"d{x}" for x in rng.integers(0, 10**9, 5000)]
        h = D.WordHasher()([w.encode() for w in words[:2500] + item[:8] + words[2500:]])
        hits += bool(index.candidates([np.unique(D.shingle_hashes(h, 5))]))
    assert hits >= 198


def test_short_items_are_found_in_every_document(spark, docs):
    rng = np.random.default_rng(1)
    items = [(1, "alpha beta gamma delta omega"), (2, "single"), (3, "one two three four five six")]
    rows = []
    for d in range(1500):
        words = [f"d{x}" for x in rng.integers(0, 10**9, 260)]
        item = items[d % 3][1]
        rows.append((d, " ".join([*words[:100], item, *words[100:]])))
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.contaminated(docs(rows), frame).collect()}
    assert found == {(d, 1 + d % 3) for d in range(1500)}


def test_query_matches_sql(spark):
    frame = registered.queries()["op5_decontamination"](spark, FOLDER).toPandas()
    expected = compare.duck(FOLDER).execute(registered.oracle_sql()["op5_decontamination"]).fetch_df()
    assert len(frame) and compare.differences(frame, expected) == []
