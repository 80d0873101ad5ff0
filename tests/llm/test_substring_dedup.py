import hashlib
import random
import re

import numpy as np
import pytest

from flowplan.llm import substring_dedup as S
from flowplan.llm import superkmer
from flowplan.llm.queries import QUERIES, table

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def brute(rows, window=50):
    first = {}
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    for d, w in words:
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_sliding_min_and_rolling():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 50, 300).astype(np.uint64)
    for width in (1, 2, 3, 43, 64, 300):
        assert superkmer.sliding_min(x, width).tolist() == [min(x[i : i + width]) for i in range(301 - width)]
    h = superkmer.rolling(x, 3)
    for i, j in [(a, b) for a in range(100) for b in range(100)]:
        assert (h[i] == h[j]) == (x[i : i + 3] == x[j : j + 3]).all()


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, docs, seed):
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefg") * rng.randint(1, 3) for _ in range(rng.randint(50, 130))] for _ in range(6)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += rng.choice(passages)[rng.randint(0, 30) :] if rng.random() < 0.6 else [rng.choice("xyz") for _ in range(rng.randint(1, 80))]
        rows.append((rng.randint(0, 1000) * 60 + i, rng.choice([" ", "\n", " \t"]).join(w)))
    rows += [(70001, None), (70002, ""), (70003, "   "), (70004, "same " * 400), (-5, "same " * 300), (70005, "é\x85ü " * 120)]
    found = S.digest(S.remove_repeated_windows(docs(rows).repartition(4))).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_repeated_ids_nulls_and_empty_table(spark, docs):
    text = " ".join(map(str, range(60)))
    found = S.digest(S.remove_repeated_windows(docs([(1, text), (1, text), (1, "z " + text), (None, text)]))).collect()
    assert sorted((r.doc_id is None, r.n_words, r.n_removed) for r in found) == [(False, 60, 0), (False, 60, 0), (False, 61, 0), (True, 60, 60)]
    assert S.remove_repeated_windows(docs([])).count() == 0


def test_query_over_whole_table(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op6_substring_dedup"](spark, FOLDER).collect()) == brute(rows)
