import hashlib
import random

import numpy as np
import pytest

from flowplan.llm import suffix_array as A
from flowplan.llm import suffix_dedup as S
from flowplan.llm.queries import QUERIES, table

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_and_prefixes(seed):
    rng = random.Random(seed)
    base = bytes(rng.randint(1, rng.choice([1, 2, 5, 200])) for _ in range(rng.randint(1, 60)))
    text = (base * rng.randint(1, 6) + bytes(rng.randint(1, 3) for _ in range(rng.randint(0, 90))) + base)[: 1 + rng.randint(0, 400)]
    order = A.suffix_array(np.frombuffer(text, np.uint8))
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    common, before = A.permuted_prefixes(np.frombuffer(text, np.uint8), order)
    for i in range(1, len(order)):
        a, b = text[order[i] :], text[order[i - 1] :]
        k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert before[order[i]] == order[i - 1] and common[order[i]] == k
    for length in (1, 3, 17):
        found = A.repeated_starts(np.frombuffer(text, np.uint8), length)
        grams = [text[i : i + length] for i in range(len(text) - length + 1)]
        assert found[: len(grams)].tolist() == [grams.count(g) > 1 for g in grams]


def brute(rows, window=400):
    count = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, t in data:
        for i in range(len(t) - window + 1):
            count[t[i : i + window]] = count.get(t[i : i + window], 0) + 1
    out = []
    for d, t in data:
        gone = np.zeros(len(t) + 1, bool)
        for i in range(len(t) - window + 1):
            if count[t[i : i + window]] > 1:
                gone[i : i + window] = True
        gone = gone[: len(t)]
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, docs, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("ab cdé") for _ in range(rng.randint(380, 900))) for _ in range(6)]
    rows = []
    for i in range(50):
        parts = [
            rng.choice(passages)[rng.randint(0, 80) :] if rng.random() < 0.6 else "".join(rng.choice("xyzü") for _ in range(rng.randint(1, 500)))
            for _ in range(rng.randint(0, 4))
        ]
        rows.append((i, "".join(parts)))
    rows += [(900, None), (901, ""), (902, "q" * 400), (903, "r" * 401), (904, "s" * 9000), (905, "tu" * 500), (906, "v" * 399)]
    rows += [(907, "one row twice " * 40), (907, "one row twice " * 40), (None, "w" * 500)]
    found = S.digest(S.remove_repeated_bytes(docs(rows).repartition(4))).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_empty_table(spark, docs):
    assert S.remove_repeated_bytes(docs([])).count() == 0


def test_query_over_whole_table(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op8_suffix_dedup"](spark, FOLDER).collect()), key=str) == brute(rows)
