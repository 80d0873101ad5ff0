import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as registered
import compare
from flowplan.llm import fill_middle

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    digest = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    spm = h4 % 100 < 20
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if spm else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, "spm" if spm else "psm", len(prefix), len(middle), sha(out), sha(text)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aZé <PSM>\n😀\x00"), st.integers(1, 9))
def test_index_gives_every_boundary(text, error):
    offsets = fill_middle.boundaries(text)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    assert offsets.tolist() == np.cumsum([0, *map(len, units)]).tolist()
    index = fill_middle.RankIndex(offsets, error)
    assert [index[r] for r in range(len(offsets))] == offsets.tolist()
    assert np.abs(index.residual).max() <= error + 1


def test_segments_stay_within_the_bound_and_are_few():
    rng = np.random.default_rng(3)
    offsets = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 200_000))])
    index = fill_middle.RankIndex(offsets)
    assert np.abs(index.residual.astype(int)).max() <= fill_middle.MAX_ERROR + 1
    assert len(index.first) < 2_000
    steep = fill_middle.RankIndex(np.cumsum([0, *([1] * 5000), 10**6, *([7] * 5000)]))
    assert steep.first.tolist() == [0, 5001]


def test_rows_match_brute_force(spark, docs):
    texts = [None, "", " ", "a", "one two", "<P>", "x<S", "<<S>>", "<M", "é😀 b\n\tc", "S> <", "w" * 70_000, "ab, " * 40_000]
    rows = [(i, t) for i, t in enumerate(texts * 6)] + [(None, "no id"), (None, None), (5, "again"), (5, "again"), (-3, "<"), (10**17, "P>a<")]
    found = fill_middle.digest(fill_middle.fill_in_middle(docs(rows).repartition(3))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(str(brute(*r)) for r in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}


def test_empty_table_and_clashing_columns(spark, docs):
    from pyspark.sql import functions as F

    assert fill_middle.fill_in_middle(docs([])).count() == 0
    clash = docs([(1, "a b")]).select("*", *[F.lit(7).alias(c) for c in ("n", "form", "output", "segments")])
    assert fill_middle.fill_in_middle(clash).first().n == 3


def test_query_matches_sql(spark):
    frame = registered.queries()["op12_fill_middle"](spark, FOLDER).toPandas()
    expected = compare.duck(FOLDER).execute(registered.oracle_sql()["op12_fill_middle"]).fetch_df()
    assert compare.differences(frame, expected) == []
