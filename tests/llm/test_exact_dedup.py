import hashlib
import re

import __spark_entry__ as registered
import compare
from flowplan.llm.exact_dedup import exact_duplicates

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((-len(text or ""), doc_id))
    return sorted(
        (d, min(g)[1], len(g), d == min(g)[1], hashlib.sha256(k.encode()).hexdigest())
        for k, g in groups.items()
        for _, d in g
    )


def test_ties_nulls_and_hot_group(spark, docs):
    rows = [(i, "hot text  here") for i in range(100, 400)] + [(1, None), (2, ""), (3, " \t"), (4, "a b"), (0, "ab"), (7, "a  b"), (6, "a\nb ")]
    rows += [(500, "é" * 20000), (501, "é" * 20000 + " "), (502, " "), (503, "x\x1fy")]
    expected = brute(rows)
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found = exact_duplicates(docs(rows).repartition(5)).collect()
        assert sorted(tuple(r) for r in found) == expected
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert exact_duplicates(docs([])).count() == 0


def test_null_ids_and_repeated_rows(spark, docs):
    found = exact_duplicates(docs([(None, "q"), (None, "q"), (3, "q"), (3, "q")])).collect()
    assert len(found) == 4 and {r.keep_id for r in found} == {3} and {r.group_size for r in found} == {4}


def test_query_matches_sql(spark):
    frame = registered.queries()["op1_exact_dedup"](spark, FOLDER).toPandas()
    expected = compare.duck(FOLDER).execute(registered.oracle_sql()["op1_exact_dedup"]).fetch_df()
    assert compare.differences(frame, expected) == []
