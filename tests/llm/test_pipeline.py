from collections import Counter

import corpus_pipeline as P
from flowplan.llm import mixing, quality
from flowplan.llm.queries import QUERIES, table

import test_decontamination
import test_mixing
import test_ngram_join
import test_token_output

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_against_brute_force(spark):
    docs = table(spark, FOLDER, "documents")
    columns = docs.columns
    counts = []
    for _, stage in P.STAGES[:4]:
        before = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        out = stage(spark, docs, FOLDER)
        assert out.columns == columns
        kept = [tuple(r) for r in out.select("doc_id", "text", "source").collect()]
        assert set(kept) <= set(before)
        if stage is P.keep_quality:
            scores = {r.doc_id: r.predicted for r in quality.score_documents(docs, table(spark, FOLDER, "labels")).collect()}
            assert sorted(kept) == sorted(r for r in before if scores[r[0]] == 1)
        elif stage is P.keep_one_of_group:
            stay = {d for d, n, c in test_ngram_join.brute([r[:2] for r in before]) if d == c}
            assert sorted(kept) == sorted(r for r in before if r[0] in stay)
        elif stage is P.keep_clean:
            items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
            hit = {x[0] for x in test_decontamination.brute([r[:2] for r in before], items)}
            assert sorted(kept) == sorted(r for r in before if r[0] not in hit)
        else:
            taken = mixing.taken(docs).collect()
            test_mixing.check(before, taken)
            n = Counter(r[0] for r in kept)
            assert all(n[r.doc_id] * r.size == r.taken for r in taken)
        counts.append(len(kept))
        docs = spark.createDataFrame(out.collect(), docs.schema)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in P.encode(spark, docs, FOLDER).collect()) == sorted(test_token_output.brute(rows))
    assert counts[1] < counts[0]
    assert QUERIES["pipeline"](spark, FOLDER).count() == len(rows)


def test_rows_are_judged_one_by_one(spark):
    texts = ["a b c d e f g", "h i j k l m n", "o p q r s t u", "v w x y z a b"]
    rows = [(None, texts[0], "x", "1"), (None, texts[0], "y", None), (None, texts[0], None, "y"), (None, texts[1], "x", "4")]
    rows += [(1, texts[2], "x", "5"), (2, texts[2], "x", "6"), (2, texts[3], "x", "7"), (2, texts[1], "x", "8"), (2, texts[1], "x", "8"), (2, "", "x", "9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, row string").repartition(3)
    kept = [tuple(r) for r in P.keep_one_of_group(spark, docs, FOLDER).collect()]
    assert sorted(r[1] for r in kept) == sorted(["", *texts]) and set(kept) <= set(rows)
    assert {r[:2] for r in kept} == {(None, texts[0]), (2, texts[1]), (1, texts[2]), (2, texts[3]), (2, "")}
    items = spark.createDataFrame([(7, texts[1])], "item_id long, text string")
    assert sorted(map(str, P.decontamination.clean(docs, items).collect())) == sorted(str(r) for r in docs.collect() if r.text != texts[1])


def test_repeated_rows_nulls_and_other_columns(spark):
    rows = [(1, "a b c d e f g", "x", 1), (1, "a b c d e f g", "x", 2), (2, "a b c d e f g", None, 3), (3, None, "x", 4), (None, "z z", "x", 5), (4, "", "y", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _gone int")
    kept = P.keep_one_of_group(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "None"]
    assert P.keep_clean(spark, docs, FOLDER).count() == 6
    assert P.mix(spark, docs, FOLDER).columns == docs.columns
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
