import zlib

import numpy as np

from flowplan.llm import quality
from flowplan.llm.queries import QUERIES, table

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = QUERIES["op2_quality"](spark, FOLDER).toPandas()
    labels = table(spark, FOLDER, "labels").toPandas()
    assert len(found) == table(spark, FOLDER, "documents").count()
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.3)).all()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    both = found.merge(labels, on="doc_id")
    both = both[both.held_out]
    good, bad = both[both.quality == 1].score, both[both.quality == 0].score
    assert (both.predicted == both.quality).mean() > 0.95
    assert np.mean([(good > b).mean() for b in bad]) > 0.98


def test_labels_of_held_out_rows_are_not_read(spark):
    documents, labels = table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels")
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.learn(documents, labels), quality.learn(documents, flipped)
    assert (a.weights == b.weights).all() and a.threshold == b.threshold


def test_odd_tables(spark, docs):
    rows = [(1, None), (2, ""), (None, "text"), (3, "A fine text. " * 9), (3, "A fine text. " * 9), (4, "%% $$ ## " * 40), (6, "x" * 300000)]
    labels = spark.createDataFrame([(3, 1, 0), (4, 0, 0), (99, 1, 0), (None, 0, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    found = quality.score_documents(docs(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].score > by_id[4].score and by_id[3].predicted == 1 and by_id[4].predicted == 0
    assert {r.predicted for r in quality.score_documents(docs(rows), labels.limit(0)).collect()} == {1}
    assert quality.score_documents(docs([]), labels).count() == 0
    assert sorted(r.doc_id for r in quality.keep_good(docs(rows), labels).where("doc_id in (3, 4)").collect()) == [3, 3]


def test_fit_prefers_the_better_feature():
    rng = np.random.default_rng(3)
    good, bad = rng.normal(1, 1, (300, 4)), rng.normal(1, 1, (200, 4))
    good[:, 2] += 5
    ranking = quality.fit(good, bad, 0.4)
    assert np.argmax(np.abs(ranking.weights)) == 2
    assert (ranking.score(good) >= quality.CUT).mean() > 0.97 and (ranking.score(bad) < quality.CUT).mean() > 0.97


def test_every_labelled_row_is_learned_from(spark):
    """Copies of one row move the mean of all features, however many there are."""
    good, bad = "A plain sentence of some words, as people write them.", "### || ## ||"
    rows = [(i, good if i % 4 else bad) for i in range(24_000)]
    rows += [(i, "other words 12 34") for i in range(24_000, 40_000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = documents.selectExpr("doc_id", "cast(doc_id >= 24000 OR doc_id % 4 <> 0 AS int) AS quality")
    learned = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5]
    x = quality.features([good.encode(), bad.encode(), b"other words 12 34"]).astype(np.float32).astype(float)
    kind = [2 if i >= 24_000 else int(i % 4 == 0) for i in learned]
    ranking = quality.learn(documents, labels)
    # Pairs over a line end between texts depend on the text after it, so only the other figures are compared.
    np.testing.assert_allclose(ranking.mean[-6:], x[kind].mean(0)[-6:], atol=1e-6)
    found = quality.score_documents(documents, labels).collect()
    assert all(r.predicted == int(r.doc_id >= 24_000 or r.doc_id % 4 != 0) for r in found)
