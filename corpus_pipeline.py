"""A corpus from raw documents to token files, one written table after another.

Documents that the quality classifier rejects go, one document of each group of near copies stays,
documents that hold a benchmark item go, the sources are mixed to their target weights, and the mix
is encoded into wavelet-matrix shards and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowplan.llm import decontamination, mixing, ngram_join, quality, token_output
from flowplan.llm.common import WORD, shared_folder, written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the classifier accepts; null and empty texts are judged like others."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def keep_one_of_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of linked documents; rows without shingles all stay.

    Rows are told apart by all their columns, not by doc_id, and rows without doc_id count as the
    greatest. Of rows of a group that repeat the staying doc_id the one with the longest text stays.
    """
    text = F.col("text").cast("string")
    # Two hashes of the whole row; rows that are equal in all columns are one key.
    columns = [F.col(f"`{c}`") for c in docs.columns]
    seeds = [F.xxhash64(F.lit(k), *columns, *[c.isNull() for c in columns]) for k in (1, 2)]
    order = [F.coalesce(F.col("doc_id").cast("long"), F.lit(ngram_join.NO_ID)).alias("key"), (-F.length(text)).alias("len")]
    worded = docs.where(text.rlike(WORD))
    signed = ngram_join.signatures(worded.select(*order, seeds[0].alias("a"), seeds[1].alias("b"), text.alias("text")))
    row = F.struct("key", "len", "a", "b")
    classes = signed.groupBy("hi", "lo", row.alias("row")).count()
    classes = written(classes.groupBy("hi", "lo").agg(F.min(F.struct("row", "count")).alias("best")), "class-rows")
    _, groups = ngram_join.linked_classes(docs)
    alone = F.when(F.col("label").isNull(), F.col("lo"))
    named = classes.join(groups, "hi", "left").select(F.coalesce("label", "hi").alias("group"), alone.alias("lo"), "best")
    best = named.groupBy("group", "lo").agg(F.min("best").alias("best"))
    best = written(best.select(F.col("best.row.a").alias("_a"), F.col("best.row.b").alias("_b"), F.col("best.count").alias("_n")), "staying")

    def staying(which: str) -> DataFrame:
        mine = best.where(which)
        return worded.join(mine, (seeds[0] == mine["_a"]) & (seeds[1] == mine["_b"]), "left_semi")

    return docs.where(~F.coalesce(text.rlike(WORD), F.lit(False))).unionByName(staying("_n = 1")).unionByName(staying("_n > 1").dropDuplicates())


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no benchmark item is found."""
    return decontamination.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated as often as the mix takes them, shuffled within their shards."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every row, read back from the token files."""
    # The workers hold what earlier stages left; a smaller memory of pieces makes room.
    return token_output.token_output(spark, docs, pieces=100_000)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram Jaccard join", keep_one_of_group),
    ("benchmark decontamination", keep_clean),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", encode),
]

#: Neither a learned classifier nor a tokenizer is SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
