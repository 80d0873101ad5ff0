"""Exact duplicates by content sort.

Sampled splitters range-partition the rows by the first normalised bytes and their digest, each
partition is sorted, and neighbours are compared in full. The identifier is part of the splitters,
so a text with very many copies spreads over several partitions; runs that meet at a partition
border are joined afterwards from one row per border.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowplan.llm.common import SPACE, slices, texts_of, written

PREFIX = 16
_KEYED = "doc_id long, chars long, prefix binary, digest binary, norm binary"
_PLACED = "kind int, doc_id long, chars long, digest binary, part int, run long, norm binary"


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts = texts_of(batch.column("text"))
        norms = [t.translate(None, SPACE) for t in texts]
        chars = pa.compute.fill_null(pa.compute.utf8_length(batch.column("text")), 0)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                chars.cast(pa.int64()),
                pa.array([n[:PREFIX] for n in norms], pa.binary()),
                pa.array([hashlib.sha256(n).digest() for n in norms], pa.binary()),
                pa.array(norms, pa.binary()),
            ],
            names=["doc_id", "chars", "prefix", "digest", "norm"],
        )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the runs of equal neighbours; the first and last text of the partition follow as borders."""
    part, run, last, names = TaskContext.get().partitionId(), -1, None, _PLACED.replace(",", "").split()[::2]

    def border(kind, run, norm):
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary()]
        values = [kind, None, None, None, part, run, norm]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        norm = batch.column("norm")
        first = norm[0].as_py()
        new = np.ones(n, bool)
        new[0] = last is None or first != last
        if n > 1:
            new[1:] = ~np.asarray(pa.compute.equal(norm.slice(1), norm.slice(0, n - 1)))
        if last is None:
            yield border(1, 0, first)
        runs = run + np.cumsum(new)
        run, last = int(runs[-1]), norm[n - 1].as_py()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.zeros(n, np.int32)),
                batch.column("doc_id"),
                batch.column("chars"),
                batch.column("digest"),
                pa.array(np.full(n, part, np.int32)),
                pa.array(runs),
                pa.nulls(n, pa.binary()),
            ],
            names=names,
        )
    if last is not None:
        yield border(2, run, last)


def exact_duplicates(documents: DataFrame) -> DataFrame:
    """One row per row of ``documents``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after deleting ASCII white space; null counts as empty, and all
    empty texts form one group. Of equal texts the longest original stays, then the smallest
    doc_id, nulls last. Rows that repeat a doc_id within a group share its decision. Other columns are
    ignored; an empty table gives an empty result.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.desc("chars"), F.asc_nulls_last("doc_id")]
    placed = (
        rows.mapInArrow(_keyed, _KEYED)
        .repartitionByRange(F.col("prefix"), F.col("digest"), *order)
        .sortWithinPartitions("prefix", "digest", "norm", *order)
        .mapInArrow(_runs, _PLACED)
    )
    placed = written(placed, "content-sort")
    # One row per partition that has rows: does its first run go on from the partition before?
    tails = placed.where("kind = 2").select("part", F.col("run").alias("last_run"), F.col("norm").alias("tail"))
    heads = placed.where("kind = 1").select("part", F.col("norm").alias("head"))
    by_part = W.orderBy("part")
    before = tails.select("part", F.lead("part").over(by_part).alias("next"), "last_run", "tail")
    before = before.select(F.col("part").alias("prev"), F.col("next").alias("part"), F.col("last_run").alias("prev_run"), "tail")
    borders = heads.join(before, "part", "left").select(
        "part",
        F.when(F.col("tail").isNull() | (F.col("tail") != F.col("head")), F.struct("part", F.lit(0).cast("long").alias("run")))
        .when(F.col("prev_run") > 0, F.struct(F.col("prev").alias("part"), F.col("prev_run").alias("run")))
        .alias("anchor"),
    )
    roots = borders.select("part", F.last("anchor", ignorenulls=True).over(by_part).alias("anchor"))
    local = (
        placed.where("kind = 0")
        .groupBy("part", "run")
        .agg(
            F.count("*").alias("n"),
            F.min(F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("z"), "doc_id")).alias("best"),
        )
        .join(roots, "part")
        .withColumn("root", F.when(F.col("run") == 0, F.col("anchor")).otherwise(F.struct("part", "run")))
    )
    groups = local.groupBy("root").agg(F.sum("n").alias("group_size"), F.min("best").alias("best"))
    runs = local.select("part", "run", "root").join(groups, "root").select("part", "run", "group_size", F.col("best.doc_id").alias("keep_id"))
    out = placed.where("kind = 0").join(runs, ["part", "run"])
    return out.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
