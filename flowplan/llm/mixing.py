"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

The rows of a source are permuted by a hash and cut into blocks of the permutation. A source's quota
is its whole passes plus the first blocks of one more, the last of them cut between two rows. A
binary tree over the output shards splits the vector of block quotas: the left half of a node draws
its number of blocks from the sources without replacement, the right half gets the rest, so every
quota is met exactly. A shard takes the next blocks of each source in permuted order and shuffles
its rows by itself. What the mix takes of a row is read from the placed blocks.

The driver splits groups of sources among ranges of shards, a table of fixed size; a task per group
then splits its part among the sources, and a task per range splits that among its shards. Drawing
in these steps has the distribution of one draw. Sources, blocks and places are written tables, so
their number has no bound.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowplan.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
REPEATS = 2.0
#: Words of an output shard, about.
SHARD_WORDS = 4_000_000
#: Blocks of a shard, about, and the most bits that number the blocks of one source.
SHARD_BLOCKS, MOST_BITS = 64, 22
#: Groups of sources, and ranges of shards, that the driver splits.
GROUPS, RANGES = 256, 256
#: Rows of a source are dealt into so many salts when they meet the table of sources.
SALTS = 32
_SPLIT = "place long, part long, n long"


def split_quotas(quotas: np.ndarray, capacity: int | np.ndarray, seed: int | list[int]) -> np.ndarray:
    """(shard, source) counts of blocks with the sums of ``quotas`` and of ``capacity``.

    A plain number of shards stands for capacities that differ by one block at most.
    """
    quotas = np.asarray(quotas, np.int64)
    if np.isscalar(capacity):
        capacity = np.diff(np.arange(capacity + 1) * int(quotas.sum()) // capacity)
    out = np.zeros((len(capacity), len(quotas)), np.int64)
    for shard, sources, counts in _tree(quotas, np.asarray(capacity, np.int64), np.atleast_1d(seed).tolist()):
        out[shard, sources] = counts
    return out


def _tree(quotas: np.ndarray, capacity: np.ndarray, seed: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, sources, counts) of every leaf; a node holds only sources with blocks left."""
    ends = np.concatenate([[0], np.cumsum(capacity)])
    nodes = [(0, len(capacity), np.flatnonzero(quotas), quotas[quotas > 0])]
    while nodes:
        first, end, sources, left = nodes.pop()
        if not len(sources):
            continue
        if end - first == 1:
            yield first, sources, left
            continue
        middle = (first + end) // 2
        rng = np.random.default_rng([*seed, first, end])
        draw = rng.multivariate_hypergeometric(left, int(ends[middle] - ends[first]), method="marginals")
        for a, b, n in ((middle, end, left - draw), (first, middle, draw)):
            nodes.append((a, b, sources[n > 0], n[n > 0]))


def _split_group(seed: int):
    """A group's quotas (kind 0: source, n) split among ranges (kind 1: range, n): rows source, range, n."""

    def split(table: pa.Table) -> pa.Table:
        group, kind, key, n = (np.asarray(table.column(c)) for c in ("group", "kind", "key", "n"))
        order = np.lexsort((key, kind))
        kind, key, n = kind[order], key[order], n[order]
        sources, ranges = key[kind == 0], key[kind == 1]
        leaves = list(_tree(n[kind == 0], n[kind == 1], [seed, 1, int(group[0])])) if len(ranges) else []
        places = [sources[s] for _, s, _ in leaves]
        parts = [np.full(len(s), ranges[r]) for r, s, _ in leaves]
        return _leaves(places, parts, [c for _, _, c in leaves])

    return split


def _split_range(total: int, shards: int, ranges: int, seed: int):
    """The sources of a range split among its shards: rows source, shard, n."""

    def split(table: pa.Table) -> pa.Table:
        source, part, n = (np.asarray(table.column(c)) for c in ("place", "part", "n"))
        order, r = np.argsort(source), int(part[0])
        source, n = source[order], n[order]
        first, end = r * shards // ranges, (r + 1) * shards // ranges
        capacity = np.asarray([(s + 1) * total // shards - s * total // shards for s in range(first, end)], np.int64)
        leaves = list(_tree(n, capacity, [seed, 2, r]))
        return _leaves([source[s] for _, s, _ in leaves], [np.full(len(s), first + k) for k, s, _ in leaves], [c for _, _, c in leaves])

    return split


def _leaves(*columns: list[np.ndarray]) -> pa.Table:
    values = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in columns]
    return pa.table(values, names=["place", "part", "n"])


@dataclass(frozen=True)
class Mix:
    """rows: (_row, doc_id, _size, source_size, target, places) of every row; places: structs (copy, shard)."""

    rows: DataFrame
    shards: int


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with _turn, their place in the permutation; rows equal in doc_id, text and source get turns of their own.

    Which of such rows gets which turn means nothing; the set of turns does not depend on partitions.
    """
    same = ["_base", "doc_id", "source"]
    pieces = rows.groupBy(*same, "_pid").count()
    before = W.partitionBy(*same).orderBy("_pid")
    pieces = pieces.withColumn("_first", F.sum("count").over(before) - F.col("count")).withColumn("_all", F.sum("count").over(before.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    pieces = written(pieces.where("_all > 1").select(F.col("_base").alias("_b"), F.col("doc_id").alias("_d"), F.col("source").alias("_s"), F.col("_pid").alias("_p"), "_first"), "repeated")
    match = (rows["_base"] == pieces["_b"]) & rows["doc_id"].eqNullSafe(pieces["_d"]) & rows["source"].eqNullSafe(pieces["_s"]) & (rows["_pid"] == pieces["_p"])
    alone = rows.join(pieces, match, "left_anti").withColumn("_turn", F.col("_base"))
    # A piece is what one input partition holds of equal rows.
    local = F.row_number().over(W.partitionBy(*same, "_pid").orderBy("_row"))
    many = rows.join(pieces, match).withColumn("_turn", F.xxhash64("_base", F.col("_first") + local))
    return alone.unionByName(many.select(alone.columns))


def _ranked(sources: DataFrame, weights) -> DataFrame:
    """``sources`` with _k, their number by code point (null last), and their weight."""
    row = F.monotonically_increasing_id()
    placed = written(sources.orderBy(F.asc_nulls_last("source")).withColumn("_at", row), "sources")
    part = F.shiftrightunsigned("_at", 33).cast("int")
    counts = dict(placed.groupBy(part.alias("part")).count().collect())  # a row per partition
    first = np.concatenate([[0], np.cumsum([counts.get(p, 0) for p in range(max(counts, default=0) + 1)])]).tolist()
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    number = F.element_at(F.array(*[F.lit(x).cast("long") for x in first]), part + 1) + inside
    ranked = placed.select("source", "source_size", number.alias("_k"))
    return ranked.withColumn("_weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights)).cast("int") + 1))


def with_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """``sizes`` (source, source_size) with _k and target, the words each source gives.

    By weight, at most ``repeats`` times its size, the rest reshared. The level is the words per unit
    of weight of the sources that are not full; it only rises as more sources turn out to be full.
    """
    ranked = written(_ranked(sizes, weights), "ranked")
    cap = F.col("source_size") * repeats
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        fills = F.col("_weight") * level > cap
        n, used, open_ = ranked.agg(
            F.sum(fills.cast("long")), F.sum(F.when(fills, cap).otherwise(0.0)), F.sum(F.when(fills, 0.0).otherwise(F.col("_weight")))
        ).first()
        if n is None or n == full or not open_:
            break
        level, full = (share * total - used) / open_, n
    return ranked.withColumn("target", F.least(cap, F.col("_weight") * level))


def plan_mix(documents: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: float = REPEATS, seed: int = 1, blocks: int | None = None, shard_words: int = SHARD_WORDS) -> Mix:
    """Targets of every source and the shards of its blocks, for rows (_row, _pid, doc_id, source, text hash, size).

    ``blocks``, a power of two, is the number of blocks of every source; by default it grows with the source.
    """
    if blocks is not None and (blocks < 2 or blocks & (blocks - 1)):
        raise ValueError("blocks must be a power of two, 2 at least")
    rows = documents.select("_row", "_pid", "doc_id", "source", "_size", F.xxhash64(F.lit(seed), "doc_id", "_hash").alias("_base"))
    rows = written(_told_apart(rows), "sized")
    sizes = rows.groupBy("source").agg(F.sum("_size").alias("source_size"))
    bits = F.ceil(F.log2(F.greatest("source_size", F.lit(1)) * SHARD_BLOCKS / shard_words))
    bits = F.lit((blocks - 1).bit_length()) if blocks else F.greatest(F.lit(1), F.least(F.lit(MOST_BITS), bits))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = with_targets(sizes, weights, share, repeats).withColumn("_bits", bits.cast("int")).withColumn("_passes", passes)
    plan = written(plan.withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size")), "plan")
    # A hot source meets its row of the plan in SALTS parts.
    salted = plan.withColumnRenamed("source", "_s").withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    match = rows["source"].eqNullSafe(salted["_s"]) & (F.pmod(F.col("_row"), F.lit(SALTS)) == F.col("_salt"))
    rows = rows.join(salted, match).withColumn("_block", F.expr("shiftrightunsigned(_turn, 64 - _bits)"))
    rows = written(rows.select("_row", "doc_id", "_size", "_turn", "_k", "_block", "source_size", "target"), "placed")

    ends = rows.groupBy("_k", "_block").agg(F.sum("_size").alias("n")).withColumn("_end", F.sum("n").over(W.partitionBy("_k").orderBy("_block")))
    ends = ends.join(plan.where("_rest > 0").select("_k", "_rest"), "_k").where("_end >= _rest and _end - n < _rest")
    # The block in which the rest ends; rows of it are taken in turn while their middle is within the rest.
    ends = written(ends.select("_k", "_block", (F.col("_rest") - F.col("_end") + F.col("n")).alias("_rest")), "ends")
    before = F.coalesce(F.sum("_size").over(W.partitionBy("_k").orderBy("_turn", "doc_id", "_size").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = rows.join(ends, ["_k", "_block"]).withColumn("_before", before).where("_before + _size / 2 <= _rest")
    cuts = inside.groupBy("_k").agg(F.max("_turn").alias("_cut"))
    last = ends.select("_k", F.col("_block").alias("_last")).join(cuts, "_k", "left")
    quota = F.col("_passes") * F.expr("shiftleft(1L, _bits)")
    quota = quota + F.coalesce("_last", F.lit(0)) + F.col("_cut").isNotNull().cast("long")
    quotas = written(plan.join(last, "_k", "left").select("_k", "_bits", "_passes", "_last", "_cut", quota.alias("n")), "quotas")

    total, words = quotas.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], plan.agg(F.sum("target")).first()[0] or 0
    shards = max(1, int(-(-words // shard_words)))
    placed = _places(quotas, int(total), shards, seed)
    copy, block = F.expr("_at div shiftleft(1L, _bits)"), F.expr("_at % shiftleft(1L, _bits)")
    places = placed.join(quotas.drop("n"), "_k").select("_k", "_shard", copy.alias("_copy"), block.alias("_block"), "_passes", "_last", "_cut")
    # The cut of a place in the source's last block; other places hold whole blocks.
    cut = F.when((F.col("_copy") == F.col("_passes")) & (F.col("_block") == F.col("_last")), F.col("_cut"))
    # A block is placed at most once a pass.
    places = places.groupBy("_k", "_block").agg(F.collect_list(F.struct(F.col("_copy").alias("copy"), F.col("_shard").alias("shard"), cut.alias("cut"))).alias("places"))
    taken_places = F.filter(F.coalesce("places", F.array().cast("array<struct<copy:bigint,shard:bigint,cut:bigint>>")), lambda p: p["cut"].isNull() | (F.col("_turn") <= p["cut"]))
    found = rows.join(places, ["_k", "_block"], "left").withColumn("places", taken_places)
    return Mix(found.select("_row", "doc_id", "_size", "_turn", "source_size", "target", "places"), shards)


def _places(quotas: DataFrame, total: int, shards: int, seed: int) -> DataFrame:
    """(_k, _shard, _at): the shard of block ``_at`` in the row of all blocks a source gives."""
    ranges = min(RANGES, shards)
    some = quotas.where("n > 0").select("_k", "n", (F.col("_k") % GROUPS).alias("group"))
    groups = sorted(some.groupBy("group").agg(F.sum("n")).collect())  # GROUPS rows at most
    edges = [(r * shards // ranges) * total // shards for r in range(ranges + 1)]
    counts = split_quotas(np.asarray([n for _, n in groups], np.int64), np.diff(edges), [seed, 0])
    cells = [(int(groups[g][0]), 1, int(r), int(counts[r, g])) for r, g in zip(*np.nonzero(counts), strict=True)]
    schema = "group long, kind int, key long, n long"
    cells = quotas.sparkSession.createDataFrame(cells, schema)
    parts = some.select("group", F.lit(0).alias("kind"), F.col("_k").alias("key"), "n").unionByName(cells)
    parts = parts.groupBy("group").applyInArrow(_split_group(seed), _SPLIT)
    parts = written(parts.groupBy("part").applyInArrow(_split_range(total, shards, ranges, seed), _SPLIT), "leaves")
    upto = F.sum("n").over(W.partitionBy("place").orderBy("part"))
    parts = parts.withColumn("_first", upto - F.col("n"))
    numbers = F.sequence(F.col("_first"), F.col("_first") + F.col("n") - 1)
    return parts.select(F.col("place").alias("_k"), F.col("part").alias("_shard"), F.explode(numbers).alias("_at"))


def _numbered(documents: DataFrame, *more: Column) -> DataFrame:
    """doc_id, source, size and text hash of every row, numbered, as a written table."""
    text = F.col("text").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    columns = [F.monotonically_increasing_id().alias("_row"), F.spark_partition_id().alias("_pid"), F.col("doc_id").cast("long").alias("doc_id")]
    return written(documents.select(*columns, F.col("source").cast("string").alias("source"), size.alias("_size"), F.xxhash64(text).alias("_hash"), *more), "numbered")


def taken(documents: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken of every row of ``documents``.

    Null texts have size 0. A null source is a source of its own, the last. Rows without doc_id and
    repeated rows take part like others, each by itself. Other columns are ignored; an empty table
    gives an empty result.
    """
    mix = plan_mix(_numbered(documents), **options)
    return mix.rows.select("doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.size("places")).alias("taken"))


def mixed(documents: DataFrame, seed: int = 1, **options) -> DataFrame:
    """The mix itself: rows of ``documents``, repeated as often as taken, dealt to shards and shuffled in each.

    The columns are those of ``documents``; a partition holds whole shards in order. Nulls, repeated
    rows and empty tables are treated as in ``taken``; empty texts come with the blocks they are in.
    """
    names = documents.columns
    numbered = _numbered(documents, F.struct(*[F.col(f"`{c}`") for c in names]).alias("_all"))
    mix = plan_mix(numbered, seed=seed, **options)
    order = F.xxhash64(F.lit(seed + 1), "_shard", "_turn", "_copy")
    dealt = mix.rows.select("_row", "_turn", F.explode("places").alias("p")).select("_row", "_turn", F.col("p.shard").alias("_shard"), F.col("p.copy").alias("_copy"))
    dealt = dealt.select(F.col("_row").alias("_r"), "_shard", order.alias("_order"))
    rows = numbered.select("_row", "_all").join(dealt, F.col("_row") == F.col("_r"))
    rows = rows.repartition(mix.shards, "_shard").sortWithinPartitions("_shard", "_order")
    return rows.select([F.col("_all")[c].alias(c) for c in names])
