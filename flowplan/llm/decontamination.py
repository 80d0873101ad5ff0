"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

Documents fall into partitions by the power of two above their number of shingles. A partition has
its own number of MinHash bands: one permutation is cut into bins, many more than the shingles of
its largest document, and each bin's least hash is one band of one row. A short item that is
contained in a long document then shares a band with it almost surely, although the two sets are
hardly similar; a shared band makes a candidate. An item that few shingles make found could miss
every band, so each of its hashes is looked up among all hashes of a document. Candidates are verified by counting the item's
shingles, word by word. Items are held by the tasks, in blocks of a fixed size, so documents are
not shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import WordHasher, shingle_hashes, slices, texts_of

WIDTH = 5
#: Items are searched in blocks of about so many bytes of text.
BLOCK_BYTES = 16 << 20
#: Shingles of a document per bin, at most: a shingle is its bin's least with a chance over 97 %.
LOAD = 1 / 16
#: Items that so many shingles, or fewer, make found are looked up by every hash.
FEW = 5
_PREFILTER = 22
RESULT = "doc_id long, item_id long, n_item long, n_shared long, containment double"


def _words(text: bytes) -> list[bytes]:
    return text.lower().split()


def _bits(n: np.ndarray) -> np.ndarray:
    """log2 of the number of bins of a set of ``n`` shingles."""
    return np.clip(np.ceil(np.log2(np.maximum(n, 1) / LOAD)), 1, 63).astype(np.uint64)


class ItemIndex:
    """The items of a block by shingle hash, with the bins from which on each hash is a band of its item.

    ``every`` marks the hashes that are looked up whether they are bands or not.
    """

    def __init__(self, items: list[tuple[int, bytes]], width: int, percent: int = 75):
        hasher = WordHasher()
        self.ids, self.shingles, self.spans = [], [], []
        hashes, owner, least, every = [], [], [], []
        for item_id, text in items:
            words = _words(text)
            if not words:
                continue
            k = min(width, len(words))
            h = np.unique(shingle_hashes(hasher(words), k))
            # With one bit more than it shares with the hash before it, a hash has a bin of its own.
            gap = h[1:] ^ h[:-1]
            common = np.asarray([64 - int(g).bit_length() for g in gap], np.uint64)
            hashes.append(h)
            least.append(np.concatenate([np.zeros(1, np.uint64), common + np.uint64(1)]))
            owner.append(np.full(len(h), len(self.ids)))
            every.append(np.full(len(h), percent * len(h) <= 100 * FEW))
            self.ids.append(item_id)
            self.spans.append(k)
            self.shingles.append({b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)})
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(self.hash, kind="stable")
        self.hash = self.hash[order]
        self.owner = np.concatenate(owner)[order] if owner else np.zeros(0, np.int64)
        self.least = np.concatenate(least)[order] if least else np.zeros(0, np.uint64)
        self.every = np.concatenate(every)[order] if every else np.zeros(0, bool)
        low = (self.hash & np.uint64((1 << _PREFILTER) - 1)).astype(np.int64)
        self.seen, self.seen_every = np.zeros(1 << _PREFILTER, bool), np.zeros(1 << _PREFILTER, bool)
        self.seen[low], self.seen_every[low[self.every]] = True, True

    def candidates(self, sets: list[np.ndarray]) -> set[tuple[int, int]]:
        """(set, item) that share a band, or any hash of an item with few. Every set is sorted."""
        n = np.fromiter(map(len, sets), np.int64, len(sets))
        if not n.sum() or not len(self.hash):
            return set()
        h, doc = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
        bits = _bits(n)[doc]
        band = h >> (np.uint64(64) - bits)
        first = np.ones(len(h), bool)
        first[1:] = (band[1:] != band[:-1]) | (doc[1:] != doc[:-1])
        low = (h & np.uint64((1 << _PREFILTER) - 1)).astype(np.int64)
        known = first & self.seen[low] | self.seen_every[low]
        h, doc, bits, first = h[known], doc[known], bits[known], first[known]
        a, b = np.searchsorted(self.hash, h, "left"), np.searchsorted(self.hash, h, "right")
        out = set()
        for i in np.flatnonzero(b > a).tolist():
            for j in range(a[i], b[i]):
                if self.every[j] or first[i] and self.least[j] <= bits[i]:
                    out.add((int(doc[i]), int(self.owner[j])))
        return out


def _search(index: ItemIndex, percent: int, width: int):
    """Found pairs of a batch, under the row's ``tag`` if it has one."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(150_000)
        spans = sorted(set(index.spans) | {width})
        for batch in slices(batches, "text", 4 << 20):
            texts = texts_of(batch.column("text"))
            word_hashes = []
            for t in texts:
                word_hashes.append(hasher(_words(t)))
            pairs: set[tuple[int, int]] = set()
            for k in spans:
                sets = [np.unique(shingle_hashes(h, k)) for h in word_hashes]
                pairs |= {(d, i) for d, i in index.candidates(sets) if index.spans[i] == k}
            by_doc = defaultdict(list)
            for d, i in pairs:
                by_doc[d].append(i)
            rows, doc_ids = [], batch.column("doc_id")
            tags = batch.column("tag") if "tag" in batch.schema.names else None
            for d in sorted(by_doc):
                words, grams = _words(texts[d]), {}
                for i in sorted(by_doc[d]):
                    k = index.spans[i]
                    if k not in grams:
                        grams[k] = {b" ".join(words[j : j + k]) for j in range(len(words) - k + 1)}
                    size, shared = len(index.shingles[i]), len(index.shingles[i] & grams[k])
                    if 100 * shared >= percent * size:
                        rows.append((doc_ids[d].as_py(), index.ids[i], size, shared, shared / size, tags[d].as_py() if tags is not None else None))
            if rows:
                values = [pa.array(v, t) for v, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.float64(), pa.int64()], strict=True)]
                names = ["doc_id", "item_id", "n_item", "n_shared", "containment", "tag"]
                yield pa.RecordBatch.from_arrays(values[: 5 + (tags is not None)], names=names[: 5 + (tags is not None)])

    return search


def contaminated(documents: DataFrame, benchmark: DataFrame, percent: int = 75, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment) of every row of ``documents`` and item found in it.

    An item is found when ``100 * n_shared >= percent * n_item`` of its distinct shingles of ``width``
    words, A-Z lower-cased, stand in the document; an item with fewer words is one shingle. Null and
    empty texts and items match nothing; repeated rows and items each give their rows. Other columns
    are ignored.
    """
    return _found(documents.select(*_key()), benchmark, percent, width, block_bytes, RESULT)


def _key() -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]


def _found(rows: DataFrame, benchmark: DataFrame, percent: int, width: int, block_bytes: int, result: str) -> DataFrame:
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    spark, found = rows.sparkSession, []
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        index = ItemIndex([(r.item_id, r.text.encode()) for r in mine.collect()], width, percent)
        if index.ids:
            found.append(rows.mapInArrow(_search(index, percent, width), result))
    if not found:
        return spark.createDataFrame([], result)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def clean(documents: DataFrame, benchmark: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``documents`` in which no item is found, with all their columns.

    A row is told by its doc_id and a hash of its text, so rows that share a doc_id, or have none, are
    judged one by one.
    """
    tag = F.xxhash64(F.col("text").cast("string"))
    hits = _found(documents.select(*_key(), tag.alias("tag")), benchmark, percent, WIDTH, BLOCK_BYTES, f"{RESULT}, tag long")
    hits = hits.select(F.col("doc_id").alias("_hit"), F.col("tag").alias("_tag")).distinct()
    return documents.join(hits, documents["doc_id"].cast("long").eqNullSafe(hits["_hit"]) & (tag == hits["_tag"]), "left_anti")
