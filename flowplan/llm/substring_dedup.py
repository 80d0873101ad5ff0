"""Removal of word windows that also start in an earlier document, by super-k-mer partitioning."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from flowplan.llm import superkmer
from flowplan.llm.common import WordHasher, mix, slices, texts_of

WINDOW = 50
GRAM = 5
BUCKET_BYTES = 16 << 20
RESULT = "doc_id long, n_words long, n_removed long, n_spans long, kept string"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def keys_of(batch: pa.RecordBatch, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """doc_id, and a hash of the text that tells rows with the same doc_id apart."""
    key = np.asarray(pa.compute.fill_null(batch.column("doc_id"), superkmer.NO_ID)).astype(np.int64)
    return key, np.fromiter((_signed(xxh3_64_intdigest(t)) for t in texts), np.int64, len(texts))


def _first_in_bucket(ids: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """A group number for every window start; equal windows, and only they, share one.

    Windows are sorted by a hash, and each is compared word by word with the first of its hash; those
    that differ from it are grouped again among themselves.
    """
    group = np.full(len(starts), -1, np.int64)
    code = superkmer.rolling(mix(ids.astype(np.uint64) + np.uint64(1)), window)[starts]
    left, used = np.arange(len(starts)), 0
    while len(left):
        order = left[np.argsort(code[left], kind="stable")]
        new = np.ones(len(order), bool)
        new[1:] = code[order[1:]] != code[order[:-1]]
        number = np.cumsum(new) - 1
        head = order[np.flatnonzero(new)][number]
        same = np.ones(len(order), bool)
        for j in range(window):
            same &= ids[starts[order] + j] == ids[starts[head] + j]
        group[order[same]] = used + number[same]
        used += int(number[-1]) + 1
        left = order[~same]
    return group


def _cut(buckets: int, window: int, gram: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(150_000)
        for batch in slices(batches, "text", 4 << 20):
            texts = texts_of(batch.column("text"))
            key, tag = keys_of(batch, texts)
            lists = [t.split() for t in texts]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            words = [w for x in lists for w in x]
            p = superkmer.pieces(hasher(words), lengths, window, gram)
            if not len(p.first):
                continue
            starts = np.cumsum(lengths) - lengths
            at, size = p.first - starts[p.doc], p.last - p.first + window
            strings = [b" ".join(words[a : b + window]) for a, b in zip(p.first.tolist(), p.last.tolist(), strict=True)]
            same = superkmer.first_equal(strings)
            least = np.full(len(strings), superkmer.NO_ID)
            np.minimum.at(least, same, key[p.doc])
            later = key[p.doc] > least[same]
            if later.any():
                d = p.doc[later]
                yield superkmer.settled(int(tag[0] % buckets), key[d], tag[d], at[later], size[later])
            send = np.flatnonzero(~later)
            d = p.doc[send]
            bucket = (p.minimiser[send] % np.uint64(buckets)).astype(np.int64)
            yield from superkmer.pack(
                bucket, p.minimiser[send], key[d], tag[d], at[send], size[send], [strings[i] for i in send.tolist()], b"\n"
            )

    return cut


def _judge(window: int):
    def judge(table: pa.Table) -> pa.Table:
        unpress, out = zstandard.ZstdDecompressor().decompress, []
        columns = [[np.frombuffer(x, t) for x in table.column(c).to_pylist()] for c, t in zip(("key", "tag", "at", "size"), [np.int64] * 4, strict=True)]
        least = table.column("minimiser").to_pylist()
        for i in [i for i, m in enumerate(least) if m is None]:
            key, tag, at, size = (c[i] for c in columns)
            out.append((key, tag, at, at + size))
        packed = [i for i, m in enumerate(least) if m is not None]
        if packed:
            key, tag, at, size = (np.concatenate([c[i] for i in packed]) for c in columns)
            minimiser = np.concatenate([np.frombuffer(least[i], np.uint64) for i in packed])
            _, inverse = np.unique(minimiser, return_inverse=True)
            low, high = np.full(inverse.max() + 1, superkmer.NO_ID), np.full(inverse.max() + 1, -superkmer.NO_ID)
            np.minimum.at(low, inverse, key)
            np.maximum.at(high, inverse, key)
            keep = (low < high)[inverse]  # some other document has the minimiser
            numbers: dict[bytes, int] = {}
            ids, done = [], 0
            for i in packed:
                n = len(columns[0][i])
                if keep[done : done + n].any():
                    lines = unpress(table.column("body")[i].as_py()).split(b"\n")
                    words = [w for j in np.flatnonzero(keep[done : done + n]).tolist() for w in lines[j].split(b" ")]
                    ids.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words)))
                done += n
            if ids:
                ids = np.concatenate(ids)
                key, tag, at, size = key[keep], tag[keep], at[keep], size[keep]
                n = size - window + 1
                base = np.cumsum(size) - size
                piece = np.repeat(np.arange(len(n)), n)
                offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                group = _first_in_bucket(ids, base[piece] + offset, window)
                least_key = np.full(int(group.max()) + 1, superkmer.NO_ID)
                np.minimum.at(least_key, group, key[piece])
                a, b = superkmer.flagged_runs(key[piece] > least_key[group], piece)
                p = piece[a]
                out.append((key[p], tag[p], at[p] + offset[a], at[p] + offset[b] + window))
        empty = [np.zeros(0, np.int64)] * 4
        return superkmer.intervals(*(np.concatenate(x) for x in zip(*(out or [empty]), strict=True)))

    return judge


def covered(n: int, spans: list[dict] | None) -> tuple[np.ndarray, int]:
    """Which of ``n`` positions no span covers, and the number of maximal covered runs."""
    edge = np.zeros(n + 1, np.int64)
    for s in spans or ():
        edge[s["start"]] += 1
        edge[s["stop"]] -= 1
    gone = np.cumsum(edge[:n]) > 0
    return ~gone, int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts, spans, rows = texts_of(batch.column("text")), batch.column("spans").to_pylist(), []
        for text, found in zip(texts, spans, strict=True):
            words = text.split()
            runs = 0
            n = len(words)
            if found:
                keep, runs = covered(n, found)
                words = [words[i] for i in np.flatnonzero(keep).tolist()]
            rows.append((n, n - len(words), runs, b" ".join(words)))
        n, gone, runs, kept = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "n_spans", "kept"],
        )


def row_keys(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, text and the spans found for that row."""

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, tag = keys_of(batch, texts_of(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text"), pa.array(key), pa.array(tag)], names=["doc_id", "text", "key", "tag"]
            )

    keyed = rows.mapInArrow(tagged, "doc_id long, text string, key long, tag long")
    return keyed.join(superkmer.per_document(spans), ["key", "tag"], "left").select("doc_id", "text", "spans")


def remove_repeated_windows(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans and the kept words of every row.

    A word goes when a window over it also starts in a row with a smaller doc_id. Null texts have no
    words, rows without doc_id count as last, rows that share a doc_id do not remove each other's
    words. Other columns are ignored; an empty table gives an empty result.
    """
    rows = row_keys(documents)
    buckets = superkmer.bucket_count(rows, window, BUCKET_BYTES)
    packed = rows.mapInArrow(_cut(buckets, window, gram), superkmer.PACKED)
    found = packed.groupBy("bucket").applyInArrow(_judge(window), superkmer.INTERVALS)
    return with_spans(rows, found).mapInArrow(_kept, RESULT)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
