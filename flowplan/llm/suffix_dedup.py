"""Removal of every byte in a string of 400 that starts more than once, by suffix arrays of shards.

Shards are made by minimiser (see ``superkmer``), so all places where a string starts are in one
shard; a shard keeps only strings whose minimiser repeats, builds their suffix array and flags the
starts with a neighbour that shares 400 bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.llm import superkmer
from flowplan.llm.common import mix, slices, texts_of
from flowplan.llm.substring_dedup import covered, keys_of, row_keys, with_spans
from flowplan.llm.suffix_array import repeated_starts

WINDOW = 400
GRAM = 16
BUCKET_BYTES = 8 << 20
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
#: In place of a position: the batch has found the string more than once and settled its places.
SETTLED = -1


def _cut(buckets: int, window: int, gram: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = mix(np.arange(1, 257).astype(np.uint64))
        for batch in slices(batches, "text", 4 << 20):
            texts = texts_of(batch.column("text"))
            key, tag = keys_of(batch, texts)
            joined = b"".join(texts)
            lengths = np.fromiter(map(len, texts), np.int64, len(texts))
            p = superkmer.pieces(codes[np.frombuffer(joined, np.uint8)], lengths, window, gram)
            if not len(p.first):
                continue
            starts = np.cumsum(lengths) - lengths
            at, size = p.first - starts[p.doc], p.last - p.first + window
            strings = [joined[a : b + window] for a, b in zip(p.first.tolist(), p.last.tolist(), strict=True)]
            same = superkmer.first_equal(strings)
            many = np.bincount(same, minlength=len(same))[same] > 1
            if many.any():
                d = p.doc[many]
                yield superkmer.settled(int(tag[0] % buckets), key[d], tag[d], at[many], size[many])
            send = np.flatnonzero(same == np.arange(len(same)))
            d = p.doc[send]
            bucket = (p.minimiser[send] % np.uint64(buckets)).astype(np.int64)
            place = np.where(many[send], SETTLED, at[send])
            length = np.where(p.again[send], -size[send], size[send])
            yield from superkmer.pack(
                bucket, p.minimiser[send], key[d], tag[d], place, length, [strings[i] for i in send.tolist()], b""
            )

    return cut


def _judge(window: int):
    def judge(table: pa.Table) -> pa.Table:
        unpress, out = zstandard.ZstdDecompressor().decompress, []
        columns = [[np.frombuffer(x, np.int64) for x in table.column(c).to_pylist()] for c in ("key", "tag", "at", "size")]
        least = table.column("minimiser").to_pylist()
        for i in [i for i, m in enumerate(least) if m is None]:
            key, tag, at, size = (c[i] for c in columns)
            out.append((key, tag, at, at + size))
        packed = [i for i, m in enumerate(least) if m is not None]
        if packed:
            key, tag, at, size = (np.concatenate([c[i] for i in packed]) for c in columns)
            again, size = size < 0, np.abs(size)  # a negative size marks a minimiser that repeats inside
            minimiser = np.concatenate([np.frombuffer(least[i], np.uint64) for i in packed])
            _, inverse, counts = np.unique(minimiser, return_inverse=True, return_counts=True)
            keep, bodies, done = (counts[inverse] > 1) | again, [], 0
            for i in packed:
                n = len(columns[0][i])
                mine = np.flatnonzero(keep[done : done + n])
                if len(mine):
                    body, ends = unpress(table.column("body")[i].as_py()), np.cumsum(np.abs(columns[3][i]))
                    bodies += [body[a:b] for a, b in zip(np.append(0, ends)[mine].tolist(), ends[mine].tolist(), strict=True)]
                done += n
            if bodies:
                # A zero, which no shifted byte is, ends every string.
                text = np.frombuffer(b"\xff".join(bodies) + b"\xff", np.uint8) + np.uint8(1)
                key, tag, at, size = key[keep], tag[keep], at[keep], size[keep]
                n = size - window + 1
                base = np.cumsum(size + 1) - (size + 1)
                piece = np.repeat(np.arange(len(n)), n)
                offset = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                repeated = repeated_starts(text, window)[base[piece] + offset]
                a, b = superkmer.flagged_runs(repeated & (at[piece] != SETTLED), piece)
                p = piece[a]
                out.append((key[p], tag[p], at[p] + offset[a], at[p] + offset[b] + window))
        empty = [np.zeros(0, np.int64)] * 4
        return superkmer.intervals(*(np.concatenate(x) for x in zip(*(out or [empty]), strict=True)))

    return judge


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        texts, spans, rows = texts_of(batch.column("text")), batch.column("spans").to_pylist(), []
        for text, found in zip(texts, spans, strict=True):
            n, runs = len(text), 0
            if found:
                keep, runs = covered(n, found)
                text = np.frombuffer(text, np.uint8)[keep].tobytes()
            rows.append((n, n - len(text), runs, text))
        n, gone, runs, kept = zip(*rows, strict=True)
        numbers = [pa.array(x, pa.int64()) for x in (n, gone, runs)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *numbers, pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
        )


def remove_repeated_bytes(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes of every row.

    A byte goes when a string of ``window`` bytes over it also starts anywhere else, in the same row
    too; rows repeated as a whole count as two places. Null texts are empty, rows without doc_id are
    handled like others. Other columns are ignored; an empty table gives an empty result. Kept bytes
    need not be valid UTF-8, as a string may begin inside a character.
    """
    rows = row_keys(documents)
    buckets = superkmer.bucket_count(rows, window, BUCKET_BYTES)
    packed = rows.mapInArrow(_cut(buckets, window, gram), superkmer.PACKED)
    found = packed.groupBy("bucket").applyInArrow(_judge(window), superkmer.INTERVALS)
    return with_spans(rows, found).mapInArrow(_kept, RESULT)


def digest(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
