"""Super-k-mers: neighbouring windows that share a minimiser travel as one packed string.

The minimiser of a window is the least hash of the short grams in it. Equal windows have equal
minimisers, so a bucket by minimiser holds all occurrences of a window, and every window of a
document travels in exactly one string. Of strings that repeat in one batch only what the bucket
has to know is sent, so a passage in a third of all documents costs one string per batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import mix

PACKED = "bucket int, minimiser binary, key binary, tag binary, at binary, size binary, body binary"
_NAMES = ["bucket", "minimiser", "key", "tag", "at", "size", "body"]
INTERVALS = "key long, tag long, start long, stop long"
#: A row without doc_id counts as one with the greatest.
NO_ID = (1 << 63) - 1
_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    if base not in _powers or len(_powers[base]) < n:
        factors = np.full(max(n, 1 << 16), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.cumprod(factors)
    return _powers[base][:n]


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every ``width`` neighbours, from prefix sums of a polynomial."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers_of(_BASE, len(values)), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * _powers_of(pow(_BASE, -1, 1 << 64), n))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, by windows of doubling length."""
    if len(values) < width:
        return values[:0]
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass
class Pieces:
    """Super-k-mers of a batch: first and last window (positions in the batch), minimiser, document.

    ``again``: the minimiser stands more than once in the string, so two of its own windows may be equal.
    """

    first: np.ndarray
    last: np.ndarray
    minimiser: np.ndarray
    doc: np.ndarray
    again: np.ndarray


def pieces(values: np.ndarray, lengths: np.ndarray, window: int, gram: int) -> Pieces:
    """The super-k-mers of documents whose symbol hashes lie one after another in ``values``."""
    # The upper half of a gram's hash with its place in the lower half: the leftmost of the least is
    # the minimiser; with places counted from the end it is the rightmost.
    grams, low32 = rolling(values, gram), np.uint64((1 << 32) - 1)
    place = np.arange(len(grams), dtype=np.uint64)
    left = sliding_min((grams & ~low32) | place, window - gram + 1) & low32
    right = low32 - (sliding_min((grams & ~low32) | (low32 - place), window - gram + 1) & low32)
    least = grams[left.astype(np.int64)]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    n = np.maximum(lengths - window + 1, 0)
    total = int(n.sum())
    doc = np.repeat(np.arange(len(lengths)), n)
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(total)
    low = least[at] if total else np.zeros(0, np.uint64)
    new = np.ones(total, bool)
    new[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], total) - 1
    if not total:
        return Pieces(at, at, low, doc, new)
    return Pieces(at[head], at[tail], low[head], doc[head], left[at[head]] != right[at[tail]])


def first_equal(strings: list[bytes]) -> np.ndarray:
    """For each string the index of the first one equal to it."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(s, i) for i, s in enumerate(strings)), np.int64, len(strings))


def pack(bucket: np.ndarray, minimiser, key, tag, at, size, strings: list[bytes], glue: bytes) -> Iterator[pa.RecordBatch]:
    """One row for each bucket of a batch."""
    press = zstandard.ZstdCompressor(level=3).compress
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    rows = [[] for _ in _NAMES]
    for part in np.split(order, cuts) if len(order) else []:
        body = press(glue.join([strings[i] for i in part.tolist()]))
        values = [int(bucket[part[0]]), *(x[part].tobytes() for x in (minimiser, key, tag, at, size)), body]
        for column, value in zip(rows, values, strict=True):
            column.append(value)
    yield _batch(rows)


def settled(bucket: int, key: np.ndarray, tag: np.ndarray, at: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """A row of intervals that the batch itself has decided; the bucket only passes them on."""
    return _batch([[bucket], [None], [key.tobytes()], [tag.tobytes()], [at.tobytes()], [size.tobytes()], [b""]])


def _batch(rows: list[list]) -> pa.RecordBatch:
    types = [pa.int32(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, types, strict=True)], names=_NAMES)


def intervals(key, tag, start, stop) -> pa.Table:
    values = [np.asarray(key, np.int64), np.asarray(tag, np.int64), np.asarray(start, np.int64), np.asarray(stop, np.int64)]
    return pa.table([pa.array(v) for v in values], names=["key", "tag", "start", "stop"])


def flagged_runs(flagged: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of every run of flagged neighbours within one piece."""
    index = np.flatnonzero(flagged)
    if not len(index):
        return index, index
    new = np.ones(len(index), bool)
    new[1:] = (np.diff(index) > 1) | (piece[index[1:]] != piece[index[:-1]])
    head = np.flatnonzero(new)
    return index[head], index[np.append(head[1:], len(index)) - 1]


def bucket_count(documents: DataFrame, window: int, bucket_bytes: int) -> int:
    """Buckets of about ``bucket_bytes`` of packed strings, about three times the text."""
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-3 * total // bucket_bytes))


def per_document(found: DataFrame) -> DataFrame:
    """The intervals of each document as one list; it is bounded by the document's length."""
    return found.groupBy("key", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
