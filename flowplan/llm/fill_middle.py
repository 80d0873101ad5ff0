"""Fill-in-the-middle rewriting of documents, with cuts looked up in a learned rank index.

A document is a run of units, letter runs or single other characters. Its index maps the rank of a
boundary to its code point: error-bounded line segments are fitted to all boundaries in one pass
(each segment as long as the cone of lines through its first point allows), a lookup predicts the
offset from the segment and adds the stored residual, so every cut is exact. The index of a
document is one byte per boundary and three numbers per segment, and lives no longer than its row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import slices

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "1:"
#: Of 100 documents so many are rewritten, and of 100 of those so many start with the suffix.
REWRITTEN, SUFFIX_FIRST = 90, 20
#: No boundary lies farther from its segment; residuals then fit a signed byte.
MAX_ERROR = 100
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, segments long, output string"


def boundaries(text: str) -> np.ndarray:
    """Code points at which units start, and the length of the text: n + 1 offsets for n units."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    lower = points | 32
    letter = (lower >= 97) & (lower <= 122) & (points < 128)
    starts = np.ones(len(points) + 1, bool)
    starts[1:-1] = ~(letter[1:] & letter[:-1])
    if not len(points):
        starts = np.ones(1, bool)
    return np.flatnonzero(starts)


class RankIndex:
    """Piecewise-linear map from rank to offset, corrected by residuals of at most ``MAX_ERROR`` + 1."""

    def __init__(self, offsets: np.ndarray, max_error: int = MAX_ERROR):
        firsts, slopes, start, n = [], [], 0, len(offsets)
        window = 512
        while start < n:
            slope, stop, window = self._grow(offsets, start, max_error, window)
            firsts.append(start)
            slopes.append(slope)
            start = stop
        self.first, self.slope = np.array(firsts, np.int64), np.array(slopes)
        self.base = offsets[self.first]
        ranks = np.arange(n)
        self.residual = (offsets - self._predict(ranks, np.repeat(np.arange(len(firsts)), np.diff([*firsts, n])))).astype(
            np.int8 if max_error < 127 else np.int64
        )

    @staticmethod
    def _grow(offsets, start, max_error, window):
        """The longest run from ``start`` that one line through its first point keeps within the bound."""
        low, high, stop, n = -np.inf, np.inf, start + 1, len(offsets)
        while stop < n:
            part = offsets[stop : stop + window] - offsets[start]
            run = np.arange(stop - start, stop - start + len(part))
            lows = np.maximum.accumulate(np.maximum((part - max_error) / run, low))
            highs = np.minimum.accumulate(np.minimum((part + max_error) / run, high))
            beyond = np.flatnonzero(lows > highs)
            fit = int(beyond[0]) if len(beyond) else len(part)
            if fit:
                low, high = lows[fit - 1], highs[fit - 1]
            stop += fit
            if len(beyond):
                break
            window = min(2 * window, 1 << 16)
        slope = 0.0 if stop == start + 1 else (low + high) / 2
        return slope, stop, max(64, min(1 << 16, stop - start))

    def _predict(self, rank, segment):
        return self.base[segment] + np.floor(self.slope[segment] * (rank - self.first[segment])).astype(np.int64)

    def __getitem__(self, rank: int) -> int:
        segment = int(np.searchsorted(self.first, rank, "right")) - 1
        return int(self._predict(rank, segment)) + int(self.residual[rank])


def rewrite(doc_id: int | None, text: str) -> tuple[int, str, int | None, int | None, int, str]:
    """n, form, characters of prefix and middle, segments of the index, and the output of one document."""
    digest = hashlib.sha256(f"{SEED}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    offsets = boundaries(text)
    index, n = RankIndex(offsets), len(offsets) - 1
    if not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= REWRITTEN:
        return n, "plain", None, None, len(index.first), text
    a, b = sorted((index[h[0] % (n + 1)], index[h[1] % (n + 1)]))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < SUFFIX_FIRST:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, a, b - a, len(index.first), output


def _rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = [field.split()[0] for field in SCHEMA.split(", ")]
    for batch in slices(batches, "text"):
        ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        rows = [(i, *rewrite(i, t or "")) for i, t in zip(ids, texts, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), types, strict=True)], names=names
        )


def fill_in_middle(documents: DataFrame) -> DataFrame:
    """One row per document: SCHEMA, with the rewritten text as ``output``.

    A null text counts as empty and stays plain; a null doc_id hashes as the empty string. Rows that
    repeat are rewritten alike, each for itself. Columns other than doc_id and text are not read. An
    empty table gives an empty one. A very long text is one row; its index takes a byte per unit.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_rewritten, SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from. Marks never occur in a rewritten text, so the first is the one meant."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        body = F.substr(output, F.lit(len(first) + 1))
        one = F.substring_index(body, second, 1)
        rest = F.substr(body, F.char_length(one) + len(second) + 1)
        two = F.substring_index(rest, MIDDLE, 1)
        return one, two, F.substr(rest, F.char_length(two) + len(MIDDLE) + 1)

    prefix, suffix, middle = parts(PREFIX, SUFFIX)
    tail, head, centre = parts(SUFFIX, PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(head, centre, tail))
        .otherwise(output)
    )


def digest(rewritten: DataFrame) -> DataFrame:
    """Hashes of the outputs and of the texts rebuilt from them."""
    return rewritten.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
