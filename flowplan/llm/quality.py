"""Document quality by Bradley-Terry ranking of preference pairs.

A document labelled 1 is preferred to one labelled 0. The score is linear in features of the text;
its weights minimise the logistic loss on feature differences of such pairs. A quantile of the
scores of labelled documents is the threshold, and scores are shifted so that it lies at 0.3.
Every labelled document that is not held out is learned from: tasks keep the features of their share and
return sums, so neither rows nor pairs reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import give_back_memory, slices, texts_of
from flowplan.session import cut_lineage

CUT = 0.3
#: Preference pairs of each learned row of the rarer class.
PAIRS = 4
RIDGE = 1e-2
#: Labelled rows of a task, and of a block within which they are paired.
PART, BLOCK = 8_192, 2_048
#: Scores are counted in so many equal bins; the threshold lies between two of them.
BINS = 1 << 16
#: Sums of tasks are added up in so many groups.
GROUPS = 32

_GROUPS = (
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r\x0b\x0c", b".", b",", b"!?",
    b"%$#*&@^~", b"|<>{}[]\\/_=+`", b"'\"()-:;",
)
N_CLASS = len(_GROUPS) + 2


def _classes() -> np.ndarray:
    table = np.full(256, len(_GROUPS), np.int64)
    table[128:] = len(_GROUPS) + 1
    for i, group in enumerate(_GROUPS):
        table[list(group)] = i
    return table


def features(texts: list[bytes]) -> np.ndarray:
    """One row per text: roots of the rates of byte-class pairs, then length and repetition figures."""
    n = len(texts)
    table = _classes()
    lengths = np.fromiter(map(len, texts), np.int64, n)
    out = np.zeros((n, N_CLASS * N_CLASS + 6))
    # A line end between texts: pairs with it count for the text before it and are the same for all.
    codes = table[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    doc = np.repeat(np.arange(n), lengths + 1)
    pair = codes[:-1] * N_CLASS + codes[1:]
    counts = np.bincount(doc[:-1] * (N_CLASS * N_CLASS) + pair, minlength=n * N_CLASS * N_CLASS).reshape(n, -1)
    out[:, :-6] = np.sqrt(counts / (lengths + 1)[:, None])
    for i, text in enumerate(texts):
        words, lines = text.split(), text.split(b"\n")
        m = len(words)
        out[i, -6:] = (
            np.log1p(m),
            np.log1p(len(text) / (m or 1)),
            len(set(words)) / (m or 1),
            len(set(lines)) / len(lines),
            np.log1p(len(text) / len(lines)),
            m == 0,
        )
    return out


@dataclass(frozen=True)
class Ranking:
    """Weights of standardised features, and the score at the threshold."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(CUT / (1 - CUT))
        value = 1 / (1 + np.exp(-np.clip(self.raw(x) - self.threshold + shift, -35, 35)))
        # The threshold itself is kept, whatever rounding does to the exponential.
        return np.where(self.raw(x) >= self.threshold, np.maximum(value, CUT), np.minimum(value, np.nextafter(CUT, 0)))


def _pairs(x: np.ndarray, good: np.ndarray, pairs: int) -> np.ndarray:
    """Feature differences of preferred and rejected rows; every row is in one at least."""
    g, b = x[good], x[~good]
    n = max(pairs * min(len(g), len(b)), len(g), len(b))
    rng = np.random.default_rng(0)
    return g[rng.permutation(np.resize(np.arange(len(g)), n))] - b[rng.permutation(np.resize(np.arange(len(b)), n))]


def _slopes(d: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Sums of the gradient and the hessian of the loss over pairs, with their number, in one row."""
    p = 1 / (1 + np.exp(np.clip(d @ w, -35, 35)))
    return np.concatenate([d.T @ p, ((d * (p * (1 - p))[:, None]).T @ d).ravel(), [len(d)]])


def _weights(width: int, slopes: Callable[[np.ndarray], np.ndarray], ridge: float) -> np.ndarray:
    w = np.zeros(width)
    for _ in range(30):  # Newton steps on a convex loss; they end at its minimum
        sums = slopes(w)
        n = max(sums[-1], 1.0)
        gradient = sums[:width] / n - ridge * w
        hessian = sums[width:-1].reshape(width, width) / n + ridge * np.eye(width)
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    return w


def _spread(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and scale from number, sums and sums of squares."""
    n, width = sums[0], (len(sums) - 1) // 2
    mean = sums[1 : width + 1] / n
    scale = np.sqrt(np.maximum(sums[width + 1 :] / n - mean**2, 0.0))
    return mean, np.where(scale < 1e-6, 1.0, scale)


def _sums(x: np.ndarray) -> np.ndarray:
    return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])


def _range(least: float, most: float) -> tuple[float, float]:
    """Borders that lie beyond all scores, whatever rounding does to them."""
    return least - 1e-9 * (1 + abs(least)), most + 1e-9 * (1 + abs(most))


def _bins(scores: np.ndarray, borders: tuple[float, float]) -> np.ndarray:
    return np.clip((scores - borders[0]) / (borders[1] - borders[0]) * BINS, 0, BINS - 1).astype(np.int64)


def _binned(scores: np.ndarray, good: np.ndarray, borders: tuple[float, float]) -> dict[str, np.ndarray]:
    """Rows of every bin and class that has any, with their least and greatest score."""
    bins = _bins(scores, borders) * 2 + good
    order = np.lexsort((scores, bins))
    bins, scores = bins[order], scores[order]
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    last = np.append(first[1:], len(bins)) - 1
    return {"bin": bins[first], "n": last - first + 1, "least": scores[first], "most": scores[last]}


def _threshold(bin: np.ndarray, n: np.ndarray, least: np.ndarray, most: np.ndarray, bad_share: float) -> float:
    """Midway between the scores beside the border that errs least; of equal ones the middle."""
    held, low, high = np.zeros((BINS, 2)), np.full(BINS, np.inf), np.full(BINS, -np.inf)
    np.add.at(held, (bin >> 1, bin & 1), n)
    np.minimum.at(low, bin >> 1, least)
    np.maximum.at(high, bin >> 1, most)
    full = np.flatnonzero(held.sum(1))
    bad, good = held[full].T
    gain = good / good.sum() * (1 - bad_share) - bad / bad.sum() * bad_share
    errors = bad_share + np.concatenate([[0], np.cumsum(gain)])  # when the first k bins are rejected
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    k = int(best[len(best) // 2])
    values = np.concatenate([[low[full[0]] - 1], high[full]]), np.concatenate([low[full], [high[full[-1]] + 1]])
    return float((values[0][k] + values[1][k]) / 2)


def fit(good: np.ndarray, bad: np.ndarray, bad_share: float, pairs: int = PAIRS, ridge: float = RIDGE) -> Ranking:
    """Learn from feature rows of preferred and rejected documents that are at hand; ``learn`` does the same over tasks.

    The threshold is the score quantile, in the mixture with ``bad_share`` of rejected documents, that
    errs least; of equal ones the middle. Without rows of both classes all scores are alike and above it.
    """
    width = good.shape[1]
    if not len(good) or not len(bad):
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), -1.0)
    both = np.concatenate([good, bad])
    is_good = np.arange(len(both)) < len(good)
    mean, scale = _spread(_sums(both))
    x = np.clip((both - mean) / scale, -8, 8)
    d = _pairs(x, is_good, pairs)
    w = _weights(width, lambda w: _slopes(d, w), ridge)
    scores = x @ w
    borders = _range(scores.min(), scores.max())
    return Ranking(mean, scale, w, _threshold(**_binned(scores, is_good, borders), bad_share=bad_share))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _labelled(batches: Iterable[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature rows and whether they are preferred, in blocks that hold both classes; what is left over at the end may not."""


    def ordered(x: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = [row.tobytes() for row in x.astype(np.float32)]
        turn = sorted(range(len(raw)), key=raw.__getitem__)  # pairs depend on the rows alone
        return x[turn], good[turn]

    x, good = np.zeros((0, width)), np.zeros(0, bool)
    for batch in batches:
        values = np.frombuffer(b"".join(batch.column("x").to_pylist()), np.float32).reshape(-1, width).astype(float)
        x, good = np.concatenate([x, values]), np.concatenate([good, batch.column("quality").to_numpy() == 1])
        while len(x) >= 2 * BLOCK and 0 < good[:BLOCK].sum() < BLOCK and 0 < good[BLOCK:].sum() < len(x) - BLOCK:
            yield ordered(x[:BLOCK], good[:BLOCK])
            x, good = x[BLOCK:], good[BLOCK:]
    if len(x):
        yield ordered(x, good)


def _summed(rows: DataFrame, width: int, size: int, work: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """``work`` on all blocks, added up in the order of tasks."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for x, good in _labelled(batches, width):
            total += work(x, good)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    def added(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.zeros(size)
        for value in table.column("sums"):
            total += np.frombuffer(value.as_py())
        return pa.table([pa.array([table.column("part")[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["part", "sums"])

    groups = rows.mapInArrow(parts, "part int, sums binary").groupBy(F.col("part") % GROUPS).applyInArrow(added, "part int, sums binary")
    return np.sum([np.frombuffer(r.sums) for r in groups.orderBy("part").collect()] + [np.zeros(size)], axis=0)


def learn(documents: DataFrame, labels: DataFrame, pairs: int = PAIRS, ridge: float = RIDGE) -> Ranking:
    """Fit on all labelled, not held-out documents."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    usable = usable.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    counts = {r["quality"]: r["count"] for r in usable.groupBy("quality").count().collect()}
    total, rarer = sum(counts.values()), min(counts.get(0, 0), counts.get(1, 0))
    width = N_CLASS * N_CLASS + 6
    none = Ranking(np.zeros(width), np.ones(width), np.zeros(width), -1.0)
    if not rarer:
        return none

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            values = [row.tobytes() for row in features(texts_of(batch.column("text"))).astype(np.float32)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.binary())], names=["doc_id", "x"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Features are shorter than texts, so they are what travels where labels are too many to be broadcast.
    found = texts.where(F.col("doc_id").isNotNull() & ~held_out()).mapInArrow(rows, "doc_id long, x binary").join(usable, "doc_id")
    # No task without some rows of the rarer class to pair with; within a task rows are in the order of a hash.
    tasks = max(1, min(total // PART, rarer // 16))
    found = found.select(F.xxhash64("doc_id").alias("turn"), "quality", "x").repartition(tasks, "turn")
    found = cut_lineage(found.sortWithinPartitions("turn", "quality", "x").select("quality", "x"))
    # Labels without document are no rows.
    sums = _summed(found, width, 2 * width + 2, lambda x, good: np.concatenate([[good.sum()], _sums(x)]))
    n, n_good = sums[1], sums[0]
    if not 0 < n_good < n:
        return none
    mean, scale = _spread(sums[1:])

    def standard(x: np.ndarray) -> np.ndarray:
        return np.clip((x - mean) / scale, -8, 8)

    def slopes(w: np.ndarray) -> np.ndarray:
        def work(x: np.ndarray, good: np.ndarray) -> np.ndarray:
            return _slopes(_pairs(standard(x), good, pairs), w) if 0 < good.sum() < len(good) else np.zeros(width * width + width + 1)

        return _summed(found, width, width * width + width + 1, work)

    w = _weights(width, slopes, ridge)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _ in _labelled(batches, width):
            scores = standard(x) @ w
            yield pa.RecordBatch.from_arrays([pa.array([scores.min()]), pa.array([scores.max()])], names=["least", "most"])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, good in _labelled(batches, width):
            made = _binned(standard(x) @ w, good, borders)
            yield pa.RecordBatch.from_pydict({name: pa.array(values) for name, values in made.items()})

    borders = _range(*found.mapInArrow(ends, "least double, most double").agg(F.min("least"), F.max("most")).first())
    bins = found.mapInArrow(binned, "bin long, n long, least double, most double").groupBy("bin")
    bins = bins.agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).collect()
    held = {name: np.array([r[name] for r in bins]) for name in ("bin", "n", "least", "most")}
    return Ranking(mean, scale, w, _threshold(**held, bad_share=counts[0] / total))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``documents``.

    Null texts count as empty and are scored too; rows without doc_id are never learned from and not
    held out. Labels other than 0 and 1 and labels without document are ignored, documents without
    label are only scored; a doc_id labelled twice counts twice. Other columns are no inputs.
    """
    ranking = learn(documents, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 2 << 20):
            score = ranking.score(features(texts_of(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("held_out", held_out()).select("doc_id", "held_out", "text")
    found = rows.mapInArrow(scored, "doc_id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the classifier accepts, with all their columns."""
    ranking = learn(documents, labels)

    @F.pandas_udf("boolean")
    def accepted(texts: pd.Series) -> pd.Series:
        give_back_memory()
        values = [(t or "").encode() for t in texts]
        out = np.zeros(len(values), bool)
        at = 0
        while at < len(values):
            end, size = at, 0
            while end < len(values) and (end == at or size + len(values[end]) <= 4 << 20):
                size += len(values[end])
                end += 1
            out[at:end] = ranking.score(features(values[at:end])) >= CUT
            at = end
        return pd.Series(out)

    return documents.where(accepted(F.col("text").cast("string")))
