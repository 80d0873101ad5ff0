"""Documents whose word shingles overlap by three quarters, joined by vertical partitioning.

Shingles are 64-bit hashes ordered by value; the order is cut into fragments. A first pass over half
of the order counts per document the shingles that no other set has: with more than a quarter of its
set it can link to nothing, whatever the other half holds. Equal sets are one class from there on.
Each remaining class is compared with the most central class of its min-hash buckets, and the links
found give groups. Then a class takes part only while three quarters of its shingles are shared
with other groups. Its shingles are put in one order for all classes, the rarest first; a fragment
lists the pairs of different groups that share a shingle early enough in both for a link. So no link
between groups is lost, a shingle of very many classes costs only the pairs it may link, and pairs of
the group that has a shingle most often are never listed. Of the listed pairs, the overlaps of those
whose histograms allow a link are counted by fragment and summed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowplan.llm.common import WordHasher, mix, shingle_hashes, slices, texts_of, written
from flowplan.llm.components import components

WIDTH = 5
#: Shingles in a fragment, about.
FRAGMENT = 1 << 21
BANDS = 4
#: Ranges of the order in the histograms that bound what two sets differ in.
BINS = 256
#: Pairs a fragment looks at in one go, about.
LISTED = 1 << 20
NO_ID = (1 << 63) - 1
_SPREAD = "fragment int, batch long, place binary, owner binary, sizes binary, hashes binary, marks binary, docs binary"
_SPREAD_NAMES = ["fragment", "batch", "place", "owner", "sizes", "hashes", "marks", "docs"]
_SPREAD_TYPES = {"place": np.int32, "owner": np.int64, "sizes": np.int32, "hashes": np.uint32, "marks": np.uint32}
_COUNTED = "batch long, place binary, shared binary, repeats binary, docs binary"
_OFTEN = "batch long, place binary, token binary, often binary, docs binary"
_EARLY = "fragment int, token long, at long, hi long, n long, label long"
_CLASS = "hi long, lo long, key long, n long, digest long, unshared long, weight double"


def shingle_sets(texts: list[bytes], hasher: WordHasher, width: int = WIDTH) -> list[np.ndarray]:
    """The distinct shingles of each text, sorted; fewer words than ``width`` are one shingle."""
    out = []
    for text in texts:
        words = text.lower().split()
        hashes = hasher(words)
        out.append(np.unique(shingle_hashes(hashes, min(width, len(words)) or 1)) if words else hashes)
    return out


def _signature(s: np.ndarray) -> tuple[int, int]:
    if not len(s):
        return 0, 0
    a, b = mix(s), mix(s ^ np.uint64(0x5851F42D4C957F2D))
    return int(a.sum(dtype=np.uint64).view(np.int64)), int(b.sum(dtype=np.uint64).view(np.int64))


def _spread(batch: int, fragments: int, share: float, owner: np.ndarray, sets: list[np.ndarray], docs: np.ndarray, marked: bool) -> pa.RecordBatch:
    """One row per fragment: the sets with shingles there and these; the first with ``docs`` and the number of shingles sent for each.

    If ``marked``, a shingle of several sets goes once, as a mark. ``docs`` ends with the place of its set.
    """
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    place = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
    span = (1 << 64) * share / fragments
    if share < 1:
        inside = hashes < np.uint64(int((1 << 64) * share))
        hashes, place = hashes[inside], place[inside]
    mark = np.zeros(0, np.uint64)
    if marked:
        order = np.argsort(hashes)
        ordered = hashes[order]
        first = np.ones(len(ordered), bool)
        first[1:] = ordered[1:] != ordered[:-1]
        single = first & np.append(first[1:], True) if len(ordered) else first
        mark = ordered[first & ~single]
        alone = np.empty(len(hashes), bool)
        alone[order] = single
        hashes, place = hashes[alone], place[alone]
    sent = np.bincount(place, minlength=len(sets))
    docs = np.vstack([docs, sent[docs[-1]]]).astype(np.int64).tobytes()
    # Few enough fragments for 16 bits are sorted by counting.
    fragment, mark_fragment = (np.minimum((x / span).astype(np.int64), fragments - 1) for x in (hashes, mark))
    turn = np.argsort(fragment.astype(np.uint16) if fragments <= 1 << 16 else fragment, kind="stable")
    fragment, hashes, place = fragment[turn], hashes[turn].astype(np.uint32), place[turn]
    new = np.ones(len(place), bool)
    new[1:] = (place[1:] != place[:-1]) | (fragment[1:] != fragment[:-1])
    starts = np.flatnonzero(new)
    here = place[starts]
    cells = {"place": here, "owner": owner[here], "sizes": np.diff(np.append(starts, len(place))).astype(np.int32), "hashes": hashes, "marks": mark.astype(np.uint32)}
    each = np.arange(fragments + 1)
    set_edges, edges, mark_edges = (np.searchsorted(f, each) for f in (fragment[starts], fragment, mark_fragment))
    used = (np.diff(edges) > 0) | (np.diff(mark_edges) > 0)
    home = batch % fragments
    used[home] = True
    rows = np.flatnonzero(used)
    columns = [pa.array(rows.astype(np.int32)), pa.array(np.full(len(rows), batch))]
    for name, values in cells.items():
        at = {"hashes": edges, "marks": mark_edges}.get(name, set_edges)
        columns.append(pa.array([values[a:b].tobytes() for a, b in zip(at[rows].tolist(), at[rows + 1].tolist(), strict=True)], pa.binary()))
    columns.append(pa.array([docs if f == home else None for f in rows.tolist()], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=_SPREAD_NAMES)


def _joined(table: pa.Table, column: str, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of a binary column in one array, and where each row begins and ends in it."""
    cells = table.column(column).to_pylist()
    lengths = np.fromiter(map(len, cells), np.int64, len(cells)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(cells), kind), np.concatenate([[0], np.cumsum(lengths)])


def _cells(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    return pa.array([values[a:b].tobytes() for a, b in zip(edges.tolist(), edges[1:].tolist(), strict=False)], pa.binary())


def _occurrences(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a fragment, for each shingle sent: how often it occurs, and whether another owner has it; then its set, and the sets' edges.

    The lower half of a hash tells shingles of a fragment apart; a chance collision only makes a
    shingle count as shared, which keeps a document in.
    """
    (owner, edges), (sizes, _), (hashes, _), (marks, _) = (_joined(table, c, _SPREAD_TYPES[c]) for c in ("owner", "sizes", "hashes", "marks"))
    entry = np.repeat(np.arange(len(owner)), sizes)
    n, values = len(hashes), np.concatenate([hashes, marks])
    order = np.argsort(values)
    ordered = values[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    group = np.cumsum(first) - 1
    count = np.bincount(group)
    owners = np.concatenate([owner[entry], np.zeros(len(marks), np.int64)])[order]
    several = np.zeros(len(count), bool)
    several[group[1:][~first[1:] & (owners[1:] != owners[:-1])]] = True
    several[group[order >= n]] = True
    often, shared = np.empty(len(values), np.int64), np.empty(len(values), bool)
    often[order], shared[order] = count[group], several[group]
    return often[:n], shared[:n], entry, edges


def _count(table: pa.Table) -> pa.Table:
    """Per batch and set of a fragment: the shingles another owner has, and how often its shingles occur beside once; without sets that have neither."""
    often, shared, entry, edges = _occurrences(table)
    place, _ = _joined(table, "place", np.int32)
    sums = [np.bincount(entry, weights=x, minlength=len(place)).astype(np.int64) for x in (shared, often - 1)]
    told = (sums[0] > 0) | (sums[1] > 0)
    edges = np.concatenate([[0], np.cumsum(told)])[edges]
    cells = [_cells(x[told], edges) for x in (place, *sums)]
    return pa.table([table.column("batch"), *cells, table.column("docs")], names=["batch", "place", "shared", "repeats", "docs"])


def _docs(table: pa.Table) -> np.ndarray:
    """hi, lo, key, n, digest, place and the shingles sent of every document of a batch."""
    return np.frombuffer(next(x for x in table.column("docs").to_pylist() if x is not None), np.int64).reshape(7, -1)


def _gather(table: pa.Table) -> pa.Table:
    """The sums over all fragments for every document of a batch."""
    hi, lo, key, n, digest, place, sent = _docs(table)
    at, _ = _joined(table, "place", np.int32)
    shared, repeats = (
        np.bincount(at, weights=_joined(table, c, np.int64)[0], minlength=int(place.max(initial=-1)) + 1)[place] for c in ("shared", "repeats")
    )
    values = [hi, lo, key, n, digest, sent - shared.astype(np.int64), (sent + repeats) / np.maximum(n, 1)]
    return pa.table([pa.array(v) for v in values], names=["hi", "lo", "key", "n", "digest", "unshared", "weight"])


def _counted(spread: DataFrame) -> DataFrame:
    counted = spread.groupBy("fragment").applyInArrow(_count, _COUNTED)
    return counted.groupBy("batch").applyInArrow(_gather, _CLASS)


def _fragments(shingles: float) -> int:
    return max(2, int(-(-shingles // FRAGMENT)))


def _documents(fragments: int, width: int, share: float):
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, part = WordHasher(150_000), TaskContext.get().partitionId()
        for at, batch in enumerate(slices(batches, "text", 4 << 20)):
            sets = shingle_sets(texts_of(batch.column("text")), hasher, width)
            signs = [_signature(s) for s in sets]
            seen: dict[tuple[int, int], int] = {}
            place = [seen.setdefault(s, len(seen)) for s in signs]
            distinct = [None] * len(seen)
            for p, s in zip(place, sets, strict=True):
                distinct[p] = s
            key = np.asarray(batch.column("key"))
            hi, lo = (np.fromiter((s[i] for s in signs), np.int64, len(signs)) for i in (0, 1))
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            docs = np.stack([hi, lo, key, sizes, np.asarray(batch.column("digest")), np.asarray(place, np.int64)])
            owner = np.fromiter((s[0] for s in seen), np.int64, len(seen))
            yield _spread(part << 32 | at, fragments, share, owner, distinct, docs, True)

    return spread


def _classes(fragments: int):
    """Rows (hi, n, label, tokens) spread by fragment; the owner of a shingle is the label."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for at, batch in enumerate(slices(batches, "tokens", 4 << 20)):
            sets = [np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist()]
            hi, n, label = (np.asarray(batch.column(c)) for c in ("hi", "n", "label"))
            docs = np.stack([hi, label, label, n, np.zeros(len(hi), np.int64), np.arange(len(hi))])
            # Shingles that two classes of one label share are not marks.
            yield _spread(part << 32 | at, fragments, 1.0, label, sets, docs, False)

    return spread


def _token_sets(width: int):
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(150_000)
        for batch in slices(batches, "text", 4 << 20):
            sets = shingle_sets(texts_of(batch.column("text")), hasher, width)
            signs = [_signature(s) for s in sets]
            wanted = zip(batch.column("hi").to_pylist(), batch.column("lo").to_pylist(), strict=True)
            keep = [i for i, w in enumerate(wanted) if signs[i] == w]
            hi, lo = (pa.array([signs[i][k] for i in keep], pa.int64()) for k in (0, 1))
            n = pa.array([len(sets[i]) for i in keep], pa.int64())
            tokens = pa.array([sets[i].tobytes() for i in keep], pa.binary())
            yield pa.RecordBatch.from_arrays([hi, lo, n, tokens], names=["hi", "lo", "n", "tokens"])

    return sets_of


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Min-hash buckets: (band, least, hi, weight)."""
    for batch in slices(batches, "tokens", 4 << 20):
        sets = [np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist()]
        hi, weight = np.asarray(batch.column("hi")), np.asarray(batch.column("weight"))
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        starts, tokens = np.cumsum(sizes) - sizes, np.concatenate(sets)
        for band in range(BANDS):
            least = np.minimum.reduceat(mix(tokens ^ np.uint64(band * 0x9E3779B1)), starts)
            values = [np.full(len(sets), band, np.int32), least.view(np.int64), hi, weight]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["band", "least", "hi", "weight"])


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("left").to_pylist(), batch.column("right").to_pylist(), strict=True)
        common = [len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True)) for x, y in pairs]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(common, pa.int64())], names=["a", "b", "na", "nb", "common"]
        )


_PAIRS = "a long, b long, na long, nb long, common long"


def _cut_sets(fragments: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.asarray([(1 << 64) * f // fragments for f in range(1, fragments)], np.uint64)
        for batch in slices(batches, "tokens", 4 << 20):
            parts = [np.split(t, np.searchsorted(t, bounds)) for t in (np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist())]
            others = [c for c in batch.schema.names if c != "tokens"]
            for f in range(fragments):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(batch.num_rows, f, np.int32)), *(batch.column(c) for c in others), pa.array([p[f].tobytes() for p in parts], pa.binary())],
                    names=["fragment", *others, "tokens"],
                )

    return cut


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of ``sets`` whose partial overlaps, by fragment, add up to ``percent``."""
    parts = sets.select("hi", "n", "tokens").mapInArrow(_cut_sets(2), "fragment int, hi long, n long, tokens binary")
    left = parts.select("fragment", F.col("hi").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("left"))
    right = parts.select("fragment", F.col("hi").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("right"))
    partial = pairs.join(left, "a").join(right, ["b", "fragment"]).select("a", "b", "na", "nb", "left", "right").mapInArrow(_overlap, _PAIRS)
    whole = partial.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("common").alias("common"))
    return whole.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _often(table: pa.Table) -> pa.Table:
    """Per batch of a fragment: its shingles with how often they occur, 0 for those of one label."""
    often, shared, entry, edges = _occurrences(table)
    place, hashes = (_joined(table, c, _SPREAD_TYPES[c])[0] for c in ("place", "hashes"))
    token = np.int64(table.column("fragment")[0].as_py()) << 32 | hashes.astype(np.int64)
    edges = np.searchsorted(entry, edges)
    cells = [_cells(x, edges) for x in (place[entry], token, np.where(shared, often, 0))]
    return pa.table([table.column("batch"), *cells, table.column("docs")], names=["batch", "place", "token", "often", "docs"])


def _early(percent: int):
    """For every class of a batch, its shared shingles that can be the rarest one in common with a linked class, and their places by rarity."""

    def early(table: pa.Table) -> pa.Table:
        hi, label, _, n, _, _, _ = _docs(table)
        (place, _), (token, _), (often, _) = (_joined(table, c, t) for c, t in (("place", np.int32), ("token", np.int64), ("often", np.int64)))
        order = np.lexsort((token, often, place))
        place, token, often = place[order], token[order], often[order]
        at = np.arange(len(place)) - np.searchsorted(place, place)
        # With a linked class at least as many percent of the set are in common, and none of them before the rarest.
        keep = (often > 0) & (100 * (n[place] - at) >= percent * n[place])
        place, token, at = place[keep], token[keep], at[keep]
        values = [(token >> 32).astype(np.int32), token, at, hi[place], n[place], label[place]]
        return pa.table([pa.array(v) for v in values], names=["fragment", "token", "at", "hi", "n", "label"])

    return early


def _listed(starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, starts[i] + k) for k below lengths[i], in pieces of about LISTED pairs."""
    ends = np.cumsum(lengths)
    a = 0
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + LISTED, side="right")))
        length = lengths[a:b]
        first = np.repeat(np.arange(a, b), length)
        yield first, starts[first] + np.arange(len(first)) - np.repeat(np.cumsum(length) - length, length)
        a = b


def _between_groups(percent: int):
    """Pairs of classes of different labels that may link by a shingle of the fragment.

    common / union >= p / 100 means (100 + p) * common >= p * (nx + ny), and what two sets have in
    common from their rarest common shingle on is at most what either has from there on.
    """

    def pairs(table: pa.Table) -> pa.Table:
        token, at, hi, n, label = (np.asarray(table.column(c)) for c in ("token", "at", "hi", "n", "label"))
        order = np.lexsort((hi, n, token))
        token, at, hi, n, label = token[order], at[order], hi[order], n[order], label[order]
        new = np.ones(len(token), bool)
        new[1:] = token[1:] != token[:-1]
        posting = np.cumsum(new) - 1
        # Within its posting, the smaller set x meets larger ones up to a size: those are neighbours.
        whole = 100 + percent
        most = np.minimum(100 * n // percent, whole * (n - at) // percent - n)
        scale = int(n.max(initial=0)) + 1
        rank = np.arange(len(token))
        end = np.searchsorted(posting * scale + n, posting * scale + np.clip(most, 0, scale - 1), side="right")
        # Pairs inside the label that a posting has most often are not listed: one of a pair is of the others.
        by_label = np.lexsort((label, posting))
        run = np.ones(len(token), bool)
        run[1:] = (posting[by_label][1:] != posting[by_label][:-1]) | (label[by_label][1:] != label[by_label][:-1])
        run_starts = np.flatnonzero(run)
        run_sizes = np.diff(np.append(run_starts, len(token)))
        of = by_label[run_starts]
        main = np.empty(int(posting[-1]) + 1 if len(posting) else 0, np.int64)
        by_size = np.argsort(run_sizes, kind="stable")
        main[posting[of][by_size]] = label[of][by_size]
        other = label != main[posting]
        found = [np.zeros((2, 0), np.int64)]
        for left, right in ((rank, rank[other]), (rank[other], rank[~other])):
            starts = np.searchsorted(right, left, side="right")
            lengths = np.maximum(np.searchsorted(right, end[left]) - starts, 0)
            for i, j in _listed(starts, lengths):
                x, y = left[i], right[j]
                keep = (label[x] != label[y]) & (whole * (n[y] - at[y]) >= percent * (n[x] + n[y]))
                x, y = hi[x[keep]], hi[y[keep]]
                found.append(np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1))
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table([pa.array(a), pa.array(b)], names=["a", "b"])

    return pairs


def _histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of each set in BINS ranges of the order, up to 255 each: what is cut off can only make sets differ less."""
    edges = np.asarray([(1 << 64) * k // BINS for k in range(1, BINS)], np.uint64)
    for batch in slices(batches, "tokens", 4 << 20):
        at = ([0, *np.searchsorted(t, edges), len(t)] for t in (np.frombuffer(x, np.uint64) for x in batch.column("tokens").to_pylist()))
        bins = pa.array([np.minimum(np.diff(x), 255).astype(np.uint8).tobytes() for x in at], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("hi"), batch.column("n"), bins], names=["hi", "n", "bins"])


def _allowed(percent: int):
    """The pairs that may link for all their histograms differ: (100 + p) * apart <= (100 - p) * (na + nb)."""

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16) for c in ("left", "right"))
            apart = np.abs(left - right).sum(1, dtype=np.int64)
            keep = pa.array((100 + percent) * apart <= (100 - percent) * (np.asarray(batch.column("na")) + np.asarray(batch.column("nb"))))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    return allowed


def signatures(rows: DataFrame, width: int = WIDTH) -> DataFrame:
    """The other columns of ``rows`` with hi, lo, the signature of the shingle set of ``text``."""
    names = [c for c in rows.columns if c != "text"]

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(150_000)
        for batch in slices(batches, "text", 4 << 20):
            signs = [_signature(s) for s in shingle_sets(texts_of(batch.column("text")), hasher, width)]
            hi, lo = (pa.array([s[i] for s in signs], pa.int64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), hi, lo], names=[*names, "hi", "lo"])

    types = dict(rows.dtypes)
    return rows.mapInArrow(signed, ", ".join([*(f"{c} {types[c]}" for c in names), "hi long", "lo long"]))


def linked_classes(documents: DataFrame, percent: int = 75, width: int = WIDTH) -> tuple[DataFrame, DataFrame]:
    """(hi, lo, key, n, ...) of every row, and (hi, label) of every class of equal sets that is linked to another."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # Half of the order is enough for the first pass while a quarter unshared rules a set out.
    share = min(1.0, 2 * (100 - percent) / 100)
    fragments = _fragments(size / 6 * share)
    docs = written(_counted(rows.mapInArrow(_documents(fragments, width, share), _SPREAD)), "shingle-sets")
    classes = docs.where("n > 0").groupBy("hi", "lo").agg(F.min(F.struct("key", "digest")).alias("first"), F.max("n").alias("n"), F.min("unshared").alias("unshared"))
    # A class is read from its first row, found by doc_id and text: rows without doc_id share one key.
    able = classes.where(100 * F.col("unshared") <= (100 - percent) * F.col("n")).select("first.key", "first.digest", "hi", "lo")
    sets = rows.join(able, ["key", "digest"]).mapInArrow(_token_sets(width), "hi long, lo long, n long, tokens binary")
    sets = written(sets.dropDuplicates(["hi", "lo"]), "class-sets")
    total = sets.agg(F.sum("n")).first()[0] or 0
    fragments = _fragments(total)

    def alive(labelled: DataFrame) -> DataFrame:
        """Classes that share enough shingles with other labels, with label, unshared count and weight."""
        counted = _counted(labelled.select("hi", "n", "label", "tokens").mapInArrow(_classes(fragments), _SPREAD))
        counted = counted.where(100 * F.col("unshared") <= (100 - percent) * F.col("n"))
        return counted.select("hi", F.col("lo").alias("label"), "unshared", "weight")

    single = sets.withColumn("label", F.col("hi"))
    first = written(alive(single), "alive")
    # Stars: each class against the most central class of its buckets, partial overlaps by fragment.
    buckets = written(sets.join(first, "hi").mapInArrow(_buckets, "band int, least long, hi long, weight double"), "buckets")
    centre = buckets.groupBy("band", "least").agg(F.max(F.struct("weight", "hi")).alias("top"), F.count("*").alias("members"))
    stars = buckets.join(centre.where("members > 1"), ["band", "least"]).select(F.col("hi").alias("a"), F.col("top.hi").alias("b"))
    stars = stars.where("a != b").distinct()
    links = written(_linked(stars, sets, percent), "star-links")
    labels = components(links)
    # What is left between groups.
    grouped = sets.join(labels, sets["hi"] == labels["node"], "left").select(sets["hi"], "n", "tokens", F.coalesce("label", "hi").alias("label"))
    grouped = written(grouped, "grouped")
    left_over = written(grouped.select("hi", "n", "tokens").join(alive(grouped), "hi"), "left-over")
    spread = left_over.select("hi", "n", "label", "tokens").mapInArrow(_classes(fragments), _SPREAD)
    early = spread.groupBy("fragment").applyInArrow(_often, _OFTEN).groupBy("batch").applyInArrow(_early(percent), _EARLY)
    between = early.groupBy("fragment").applyInArrow(_between_groups(percent), "a long, b long").distinct()
    bins = left_over.select("hi", "n", "tokens").mapInArrow(_histograms, "hi long, n long, bins binary")
    between = between.join(bins.toDF("a", "na", "left"), "a").join(bins.toDF("b", "nb", "right"), "b")
    between = written(between.mapInArrow(_allowed(percent), "a long, b long"), "between")
    links = written(links.union(_linked(between, left_over, percent)), "all-links")
    return docs, components(links).withColumnRenamed("node", "hi")


def jaccard_components(documents: DataFrame, percent: int = 75, width: int = WIDTH) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    Rows link when ``100 * common >= percent * union`` of their shingle sets, and equal sets always do.
    Null and empty texts have no set and are alone. Rows without doc_id take part as the greatest;
    alone they have a null component. Other columns are ignored; an empty table gives an empty result.
    """
    docs, groups = linked_classes(documents, percent, width)
    keyed = docs.where("n > 0").join(groups, "hi", "left")
    # Equal sets share hi and lo; linked classes share the label.
    least = keyed.where("label is not null").groupBy("label").agg(F.min("key").alias("linked"))
    linked = groups.join(least, "label").select("hi", "linked")
    same = docs.where("n > 0").groupBy("hi", "lo").agg(F.min("key").alias("equal"))
    out = docs.join(linked, "hi", "left").join(same, ["hi", "lo"], "left")
    found = F.when(F.col("n") == 0, F.col("key")).otherwise(F.coalesce("linked", "equal"))
    return out.select(
        F.nullif("key", F.lit(NO_ID)).alias("doc_id"), F.col("n").alias("n_shingles"), F.nullif(found, F.lit(NO_ID)).alias("component_id")
    )
