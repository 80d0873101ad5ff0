"""Code lengths of documents by prediction by partial matching over bytes.

The longest context is the bytes of the three tokens before: what followed them in other places of
the training rows predicts a token as a whole. After an escape a token's bytes and its closing space
are predicted in turn. The contexts of a byte are the whole token so far, a path in a trie of all
training tokens, then the last two bytes, the last one, none, and at last a uniform guess; a token
that ends a document is coded as a line end. From each context
the coder escapes to the next with a chance estimated from how many symbols the context has shown
(half a count of each symbol goes to the escape), and symbols of a context that was left are excluded
below it. In the longest context the escape is estimated from the followers seen once, and a training
row's own occurrence does not count for itself. The shorter contexts count each edge of the trie once, as an update-excluding coder would.

The corpus is gathered by Spark: batches of documents keep their words as places in a dictionary of
the batch, which is made again for the places and for the contexts; the words and counts of the dictionaries are stored
once and dealt by the first three bytes of a word, so that deeper trie nodes are whole in one shard, and counts and code lengths come back to the batches. Only counts of contexts
of two bytes and of first three bytes are brought together; there are at most 2**24 of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xxhash import xxh3_64_intdigest, xxh32_intdigest

from flowplan.llm.common import mix, slices, written

END = b"\n"
SPACE = 32
SHARD_BYTES = 8 << 20
_WORDS_OF = "batch long, shard int, words binary, train binary"
_MAIN = "batch long, docs binary"
_WORDS = "shard int, words binary, counts binary, total long, distinct long"
_DEALT = "batch long, shard int, key binary, train binary"
_BACK = "batch long, kind int, shard int, counts binary, logs binary"
#: Tokens before a token that make its longest context.
REACH = 3
#: Escape from the longest context: the share of followers seen once, and at least so much by count.
ONCE, LEAST, MOST = 0.7, 0.15, 0.95
_LOW28 = np.uint64((1 << 28) - 1)
_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def tokens(array: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts in a row, each text closed by END; and how many tokens each text has."""
    # A copy without offset: kernels that join and split strings go wrong on slices.
    texts = pa.compute.fill_null(array.take(pa.array(np.arange(len(array)))).cast(pa.large_string()), "")
    texts = pa.compute.binary_join_element_wise(pa.compute.ascii_lower(texts), pa.scalar("\n\x00E\n", pa.large_string()), pa.scalar("", pa.large_string()))
    lists = pa.compute.ascii_split_whitespace(texts)
    flat = lists.flatten()
    filled = np.asarray(pa.compute.binary_length(flat)) > 0
    sums = np.concatenate([[0], np.cumsum(filled)])
    ends = sums[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
    words = flat.filter(pa.array(filled)).cast(pa.large_binary())
    # The close of a text is its last token, whatever its words look like.
    last = np.zeros(len(words), bool)
    last[ends[1:] - 1] = True
    words = pa.compute.if_else(pa.array(last), pa.scalar(END, pa.large_binary()), words)
    return words, np.diff(ends)


def _shard_of(words: list[bytes], shards: int) -> np.ndarray:
    first = np.fromiter((int.from_bytes(w[:3].ljust(3, b" "), "big") for w in words), np.uint64, len(words))
    return ((first * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


@dataclass
class Batch:
    """Documents of a batch with their tokens as places in its dictionary, ordered by shard and word."""

    number: int
    docs: np.ndarray
    names: pa.Array
    shard: np.ndarray
    index: np.ndarray

    def hashes(self) -> np.ndarray:
        return np.fromiter(map(xxh32_intdigest, self.names.to_pylist()), np.uint32, len(self.names)).astype(np.uint64)


def _coded(rows: Iterator[pa.RecordBatch], shards: int) -> Iterator[Batch]:
    """The same batches whenever the same rows come in the same partition.

    A batch's number is a digest of its place (partition and turn) and of what it holds, so equal
    batches are told apart and a reading that gave other rows is noticed.
    """
    for turn, batch in enumerate(slices(rows, "text")):
        words, counts = tokens(batch.column("text"))
        coded = words.dictionary_encode()
        shard = _shard_of(coded.dictionary.to_pylist(), shards)
        order = pa.compute.sort_indices(pa.table([pa.array(shard), coded.dictionary], names=["s", "w"]), [("s", "ascending"), ("w", "ascending")])
        order = np.asarray(order).astype(np.int64)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        held, ids = np.asarray(batch.column("held_out")), batch.column("doc_id")
        docs = np.stack([np.asarray(ids.fill_null(0)), np.asarray(ids.is_valid()), held, counts]).astype(np.int64)
        index, names = rank[np.asarray(coded.indices)], coded.dictionary.take(pa.array(order))
        number = xxh3_64_intdigest(docs.tobytes() + index.tobytes(), seed=TaskContext.get().partitionId() << 32 | turn) >> 1
        yield Batch(number, docs, names, shard[order], index)


def _parts(shard: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(shard, first, end) of every run in sorted ``shard``."""
    cuts = [0, *(np.flatnonzero(np.diff(shard)) + 1).tolist(), len(shard)] if len(shard) else []
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield int(shard[a]), a, b


def _rows(columns: list[list], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[t]) for v, t in zip(columns, types, strict=True)], names=list(names))


def _dictionaries(shards: int):
    """The words of every batch and shard, with their training counts."""

    def dictionaries(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for x in _coded(rows, shards):
            train = np.bincount(x.index[np.repeat(x.docs[2] == 0, x.docs[3])], minlength=len(x.names))
            names, out = x.names.to_pylist(), [[], [], [], []]
            for shard, a, b in _parts(x.shard):
                row = (x.number, shard, press(b" ".join(names[a:b])), press(train[a:b].astype(np.int64).tobytes()))
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield _rows(out, _WORDS_OF)

    return dictionaries


def _planes(values: np.ndarray) -> bytes:
    """Bytes of equal weight side by side, which packs better."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def _from_planes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _main(shards: int):
    """The documents, places of tokens and context shards of every batch."""

    def main(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for x in _coded(rows, shards):
            parts = (x.docs.tobytes(), press(x.shard.astype(np.int32).tobytes()), x.hashes().astype(np.uint32).tobytes(), press(_planes(x.index)))
            yield _rows([[x.number], [b"".join(len(p).to_bytes(8, "little") + p for p in parts)]], _MAIN)

    return main


def _unpack(data: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _split(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b" ")


def _sum_words(table: pa.Table) -> pa.Table:
    """The distinct words of a shard in order, with their training counts."""
    words = pa.concat_arrays([pa.array(_split(x), pa.large_binary()) for x in table.column("words").to_pylist()])
    train = np.concatenate([_unpack(x) for x in table.column("train").to_pylist()])
    coded = words.dictionary_encode()
    counts = np.bincount(np.asarray(coded.indices), weights=train, minlength=len(coded.dictionary)).astype(np.int64)
    names = coded.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    press = zstandard.ZstdCompressor(level=1).compress
    values = [
        [table.column("shard")[0].as_py()], [press(b" ".join([names[i] for i in order]))], [press(counts[order].tobytes())],
        [int(counts.sum())], [int((counts > 0).sum())],
    ]
    types = [pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    return pa.table([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=["shard", "words", "counts", "total", "distinct"])


class Trie:
    """Sorted words as a trie: the bytes of each with its closing space, and prefixes shared with the word before."""

    def __init__(self, words: list[bytes], counts: np.ndarray):
        self.counts = counts
        self.size = np.fromiter(map(len, words), np.int64, len(words)) + 1
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b" ".join(words) + b" ", np.uint8)
        self.common = self._common()

    def _common(self) -> np.ndarray:
        common = np.zeros(len(self.size), np.int64)
        live, k = np.arange(1, len(self.size)), 0
        while len(live):
            live = live[(self.size[live] > k) & (self.size[live - 1] > k)]
            live = live[self.data[self.start[live] + k] == self.data[self.start[live - 1] + k]]
            common[live] += 1
            k += 1
        return common

    def key(self, at: np.ndarray) -> np.ndarray:
        """The two bytes before each place and the byte there."""
        a, b, c = (self.data[at - k].astype(np.int64) for k in (2, 1, 0))
        return a << 16 | b << 8 | c

    def levels(self, first: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(depth, words that go on there, their nodes, their edges), numbered from zero, in order."""
        live = np.flatnonzero(self.size > first)
        depth = first
        while len(live):
            apart = np.ones(len(live), bool)
            apart[1:] = live[1:] != live[:-1] + 1
            node = np.cumsum(apart | (self.common[live] < depth)) - 1
            edge = np.cumsum(apart | (self.common[live] < depth + 1)) - 1
            yield depth, live, node, edge
            depth += 1
            live = live[self.size[live] > depth]


def _contexts(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First three bytes with training counts, and (two bytes, next byte) with the number of trie edges."""
    words, counts = _split(table.column("words")[0].as_py()), _unpack(table.column("counts")[0].as_py())
    first = np.fromiter((int.from_bytes((w + b" ")[:3].ljust(3, b" "), "big") for w in words), np.int64, len(words))
    keys, inverse = np.unique(first, return_inverse=True)
    starts = np.bincount(inverse, weights=counts).astype(np.int64)
    trie, found = Trie([w for w, c in zip(words, counts.tolist(), strict=True) if c], counts[counts > 0]), []
    for depth, live, _, edge in trie.levels(3):
        head = live[np.flatnonzero(np.diff(edge, prepend=-1))]
        at = trie.start[head] + depth
        found.append(trie.key(at))
    edges, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.int64), return_counts=True)
    return keys, starts, edges, n


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            keys, starts, edges, n = _contexts(batch.slice(i, 1))
            kind = np.concatenate([np.zeros(len(keys), np.int32), np.ones(len(edges), np.int32)])
            values = [kind, np.concatenate([keys, edges]), np.concatenate([starts, n])]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=["kind", "key", "n"])


@dataclass
class Lookup:
    """Sums by sorted key."""

    keys: np.ndarray
    values: np.ndarray

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], 0)

    @classmethod
    def of(cls, keys: np.ndarray, values: np.ndarray) -> Lookup:
        found, inverse = np.unique(keys, return_inverse=True)
        return cls(found, np.bincount(inverse, weights=values, minlength=len(found)).astype(np.int64))


class Model:
    """Contexts of at most two bytes with exclusion, and the log10 probabilities of first three bytes."""

    def __init__(self, starts: tuple[np.ndarray, np.ndarray], edges: tuple[np.ndarray, np.ndarray]):
        keys, counts = starts
        order = np.argsort(keys)
        keys, counts = keys[order].astype(np.int64), counts[order].astype(np.int64)
        # Edges of the first three levels come from the first bytes; history before a word is a zero and a space.
        a, b, c = keys >> 16, keys >> 8 & 255, keys & 255
        seen = counts > 0
        levels = [
            (np.unique(a[seen]), lambda k: SPACE << 8 | k),
            (np.unique(keys[seen & (a != SPACE)] >> 8), lambda k: SPACE << 16 | k),
            (np.unique(keys[seen & (a != SPACE) & (b != SPACE)]), lambda k: k),
        ]
        short = [to(k) for k, to in levels]
        two = np.concatenate([edges[0].astype(np.int64), *short])
        n = np.concatenate([edges[1].astype(np.int64), *[np.ones(len(k), np.int64) for k in short]])
        self.n2 = Lookup.of(two, n)
        key, value = self.n2.keys, self.n2.values
        self.n1 = Lookup.of(key & 0xFFFF, value)
        self.n0 = Lookup.of(key & 0xFF, value)
        self.sum2, self.sym2 = Lookup.of(key >> 8, value), Lookup.of(key >> 8, np.ones(len(key)))
        self.sum1, self.sym1 = Lookup.of(self.n1.keys >> 8, self.n1.values), Lookup.of(self.n1.keys >> 8, np.ones(len(self.n1.keys)))
        self.sum0, self.sym0 = int(self.n0.values.sum()), len(self.n0.keys)
        # What the symbols of a context weigh in the next shorter one.
        self.out1 = Lookup.of(key >> 8, self.n1(key & 0xFFFF))
        self.out0 = Lookup.of(self.n1.keys >> 8, self.n0(self.n1.keys & 0xFF))
        self.starts = Lookup(keys, np.arange(len(keys)))
        self.start_logs = self._start_logs(keys, counts)

    def _start_logs(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        logs = np.zeros(len(keys))
        for level in range(3):
            node, edge = keys >> (24 - 8 * level), keys >> (16 - 8 * level)
            on = np.ones(len(keys), bool) if level == 0 else (edge >> 8 & 255) != SPACE
            if level == 2:
                on &= (keys >> 16) != SPACE
            index = np.flatnonzero(on)
            if not len(index):
                continue
            _, nodes = np.unique(node[index], return_inverse=True)
            first, heads, edges = np.unique(edge[index], return_index=True, return_inverse=True)
            history = (first | SPACE << 8) if level == 0 else (first | SPACE << 16) if level == 1 else first
            per_edge = np.bincount(edges, weights=counts[index]).astype(np.int64)
            logs[index] += self.predict(nodes[heads], per_edge, history)[edges]
        return logs

    def predict(self, node: np.ndarray, counts: np.ndarray, key: np.ndarray) -> np.ndarray:
        """log10 probability of each edge; ``node`` numbers the edges' nodes from zero, ``key`` has two bytes and the symbol."""
        seen = counts > 0
        total = np.bincount(node, weights=counts)
        symbols = np.bincount(node, weights=seen)
        known = total[node] > 0
        logs = np.zeros(len(node))
        hit = seen
        logs[hit] = np.log10((2 * counts[hit] - 1) / (2 * total[node[hit]]))
        miss = np.flatnonzero(~seen)
        if not len(miss):
            return logs
        weigh = np.where(seen, self.n2(key), 0)
        out2 = np.bincount(node, weights=weigh, minlength=len(total)).astype(np.int64)
        n, k = node[miss], key[miss]
        escaped = known[miss]
        logs[miss[escaped]] += np.log10(symbols[n[escaped]] / (2 * total[n[escaped]]))
        gone, used = out2[n], symbols[n].astype(np.int64)
        steps = (
            (self.n2(k), self.sum2(k >> 8), self.sym2(k >> 8), self.out1(k >> 8)),
            (self.n1(k & 0xFFFF), self.sum1(k >> 8 & 0xFF), self.sym1(k >> 8 & 0xFF), self.out0(k >> 8 & 0xFF)),
            (self.n0(k & 0xFF), np.full(len(k), self.sum0), np.full(len(k), self.sym0), np.zeros(len(k), np.int64)),
        )
        open_ = np.ones(len(miss), bool)
        for here, weight, kinds, below in steps:
            left, fresh = weight - gone, kinds - used
            here = np.where(open_, here, 0)
            good = here > 0
            logs[miss[good]] += np.log10((2 * here[good] - 1) / (2 * left[good]))
            open_ &= ~good
            leave = open_ & (left > 0)
            logs[miss[leave]] += np.log10(fresh[leave] / (2 * left[leave]))
            # A context that was never seen excludes nothing below.
            gone, used = np.where(weight > 0, below, 0), np.where(weight > 0, kinds, 0)
        logs[miss[open_]] -= np.log10(np.maximum(256 - self.sym0, 1))
        return logs

    def words(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """log10 probability of every word of a whole shard, in sorted order."""
        first = np.fromiter((int.from_bytes((w + b" ")[:3].ljust(3, b" "), "big") for w in words), np.int64, len(words))
        logs = self.start_logs[self.starts(first)]
        trie = Trie(words, counts)
        for depth, live, node, edge in trie.levels(3):
            head = np.flatnonzero(np.diff(edge, prepend=-1))
            at = trie.start[live[head]] + depth
            key = trie.key(at)
            per_edge = np.bincount(edge, weights=counts[live]).astype(np.int64)
            logs[live] += self.predict(node[head], per_edge, key)[edge]
        return logs


def _back(model: Model):
    def back(left: pa.Table, right: pa.Table) -> pa.Table:
        """Counts and code lengths of a shard's words, for each batch in the batch's own order."""
        words, counts = _split(right.column("words")[0].as_py()), _unpack(right.column("counts")[0].as_py())
        logs, names, press = model.words(words, counts), pa.array(words, pa.large_binary()), zstandard.ZstdCompressor(level=3).compress
        out = [[], [], [], [], []]
        for batch, shard, mine in zip(*(left.column(c).to_pylist() for c in ("batch", "shard", "words")), strict=True):
            at = np.asarray(pa.compute.index_in(pa.array(_split(mine), pa.large_binary()), value_set=names))
            row = (batch, 0, shard, press(_planes(counts[at])), press(_planes(logs[at].astype(np.float32))))
            for column, value in zip(out, row, strict=True):
                column.append(value)
        return pa.Table.from_batches([_rows(out, _BACK)])

    return back


def _open(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The documents of a batch (ids, which are known, held out, tokens), word shards and hashes, token places."""
    parts, at = [], 0
    for _ in range(4):
        size = int.from_bytes(packed[at : at + 8], "little")
        parts.append(packed[at + 8 : at + 8 + size])
        at += 8 + size
    index = _from_planes(zstandard.ZstdDecompressor().decompress(parts[3]), np.int32)
    return np.frombuffer(parts[0], np.int64).reshape(4, -1), _unpack(parts[1], np.int32), np.frombuffer(parts[2], np.uint32).astype(np.uint64), index


def _contexts_of(n: np.ndarray, word: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens with REACH tokens before them in order of shard, their shards and the hashes of those before."""
    offset = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    at = np.flatnonzero(offset >= REACH)
    context = np.zeros(len(at), np.uint64)
    for k in range(REACH, 0, -1):
        context = mix(context * np.uint64(0x9E3779B97F4A7C15) + word[at - k] + np.uint64(1))
    shard = ((context >> np.uint64(32)) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return at[order], shard[order], context[order]


def _deal(shards: int):
    """Every token that has REACH tokens before it, to the shard of their hash: 28 bits of each in seven bytes."""

    def deal(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _coded(rows, shards):
            word = x.hashes()[x.index]
            at, shard, context = _contexts_of(x.docs[3], word, shards)
            key = (context & _LOW28) << np.uint64(28) | word[at] & _LOW28
            train, out = np.repeat(x.docs[2] == 0, x.docs[3])[at], [[], [], [], []]
            body = key.view(np.uint8).reshape(-1, 8)[:, :7]
            for s, a, b in _parts(shard):
                for column, value in zip(out, (x.number, s, body[a:b].tobytes(), np.packbits(train[a:b]).tobytes()), strict=True):
                    column.append(value)
            yield _rows(out, _DEALT)

    return deal


def _keys(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.view(np.uint64).ravel()


def _follow(table: pa.Table) -> pa.Table:
    """Per token of a shard: below zero its log10 probability after its context, above zero the cost of the escape, or zero."""
    keys = [_keys(x) for x in table.column("key").to_pylist()]
    train = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(k)) for x, k in zip(table.column("train").to_pylist(), keys, strict=True)])
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    pair = np.cumsum(new) - 1
    context_of = ranked[new] >> np.uint64(28)
    context_new = np.ones(len(context_of), bool)
    context_new[1:] = context_of[1:] != context_of[:-1]
    context = np.cumsum(context_new) - 1
    mine = train[order].astype(np.int64)
    n = np.bincount(pair, weights=mine).astype(np.int64)
    total = np.bincount(context, weights=n).astype(np.int64)
    once = np.bincount(context, weights=n == 1).astype(np.int64)
    place = context[pair]
    n_here = n[pair]
    others, total_here = n_here - mine, total[place] - mine
    once_here = once[place] - mine * (n_here == 1) + mine * (n_here == 2)
    value = np.zeros(len(key))
    seen = total_here > 0
    escape = np.zeros(len(key))
    escape[seen] = np.minimum(MOST, np.maximum(LEAST, ONCE * once_here[seen]) / total_here[seen])
    hit = seen & (others > 0)
    value[hit] = np.log10((1 - escape[hit]) * others[hit] / total_here[hit])
    miss = seen & (others == 0)
    value[miss] = -np.log10(escape[miss])
    back = np.empty(len(key))
    back[order] = value
    press, out = zstandard.ZstdCompressor(level=3).compress, [[], [], [], [], []]
    values = np.split(back.astype(np.float32), np.cumsum([len(k) for k in keys])[:-1])
    for batch, shard, mine in zip(table.column("batch").to_pylist(), table.column("shard").to_pylist(), values, strict=True):
        some = mine != 0
        row = (batch, 1, shard, press(np.packbits(some).tobytes()), press(_planes(mine[some])))
        for column, value in zip(out, row, strict=True):
            column.append(value)
    return pa.Table.from_batches([_rows(out, _BACK)])


def _sum_documents(total: int, distinct: int, shards: int):
    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows != 1:
            raise ValueError("the input gave other batches when it was read again; write it as a table first")
        unpress = zstandard.ZstdDecompressor().decompress
        (doc_ids, known, held, n), word_shard, hashes, index = _open(left.column("docs")[0].as_py())
        at, shard, _ = _contexts_of(n, hashes[index], shards)
        counts, logs, after = np.full(len(hashes), -1), np.zeros(len(hashes)), np.zeros(len(index))
        words_at, contexts_at = ({s: (a, b) for s, a, b in _parts(x)} for x in (word_shard, shard))
        for kind, s, c, x in zip(*(right.column(k).to_pylist() for k in ("kind", "shard", "counts", "logs")), strict=True):
            if kind == 0:
                a, b = words_at[s]
                counts[a:b], logs[a:b] = _from_planes(unpress(c), np.int64), _from_planes(unpress(x), np.float32)
            else:
                a, b = contexts_at[s]
                some = np.unpackbits(np.frombuffer(unpress(c), np.uint8), count=b - a).view(bool)
                after[at[a:b][some]] = _from_planes(unpress(x), np.float32)
        if (counts < 0).any():
            raise ValueError("the input gave other batches when it was read again; write it as a table first")
        base = np.log10((counts + 0.5) / (total + 0.5 * (distinct + 1)))[index]
        score = np.where(after < 0, after, logs[index] - after)
        starts = np.cumsum(n) - n
        per_doc = [np.add.reduceat(x, starts) if len(n) else x[:0] for x in ((counts > 0).astype(np.int64)[index], base, score)]
        values = [pa.array(doc_ids, mask=known == 0), pa.array(held == 1), pa.array(n), *[pa.array(x) for x in per_doc]]
        return pa.table(values, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return sums


def score_documents(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learned from rows whose crc32 of doc_id is not 1 modulo 5. Null texts are empty and hold the end
    token alone; rows without doc_id are learned from. Without training rows every token is guessed
    from the uniform. Other columns are ignored; an empty table gives an empty result.
    """
    text, doc_id = F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")
    held = F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False)).alias("held_out")
    rows = documents.select(doc_id, held, text)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    # Read twice below; packed it is a fifth of the text, and to make it again is a whole pass over the texts.
    dealt = written(rows.mapInArrow(_dictionaries(shards), _WORDS_OF), "dealt")
    words = written(dealt.groupBy("shard").applyInArrow(_sum_words, _WORDS), "words")
    total, distinct = words.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    contexts = words.mapInArrow(_context_rows, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    found = contexts.toPandas()  # two kinds of three bytes: at most 2 * 2**24 rows
    tables = [found[found.kind == k] for k in (0, 1)]
    model = Model(*[(t.key.to_numpy(np.int64), t.n.to_numpy(np.int64)) for t in tables])
    back = dealt.groupBy("shard").cogroup(words.groupBy("shard")).applyInArrow(_back(model), _BACK)
    after = rows.mapInArrow(_deal(shards), _DEALT).groupBy("shard").applyInArrow(_follow, _BACK)
    main = rows.mapInArrow(_main(shards), _MAIN)
    scores = main.groupBy("batch").cogroup(back.unionByName(after).groupBy("batch")).applyInArrow(_sum_documents(total, distinct, shards), _SCORES)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
