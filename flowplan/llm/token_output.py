"""Token ids of a corpus as wavelet-matrix shards, and reading them back.

Rows are range-partitioned and sorted by doc_id, so the shards of all partitions in order hold the
corpus in ascending doc_id order. A shard is one binary value of a written table: the table's
commit keeps shards whole when tasks are retried, on any store Spark can write to.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flowplan.llm import wavelet
from flowplan.llm.common import slices, worker_store, written

SHARD_TOKENS = 2_000_000
#: Distinct runs of letters a Python worker remembers; fewer take less memory and more time.
PIECES = 300_000
SHARDS = "part int, seq int, n_docs long, n_shard_tokens long, data binary"
_READ = "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


#: Letters, a mark, and perhaps a line end and the same again: a byte-level tokenizer cuts such a
#: piece into these groups, whatever they hold.
_LETTERS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
_SHAPE = rf"\A(?P<a> ?{_LETTERS})(?P<b>[.,!?;:]?)(?:(?P<c>\n)(?P<d>{_LETTERS})(?P<e>[.,!?;:]?))?\z"
#: A space before white space or the end: the tokenizer may join it with what stands before it.
_UNSURE = re.compile(r" (?=\s|\Z)")


def _byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


class CachedTokenizer:
    """Ids of whole texts from the tokenizers library.

    A byte-level tokenizer splits before a space that follows anything and precedes no white space,
    so such a text's ids are those of its space-led pieces in a row; each distinct piece of a batch is
    encoded once. Plain pieces are cut into runs of letters and marks, and the ids of runs are kept
    over batches, up to ``limit`` runs. A text with any other space is encoded whole.
    """

    def __init__(self, path: str, limit: int = PIECES):
        # Spark's tasks fill the cores; threads inside a worker would only take turns.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.model, self.symbols = self.tokenizer.model, _byte_symbols()
        self.runs = pa.array([], pa.large_string())
        self.ids, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64)

    def _run(self, run: str) -> list[int]:
        """Ids of a run of letters or a mark, which the tokenizer's model merges as one."""
        shown = run.replace(" ", self.symbols[32]).replace("\n", self.symbols[10]) if run.isascii() else run.encode().decode("latin-1").translate(self.symbols)
        return [t.id for t in self.model.tokenize(shown)]

    def _known(self, runs: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The index of each of the distinct ``runs`` in two arrays, all ids in a row and the sizes; what has room is kept."""
        found = pa.compute.index_in(runs, value_set=self.runs)
        unseen = np.asarray(found.is_null())
        new = runs.filter(pa.array(unseen))
        made = list(map(self._run, new.to_pylist()))
        sizes = np.concatenate([self.sizes, np.fromiter(map(len, made), np.int64, len(made))])
        ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(made), np.int32, int(sizes[len(self.sizes) :].sum()))])
        index = np.asarray(found.fill_null(0)).astype(np.int64)
        index[unseen] = len(self.runs) + np.arange(len(new))
        room = self.limit - len(self.runs)
        if room > 0 and len(new):
            self.runs = pa.concat_arrays([self.runs, new[:room]])
            self.sizes = sizes[: len(self.runs)].copy()
            self.ids = ids[: int(self.sizes.sum())].copy()
        return index, ids, sizes

    def _encode(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``pieces`` in a row, and how many each has."""
        shapes = pa.compute.extract_regex(pieces, _SHAPE)
        other = np.flatnonzero(np.asarray(shapes.is_null()))
        parts = [shapes.field(k).dictionary_encode() for k in range(shapes.type.num_fields)]
        table = pa.chunked_array([pa.array([""], pa.large_string()), *(p.dictionary for p in parts)]).combine_chunks().dictionary_encode()
        index, ids, sizes = self._known(table.dictionary)
        index, at = index[np.asarray(table.indices)], 1
        grid = np.zeros((len(pieces), len(parts)), np.int64)
        for k, p in enumerate(parts):
            grid[:, k] = index[np.asarray(pa.compute.add(p.indices, at).fill_null(0))]  # place 0 is the empty run
            at += len(p.dictionary)
        grid_sizes = sizes[grid]
        grid_sizes[other] = 0
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        whole = [e.ids for e in encode(pieces.take(pa.array(other)).to_pylist(), add_special_tokens=False)]
        # What was encoded whole follows the runs' ids and stands in a row's first place.
        starts = (np.cumsum(sizes) - sizes)[grid]
        whole_sizes = np.fromiter(map(len, whole), np.int64, len(whole))
        starts[other, 0] = len(ids) + np.cumsum(whole_sizes) - whole_sizes
        grid_sizes[other, 0] = whole_sizes
        ids = np.concatenate([ids, np.fromiter(chain.from_iterable(whole), np.int32, int(whole_sizes.sum()))])
        return _gathered(ids, starts.ravel(), grid_sizes.ravel()), grid_sizes.sum(1)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        whole = [bool(_UNSURE.search(t)) for t in texts]
        lists = pa.compute.split_pattern(pa.array(["" if w else t for t, w in zip(texts, whole, strict=True)], pa.large_string()), " ")
        heads = np.asarray(lists.offsets)[:-1].astype(np.int64)
        coded = lists.values.dictionary_encode()
        words, code = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
        # A piece is a word with the space before it; what no space leads is a piece of its own.
        first = [t if w else t[: k if (k := t.find(" ")) >= 0 else None] for t, w in zip(texts, whole, strict=True)]
        led = pa.compute.binary_join_element_wise(pa.scalar(" ", pa.large_string()), words, pa.scalar("", pa.large_string()))
        pieces = pa.chunked_array([led, pa.array(first, pa.large_string())]).combine_chunks()
        ids, piece_sizes = self._encode(pieces)
        code[heads] = len(words) + np.arange(len(texts))
        sizes = piece_sizes[code]
        found = _gathered(ids, (np.cumsum(piece_sizes) - piece_sizes)[code], sizes)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return found, np.diff(ends[np.append(heads, len(code))])


def _gathered(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``ids`` at ``starts`` in a row."""
    place = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    place += np.arange(len(place))
    return ids[place]


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    """``ids`` with ``end_id`` after each text."""
    out = np.full(len(ids) + len(sizes), end_id, np.int32)
    keep = np.ones(len(out), bool)
    keep[np.cumsum(sizes + 1) - 1] = False
    out[keep] = ids
    return out


def write_shards(documents: DataFrame, tokenizer_path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS, pieces: int = PIECES) -> DataFrame:
    """Encode every text and return the written table of shards (part, seq, n_docs, n_shard_tokens, data).

    Null texts count as empty and hold the end id alone; rows without doc_id come last, rows with
    the same doc_id stand in the order of their texts.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = worker_store("tokenizer")
        if (tokenizer_path, pieces) not in store:
            store[tokenizer_path, pieces] = CachedTokenizer(tokenizer_path, pieces)
        encoder, part, seq, held, count = store[tokenizer_path, pieces], TaskContext.get().partitionId(), 0, [], 0

        def shard():
            ids, sizes, docs = (np.concatenate([h[k] for h in held]) for k in range(3))
            known = np.concatenate([h[3] for h in held])
            data = wavelet.dump(wavelet.WaveletMatrix.of(ids), docs, known, sizes)
            values = [[part], [seq], [len(docs)], [len(ids)], [data]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, types, strict=True)],
                names=["part", "seq", "n_docs", "n_shard_tokens", "data"],
            )

        for batch in slices(batches, "text", keep="tokenizer"):
            ids, sizes = encoder([t or "" for t in batch.column("text").to_pylist()])
            doc_ids = batch.column("doc_id")
            held.append(
                (with_end(ids, sizes, end_id), sizes + 1, np.asarray(doc_ids.fill_null(0)), np.asarray(doc_ids.is_valid()))
            )
            count += len(held[-1][0])
            if count >= shard_tokens:
                yield shard()
                seq, held, count = seq + 1, [], 0
        if held:
            yield shard()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = [F.asc_nulls_last("doc_id")]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    return written(placed.mapInArrow(encode, SHARDS), "token-shards")


def shard_bases(shards: DataFrame) -> DataFrame:
    """part, seq and base, the tokens before each shard: one row per file, summed in order."""
    before = W.orderBy("part", "seq").rowsBetween(W.unboundedPreceding, -1)
    return shards.select("part", "seq", F.coalesce(F.sum("n_shard_tokens").over(before), F.lit(0)).alias("base"))


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """Every position of ``token`` in the corpus, counted from zero over all shards in order.

    A shard is asked by rank and select and unpacks only the blocks on the way. A token that does
    not occur, and an empty table, give no rows.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                matrix = wavelet.load(data)[0]
                found = [matrix.select(token, k) for k in range(matrix.rank(token, matrix.size))]
                n = len(found)
                columns = [pa.array([part] * n, pa.int32()), pa.array([seq] * n, pa.int32()), pa.array(found, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "seq", "place"])

    places = shards.select("part", "seq", "data").mapInArrow(find, "part int, seq int, place long")
    return places.join(shard_bases(shards), ["part", "seq"]).select((F.col("base") + F.col("place")).alias("position"))


def tokens_at(shards: DataFrame, positions: DataFrame) -> DataFrame:
    """position and token for each row of ``positions`` (position long); null where the corpus has none.

    Positions meet their shard by its range of tokens, cut into steps of ``SHARD_TOKENS``, and are read by
    access. Null and repeated positions keep their rows; other columns are ignored.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, out = batch.column("places").to_pylist(), []
            for data, asked in zip(batch.column("data").to_pylist(), places, strict=True):
                matrix = wavelet.load(data)[0]
                out.append([matrix.access(i) for i in asked])
            columns = [batch.column("base"), batch.column("places"), pa.array(out, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["base", "places", "tokens"])

    asked = positions.select(F.col("position").cast("long").alias("position"))
    step = F.lit(SHARD_TOKENS)
    files = shards.select("part", "seq", "n_shard_tokens").join(shard_bases(shards), ["part", "seq"]).where("n_shard_tokens > 0")
    last = F.col("base") + F.col("n_shard_tokens") - 1
    ranges = files.select("part", "seq", "base", last.alias("last"), F.explode(F.sequence(F.floor(F.col("base") / step), F.floor(last / step))).alias("step"))
    wanted = asked.where("position >= 0").distinct().withColumn("step", F.floor(F.col("position") / step))
    met = wanted.join(ranges, "step").where(F.col("position").between(F.col("base"), F.col("last")))
    # A shard has a bounded number of tokens, and so of distinct positions.
    per_file = met.groupBy("part", "seq", "base").agg(F.collect_list(F.col("position") - F.col("base")).alias("places"))
    read_rows = per_file.join(shards.select("part", "seq", "data"), ["part", "seq"]).select("base", "places", "data").mapInArrow(read, "base long, places array<long>, tokens array<long>")
    pair = read_rows.select("base", F.explode(F.arrays_zip("places", "tokens")).alias("p"))
    found = pair.select((F.col("base") + F.col("p.places")).alias("position"), F.col("p.tokens").alias("token"))
    return asked.join(found, "position", "left")


def read_shards(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the shard files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, seq = batch.column("part")[i].as_py(), batch.column("seq")[i].as_py()
                matrix, doc_ids, known, sizes = wavelet.load(batch.column("data")[i].as_py())
                ids = matrix.tokens().astype("<u4", copy=False)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, part, np.int32)),
                        pa.array(np.full(n, seq, np.int32)),
                        pa.array(doc_ids, mask=~known),
                        pa.array(starts),
                        pa.array(sizes),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "seq", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )

    docs = shards.select("part", "seq", "data").mapInArrow(decode, _READ)
    return docs.join(shard_bases(shards), ["part", "seq"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_output(spark: SparkSession, documents: DataFrame, tokenizer_path: str | None = None, end_id: int = 2, pieces: int = PIECES) -> DataFrame:
    """Write the shards of ``documents`` and read them back."""
    return read_shards(write_shards(documents, tokenizer_path or tokenizer_file(), end_id, pieces=pieces))
