import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from flowplan.llm import token_output as T
from flowplan.llm import wavelet
from flowplan.llm.queries import QUERIES, table

from llm_tables import docs  # noqa: F401

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size,top", [(0, 1), (1, 1), (700, 1), (5000, 3), (20000, 50257)])
def test_wavelet_round_trip_rank_select(size, top):
    rng = np.random.default_rng(size)
    ids = rng.integers(0, top, size).astype(np.int32)
    lengths = np.asarray([size], np.int64)
    data = wavelet.dump(wavelet.WaveletMatrix.of(ids), np.asarray([7]), np.asarray([True]), lengths)
    matrix, docs, known, back = wavelet.load(data)
    assert matrix.tokens().tolist() == ids.tolist() and docs.tolist() == [7] and back.tolist() == [size]
    for i in rng.integers(0, size, 50).tolist() if size else []:
        token = int(ids[i])
        assert matrix.access(i) == token
        assert matrix.rank(token, i) == int((ids[:i] == token).sum())
        assert matrix.select(token, int((ids[:i] == token).sum())) == i
    assert matrix.rank(top + 5, size) == 0


def brute(rows):
    tokenizer, at, out = Tokenizer.from_file(T.tokenizer_file()), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or "")):
        ids = np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_edge_texts(spark, docs):
    rows = [
        (5, None), (3, ""), (9, " "), (1, "  two  spaces "), (2, "a\n b"), (4, "a \nb\n\n c"), (6, "x <|endoftext|> y"),
        (7, "don't\tstop  now 　 ok"), (8, "é" * 3000), (8, "again"), (None, "no id"), (10, " lead and trail "),
        (-4, "\x85 odd \x1c space"), (11, "1 2 three,four ...  "),
    ]
    found = T.token_output(spark, docs(rows)).collect()
    assert sorted(tuple(r) for r in found if r[0] is not None) == sorted(x for x in brute(rows) if x[0] is not None)
    assert [tuple(r) for r in found if r[0] is None] == [x for x in brute(rows) if x[0] is None]
    assert T.token_output(spark, docs([])).count() == 0


def test_query_over_whole_table(spark):
    rows = [tuple(r) for r in table(spark, FOLDER, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op3_token_output"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in found) == brute(rows)


def test_lookups_read_only_their_blocks():
    rng = np.random.default_rng(5)
    ids = rng.zipf(1.3, 1_200_000).clip(1, 40_000).astype(np.int32)
    data = wavelet.dump(wavelet.WaveletMatrix.of(ids), np.asarray([7]), np.asarray([True]), np.asarray([len(ids)]))
    read = []

    def ranged(start, end):
        read.append((start, end))
        return data[start:end]

    file = wavelet.WaveletFile(ranged)
    levels, planes = len(file.matrix.zeros), sum(file.edges[7 + 2 * k] - file.edges[6 + 2 * k] for k in range(len(file.matrix.zeros)))
    for i in (0, 65_535, 65_536, 65_537, 700_001, len(ids) - 1):
        read.clear()
        file.matrix._kept.clear()
        assert file.matrix.access(i) == ids[i]
        assert len(read) <= 2 * levels and 8 * sum(b - a for a, b in read) < planes
        token, before = int(ids[i]), int((ids[:i] == ids[i]).sum())
        read.clear()
        file.matrix._kept.clear()
        assert file.matrix.rank(token, i) == before and file.matrix.select(token, before) == i
        assert len(read) <= 6 * levels
    with pytest.raises(ValueError):
        wavelet.load(b"none" + data[4:])


def test_lookups_over_shards(spark, docs):
    rows = [(i, f"word {i % 7} and <|endoftext|> again" * (1 + i % 3)) for i in range(300)] + [(5, "word"), (None, None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        shards = T.write_shards(docs(rows), T.tokenizer_file(), shard_tokens=500)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    tokenizer, ids = Tokenizer.from_file(T.tokenizer_file()), []
    for _, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] or "")):
        ids += [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
    assert shards.count() > 3
    for token in (2, ids[0], ids[len(ids) // 2], 49_999):
        assert sorted(r.position for r in T.occurrences(shards, token).collect()) == [i for i, x in enumerate(ids) if x == token]
    asked = [0, 1, 499, 500, len(ids) - 1, len(ids), -1, None, 1]
    made = spark.createDataFrame([(p, "x") for p in asked], "position long, token string")
    found = [tuple(r) for r in T.tokens_at(shards, made).collect()]
    inside = [(p, ids[p] if p is not None and 0 <= p < len(ids) else None) for p in asked]
    assert sorted(found, key=str) == sorted(inside, key=str)
    empty = T.write_shards(docs([]), T.tokenizer_file())
    assert T.occurrences(empty, 2).count() == 0 and [tuple(r) for r in T.tokens_at(empty, made.limit(1)).collect()] == [(0, None)]


def test_plain_pieces_and_full_stores():
    whole, few = T.CachedTokenizer(T.tokenizer_file()), T.CachedTokenizer(T.tokenizer_file(), 3)
    texts = ["", "a", " a", "one two, three\nfour. five", "one\n", "a\nb\nc d", "x\u0130 \u00e9t\u00e9, na\u00efve;\n\u0141\u00f3d\u017a", "\ud55c\uad6d 12ab c3", "two  spaces", "ends ", "one two, three"]
    tokenizer = Tokenizer.from_file(T.tokenizer_file())
    assert [x.tolist() for x in whole(["", " ", ""])] == [tokenizer.encode(" ", add_special_tokens=False).ids, [0, 1, 0]]
    for encoder in (whole, few, whole, few):
        ids, sizes = encoder(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
