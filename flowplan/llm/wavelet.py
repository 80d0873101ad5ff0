"""A wavelet matrix over token ids, with rank and select, in one compressed byte string.

The file keeps every bit plane in blocks of 2^16 bits that are compressed by themselves. A plane has a
directory of its blocks, where each begins and how many ones stand before it, and a block has one of its
words, the ones before each 512 bits. So a lookup reads the header, a directory per plane, and a block or
two per plane; only ``tokens`` reads all planes.
"""

from __future__ import annotations

import struct
from collections.abc import Callable

import numpy as np
import zstandard

MAGIC = b"WVM2"
WORD_BITS = 512
BLOCK_BITS = 1 << 16
#: What a matrix that is read from a file keeps unpacked at a time.
BLOCKS_KEPT = 256
_HEAD = "<4sQQI"
_HEAD_BYTES = struct.calcsize(_HEAD)


def _before(counts: np.ndarray) -> np.ndarray:
    """Sums of ``counts`` before each place, and their total."""
    return np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _packed_block(plane: np.ndarray, k: int) -> bytes:
    """The ones before each word of block ``k``, then its bits."""
    bits = plane[k * BLOCK_BITS // 8 : (k + 1) * BLOCK_BITS // 8]
    ones = np.bitwise_count(np.concatenate([bits, np.zeros(-len(bits) % (WORD_BITS // 8), np.uint8)]))
    words = _before(ones.reshape(-1, WORD_BITS // 8).sum(1, dtype=np.int64))[:-1]
    return words.astype("<u2").tobytes() + bits.tobytes()


class WaveletMatrix:
    """Bit planes of the ids' ranks in the shard's own alphabet, the highest bit first.

    Every plane holds one bit per token; below it zeros come before ones, each in the order of the
    plane. ``block`` gives a block of a plane as the ones before each of its words and its bits.
    """

    def __init__(self, alphabet: np.ndarray, zeros: list[int], size: int, ones: list[np.ndarray], block: Callable[[int, int], bytes]):
        self.alphabet, self.zeros, self.size, self.ones, self._read = alphabet, zeros, size, ones, block
        self._kept: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        top = int(ids.max()) + 1 if len(ids) else 0
        alphabet = np.flatnonzero(np.bincount(ids, minlength=top)) if top else np.zeros(0, np.int64)
        table = np.zeros(top, np.uint16 if len(alphabet) <= 1 << 16 else np.uint32)
        table[alphabet] = np.arange(len(alphabet))
        codes, planes, zeros, directory = table[ids], [], [], []
        for level in range(max(1, int(len(alphabet) - 1).bit_length()) - 1, -1, -1):
            ones = (codes & table.dtype.type(1 << level)) != 0
            plane = np.packbits(ones)
            planes.append(plane)
            steps = np.arange(0, len(plane), BLOCK_BITS // 8)
            directory.append(_before(np.add.reduceat(np.bitwise_count(plane), steps, dtype=np.int64) if len(plane) else steps))
            low = codes.compress(~ones)  # much faster than a mask as index
            zeros.append(len(low))
            codes = np.concatenate([low, codes.compress(ones)])
        return cls(alphabet.astype(np.uint32), zeros, len(ids), directory, lambda level, k: _packed_block(planes[level], k))

    def _block(self, level: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        found = self._kept.get((level, k))
        if found is None:
            if len(self._kept) >= BLOCKS_KEPT:
                self._kept.clear()
            data = self._read(level, k)
            bits = min(BLOCK_BITS, self.size - k * BLOCK_BITS)
            words = -(-bits // WORD_BITS)
            found = self._kept[level, k] = np.frombuffer(data, "<u2", words), np.frombuffer(data, np.uint8, offset=2 * words)
        return found

    def _bit(self, level: int, i: int) -> int:
        k, i = divmod(i, BLOCK_BITS)
        return int(self._block(level, k)[1][i >> 3] >> (7 - (i & 7))) & 1

    def _ones_before(self, level: int, i: int) -> int:
        ones, (k, i) = self.ones[level], divmod(i, BLOCK_BITS)
        if not i:
            return int(ones[k])
        words, bits = self._block(level, k)
        word = (i - 1) // WORD_BITS
        count = int(ones[k]) + int(words[word]) + int(np.bitwise_count(bits[word * WORD_BITS // 8 : i >> 3]).sum())
        return count + (int(bits[i >> 3] >> (8 - (i & 7))).bit_count() if i & 7 else 0)

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        code = 0
        for level in range(len(self.zeros)):
            bit, ones = self._bit(level, i), self._ones_before(level, i)
            code = code << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return int(self.alphabet[code])

    def _path(self, token: int) -> list[int] | None:
        k = int(np.searchsorted(self.alphabet, token))
        if k == len(self.alphabet) or self.alphabet[k] != token:
            return None
        return [k >> level & 1 for level in range(len(self.zeros) - 1, -1, -1)]

    def rank(self, token: int, end: int) -> int:
        """How often ``token`` stands before position ``end``."""
        path = self._path(token)
        if path is None:
            return 0
        a, b = 0, max(0, min(end, self.size))
        for level, one in enumerate(path):
            x, y = self._ones_before(level, a), self._ones_before(level, b)
            a, b = (self.zeros[level] + x, self.zeros[level] + y) if one else (a - x, b - y)
        return b - a

    def select(self, token: int, k: int) -> int:
        """The position of occurrence ``k`` of ``token``, counted from zero."""
        if not 0 <= k < self.rank(token, self.size):
            raise IndexError(k)
        path, i = self._path(token), 0
        for level, one in enumerate(path):
            ones = self._ones_before(level, i)
            i = self.zeros[level] + ones if one else i - ones
        i += k
        for level in range(len(path) - 1, -1, -1):
            i = self._select_bit(level, path[level], i - self.zeros[level] if path[level] else i)
        return i

    def _select_bit(self, level: int, one: int, k: int) -> int:
        starts = self.ones[level]
        if not one:
            starts = np.minimum(np.arange(len(starts)) * BLOCK_BITS, self.size) - starts
        block = int(np.searchsorted(starts, k, "right")) - 1
        k -= int(starts[block])
        words, bits = self._block(level, block)
        words = words.astype(np.int64)
        if not one:
            words = np.arange(len(words)) * WORD_BITS - words
        word = int(np.searchsorted(words, k, "right")) - 1
        inside = np.unpackbits(bits[word * WORD_BITS // 8 : (word + 1) * WORD_BITS // 8]) == one
        return block * BLOCK_BITS + word * WORD_BITS + int(np.flatnonzero(inside)[k - int(words[word])])

    def plane(self, level: int) -> np.ndarray:
        """All bits of a plane, eight to a byte."""
        words = [-(-min(BLOCK_BITS, self.size - at) // WORD_BITS) for at in range(0, self.size, BLOCK_BITS)]
        parts = [np.frombuffer(self._read(level, k), np.uint8, offset=2 * n) for k, n in enumerate(words)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint8)

    def tokens(self) -> np.ndarray:
        """All tokens in order: the planes undone from the lowest bit up."""
        kind = np.uint16 if len(self.alphabet) <= 1 << 16 else np.uint32
        codes = np.zeros(self.size, kind)
        for level in range(len(self.zeros) - 1, -1, -1):
            ones = np.unpackbits(self.plane(level), count=self.size).view(bool)
            up = np.empty(self.size, kind)
            up[np.flatnonzero(~ones)] = codes[: self.zeros[level]]
            up[np.flatnonzero(ones)] = codes[self.zeros[level] :] | kind(1 << (len(self.zeros) - 1 - level))
            codes = up
        return self.alphabet[codes] if self.size else self.alphabet[:0]


def dump(matrix: WaveletMatrix, doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray) -> bytes:
    """The file, all little-endian.

    Magic, tokens, documents and planes; where each section ends; doc ids, which are not null, lengths,
    alphabet, zeros per plane; then per plane its directory and its blocks. A directory holds the ones
    before each block and at the end, and where each block begins and the last ends, from the plane's
    first block on.
    """
    press = zstandard.ZstdCompressor(level=1).compress
    columns = [doc_ids.astype("<i8"), known.astype("u1"), lengths.astype("<i8"), matrix.alphabet.astype("<u4"), np.asarray(matrix.zeros, "<i8")]
    sections = [press(c.tobytes()) for c in columns]
    for level, ones in enumerate(matrix.ones):
        blocks = [press(matrix._read(level, k)) for k in range(len(ones) - 1)]
        places = _before(np.fromiter(map(len, blocks), np.int64, len(blocks)))
        sections += [np.concatenate([ones, places]).astype("<i8").tobytes(), b"".join(blocks)]
    ends = np.cumsum([len(s) for s in sections]).astype("<i8")
    return b"".join([struct.pack(_HEAD, MAGIC, matrix.size, len(doc_ids), len(matrix.zeros)), ends.tobytes(), *sections])


class WaveletFile:
    """A file that is read by byte ranges: ``read(start, end)`` gives its bytes from start to before end."""

    def __init__(self, read: Callable[[int, int], bytes]):
        magic, size, self.n_docs, levels = struct.unpack(_HEAD, read(0, _HEAD_BYTES))
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix file")
        self._bytes, first = read, _HEAD_BYTES + 8 * (5 + 2 * levels)
        self.edges = [first, *(first + np.frombuffer(read(_HEAD_BYTES, first), "<i8")).tolist()]
        self._unpress = zstandard.ZstdDecompressor().decompress
        ones, self.places = [], []
        for level in range(levels):
            directory = np.frombuffer(self._section(5 + 2 * level), "<i8")
            ones.append(directory[: len(directory) // 2])
            self.places.append(directory[len(directory) // 2 :])
        zeros = self._column(4, "<i8").tolist()
        self.matrix = WaveletMatrix(self._column(3, "<u4"), zeros, size, ones, self._block)

    def _section(self, k: int) -> bytes:
        return self._bytes(self.edges[k], self.edges[k + 1])

    def _column(self, k: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._unpress(self._section(k)), kind)

    def _block(self, level: int, k: int) -> bytes:
        first, places = self.edges[6 + 2 * level], self.places[level]
        return self._unpress(self._bytes(first + int(places[k]), first + int(places[k + 1])))

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Doc ids, which of them are not null, and lengths."""
        return self._column(0, "<i8"), self._column(1, "u1").astype(bool), self._column(2, "<i8")


def load(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray, np.ndarray]:
    """The matrix, doc ids, which of them are not null, and lengths in ``data``."""
    view = memoryview(data)
    file = WaveletFile(lambda start, end: view[start:end])
    return file.matrix, *file.documents()
