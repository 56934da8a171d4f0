"""Hashes of the words of whole blocks of text, without an object for each word."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

MIX = np.uint64(0x9E3779B97F4A7C15)
LONG = 256  # bytes of a word from which on it is hashed on its own
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of texts laid end to end: runs of bytes other than 0x20 and 0x09 to 0x0D. A null text has none."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        """``lower`` turns A-Z into a-z first."""
        texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
        _, edges, data = texts.buffers()
        edges = np.frombuffer(edges, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
        n = int(edges[-1] - edges[0])
        self.padded = np.zeros(n + 8, dtype=np.uint8)
        if n:
            self.padded[:n] = np.frombuffer(data, np.uint8, n, int(edges[0]))
        edges, flat = edges - edges[0], self.padded[:n]
        if lower:
            flat |= (flat - np.uint8(65) < 26).view(np.uint8) << 5
        word = (flat != 32) & (flat - np.uint8(9) > 4)
        # A word also ends where its text does.
        apart = np.zeros(n + 1, dtype=bool)
        apart[edges] = True
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1] | apart[1:-1]
        last[:-1] &= ~word[1:] | apart[1:-1]
        self.begin, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.sizes = np.diff(np.searchsorted(self.begin, edges))  # words of each text

    def hashes(self) -> np.ndarray:
        """64-bit hashes. A word is mixed eight bytes at a time, all words of the block at once."""
        begin, size = self.begin, self.end - self.begin
        eights = np.ndarray(len(self.padded) - 7, "<u8", self.padded, strides=(1,))
        found = mixed(size.astype(np.uint64) * MIX + (eights[begin] & MASKS[np.minimum(size, 8)]))
        some = np.flatnonzero((size > 8) & (size <= LONG))
        done = 8
        while len(some):
            found[some] = mixed(found[some] * MIX + (eights[begin[some] + done] & MASKS[np.minimum(size[some] - done, 8)]))
            done += 8
            some = some[size[some] > done]
        for i in np.flatnonzero(size > LONG).tolist():
            found[i] = xxhash.xxh64_intdigest(self.padded[begin[i]:self.end[i]])
        return found


def hashed(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of ``texts`` end to end, and how many words each text has."""
    words = Words(texts, lower)
    return words.hashes(), words.sizes


def dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values in order, and which of them each value is."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    order = np.argsort(values)
    ordered = values[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    place = np.empty(len(values), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return ordered[new], place
