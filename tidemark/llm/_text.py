"""Vectorised text kernels on UTF-8 bytes: word bounds, 64-bit word hashes, hashes of n-grams, sliding minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

U = np.uint64
MULTIPLIER = U(0x9E3779B97F4A7C55)
WHITE = bytes([0x20, *range(0x09, 0x0E)])


def byte_set(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[np.frombuffer(members, np.uint8)] = True
    return table


#: Bytes of words as [^\x20\x09-\x0D]+ has them.
NOT_WHITE = ~byte_set(WHITE)
#: Bytes of words as [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ has them, after A-Z are lower-cased.
ALNUM = byte_set(bytes([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads all bits (splitmix64)."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> U(30))
        h = h * U(0xBF58476D1CE4E5B9)
        h ^= h >> U(27)
        h = h * U(0x94D049BB133111EB)
        return h ^ (h >> U(31))


class Words:
    """Words of several texts in one buffer. first has, for each text and the end, the number of its first word."""

    def __init__(self, texts: list[bytes], members: np.ndarray = NOT_WHITE, lower: bool = False):
        self.buf = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if lower:
            self.buf = LOWER[self.buf]
        sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        inside = members[self.buf].view(np.int8)
        step = np.diff(inside, prepend=np.int8(0))
        self.starts = np.flatnonzero(step == 1)
        self.ends = np.flatnonzero(step == -1)
        self.first = np.searchsorted(self.starts, self.at)

    def __len__(self) -> int:
        return len(self.starts)

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i] : self.ends[i]].tobytes()

    def hashes(self, block: int = 1 << 16) -> np.ndarray:
        """A 64-bit hash of each word; long texts go through in blocks."""
        lens = self.ends - self.starts
        total = np.cumsum(lens)
        out = np.empty(len(lens), U)
        lo = 0
        while lo < len(lens):
            done = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, done + block, "right")))
            n = lens[lo:hi]
            begin = np.cumsum(n) - n
            pos = np.arange(int(n.sum())) - np.repeat(begin, n)
            vals = self.buf[np.repeat(self.starts[lo:hi], n) + pos].astype(U) + U(1)
            powers = np.cumprod(np.full(int(n.max()), MULTIPLIER, U))
            out[lo:hi] = np.add.reduceat(vals * powers[pos], begin)
            lo = hi
        return mixed(out)

    def of_word(self) -> np.ndarray:
        """The text that each word is of."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """A hash of each n consecutive values, in about 2 log n passes."""
    if len(h) < n:
        return np.empty(0, U)
    acc, have, cur, p = None, 0, h, 1
    factor = MULTIPLIER
    acc_factor = U(1)
    with np.errstate(over="ignore"):
        left = n
        while left:
            if left & 1:
                acc = cur if acc is None else acc[: len(cur) - have] + acc_factor * cur[have:]
                have += p
                acc_factor = acc_factor * factor
            left >>= 1
            if left:
                cur = cur[: len(cur) - p] + factor * cur[p:]
                factor = factor * factor
                p *= 2
    return mixed(acc[: len(h) - n + 1])


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """The least of each w consecutive values."""
    if len(h) < w:
        return h[:0]
    cur, p = h, 1
    while p * 2 <= w:
        cur = np.minimum(cur[: len(cur) - p], cur[p:])
        p *= 2
    n = len(h) - w + 1
    return np.minimum(cur[:n], cur[w - p : w - p + n])


def cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of entries whose sizes come to `most` or less, or of one entry."""
    total, lo = np.cumsum(sizes), 0
    while lo < len(sizes):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... for each entry, as many as its size."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def whole_groups(batches, columns: list[str], least: int = 4096) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of about `least` rows or one group, and for each row the number of its group there. Rows with equal columns, which must follow each other, are a group."""
    held: list[pa.RecordBatch] = []
    for batch in _ended(batches):
        if batch is not None:
            held.append(batch)
            if sum(b.num_rows for b in held) < least:
                continue
        if not held:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(c).to_numpy() for c in columns]
        new = np.zeros(table.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        cut = table.num_rows if batch is None else int(np.flatnonzero(new)[-1]) if new.any() else 0
        if cut:
            yield table.slice(0, cut), np.cumsum(new[:cut])
        held = table.slice(cut).to_batches()


def _ended(batches):
    yield from batches
    yield None


def word_hash(word: str) -> np.uint64:
    return Words([word.encode()], np.ones(256, bool) & (np.arange(256) != 0x20)).hashes()[0]


def utf8(column) -> list[bytes]:
    """Arrow strings as bytes; null as b''."""
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return [b"" if t is None else t for t in col.cast(kind).to_pylist()]


def small_batches(batches, most: int = 1 << 21, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cuts Arrow batches so that each has about `most` bytes of text, or one long row."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0).to_numpy(zero_copy_only=False), np.int64)
        total, lo = np.cumsum(sizes), 0
        while lo < len(sizes):
            done = total[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(total, done + most, "right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
