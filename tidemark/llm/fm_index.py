"""A compressed full-text index of a shard: the Burrows-Wheeler transform in a wavelet tree of packed bit rows, with
backward search and matching statistics. Beside the tree a row has 13 bytes: its common prefix (one byte), the rows
next to it with shorter ones, and the weights before it. All searches run for many patterns at once."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit row in 64-bit words with a count before each word."""

    def __init__(self, bits: np.ndarray):
        pad = np.zeros(-len(bits) % 64 + 64, np.uint8)
        self.words = np.packbits(np.concatenate([bits.astype(np.uint8), pad]), bitorder="little").view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)]).astype(np.int32)

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones before i."""
        w, r = i >> 6, (i & 63).astype(np.uint64)
        return self.before[w] + np.bitwise_count(self.words[w] & ((np.uint64(1) << r) - np.uint64(1)))


class WaveletTree:
    """Symbols by bits, the highest first; each level holds the zeros before the ones (a wavelet matrix), so no pointers are kept."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, int(values.max(initial=0)).bit_length())
        self.rows, self.zeros = [], []
        cur, n = values, int(values.max(initial=0)) + 1
        for k in range(self.levels - 1, -1, -1):
            bit = (cur >> k) & 1
            self.rows.append(Bits(bit))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])
            self.zeros.append(int((bit == 0).sum()))
        self.start = self._down(np.arange(n), np.zeros(n, np.int64))

    def _down(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, row, zeros in zip(range(self.levels - 1, -1, -1), self.rows, self.zeros, strict=True):
            one = row.ones(i)
            i = np.where((c >> k) & 1, zeros + one, i - one)
        return i

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c is before i."""
        return self._down(c, i) - self.start[c]


def suffix_ranks(text: np.ndarray, deepest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array by doubling, and ranks by the first 1, 2, 4, ... symbols (as far as `deepest`)."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    kept, p = [rank], 1
    order = np.argsort(rank, kind="stable")
    while p < n and int(rank.max()) < n - 1:
        second = np.zeros(n, np.int64)
        second[: n - p] = rank[p:] + 1
        key = rank * (n + 1) + second
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = step
        p *= 2
        if p <= deepest:
            kept.append(rank)
    return order, kept


class FMIndex:
    """Parts (first has where each starts, and the end) of symbols from 0 on; weights count the places that each part stands for. longest: match lengths above it are not told apart."""

    def __init__(self, symbols: np.ndarray, first: np.ndarray, weights: np.ndarray, longest: int):
        lens = np.diff(first)
        part = np.repeat(np.arange(len(lens)), lens)
        text = np.ones(len(symbols) + len(lens) + 1, np.int64)  # 1 ends a part, 0 the text
        text[np.arange(len(symbols)) + part] = symbols + 2
        text[-1] = 0
        sa, ranks = suffix_ranks(text, longest)
        n = len(text)
        self.n, self.longest = n, longest
        counts = np.bincount(text, minlength=int(text.max()) + 2)
        self.before = np.cumsum(counts) - counts
        self.tree = WaveletTree(text[sa - 1])
        weight = np.append(np.repeat(weights, lens + 1), 0)
        total = np.concatenate([[0], np.cumsum(weight[sa])])
        self.weight = total.astype(np.int32) if total[-1] < 1 << 31 else total
        # common prefixes of neighbours, by ranks of halving lengths
        a, b = sa[:-1], sa[1:]
        lcp = np.zeros(n - 1, np.int64)
        for k in range(len(ranks) - 1, -1, -1):
            i, j = np.minimum(a + lcp, n - 1), np.minimum(b + lcp, n - 1)
            lcp += (1 << k) * (ranks[k][i] == ranks[k][j])
        self.lcp = np.concatenate([[0], np.minimum(lcp, longest), [0]]).astype(np.min_scalar_type(longest))  # lcp[i]: of rows i - 1 and i
        # the nearest rows on both sides with a shorter prefix
        self.left, self.right = np.zeros(n + 1, np.int32), np.full(n + 1, n, np.int32)
        for v in range(1, longest + 1):
            mine = np.flatnonzero(self.lcp == v)
            if len(mine):
                low = np.flatnonzero(self.lcp < v)
                after = np.searchsorted(low, mine)
                self.left[mine], self.right[mine] = low[after - 1], low[after]

    def extended(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: rows of c and the pattern."""
        both = self.tree.rank(np.concatenate([c, c]), np.concatenate([lo, hi])) + np.concatenate([self.before[c], self.before[c]])
        return both[: len(c)], both[len(c) :]

    def matching_statistics(self, symbols: np.ndarray, first: np.ndarray, least: int = 2) -> np.ndarray:
        """For each position of the streamed parts the length of the longest match from there that the index has at `least` places (or at least `longest`)."""
        lens = np.diff(first)
        order = np.argsort(-lens, kind="stable")
        ends, lens = first[1:][order], lens[order]
        out = np.zeros(len(symbols), np.int64)
        lo, hi, length = np.zeros(len(lens), np.int64), np.full(len(lens), self.n), np.zeros(len(lens), np.int64)
        for t in range(1, int(lens[0]) + 1 if len(lens) else 1):
            k = int(np.searchsorted(-lens, -t, "right"))
            at = ends[:k] - t
            todo = np.arange(k)
            while len(todo):
                c = symbols[at[todo]] + 2
                a, b = self.extended(c, lo[todo], hi[todo])
                ok = self.weight[b] - self.weight[a] >= least
                good = todo[ok]
                lo[good], hi[good] = a[ok], b[ok]
                length[good] += 1
                todo = todo[~ok]
                todo = todo[length[todo] > 0]  # others match nothing here
                # shorten the match from its right end, to the next length that has more rows
                x, y = lo[todo], hi[todo]
                edge = np.where(self.lcp[x] >= self.lcp[y], x, y)
                shorter = self.lcp[edge]
                length[todo] = shorter
                lo[todo], hi[todo] = np.where(shorter > 0, self.left[edge], 0), np.where(shorter > 0, self.right[edge], self.n)
            out[at] = length[:k]
        return out
