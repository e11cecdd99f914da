"""Suffix arrays by induced sorting and permuted common prefixes, on NumPy.

Suffixes are classified as S (smaller than the next suffix) or L; leftmost S suffixes (LMS) are sorted by their
substrings, named, and if names repeat, sorted recursively; from them L and S suffixes are induced, each in one pass
over the array. With few symbols a pass goes bucket by bucket, each bucket's entries at once; with many symbols (the
named strings of the recursion) it goes entry by entry. Both passes are linear.
"""

from __future__ import annotations

import numpy as np


def _types(t: np.ndarray) -> np.ndarray:
    """True for S. The last suffix is S."""
    n = len(t)
    step = np.sign(np.diff(t)).astype(np.int8)
    at = np.where(step != 0, np.arange(n - 1), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]  # where the symbol next differs
    out = np.ones(n, bool)
    inner = at < n - 1
    out[:-1][inner] = step[at[inner]] > 0
    out[:-1][~inner] = False
    return out


def _within(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many equal keys are before each, and of each key how many (as keys, counts)."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    head = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    count = np.diff(np.append(head, len(k)))
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(k)) - np.repeat(head, count)
    return out, np.stack([k[head], count])


def _induce_by_bucket(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """lms in their order, by bucket; the suffix array induced from them."""
    n, k = len(t), len(begin)
    sa = np.full(n, -1, np.int64)
    cuts = np.searchsorted(t[lms], np.arange(k + 1))
    head = begin.copy()
    l_end = begin.copy()

    def put_l(preds: np.ndarray) -> None:
        c = t[preds]
        rank, (keys, count) = _within(c)
        sa[head[c] + rank] = preds
        head[keys] += count

    for c in range(k):
        if end[c] == begin[c]:
            continue
        done = begin[c]
        while True:  # the bucket's L entries; they may add to it
            now = head[c]
            if done == now:
                break
            preds = sa[done:now]
            preds = preds[preds > 0] - 1
            preds = preds[~s_type[preds]]
            done = now
            if len(preds):
                put_l(preds)
        l_end[c] = head[c]
        own = lms[cuts[c] : cuts[c + 1]]
        preds = own[own > 0] - 1
        if len(preds):
            put_l(preds)  # what is before a leftmost S is L
    tail = end.copy()

    def put_s(preds: np.ndarray) -> None:
        """preds in the order in which they are met, from the array's end."""
        c = t[preds]
        rank, (keys, count) = _within(c)
        sa[tail[c] - 1 - rank] = preds
        tail[keys] -= count

    for c in range(k - 1, -1, -1):
        if end[c] == begin[c]:
            continue
        done = end[c]
        while True:
            now = tail[c]
            if done == now:
                break
            preds = sa[now:done][::-1]
            preds = preds[preds > 0] - 1
            preds = preds[s_type[preds]]
            done = now
            if len(preds):
                put_s(preds)
        preds = sa[begin[c] : l_end[c]][::-1]
        preds = preds[preds > 0] - 1
        preds = preds[s_type[preds]]
        if len(preds):
            put_s(preds)
    if sa[0] != n - 1:
        sa[0] = n - 1  # the end mark, which nothing induces
    return sa


def _induce_by_entry(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(t)
    text, is_s = t.tolist(), s_type.tolist()
    sa = [-1] * n
    tail = end.tolist()
    for j in lms[::-1].tolist():
        c = text[j]
        tail[c] -= 1
        sa[tail[c]] = j
    head = begin.tolist()
    for i in range(n):
        j = sa[i] - 1
        if j >= 0 and not is_s[j]:
            c = text[j]
            sa[head[c]] = j
            head[c] += 1
    tail = end.tolist()
    for i in range(n - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and is_s[j]:
            c = text[j]
            tail[c] -= 1
            sa[tail[c]] = j
    sa[0] = n - 1
    return np.array(sa, np.int64)


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Of integers from 0 on; the last is 0 and no other is."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int64)
    k = int(t.max()) + 1
    count = np.bincount(t, minlength=k)
    end = np.cumsum(count)
    begin = end - count
    s_type = _types(t)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    induce = _induce_by_bucket if k * 100 < n else _induce_by_entry
    # by first symbol, any order within: the induced array has the LMS substrings sorted
    sa = induce(t, s_type, lms[np.argsort(t[lms], kind="stable")], begin, end)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    by = sa[is_lms[sa]]
    nxt = np.full(n, n - 1)
    nxt[lms[:-1]] = lms[1:]
    a, b = by[:-1], by[1:]
    same = (nxt[a] - a) == (nxt[b] - b)
    alive, d = np.flatnonzero(same), 0
    while len(alive):
        differs = t[a[alive] + d] != t[b[alive] + d]
        same[alive[differs]] = False
        alive = alive[~differs]
        d += 1
        alive = alive[a[alive] + d <= nxt[a[alive]]]
    name = np.zeros(n, np.int64)
    name[by] = np.concatenate([[0], np.cumsum(~same)])
    names = name[lms]
    if int(names.max()) + 1 < len(lms):
        order = suffix_array(names)
    else:
        order = np.empty(len(lms), np.int64)
        order[names] = np.arange(len(lms))
    return induce(t, s_type, lms[order], begin, end)


def permuted_prefixes(t: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place in the text, the common prefix with the suffix before it in the array. Where both are preceded by
    the same symbol it is one less than the place before has; only the others are compared, 8 symbols at a time."""
    n = len(t)
    phi = np.full(n, -1)
    phi[sa[1:]] = sa[:-1]
    first = int(sa[0])
    at = np.arange(n)
    same_before = np.zeros(n, bool)
    ok = (at > 0) & (phi > 0)
    same_before[ok] = t[at[ok] - 1] == t[phi[ok] - 1]
    # the place before must itself follow phi: true when its own predecessor in the array is phi - 1
    chain = np.zeros(n, bool)
    chain[1:] = same_before[1:] & (phi[:-1] == phi[1:] - 1)
    todo = np.flatnonzero(~chain & (at != first))
    plcp = np.zeros(n, np.int64)
    eight = np.zeros(n, np.uint64)
    padded = np.concatenate([t, np.zeros(8, t.dtype)]).astype(np.uint64)
    wide = int(t.max()) >= 256
    width = 4 if wide else 8
    bits = 16 if wide else 8
    for i in range(width):
        eight |= padded[i : i + n] << np.uint64(bits * i)
    alive = todo
    i, j = todo.copy(), phi[todo].copy()
    while len(alive):
        inside = (i + width <= n) & (j + width <= n)
        same = np.zeros(len(alive), bool)
        same[inside] = eight[i[inside]] == eight[j[inside]]
        left_i, left_j, who = i[~same], j[~same], alive[~same]
        for _ in range(width):
            go = (left_i < n) & (left_j < n)
            go[go] = t[left_i[go]] == t[left_j[go]]
            left_i, left_j, who = left_i[go], left_j[go], who[go]
            plcp[who] += 1
            left_i, left_j = left_i + 1, left_j + 1
        plcp[alive[same]] += width
        alive, i, j = alive[same], i[same] + width, j[same] + width
    head = np.maximum.accumulate(np.where(chain, 0, at))
    return plcp[head] - (at - head)
