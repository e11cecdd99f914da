"""Suffix-array dedup: bytes covered by 100-byte strings that also start earlier are removed.

Segments that hold repeated anchors (see repeats) are put end to end in shards; each shard gets its suffix array by
induced sorting and its permuted common prefixes, which give the classes of equal windows. The first place of a
class (least doc_id, then least start) stays, all its other places are removed. Windows are judged on the input and
never cross documents.

A null or empty text has no bytes. Rows that repeat doc_id and text are one document: neither is earlier than the
other, so they lose what an earlier document has, and what repeats inside. A null doc_id comes before all others; of
rows with one doc_id and different texts the one with the lesser hash comes first. Other columns don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import U, mixed, ngrams, small_batches, utf8
from .repeats import Shard, Units, carried, covered, keyed, removed, repeated
from .suffix_array import permuted_prefixes, suffix_array

WINDOW, GRAM = 100, 36


def _candidates(shard: Shard, window: int) -> np.ndarray:
    """Parts that hold a window whose hash is twice in the shard: others have nothing to sort."""
    h = ngrams(mixed(shard.units.astype(U) + U(1)), window)
    n = np.diff(shard.first)
    part = np.repeat(np.arange(len(n)), n)[: len(h)]
    at = np.flatnonzero(np.arange(len(h)) + window <= shard.first[1:][part])
    _, back, count = np.unique(h[at], return_inverse=True, return_counts=True)
    return np.unique(part[at[count[back] > 1]])


def _search(window: int):
    def search(shard: Shard, table: pa.Table) -> np.ndarray:
        """Units at which a window starts that also starts earlier than the segment's first place has it."""
        flags = np.zeros(len(shard.units), bool)
        take = _candidates(shard, window)
        if not len(take):
            return flags
        n = np.diff(shard.first)[take]
        text = np.ones(int(n.sum()) + len(take) + 1, np.int64)  # 1 ends a part, 0 the text
        part = np.repeat(np.arange(len(take)), n)
        src = np.repeat(shard.first[take] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        place = np.arange(len(src)) + part
        text[place] = shard.units[src].astype(np.int64) + 2
        text[-1] = 0
        sa = suffix_array(text)
        lcp = permuted_prefixes(text, sa)
        # windows in the array's order; a class begins where the common prefix is shorter than a window
        unit = np.full(len(text), -1)
        fits = np.arange(len(src)) + window <= np.cumsum(n)[part]
        unit[place[fits]] = src[fits]
        rows = sa[unit[sa] >= 0]
        if not len(rows):
            return flags
        # between two windows of a class no other suffix can stand, so neighbours in rows are neighbours in sa
        cls = np.cumsum(np.append(True, lcp[rows[1:]] < window))
        u = unit[rows]
        p = np.searchsorted(shard.first, u, "right") - 1
        start = table.column("start").to_numpy()[p] + u - shard.first[p]
        did, th = table.column("did").to_numpy()[p], table.column("th").to_numpy()[p]
        order = np.lexsort((start, th, did, cls))
        later = np.ones(len(order), bool)
        later[np.flatnonzero(np.append(True, np.diff(cls[order]) != 0))] = False
        flags[u[order[later]]] = True
        return flags

    return search


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The keyed rows, and did, th, lo, hi: ranges of windows (by first bytes) that also start earlier."""
    rows = keyed(docs, text, doc_id)
    places, distinct, found = repeated(rows, Units(window, gram, False), _search(window), 1 << 18)
    firsts = found.selectExpr("did", "th", "start + lo AS lo", "start + hi AS hi")
    many = distinct.filter("n > 1").select("anchor", "sh", F.col("did").alias("fd"), F.col("th").alias("ft"), F.col("start").alias("fs"))
    others = carried(places, many).filter("NOT (did = fd AND th = ft AND start = fs)").selectExpr("did", "th", "start AS lo", "start + n_windows - 1 AS hi")
    return rows, firsts.unionByName(others)


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id", with_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the remaining bytes)."""
    rows, cuts = repeated_windows(docs, window, gram, text, doc_id)

    def cut(batches):
        for batch in small_batches(batches, 1 << 22):
            n, gone, spans_, sha, kept_ = [], [], [], [], []
            for t, own in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                spans = covered(own, window)
                kept = b"".join(t[a:b] for a, b in zip([0, *(b for _, b in spans)], [*(a for a, _ in spans), len(t)], strict=True))
                n.append(len(t)), gone.append(len(t) - len(kept)), spans_.append(len(spans)), sha.append(hashlib.sha256(kept).hexdigest()), kept_.append(kept)
            cols = [batch.column(0), *(pa.array(x, pa.int64()) for x in (n, gone, spans_)), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(kept_, pa.binary())] if with_bytes else []), ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_bytes)

    return removed(rows, cuts).select("doc_id", "text", "cuts").mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes)


def digest(docs: DataFrame) -> DataFrame:
    return deduplicated(docs, with_bytes=False)
