"""Substring dedup: words covered by 35-word windows that are elsewhere too are removed.

Segments that hold repeated anchors (see repeats) are indexed in shards by compressed FM-indexes; the segments are
then streamed through their shard's index backwards, and the matching statistics report intervals that reach the
threshold at two places or more. Windows are judged on the input: all their places lose them.

A null or empty text has no words and loses none; texts shorter than a window lose none. Rows that repeat both doc_id
and text lose all their windows (each has another place). Other columns don't matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ._text import small_batches, utf8
from .fm_index import FMIndex
from .repeats import Shard, Units, carried, covered, keyed, removed, repeated

WINDOW, GRAM = 35, 12


def _search(window: int):
    def search(shard: Shard, table: pa.Table) -> np.ndarray:
        index = FMIndex(shard.units, shard.first, shard.weight, window)
        return index.matching_statistics(shard.units, shard.first) >= window

    return search


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The keyed rows, and did, th, lo, hi: ranges of windows (by first words) that are at two places or more."""
    rows = keyed(docs, text, doc_id)
    places, _, found = repeated(rows, Units(window, gram, True), _search(window))
    single = found.filter("n = 1").selectExpr("did", "th", "start + lo AS lo", "start + hi AS hi")
    many = carried(places, found.filter("n > 1").select("anchor", "sh", "lo", "hi")).selectExpr("did", "th", "start + lo AS lo", "start + hi AS hi")
    return rows, single.unionByName(many)


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text", doc_id: str = "doc_id", with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, if asked for, kept_text (kept words joined by one space)."""
    rows, cuts = repeated_windows(docs, window, gram, text, doc_id)

    def cut(batches):
        for batch in small_batches(batches, 1 << 22):
            n, gone, sha, kept_text = [], [], [], []
            for t, own in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = t.split()  # bytes split at the same white space
                n.append(len(words))
                spans = covered(own, window)
                kept, at = [], 0
                for a, b in spans:
                    kept += words[at:a]
                    at = b
                kept += words[at:]
                gone.append(len(words) - len(kept))
                joined = b" ".join(kept)
                sha.append(hashlib.sha256(joined).hexdigest())
                kept_text.append(joined)
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha, pa.string())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(kept_text, pa.binary()).cast(pa.string())] if with_text else []), ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text)

    return removed(rows, cuts).select("doc_id", "text", "cuts").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text)


def digest(docs: DataFrame) -> DataFrame:
    return deduplicated(docs, with_text=False)
