"""What finders of repeated windows share: candidates by anchors, distinct segments in shards, removal.

A window is W consecutive units (words or bytes) of one text. Its anchor is the least hash of its GRAM-unit grams, so
that equal windows have equal anchors wherever they stand. Consecutive windows with one anchor are a run, and the
units that they cover are the run's segment: a window is in exactly one segment.

1. Anchors are counted over the corpus; those at one place only can't have repeated windows.
2. Each text learns which of its anchors are repeated, and gives the runs of these as segments. Equal segments are one
   (with the number of places and the first of them) from here on, so that a passage that a third of all texts hold
   is one row from each task.
3. Segments of frequent anchors can still be many, each with its own surroundings. Their windows are counted by hash,
   once for each part of the segments; runs of windows that are there twice or more go on as segments, and equal ones are
   one again.
4. Segments are dealt to shards by anchor; a shard is indexed as a whole (FM-index or suffix array) and tells which
   windows of which segments are repeated.
5. What it says is carried to all places of the segments (through parts of them where they can be many), and texts drop
   what their windows cover.

Rows are known by doc_id (null: the least) and a hash of their text, so rows that repeat both are one document that
stands at several places.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._store import discard, written
from ._text import U, Words, mixed, ngrams, sliding_min, small_batches, spread, utf8

FREQUENT = 64
_BYTE = mixed(np.arange(1, 257, dtype=U))


@dataclass(frozen=True)
class Units:
    """window and gram in units; of words, or else of bytes. shard: bytes of segments to a shard, about."""

    window: int
    gram: int
    words: bool
    shard: int = 1 << 20

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, Callable[[int, int, int], bytes]]:
        """Hashes of all units, each text's first unit (and the end), and what gives units a..b of text d as bytes."""
        if self.words:
            w = Words(texts)
            return w.hashes(), w.first, lambda d, a, b: w.buf[w.starts[w.first[d] + a] : w.ends[w.first[d] + b - 1]].tobytes()
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        return _BYTE[np.frombuffer(b"".join(texts), np.uint8)], first, lambda d, a, b: texts[d][a:b]

    @property
    def grams(self) -> int:
        return self.window - self.gram + 1

    def anchors(self, units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each window's anchor (0: it isn't inside one text), the text of each unit, and the grams' hashes."""
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        g = ngrams(units, self.gram) | U(1)
        a = sliding_min(g, self.grams)
        at = np.arange(len(a))
        return np.where(at + self.window <= first[1:][doc[: len(a)]], a, U(0)), doc, g

    def places(self, units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text of every gram that is an anchor of a window."""
        a, doc, g = self.anchors(units, first)
        if not len(a):
            return g[:0], doc[:0]
        pad = np.zeros(self.grams - 1, U)
        most = ~sliding_min(~np.concatenate([pad, a, pad]), self.grams)
        hit = np.flatnonzero(most == g)
        return g[hit], doc[hit]

    def runs(self, units: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first and last window (from the text's start), and anchor of every run."""
        a, doc, _ = self.anchors(units, first)
        if not len(a):
            z = np.empty(0, np.int64)
            return z, z, z, a
        d = doc[: len(a)]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
        lo = np.flatnonzero(new)
        hi = np.append(lo[1:], len(a)) - 1
        ok = a[lo] != 0
        lo, hi = lo[ok], hi[ok]
        return d[lo], lo - first[d[lo]], hi - first[d[lo]], a[lo]


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(-(2**63))).alias("did"), F.xxhash64(t).alias("th"), t.alias("text"))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _repeated_anchors(rows: DataFrame, units: Units, batch_bytes: int) -> DataFrame:
    """did, th, anchors (lowest bit: is it frequent) of every text with repeated anchors. Texts are read once; their anchors are written, and counted and looked up from there."""

    def of_texts(batches):
        for batch in small_batches(batches, batch_bytes):
            u, first, _ = units.of(utf8(batch.column(2)))
            g, d = units.places(u, first)
            ends = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=batch.num_rows))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _signed(g))], ["did", "th", "places"])

    own = written(rows.select("did", "th", "text").mapInArrow(of_texts, "did long, th long, places array<long>"), "anchors")
    each = own.select("did", "th", F.explode("places").alias("anchor"))
    many = each.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1")
    many = written(many.select("anchor", F.when(F.col("n") > FREQUENT, 1).otherwise(0).cast("long").alias("hot")), "repeated")
    chosen = written(each.join(many.hint("shuffle_hash"), "anchor").groupBy("did", "th").agg(F.collect_set(F.col("anchor").bitwiseAND(F.lit(-2)).bitwiseOR(F.col("hot"))).alias("anchors")), "chosen")
    discard(own)
    discard(many)
    return chosen


_PLACES = "anchor long, hot boolean, sh long, chk long, did long, th long, start long, n_windows long, text binary"
_NAMES = [c.split()[0] for c in _PLACES.split(", ")]
_SCHEMA = pa.schema([(n, {"long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}[c.split()[1]]) for n, c in zip(_NAMES, _PLACES.split(", "), strict=True)])


def _segments(rows: DataFrame, chosen: DataFrame, units: Units, batch_bytes: int) -> DataFrame:
    """_PLACES: a row for each run with a repeated anchor. sh and chk are a hash of the segment's units."""

    def cut(batches):
        for batch in small_batches(batches, batch_bytes):
            u, first, part = units.of(utf8(batch.column(2)))
            doc, lo, hi, anchor = units.runs(u, first)
            anchor = anchor.view(np.int64)
            lists = batch.column(3)
            flat = lists.values.to_numpy()
            sizes = np.diff(lists.offsets.to_numpy())
            flat = flat[lists.offsets[0].as_py() : lists.offsets[-1].as_py()]
            owner = np.repeat(np.arange(batch.num_rows), sizes)
            order = np.lexsort((flat & -2, owner))
            flat, owner = flat[order], owner[order]
            begin = np.concatenate([[0], np.cumsum(sizes)])
            keep, hot = [], []
            edges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            for d in range(batch.num_rows):
                known, runs = flat[begin[d] : begin[d + 1]], np.arange(edges[d], edges[d + 1])
                if not len(runs) or not len(known):
                    continue
                at = np.minimum(np.searchsorted(known & -2, anchor[runs] & -2), len(known) - 1)
                ok = (known[at] & -2) == (anchor[runs] & -2)
                keep.append(runs[ok]), hot.append((known[at[ok]] & 1) == 1)
            keep = np.concatenate(keep) if keep else np.empty(0, np.int64)
            hot = np.concatenate(hot) if hot else np.empty(0, bool)
            doc, lo, hi, anchor = doc[keep], lo[keep], hi[keep], anchor[keep]
            ends = hi + units.window
            base = first[doc]
            raw = u.tobytes() if units.words else None
            texts, hashes = [], []
            for d, a, b, f in zip(doc.tolist(), lo.tolist(), ends.tolist(), base.tolist(), strict=True):
                t = part(d, a, b)
                texts.append(t)
                hashes.append(_hash(t if raw is None else raw[8 * (f + a) : 8 * (f + b)]))
            take = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(hot), *_halves(hashes), batch.column(0).take(take), batch.column(1).take(take), pa.array(lo), pa.array(hi - lo + 1), pa.array(texts, pa.binary())], _NAMES
            )

    return rows.join(chosen.hint("shuffle_hash"), ["did", "th"]).select("did", "th", "text", "anchors").mapInArrow(cut, _PLACES)


def _hash(part: bytes) -> bytes:
    return xxhash.xxh3_128_digest(part)


def _halves(hashes: list[bytes]) -> tuple[pa.Array, pa.Array]:
    both = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
    return pa.array(both[:, 0]), pa.array(both[:, 1])


def _thinned(single: DataFrame, frequent: DataFrame, units: Units, batch_bytes: int, parts: int) -> DataFrame:
    """Of segments at one place, the runs of windows whose hash is there twice or more among all segments of frequent anchors, as segments of their own (_PLACES). What surrounds a frequent passage falls away, and what is left of it is equal again.

    Segments are dealt to parts by their hash. A window that very many segments hold is one row for each part, whether it
    is counted or looked up; each part then gets the hashes that are there twice."""
    part = F.pmod(F.xxhash64("anchor", "sh"), F.lit(parts)).alias("part")

    def windows(texts: list[bytes]):
        u, first, text = units.of(texts)
        n = np.diff(first) - units.window + 1
        return u, first, text, n, ngrams(u, units.window)[spread(first[:-1], n)]

    def every(batches):
        for batch in small_batches(batches, batch_bytes):
            *_, n, wh = windows(batch.column(2).to_pylist())
            own = np.repeat(batch.column(0).to_numpy(), n)
            order = np.lexsort((wh, own))
            head = np.flatnonzero(np.append(True, (np.diff(own[order]) != 0) | (wh[order][1:] != wh[order][:-1]))) if len(wh) else order
            many = np.add.reduceat(np.repeat(batch.column(1).to_numpy(), n)[order], head) if len(wh) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([_signed(wh[order][head]), pa.array(own[order][head]), pa.array(many)], ["wh", "part", "n"])

    def cut(segments: pa.Table, hashes: pa.Table) -> pa.Table:
        out = []
        known = np.sort(hashes.column("wh").to_numpy().view(U))
        for batch in small_batches(segments.to_batches(), batch_bytes):
            texts = batch.column("text").to_pylist()
            u, first, text, n, wh = windows(texts)
            at = np.minimum(np.searchsorted(known, wh), max(0, len(known) - 1))
            found = known[at] == wh if len(known) else np.zeros(len(wh), bool)
            raw, wide = (u.tobytes(), 8) if units.words else (b"".join(texts), 1)
            row, lo, size, parts_, hs = [], [], [], [], []
            for r, a, b in ranges(found, np.concatenate([[0], np.cumsum(n)])):
                e = b + units.window
                row.append(r), lo.append(a), size.append(b - a + 1)
                f = int(first[r])
                parts_.append(text(r, a, e))
                hs.append(_hash(raw[wide * (f + a) : wide * (f + e)]))
            take = pa.array(row, pa.int64())
            start = batch.column("start").to_numpy()[np.array(row, np.int64)] + np.array(lo, np.int64)
            ids = [batch.column(c).take(take) for c in ("anchor", "did", "th")]
            out.append(pa.RecordBatch.from_arrays([ids[0], pa.array(np.ones(len(row), bool)), *_halves(hs), *ids[1:], pa.array(start), pa.array(size, pa.int64()), pa.array(parts_, pa.binary())], _NAMES))
        return pa.Table.from_batches(out, _SCHEMA)

    # one shuffle by hash serves both sums; what a batch has several times is one row already
    every_ = frequent.select(part, "n", "text").mapInArrow(every, "wh long, part long, n long").repartition("wh")
    each = every_.groupBy("wh", "part").agg(F.sum("n").alias("n")).withColumn("m", F.sum("n").over(Window.partitionBy("wh")))
    hashes = each.filter("m > 1").select("part", "wh")
    own = single.select(part, "anchor", "sh", "did", "th", "start", "text")
    return own.groupBy("part").cogroup(hashes.groupBy("part")).applyInArrow(cut, _PLACES)


def carried(places: DataFrame, known: DataFrame) -> DataFrame:
    """places with what is known of their segments (anchor, sh and more; few rows a segment). Segments of frequent anchors can have very many places: these are dealt to parts, what is known goes once to each part that needs it, and they meet there."""
    hot = places.filter("hot")
    parts = max(1, hot.count() >> 16) * 32
    hot = hot.withColumn("part", F.pmod(F.xxhash64("did", "th", "start"), F.lit(parts)))
    needed = hot.select("anchor", "sh", "part").distinct().join(known.hint("shuffle_hash"), ["anchor", "sh"])
    return places.filter("NOT hot").join(known.hint("shuffle_hash"), ["anchor", "sh"]).unionByName(hot.join(needed.hint("shuffle_hash"), ["anchor", "sh", "part"]).drop("part"))


@dataclass
class Shard:
    """Segments: words as dense ids or bytes, one after the other, with each segment's first unit (and the end); weight is the number of places."""

    units: np.ndarray
    first: np.ndarray
    weight: np.ndarray


def _joined(table: pa.Table, units: Units) -> Shard:
    texts = table.column("text").to_pylist()
    h, first, _ = units.of(texts)
    values = np.unique(h, return_inverse=True)[1] if units.words else np.frombuffer(b"".join(texts), np.uint8)
    return Shard(values, first, table.column("n").to_numpy())


def ranges(flags: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, first, last) of every run of flagged positions, from the part's start."""
    at = np.flatnonzero(flags)
    if len(at):
        part = np.searchsorted(first, at, "right") - 1
        cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(part) > 0)) + 1
        for a, b in zip(np.append(0, cut), np.append(cut, len(at)) - 1, strict=True):
            yield int(part[a]), int(at[a] - first[part[a]]), int(at[b] - first[part[a]])


_FOUND = "anchor long, sh long, n long, did long, th long, start long, lo long, hi long"


def repeated(rows: DataFrame, units: Units, search: Callable[[Shard, pa.Table], np.ndarray], batch_bytes: int = 1 << 20) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Places (all of _PLACES but text), distinct segments (anchor, sh, n, did, th, start), and _FOUND: window ranges of distinct segments for which search() flags the units that they start at."""
    chosen = _repeated_anchors(rows, units, batch_bytes)
    cut = _segments(rows, chosen, units, batch_bytes)
    # one pass over the texts: places and texts of segments are written together, the text once per task and segment
    places = written(cut, "places")
    discard(chosen)

    def classes(segments: DataFrame) -> DataFrame:
        # a hash of 64 bits groups them; that no other text has it is checked by 64 more
        one = F.when(F.min("chk") == F.max("chk"), F.min("chk")).otherwise(F.raise_error(F.lit("two segments share a hash")).cast("long"))
        kept = segments.groupBy("anchor", "sh").agg(one.alias("chk"), F.sum("n").alias("n"), F.min("at").alias("at"), F.max("hot").alias("hot"), F.first("text").alias("text"))
        return kept.select("anchor", "sh", "chk", "n", "at.*", "hot", "text")

    at = F.struct("did", "th", "start").alias("at")
    distinct = written(classes(places.select("anchor", "sh", "chk", F.lit(1).cast("long").alias("n"), at, "hot", "text")), "distinct")
    single = F.col("hot") & (F.col("n") == 1)
    frequent = distinct.filter("hot").agg(F.sum(F.octet_length("text"))).first()[0]
    if frequent:
        cut_again = written(_thinned(distinct.filter(single), distinct.filter("hot"), units, batch_bytes, 32 * max(1, frequent // (32 * units.shard))), "thinned")
        places = places.unionByName(cut_again)
        again = cut_again.select("anchor", "sh", "chk", F.lit(1).cast("long").alias("n"), at, "hot", "text")
        first, distinct = distinct, written(classes(distinct.filter(~single).select("anchor", "sh", "chk", "n", at, "hot", "text").unionByName(again)), "distinct")
        discard(first)
    shards = max(1, int(distinct.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]) // units.shard)

    def of_shard(table: pa.Table) -> pa.Table:
        shard = _joined(table, units)
        found = list(ranges(search(shard, table), shard.first))
        own = table.select(["anchor", "sh", "n", "did", "th", "start"]).take(pa.array([r for r, _, _ in found], pa.int64()))
        return own.append_column("lo", pa.array([a for _, a, _ in found], pa.int64())).append_column("hi", pa.array([b for _, _, b in found], pa.int64()))

    dealt = distinct.select("anchor", "sh", "n", "did", "th", "start", "text").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    found = written(dealt.groupBy("shard").applyInArrow(of_shard, _FOUND), "found")
    return places.drop("text"), distinct.drop("text"), found


def removed(rows: DataFrame, ranges_: DataFrame) -> DataFrame:
    """rows with cuts: the window ranges (lo, hi) that ranges_ (did, th, lo, hi) has for them."""
    own = ranges_.groupBy("did", "th").agg(F.collect_set(F.struct("lo", "hi")).alias("cuts"))
    return rows.join(own.hint("shuffle_hash"), ["did", "th"], "left")


def covered(cuts: list[dict] | None, window: int) -> list[tuple[int, int]]:
    """The units that the windows cover, as disjoint ranges (first, end)."""
    out: list[list[int]] = []
    for a, b in sorted((c["lo"], c["hi"] + window) for c in cuts or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
