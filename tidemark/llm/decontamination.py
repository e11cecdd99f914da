"""Benchmark decontamination by spaced seeds.

Words are lower-cased runs of letters and digits (as in licences). A document is contaminated by an item if, on one
diagonal, a stretch of min(min_words, the item's words) words or more has min_share of its words equal, substitutions
counted. A stretch begins and ends on a word that agrees or at an end of the item.

A mask looks at some of the words it spans and ignores the others. An item's masks (masks_for) are a run of up to RUN
words, and every placement of the allowed substitutions that leaves no such run; each acceptable stretch holds one of
them in full, so none is missed. The hashes of all masks at all positions of the benchmark items are the test side, a
written table. Training texts give the hashes of the same masks at all of their positions, and the two sides are joined:

1. A bitmap of the test hashes, of a fixed size, lets training hashes through that may be there. It is all that tasks
   hold of the test side; with very many items it lets more through, and the join decides.
2. What is left of the training side is joined to the test side by hash. A frequent hash is joined once for each part of
   the training texts and met by their hits there, so that no task gets all hits of a popular seed.
3. A hit gives an item and a diagonal; each diagonal is verified once, word by word, for its longest stretch, where the
   item's words and the text have come together.

Null and empty texts and items match nothing. Repeated rows are compared one by one, and an item that is there twice is
reported under each of its ids. Of several stretches of one pair the longest counts, then the one with more equal words,
then the first in the document. Long texts are one row of one batch. Only doc_id, text, item_id are read.
"""

from __future__ import annotations

from functools import cache
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import written
from ._text import ALNUM, U, Words, cuts, mixed, small_batches, spread, utf8

RUN = 4
MIN_WORDS, MIN_SHARE = 13, 0.8
#: Test hashes that the bitmap has BITS bits for each of.
MOST_SEEDS, BITS = 2_000_000, 16
#: Hits to a part, about.
PART = 1 << 16
#: Hits, and words compared, that are held at a time.
MOST_HITS, MOST_COMPARED = 1 << 19, 1 << 22
EPS = 1e-9


@cache
def masks_for(words: int, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE) -> tuple[str, ...]:
    """Masks (1 is looked at) of which each acceptable stretch of an item of so many words holds one.

    L words with s substitutions have a run of (L - s) / (s + 1) words or more. For a run of min_share / (1 - min_share)
    words or less, only stretches of up to (run - 1) / (1 - min_share) words can do without it; their placements are tried.
    """
    least, lost = min(words, min_words), 1 - min_share
    run = min(RUN, least, max(1, int(min_share / lost + EPS)) if lost > EPS else RUN)
    out = {"1" * run}
    for n in range(least, min(words, int((run - 1) / lost + EPS) if lost > EPS else 0) + 1):
        for places in combinations(range(n), int(lost * n + EPS)):
            mask = "".join("0" if i in places else "1" for i in range(n))
            if "1" * run not in mask:
                out.add(mask.strip("0"))
    return tuple(sorted(out))


def _seeds(h: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the looked-at words at each position."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return h[:0]
    out = np.full(n, U(1))
    with np.errstate(over="ignore"):
        for i, c in enumerate(mask):
            if c == "1":
                out = out * U(0x9E3779B97F4A7C55) + h[i : i + n]
    return mixed(out)


class Seeds:
    """Items' words in one array and, for a side that is held as a whole, for each mask sorted hashes with item and position."""

    def __init__(self, items: list[tuple[int, np.ndarray]], min_words: int, min_share: float, masks: bool = True):
        self.ids = [i for i, _ in items]
        self.words = np.concatenate([np.empty(0, U), *[w for _, w in items]])
        self.sizes = np.array([len(w) for _, w in items], np.int64)
        self.begin = np.cumsum(self.sizes) - self.sizes
        found: dict[str, list] = {}
        for k, (_, w) in enumerate(items if masks else ()):
            for mask in masks_for(len(w), min_words, min_share):
                s = _seeds(w, mask)
                found.setdefault(mask, []).append((s, np.full(len(s), k), np.arange(len(s))))
        self.masks = {}
        for mask, parts in found.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(h, kind="stable")
            self.masks[mask] = h[order], item[order], at[order]


def stretch(same: np.ndarray, from_start: bool, to_end: bool, share: float) -> tuple[int, int, int]:
    """The longest stretch with `share` of its words agreeing, as (first, end, agreeing words): it begins and ends on a word that agrees, or at an end if that is the item's."""
    p = np.concatenate([[0], np.cumsum(same)])
    level = p - share * np.arange(len(p))
    begins, ends = same.copy(), same.copy()
    begins[0] |= from_start
    ends[-1] |= to_end
    least = np.minimum.accumulate(np.where(begins, level[:-1], np.inf))
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(-least, -(level[end] + EPS), "left")
    n, good = end - first, p[end] - p[np.minimum(first, end)]
    if not len(n):
        return 0, 0, 0
    k = np.lexsort((first, -good, -n))[0]
    return int(first[k]), int(end[k]), int(good[k])


def _diagonals(s: Seeds, h: np.ndarray, first: np.ndarray):
    """(document, item, where the item's word 0 falls in h) of the hits, in arrays; each once a mask and chunk."""
    wide = len(h) + int(s.sizes.max(initial=0)) + 1
    for mask, (hashes, item, pos) in s.masks.items():
        t = _seeds(h, mask)
        lo = np.searchsorted(hashes, t, "left")
        at = np.flatnonzero(hashes[np.minimum(lo, len(hashes) - 1)] == t)
        doc = np.searchsorted(first, at, "right") - 1
        inside = at + len(mask) <= first[doc + 1]
        at, doc = at[inside], doc[inside]
        n = np.searchsorted(hashes, t[at], "right") - lo[at]
        for a, b in cuts(n, MOST_HITS):
            j = spread(lo[at[a:b]], n[a:b])
            start = np.repeat(at[a:b], n[a:b]) - pos[j] + wide - len(h) - 1
            key = np.unique((np.repeat(doc[a:b], n[a:b]) * len(s.ids) + item[j]) * wide + start)
            yield key // wide // len(s.ids), key // wide % len(s.ids), key % wide - (wide - len(h) - 1)


def _compared(s: Seeds, h: np.ndarray, first: np.ndarray, diagonals, min_words: int, share: float) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """For (document, item) on some of the diagonals: words, agreeing words, -word of the document, -word of the item of the longest stretch."""
    best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for doc, item, start in diagonals:
        lo = np.maximum(0, first[doc] - start)
        n = np.minimum(s.sizes[item], first[doc + 1] - start) - lo
        least = np.minimum(s.sizes[item], min_words)
        for a, b in cuts(n, MOST_COMPARED):
            same = h[spread(start[a:b] + lo[a:b], n[a:b])] == s.words[spread(s.begin[item[a:b]] + lo[a:b], n[a:b])]
            at = np.cumsum(n[a:b]) - n[a:b]
            for i in np.flatnonzero(np.add.reduceat(same, at, dtype=np.int64) >= share * least[a:b] - EPS).tolist():
                d, k, x = int(doc[a + i]), int(item[a + i]), int(lo[a + i])
                here = same[at[i] : at[i] + n[a + i]]
                f, e, good = stretch(here, x == 0, x + len(here) == s.sizes[k], share)
                if e - f >= least[a + i]:
                    best[d, k] = max(best.get((d, k), (0,)), (e - f, good, -(int(start[a + i] - first[d]) + x + f), -(x + f)))
    return best


def _verified(s: Seeds, h: np.ndarray, first: np.ndarray, min_words: int, share: float) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """_compared() of all diagonals that the seeds hit."""
    return _compared(s, h, first, _diagonals(s, h, first), min_words, share)


def overlaps(docs: DataFrame, benchmark: DataFrame, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE, most_seeds: int = MOST_SEEDS, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, item_id, overlap (words of the longest verified stretch), matched (of them equal), doc_word, item_word (where it starts): one row per row of docs and item that overlap."""
    rows = docs.selectExpr(f"CAST({doc_id} AS long) AS doc_id", f"{text} AS text")
    return _found(rows, "long", benchmark, min_words, min_share, most_seeds, item_id, item_text)


def _items(benchmark: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """item_no, item_id, n, words (their hashes as bytes) of every item with words."""

    def words_of(batches):
        for batch in small_batches(batches):
            words = Words(utf8(batch.column(1)), ALNUM, lower=True)
            h, first = words.hashes(), words.first
            some = np.flatnonzero(np.diff(first))
            parts = [h[first[i] : first[i + 1]].tobytes() for i in some]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some)), pa.array(np.diff(first)[some]), pa.array(parts, pa.binary())], ["item_id", "n", "words"])

    found = benchmark.selectExpr(f"CAST({item_id} AS long) AS item_id", f"{item_text} AS text").mapInArrow(words_of, "item_id long, n long, words binary")
    return written(found.withColumn("item_no", F.monotonically_increasing_id()), "items")


def _marked(mask: str) -> np.uint64:
    """Tells the hashes of masks apart."""
    return U(int.from_bytes(blake2b(mask.encode(), digest_size=8).digest(), "little"))


def _found(rows: DataFrame, kind: str, benchmark: DataFrame, min_words: int = MIN_WORDS, min_share: float = MIN_SHARE, most_seeds: int = MOST_SEEDS, item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """overlaps() of rows with doc_id, of any kind, and text."""
    spark = rows.sparkSession
    items = _items(benchmark, item_id, item_text)

    def test_side(batches):
        for batch in batches:
            h, no, pos = [np.empty(0, U)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for k, n, words in zip(*(batch.column(c).to_pylist() for c in ("item_no", "n", "words")), strict=True):
                for mask in masks_for(n, min_words, min_share):
                    s = mixed(_seeds(np.frombuffer(words, U), mask) ^ _marked(mask))
                    h.append(s), no.append(np.full(len(s), k)), pos.append(np.arange(len(s)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h).view(np.int64)), pa.array(np.concatenate(no)), pa.array(np.concatenate(pos))], ["h", "item_no", "pos"])

    seeds = written(items.select("item_no", "n", "words").mapInArrow(test_side, "h long, item_no long, pos long"), "seeds")
    # masks depend on an item's words up to a length only, so there are few different ones
    longest = max(min_words, int((RUN - 1) / (1 - min_share) + EPS) if min_share < 1 - EPS else 0)
    lengths = [r[0] for r in items.select(F.least("n", F.lit(longest))).distinct().collect()]
    masks = sorted({m for n in lengths for m in masks_for(n, min_words, min_share)})

    bits = 1 << max(15, (BITS * most_seeds - 1).bit_length())
    bit = F.pmod("h", F.lit(bits)) + 1
    bitmap = np.zeros(bits // 8, np.uint8)
    for at, part in seeds.groupBy(F.bitmap_bucket_number(bit)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit))).toLocalIterator():
        bitmap[(at - 1) * 4096 : at * 4096] = np.frombuffer(part, np.uint8)
    shared = spark.sparkContext.broadcast(bitmap)  # bits / 8 bytes, whatever the benchmark's size

    def training_side(batches):
        known = shared.value
        for batch in small_batches(batches):
            words = Words(utf8(batch.column(1)), ALNUM, lower=True)
            h, first = words.hashes(), words.first
            hs, ats = [np.empty(0, U)], [np.empty(0, np.int64)]
            for mask in masks:
                s = mixed(_seeds(h, mask) ^ _marked(mask))
                b = (s.view(np.int64) % bits).astype(np.int64)
                at = np.flatnonzero((known[b >> 3] >> (b & 7).astype(np.uint8)) & 1)
                at = at[at + len(mask) <= first[np.searchsorted(first, at, "right")]]
                hs.append(s[at]), ats.append(at)
            at = np.concatenate(ats)
            doc = np.searchsorted(first, at, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), batch.column(0).take(pa.array(doc)), pa.array(at - first[doc])], ["h", "th", "at"])

    own = rows.withColumn("th", F.xxhash64("text"))
    hits = written(own.select("th", "text").mapInArrow(training_side, "h long, th long, at long").distinct(), "hits")
    parts = max(1, hits.count() // PART) * 32
    part = F.pmod(F.xxhash64("th"), F.lit(parts)).alias("part")
    dealt = hits.select("h", part, "th", "at")
    needed = dealt.select("h", "part").distinct().join(seeds, "h")
    diagonals = dealt.join(needed, ["h", "part"]).groupBy("th", "part", "item_no").agg(F.collect_set(F.col("at") - F.col("pos")).alias("starts"))
    wanted = diagonals.select("item_no", "part").distinct().join(items.drop("n"), "item_no")
    of_text = diagonals.join(wanted, ["item_no", "part"]).groupBy("th").agg(F.collect_list(F.struct("item_no", "item_id", "words", "starts")).alias("items"))
    of_text = written(of_text, "diagonals")
    # a text that very many rows have meets its diagonals once for each part of the rows
    parts = max(1, rows.count() // PART) * 32
    placed = own.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    known = placed.select("th", "part").distinct().join(of_text, "th")
    both = placed.join(known.hint("shuffle_hash"), ["th", "part"]).select("doc_id", "text", "items")
    out = f"doc_id {kind}, item_id long, overlap long, matched long, doc_word long, item_word long"
    names = [c.split()[0] for c in out.split(", ")]

    def verify(batches):
        for batch in small_batches(batches):
            words = Words(utf8(batch.column(1)), ALNUM, lower=True)
            h, first = words.hashes(), words.first
            side: dict[int, tuple[int, np.ndarray]] = {}
            place: dict[int, int] = {}
            docs, nos, starts = [], [], []
            for d, found in enumerate(batch.column(2).to_pylist()):
                for i in found:
                    k = place.setdefault(i["item_no"], len(place))
                    side[k] = (i["item_id"], np.frombuffer(i["words"], U))
                    docs += [d] * len(i["starts"])
                    nos += [k] * len(i["starts"])
                    starts += i["starts"]
            s = Seeds([side[k] for k in range(len(side))], min_words, min_share, masks=False)
            doc = np.array(docs, np.int64)
            best = _compared(s, h, first, [(doc, np.array(nos, np.int64), np.array(starts, np.int64) + first[doc])], min_words, min_share)
            rows = sorted(best)
            vals = [best[r] for r in rows]
            ids = batch.column(0).take(pa.array([d for d, _ in rows], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([s.ids[k] for _, k in rows], pa.int64()), *[pa.array([abs(v[i]) for v in vals], pa.int64()) for i in range(4)]], names)

    return both.mapInArrow(verify, out)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that no item overlaps, nor another row of their doc_id. Rows without a doc_id are told apart by their text."""
    number, body = docs[doc_id].cast("long"), docs[text]
    key = F.when(number.isNotNull(), F.concat(F.lit("id "), number.cast("string"))).otherwise(F.concat(F.lit("text "), F.sha2(F.coalesce(body, F.lit("")).cast("binary"), 256)))
    leaks = _found(docs.select(key.alias("doc_id"), body.alias("text")), "string", benchmark, **options).select(F.col("doc_id").alias("_leak")).distinct()
    return docs.join(leaks, key == leaks["_leak"], "left_anti")
