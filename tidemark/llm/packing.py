"""Best-fit packing planned over a histogram of lengths.

1. Every text becomes token ids and one closing id; longer ones are cut into pieces of `capacity` tokens. The pieces
   (without ids) are written once.
2. The histogram of piece lengths (at most `capacity` rows, whatever the corpus) is packed on the driver by best fit
   in falling order, over counts: a step puts pieces of one length into all the open sequences with one and the same
   space left.
3. A piece's rank within its length picks its slot: ranks are counted per (bucket, length) and raised by the
   counts of the buckets before, so that a length that a third of all pieces have is no single task.

A null or empty text is the closing id alone. Each row is packed, repeated ones too. Other columns don't matter.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._store import written
from ._text import LOWER, Words, small_batches, utf8

CAPACITY, CLOSING = 2048, 0
#: Pieces to a bucket, about; buckets bound the tasks that rank.
BUCKET = 50_000
#: Parts of words that a worker remembers the ids of; when full it begins anew.
REMEMBERED = 1 << 20


#: Kinds of bytes: 0 white, 1 letter, 2 digit, 3 mark, 4 first byte of U+00C0..U+00FF, 5 a following byte, 6 anything else.
_KIND = np.full(256, 6, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[0x30:0x3A] = 2
_KIND[[b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) not in "'<"]] = 3
_KIND[0xC3], _KIND[0x80:0xC0] = 4, 5


class Tokens(Words):
    """The parts that the tokenizer splits words into: runs of letters, single digits, runs of marks. A word with
    anything that this doesn't cover (apostrophes, "<", characters beyond U+00FF, controls) is one part, odd."""

    def __init__(self, texts: list[bytes]):
        super().__init__(texts)
        raw, before = self.buf, np.roll(self.buf, 1)
        kind = _KIND[raw]
        second = (kind == 5) & (before == 0xC3) & (raw != 0x97) & (raw != 0xB7)
        lead = (kind == 4) & np.roll(second, -1)
        bad = np.cumsum((kind >= 4) & ~second & ~lead, dtype=np.int64)
        kind[second | lead] = 1
        odd = bad[self.ends - 1] - bad[self.starts] + (kind[self.starts] >= 4) > 0
        cover = np.zeros(len(raw) + 1, np.int8)
        cover[self.starts[odd]] += 1
        cover[self.ends[odd]] -= 1
        inside = np.cumsum(cover[:-1], dtype=np.int8).view(bool)
        low = LOWER[raw]
        low[second & (raw <= 0x9E)] += 0x20
        self.buf = np.where(inside, raw, low)
        kind[inside] = 7
        last = np.roll(kind, 1)
        last[0] = 0
        begins = (kind != 0) & ((kind != last) | (kind == 2))
        edge = np.flatnonzero(begins | ((kind == 0) & (last != 0)))
        is_start = begins[edge]
        self.starts = edge[is_start]
        self.ends = edge[np.flatnonzero(is_start) + 1]
        self.odd = kind[self.starts] == 7
        self.first = np.searchsorted(self.starts, self.at)


def _byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable ones themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    shifted = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


class Encoder:
    """Ids of texts by the tokenizer of word_bpe_49k.json: lower case, split as Tokens has it, each part by itself. Each
    distinct part is tokenized once and remembered; odd words go through the whole tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self._forget()

    def _forget(self) -> None:
        self.h = np.empty(0, np.uint64)
        self.at, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def _one(self, part: bytes, odd: bool) -> list[int]:
        if odd:
            return self.tokenizer.encode(part.decode("utf-8", "replace"), add_special_tokens=False).ids
        text = part.decode() if part.isascii() else "".join([self.letters[b] for b in part])
        return [t.id for t in self.tokenizer.model.tokenize(text)]

    def _learn(self, hashes: np.ndarray, parts: list[tuple[bytes, bool]]) -> None:
        got = [self._one(*p) for p in parts]
        n = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter((i for x in got for i in x), np.uint32, int(n.sum()))
        order = np.argsort(hashes)
        place = np.searchsorted(self.h, hashes[order])
        self.h = np.insert(self.h, place, hashes[order])
        self.at = np.insert(self.at, place, (len(self.ids) + np.cumsum(n) - n)[order])
        self.n = np.insert(self.n, place, n[order])
        self.ids = np.concatenate([self.ids, ids])

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        parts = Tokens(texts)
        if not len(parts):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        back, h = pd.factorize(parts.hashes())
        k = np.searchsorted(self.h, h)
        new = np.flatnonzero(self.h[np.minimum(k, len(self.h) - 1)] != h) if len(self.h) else np.arange(len(h))
        if len(new):
            if len(self.h) + len(new) > REMEMBERED:
                self._forget()
                new = np.arange(len(h))
            place = np.empty(len(h), np.int64)
            place[back[::-1]] = np.arange(len(back))[::-1]
            self._learn(h[new], [(parts.word(i), bool(parts.odd[i])) for i in place[new].tolist()])
            k = np.searchsorted(self.h, h)
        n, at = self.n[k][back], self.at[k][back]
        ends = np.cumsum(n)
        ids = self.ids[np.repeat(at - ends + n, n) + np.arange(int(ends[-1]))]
        return ids, np.diff(np.concatenate([[0], ends])[parts.first])


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, closing: int = CLOSING, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""

    def cut(batches):
        if tokenizer not in _encoders:
            _encoders[tokenizer] = Encoder(tokenizer)
        encode = _encoders[tokenizer]
        for batch in small_batches(batches):
            ids, n = encode(utf8(batch.column(1)))
            rows, piece, start, length, crc = [], [], [], [], []
            at = 0
            for row, k in enumerate(n.tolist()):
                own = np.append(ids[at : at + k], closing).astype("<u4")
                at += k
                for p, s in enumerate(range(0, k + 1, capacity)):
                    part = own[s : s + capacity]
                    rows.append(row), piece.append(p), start.append(s), length.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.selectExpr(f"CAST({doc_id} AS long) AS doc_id", f"{text} AS text").mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit in falling order over counts. Rows (length, rank from, rank to, first sequence, pieces to a sequence,
    offset): the piece of rank r goes to sequence first + (r - from) div k, at offset + length * ((r - from) mod k)."""
    out, sequences = [], 0
    open_: dict[int, list[tuple[int, int]]] = {}  # space left: runs of sequences (first, count)
    spaces: list[int] = []  # heap of spaces that may be open

    def add(space: int, first: int, count: int) -> None:
        if space and count:
            if space not in open_:
                open_[space] = []
            open_[space].append((first, count))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        spaces = sorted(s for s, runs in open_.items() if runs and s >= length)
        heapq.heapify(spaces)
        while left:
            while spaces and not open_.get(spaces[0]):
                heapq.heappop(spaces)
            if spaces:
                space = spaces[0]
                first, count = open_[space].pop()
            else:
                space, first, count = capacity, sequences, math_ceil(left, capacity // length)
                sequences += count
            k = space // length
            full = min(count, left // k)
            if full:
                out.append((length, rank, rank + full * k, first, k, capacity - space))
                rank, left = rank + full * k, left - full * k
                add(space - k * length, first, full)
                if 0 < space - k * length >= length:
                    heapq.heappush(spaces, space - k * length)
            if full < count and left:  # one more that isn't filled up
                out.append((length, rank, rank + left, first + full, left, capacity - space))
                rest = space - left * length
                add(rest, first + full, 1)
                add(space, first + full + 1, count - full - 1)
                rank, left = rank + left, 0
            elif full < count:
                add(space, first + full, count - full)
    return out


def math_ceil(a: int, b: int) -> int:
    return -(-a // b)


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, closing: int = CLOSING, text: str = "text", doc_id: str = "doc_id", bucket: int = BUCKET) -> DataFrame:
    """The pieces with sequence_id and offset."""
    spark = docs.sparkSession
    cut = written(pieces(docs, tokenizer, capacity, closing, text, doc_id).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    slots = plan(counts, capacity)
    slots_df = spark.createDataFrame(slots or [(0, 0, 0, 0, 1, 0)], "_length long, _from long, _to long, _first long, _k long, _offset long")
    buckets = max(1, sum(counts.values()) // bucket)
    cut = cut.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))
    before = (
        cut.groupBy("length", "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .drop("_n")
    )
    ranked = cut.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_row")) - 1).join(before, ["length", "_bucket"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    # the plan is bounded by the lengths (a few rows each), not by the corpus
    step = F.col("_rank") - F.col("_from")
    return ranked.join(F.broadcast(slots_df), (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to"))).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("_first") + F.floor(step / F.col("_k"))).cast("long").alias("sequence_id"), (F.col("_offset") + F.col("length") * (step % F.col("_k"))).cast("long").alias("offset")
    )
