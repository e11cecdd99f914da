"""Near-duplicates by MinHash with sequential Bayesian verification.

1. Texts become sets of word shingles (64-bit hashes). Texts whose sorted full sets have one cryptographic digest are one
   class from here on.
2. Class representatives get BANDS * ROWS minima; those that share a band are in one bucket. At a similarity of 0.8 a
   pair shares no band with a probability of (1 - 0.8 ** 4) ** 32 < 5e-8.
3. Each document is first paired with one other only: of the least members of its buckets, the one that it shares most
   buckets with. Pairs' signatures are compared in batches of BATCH minima; after each batch a pair is dropped if, given
   the agreements so far and a flat prior, the probability that its similarity reaches the limit is below MISS.
   Survivors are verified on their full sets.
4. Components of the verified links are taken. Buckets whose members are all in one component are done: no further
   link can change anything. In the others all pairs of members from different components are compared in the same
   sequential way, in blocks of members, and survivors are verified on full sets in the block. No pair leaves a block
   unless it links two components, and no bucket is capped.
5. Components again.

A null or empty text has an empty set, is linked with nothing and kept. Rows that share a doc_id are one document: what is
near to one of its texts is in one component with all of them.
Rows without a doc_id are linked with nothing. Repeated rows are one class. Other columns don't matter.
"""

from __future__ import annotations

from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._store import discard, written
from ._text import NOT_WHITE, U, Words, cuts, mixed, ngrams, small_batches, spread, utf8, whole_groups
from .components import components

SHINGLE, PERCENT = 5, 80
BANDS, ROWS, BATCH, MISS = 32, 4, 16, 1e-7
#: Members of a block, and shingles of all of them, about.
BLOCK, LOAD = 256, 1 << 21
#: Pairs that are compared at a time, and in a task, about; texts that a task verifies; rows of one part of a table.
PAIRS, PAIRS_A_TASK, MEMBERS_A_TASK, PART = 1 << 17, 1 << 27, 1 << 11, 1 << 16
_FACTORS = mixed(np.arange(1, BANDS * ROWS + 1, dtype=U)) | U(1)


def shingles(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (with repeats), and where each text's begin (and the end). Texts of fewer than n words have their whole sequence as one."""
    words = Words(texts, NOT_WHITE, lower=True)
    h, first = words.hashes(), words.first
    count = np.diff(first)
    own = np.maximum(count - n + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(own)])
    start = np.repeat(first[:-1] - at[:-1], own) + np.arange(at[-1])
    grams = np.concatenate([ngrams(h, n), np.zeros(min(n, len(h) + 1), U)])  # short texts at the end look beyond
    out = grams[start] if len(start) else np.empty(0, U)
    for d in np.flatnonzero((count > 0) & (count < n)):
        out[at[d]] = ngrams(h[first[d] : first[d + 1]], int(count[d]))[0]
    return out, at


def signatures(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One row of minima (32 bits each) per text; rows of texts without shingles are 0."""
    out = np.zeros((len(at) - 1, BANDS * ROWS), np.uint32)
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some):
        with np.errstate(over="ignore"):
            for i, f in enumerate(_FACTORS):
                out[some, i] = np.minimum.reduceat(x * f, at[:-1][some]) >> U(32)
    return out


def least_agreements(percent: int = PERCENT, miss: float = MISS, batch: int = BATCH, total: int = BANDS * ROWS) -> list[tuple[int, int]]:
    """(minima compared, agreements needed to go on): with m of n, P(similarity >= t) under a flat prior is P(Binomial(n + 1, t) <= m)."""
    t, out = percent / 100, []
    for n in range(batch, total + 1, batch):
        p, m = 0.0, -1
        while p < miss:
            m += 1
            p += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return out


def _alive(a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> np.ndarray:
    """Which rows of a and b (or a single row) survive every batch."""
    alive, same, done = np.arange(len(b)), np.zeros(len(b), np.int64), 0
    for n, m in steps:
        left = a[done:n] if a.ndim == 1 else a[alive, done:n]
        same = same + (left == b[alive, done:n]).sum(1)
        go = same >= m
        alive, same, done = alive[go], same[go], n
    return alive


def _sets(docs: DataFrame, n: int) -> DataFrame:
    def make(batches):
        for batch in small_batches(batches, 1 << 19):
            x, at = shingles(utf8(batch.column(1)), n)
            sig = signatures(x, at)
            size, k1, k2 = (np.zeros(len(at) - 1, t) for t in (np.int64, U, U))
            for d in range(len(at) - 1):
                own = np.unique(x[at[d] : at[d + 1]])
                size[d] = len(own)
                k1[d], k2[d] = np.frombuffer(blake2b(own.tobytes(), digest_size=16).digest(), U)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array([s.tobytes() for s in sig], pa.binary())], ["doc_id", "n_shingles", "k1", "k2", "sig"])

    return docs.mapInArrow(make, "doc_id long, n_shingles long, k1 long, k2 long, sig binary")


def _band_keys(sig: np.ndarray) -> np.ndarray:
    """A hash of each band of each signature."""
    sig = sig.reshape(-1, BANDS, ROWS).astype(U)
    key = np.tile(np.arange(1, BANDS + 1, dtype=U), (len(sig), 1))
    with np.errstate(over="ignore"):
        for r in range(ROWS):
            key = mixed(key + sig[:, :, r])
    return key


def _buckets(reps: DataFrame) -> DataFrame:
    """bucket, id and size of the set for every band of every representative."""

    def make(batches):
        for batch in batches:
            key = _band_keys(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32))
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), *(pa.array(np.repeat(batch.column(c).to_numpy(), BANDS)) for c in (0, 2))], ["bucket", "id", "size"])

    return reps.select("id", "sig", F.col("n_shingles").cast("int").alias("size")).mapInArrow(make, "bucket long, id long, size int")


def _surviving(pairs: DataFrame, reps: DataFrame, steps) -> DataFrame:
    """The pairs a, b whose signatures survive."""
    sig = reps.select("id", "sig")
    both = pairs.join(sig.withColumnRenamed("id", "a").withColumnRenamed("sig", "sa"), "a").join(sig.withColumnRenamed("id", "b").withColumnRenamed("sig", "sb"), "b").select("a", "b", "sa", "sb")

    def compare(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS) for i in (2, 3))
            take = pa.array(_alive(a, b, steps))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["a", "b"])

    return both.mapInArrow(compare, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs whose full sets have the similarity."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    own = written(texts.join(ids.hint("merge"), "id", "left_semi"), "texts")  # the same plan at every size
    both = pairs.join(own.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(own.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", F.col("tb").alias("text"))

    def verify(batches):
        for batch in small_batches(batches, 1 << 19):
            (xa, fa), (xb, fb) = shingles(utf8(batch.column(2)), n), shingles(utf8(batch.column(3)), n)
            ok = []
            for i in range(batch.num_rows):
                sa, sb = np.unique(xa[fa[i] : fa[i + 1]]), np.unique(xb[fb[i] : fb[i + 1]])
                common = len(np.intersect1d(sa, sb, assume_unique=True))
                ok.append(bool(len(sa)) and 100 * common >= percent * (len(sa) + len(sb) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], ["a", "b"])

    links = written(both.mapInArrow(verify, "a long, b long"), "links")
    discard(own)
    return links


def _cross_pairs(sig: np.ndarray, size: np.ndarray, comp: np.ndarray, part: np.ndarray, group: np.ndarray, alone: np.ndarray, bucket: np.ndarray, steps, percent: int):
    """Pairs (i, j) of rows of one group, of different components and parts (of any parts if alone), that survive and that share no band before their bucket's: a pair is met in one bucket only. Rows are sorted by group and size; sizes too far apart for the similarity are not compared."""
    end = np.searchsorted(group, group, "right")
    wide = np.int64(size.max(initial=0)) * 2 + 2
    end = np.minimum(end, np.searchsorted(group * wide + size, group * wide + np.minimum(size * 100 // percent, wide - 1), "right"))
    after = np.maximum(end - np.arange(len(end)) - 1, 0)
    bands = sig.reshape(-1, BANDS, ROWS)
    for lo, hi in cuts(after, PAIRS):
        i, j = np.repeat(np.arange(lo, hi), after[lo:hi]), spread(np.arange(lo, hi) + 1, after[lo:hi])
        ok = (comp[i] != comp[j]) & (alone[i] | (part[i] != part[j]))
        i, j = i[ok], j[ok]
        same, done = np.zeros(len(i), np.int64), 0
        for n, m in steps:
            same = same + (sig[i, done:n] == sig[j, done:n]).sum(1)
            go = same >= m
            i, j, same, done = i[go], j[go], same[go], n
        for a in range(0, len(i), PAIRS // BANDS):
            x, y = i[a : a + PAIRS // BANDS], j[a : a + PAIRS // BANDS]
            shared = (bands[x] == bands[y]).all(2).argmax(1)
            here = (_band_keys(sig[x]).view(np.int64) == bucket[x][:, None]).argmax(1)
            yield x[shared >= here], y[shared >= here]


def _involved(buckets: DataFrame, labels: DataFrame, reps: DataFrame, steps, block: int, percent: int = PERCENT) -> DataFrame:
    """bucket, p, q, part, id, component: members with a surviving pair, of buckets with members from different components. Members of a bucket's largest component need not meet each other: they are dealt to blocks of their own, and each block of the others meets these and each other one in a group. Blocks are bounded by their members and by their sets' sizes, for the texts of two are held later on. So a bucket of one large component and a few others is read about once, whatever its size."""
    member = buckets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    counts = member.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    mixed_up = counts.groupBy("bucket").agg(F.max(F.struct("n", "component", "size")).alias("main"), F.sum("n").alias("n"), F.sum("size").alias("size"), F.count("*").alias("kinds")).filter("kinds > 1")
    blocks = lambda n, size: F.greatest(F.ceil(n / block), F.ceil(size / LOAD)).cast("int")
    main = F.col("main")
    mixed_up = written(mixed_up.select("bucket", main["component"].alias("main"), blocks(main["n"], main["size"]).alias("mains"), blocks(F.col("n") - main["n"], F.col("size") - main["size"]).alias("rests"), F.col("n").alias("members")), "mixed")
    # the work is pairs, not bytes: tasks are as many as it needs
    work = mixed_up.agg(F.coalesce(F.sum(F.least(F.col("members"), F.lit(2 * block)) * F.col("members") * F.col("rests")), F.lit(0))).first()[0]
    tasks = max(buckets.sparkSession.sparkContext.defaultParallelism, int(work // PAIRS_A_TASK))
    own = F.col("component") == F.col("main")
    place = F.xxhash64("id")
    dealt = (
        member.join(mixed_up, "bucket")
        .withColumn("part", F.when(own, F.col("rests") + F.pmod(place, F.col("mains"))).otherwise(F.pmod(place, F.col("rests"))).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("rests") - 1 + F.when(own, 0).otherwise(F.col("mains")))))
        .select("bucket", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "id", "component")
        .join(reps.select("id", "n_shingles", "sig"), "id")
        .repartition(tasks, "bucket", "p", "q")
        .sortWithinPartitions("bucket", "p", "q", "n_shingles", "id")
    )

    names = ["bucket", "p", "q", "part", "id", "component"]

    def compare(batches):
        for table, group in whole_groups(batches, ["bucket", "p", "q"]):
            bucket, p, q, part, ids, comp, size = (table.column(c).to_numpy() for c in (*names, "n_shingles"))
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
            hit = np.zeros(len(ids), bool)
            for i, j in _cross_pairs(sig, size, comp, part, group, p == q, bucket, steps, percent):
                hit[i] = True
                hit[j] = True
            yield from table.select(names).filter(pa.array(hit)).to_batches()

    return dealt.mapInArrow(compare, "bucket long, p int, q int, part int, id long, component long")


def _cross_links(involved: DataFrame, texts: DataFrame, n: int, percent: int, steps) -> DataFrame:
    """Links between components, verified on full sets inside each group: once two components are known to be linked there, their other pairs are not looked at."""

    def verify(batches):
        for table, group in whole_groups(batches, ["bucket", "p", "q"], 256):
            x, at = shingles(utf8(table.column("text")), n)
            sets = [np.unique(x[at[i] : at[i + 1]]) for i in range(len(group))]
            order = np.lexsort(([len(s) for s in sets], group))
            sets, group = [sets[i] for i in order], group[order]
            size = np.array([len(s) for s in sets])
            sig = signatures(np.concatenate(sets), np.concatenate([[0], np.cumsum(size)]))
            ids, comp, part, p, q, bucket = (table.column(c).to_numpy()[order] for c in ("id", "component", "part", "p", "q", "bucket"))
            up: dict[tuple[int, int], tuple[int, int]] = {}

            def top(c: tuple[int, int], up=up) -> tuple[int, int]:
                while up.get(c, c) != c:
                    c = up[c]
                return c

            out = []
            for left, right in _cross_pairs(sig, size, comp, part, group, p == q, bucket, steps, percent):
                for i, j in zip(left.tolist(), right.tolist(), strict=True):
                    a, b = top((int(group[i]), int(comp[i]))), top((int(group[j]), int(comp[j])))
                    if a == b:
                        continue
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * common >= percent * (size[i] + size[j] - common):
                        up[a] = b
                        out.append((ids[i], ids[j]))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], pa.int64()) for k in (0, 1)], ["a", "b"])

    tasks = max(involved.sparkSession.sparkContext.defaultParallelism, involved.count() // MEMBERS_A_TASK)
    both = involved.join(texts.hint("merge"), "id").repartition(tasks, "bucket", "p", "q").sortWithinPartitions("bucket", "p", "q", "id")
    return both.mapInArrow(verify, "a long, b long")


def linked(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, miss: float = MISS, block: int = BLOCK, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs."""
    steps = least_agreements(percent, miss)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = written(_sets(rows, shingle), "sets")
    full = sets.filter("n_shingles > 0")
    classes = written(full.filter("doc_id IS NOT NULL").groupBy("k1", "k2").agg(F.min("doc_id").alias("id")), "classes")
    reps = written(sets.join(classes, (sets["doc_id"] == classes["id"]) & (sets["k1"] == classes["k1"]) & (sets["k2"] == classes["k2"])).select("id", "n_shingles", "sig").dropDuplicates(["id", "sig"]), "reps")
    texts = rows.select(F.col("doc_id").alias("id"), "text").filter("text IS NOT NULL")

    every = _buckets(reps)
    least = every.groupBy("bucket").agg(F.min("id").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    buckets = written(every.join(least, "bucket"), "buckets")
    # each document meets, of the least members of its buckets, the one that it shares most buckets with
    shared = buckets.filter("id <> least").groupBy("id", "least").agg(F.count("*").alias("n"))
    stars = shared.groupBy("id").agg(F.max_by("least", F.struct("n", -F.col("least"))).alias("a")).select("a", F.col("id").alias("b"))
    links = _verified(written(_surviving(stars, reps, steps), "pairs"), texts, shingle, percent)
    # a doc_id with several texts has several classes: they are one document
    kind = F.struct("k1", "k2", "n_shingles")
    several = written(sets.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(kind).alias("lo"), F.max(kind).alias("hi")).filter("lo <> hi").select("doc_id"), "several")
    ids = sets.filter("n_shingles > 0").join(several, "doc_id").join(classes, ["k1", "k2"]).groupBy("doc_id", "id").count()
    one = written(ids.groupBy("doc_id").agg(F.min("id").alias("one")), "one")
    links = links.union(ids.join(one, "doc_id").filter("id <> one").select(F.col("one").alias("a"), F.col("id").alias("b")))
    labels = written(components(links), "labels")

    involved = written(_involved(buckets.select("bucket", "id", "size"), labels, reps, steps, block, percent), "involved")
    discard(buckets)
    discard(reps)
    if involved.limit(1).count():
        more = written(_cross_links(involved, texts, shingle, percent, steps), "links")
        labels = written(components(links.union(more)), "labels")

    # a set that many rows have meets its class once for each part of the rows, and its rows meet that part by part
    parts = max(1, full.count() // PART) * 32
    dealt = full.select("doc_id", "n_shingles", "k1", "k2").withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(parts)))
    known = dealt.select("k1", "k2", "part").distinct().join(classes, ["k1", "k2"])
    own = dealt.join(known, ["k1", "k2", "part"], "left").select("doc_id", "n_shingles", "id")
    own = own.union(sets.filter("n_shingles = 0").join(one, "doc_id", "left").select("doc_id", "n_shingles", F.col("one").alias("id")))
    found = own.join(labels, "id", "left").select("doc_id", "n_shingles", F.coalesce("component", "id", "doc_id").alias("component_id"))
    return found.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def kept_documents(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least doc_id. Columns as in docs; of rows that share a doc_id one stays."""
    drop = linked(docs, shingle, percent).filter("NOT kept").select(F.col("doc_id").alias("_drop")).distinct()
    kept = docs.join(drop, docs["doc_id"].cast("long") == drop["_drop"], "left_anti")
    repeated = docs.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_many")).agg(F.count("*").alias("_n")).filter("_n > 1").select("_many")
    if not repeated.limit(1).count():
        return kept
    many = written(repeated, "repeated")
    once = kept.join(many, kept["doc_id"] == many["_many"], "left_semi").dropDuplicates(["doc_id"])
    return kept.join(many, kept["doc_id"] == many["_many"], "left_anti").unionByName(once)
