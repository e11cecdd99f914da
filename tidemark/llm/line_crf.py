"""Document quality from a linear-chain conditional random field over lines.

Each line with a word is a position of the chain, labelled good or bad. A position sees features of its own line and
of its neighbours. The field is fitted by gradient ascent on the likelihood of labelled documents, whose labels hold for
their lines; half of them are glued into chains of GLUED documents, so that good lines are seen beside bad ones and a
document can be good in parts. Forward-backward marginals, weighted by the lines' lengths, give the document's score.

Fitting takes at most about `sample` labelled rows, chosen by a hash of doc_id; it and scoring read whole texts, of any
length (a text's lines are held at once). Only the text is an input of a score. A text without words (null and empty ones
too) has score 0. Rows are scored one by one. Labels that are null don't count; with two labels for a doc_id the
higher one holds. Without any labels all texts with words have score 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._text import NOT_WHITE, U, Words, byte_set, mixed, small_batches, spread, utf8

SAMPLE, HELD_OUT, THRESHOLD, GLUED = 6000, 2, 0.7, 4
_UPPER = byte_set(bytes(range(0x41, 0x5B)))
_DIGIT = byte_set(b"0123456789")
_SYMBOL = byte_set(b"#*$%&|<>{}[]\\^~_=+@/")
_MARK = byte_set(b"!?;:.,\"'()-")
_SHOUT = byte_set(b"!?")
_END = byte_set(b".!?:;\"')")
OWN = ["bias", "words", "upper", "digit", "symbol", "mark", "shout", "no_end", "word_length", "repeat", "repeat2", "known_line"]
SEEN = ["upper", "symbol", "shout", "repeat", "repeat2", "known_line", "no_end"]
FEATURES = [*OWN, *(f"before_{x}" for x in SEEN), *(f"after_{x}" for x in SEEN), "is_first", "is_last"]


def lines_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line with a word, each line's length, and for each text the number of its first line (and the end)."""
    words = Words(texts, NOT_WHITE)
    buf, n = words.buf, len(words)
    if not n:
        return np.empty((0, len(FEATURES))), np.empty(0), np.zeros(len(texts) + 1, np.int64)
    h, doc = words.hashes(), words.of_word()
    breaks = np.cumsum(buf == 10, dtype=np.int64)[words.starts]  # which \n-line, over all texts
    new = np.ones(n, bool)
    new[1:] = (breaks[1:] != breaks[:-1]) | (doc[1:] != doc[:-1])
    head = np.flatnonzero(new)  # first word of each line
    count = np.diff(np.append(head, n))
    of_doc = doc[head]
    lo, hi = words.starts[head], words.ends[np.append(head[1:], n) - 1]
    size = hi - lo
    cut = np.ravel(np.column_stack([lo, hi]))  # hi of the last line is inside the buffer, which ends on a space

    def share(members: np.ndarray) -> np.ndarray:
        return np.add.reduceat(members[buf], cut, dtype=np.int64)[::2] / size

    line = np.repeat(np.arange(len(head)), count)
    same = np.zeros((2, n))
    for k in (1, 2):
        same[k - 1, k:] = (h[k:] == h[:-k]) & (line[k:] == line[:-k])
    with np.errstate(over="ignore"):
        whole = np.add.reduceat(mixed(h + (np.arange(n) - head[line]).astype(U) * U(0x9E3779B97F4A7C55)), head)
    order = np.lexsort((np.arange(len(head)), whole, of_doc))
    known = np.zeros(len(head))
    known[order[1:]] = (whole[order[1:]] == whole[order[:-1]]) & (of_doc[order[1:]] == of_doc[order[:-1]])
    own = np.column_stack(
        [
            np.ones(len(head)),
            np.log1p(count) / 4,
            share(_UPPER),
            share(_DIGIT) * 4,
            share(_SYMBOL) * 4,
            share(_MARK) * 4,
            share(_SHOUT) * 8,
            ~_END[buf[hi - 1]],
            size / count / 10,
            np.add.reduceat(same[0], head) / count,
            np.add.reduceat(same[1], head) / count,
            known,
        ]
    )
    first = np.searchsorted(of_doc, np.arange(len(texts) + 1))
    is_first, is_last = np.zeros(len(head)), np.zeros(len(head))
    some = first[:-1][np.diff(first) > 0]
    is_first[some] = 1
    is_last[np.append(some[1:], len(head)) - 1] = 1
    seen = own[:, [OWN.index(x) for x in SEEN]]
    before, after = np.roll(seen, 1, 0), np.roll(seen, -1, 0)
    before[is_first == 1] = 0
    after[is_last == 1] = 0
    return np.column_stack([own, before, after, is_first, is_last]), size.astype(float), first


def glued(x: np.ndarray, first: np.ndarray, labels: np.ndarray, most: int = GLUED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, label of each line, and bounds of chains made of the documents in a random order: the first half stand alone, the others are put together by `most`. Where two meet, their lines are neighbours."""
    n = np.diff(first)
    some = np.flatnonzero(n)
    order = np.random.default_rng(0).permutation(some)
    n = n[order]
    x, y = x[spread(first[:-1][order], n)], np.repeat(labels[order], n)
    begin = np.cumsum(n) - n
    at = np.arange(len(order))
    inner = (at >= len(order) // 2) & ((at - len(order) // 2) % most != 0)
    b = begin[inner]
    own = [FEATURES.index(f) for f in SEEN]
    x[np.ix_(b, [FEATURES.index(f"before_{f}") for f in SEEN])] = x[np.ix_(b - 1, own)]
    x[np.ix_(b - 1, [FEATURES.index(f"after_{f}") for f in SEEN])] = x[np.ix_(b, own)]
    x[b, FEATURES.index("is_first")] = x[b - 1, FEATURES.index("is_last")] = 0
    return x, y, np.append(begin[~inner], len(x))


class Field:
    """Two states, bad and good: weights of the good state's features, transition scores, scores of the first state."""

    def __init__(self, width: int = len(FEATURES)):
        self.w, self.trans, self.start = np.zeros(width), np.zeros((2, 2)), np.zeros(2)

    def marginals(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Marginals of each position, expected transitions, and log Z; chains run from first[i] to first[i + 1]."""
        lens = np.diff(first)
        order = np.argsort(-lens, kind="stable")
        begin, lens = first[:-1][order], lens[order]
        s = x @ self.w
        top = np.maximum(s, 0)
        e = np.column_stack([np.exp(-top), np.exp(s - top)])
        a, b = np.exp(self.trans - self.trans.max()), np.exp(self.start - self.start.max())
        alpha, beta, scale = np.zeros_like(e), np.ones_like(e), np.ones(len(e))
        steps = int(lens[0]) if len(lens) else 0
        active = [int(np.searchsorted(-lens, -t, "left")) for t in range(steps)]  # chains longer than t
        for t in range(steps):
            at = begin[: active[t]] + t
            v = (b if t == 0 else alpha[at - 1] @ a) * e[at]
            scale[at] = v.sum(1)
            alpha[at] = v / scale[at, None]
        pairs = np.zeros((2, 2))
        for t in range(steps - 1, 0, -1):
            at = begin[: active[t]] + t
            right = e[at] * beta[at] / scale[at, None]
            beta[at - 1] = right @ a.T
            pairs += a * (alpha[at - 1].T @ right)
        gamma = alpha * beta
        log_z = float(np.log(scale).sum() + top.sum() + max(0, (len(x) - int((lens > 0).sum()))) * self.trans.max() + int((lens > 0).sum()) * self.start.max())
        return gamma, pairs, log_z

    def fit(self, x: np.ndarray, first: np.ndarray, labels: np.ndarray, rounds: int = 150, rate: float = 0.1, penalty: float = 1e-3) -> Field:
        """labels: of the documents, whose lines run from first[i] to first[i + 1]."""
        x, states, first = glued(x, first, labels)
        y, heads = states.astype(float), states[first[:-1]]
        follows = np.ones(len(y), bool)
        follows[first[:-1]] = False
        step = states[:-1][follows[1:]] * 2 + states[1:][follows[1:]]
        seen = np.bincount(step, minlength=4).reshape(2, 2).astype(float)
        began = np.array([(heads == 0).sum(), (heads == 1).sum()], float)
        theta = np.zeros(len(self.w) + 6)
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        for k in range(1, rounds + 1):
            gamma, pairs, _ = self.marginals(x, first)
            g = np.concatenate([x.T @ (y - gamma[:, 1]), (seen - pairs).ravel(), began - gamma[first[:-1]].sum(0)]) / max(1, len(x)) - penalty * theta
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            theta = theta + rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
            self.w, self.trans, self.start = theta[: len(self.w)], theta[len(self.w) : -2].reshape(2, 2), theta[-2:]
        return self

    def scores(self, texts: list[bytes]) -> np.ndarray:
        x, size, first = lines_of(texts)
        out = np.zeros(len(texts))
        if len(x):
            gamma = self.marginals(x, first)[0][:, 1]
            some = np.diff(first) > 0
            at = first[:-1][some]
            out[some] = np.add.reduceat(gamma * size, at) / np.add.reduceat(size, at)
        return np.clip(out, 0, 1)


def held_out(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == HELD_OUT


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Field:
    """The field of a sample of labelled rows that aren't held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").filter(F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    n = known.count()
    parts = 1 << 20
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < max(1, min(parts, parts * sample // max(1, n)))).groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").cast("int").alias("label"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < max(1, min(parts, parts * sample // max(1, n))))
    joined = rows.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).select("doc_id", "label", "text")  # about `sample` rows

    def features(batches):
        for batch in small_batches(batches):
            x, _, first = lines_of(utf8(batch.column(2)))
            lines = [x[a:b].astype(np.float32).tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lines, pa.binary())], ["doc_id", "label", "x"])

    got = sorted((r["doc_id"], r["label"], bytes(r["x"])) for r in joined.mapInArrow(features, "doc_id long, label int, x binary").toLocalIterator())
    xs = [np.frombuffer(x, np.float32).reshape(-1, len(FEATURES)).astype(float) for _, _, x in got]
    field = Field()
    if xs and sum(map(len, xs)):
        field.fit(np.concatenate(xs), np.concatenate([[0], np.cumsum([len(x) for x in xs])]), np.array([r[1] for r in got]))
    return field


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs."""
    field = fitted(docs, labels, sample)

    def score(batches):
        for batch in small_batches(batches):
            s = field.scores(utf8(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text").mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")
