import numpy as np
import plain
import pytest

from tidemark.llm import near_dedup, repeats, substring_dedup, suffix_dedup
from tidemark.llm._text import MULTIPLIER, Words, mixed, ngrams, sliding_min
from tidemark.llm.components import components
from tidemark.llm.fm_index import FMIndex
from tidemark.llm.suffix_array import permuted_prefixes, suffix_array


def test_kernels():
    rng = np.random.default_rng(0)
    h = rng.integers(0, 2**63, 200).astype(np.uint64)
    one = lambda x: sum(int(v) * pow(int(MULTIPLIER), k, 2**64) for k, v in enumerate(x)) % 2**64
    g = ngrams(h, 35)
    assert all(g[i] == mixed(np.array([one(h[i : i + 35])], np.uint64))[0] for i in range(len(g)))
    assert (sliding_min(h, 13) == [h[i : i + 13].min() for i in range(188)]).all()
    w = Words([b"a bb  a", b"", b"bb ccc"])
    assert [w.word(i) for i in range(len(w))] == [b"a", b"bb", b"a", b"bb", b"ccc"] and w.first.tolist() == [0, 3, 3, 5]
    assert w.hashes()[0] == w.hashes()[2] and w.hashes(1)[4] == w.hashes()[4]


def test_fm_index():
    rng = np.random.default_rng(1)
    for _ in range(30):
        parts = [rng.integers(0, rng.integers(1, 6), rng.integers(1, 30)) for _ in range(rng.integers(1, 12))]
        weight, longest = rng.integers(1, 3, len(parts)), int(rng.integers(2, 12))
        x, first = np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        got = FMIndex(x, first, weight, longest).matching_statistics(x, first)
        places = lambda p: sum(int(weight[k]) * sum(q[i : i + len(p)].tolist() == p for i in range(len(q) - len(p) + 1)) for k, q in enumerate(parts))
        for k, p in enumerate(parts):
            for i in range(len(p)):
                m = 0
                while i + m < len(p) and places(p[i : i + m + 1].tolist()) >= 2:
                    m += 1
                assert got[first[k] + i] == m if m < longest else got[first[k] + i] >= longest


def test_suffix_array():
    rng = np.random.default_rng(1)
    for trial in range(200):
        n = int(rng.integers(0, 300))
        x = rng.integers(1, rng.integers(2, 300), n)
        if trial % 3 == 0 and n > 5:
            x = np.tile(x[: int(rng.integers(1, 6))], 60)[:n]
        t = np.append(x, 0)
        sa = suffix_array(t)
        rows = t.tolist()
        assert sa.tolist() == sorted(range(len(rows)), key=lambda i: rows[i:])
        p = permuted_prefixes(t, sa)
        for a, b in zip(sa[:-1].tolist(), sa[1:].tolist(), strict=True):
            m = 0
            while a + m < len(rows) and b + m < len(rows) and rows[a + m] == rows[b + m]:
                m += 1
            assert p[b] == m


@pytest.mark.parametrize("frequent", [64, 2])
def test_substring_dedup(make, small_docs, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    docs = [*small_docs, small_docs[60], (None, small_docs[61][1])]  # a repeated row, and one without an id
    got = sorted((tuple(r) for r in substring_dedup.digest(make(docs)).collect()), key=str)
    assert got == plain.substring_dedup(docs)


@pytest.mark.parametrize("frequent", [64, 2])
def test_suffix_dedup(make, small_docs, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    docs = [d for d in small_docs if d[0] % 3 or d[0] < 15] + [(None, small_docs[61][1])]
    got = sorted((tuple(r) for r in suffix_dedup.digest(make(docs)).collect()), key=str)
    assert got == plain.suffix_dedup(docs)


def test_suffix_dedup_of_repeated_rows(make, small_docs):
    row = small_docs[61]
    got = suffix_dedup.digest(make([row, row, (1000, row[1])])).collect()
    # neither of the equal rows is earlier; the later document loses all
    assert sorted((r["doc_id"], r["n_removed"] == 0, r["n_removed"] == r["n_bytes"]) for r in got) == [(row[0], True, False)] * 2 + [(1000, False, True)]


def test_texts_are_returned(make):
    text = " ".join(f"v{i}" for i in range(50))
    got = {r["doc_id"]: r["kept_text"] for r in substring_dedup.deduplicated(make([(1, text + " tail"), (2, text), (3, "free\tword")])).collect()}
    assert got == {1: "tail", 2: "", 3: "free word"}
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.deduplicated(make([(1, text), (2, "head " + text)])).collect()}
    assert kept == {1: text.encode(), 2: b"head "}


@pytest.mark.parametrize("n", [4, 5])
def test_near_dedup(make, small_docs, n):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.linked(make(small_docs), n, block=7).collect()}
    assert got == plain.near_components(small_docs, n)


def test_near_dedup_edges(make, spark):
    text = " ".join(f"v{i}" for i in range(50))
    got = sorted((tuple(r) for r in near_dedup.linked(make([(5, text), (5, text), (None, text), (9, text + " end"), (7, None)])).collect()), key=str)
    assert got == sorted([(5, 46, 5, True), (5, 46, 5, True), (None, 46, None, True), (9, 47, 5, False), (7, 0, 7, True)], key=str)
    kept = near_dedup.kept_documents(make([(5, text), (5, text), (None, text), (9, text + " end"), (7, None)]))
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [5, 7, None]
    assert near_dedup.linked(make([(1, "x")]).limit(0)).count() == 0


def test_near_dedup_of_a_doc_id_with_several_texts(make):
    a, b, c = (" ".join(f"{x}{i}" for i in range(50)) for x in "abc")
    docs = [(1, a), (5, a), (5, b), (5, ""), (9, b + " end"), (3, b + " more"), (20, c), (20, ""), (21, c + " end")]
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in near_dedup.linked(make(docs)).collect())
    assert got == sorted((i, 1 if i < 10 else 20, i in (1, 20)) for i, _ in docs)
    kept = sorted((r["doc_id"], r["text"]) for r in near_dedup.kept_documents(make(docs[:-3])).collect())
    assert kept == [(1, a)]
    apart = near_dedup.kept_documents(make([(1, a), (5, b), (5, c), (9, c + " end")])).collect()
    assert sorted(r["doc_id"] for r in apart) == [1, 5]


def test_band_and_batch_thresholds():
    steps = near_dedup.least_agreements()
    assert [n for n, _ in steps] == list(range(16, 129, 16)) and steps[-1][1] < 0.8 * 128
    rng = np.random.default_rng(3)
    sig = (rng.random((2000, 128)) < 0.8).astype(np.uint32)  # pairs at the limit
    assert len(near_dedup._alive(np.ones(128, np.uint32), sig, steps)) == 2000


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200), (200, 150), (300, 300)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 150: 100, 200: 100}


def test_empty_tables(make):
    none = make([(1, "x")]).limit(0)
    assert substring_dedup.digest(none).count() == 0 and suffix_dedup.digest(none).count() == 0
