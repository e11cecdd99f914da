"""Long texts, clashing columns, empty and repeated rows, and what the operators promise beyond their queries' columns."""

import gzip
import io
import json
import os
import random
import time

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from tidemark.llm import _store, _text, decontamination, licenses, line_crf, near_dedup, quality_rules, secrets, substring_dedup, suffix_dedup, warc

pytest.importorskip("public_tokenizers")
MEGABYTE = 1 << 20


def _within(seconds, f):
    start = time.perf_counter()
    out = f()
    assert time.perf_counter() - start < seconds
    return out


# ---- long texts

@pytest.mark.parametrize("text", ["x" * MEGABYTE, "ab " * (MEGABYTE // 3), "a|" * (MEGABYTE // 2), " " * MEGABYTE], ids=["word", "line", "bars", "blanks"])
def test_quality_rules_are_linear(make, text):
    rows = _within(60, lambda: quality_rules.digest(make([(1, text)])).collect())
    assert rows[0]["n_words"] == len(plain.words(text)) and not rows[0]["kept"]


@pytest.mark.parametrize("piece", ["<a ", "<p ", "<title>", "<html ", "<head>", "<script>", "<!--", "</script ", "<style><head>", "<a href=\""])
def test_pages_are_read_in_linear_time(piece):
    page = (piece * (MEGABYTE // len(piece))).encode()
    _within(5, lambda: warc.derived(warc.response(1, "http://x/", page)))


def test_long_texts_of_other_operators(make, spark):
    rnd = random.Random(1)
    words = " ".join(f"w{rnd.randrange(10**6)}" for _ in range(120_000))
    docs = [(1, words), (2, words + " end"), (3, "q" * MEGABYTE)]
    near = {r["doc_id"]: r["component_id"] for r in near_dedup.linked(make(docs)).collect()}
    assert near == {1: 1, 2: 1, 3: 3}
    assert {r["doc_id"]: r["n_removed"] for r in substring_dedup.digest(make(docs)).collect()} == {1: 120_000, 2: 120_000, 3: 0}
    item = spark.createDataFrame([(5, " ".join(words.split()[1000:1030]))], "item_id long, text string")
    assert {(r["doc_id"], r["doc_word"], r["overlap"]) for r in decontamination.overlaps(make(docs), item).collect()} == {(1, 1000, 30), (2, 1000, 30)}
    assert licenses.scanned(make([(1, words + " released under the MIT License")])).first()["labels"] == "mit"
    assert all(0 <= r["score"] <= 1 for r in line_crf.scored(make(docs), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect())


# ---- quality rules

def test_phrases_are_whole_words_of_short_lines(make):
    prose = " ".join(f"word{i}" for i in range(30)) + "."
    stay = ["The team will assign in order the design in blue.", "He had to sign in.", "Our blog in town is new.", "This line is wrapped and so it has no mark\nbut the next one goes on with a small letter and ends here.", "क्या यह एक लंबा वाक्य है जिसमें दस से अधिक शब्द हैं और अंत में चिह्न है।"]
    go = ["Sign in", "Sign in to your account", "» more", "© 2020 All rights reserved", "Alle Rechte vorbehalten.", "Mentions légales", "Política de privacidad", "ten words without any mark in a line that ends Here"]
    rows = {r["doc_id"]: r for r in quality_rules.judged(make([(i, f"{prose}\n{t}") for i, t in enumerate(stay + go)])).select("doc_id", "n_bad_lines").collect()}
    assert [rows[i]["n_bad_lines"] for i in range(len(stay + go))] == [0] * len(stay) + [1] * len(go)


CLASH = "doc_id long, text string, lang string, source string, n_words int, kept string, clean_text string, spans string, n_live int, _row string, _words int, row long, _leak int, _drop int, part int, sig int"


@pytest.fixture()
def clashing(spark):
    text = " ".join(f"word{i}" for i in range(40)) + ". token = abcdefgh"
    rows = [(i, f"{text} {i}" if i else None, "en", "s", 7, "k", "c", "s", 3, "r", 1, 2, 3, 4, 5, 6) for i in range(3)]
    return spark.createDataFrame(rows, CLASH)


@pytest.mark.parametrize("operator", [quality_rules.kept_documents, near_dedup.kept_documents, secrets.redacted, lambda d: decontamination.clean_documents(d, d.sparkSession.createDataFrame([(1, "no such words here at all")], "item_id long, text string"))], ids=["quality", "near", "secrets", "leaks"])
def test_clashing_columns_pass_unchanged(clashing, operator):
    out = operator(clashing)
    assert out.columns == clashing.columns and out.dtypes == clashing.dtypes
    own = {r["doc_id"]: r.asDict() for r in clashing.collect()}
    rows = out.collect()
    assert rows and all({**r.asDict(), "text": 0} == {**own[r["doc_id"]], "text": 0} for r in rows)


@pytest.mark.parametrize("operator", [quality_rules.kept_documents, near_dedup.kept_documents, secrets.redacted, quality_rules.digest, secrets.digest, licenses.scanned, near_dedup.linked, substring_dedup.digest, suffix_dedup.digest], ids=lambda f: f"{f.__module__.split('.')[-1]}.{f.__name__}")
def test_empty_and_repeated_rows(make, operator):
    text = " ".join(f"word{i}" for i in range(40)) + "."
    assert operator(make([(1, text)]).limit(0)).count() == 0
    rows = operator(make([(1, text)] * 3)).collect()
    assert len(rows) == (1 if operator is near_dedup.kept_documents else 3) and len({str(r["doc_id"]) for r in rows}) == 1


# ---- the field

def _labelled(spark, size):
    d = f"/root/testdata/{size}"
    rows = spark.read.parquet(f"{d}/documents.parquet").join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("quality IS NOT NULL").orderBy("doc_id").select("doc_id", "quality", "text").collect()
    return [(r["text"], r["quality"]) for r in rows if len(r["text"].split("\n")) > 2]


def test_lines_of_one_document_can_differ(spark):
    rows = _labelled(spark, "sf0.1")
    fit, held = rows[::2], rows[1::2]
    x, _, first = line_crf.lines_of([t.encode() for t, _ in fit])
    field = line_crf.Field().fit(x, first, np.array([y for _, y in fit]))
    good, bad = ([t for t, y in held if y == k] for k in (1, 0))
    right = []
    for a, b in zip(good, bad, strict=False):
        n = len(line_crf.lines_of([a.encode()])[0])
        x, _, first = line_crf.lines_of([f"{a}\n{b}".encode()])
        gamma = field.marginals(x, first)[0][:, 1]
        right += [(gamma[:n] > 0.5).mean(), (gamma[n:] < 0.5).mean()]
    assert len(right) >= 10 and np.mean(right) > 0.9


def test_glued_chains_hold_every_line_once(spark):
    rows = _labelled(spark, "sf0.01")[:21] + [("", 1)]
    x, _, first = line_crf.lines_of([t.encode() for t, _ in rows])
    labels = np.array([y for _, y in rows])
    gx, gy, gfirst = line_crf.glued(x, first, labels)
    assert len(gx) == len(x) and gy.sum() == np.repeat(labels, np.diff(first)).sum() and gfirst[-1] == len(x)
    assert len(gfirst) - 1 == 10 + 3  # half of 21 alone, the others in fours
    heads = np.zeros(len(gx), bool)
    heads[gfirst[:-1]] = True
    assert (gx[:, line_crf.FEATURES.index("is_first")] == heads).all()
    own, before = ([line_crf.FEATURES.index(p + f) for f in line_crf.SEEN] for p in ("", "before_"))
    assert np.allclose(gx[1:][~heads[1:]][:, before], gx[:-1][~heads[1:]][:, own])


def test_crf_of_empty_tables(make, spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert line_crf.scored(make([(1, "x")]).limit(0), none).count() == 0


# ---- WARC files

def test_response_records_are_read(spark, tmp_path):
    page = "<html lang=de><title>Ä &amp; B</title><body><p>Größe</p><a href='/x'>x</a>".encode("latin-1")
    bodies = [(b"Content-Type: text/html; charset=iso-8859-1\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2", page), (b"Content-Type: text/html; charset=iso-8859-1\r\nContent-Encoding: gzip", gzip.compress(page)), (b"Content-Type: text/html; charset=iso-8859-1\r\nTransfer-Encoding: chunked", b"5\r\n" + page[:5] + b"\r\n%x\r\n" % (len(page) - 5) + page[5:] + b"\r\n0\r\n\r\n")]
    out = io.BytesIO()

    def member(fields, block):
        head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + f"content-length: {len(block)}\r\n\r\n"
        out.write(gzip.compress(head.encode() + block + b"\r\n\r\n"))

    member({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:0>", "WARC-Date": "2020-01-01T00:00:00Z"}, b"software: x")
    for i, (headers, body) in enumerate(bodies):
        block = b"HTTP/1.1 404 Not Found\r\n" + headers + b"\r\n\r\n" + body
        member({"warc-type": "response", "WARC-RECORD-ID": f"<urn:uuid:{i + 1}>", "WARC-Target-URI": "http://e.net/d/", "WARC-Date": f"2020-01-0{i + 1}T00:00:00Z", "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": warc.digest(body) if i else "sha1:WRONG"}, block)
    (tmp_path / "a.warc.gz").write_bytes(out.getvalue())
    made = warc.derivatives_of_files(spark, str(tmp_path))
    rows = sorted(made.collect(), key=lambda r: (r["date"], r["record_type"]))
    assert [(r["refers_to"], r["record_type"], r["date"][:10]) for r in rows] == [(f"<urn:uuid:{i}>", k, f"2020-01-0{i}") for i in (1, 2, 3) for k in ("conversion", "metadata")]
    assert all(r["content"] == "Größe\nx" for r in rows[::2])
    meta = [json.loads(r["content"]) for r in rows[1::2]]
    assert [m["envelope"]["digests_hold"] for m in meta] == [False, True, True]
    assert meta[0]["http"] == {"status": "HTTP/1.1 404 Not Found", "headers": {"Content-Type": "text/html; charset=iso-8859-1", "Set-Cookie": "a=1, b=2"}}
    assert all(m["html"] == {"title": "Ä & B", "lang": "de", "links": ["http://e.net/x"]} and m["envelope"]["warc"]["WARC-Type"] == "response" for m in meta)
    data = b"".join(bytes(r["member"]) for r in warc.members(made).collect())
    assert sorted(r["record_id"] for r in warc.from_bytes(data)) == sorted(r["record_id"] for r in rows)


def test_warc_of_empty_and_repeated_rows(spark):
    pages = spark.createDataFrame([(1, "http://e.net/", "<p>x")] * 2, "page_id long, url string, html string")
    assert warc.derivatives(pages.limit(0)).count() == 0
    rows = [tuple(r) for r in warc.derivatives(pages).collect()]
    assert len(rows) == 4 and len(set(rows)) == 2
    with pytest.raises(ValueError):
        list(warc.from_bytes(b"no record"))


# ---- licences

def test_licence_labels_and_scores_are_those_of_brute_force(make):
    rnd = random.Random(9)
    docs = []
    for k in range(120):
        label, notice, key = rnd.choice(licenses.TEMPLATES)
        words = notice.split()
        for _ in range(rnd.randrange(0, max(2, len(words) // 2))):
            words[rnd.randrange(len(words))] = rnd.choice(["other", "the", "of", "license"])
        if rnd.random() < 0.3:
            words = words[rnd.randrange(0, 4) :]
        docs.append((k, " ".join([*(f"w{rnd.randrange(50)}" for _ in range(rnd.randrange(20))), *words, "the end of the license"])))
    got = {r["doc_id"]: (r["labels"], round(r["score"], 9)) for r in licenses.scanned(make(docs)).collect()}
    assert got == {i: plain.licences(t, licenses.TEMPLATES, licenses.SCORE, licenses.BASE_SCORE) for i, t in docs}


# ---- secrets

def test_repositories_count(spark):
    rows = [(i, "token=aaaaaaaa", "o1", f"r{i}") for i in range(8)] + [(8, "token=aaaaaaaa token=bbbbbbbb", "o2", "r"), (9, "token=bbbbbbbb", "o1", "r")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, owner string, repo string")
    got = {r["doc_id"]: (r["n_live"], r["n_copied"], r["most_repos"], r["most_owners"]) for r in secrets.scanned(docs, owner=F.col("owner"), repo=F.col("repo")).collect()}
    assert got == {i: (0, 1, 9, 2) for i in range(8)} | {8: (1, 1, 9, 2), 9: (1, 0, 2, 2)}


# ---- what the operators share

def test_whole_groups():
    import pyarrow as pa

    rnd = np.random.default_rng(2)
    keys = np.sort(rnd.integers(0, 300, 5000))
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[a : a + 37]), pa.array(np.arange(a, min(a + 37, 5000)))], ["k", "i"]) for a in range(0, 5000, 37)]
    tables = list(_text.whole_groups(iter(batches), ["k"], 100))
    assert np.concatenate([t.column("i").to_numpy() for t, _ in tables]).tolist() == list(range(5000))
    seen = [set(t.column("k").to_pylist()) for t, _ in tables]
    assert sum(map(len, seen)) == len(set(keys.tolist()))  # no group is cut
    assert all(len(set(g.tolist())) == len(s) for (_, g), s in zip(tables, seen, strict=True))


def test_settings_come_back_after_the_last_writer(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with _store._writing(spark):
        with _store._writing(spark):
            assert spark.conf.get(key) == "500"
        assert spark.conf.get(key) == "500"
    assert spark.conf.get(key) == before


def test_written_tables_can_be_discarded(spark):
    table = _store.written(spark.range(3).toDF("x"), "t")
    assert table.count() == 3
    _store.discard(table)
    assert not os.path.exists(table._tidemark_path.removeprefix("file://"))


@pytest.mark.parametrize("block", [5, 40])
def test_a_large_component_beside_others_in_a_bucket(make, block):
    """Buckets whose members are mostly of one component are dealt apart; no link is lost by it."""
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    docs = []
    for k in range(90):
        words = base.copy()
        for _ in range(rnd.randrange(0, 3)):
            words[rnd.randrange(120)] = f"e{rnd.randrange(10**6)}"
        docs.append((k, " ".join(words)))
    for k in range(90, 120):  # at the edge of the similarity
        words = base.copy()
        for at in rnd.sample(range(120), rnd.randrange(2, 6)):
            words[at] = f"f{rnd.randrange(10**6)}"
        docs.append((k, " ".join(words)))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in near_dedup.linked(make(docs), 4, block=block).collect()}
    assert got == plain.near_components(docs, 4)


def test_pages_of_the_tables_are_as_a_parser_reads_them(spark):
    from urllib.parse import urljoin

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {(r["page_id"], r["record_type"]): r["content"] for r in warc.derivatives(pages).select("page_id", "record_type", "content").collect()}
    for r in pages.collect():
        page = plain.Page(r["html"])
        meta = json.loads(rows[r["page_id"], "metadata"])["html"]
        assert rows[r["page_id"], "conversion"] == page.text
        assert (meta["title"], meta["lang"]) == (None if page.title is None else " ".join(page.title.split()), page.lang)
        assert meta["links"] == [urljoin(r["url"], x) for x in page.links]
