"""Every stage of the pipeline, and the whole of it, against plain versions on a table of odd rows."""

import random
import zlib

import numpy as np
import plain
import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from conftest import prose  # noqa: E402

import public_tokenizers  # noqa: E402


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rnd = random.Random(21)
    item = prose(rnd, 30, 10**6)
    text = lambda n: ".\n".join(prose(rnd, 12, 10**6) for _ in range(n)) + "."
    base = text(8)
    docs = [None, "", " \n", "short", "Home | About | Help\n" * 12, base + "\nHome | About | Contact | Help\nAll rights reserved", "z" * 50_000, "y. " * 30]
    docs += [base, base, base.replace("\n", " "), base + " end", text(6) + f"\n{item}.", text(6) + " " + " ".join("other" if i % 6 == 5 else w for i, w in enumerate(item.split())) + "."]
    docs += [f"{text(4)}\ntoken = secret{k // 4 if k < 8 else k}value and AKIAABCDEFGHIJKLMN{k:02d}." for k in range(12)]
    docs += [text(rnd.randrange(1, 40)) for _ in range(40)] + [text(900)]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, len(t or ""), i, "kept") for i, t in enumerate(docs)]
    rows += [(None, base, "en", "s1", len(base), 1, "kept"), rows[12], rows[30], (31, rows[31][1], "de", "s9", rows[31][4], 2, "x")]
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string").repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, [(1, item)]


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _kept(rows):
    """One row of each doc_id, of each component the least doc_id; rows without a doc_id stay."""
    seen = {}
    for r in rows:
        if r[0] is not None:
            seen.setdefault(r[0], r)
    found = plain.near_components([(i, r[1]) for i, r in seen.items()], 5)
    return [r for i, r in seen.items() if found[i][1] == i] + [r for r in rows if r[0] is None]


def test_every_stage_is_as_plain(spark, tables):
    folder, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    same = lambda a, b: sorted(map(str, a)) == sorted(map(str, b))
    stages = dict(corpus_pipeline.STAGES)

    before, after = _rows(docs), _rows(kept := stages["quality_rules"](spark, docs, folder))
    cleaned = [(r, plain.quality(r[1])) for r in before]
    assert same(after, [(r[0], t, r[2], r[3], len(t), *r[5:]) for r, t in cleaned if t is not None]) and 0 < len(after) < len(before)

    docs = spark.createDataFrame(after, kept.schema)
    near = _rows(stages["near_dedup"](spark, docs, folder))
    by = lambda rows: [(r[0], r[1]) for r in rows]  # noqa: E731 - of repeated rows any may stay
    assert same(by(near), by(_kept(after))) and len(near) < len(after)

    docs = spark.createDataFrame(near, kept.schema)
    clean = _rows(stages["decontamination"](spark, docs, folder))
    bad = plain.contaminated([((r[0], r[1]), r[1]) for r in near], items)
    assert len(bad) == 2 and same(clean, [r for r in near if (r[0], r[1]) not in bad])

    docs = spark.createDataFrame(clean, kept.schema)
    safe = _rows(stages["secrets"](spark, docs, folder))
    own = plain.redacted([(k, r[1], r[3], "/".join(x for x in (r[3], r[2]) if x is not None)) for k, r in enumerate(clean)])
    assert same(safe, [(r[0], own[k], r[2], r[3], len(own[k]), *r[5:]) for k, r in enumerate(clean)]) and by(safe) != by(clean)
    assert any("[access]" in r[1] and "[assign]" not in r[1] for r in safe) and any("[assign]" in r[1] for r in safe)

    docs = spark.createDataFrame(safe, kept.schema)
    _packed_as_plain(_rows_of(stages["packing"](spark, docs, folder)), safe)
    final = _rows_of(corpus_pipeline.run(spark, folder))
    assert sorted((r["doc_id"] or -1, r["piece"], r["length"], r["ids_crc32"]) for r in final) == sorted((r["doc_id"] or -1, r["piece"], r["length"], r["ids_crc32"]) for r in _rows_of(stages["packing"](spark, docs, folder)))


def _rows_of(df):
    return [r.asDict() for r in df.collect()]


def _packed_as_plain(rows, docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = []
    for r in docs:
        ids = tokenizer.encode(r[1], add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = ids[k : k + 2048]
            pieces.append((r[0], k // 2048, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(map(str, pieces)) == sorted(str((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])) for r in rows)
    room = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == room.get(r["sequence_id"], 0)
        room[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(room.values()) <= 2048
    free = []  # best fit, longest first, one by one
    for n in sorted((p[3] for p in pieces), reverse=True):
        fits = [i for i, f in enumerate(free) if f >= n]
        at = min(fits, key=lambda i: free[i]) if fits else len(free)
        free[at:] = [2048] if at == len(free) else free[at:]
        free[at] -= n
    assert len(room) <= len(free)


def test_stages_of_empty_tables(spark, tables):
    folder, _ = tables
    none = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, folder)
        assert out.count() == 0
        assert name == "packing" or out.dtypes == none.dtypes
