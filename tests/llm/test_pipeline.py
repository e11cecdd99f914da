"""The pipeline against its stages' plain versions, on the smallest tables."""

import plain
import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        docs = stage(spark, docs, data)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = docs.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(after) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
        gone = set(before) - set(after)
        if name == "near_dedup":
            found = plain.near_components(list(before.items()), 5)
            assert gone == {i for i, (_, c) in found.items() if c != i}
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
            assert gone >= {i for i, _ in plain.leaks(list(before.items()), items)} and len(gone) < len(before) / 2
        elif name == "secrets":
            assert not gone
            changed = [i for i in after if after[i] != before[i]]
            assert all("[" in after[i] for i in changed)
    final = corpus_pipeline.run(spark, data)
    assert {r["doc_id"] for r in final.select("doc_id").distinct().collect()} == set(after)
