"""The pipeline's stages on planted cases."""

from __future__ import annotations

import random

import pyarrow.parquet as pq

import corpus_pipeline


def test_stages(spark, tmp_path):
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()
    rng = random.Random(1)
    items = pq.read_table("/root/testdata/sf0.01/benchmark.parquet").to_pylist()
    docs = table[:300]
    last = max(r["doc_id"] for r in table)
    copy = docs[5] | {"doc_id": last + 1}
    leak = docs[7] | {"doc_id": last + 2, "text": " ".join(rng.sample(docs[7]["text"].split(), 30)) + " " + items[0]["text"]}
    junk = [docs[9] | {"doc_id": last + 3, "text": None}, docs[9] | {"doc_id": last + 4, "text": "12 34 !?"}]
    spark.createDataFrame([*docs, copy, leak, *junk], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, seen = corpus_pipeline.common.table(spark, str(tmp_path), "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        now = corpus_pipeline.common.cut(stage(spark, now, str(tmp_path)), name)
        seen.append({r.doc_id for r in now.select("doc_id").collect()})
        if k + 1 < len(corpus_pipeline.STAGES):
            assert now.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {last + 3, last + 4}.isdisjoint(seen[0]) and len(seen[0]) >= 300
    assert last + 1 not in seen[1] and docs[5]["doc_id"] in seen[1] | {r["doc_id"] for r in docs[:5]}
    assert seen[2] == seen[1] and last + 2 in seen[2] and last + 2 not in seen[3] and seen[4] == seen[3]
    assert {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == seen[4]


def test_repeated_rows_and_empty_tables(spark, tmp_path):
    """Repeated rows and null ids go through every stage; without rows, or without a benchmark, so does nothing."""
    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pylist()[:60]
    odd = [docs[3]] * 5 + [docs[4] | {"doc_id": None}] * 3 + [docs[5] | {"lang": None}]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, rows, items in (("full", docs + odd, []), ("empty", [], [{"item_id": 1, "text": "some item to find"}])):
        folder = tmp_path / name
        spark.createDataFrame(rows, schema).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        out = [r.doc_id for r in corpus_pipeline.run(spark, str(folder)).collect()]
        assert len(out) == len(set(out)) and set(out) <= {r["doc_id"] for r in rows} and (name == "empty" or len(out) > 30)
