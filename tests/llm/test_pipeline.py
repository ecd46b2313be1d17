from __future__ import annotations


import corpus_pipeline
from texmend.llm import shards


def test_stages_keep_columns_and_decide(spark, docs, texts, tmp_path):
    spark.createDataFrame([(1, texts[81][1])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    at, ids = docs, None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        path = f"{tmp_path}/stage{k}"
        stage(spark, at, str(tmp_path)).write.parquet(path)
        at = spark.read.parquet(path)
        assert at.columns == docs.columns
        before, ids = ids, {r.doc_id for r in at.select("doc_id").collect()}
        assert before is None or ids <= before
    assert 81 not in ids and 84 not in ids and 61 not in ids and 86 not in ids
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = shards.expected([(r.doc_id, r.text) for r in at.select("doc_id", "text").collect()])
    assert sorted((str(r.doc_id), r.seq, r.n_tokens, r.ids_sha256) for r in out) == sorted((str(i), *x) for i, *x in want)
    assert sorted(r.slot for r in out) == list(range(len(want)))


def test_near_duplicates_at_five_words_and_80_percent(spark, empty):
    """Four spread changes in 200 words: 0.8148 of five-word shingles are shared, 0.8498 of four-word ones; a fifth change is one too many."""
    base = [f"w{k}" for k in range(200)]
    changed = lambda n, mark: " ".join(mark if k in [20 + 30 * x for x in range(n)] else w for k, w in enumerate(base))
    rows = [(1, " ".join(base)), (2, changed(4, "x")), (3, changed(5, "y"))]
    docs = spark.createDataFrame([(i, t, "en", "s0", len(t)) for i, t in rows], empty.schema)
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()) == [1, 3]
