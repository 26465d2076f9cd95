"""The registered corpus queries against DuckDB, and the pipeline against its own stages by brute force."""

import pytest

from wordloom import llm


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_same_rows(name, same_rows):
    same_rows(llm.queries()[name], llm.oracle_sql()[name])


def test_pipeline(spark, data):
    import corpus_pipeline
    from wordloom.llm import quality

    from test_operators import base_spans, contaminated_by_force, ids, pieces_hold, similar_by_force

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    good = {r["doc_id"] for r in quality.quality_rules(spark.read.parquet(f"{data}/documents.parquet")).where("kept").collect()}
    kept = similar_by_force([(d, docs[d]) for d in sorted(good)])
    dirty = {x[0] for x in contaminated_by_force([(d, docs[d]) for d in kept], items) if x[5]}
    want = set(kept) - dirty
    rows = corpus_pipeline.run(spark, data).collect()
    assert {r["doc_id"] for r in rows} == want
    clean = {d: docs[d] for d in want if not base_spans(docs[d])}
    own = {d: ids(t) + [1] for d, t in clean.items()}
    assert pieces_hold(rows, own) == 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_near_dedup", "decontamination", "pii", "packing"]
