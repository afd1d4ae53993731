"""The stages of the pipeline, each over what the one before kept."""

import corpus_pipeline
from tests.llm.conftest import DATA
from tests.llm.test_contracts import plain_counts, plain_fingerprint, plain_spans


def test_stages_and_their_decisions(spark, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = stage(spark, docs, DATA)
        after = {r["doc_id"]: r for r in docs.collect()}
        assert docs.columns == documents.columns and set(after) <= set(before)
        kept[name] = before, after
    for r in kept["quality_rules"][1].values():
        counts = plain_counts(r["text"])
        assert counts[0] >= 20 and 100 * counts[4] <= 30 * counts[0]
    before, after = kept["near_duplicates"]
    prints = {d: plain_fingerprint(r["text"]) for d, r in before.items()}
    left = sorted(after)
    assert all((prints[a] ^ prints[b]).bit_count() > 3 for i, a in enumerate(left) for b in left[:i])
    assert all(any((prints[d] ^ prints[a]).bit_count() <= 3 for a in before if a != d) for d in set(before) - set(after))
    before, after = kept["secret_scan"]
    assert set(before) == set(after) and not any(plain_spans(r["text"]) for r in after.values())
    pieces = corpus_pipeline.run(spark, DATA).collect()
    assert {r["doc_id"] for r in pieces} == set(after)


def test_stages_take_odd_rows(spark, odd):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA)
        assert docs.columns == odd.columns
    corpus_pipeline.STAGES[-1][1](spark, docs, DATA).count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), DATA).count() == 0
