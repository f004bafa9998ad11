"""The pipeline's near duplicates have a similarity of 80 % or more."""

import brute

import corpus_pipeline as pipeline


def test_stage_takes_80_percent(spark, make_docs):
    base = [f"w{i}" for i in range(100)]
    docs = [(1, " ".join(base)), (2, " ".join([*base[:90], *(f"x{i}" for i in range(10))]))]  # 86 of 106 shingles
    docs += [(3, " ".join(f"v{i}" for i in range(100))), (4, " ".join([*(f"v{i}" for i in range(88)), *(f"y{i}" for i in range(12))]))]  # 84 of 108
    kept = {r.doc_id for r in pipeline.near_dedup(spark, make_docs(docs), "").collect()}
    assert kept == {i for i, (_, c) in brute.groups(docs, 80).items() if i == c} == {1, 3, 4}
    assert {i for i, (_, c) in brute.groups(docs, 85).items() if i == c} == {1, 2, 3, 4}
