"""The pipeline's stages on a small table: order, columns, decisions and whole results."""
import collections

import corpus_pipeline as C
from hourwise.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in C.STAGES] == ["quality", "exact_dedup", "near_dedup", "secret_scan", "packing"]
    docs = documents(spark, SF)
    columns, seen = docs.columns, [docs.count()]
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    for name, stage in C.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = docs.cache()
        seen.append(docs.count())
        if name == "quality":
            assert good <= {r.doc_id for r in docs.collect()}
    assert seen[0] > seen[1] > seen[2] > seen[3] == seen[4]
    assert not [r for r in docs.collect() if 'token = "' in r.text]
    pieces = C.STAGES[-1][1](spark, docs, SF).collect()
    tokens = collections.Counter()
    for p in pieces:
        tokens[p.doc_id] += p.length
    assert set(tokens) == {r.doc_id for r in docs.collect()}
    assert all(tokens[p.doc_id] == p.doc_tokens for p in pieces)
