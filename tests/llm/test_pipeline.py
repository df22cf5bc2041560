"""The pipeline's stages against the operators' own results and brute force."""

import corpus_pipeline
from tapeloom.llm import decontam, near_dups, quality, toxicity
from tapeloom.llm.common import stage

from .conftest import SF, documents
from .test_pairs import linked


def test_stages(spark):
    docs = documents(spark)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    kept = []
    for name, step in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(step(spark, docs, SF), f"test-{name}")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if name == "quality":
            want = ids(quality.quality(before, labels).where("predicted = 1"))
        elif name == "toxicity":
            want = ids(toxicity.toxicity(before, labels).where("predicted = 0"))
        elif name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            want = sorted(k for k, _, c in linked(rows, 5, 80) if k == c)
            assert want == ids(near_dups.near_duplicates(before).where("kept"))
        else:
            bad = {r["doc_id"] for r in decontam.contaminated(before, benchmark).collect()}
            want = [i for i in ids(before) if i not in bad]
        assert ids(docs) == want and 0 < len(want) <= before.count()
        kept.append(len(want))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, last.collect()))
    assert {r["doc_id"] for r in last.collect()} == set(ids(docs))
    assert kept[-1] < kept[0]


def test_edges(spark, edges, nothing):
    for docs in (edges, nothing):
        for _, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, SF), "test-edges")
        docs.collect()
