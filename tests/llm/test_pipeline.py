"""The pipeline against its parts in plain form."""

import corpus_pipeline
from quire.llm import bpe, quality

from . import brute


def test_pipeline(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = {r["doc_id"] for r in quality.classified(d, labels).collect() if r["score"] >= quality.THRESHOLD}
    docs = sorted((r["doc_id"], r["text"], r["source"]) for r in d.collect() if r["doc_id"] in good)
    ids = [i for i, _, _ in docs]
    groups = brute.components([brute.simhash(t) for _, t, _ in docs], ids)
    docs = [x for x, g in zip(docs, groups) if x[0] == g]
    want = {}
    for _, copies, once, _, _, rows in brute.mix([(i, s, t) for i, t, s in docs]):
        want |= {i: n for i, _, _, h in rows if (n := copies + ((i, h) in once))}
    got = corpus_pipeline.run(spark, sf).collect()
    counts = {}
    for r in got:
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    assert counts == want
    codec, texts = bpe.codec(*bpe.default_vocabulary()), {i: t for i, t, _ in docs}
    assert all(bytes(r["ids"]) == codec.encode(texts[r["doc_id"]]) for r in got)


def test_stages_keep_columns(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 4
    docs = d
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf)
        assert docs.columns == d.columns
