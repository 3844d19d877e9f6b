"""Python workers outlive their tasks: what they keep from one counts in the next."""

import pyarrow as pa

from quire.llm import bpe


def test_idle_workers_keep_no_pieces(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat_ws(' ', transform(sequence(1, 200), x -> concat('w', id * 200 + x))) AS text").repartition(8)
    rows = bpe.encoded(docs)
    assert rows.selectExpr("count(*)", "min(n_tokens)").first()[0] == 400

    def kept(batches):
        c = bpe.codec(*bpe.default_vocabulary())
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(c.pieces) + len(c.older)] * b.num_rows)], ["n"])

    assert {r["n"] for r in spark.range(0, 16, 1, 8).mapInArrow(kept, "n bigint").collect()} == {0}
