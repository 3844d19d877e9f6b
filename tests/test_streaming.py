"""Streams give what the batch operators give."""

from pyspark.sql import functions as F

from quire.operators import waybill
from quire.plans.inputs import PAGES, derived
from quire.streaming import pages


def test_segmentation(spark, sf, tmp_path):
    kinds = waybill.page_kinds(derived(spark, sf, PAGES)).select(F.col("file").cast("long").alias("file"), "page", "kind", "excluded", "has_number", "has_items")
    want = {(r["file"], r["page"], r["doc"]) for r in waybill.segment(kinds).collect()}
    for n, part in enumerate(("page <= 3", "page > 3")):
        kinds.filter(part).coalesce(1).write.parquet(f"{tmp_path}/in/{n}")
        stream = spark.readStream.schema(kinds.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        pages.into_table(pages.segment_stream(stream), f"{tmp_path}/out", f"{tmp_path}/at").awaitTermination()
    got = {(r["file"], r["page"], r["doc"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == want


def test_text_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes("день\n\nночь".encode("cp1251"))
    (tmp_path / "in" / "b.pdf").write_bytes(b"%PDF")
    pages.into_table(pages.text_stream(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/at").awaitTermination()
    assert [r["markdown"] for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["день\n\nночь\n"]
