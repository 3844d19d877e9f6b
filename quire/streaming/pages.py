"""The batch operators over streams of arriving files and pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.text import paragraphs
from ..operators import waybill
from ..sources.files import decode_text, detect_format

_FILES = "path string, modificationTime timestamp, length long, content binary"


def text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """path, markdown, error of text files as they arrive below ``path``; stateless."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(_FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(path)
    )
    text = files.filter(detect_format(F.col("path")) == "txt").withColumn("text", decode_text(F.col("content")))
    return text.select("path", paragraphs(F.col("text")).alias("markdown"), F.when(F.col("text").isNull(), "undecodable").alias("error"))


def issue_stream(items: DataFrame) -> DataFrame:
    """doc, row, code, level of item rows as they arrive; stateless."""
    return waybill.check_items(items)


def segment_stream(pages: DataFrame) -> DataFrame:
    """file, page, doc of pages that arrive in order within a file; a file's open document is kept as state.

    pages: file long, page int, kind string, excluded boolean, has_number boolean, has_items boolean.
    The sequential rule that ``waybill.segment`` states by windows."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        doc, started = state.get if state.exists else (0, False)
        rows = pd.concat(list(frames)).sort_values("page")
        out = []
        for r in rows.itertuples():
            if r.excluded:
                out.append((key[0], r.page, None if r.kind == "other" or not doc else doc))
                continue
            front = r.kind == "front"
            if not doc or (front and started):
                doc, started = doc + 1, False
            started = bool(started or r.has_items or (front and r.has_number))
            out.append((key[0], r.page, doc))
        state.update((doc, started))
        yield pd.DataFrame(out, columns=["file", "page", "doc"]).astype({"doc": "Int64"})

    return pages.groupBy("file").applyInPandasWithState(
        run, "file long, page int, doc long", "doc int, started boolean", "append", GroupStateTimeout.NoTimeout
    )


def into_table(stream: DataFrame, path: str, checkpoint: str, batch: Callable[[DataFrame], DataFrame] = lambda d: d) -> StreamingQuery:
    """Writes each micro-batch to a folder of its own, overwriting what a failed try left: once each, whatever is retried."""

    def write(df: DataFrame, epoch: int) -> None:
        batch(df).write.mode("overwrite").parquet(f"{path}/batch={epoch}")

    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
