"""Triage of PDF pages: whether a page has a text layer worth reading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import box, cross

# Least characters, share of unreadable ones, share covered by rasters, share of invisible text.
MIN_CHARS, GARBAGE, COVERAGE, INVISIBLE = 20, 0.3, 0.5, 0.8


def features(objects: DataFrame, texts: DataFrame) -> DataFrame:
    """doc, page, chars, garbage, coverage, invisible, drawn.

    objects: doc, page, type (text, image, ...), l, b, r, t, render_mode; texts: doc, page, width, height, text.
    Raster boxes are clipped to the page and their areas summed, at most the page's."""
    page = box(F.lit(0.0), F.lit(0.0), F.col("width"), F.col("height"))
    x = texts.join(objects, ["doc", "page"], "left")
    # page space grows upwards: b is below t
    part = F.when(F.col("type") == "image", cross(box(F.col("l"), F.col("b"), F.col("r"), F.col("t")), page))
    agg = x.groupBy("doc", "page", "width", "height", "text").agg(
        F.coalesce(F.sum(part), F.lit(0.0)).alias("_a"),
        F.count_if(F.col("type") == "text").alias("_t"),
        F.count_if((F.col("type") == "text") & (F.col("render_mode") == 3)).alias("_i"),
        F.count("type").alias("_n"),
    )
    seen = F.regexp_replace("text", r"(?U)\s", "")
    n = F.length(seen)
    bad = n - F.length(F.replace(seen, F.lit("�"), F.lit("")))
    return agg.select(
        "doc",
        "page",
        n.alias("chars"),
        F.when(n > 0, bad / n).otherwise(F.lit(0.0)).alias("garbage"),
        F.least(F.lit(1.0), F.col("_a") / (F.col("width") * F.col("height"))).alias("coverage"),
        F.when(F.col("_t") > 0, F.col("_i") / F.col("_t")).otherwise(F.lit(0.0)).alias("invisible"),
        (F.col("_n") > 0).alias("drawn"),
    )


def pages(measured: DataFrame) -> DataFrame:
    """Adds kind; the first rule that holds decides. measured: chars, garbage, coverage, invisible, drawn."""
    enough = F.col("chars") >= MIN_CHARS
    kind = (
        F.when(enough & (F.col("garbage") >= GARBAGE), "full_scan")
        .when(enough & (F.col("coverage") >= COVERAGE) & (F.col("invisible") >= INVISIBLE), "hybrid")
        .when(enough, "digital")
        .when(F.col("coverage") >= COVERAGE, "full_scan")
        .when((F.col("chars") == 0) & ~F.col("drawn"), "blank")
        .otherwise("digital")
    )
    return measured.withColumn("kind", kind)


def files(triaged: DataFrame, keys: list[str], page: str) -> DataFrame:
    """keys, usable, scans, hybrids, skipped (pages without text, in order): a file's verdict."""
    skipped = F.array_sort(F.collect_list(F.when(F.col("kind").isin("full_scan", "blank"), F.col(page))))
    return triaged.groupBy(*keys).agg(
        F.bool_or(F.col("kind").isin("digital", "hybrid")).alias("usable"),
        F.count_if(F.col("kind") == "full_scan").alias("scans"),
        F.count_if(F.col("kind") == "hybrid").alias("hybrids"),
        F.array_join(F.transform(skipped, lambda p: p.cast("string")), ",").alias("skipped"),
    )


def warnings(triaged: DataFrame) -> DataFrame:
    """Rows of pages that are not plain text: keys and kind."""
    return triaged.filter("kind <> 'digital' OR (chars = 0 AND coverage = 0)")
