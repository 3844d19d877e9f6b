"""Files to Markdown: the way of a document from its bytes through blocks to one text.

Text and word files go all the way here. PDF pages and images need text layers and models, whose outputs
arrive as tables (``textlayer``, ``layout``, ``answers``); older formats need a converter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources import files as S
from ..sources import ooxml
from . import markdown, numbering, tables

KEYS = ["path"]


def _once(read: DataFrame) -> DataFrame:
    """Written once to the folder of checkpoints, where the session has one: several branches read it."""
    return read.checkpoint() if read.sparkSession.sparkContext.getCheckpointDir() else read


def _numbered(paragraphs: DataFrame, lists: DataFrame) -> DataFrame:
    """paragraphs with marker: the shown number, "" for a bullet, null outside lists."""
    x = paragraphs.filter("num_id IS NOT NULL").select("path", "pos", "num_id", "ilvl").join(lists, ["path", "num_id"])
    x = x.withColumn("start", F.get("starts", F.col("ilvl"))).drop("starts")
    marks = numbering.markers(x, KEYS).withColumn("pos", F.col("pos").cast("int"))
    return paragraphs.join(marks, ["path", "pos"], "left")


def _block(text: Column, rich: Column) -> tuple[Column, Column]:
    """kind and Markdown of a paragraph: heading, title run together with its text, list item, plain."""
    mark, level, glued = F.col("marker"), F.col("level"), F.col("glued")
    signs = F.repeat(F.lit("#"), level)
    numbered = F.when(F.coalesce(mark, F.lit("")) != "", F.concat(mark, F.lit(" "), text)).otherwise(text)
    item = F.concat(F.repeat(F.lit("   "), F.col("ilvl")), T.list_bullet(mark), F.lit(" "), rich)
    is_item = level.isNull() & F.col("in_list")
    md = (
        F.when(glued.isNotNull(), F.concat(signs, F.lit(" "), glued["heading"], F.lit("\n\n"), glued["body"]))
        .when(level.isNotNull(), F.concat(signs, F.lit(" "), numbered))
        .when(is_item, item)
        .otherwise(rich)
    )
    return F.when(is_item, "item").otherwise("block"), md


def word_documents(files: DataFrame) -> DataFrame:
    """path, markdown, error of word documents (path, content): headings by style, weight and number, list numbers
    as shown, emphasis and links, tables by their kind. A file that can't be read has an error, never a failed job;
    paths are unique. A document's blocks keep their position as key."""
    read = _once(ooxml.content(files))
    found = read.select("path", F.explode("blocks").alias("b")).select("path", "b.*")
    lists = read.select("path", F.explode("lists").alias("n")).select("path", "n.*")
    shown = T.strip(T.render_scripts(T.join_runs(F.transform("runs", lambda r: T.strip(r["text"])))))
    p = found.filter("size(cells) = 0").select(
        "path", "pos", "heading", "num_id", "ilvl", T.strip(T.plain(T.join_runs(F.transform("runs", lambda r: T.strip(r["text"]))))).alias("text"),
        shown.alias("shown"), T.strip(T.render_scripts(T.rich_text(F.col("runs")))).alias("rich"),
        F.forall(F.filter("runs", lambda r: T.strip(r["text"]) != ""), lambda r: r["bold"]).alias("bold"),
    ).filter("text <> ''")
    style = F.when(F.col("heading").isNotNull() & T.caption_kind(F.col("text")).isNull(), F.least("heading", F.lit(T.MAX_LEVEL)))
    p = p.withColumn("style", style).withColumn("in_list", F.col("num_id").isNotNull() & F.col("heading").isNull())
    p = _numbered(markdown.headings(p, KEYS, styled=True), lists)
    kind, md = _block(F.col("shown"), F.col("rich"))
    parts = p.select("path", "pos", kind.alias("kind"), md.alias("md"))
    grid = found.filter("size(cells) > 0").select("path", "pos", F.explode("cells").alias("e")).select("path", "pos", "e.*")
    parts = parts.unionByName(tables.to_markdown(grid, ["path", "pos"]).select("path", "pos", F.lit("block").alias("kind"), "md"))
    out = markdown.assemble(parts.withColumn("link", F.lit(None).cast("string")), KEYS)
    text = F.when(F.col("error").isNull(), F.coalesce(F.concat(T.finalize(F.col("md")), F.lit("\n")), F.lit("")))
    return read.select("path", "error").join(out, KEYS, "left").select("path", text.alias("markdown"), "error")


def parse(files: DataFrame) -> DataFrame:
    """path, format, markdown, error of every file (path, content), by the format that its name tells. What isn't
    read here says so: a document of another kind, or an unknown one."""
    known = files.withColumn("format", S.detect_format(F.col("path")))
    word = F.col("format").isin("docx", "docm")
    done = S.text_files(known.drop("format")).unionByName(word_documents(known.filter(word)))
    other = known.filter(F.col("format").isNull() | (~word & (F.col("format") != "txt")))
    why = F.when(F.col("format").isNull(), "unsupported format").otherwise(F.concat(F.lit("outside input needed: "), F.col("format")))
    rest = other.select("path", F.lit(None).cast("string").alias("markdown"), why.alias("error"))
    return done.unionByName(rest).select("path", S.detect_format(F.col("path")).alias("format"), "markdown", "error")
