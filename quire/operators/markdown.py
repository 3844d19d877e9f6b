"""Documents as ordered blocks: headings, captions, markers, enrichment, assembly, report.

blocks: doc, pos, kind, md and what an operator names besides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions import text as T

IMAGE = r"!\[((?:\\.|[^\]\\])*)\]\((?:<([^>]+)>|([^)\s]+))\)"


def _ordered(item: Column) -> Column:
    return F.array_sort(F.collect_list(item))


def headings(lines: DataFrame, keys: list[str], styled: bool = False) -> DataFrame:
    """Adds level: the heading level of each line (keys, pos, text, bold, in_list), or null. If ``styled``, lines
    have one in ``style`` too, which decides where it is set, and those that run on after their title get ``glued``.

    A numbered line continues the numbering if its parent's number already heads a section. Which numbers do
    depends on the lines before, so a document's numbers are folded in order; texts stay out of the fold."""
    f = T.heading_features(F.col("text"), F.col("bold"), F.col("in_list"))
    x = lines.withColumn("_sure", f["sure"]).withColumn("_number", f["number"]).withColumn("_level", f["level"])
    if styled:
        own, text = F.col("style"), F.col("text")
        x = x.withColumn("_sure", F.coalesce(own, "_sure")).withColumn("_level", F.coalesce(own, "_level"))
        x = x.withColumn("_number", F.when(own.isNotNull(), T.section_number(text)).otherwise(F.col("_number")))
        bare = F.col("_sure").isNull() & F.col("_number").isNull() & ~F.col("in_list")
        x = x.withColumn("glued", F.when(bare, glued_heading(text)))
        x = x.withColumn("_level", F.coalesce(T.section_level(F.col("glued.number")), "_level")).withColumn("_number", F.coalesce("_number", "glued.number"))
    numbered = x.filter("_number IS NOT NULL").groupBy(*keys).agg(_ordered(F.struct("pos", "_number", "_sure")).alias("all"))
    state = F.struct(F.array().cast("array<string>").alias("known"), F.array().cast(f"array<{lines.schema['pos'].dataType.simpleString()}>").alias("at"))

    def step(s: Column, e: Column) -> Column:
        found = e["_sure"].isNotNull() | F.array_contains(s["known"], T.section_parent(e["_number"]))
        return F.when(found, F.struct(F.concat(s["known"], F.array(e["_number"])).alias("known"), F.concat(s["at"], F.array(e["pos"])).alias("at"))).otherwise(s)

    # a number without a point has the empty parent, which nothing is known by
    at = numbered.select(*keys, F.explode(F.aggregate("all", state, step, lambda s: s["at"])).alias("pos"), F.lit(True).alias("_yes"))
    out = x.join(at, [*keys, "pos"], "left")
    level = F.when(F.col("_number").isNotNull() & F.col("_yes"), F.col("_level")).otherwise(F.col("_sure"))
    out = out.withColumn("level", level).drop("_sure", "_number", "_level", "_yes")
    return out.withColumn("glued", F.when(F.col("level").isNotNull(), F.col("glued"))) if styled else out


def glued_heading(text: Column) -> Column:
    """struct<number, heading, body> of a section number, a title and a text run together; null if it is none.
    Holds only where the number's parent is a heading."""
    number = F.regexp_extract(text, r"(?sU)^(\d+(?:\.\d+)*)\.?\s+(.+)$", 1)
    rest = F.regexp_extract(text, r"(?sU)^(\d+(?:\.\d+)*)\.?\s+(.+)$", 2)
    form = r"(?s)^(.*?)([.!?])[\s\u00a0]+(?=[A-ZА-ЯЁ0-9])(.*)$"
    end = F.regexp_extract(rest, form, 2)
    title = F.concat(F.regexp_extract(rest, form, 1), F.when(end == ".", "").otherwise(end))
    body = T.strip(F.regexp_extract(rest, form, 3))
    heading = F.concat(number, F.lit(" "), T.strip(title))
    fine = (
        (end != "")
        & (body != "")
        & F.regexp_like(title, F.lit(r"\A\p{Lu}"))
        & (F.length(heading) <= T.MAX_HEADING)
        & ~F.regexp_like(heading, F.lit(r"[\n,:;]"))
        & (F.length(F.regexp_replace(title, r"[^\p{L}]", "")) >= 3)
    )
    return F.when(fine, F.struct(number.alias("number"), heading.alias("heading"), body.alias("body")))


def _any_caption(c: Column) -> Column:
    return F.coalesce(T.caption_kind(c), F.when(F.regexp_like(c, F.lit(r"(?iuU)\A" + T.SCHEME_CAPTION + r"\z")), "figure"))


def picture_captions(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """keys, pos, alt of every picture: a table's caption stands above it, a figure's below; a bare number takes its title along."""
    w = W.partitionBy(*keys).orderBy("pos")
    text = F.when(F.col("kind") == "block", F.col("md"))
    near = {n: F.coalesce((F.lag(text, -n) if n < 0 else F.lead(text, n)).over(w), F.lit("")) for n in (-2, -1, 1, 2)}
    x = blocks.select(*keys, "pos", "kind", *[c.alias(f"b{i}") for i, c in enumerate(near.values())]).filter("kind = 'picture'")
    before2, before, after, after2 = (F.col(f"b{i}") for i in range(4))

    def named(number: Column, title: Column) -> Column:
        plain = (title != "") & ~F.regexp_like(title, F.lit(r"\A(?:#|\||!|\$|- |1\. )"))
        bare = F.regexp_like(number, F.lit(r"(?iuU)\A(?:" + T.BARE_CAPTION + r")\z"))
        both = bare & plain & (F.length(title) <= 200) & T.caption_kind(title).isNull()
        return F.when(both, F.concat(number, F.lit(" – "), title)).otherwise(number)

    titled = (before != "") & ~F.regexp_like(before, F.lit(r"\A(?:\||!|- \*\*)"))
    alt = (
        F.when(titled & (_any_caption(before2) == "table") & _any_caption(before).isNull(), named(before2, before))
        .when(_any_caption(before) == "table", before)
        .when(_any_caption(after).isNotNull(), named(after, after2))
        .when(_any_caption(before).isNotNull(), before)
        .otherwise("image")
    )
    return x.select(*keys, "pos", alt.alias("alt"))


def media_names(pictures: DataFrame, keys: list[str], base: str) -> DataFrame:
    """Adds link: base/img-NNN.ext in order of those that have bytes; others have none. pictures: keys, pos, mime, content."""
    has = F.col("content").isNotNull()
    n = F.sum(has.cast("int")).over(W.partitionBy(*keys).orderBy("pos"))
    ext = F.lit("bin")
    for mime, e in {"image/png": "png", "image/jpeg": "jpg", "image/gif": "gif", "image/bmp": "bmp", "image/tiff": "tiff", "image/webp": "webp"}.items():
        ext = F.when(F.lower("mime") == mime, e).otherwise(ext)
    return pictures.withColumn("link", F.when(has, F.concat(F.lit(base.rstrip("/") + "/"), F.format_string("img-%03d.%s", n, ext))))


def assemble(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """keys, md: a document's blocks in order. List items follow each other on the next line, all else after a
    blank line; shapes that repeat the link before go. blocks: keys, pos, kind (block, item, shape, ...), md, link."""
    w = W.partitionBy(*keys).orderBy("pos")
    b = blocks.filter(F.col("md") != "")
    same = (F.col("kind") == "shape") & (F.lag("kind").over(w) == "shape") & F.col("link").eqNullSafe(F.lag("link").over(w))
    b = b.withColumn("_same", F.coalesce(same, F.lit(False))).filter("NOT _same")
    before = F.lag("kind").over(w)
    gap = F.when(before.isNull(), "").when((before == "item") & (F.col("kind") == "item"), "\n").otherwise("\n\n")
    b = b.withColumn("_s", F.concat(gap, "md"))
    return b.groupBy(*keys).agg(F.array_join(F.transform(_ordered(F.struct("pos", "_s")), lambda x: x["_s"]), "").alias("md"))


def fill_pages(pages: DataFrame, read: DataFrame) -> DataFrame:
    """doc, md: pages (doc, page, md, scanned) in order; a scanned one is what was read of it (doc, page, block), or says why nothing was."""
    x = pages.join(read, ["doc", "page"], "left")
    failed = F.format_string("<!-- page %d: not read -->", F.col("page"))
    x = x.withColumn("_s", F.when(F.col("scanned"), F.coalesce("block", failed)).otherwise(F.col("md")))
    return x.groupBy("doc").agg(F.array_join(F.transform(_ordered(F.struct("page", "_s")), lambda e: e["_s"]), "\n\n").alias("md"))


def merge_markers(bodies: DataFrame, parts: DataFrame) -> DataFrame:
    """doc, md: the first ``[FIGURE k]``, ``[TABLE k]`` or ``[HAND k]`` of a body (doc, body) gives way to its part
    (doc, key, ord, text), repeats and unknown ones to nothing; parts never named follow at the end."""
    form = r"\\?\[((?:FIGURE|TABLE|HAND) \d+)\\?\]"
    text = F.split("body", form)
    keys = F.concat(F.regexp_extract_all("body", F.lit(form), F.lit(1)), F.array(F.lit(None).cast("string")))
    x = bodies.select("doc", F.posexplode(F.arrays_zip(text.alias("t"), keys.alias("k"))).alias("pos", "e"))
    x = x.select("doc", "pos", F.col("e.t").alias("t"), F.col("e.k").alias("key"))
    n = F.row_number().over(W.partitionBy("doc", "key").orderBy("pos"))
    x = x.withColumn("_n", n).join(parts, ["doc", "key"], "left")
    put = F.when(F.col("_n") == 1, F.coalesce("text", F.lit(""))).otherwise("")
    named = x.select("doc", F.lit(0).alias("late"), "pos", F.concat("t", put).alias("s"))
    late = parts.join(x.select("doc", "key").filter("key IS NOT NULL"), ["doc", "key"], "left_anti").join(bodies.select("doc"), "doc", "left_semi")
    late = late.select("doc", F.lit(1).alias("late"), F.col("ord").cast("int").alias("pos"), F.concat(F.lit("\n\n"), "text").alias("s"))
    all_ = named.unionByName(late).groupBy("doc").agg(_ordered(F.struct("late", "pos", "s")).alias("x"))
    md = F.regexp_replace(F.array_join(F.transform("x", lambda e: e["s"]), ""), r"\n{3,}", "\n\n")
    return all_.select("doc", T.strip(md).alias("md"))


def image_links(docs: DataFrame) -> DataFrame:
    """doc, pos, line, nth, alt, link, stem: images of a text (doc, md), line by line."""
    lines = docs.select("doc", F.posexplode(F.split("md", "\n")).alias("pos", "line"))
    whole = F.regexp_extract_all("line", F.lit(f"({IMAGE})"), F.lit(1))
    x = lines.select("doc", "pos", "line", F.posexplode(whole).alias("nth", "m"))
    link = F.coalesce(F.nullif(F.regexp_extract("m", IMAGE, 2), F.lit("")), F.regexp_extract("m", IMAGE, 3))
    x = x.withColumn("alt", F.regexp_extract("m", IMAGE, 1)).withColumn("link", link)
    stem = F.regexp_replace(F.regexp_extract("link", r"[^/]*$", 0), r"(?<=[^.])\.[^.]*$", "")
    return x.withColumn("stem", stem).drop("m")


def to_describe(docs: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """doc, pos, anchor, stem, alt, link: each picture's first link that is local and not described yet (doc, stem);
    anchor is the line to put the description above: that of the link, or of the table around it."""
    x = image_links(docs).filter(~F.col("link").contains("://"))
    x = x.withColumn("_n", F.row_number().over(W.partitionBy("doc", "stem").orderBy("pos", "nth"))).filter("_n = 1")
    if done is not None:
        x = x.join(done, ["doc", "stem"], "left_anti")
    lines = docs.select("doc", F.posexplode(F.split("md", "\n")).alias("pos", "line"))
    w = W.partitionBy("doc").orderBy("pos")
    pipe = F.ltrim("line").startswith("|")
    lines = lines.withColumn("_g", F.col("pos") - F.sum(pipe.cast("int")).over(w)).filter(pipe)
    start = lines.withColumn("anchor", F.min("pos").over(W.partitionBy("doc", "_g"))).select("doc", "pos", "anchor")
    return x.join(start, ["doc", "pos"], "left").select("doc", "pos", F.coalesce("anchor", "pos").alias("anchor"), "stem", "alt", "link")


def insert_above(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """doc, md with blocks (doc, anchor, ord, block) above their lines, a blank line after each."""
    lines = docs.select("doc", F.posexplode(F.split("md", "\n")).alias("pos", "s"))
    all_ = lines.select("doc", "pos", F.lit(1).alias("k"), F.lit(0).alias("ord"), "s").unionByName(
        blocks.select("doc", F.col("anchor").alias("pos"), F.lit(0).alias("k"), F.col("ord").cast("int"), F.concat(F.regexp_replace("block", r"\n+$", ""), F.lit("\n")).alias("s"))
    )
    return all_.groupBy("doc").agg(F.array_join(F.transform(_ordered(F.struct("pos", "k", "ord", "s")), lambda e: e["s"]), "\n").alias("md"))


def vision_block(id_: Column, sha: Column, kind: Column, model: Column, body: Column) -> Column:
    safe = lambda c: F.replace(F.replace(c, F.lit("-->"), F.lit("–>")), F.lit('"'), F.lit("'"))
    return F.concat(
        F.lit('<!-- vision:begin id="'), safe(id_), F.lit('" sha256="'), sha, F.lit('" kind="'), kind,
        F.lit('" model="'), safe(F.coalesce(model, F.lit("-"))), F.lit('" -->\n'), body, F.lit('\n<!-- vision:end id="'), safe(id_), F.lit('" -->\n\n'),
    )


def scan_block(page: Column, sha: Column, kind: Column, source: Column, body: Column) -> Column:
    """A read scan page between its marks; a page without a heading gets one."""
    head = F.when(~F.regexp_like(body, F.lit(r"(?m)^#{1,6} ")), F.format_string("## Page %d\n\n", page)).otherwise("")
    return F.concat(
        F.format_string('<!-- pdf-scan:begin page="%d" sha256="%s" kind="%s" source="%s" -->\n\n', page, sha, kind, T.comment_safe(source)),
        head, body, F.format_string('\n\n<!-- pdf-scan:end page="%d" -->', page),
    )


def demote(md: Column, by: int = 2) -> Column:
    """Headings so many levels lower, to the sixth at most; deepest first, so that none is moved twice."""
    out = md
    for n in range(6, 0, -1):
        out = F.regexp_replace(out, rf"(?m)^#{{{n}}}(?=\s)", "#" * min(6, n + by))
    return out


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc, md: a waybill's title, requisites and item table. docs: doc, title and fields (array<struct<name, value>>);
    items: doc, row, cells (array<string>), with one header for all (array column ``columns``)."""
    shown = lambda c: F.replace(F.coalesce(c, F.lit("—")), F.lit("|"), F.lit("\\|"))
    fields = F.array_join(F.transform("fields", lambda f: F.concat(F.lit("| "), f["name"], F.lit(" | "), shown(f["value"]), F.lit(" |"))), "\n")
    top = docs.select("doc", F.concat(F.lit("# "), "title", F.lit("\n\n| Field | Value |\n|---|---|\n"), fields).alias("top"))
    line = F.concat(F.lit("| "), F.array_join(F.transform("cells", lambda c: shown(c)), " | "), F.lit(" |"))
    head = F.concat(F.lit("| "), F.array_join("columns", " | "), F.lit(" |\n|"), F.array_join(F.array_repeat(F.lit("---"), F.size("columns")), "|"), F.lit("|"))
    rows = items.withColumn("_s", line).groupBy("doc", "columns").agg(F.array_join(F.transform(_ordered(F.struct("row", "_s")), lambda e: e["_s"]), "\n").alias("rows"))
    rows = rows.select("doc", F.concat(head, F.lit("\n"), "rows").alias("rows"))
    return top.join(rows, "doc", "left").select("doc", F.concat_ws("\n\n", "top", "rows").alias("md"))
