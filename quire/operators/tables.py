"""Table structure: grids of cells to Markdown, and Markdown or HTML table text.

cells: keys, r, c, key (which merged cell it belongs to), lines array<string>, bold, h_cont, v_cont.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions.text import collapse, is_numeric, strip

# Sizes, and stems of words that head columns.
SHORT_CELL, HEADER_ROWS = 40, 3
HEADER_STEMS = (
    "атрибут", "вариант", "действи", "значени", "единиц", "команд", "комментари", "критери",
    "метод", "наименовани", "названи", "назначени", "описани", "определени", "опци", "параметр",
    "показател", "поле", "пояснени", "пример", "примечани", "результат", "свойств", "содержани",
    "термин", "требовани", "тип", "формул", "функци", "характеристик", "что", "как", "зачем",
    "name", "value", "description", "type", "parameter", "option", "example", "field",
)


def with_text(cells: DataFrame) -> DataFrame:
    return cells.withColumn("text", F.array_join("lines", " ")).withColumn("empty", F.size("lines") == 0)


def drop_empty(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Without rows of empty cells, then without columns that hold nothing of their own; r and c are renumbered from 0.

    Cells are dealt by table once; windows, aggregates and joins within tables keep to that."""
    x = with_text(cells.repartition(*keys))
    x = x.withColumn("_e", F.bool_and("empty").over(W.partitionBy(*keys, "r"))).filter("NOT _e")
    x = x.withColumn("_e", F.bool_and(F.col("empty") | F.col("h_cont")).over(W.partitionBy(*keys, "c"))).filter("NOT _e")
    rank = lambda c: (F.dense_rank().over(W.partitionBy(*keys).orderBy(c)) - 1).cast("int")
    return x.withColumn("_r", rank("r")).withColumn("_c", rank("c")).withColumn("r", F.col("_r")).withColumn("c", F.col("_c")).drop("_e", "_r", "_c")


def header_like(text: Column) -> Column:
    t = F.lower(text)
    stems = F.regexp_like(t, F.lit(r"(?U)\b(?:" + "|".join(HEADER_STEMS) + ")"))
    return F.length(t).between(1, SHORT_CELL) & ~F.regexp_like(t, F.lit(r"(?U)\d|:$")) & stems


def kinds(grid: DataFrame, keys: list[str]) -> DataFrame:
    """keys, kind: layout, key_value or grid for each table of ``drop_empty``'s result.

    All features are aggregates: by row first, then by table."""
    first = F.row_number().over(W.partitionBy(*keys, "key").orderBy("r", "c")) == 1
    g = grid.withColumn("origin", first)
    text = F.col("text")
    rows = g.groupBy(*keys, "r").agg(
        F.count(F.lit(1)).alias("cols"),
        F.count_distinct("key").alias("own"),
        F.bool_and((F.size("lines") == 1) & (F.length(text) <= SHORT_CELL)).alias("short"),
        F.bool_and(~F.col("empty")).alias("full"),
        F.bool_and(header_like(text)).alias("words"),
        F.count_if(~F.col("empty")).alias("filled"),
        F.count_if(~F.col("empty") & F.col("bold")).alias("bold"),
        F.count_if(~F.col("empty") & ~F.col("h_cont")).alias("labels"),
        F.count_if(~F.col("empty") & ~F.col("h_cont") & text.endswith(":")).alias("colons"),
        F.count_if(F.col("origin")).alias("origins"),
        F.count_if(F.col("origin") & F.col("empty")).alias("blank"),
        F.bool_or(F.col("origin") & text.contains("___")).alias("rule"),
        F.max(F.when(F.col("c") == 0, text)).alias("left"),
        F.max(F.when(F.col("c") == 1, text)).alias("right"),
    )
    rows = rows.withColumn("wide", (F.col("cols") > 1) & (F.col("own") == 1))
    # the first row that is no full-width section, for the header tests of pairs
    pair = W.partitionBy(*keys).orderBy("wide", "r")
    rows = rows.withColumn("_p", F.row_number().over(pair)).withColumn("head", (F.col("_p") == 1) & ~F.col("wide"))
    top, left, right, narrow = F.col("r") == 0, F.col("left"), F.col("right"), ~F.col("wide")
    has_left, has_right = narrow & (left != ""), narrow & (right != "")
    t = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("cols").alias("cols"),
        F.bool_or(top & F.col("short")).alias("top_short"),
        F.bool_or(top & F.col("full")).alias("top_full"),
        F.bool_or("rule").alias("rule"),
        F.max(F.when(top, F.col("labels"))).alias("labels"),
        F.max(F.when(top, F.col("colons"))).alias("colons"),
        F.sum("origins").alias("origins"),
        F.sum("blank").alias("blank"),
        F.count_if(narrow).alias("pairs"),
        F.bool_or(F.col("head") & F.col("words")).alias("by_words"),
        F.bool_or(F.col("head") & (F.col("filled") > 0) & (F.col("filled") == F.col("bold"))).alias("head_bold"),
        F.sum(F.when(narrow & ~F.col("head"), F.col("filled"))).alias("body"),
        F.sum(F.when(narrow & ~F.col("head"), F.col("bold"))).alias("body_bold"),
        F.count_if(has_left).alias("lefts"),
        F.max(F.when(has_left, F.length(left))).alias("longest"),
        F.sum(F.when(has_left, F.length(left))).alias("chars"),
        F.count_if(has_left & is_numeric(left)).alias("numeric"),
        F.count_distinct(F.when(has_left, left)).alias("unique"),
        F.count_if(has_right).alias("rights"),
        F.count_if(has_right & right.endswith(":")).alias("right_colons"),
    )
    signature = (F.col("n") <= 4) & (F.col("rule") | ((F.col("labels") >= 2) & (F.col("colons") == F.col("labels"))))
    layout = (
        F.when(F.col("cols") == 1, True)
        .when(F.col("n") == 1, ~((F.col("cols") >= 3) & F.col("top_short")))
        .when(signature, True)
        .when((F.col("cols") >= 3) & F.col("top_full"), False)
        .otherwise(2 * F.col("blank") >= F.col("origins"))
    )
    by_bold = F.col("head_bold") & (F.coalesce("body", F.lit(0)) > 0) & (F.col("body_bold") < F.col("body"))
    key_value = (
        (F.col("cols") == 2)
        & (F.col("n") >= 2)
        & (F.col("pairs") >= 2)
        & ~by_bold
        & ~F.col("by_words")
        & (F.col("lefts") > 0)
        & (10 * F.col("lefts") >= 8 * F.col("pairs"))
        & (F.col("longest") <= 80)
        & (F.col("chars") <= 40 * F.col("lefts"))
        & (2 * F.col("numeric") < F.col("lefts"))
        & (2 * F.col("right_colons") < F.greatest(F.lit(1), F.col("rights")))
        & (10 * F.col("unique") >= 8 * F.col("lefts"))
    )
    kind = F.when(layout, "layout").when(F.coalesce(key_value, F.lit(False)), "key_value").otherwise("grid")
    return t.select(*keys, kind.alias("kind"), signature.alias("signature"))


def _rows(grid: DataFrame, keys: list[str]) -> DataFrame:
    """keys, rows: a table as one row, an array of its rows with what heads are told by and their cells."""
    cell = W.partitionBy(*keys, "key")
    row = W.partitionBy(*keys, "r")
    g = grid.withColumn("_wide", (F.count(F.lit(1)).over(row) > 1) & (F.min("key").over(row) == F.max("key").over(row)))
    over = F.max("c").over(cell) > F.min("c").over(cell)
    need = F.max("r").over(cell) + 1 + (over & ~F.col("_wide")).cast("int")
    origin = ~F.col("empty") & (F.col("r") == F.min("r").over(cell))
    g = g.withColumn("_need", F.when(origin, need))
    shown = F.when(F.col("h_cont"), "").otherwise(F.array_join("lines", "<br>"))
    full = ~F.col("empty")
    rows = g.groupBy(*keys, "r").agg(
        F.max("_need").alias("need"),
        F.count_if(full).alias("filled"),
        F.count_if(full & F.col("bold")).alias("bold"),
        F.count_if(full & is_numeric(F.col("text"))).alias("numeric"),
        F.bool_and("_wide").alias("wide"),
        F.array_sort(F.collect_list(F.struct("c", "text", shown.alias("shown")))).alias("cells"),
    )
    item = F.struct("r", "need", "filled", "bold", "numeric", "wide", "cells")
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("rows"))


def _with_depth(t: DataFrame) -> DataFrame:
    """How many rows head a table. Merged cells that reach below the head so far draw it down,
    groups over several columns one row more; that settles within ``HEADER_ROWS`` steps."""
    rows, n = F.col("rows"), F.size("rows")
    first, body = rows[0], F.slice("rows", 2, 1_000_000)
    total = lambda name: F.aggregate(F.transform(body, lambda x: x[name]), F.lit(0).cast("long"), lambda a, x: a + x)
    all_bold = (first["filled"] > 0) & (first["bold"] == first["filled"])
    t = t.withColumn("_bold", all_bold & (total("filled") > 0) & (total("bold") < total("filled")))
    data = ~F.col("_bold") & (first["filled"] > 0) & (2 * first["numeric"] >= first["filled"])
    # rows come in order, so one walk meets every cell that the head has reached by then
    reach = F.aggregate("rows", F.lit(1), lambda a, x: F.when((x["r"] < a) & (x["need"] > a), x["need"]).otherwise(a))
    t = t.withColumn("_d", reach)
    bold_row = lambda i: (F.get(rows, i)["filled"] > 0) & (F.get(rows, i)["bold"] == F.get(rows, i)["filled"])
    more = F.aggregate(
        F.sequence(F.lit(1), F.lit(HEADER_ROWS - 1)),
        F.col("_d"),
        lambda a, _: F.when(F.col("_bold") & (a < F.least(F.lit(HEADER_ROWS), n)) & F.coalesce(bold_row(a), F.lit(False)), a + 1).otherwise(a),
    )
    return t.withColumn("depth", F.when(n == 1, 1).when(data, 0).otherwise(F.least(more, F.lit(HEADER_ROWS), n - 1))).drop("_bold", "_d")


def header_depth(grid: DataFrame, keys: list[str]) -> DataFrame:
    """keys, depth of every table."""
    return _with_depth(_rows(grid, keys)).select(*keys, "depth")


def _pipe(c: Column) -> Column:
    return F.replace(c, F.lit("|"), F.lit("\\|"))


def _line(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(F.transform(cells, _pipe), " | "), F.lit(" |"))


def render_grid(grid: DataFrame, keys: list[str]) -> DataFrame:
    """keys, md: tables with a head, in the pipe form. Head rows are joined per column without repeats,
    full-width rows are bold, repeats of the head in the body go."""
    t = _with_depth(_rows(grid, keys))
    top = F.slice("rows", F.lit(1), F.col("depth"))
    none = F.array().cast("array<string>")

    def name(i: Column) -> Column:
        texts = F.filter(F.transform(top, lambda r: r["cells"][i]["text"]), lambda x: x != "")
        kept = F.aggregate(texts, none, lambda a, x: F.when((F.size(a) > 0) & (F.element_at(a, -1) == x), a).otherwise(F.concat(a, F.array(x))))
        return F.array_join(kept, " / ")

    t = t.withColumn("head", F.transform(F.sequence(F.lit(0), F.size(F.col("rows")[0]["cells"]) - 1), name))

    def line(r: Column) -> Column:
        bold = F.concat(F.array(F.concat(F.lit("**"), r["cells"][0]["text"], F.lit("**"))), F.array_repeat(F.lit(""), F.size(r["cells"]) - 1))
        own = F.when(F.transform(r["cells"], lambda e: e["text"]) != F.col("head"), _line(F.transform(r["cells"], lambda e: e["shown"])))
        return F.when(r["wide"], _line(bold)).otherwise(own)

    body = F.array_compact(F.transform(F.slice("rows", F.col("depth") + 1, F.size("rows")), line))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), F.size("head")), "|"), F.lit("|"))
    return t.select(*keys, F.array_join(F.concat(F.array(_line(F.col("head")), rule), body), "\n").alias("md"))


def render_key_value(grid: DataFrame, keys: list[str]) -> DataFrame:
    """keys, md: pairs as a list, parted by bold full-width rows."""
    rows = grid.groupBy(*keys, "r").agg(
        F.max(F.when(F.col("c") == 0, F.col("text"))).alias("k"),
        F.max(F.when(F.col("c") == 1, F.array_join("lines", "<br>"))).alias("v"),
        (F.count_distinct("key") == 1).alias("wide"),
    )
    k = strip(F.regexp_replace("k", ":+$", ""))
    item = (
        F.when((k != "") & (F.col("v") != ""), F.concat(F.lit("- **"), k, F.lit(":** "), F.col("v")))
        .when(k != "", F.concat(F.lit("- **"), k, F.lit("**")))
        .when(F.col("v") != "", F.concat(F.lit("- "), F.col("v")))
    )
    rows = rows.withColumn("s", F.when(F.col("wide"), F.concat(F.lit("**"), F.col("k"), F.lit("**"))).otherwise(item)).filter("s IS NOT NULL")
    was = F.lag("wide").over(W.partitionBy(*keys).orderBy("r"))
    gap = F.when(was.isNull(), "").when(F.col("wide") | was, "\n\n").otherwise("\n")
    return rows.withColumn("_s", F.concat(gap, F.col("s"))).groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "_s"))), lambda x: x["_s"]), "").alias("md"))


def render_layout(grid: DataFrame, keys: list[str], by_column: Column) -> DataFrame:
    """keys, md: cells as paragraphs, each merged cell once, by row or (signatures) by column."""
    order = F.when(by_column, F.struct(F.col("c").alias("a"), F.col("r").alias("b"))).otherwise(F.struct(F.col("r").alias("a"), F.col("c").alias("b")))
    g = grid.filter("NOT empty").withColumn("_o", order)
    g = g.withColumn("_n", F.row_number().over(W.partitionBy(*keys, "key").orderBy("_o"))).filter("_n = 1")
    text = F.array_join("lines", "\n")
    return g.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_o", text.alias("s")))), lambda x: x["s"]), "\n\n").alias("md"))


def to_markdown(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys, kind, md of every table: a full-width first row of three and more is a caption, the rest by its kind."""
    g = drop_empty(cells, keys)
    row, all_ = W.partitionBy(*keys, "r"), W.partitionBy(*keys)
    wide = (F.count(F.lit(1)).over(row) > 1) & (F.min("key").over(row) == F.max("key").over(row))
    g = g.withColumn("_w", (F.col("r") == 0) & wide & (F.max("r").over(all_) >= 2))
    g = g.withColumn("caption", F.max(F.when(F.col("_w"), F.col("text"))).over(all_))
    captions = g.filter("_w").groupBy(*keys).agg(F.max("caption").alias("caption"))
    g = drop_empty(g.filter("NOT _w").drop("text", "empty", "caption", "_w"), keys)
    k = kinds(g, keys)
    g = g.join(k, keys)
    parts = [
        render_layout(g.filter("kind = 'layout'"), keys, F.col("signature")),
        render_key_value(g.filter("kind = 'key_value'"), keys),
        render_grid(g.filter("kind = 'grid'").drop("kind", "signature"), keys),
    ]
    md = parts[0].unionByName(parts[1]).unionByName(parts[2])
    out = k.join(md, keys, "left").join(captions, keys, "left")
    head = F.when(F.col("caption").isNotNull(), F.concat(F.lit("**"), F.col("caption"), F.lit("**")))
    return out.select(*keys, "kind", F.concat_ws("\n\n", head, F.when(F.col("md") != "", F.col("md"))).alias("md"))


# tables in texts


def html_tables(c: Column) -> Column:
    """Pipe tables of the HTML tables in a text, joined by blank lines: spans become empty cells, rows are
    filled up, tables of one row go. For well-formed markup; native."""
    tables = F.regexp_extract_all(c, F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), F.lit(1))

    def cell(x: Column) -> Column:
        span = F.coalesce(F.regexp_extract(x, r'(?i)^[^>]*colspan\s*=\s*"?(\d+)', 1).try_cast("int"), F.lit(1))
        text = F.regexp_replace(F.regexp_replace(F.regexp_extract(x, r"(?s)^[^>]*>(.*)$", 1), r"(?i)<br\s*/?>", " "), r"<[^>]+>", "")
        return F.concat(F.array(collapse(text)), F.array_repeat(F.lit(""), F.greatest(span, F.lit(1)) - 1))

    def table(t: Column) -> Column:
        rows = F.regexp_extract_all(t, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), F.lit(1))
        rows = F.transform(rows, lambda r: F.flatten(F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<t[dh]\b(.*?)</t[dh]>"), F.lit(1)), lambda x: cell(x))))
        rows = F.filter(rows, lambda r: F.size(r) > 0)
        width = F.array_max(F.transform(rows, lambda r: F.size(r)))
        full = F.transform(rows, lambda r: F.concat(r, F.array_repeat(F.lit(""), width - F.size(r))))
        lines = F.transform(full, _line)
        rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), width), "|"), F.lit("|"))
        joined = F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, 2, 1_000_000)), "\n")
        return F.when(F.size(rows) >= 2, joined)

    return F.array_join(F.array_compact(F.transform(tables, table)), "\n\n")


def pipe_tables(texts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, md: runs of two and more lines that start with a pipe, joined by blank lines. texts: keys, text."""
    lines = texts.select(*keys, F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("line", strip(F.col("line")))
    w = W.partitionBy(*keys).orderBy("pos")
    on = F.col("line").startswith("|")
    lines = lines.withColumn("_g", F.col("pos") - F.sum(on.cast("int")).over(w)).filter(on)
    runs = lines.groupBy(*keys, "_g").agg(F.array_sort(F.collect_list(F.struct("pos", "line"))).alias("x")).filter(F.size("x") >= 2)
    runs = runs.select(*keys, F.col("x")[0]["pos"].alias("pos"), F.array_join(F.transform("x", lambda e: e["line"]), "\n").alias("s"))
    return runs.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "s"))), lambda e: e["s"]), "\n\n").alias("md"))


def settle(text: Column) -> Column:
    """Without fence lines; long blanks are short, and of a run of empty pipe lines three stay."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.regexp_replace(x, r"(?:\\_|_){12,}", "____"))
    state = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("run"))

    def step(s: Column, x: Column) -> Column:
        fence, bare = F.regexp_like(x, F.lit(r"^\s*```")), F.regexp_like(x, F.lit(r"^\s*\|[\s|]*$"))
        run = F.when(bare & ~fence, s["run"] + 1).otherwise(0)
        drop = fence | (bare & (run > 3))
        return F.struct(F.when(drop, s["out"]).otherwise(F.concat(s["out"], F.array(x))).alias("out"), run.alias("run"))

    return strip(F.array_join(F.aggregate(lines, state, step, lambda s: s["out"]), "\n"))


def join_tiles(tiles: DataFrame, keys: list[str]) -> DataFrame:
    """keys, md: tables read tile by tile as one. Later tiles lose what stands up to their rule line (in the first
    four rows), a row of column numbers stays once, a row equal to the one before it goes. tiles: keys, tile, text."""
    lines = tiles.select(*keys, "tile", F.posexplode(F.filter(F.split("text", "\n"), lambda x: F.btrim(x) != "")).alias("pos", "line"))
    rule = F.regexp_like("line", F.lit(r"^\|[\s:|-]*-[\s:|-]*\|?\s*$"))
    end = F.min(F.when(rule & (F.col("pos") < 4), F.col("pos"))).over(W.partitionBy(*keys, "tile"))
    first = F.min("tile").over(W.partitionBy(*keys))
    lines = lines.withColumn("_end", end).withColumn("_first", first)
    lines = lines.filter((F.col("tile") == F.col("_first")) | F.col("_end").isNull() | (F.col("pos") > F.col("_end")))
    cells = F.transform(F.split(F.regexp_replace("line", r"^\||\|\s*$", ""), r"\|"), lambda x: F.btrim(x))
    counted = F.transform(F.sequence(F.lit(1), F.size(cells)), lambda i: i.cast("string"))
    lines = lines.withColumn("_num", (F.size(cells) >= 2) & (cells == counted))
    order = W.partitionBy(*keys, "_num").orderBy("tile", "pos")
    lines = lines.withColumn("_k", F.row_number().over(order)).filter("NOT _num OR _k = 1")
    lines = lines.withColumn("_before", F.lag("line").over(W.partitionBy(*keys).orderBy("tile", "pos")))
    lines = lines.filter(~F.col("line").eqNullSafe(F.col("_before")))
    x = F.array_sort(F.collect_list(F.struct("tile", "pos", "line")))
    return lines.groupBy(*keys).agg(F.array_join(F.transform(x, lambda e: e["line"]), "\n").alias("md"))


def body_kind(text: Column) -> Column:
    """What a read page shows: table_scan, diagram or text_scan."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x) != "")
    pipes = F.size(F.filter(lines, lambda x: F.ltrim(x).startswith("|")))
    is_table = (pipes >= 2) & (10 * pipes >= 8 * F.size(lines))
    return F.when(is_table, "table_scan").when(F.length(strip(text)) < 40, "diagram").otherwise("text_scan")


def splice_cells(tables_: DataFrame, read: DataFrame, keys: list[str], name: int = 0) -> DataFrame:
    """keys, md: cells read again put into a pipe table. The n-th reading (keys, nth from 1, cells: map of column to text) goes to
    the n-th row below the rule line that has a name and is neither a total nor a row of column numbers. tables_: keys, md."""
    lines = tables_.select(*keys, F.posexplode(F.split("md", "\n")).alias("pos", "line"))
    rule = F.regexp_like("line", F.lit(r"^\s*\|[\s:|-]*-[\s:|-]*\|?\s*$"))
    after = F.max(rule.cast("int")).over(W.partitionBy(*keys).orderBy("pos").rowsBetween(W.unboundedPreceding, -1)) == 1
    cells = F.transform(F.split(F.regexp_replace(F.btrim("line"), r"^\|+|\|+$", ""), r"\|"), lambda c: F.btrim(c))
    x = lines.withColumn("_c", cells).withColumn("_a", F.coalesce(after, F.lit(False)))
    first = F.lower(F.regexp_replace(F.get("_c", F.lit(0)), r"^\.+|\.+$", ""))
    counted = F.col("_c") == F.transform(F.sequence(F.lit(1), F.size("_c")), lambda i: i.cast("string"))
    total = first.startswith("итого") | first.startswith("всего")
    fits = F.col("_a") & F.ltrim("line").startswith("|") & ~counted & ~total & (F.coalesce(F.get("_c", F.lit(name)), F.lit("")) != "")
    x = x.withColumn("_f", fits).withColumn("nth", F.sum(F.col("_f").cast("int")).over(W.partitionBy(*keys).orderBy("pos")))
    r = read.select(*keys, "nth", F.col("cells").alias("_new"))
    x = x.join(r, [*keys, "nth"], "left")
    new = F.transform("_c", lambda c, i: F.coalesce(F.try_element_at("_new", i), c))
    line = F.when(F.col("_f") & F.col("_new").isNotNull(), F.concat(F.lit("| "), F.array_join(new, " | "), F.lit(" |"))).otherwise(F.col("line"))
    x = x.withColumn("_l", line).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", "_l"))).alias("x"))
    return x.select(*keys, F.array_join(F.transform("x", lambda e: e["_l"]), "\n").alias("md"))
