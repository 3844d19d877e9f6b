"""Text layers, office files, zones and bands."""

import io
import zipfile

from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.operators import layout, tables, textlayer, triage
from quire.sources import files, ooxml


def test_words_and_paragraphs(spark):
    lines = ["Full line of the text here", "ends.", "Next par goes on to the edge", "and on."]
    chars, idx = [], 0
    for n, line in enumerate(lines):
        for k, ch in enumerate(line + "\n"):
            chars.append((1, idx, ch, 10.0 * k, 100.0 - 12 * n, 10.0 * k + 9, 110.0 - 12 * n, line.startswith("Next"), False, "u" if ch == "F" else None, 0.0, 0.0, 400.0, 200.0))
            idx += 1
    df = spark.createDataFrame(chars, "e int, idx int, ch string, l double, b double, r double, t double, bold boolean, italic boolean, url string, el double, eb double, er double, et double")
    got = textlayer.words(df, ["e"]).orderBy("word").collect()
    assert [w["text"] for w in got] == " ".join(lines).split()
    assert [w["text"] for w in got if w["paragraph_end"]] == ["ends."]
    assert got[0]["url"] == "u" and got[0]["bold"] is False and got[7]["bold"] is True
    el = spark.createDataFrame([(1, " ".join(lines), "text")], "e int, text string, label string")
    out = textlayer.styled(el, textlayer.words(df, ["e"]), ["e"]).orderBy("part").collect()
    assert [r["md"] for r in out] == ["[Full](u) line of the text here ends.", "**Next par goes on to the edge** and on."]


def _styled(spark, text, words, label="text"):
    el = spark.createDataFrame([(1, text, label)], "e int, text string, label string")
    found = spark.createDataFrame([(1, i + 1, *w) for i, w in enumerate(words)], "e int, word int, text string, bold boolean, italic boolean, url string, paragraph_end boolean")
    return [(r["part"], r["text"], r["md"], r["bold"]) for r in textlayer.styled(el, found, ["e"]).orderBy("part").collect()]


def test_alignment_and_styles(spark):
    a, dash, b, c = ("a", True, False, None, False), ("-", None, None, None, False), ("b,", True, False, None, False), ("c", False, True, None, False)
    assert _styled(spark, "quite other words", [a]) == []
    assert _styled(spark, " \t", [a]) == []
    assert _styled(spark, "a – b, c", [a, dash, b, c]) == [(0, "a – b, c", "**a – b**, *c*", False)]
    assert _styled(spark, "a – b,", [a, dash, b]) == [(0, "a – b,", "a – b,", True)]  # bold as a whole: no marks
    assert _styled(spark, "a x b, c", [a, b, c]) == [(0, "a x b, c", "**a** x **b**, *c*", False)]
    link, both = ("see", False, False, "http://x", True), ("this!", True, True, None, False)
    assert _styled(spark, "see this!", [link, both], "title") == [(0, "see this!", "[see](http://x) ***this***!", False)]
    assert [p[:2] for p in _styled(spark, "see this!", [link, both])] == [(0, "see"), (1, "this!")]


def test_links(spark):
    chars = spark.createDataFrame([(1, 0, 0.0, 0.0, 2.0, 2.0), (1, 1, 50.0, 0.0, 52.0, 2.0)], "p int, idx int, l double, b double, r double, t double")
    links = spark.createDataFrame([(1, 1, 0.0, 0.0, 9.0, 9.0, "second"), (1, 0, 0.0, 0.0, 5.0, 5.0, "first")], "p int, ord int, l double, b double, r double, t double, url string")
    assert {r["idx"]: r["url"] for r in textlayer.with_links(chars, links, ["p"]).collect()} == {0: "first", 1: None}


def _docx(names: dict) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in names.items():
            z.writestr(name, data)
    return out.getvalue()


def test_word_files(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    numbering = f'<w:numbering {w}><w:abstractNum w:abstractNumId="7"><w:lvl w:ilvl="0"><w:start w:val="3"/><w:numFmt w:val="upperRoman"/><w:lvlText w:val="%1."/><w:isLgl/></w:lvl></w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="7"/><w:lvlOverride w:ilvl="0"><w:startOverride w:val="9"/></w:lvlOverride></w:num></w:numbering>'
    body = f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="S"/><w:numPr><w:ilvl w:val="0"/><w:numId w:val="1"/></w:numPr></w:pPr><w:r><w:t>x</w:t></w:r><w:r><w:rPr><w:vertAlign w:val="subscript"/></w:rPr><w:t>2</w:t></w:r></w:p></w:body></w:document>'
    types = b"<Types>" + ooxml._MACRO + b"</Types>"
    (tmp_path / "a.docm").write_bytes(_docx({"word/numbering.xml": numbering, "word/document.xml": body, "[Content_Types].xml": types}))
    (tmp_path / "b.docx").write_bytes(b"no zip")
    read = files.read(spark, str(tmp_path))
    got = {r["path"][-6:]: r for r in ooxml.definitions(read).collect()}
    a = got["a.docm"]
    assert a["levels"][0].asDict() == {"abs_id": "7", "ilvl": 0, "start": 3, "fmt": "upperRoman", "text": "%1.", "restart": None, "legal": True}
    assert a["nums"][0].asDict() == {"num_id": "1", "abs_id": "7", "ilvl": 0, "start": 9}
    assert a["paragraphs"][0]["text"] == "xzqxsubzqx2zqxendzqx" and got["b.docx"]["paragraphs"] == []
    plain = {r["path"][-6:]: r["content"] for r in ooxml.plain_documents(read).collect()}
    assert ooxml._PLAIN in ooxml.part(bytes(plain["a.docm"]), "[Content_Types].xml")


def test_zones_rows_slices(spark):
    df = spark.createDataFrame([(1, 1000, 2000, [100, 200, 240, 300, 360, 420]), (2, 1000, 2000, [])], "p int, width int, height int, lines array<int>")
    df = df.withColumn("table", F.when(F.col("p") == 1, G.box(F.lit(50), F.lit(100), F.lit(900), F.lit(430)))).withColumn("block", F.lit(None).cast("struct<l:int,t:int,r:int,b:int>"))
    z = {r["p"]: r for r in layout.zones(df).collect()}
    assert z[1]["head"] == 240 and z[1]["source"] == "layout" and tuple(z[1]["zone"]) == (40, 80, 910, 450)
    assert z[2]["source"] == "bands" and z[2]["head"] == 600 + int(0.15 * 1160) and z[2]["footer"] is not None
    rows = layout.rows_between(layout.zones(df), ["p"]).orderBy("row").collect()
    assert [(r["top"], r["bottom"]) for r in rows] == [(240, 300), (300, 360), (360, 420)]
    cut = layout.slices(layout.zones(df).filter("p = 2"), ["p"]).orderBy("slice").collect()
    assert cut[0]["top"] == 774 and cut[-1]["bottom"] == 1760 and cut[1]["top"] < cut[0]["bottom"]


def test_page_bands(spark):
    rows = [(1, 1000, [(0, 100)]), (2, 4000, [(0, 900), (800, 1200), (1400, 2500), (2700, 3900)]), (3, 4000, [])]
    df = spark.createDataFrame(rows, "p int, height int, busy array<struct<top:int,bottom:int>>")
    got = {r["p"]: [tuple(b) for b in r["bands"]] for r in layout.page_bands(df, 1600).collect()}
    assert got[1] == [(0, 1000)] and got[2] == [(0, 1300), (1300, 2600), (2600, 4000)] and got[3] == [(0, 4000)]


def test_html_blocks_and_hints(spark):
    html = '<div data-bbox="0 0 1000 500"><div data-bbox="0,0,500,500">in <b>bold</b></div><div data-label="Blank-Page" data-bbox="0 0 1 1">x</div><div data-bbox="600 600 900 900">low</div>'
    df = spark.createDataFrame([(1, html, 200, 100)], "p int, html string, width int, height int")
    blocks = layout.html_blocks(df, ["p"])
    assert sorted((r["text"], tuple(r["box"])) for r in blocks.collect()) == [("in bold", (0, 0, 100, 50)), ("low", (120, 60, 180, 90))]
    crops = spark.createDataFrame([(1, "a", (0, 0, 60, 60)), (1, "b", (190, 95, 200, 100))], "p int, crop string, box struct<l:int,t:int,r:int,b:int>")
    assert {r["crop"]: r["hint"] for r in layout.hints(crops, blocks, ["p"]).collect()} == {"a": "in bold", "b": ""}


def test_splice(spark):
    md = "| n | q |\n|---|---|\n| 1 | 2 |\n| a | x |\n|  | y |\n| Итого | 5 |\n| b | z |"
    df = spark.createDataFrame([(1, md)], "t int, md string")
    read = spark.createDataFrame([(1, 1, {1: "X"}), (1, 2, {0: "B", 7: "no"})], "t int, nth int, cells map<int,string>")
    assert tables.splice_cells(df, read, ["t"]).first()["md"].split("\n")[3:] == ["| a | X |", "|  | y |", "| Итого | 5 |", "| B | z |"]


def test_triage_features(spark):
    texts = spark.createDataFrame([(1, 1, 100.0, 100.0, "x" * 30), (1, 2, 100.0, 100.0, ""), (1, 3, 100.0, 100.0, "�" * 9 + "x" * 21), (1, 4, 100.0, 100.0, "")], "doc int, page int, width double, height double, text string")
    objects = [(1, 1, "image", -50.0, 0.0, 60.0, 90.0, 0), (1, 1, "text", 0.0, 0.0, 1.0, 1.0, 3), (1, 2, "image", 0.0, 0.0, 100.0, 80.0, 0), (1, 2, "image", 0.0, 0.0, 100.0, 80.0, 0)]
    df = spark.createDataFrame(objects, "doc int, page int, type string, l double, b double, r double, t double, render_mode int")
    got = {r["page"]: (r["kind"], r["coverage"]) for r in triage.pages(triage.features(df, texts)).collect()}
    assert got == {1: ("hybrid", 0.54), 2: ("full_scan", 1.0), 3: ("full_scan", 0.0), 4: ("blank", 0.0)}
