"""Files to Markdown, answers to records."""

import io
import zipfile

from pyspark.sql import functions as F

from quire.operators import documents, waybill

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


def _p(*runs, style="", num=None):
    props = (f'<w:pStyle w:val="{style}"/>' if style else "") + (f'<w:numPr><w:ilvl w:val="{num[1]}"/><w:numId w:val="{num[0]}"/></w:numPr>' if num else "")
    return f"<w:p><w:pPr>{props}</w:pPr>{''.join(runs)}</w:p>"


def _r(text, look="", url=None):
    run = f'<w:r><w:rPr>{look}</w:rPr><w:t xml:space="preserve">{text}</w:t></w:r>'
    return f'<w:hyperlink r:id="{url}">{run}</w:hyperlink>' if url else run


def _docx(body):
    out = io.BytesIO()
    lvl = '<w:lvl w:ilvl="%d"><w:start w:val="1"/><w:numFmt w:val="%s"/><w:lvlText w:val="%s"/></w:lvl>'
    levels = lvl % (0, "decimal", "%1.") + lvl % (1, "decimal", "%1.%2")
    style = '<w:style w:type="paragraph" w:styleId="%s"><w:name w:val="%s"/>%s</w:style>'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {W}><w:body>{body}</w:body></w:document>")
        based = '<w:basedOn w:val="H2"/>'
        z.writestr("word/styles.xml", f"<w:styles {W}>{style % ('T', 'Title', '')}{style % ('H2', 'heading 2', '')}{style % ('Own', 'mine', based)}</w:styles>")
        z.writestr("word/numbering.xml", f'<w:numbering {W}><w:abstractNum w:abstractNumId="7">{levels}</w:abstractNum><w:num w:numId="1"><w:abstractNumId w:val="7"/></w:num></w:numbering>')
        z.writestr("word/_rels/document.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="k" Target="http://x.y" TargetMode="External"/></Relationships>')
    return out.getvalue()


def test_parse(spark):
    cell = lambda *p, props="": f"<w:tc><w:tcPr>{props}</w:tcPr>{''.join(p)}</w:tc>"
    table = (
        "<w:tbl><w:tr>" + cell(_p(_r("Name"))) + cell(_p(_r("Value")), props='<w:gridSpan w:val="2"/>') + "</w:tr>"
        "<w:tr>" + cell(_p(_r("a|b")), props='<w:vMerge w:val="restart"/>') + cell(_p(_r("1")), _p(_r("2"))) + cell(_p(_r("x"), num=(1, 0))) + "</w:tr>"
        "<w:tr>" + cell(_p(), props="<w:vMerge/>") + cell(_p(_r("3"))) + cell(_p(_r("4"))) + "</w:tr></w:tbl>"
    )
    bold, low = "<w:b/>", '<w:vertAlign w:val="subscript"/>'
    body = [
        _p(_r("The title"), style="T"), _p(_r("2 Scope"), style="Own"), _p(_r("Plain "), _r("part", bold), _r("."), _r(" H"), _r("2", low)),
        _p(_r("2.1 Inner. Then the text goes on here.")), _p(_r("9.1 Stray. Then the text goes on here.")), _p(_r("All of it bold", bold)),
        _p(_r("one,"), num=(1, 0)), _p(_r("two "), _r("see", url="k"), num=(1, 1)), _p(_r("three;"), num=(1, 0)), _p(), table, _p(_r("end.")),
    ]
    files = [
        ("d/a.docx", _docx("".join(body))), ("d/b.DOCM", _docx("")), ("d/c.docx", b"no zip"), ("d/d.txt", " x\r\n\r\ny ".encode()), ("d/e.pdf", b"%PDF"),
        ("d/f.xyz", b""), ("d/g.txt", b"\x98"), ("d/h.txt", None), ("d/i.docx", None), ("d/j.docx", _docx("<w:p>")),
    ]
    df = spark.createDataFrame(files, "path string, content binary")
    got = {r["path"][2:]: (r["format"], r["markdown"], r["error"]) for r in documents.parse(df).collect()}
    assert got["a.docx"][1].split("\n\n")[:6] == ["# The title", "## 2 Scope", "Plain **part**. H<sub>2</sub>", "## 2.1 Inner", "Then the text goes on here.", "9.1 Stray. Then the text goes on here."]
    assert got["a.docx"][1].split("\n\n")[6:] == [
        "# All of it bold", "1. one,\n   - 1.1 two [see](http://x.y)\n2. three;",
        # the head goes on below a cell over several columns, and below one that reaches down from there
        "| Name / a\\|b | Value / 1 2 | Value / - x |\n|---|---|---|\n| a\\|b | 3 | 4 |", "end.\n",
    ]
    assert got["b.DOCM"] == ("docm", "", None) and got["c.docx"] == ("docx", None, "unreadable document")
    assert got["d.txt"] == ("txt", "x\n\ny\n", None) and got["e.pdf"] == ("pdf", None, "outside input needed: pdf")
    assert got["f.xyz"] == (None, None, "unsupported format") and got["g.txt"][2] == got["h.txt"][2] == "undecodable"
    assert got["i.docx"][2] == got["j.docx"][2] == "unreadable document" and len(got) == len(files)
    assert documents.parse(df.limit(0)).count() == 0


def test_records(spark):
    answers = [(None,), ("",), ("[1]",), ("{bad",), ('{"items": {"name": "x"}, "shipper": [1], "totals": [2], "series": " "}',), ('{"items": [{"n": 1.5, "name": {"a": 1}}, null, 3], "shipper": {"unp": "1\\u00a02"}}',)]
    got = [r["w"] for r in spark.createDataFrame(answers, "a string").select(waybill.coerce_waybill(F.col("a"), F.lit(4)).alias("w")).collect()]
    assert all(w["items"] == [] and w["shipper"]["name"] is None and w["totals"]["cost"] is None and w["series"] is None for w in got[:5])
    assert [(i["n"], i["name"], i["page"]) for i in got[5]["items"]] == [("1.5", '{"a":1}', 4)] and got[5]["shipper"]["unp"] == "12"
    assert [f.split(":")[0] for f in waybill._fields_of(waybill.WAYBILL)] == list(got[0].asDict())
