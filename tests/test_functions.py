"""Golden values of column functions, nulls and odd input included."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quire.functions import geometry as G
from quire.functions import numbers as N
from quire.functions import text as T
from quire.operators import answers, markdown, tables, waybill
from quire.sources import files


def one(spark, make, *values, form="string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], f"x {form}").select(make(F.col("x"))).collect()]


def test_numbers(spark):
    given = ["1 234,56", "1.234,56", "20%", "150,00 руб.", "1.234", "1,234,567", "1.2.3", "abc", None, "1,234,567.89", "--5", "-7,5", "1 000"]
    want = [1234.56, 1234.56, 20, 150, 1.234, 1234567, 123, None, None, 1234567.89, None, -7.5, 1000]
    assert [None if v is None else float(v) for v in one(spark, N.to_number, *given)] == want


def test_words(spark):
    given = ["Сто двадцать три рубля 45 копеек", "1 250 рублей 05 коп.", "две тысячи пять", "один миллион двести тысяч рублей", "тысяча рублей", "нет", None]
    want = [Decimal("123.45"), Decimal("1250.05"), 2005, 1200000, 1000, None, None]
    assert one(spark, N.words_to_amount, *given) == want


def test_amount_text(spark):
    assert one(spark, lambda c: N.amount_text(c.cast("decimal(20,3)")), "1234567.5", "0.125") == ["1 234 567,50", "0,12"]


def test_null_text_and_series(spark):
    assert one(spark, T.null_text, "", "null", "None", " - ", "—", "нет", "a   b", None) == [None] * 6 + ["a b", None]
    assert one(spark, T.series, "e.B", "аб") == ["ЕВ", "АБ"]


def test_captions(spark):
    given = ["Таблица 6", "Рис. 2.1 – Схема", "Рисунок А.1 — x", "Таблица", "таблицы 1", None]
    assert one(spark, T.caption_kind, *given) == ["table", "figure", "figure", None, None, None]


def test_bullets_and_marks(spark):
    assert one(spark, T.list_bullet, "3.", "а)", "1.2.", "", None) == ["3.", "- а)", "- 1.2.", "-", "-"]
    mark = "zqxnum" + "1.".encode().hex() + "zqx "
    assert one(spark, T.marker_of, mark + "x", "zqxnumzqx y", "z") == ["1.", "", None]
    assert one(spark, T.finalize, f"a {mark}b zqxnumzqxc") == ["a 1. b c"]
    assert one(spark, T.render_scripts, "xzqxsubzqxizqxendzqxzqxsubzqx – zqxendzqx zqxsupzqx zqxendzqx") == ["x<sub>i – </sub>  "]
    assert one(spark, T.plain, f"{mark}azqxsupzqx2zqxendzqx") == ["a2"]


@pytest.mark.parametrize("form,n,want", [("decimalZero", 100, "100"), ("lowerLetter", 28, "bb"), ("upperRoman", 1994, "MCMXCIV"), ("russianLower", 29, "аа"), ("none", 3, ""), ("decimal", 7, "7"), ("lowerRoman", 0, "")])
def test_list_numbers(spark, form, n, want):
    assert one(spark, lambda c: T.list_number(c, F.lit(form)), n, form="int") == [want]


def test_headings(spark):
    rows = [(1, 0, "1 Start", True, False), (1, 1, "1.1 next part", False, False), (1, 2, "2.1 orphan here", False, False), (1, 3, "1.1.1 deep one", False, False), (1, 4, "Ends with.", True, False), (1, 5, "СПИСОК", False, True), (1, 6, "plain words", False, False)]
    df = spark.createDataFrame(rows, "doc int, pos int, text string, bold boolean, in_list boolean")
    got = {r["pos"]: r["level"] for r in markdown.headings(df, ["doc"]).collect()}
    assert got == {0: 1, 1: 2, 2: None, 3: 3, 4: None, 5: 1, 6: None}


def test_glued_heading(spark):
    got = one(spark, markdown.glued_heading, "2.1.1 Тема. Дальше текст…", "2.1 тема. Дальше", "2.1 Тема")
    assert tuple(got[0]) == ("2.1.1", "2.1.1 Тема", "Дальше текст…") and got[1:] == [None, None]


def test_image_links(spark):
    df = spark.createDataFrame([("*a* [x]", "m/a b.png"), ("b*c", "p.png")], "a string, l string")
    assert [r[0] for r in df.select(T.image_markdown(F.col("a"), F.col("l"))).collect()] == ["![a \\[x\\]](<m/a b.png>)", "![b*c](p.png)"]


def test_demote(spark):
    assert one(spark, markdown.demote, "# a\n##### b\ntext # c") == ["### a\n###### b\ntext # c"]


def test_boxes(spark):
    box = lambda *v: G.box(*map(F.lit, v))
    df = spark.range(1)
    got = df.select(G.iou(box(0, 0, 10, 10), box(5, 0, 15, 10)), G.inside(box(0, 0, 10, 10), box(5, 0, 15, 10)), G.inside(box(1, 1, 1, 1), box(0, 0, 9, 9)), G.iou(box(0, 0, 1, 1), box(5, 5, 6, 6))).first()
    assert [round(x, 4) for x in got] == [0.3333, 0.5, 0.0, 0.0]
    assert [r[0] for r in spark.createDataFrame([("Page-Header",), ("chart",), ("x",)], "x string").select(G.role(F.col("x"))).collect()] == ["margin", "picture", "text"]


def test_formats(spark):
    assert one(spark, files.detect_format, "/a/b.PDF", "x.jpeg", "no", ".txt", "a.b.docm", "a.zip") == ["pdf", "image", None, None, "docm", None]


def test_decoding(spark):
    given = ["Привет".encode("cp1251"), b"\xef\xbb\xbfabc", "ы".encode("utf-16"), "﻿ы".encode("utf-16-be"), "ы".encode(), b"\x98\xff", b""]
    assert one(spark, files.decode_text, *map(bytearray, given), form="binary") == ["Привет", "abc", "ы", "ы", "ы", None, ""]


def test_paragraphs(spark):
    assert one(spark, T.paragraphs, "a\r\n \r\nb\r\rc\n", " \n\n ", None) == ["a\n\nb\n\nc\n", "", None]


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("день\n\nночь".encode("cp1251"))
    (tmp_path / "b.txt").write_bytes(b"\x98\xff")
    (tmp_path / "c.PDF").write_bytes(b"%PDF")
    got = {r["path"][-5:]: (r["markdown"], r["error"]) for r in files.text_files(files.read(spark, str(tmp_path))).collect()}
    assert got == {"a.txt": ("день\n\nночь\n", None), "b.txt": (None, "undecodable")}
    assert files.waybill_files(spark, str(tmp_path)).count() == 1


def test_json_answers(spark):
    given = ['```json\n{"a": "}"}\n```', 'x {bad} {"b": 1} y', "none", '{"a": 1} {"b": 2}', None, "{"]
    assert one(spark, answers.first_json, *given) == ['{"a": "}"}', '{"b": 1}', None, '{"a": 1}', None, None]


def test_upright(spark):
    given = ['{"upright": "B"}', '{"upright": "A"}', "junk", "so\n**В**", "Copy A is upside down, copy B fine", "копия B"]
    assert one(spark, answers.upright, *given) == [180, 0, 0, 180, 180, 180]


def test_salvaged_boxes(spark):
    given = '[{"bbox": [0, 0, 28, 28], "category": "Text", "text": "broken'
    df = spark.createDataFrame([(1, given), (2, "junk"), (3, '[{"bbox":[0,0,90,90],"category":"Text","text":"all"}]')], "p int, answer string")
    got = answers.detected(df, ["p"], F.lit(100), F.lit(100), F.lit(100), F.lit(100)).collect()
    assert {(r["p"], r["status"]) for r in got} == {(1, "salvaged"), (2, "invalid"), (3, "collapsed")}


def test_settle(spark):
    given = "```\n|  |\n| |\n||\n| |\na\\_" + "_" * 14 + "b\n| x |\n```"
    assert one(spark, tables.settle, given) == ["|  |\n| |\n||\na____b\n| x |"]


def test_body_kind(spark):
    assert one(spark, tables.body_kind, "| a |\n| b |", "short", "x" * 50) == ["table_scan", "diagram", "text_scan"]


def test_dates(spark):
    given = ["31.02.2024", "5/6/21", "01-13-2020", "2.7.2024", "3.7.2024", "x", None]
    assert one(spark, lambda c: waybill.date_ok(c, "2024-06-01"), *given) == [False, True, False, True, False, False, False]


def test_merged_header(spark):
    """A head of two rows, a group over two columns, a full-width section and a repeated head."""
    at = [
        (0, 0, "a", ["N"]), (0, 1, "b", ["Group"]), (0, 2, "b", ["Group"]), (1, 0, "a", ["N"]), (1, 1, "c", ["x"]), (1, 2, "d", ["y"]),
        (2, 0, "e", ["Part"]), (2, 1, "e", ["Part"]), (2, 2, "e", ["Part"]), (3, 0, "f", ["r"]), (3, 1, "g", ["p", "q"]), (3, 2, "h", ["2|3"]),
    ]
    seen, rows = set(), []
    for r, c, k, lines in at:
        rows.append((1, r, c, k, lines, False, k in seen and k in "be", k in seen and k == "a"))
        seen.add(k)
    df = spark.createDataFrame(rows, "t int, r int, c int, key string, lines array<string>, bold boolean, h_cont boolean, v_cont boolean")
    got = tables.to_markdown(df, ["t"]).first()
    assert got["md"] == "| N | Group / x | Group / y |\n|---|---|---|\n| **Part** |  |  |\n| r | p<br>q | 2\\|3 |"
