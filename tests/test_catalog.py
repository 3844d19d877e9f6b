"""Every catalogue query against its SQL, and those without SQL against plain loops."""

import pytest

from quire.plans import catalog
from quire.plans.inputs import BOXES, PAGES, derived

from .oracle import rows_of_spark, rows_of_sql


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_same_rows_as_sql(spark, sf, name):
    assert rows_of_spark(catalog.QUERIES[name](spark, sf)) == rows_of_sql(catalog.ORACLE_SQL[name], sf)


def _area(b):
    return max(0, b[2] - b[0]) * max(0, b[3] - b[1])


def _cross(a, b):
    return _area((max(a[0], b[0]), max(a[1], b[1]), min(a[2], b[2]), min(a[3], b[3])))


def _pages(spark, sf):
    out = {}
    for r in derived(spark, sf, BOXES).orderBy("page", "id").collect():
        out.setdefault(r["page"], []).append(r)
    return out


def test_region_plan(spark, sf):
    want = set()
    for page, boxes in _pages(spark, sf).items():
        rows = []
        for r in boxes:
            kind = "margin" if r["id"] % 5 == 0 else {"picture": "figure"}.get(r["role"], r["role"])
            rows.append((r["t"], r["l"], r["id"], kind, r["score"] / 10, (r["l"], r["t"], r["r"], r["b"])))
        taken, n = [], {"figure": 0, "table": 0}
        for _, _, i, kind, score, b in sorted(rows):
            if kind == "margin":
                inner = any(o[2] != i and o[3] != "margin" and 2 * _cross(b, o[5]) >= _area(b) for o in rows)
                use = "text" if inner else "masked"
            elif kind == "text":
                use = "text"
            elif score < 0.5:
                use = "skipped: low confidence"
            elif kind == "figure" and _area(b) >= 0.6 * 400000:
                use = "skipped: page-sized"
            elif any(10 * _cross(b, t) >= 8 * _area(b) for t in taken):
                use = "skipped: inside another region"
            else:
                n[kind] += 1
                over = kind == "figure" and any(o[3] == "text" and _cross(o[5], b) / _area(o[5]) >= 0.3 for o in rows)
                use = f"{kind} {n[kind]}" + (" over-text" if over else "")
                taken.append(b)
            want.add((page, i, kind, use))
    got = {tuple(r) for r in catalog.q39_region_plan(spark, sf).select("page", "ord", "kind", "use").collect()}
    assert got == want


def test_table_kinds(spark, sf):
    cells = {}
    for r in catalog.q25_grid_drop_empty(spark, sf).collect():
        cells.setdefault(r["doc"], {})[r["r"], r["c"]] = r["text"]
    want = {}
    for doc, at in cells.items():
        n, m = max(r for r, _ in at) + 1, max(c for _, c in at) + 1
        g = [[at[r, c] for c in range(m)] for r in range(n)]
        number = lambda t: t.isdigit()
        if m == 1:
            kind = "layout"
        elif n == 1:
            kind = "grid" if m >= 3 and all(g[0]) else "layout"
        elif m >= 3 and all(g[0]):
            kind = "grid"
        elif 2 * sum(not x for row in g for x in row) >= n * m:
            kind = "layout"
        else:
            left = [row[0] for row in g if row[0]]
            by_bold = any(g[0]) and any(x for row in g[1:] for x in row)
            # no cell is a column head by its words: names and notes carry digits
            pairs = m == 2 and not by_bold and left and len(left) >= 0.8 * n and sum(map(number, left)) < 0.5 * len(left) and len(set(left)) >= 0.8 * len(left)
            kind = "key_value" if pairs else "grid"
        want[doc] = kind
    got = {r["doc"]: r["kind"] for r in catalog.q26_table_kind(spark, sf).collect()}
    assert got == want


def test_counters(spark, sf):
    ru = "абвгдежзиклмнопрстуфхцчшщэюя"
    roman = lambda n: "L" * (n // 50) + ["", "X", "XX", "XXX", "XL"][n % 50 // 10] + ["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"][n % 10]
    want, by = set(), {}
    for r in derived(spark, sf, PAGES).orderBy("file", "page").collect():
        by.setdefault(r["file"], []).append((r["page"], str(r["v"] % 2), r["v"] % 3))
    for doc, rows in by.items():
        n, seen = [None] * 9, set()
        for pos, num, lvl in rows:
            if num not in seen:
                seen.add(num)
                if num == "1" and lvl == 0:
                    n[0] = 4
            n[lvl] = 1 if n[lvl] is None else n[lvl] + 1
            for d in range(lvl + 1, 9):
                restart = 1 if d == 2 else None
                if restart is None or lvl < restart:
                    n[d] = None
            v = [1 if x is None else x for x in n]
            mark = [f"{roman(v[0])}.", f"{v[0]}.{v[1]}", f"{ru[(v[2] - 1) % 28] * ((v[2] - 1) // 28 + 1)})"][lvl]
            want.add((doc, pos, mark))
    got = {tuple(r) for r in catalog.q47b_multilevel_counters(spark, sf).collect()}
    assert got == want


def test_fusion_and_tiles_keep_page_order(spark, sf):
    rows = catalog.q39b_layout_fusion(spark, sf).orderBy("page", "ord").collect()
    assert rows
    for a, b in zip(rows, rows[1:]):
        if a["page"] == b["page"]:
            assert (a["t"], a["l"]) <= (b["t"], b["l"])
    assert {r["source"] for r in rows} <= {"lines", "heron", "dots", "heron+dots"}
    assert catalog.q39c_tile_merge(spark, sf).count() > 0


def test_fusion_by_hand(spark):
    """Cases worked out by hand, on a page of 1000 by 1000."""
    from quire.operators import layout

    dets = [
        # page 1: both detectors agree on a table; heron alone is not sure of one, is sure of another; dots alone stays
        (1, 1, "table", 0.6, (100, 100, 300, 200), "heron"), (1, 2, "table", 0.9, (103, 102, 301, 199), "dots"),
        (1, 3, "table", 0.4, (500, 100, 700, 200), "heron"), (1, 4, "table", 0.5, (500, 300, 700, 400), "heron"), (1, 5, "table", 0.1, (100, 300, 300, 400), "dots"),
        # a ruled table takes the place of one that shares half of the smaller
        (1, 6, "table", 0.9, (100, 600, 300, 700), "dots"),
        # text inside a table goes; of two that are one place the surer stays, at a tie the earlier
        (1, 7, "text", 0.9, (110, 110, 290, 150), "heron"), (1, 8, "text", 0.5, (500, 700, 700, 740), "heron"), (1, 9, "text", 0.8, (500, 700, 700, 741), "heron"),
        # dots' text stays where less than 0.3 of it is covered
        (1, 10, "text", 0.9, (500, 720, 700, 820), "dots"), (1, 11, "margin", 0.9, (500, 700, 700, 745), "dots"),
        # too small for anything; a picture over 0.4 of the page; one that is free; dots' of the same place
        (1, 12, "text", 0.9, (0, 0, 9, 9), "heron"), (2, 1, "picture", 0.9, (0, 0, 700, 600), "heron"),
        (2, 2, "picture", 0.7, (0, 700, 200, 900), "dots"), (2, 3, "picture", 0.6, (0, 700, 200, 890), "heron"),
        # a picture over three texts
        (2, 4, "picture", 0.9, (700, 0, 900, 300), "heron"), (2, 5, "text", 0.9, (710, 10, 890, 50), "heron"), (2, 6, "text", 0.8, (710, 60, 890, 100), "heron"), (2, 7, "text", 0.7, (710, 110, 890, 150), "heron"),
    ]
    box = "struct<l:int,t:int,r:int,b:int>"
    d = spark.createDataFrame(dets, f"page int, ord int, role string, score double, box {box}, source string")
    k = spark.createDataFrame([(1, 1, (90, 590, 310, 710)), (3, 1, (0, 0, 50, 50))], f"page int, ord int, box {box}")
    got = [tuple(r) for r in layout.fuse(d, k, ["page"], 1000, 1000).orderBy("page", "ord").collect()]
    assert got == [
        (1, 0, "table", 0.9, 102, 101, 300, 200, "heron+dots"),
        (1, 1, "table", 0.1, 100, 300, 300, 400, "dots"),
        (1, 2, "table", 0.5, 500, 300, 700, 400, "heron"),
        (1, 3, "table", 1.0, 90, 590, 310, 710, "lines"),
        (1, 4, "text", 0.8, 500, 700, 700, 741, "heron"),
        (1, 5, "text", 0.9, 500, 720, 700, 820, "dots"),
        (2, 0, "text", 0.9, 710, 10, 890, 50, "heron"),
        (2, 1, "text", 0.8, 710, 60, 890, 100, "heron"),
        (2, 2, "text", 0.7, 710, 110, 890, 150, "heron"),
        (2, 3, "picture", 0.6, 0, 700, 200, 890, "heron"),
        (3, 0, "table", 1.0, 0, 0, 50, 50, "lines"),
    ]


def test_checks_of_very_long_numbers(spark):
    """A printed number of any length ends no job: it is compared where it fits, and unread where it does not."""
    from pyspark.sql import functions as F

    from quire.operators import waybill

    form = "doc int, row int, quantity string, price string, cost string, vat_rate string, vat string, cost_with_vat string, places string, mass string"
    rows = [
        (1, 1, "1", "1234567890123", "1234567890123", "20%", "246913578024,60", "1481481468147.60", "1", "2"),
        (1, 2, "1", "1234567890123", "1234567890124", None, None, "9" * 40, "1", "2"),
        (2, 1, "9" * 22, "9" * 22, "5", "20", "1", "6", "9" * 22, "1"), (2, 2, "1 000,5", "2", "2.001,00", "bad", "0", "2001", "9" * 22, "9" * 40),
    ]
    items = spark.createDataFrame(rows, form)
    assert sorted(tuple(r)[:3] for r in waybill.check_items(items).collect()) == [(1, 2, "row_cost")]
    totals = spark.createDataFrame([(1, "2469135780247", "0", "1", "2", "4"), (2, "9" * 40, "1", "2007", "1", "1")], "doc int, cost string, vat string, cost_with_vat string, places string, mass string")
    got = {tuple(r)[:2] for r in waybill.check_totals(items, totals).collect()}
    assert {(1, "total_vat"), (1, "total_cost_with_vat")} <= got and (1, "total_cost") not in got and (2, "total_cost") not in got
    fixed = waybill.accept_repairs(items.select("doc", "row", *waybill.OPERANDS), items.select("doc", "row", *waybill.OPERANDS).withColumn("round", F.lit(1)))
    assert fixed.filter("repaired").count() == 0 and fixed.count() == 4


def test_hint_trim(spark):
    from pyspark.sql import functions as F

    from quire.functions import text as T

    t = "ab" * 9 + " end"
    long = "x y z\n" * 3 + "".join(chr(0x4E00 + i) for i in range(1000)) + "\n" + "".join(chr(0x6E00 + i) for i in range(1000))
    df = spark.createDataFrame([(t,), (long,), (None,)], "t string")
    got = [r[0] for r in df.select(T.trim_hint(F.col("t"))).collect()]
    assert got == ["ab end", long[: 18 + 1000], None]


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
