"""Queries over whole texts: what stands late in a long text, or in a late turn, reaches the result."""

from quire.plans import catalog
from quire.plans.inputs import BOXES, derived


def _documents(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def _lines(text):
    for pos, head in enumerate(text.split("\n")):
        a, b = 1 + pos % 3, 1 + pos % 2
        num = ["", f"{a}", f"{a}.{b}", f"{a}.{b}.1"][pos % 4]
        yield pos, num, f"{num} {head}" if num else head, pos % 8 == 1, pos % 11 == 5


def test_headings_of_whole_texts(spark, tmp_path):
    late = "\n".join(["words that go on, and on."] * 60 + ["Late Heading"] * 40)
    texts = {100: late, 101: "Short one\nSecond Line\nTHIRD", 102: "", 103: None}
    want = set()
    for doc, text in texts.items():
        known = set()
        for pos, num, line, bold, in_list in _lines(text or ""):
            letters = "".join(c for c in line if c.isalpha())
            if not line or len(line) > 100 or line[-1] in ".,;:" or len(letters) < 3:
                continue
            if in_list:
                level = 1 if letters.isupper() else None
            elif bold or (num and letters.isupper()) or (num and num.rpartition(".")[0] in known):
                level = num.count(".") + 1
                known |= {num} - {""}
            else:
                level = None
            if level is not None:
                want.add((doc, pos, level))
    assert any(pos > 60 for doc, pos, _ in want if doc == 100)
    got = {tuple(r) for r in catalog.q21_heading_level(spark, _documents(spark, tmp_path, list(texts.items()))).collect()}
    assert got == want


def test_markers_late_in_a_body(spark, tmp_path):
    text = "x" * 100 + " [TABLE 1] end"
    got = catalog.q41_marker_merge(spark, _documents(spark, tmp_path, [(30, text)])).collect()
    assert [tuple(r) for r in got] == [(30, "<t30>\n" + "x" * 100 + "  end\n<fig> and  \n\n<late>")]


def _conversations(spark, path, rows):
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    return str(path)


def test_links_of_every_turn(spark, tmp_path):
    rows = [(c, t, "user", "x") for c in (1, 2) for t in range(25)]
    got = {tuple(r) for r in catalog.q42_enrich_first_link(spark, _conversations(spark, tmp_path, rows)).collect()}
    want = {(c, t, 2, 1 if c % 2 == 0 else 2, f"img-{t % 3}", f"a{t}") for c, t, _, _ in rows}
    assert got == want | {(c, t, 3, 3, "my pic", "d") for c, t, _, _ in rows if (c + t) % 7}


def test_every_box_goes_to_one_side_of_the_fusion(spark, sf, monkeypatch):
    sides = []
    monkeypatch.setattr(catalog.layout, "fuse", lambda dets, ruled, *a: sides.extend([dets, ruled]))
    catalog.q39b_layout_fusion(spark, sf)
    dets, ruled = ([tuple(r) for r in x.select("page", "ord").collect()] for x in sides)
    assert sorted(dets + ruled) == sorted(tuple(r) for r in derived(spark, sf, BOXES).select("page", "id").collect())


def test_whole_texts_of_conversations(spark, tmp_path):
    long = "word " * 50 + "end"  # 253 characters
    rows = [(c, t, "assistant", f"{t} {long}") for c in (1, 2) for t in (0, 1, 2, 3, 104)]
    path = _conversations(spark, tmp_path, rows)
    assert {tuple(r) for r in catalog.q13_header_first_nonnull(spark, path).collect()} == {(c, f"104 {long}", f"0 {long}") for c in (1, 2)}
    got = {(r["conv_id"], r["turn"]): tuple(r)[2:] for r in catalog.q46_sections(spark, path).collect()}
    want = {0: (f"0 {long}", None, "second"), 1: (f"just 1 {long}", None, None), 2: (None, f"2 {long}\nmore", None), 3: (None, None, None), 104: (f"104 {long}", None, "second")}
    assert got == {(c, t): want[t] for c, t, _, _ in rows}


def test_long_text_is_no_caption_title(spark, tmp_path):
    rows = [(2, 0, "user", "a"), (2, 1, "user", "b"), (2, 2, "user", "c"), (2, 3, "user", "d" * 300), (6, 0, "user", "a"), (6, 1, "user", "b"), (6, 2, "user", "c"), (6, 3, "user", "d" * 150)]
    got = {r["doc"]: r["alt"] for r in catalog.q40_captions_neighbours(spark, _conversations(spark, tmp_path, rows)).collect()}
    assert got == {2: "Рисунок 2", 6: "Рисунок 2 – plain " + "d" * 150}
