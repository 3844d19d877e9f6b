"""Office documents: definitions of list numbers, scripts and macros in their XML, with the standard library.

The work on a file's bytes runs in Arrow batches; a file is a row of ``files.read``.
"""

from __future__ import annotations

import io
import zipfile
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
# Content types of a document with and without macros.
_MACRO = b"application/vnd.ms-word.document.macroEnabled.main+xml"
_PLAIN = b"application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"

LEVELS = "array<struct<abs_id:string,ilvl:int,start:int,fmt:string,text:string,restart:int,legal:boolean>>"
NUMS = "array<struct<num_id:string,abs_id:string,ilvl:int,start:int>>"
STYLES = "array<struct<style_id:string,name:string,based_on:string,num_id:string,ilvl:string>>"


def part(content: bytes, name: str) -> bytes | None:
    """A member of the package; None where it has none or is no package."""
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            return z.read(name)
    except (KeyError, zipfile.BadZipFile):
        return None


def _value(node, name: str) -> str | None:
    found = node.find(f"{_W}{name}") if node is not None else None
    return None if found is None else found.get(f"{_W}val")


def _whole(v: str | None, other: int | None = None) -> int | None:
    return int(v) if v is not None and v.lstrip("-").isdigit() else other


def levels(xml: bytes | None) -> list[dict]:
    """Levels of abstract lists."""
    if not xml:
        return []
    return [
        {
            "abs_id": a.get(f"{_W}abstractNumId"), "ilvl": int(lvl.get(f"{_W}ilvl")), "start": _whole(_value(lvl, "start"), 1),
            "fmt": _value(lvl, "numFmt") or "decimal", "text": _value(lvl, "lvlText") or "", "restart": _whole(_value(lvl, "lvlRestart")),
            "legal": lvl.find(f"{_W}isLgl") is not None,
        }
        for a in ET.fromstring(xml).iter(f"{_W}abstractNum") for lvl in a.iter(f"{_W}lvl")
    ]


def nums(xml: bytes | None) -> list[dict]:
    """Lists: their abstract list, and a row per start override."""
    out = []
    for n in ET.fromstring(xml).iter(f"{_W}num") if xml else ():
        own = {"num_id": n.get(f"{_W}numId"), "abs_id": _value(n, "abstractNumId")}
        over = [(int(o.get(f"{_W}ilvl")), _whole(_value(o, "startOverride"))) for o in n.iter(f"{_W}lvlOverride")]
        out += [own | {"ilvl": i, "start": s} for i, s in over] or [own | {"ilvl": None, "start": None}]
    return out


def styles(xml: bytes | None) -> list[dict]:
    """Paragraph styles with the list they name."""
    out = []
    for s in ET.fromstring(xml).iter(f"{_W}style") if xml else ():
        if s.get(f"{_W}type") == "paragraph":
            props = s.find(f"{_W}pPr/{_W}numPr")
            out.append({"style_id": s.get(f"{_W}styleId"), "name": _value(s, "name"), "based_on": _value(s, "basedOn"), "num_id": _value(props, "numId"), "ilvl": _value(props, "ilvl")})
    return out


def without_macros(content: bytes) -> bytes | None:
    """A macro document as a plain one: the content type of its main part is changed; None if it is no package."""
    try:
        out = io.BytesIO()
        with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
            for i in old.infolist():
                data = old.read(i.filename)
                new.writestr(i, data.replace(_MACRO, _PLAIN) if i.filename == "[Content_Types].xml" else data)
        return out.getvalue()
    except zipfile.BadZipFile:
        return None


def paragraphs(xml: bytes | None) -> list[dict]:
    """Paragraphs in order: style, list, level, and text with raised and lowered runs marked."""
    out = []
    for pos, p in enumerate(ET.fromstring(xml).iter(f"{_W}p") if xml else ()):
        props = p.find(f"{_W}pPr")
        num = props.find(f"{_W}numPr") if props is not None else None
        text = ""
        for r in p.iter(f"{_W}r"):
            run = "".join(t.text or "" for t in r.iter(f"{_W}t"))
            raised = _value(r.find(f"{_W}rPr"), "vertAlign")
            mark = {"superscript": "sup", "subscript": "sub"}.get(raised or "")
            text += f"zqx{mark}zqx{run}zqxendzqx" if mark and run else run
        out.append({"pos": pos, "style_id": _value(props, "pStyle"), "num_id": _value(num, "numId"), "ilvl": _value(num, "ilvl"), "text": text})
    return out


def _each(files: DataFrame, form: str, make) -> DataFrame:
    """A row of ``form`` per file, made of its path and bytes in one pass; a file's row is a batch of its own."""
    names = [f.name for f in StructType.fromDDL(form)]

    def run(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                row = make(None if content is None else bytes(content)) | {"path": path}
                yield pd.DataFrame({n: [row[n]] for n in names})

    return files.select("path", "content").mapInPandas(run, form)


_PARAGRAPHS = "array<struct<pos:int,style_id:string,num_id:string,ilvl:string,text:string>>"


def definitions(files: DataFrame) -> DataFrame:
    """path, levels, nums, styles, paragraphs of word documents; empty arrays where a part is missing or broken."""

    def make(content: bytes | None) -> dict:
        parts = {"levels": ("numbering", levels), "nums": ("numbering", nums), "styles": ("styles", styles), "paragraphs": ("document", paragraphs)}
        return {k: _safe(f, part(content or b"", f"word/{name}.xml")) for k, (name, f) in parts.items()}

    return _each(files, f"path string, levels {LEVELS}, nums {NUMS}, styles {STYLES}, paragraphs {_PARAGRAPHS}", make)


def _safe(f, xml: bytes | None) -> list[dict]:
    try:
        return f(xml)
    except ET.ParseError:
        return []


# a document's content in order

CONTENT = (
    "path string, error string, blocks array<struct<pos:int,heading:int,num_id:string,ilvl:int,"
    "runs:array<struct<text:string,bold:boolean,italic:boolean,url:string>>,"
    "cells:array<struct<r:int,c:int,key:string,lines:array<string>,bold:boolean,h_cont:boolean,v_cont:boolean>>>>,"
    "lists array<struct<num_id:string,abs_id:string,starts:array<int>,levels:array<struct<start:int,fmt:string,text:string,restart:int,legal:boolean>>>>"
)
_INLINE = {f"{_W}{n}" for n in ("ins", "smartTag", "sdt", "sdtContent", "fldSimple")}
_BLANK = {"start": 1, "fmt": "bullet", "text": "", "restart": None, "legal": False}
_HOPS = 20


def _on(props, name: str) -> bool:
    found = props.find(f"{_W}{name}") if props is not None else None
    return found is not None and found.get(f"{_W}val") not in ("0", "false", "off")


def _run_text(run) -> str:
    text = "".join({f"{_W}t": e.text or "", f"{_W}tab": "\t", f"{_W}br": "\n"}.get(e.tag, "") for e in run)
    mark = {"superscript": "sup", "subscript": "sub"}.get(_value(run.find(f"{_W}rPr"), "vertAlign") or "")
    return f"zqx{mark}zqx{text}zqxendzqx" if mark and text else text


def runs(p, links: dict) -> list[dict]:
    """A paragraph's runs; neighbours of one look are one."""
    out: list[dict] = []

    def walk(node, url):
        for e in node:
            if e.tag == f"{_W}hyperlink":
                walk(e, links.get(e.get(f"{_R}id")))
            elif e.tag in _INLINE:
                walk(e, url)
            elif e.tag == f"{_W}r":
                props = e.find(f"{_W}rPr")
                look = {"bold": _on(props, "b"), "italic": _on(props, "i"), "url": url}
                text = _run_text(e)
                if out and all(out[-1][k] == v for k, v in look.items()):
                    out[-1]["text"] += text
                elif text:
                    out.append({"text": text} | look)

    walk(p, None)
    return out


def _children(node, name: str):
    """Children of a kind, those in content controls included."""
    for e in node:
        if e.tag == f"{_W}{name}":
            yield e
        elif e.tag in (f"{_W}sdt", f"{_W}sdtContent"):
            yield from _children(e, name)


def _cell(tc, links: dict) -> tuple[list[str], bool]:
    """Lines of a cell, list items marked, rows of tables in it joined by semicolons; whether all of it is bold."""
    lines, looks = [], []
    for e in tc:
        if e.tag == f"{_W}tbl":
            for tr in _children(e, "tr"):
                texts = [" ".join(_cell(c, links)[0]) for c in _children(tr, "tc")]
                lines.append("; ".join(dict.fromkeys(t for t in texts if t)))
        for p in [e] if e.tag == f"{_W}p" else _children(e, "p") if e.tag == f"{_W}sdt" else ():
            found = runs(p, links)
            looks += [r["bold"] for r in found if r["text"].strip()]
            listed = p.find(f"{_W}pPr/{_W}numPr") is not None
            texts = [" ".join(t.split()) for t in "".join(r["text"] for r in found).split("\n")]
            lines += [f"- {t}" if listed and not t.startswith("- ") else t for t in texts if t]
    return [t for t in lines if t], bool(looks) and all(looks)


def cells(tbl, links: dict) -> list[dict]:
    """The grid of a table: a merged cell stands at every place that it covers; short rows are filled up."""
    rows: list[list[dict]] = []
    for r, tr in enumerate(_children(tbl, "tr")):
        row: list[dict] = []
        for tc in _children(tr, "tc"):
            props = tc.find(f"{_W}tcPr")
            merge = props.find(f"{_W}vMerge") if props is not None else None
            above = rows[-1][len(row)] if rows and len(row) < len(rows[-1]) else None
            goes_on = merge is not None and merge.get(f"{_W}val", "continue") == "continue" and above is not None
            if goes_on:
                own = {k: above[k] for k in ("key", "lines", "bold")}
            else:
                lines, bold = _cell(tc, links)
                own = {"key": f"{r},{len(row)}", "lines": lines, "bold": bold}
            for k in range(max(1, _whole(_value(props, "gridSpan"), 1) or 1)):
                row.append(own | {"r": r, "c": len(row), "h_cont": k > 0, "v_cont": goes_on})
        rows.append(row)
    width = max(map(len, rows), default=0)
    for r, row in enumerate(rows):
        row += [{"r": r, "c": c, "key": f"{r},{c}", "lines": [], "bold": False, "h_cont": False, "v_cont": False} for c in range(len(row), width)]
    return [c for row in rows for c in row]


def _lists(xml: bytes | None) -> list[dict]:
    by_abs: dict = {}
    for lvl in levels(xml):
        by_abs.setdefault(lvl["abs_id"], {})[lvl["ilvl"]] = {k: lvl[k] for k in _BLANK}
    out: dict = {}
    for n in nums(xml):
        own = by_abs.get(n["abs_id"], {})
        row = out.setdefault(n["num_id"], {"num_id": n["num_id"], "abs_id": n["abs_id"], "starts": [None] * 9, "levels": [own.get(i, _BLANK) for i in range(9)]})
        if n["ilvl"] is not None and 0 <= n["ilvl"] < 9:
            row["starts"][n["ilvl"]] = n["start"]
    return list(out.values())


def _style_facts(xml: bytes | None) -> dict:
    """Per style: heading level, list and level in it, each of the nearest style up the chain that says."""
    own = {}
    for s in styles(xml):
        name = (s["name"] or s["style_id"] or "").lower().replace(" ", "")
        level = 1 if name == "title" else int(name[7:]) if name.startswith("heading") and name[7:].isdigit() else None
        own[s["style_id"]] = s | {"heading": level or None}
    out = {}
    for style_id in own:
        at, fact = style_id, dict.fromkeys(("heading", "num_id", "ilvl"))
        for _ in range(_HOPS):
            if at not in own:
                break
            fact = {k: own[at][k] if v is None else v for k, v in fact.items()}
            at = own[at]["based_on"]
        out[style_id] = fact
    return out


def _links(xml: bytes | None) -> dict:
    return {e.get("Id"): e.get("Target") for e in ET.fromstring(xml) if e.get("TargetMode") == "External"} if xml else {}


def blocks(content: bytes | None) -> dict:
    """error, blocks, lists of a document: paragraphs and tables in order, with what their styles say."""
    none = {"error": "unreadable document", "blocks": [], "lists": []}
    xml = part(content or b"", "word/document.xml")
    if xml is None:
        return none
    try:
        body = ET.fromstring(xml).find(f"{_W}body")
        facts, lists = _style_facts(part(content, "word/styles.xml")), _lists(part(content, "word/numbering.xml"))
        links = _links(part(content, "word/_rels/document.xml.rels"))
    except ET.ParseError:
        return none
    known, out = {n["num_id"] for n in lists}, []

    def walk(node):
        for e in node:
            empty = {"pos": len(out), "heading": None, "num_id": None, "ilvl": None, "runs": [], "cells": []}
            if e.tag == f"{_W}tbl":
                out.append(empty | {"cells": cells(e, links)})
            elif e.tag == f"{_W}p":
                props = e.find(f"{_W}pPr")
                num = props.find(f"{_W}numPr") if props is not None else None
                style = facts.get(_value(props, "pStyle"), {})
                num_id, ilvl = _value(num, "numId") or style.get("num_id"), _value(num, "ilvl") or style.get("ilvl")
                num_id = num_id if num_id in known else None
                at = min(8, max(0, _whole(ilvl, 0))) if num_id else None
                out.append(empty | {"heading": style.get("heading"), "num_id": num_id, "ilvl": at, "runs": runs(e, links)})
            elif e.tag in (f"{_W}sdt", f"{_W}sdtContent"):
                walk(e)

    walk(body if body is not None else [])
    return {"error": None, "blocks": out, "lists": lists}


def content(files: DataFrame) -> DataFrame:
    """path, error, blocks, lists (``CONTENT``) of word documents; one that can't be read has an error and no blocks."""
    return _each(files, CONTENT, blocks)


def plain_documents(files: DataFrame) -> DataFrame:
    """files whose macro documents are plain ones."""
    is_macro = F.lower("path").endswith(".docm")

    @F.pandas_udf("binary")
    def run(contents: pd.Series) -> pd.Series:
        return contents.map(lambda b: without_macros(bytes(b)), na_action="ignore")

    return files.withColumn("content", F.when(is_macro, run("content")).otherwise(F.col("content")))
