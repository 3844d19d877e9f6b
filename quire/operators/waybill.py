"""Waybills: checks of printed arithmetic, pages to documents, merges of partial readings, repairs.

Tables carry explicit keys for order (file, page, row); no operator relies on row order.
Amounts are strings as printed; checks parse them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from ..functions.numbers import NUMBER, with_numbers, words_to_amount
from ..functions.text import form_number, null_text, series

# Tolerances of the checks.
KOPECK, PER_UNIT, VAT_SLACK, MASS_SLACK = "0.011", "0.005", "0.02", "0.0011"
TOTALS = {"cost": KOPECK, "vat": KOPECK, "cost_with_vat": KOPECK, "mass": MASS_SLACK, "places": MASS_SLACK}
ITEM_FIELDS = ("n", "name", "unit", "quantity", "price", "cost", "vat_rate", "vat", "cost_with_vat", "places", "mass", "note")
KINDS = ("front", "continuation", "back", "other")

ITEM = "struct<" + ",".join(f"{f}:string" for f in ITEM_FIELDS) + ",page:int>"
PARTY = "struct<name:string,unp:string,address:string>"
TOTAL = (
    "struct<quantity:string,cost:string,vat:string,cost_with_vat:string,places:string,mass:string,"
    "vat_words:string,cost_with_vat_words:string,mass_words:string,places_words:string>"
)
WAYBILL = (
    f"struct<form:string,series:string,number:string,date:string,shipper:{PARTY},consignee:{PARTY},carrier_customer:{PARTY},"
    "basis:string,loading_point:string,unloading_point:string,vehicle:string,trailer:string,waybill:string,driver:string,"
    f"released_by:string,handed_by:string,accepted_by:string,power_of_attorney:string,seal:string,items:array<{ITEM}>,totals:{TOTAL}>"
)


OPERANDS = ["quantity", "price", "cost", "vat_rate", "vat", "cost_with_vat"]


def _dec(x: str) -> Column:
    return F.lit(x).cast("decimal(18,6)")


def _issue(code: str, wrong: Column, level: str = "error") -> Column:
    return F.when(wrong, F.struct(F.lit(code).alias("code"), F.lit(level).alias("level")))


def wrong_rows() -> dict[str, Column]:
    """Whether an item row fails each check, of columns made by ``with_numbers``; a check with an operand
    that is unread, or whose product passes 38 digits, is skipped."""
    q, p, c, rate, vat, total = (F.col(f"_n_{k}") for k in OPERANDS)
    off = lambda a, b: F.abs(F.try_subtract(a, b))
    found = {
        "row_cost": off(F.try_multiply(q, p), c) > F.try_add(_dec(KOPECK), F.try_multiply(F.abs(q), _dec(PER_UNIT))),
        "row_vat": off(F.try_multiply(F.try_multiply(c, rate), _dec("0.01")), vat) > _dec(VAT_SLACK),
        "row_total": off(F.try_add(c, F.coalesce(vat, _dec("0"))), total) > _dec(KOPECK),
    }
    return {k: F.coalesce(v, F.lit(False)) for k, v in found.items()}


def check_items(items: DataFrame) -> DataFrame:
    """doc, row, code, level: arithmetic that does not hold within a row."""
    parsed = with_numbers(items.select("doc", "row", *OPERANDS), OPERANDS)
    found = F.array_compact(F.array(*[_issue(k, v) for k, v in wrong_rows().items()]))
    return parsed.filter(_any(wrong_rows())).select("doc", "row", F.inline(found))


def _any(wrong: dict[str, Column]) -> Column:
    a, *rest = wrong.values()
    for b in rest:
        a = a | b
    return a


def check_totals(items: DataFrame, totals: DataFrame) -> DataFrame:
    """doc, code, level, stated, summed: printed totals that differ from the sums of rows, or from their words.

    items and totals have doc and the fields of TOTALS; totals may have ``*_words``."""
    parsed = with_numbers(items.select("doc", *TOTALS), list(TOTALS))
    sums = parsed.groupBy("doc").agg(*[F.try_sum(f"_n_{k}").try_cast(NUMBER).alias(f"_sum_{k}") for k in TOTALS])
    both = with_numbers(totals, list(TOTALS)).join(sums, "doc", "left")
    spelled = [k for k in ("cost_with_vat", "vat") if f"{k}_words" in totals.columns]
    both = both.withColumns({f"_said_{k}": words_to_amount(F.col(f"{k}_words")).try_cast(NUMBER) for k in spelled})
    pairs = [(f"total_{k}", F.col(f"_n_{k}"), F.col(f"_sum_{k}"), slack) for k, slack in TOTALS.items()]
    pairs += [(f"words_{k}", F.col(f"_n_{k}"), F.col(f"_said_{k}"), KOPECK) for k in spelled]
    found = []
    for code, stated, other, slack in pairs:
        row = F.struct(F.lit(code).alias("code"), stated.alias("stated"), other.alias("summed"))
        found.append(F.when(F.abs(F.try_subtract(stated, other)) > _dec(slack), row))
    rows = both.select("doc", F.inline(F.array_compact(F.array(*found))))
    return rows.select("doc", "code", F.lit("error").alias("level"), "stated", "summed")


def date_ok(c: Column, as_of: str) -> Column:
    """A real date, day first, from 2000 to 31 days after ``as_of``; two-digit years are of this century."""
    form = r"\A(\d{1,2})[./-](\d{1,2})[./-](\d{2}|\d{4})\z"
    t = F.btrim(c)
    y = F.regexp_extract(t, form, 3)
    y = F.when(F.length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y)
    text = F.concat_ws("-", y, F.lpad(F.regexp_extract(t, form, 2), 2, "0"), F.lpad(F.regexp_extract(t, form, 1), 2, "0"))
    day = F.when(F.regexp_like(t, F.lit(form)), text.try_cast("date"))
    return F.coalesce((day >= F.lit("2000-01-01").cast("date")) & (day <= F.date_add(F.lit(as_of).cast("date"), 31)), F.lit(False))


def check_requisites(heads: DataFrame, items: DataFrame | None, as_of: str) -> DataFrame:
    """doc, code, level for headers (doc, series, number, date, shipper_unp, consignee_unp):
    unread fields are warnings, malformed ones and documents without items errors."""

    def field(code: str, c: Column, fine: Column) -> Column:
        unread = c.isNull() | (c == "")
        return F.when(unread, F.struct(F.lit(code).alias("code"), F.lit("warning").alias("level"))).when(
            ~fine, F.struct(F.lit(code).alias("code"), F.lit("error").alias("level"))
        )

    like = lambda c, form: F.regexp_like(F.col(c), F.lit(form))
    found = [
        field("series", F.col("series"), like("series", r"\A[А-ЯA-Z]{2}\z")),
        field("number", F.col("number"), like("number", r"\A\d{7}\z")),
        field("date", F.col("date"), date_ok(F.col("date"), as_of)),
        *(field(f"{k}_unp", F.col(f"{k}_unp"), like(f"{k}_unp", r"\A\d{9}\z")) for k in ("shipper", "consignee")),
    ]
    out = heads.select("doc", F.inline(F.array_compact(F.array(*found))))
    if items is not None:
        bare = heads.select("doc").join(items.select("doc"), "doc", "left_anti")
        out = out.unionByName(bare.select("doc", F.lit("items").alias("code"), F.lit("error").alias("level")))
    return out


def validate(heads: DataFrame, items: DataFrame, totals: DataFrame, as_of: str) -> DataFrame:
    """doc, part, row, code, level of all checks: requisites, rows, totals."""
    null_row = F.lit(None).cast("int").alias("row")
    a = check_requisites(heads, items, as_of).select("doc", F.lit(1).alias("part"), null_row, "code", "level")
    b = check_items(items).select("doc", F.lit(2).alias("part"), F.col("row").cast("int"), "code", "level")
    c = check_totals(items, totals).select("doc", F.lit(3).alias("part"), null_row, "code", "level")
    return a.unionByName(b).unionByName(c)


def status(docs: DataFrame, issues: DataFrame) -> DataFrame:
    """doc, errors, warnings, status: check if anything is wrong, else ok."""
    n = issues.groupBy("doc").agg(
        F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warning").alias("warnings")
    )
    out = docs.select("doc").join(n, "doc", "left").na.fill(0, ["errors", "warnings"])
    return out.withColumn("status", F.when(F.col("errors") + F.col("warnings") > 0, "check").otherwise("ok"))


def page_kinds(pages: DataFrame) -> DataFrame:
    """Adds kind (a readable answer, else front or, in an open document, continuation) and excluded.

    pages: file, page, kind_raw, zones_source, has_table."""
    said = F.element_at(F.split(F.lower(F.coalesce(F.btrim("kind_raw"), F.lit(""))), r"\s+"), 1)
    known = said.isin(*KINDS)
    aside = (said == "back") | ((said == "other") & (F.coalesce("zones_source", F.lit("")) != "layout"))
    excluded = known & aside & ~F.col("has_table")
    before = W.partitionBy("file").orderBy("page").rowsBetween(W.unboundedPreceding, -1)
    p = pages.withColumn("excluded", excluded)
    open_ = F.coalesce(F.max(~F.col("excluded")).over(before), F.lit(False))
    return p.withColumn("kind", F.when(known, said).when(open_, "continuation").otherwise("front"))


def segment(pages: DataFrame) -> DataFrame:
    """Adds doc (from 1 within a file; null before any): fronts open a document once the current one holds something.

    pages: file, page, kind, excluded, has_number, has_items. Without recursion: number the stretches
    between fronts; a front is a boundary if it is the first kept page or the stretch before it
    contributed a number or items. What stretches hold is an aggregate, so windows do it all."""
    by_file = W.partitionBy("file").orderBy("page")
    kept = ~F.col("excluded")
    front = kept & (F.col("kind") == "front")
    p = pages.withColumn("_g", F.sum(front.cast("int")).over(by_file))
    holds = kept & (F.col("has_items") | (front & F.col("has_number")))
    p = p.withColumn("_s", F.max(holds).over(W.partitionBy("file", "_g")))
    p = p.withColumn("_nth", F.sum(kept.cast("int")).over(by_file))
    # the stretch before a front's own is what the page before it belongs to
    held = F.coalesce(F.lag("_s").over(by_file), F.lit(False))
    first = kept & (F.col("_nth") == 1)
    p = p.withColumn("_b", (first | (front & held)).cast("int"))
    doc = F.sum("_b").over(by_file)
    return p.withColumn("doc", F.when((F.col("kind") == "other") & F.col("excluded"), None).when(doc > 0, doc)).drop("_g", "_s", "_nth", "_b")


def copies(pages: DataFrame) -> DataFrame:
    """Adds copy_of: the first page of the document with the same list of (name, quantity, cost).

    pages: file, doc, page, signature (the list as an array; empty ones are no copies)."""
    first = F.min("page").over(W.partitionBy("file", "doc", "signature"))
    is_copy = (F.size("signature") > 0) & (F.col("page") > first)
    return pages.withColumn("copy_of", F.when(is_copy, first))


def without_adjacent_repeats(rows: DataFrame) -> DataFrame:
    """Rows without those that repeat the one before on the page (same n, name, cost, quantity; name read).

    rows: file, page, row and those fields, without rows of totals."""
    w = W.partitionBy("file", "page").orderBy("row")
    key = F.struct("n", "name", "cost", "quantity")
    return rows.withColumn("_p", F.lag(key).over(w)).filter(~(F.col("name").isNotNull() & key.eqNullSafe(F.col("_p")))).drop("_p")


def first_read(rows: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """Per key, each field's first value in order that was read; a struct of the order breaks no ties silently."""
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(*[F.min_by(f, F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields])


def last_read(rows: DataFrame, keys: list[str], order: list[str], fields: list[str]) -> DataFrame:
    """Per key, each field's last value in order that was read."""
    at = F.struct(*order)
    return rows.groupBy(*keys).agg(*[F.max_by(f, F.when(F.col(f).isNotNull(), at)).alias(f) for f in fields])


def accept_repairs(items: DataFrame, candidates: DataFrame) -> DataFrame:
    """items (doc, row, fields), each row that fails a check replaced by its first candidate (doc, row, round,
    fields) that passes all and does not change quantity, price and cost together."""
    fields = [c for c in items.columns if c not in ("doc", "row")]
    fails = _any(wrong_rows())
    keys = ["quantity", "price", "cost"]
    old = with_numbers(items, OPERANDS).filter(fails).select("doc", "row", *[F.col(f"_n_{c}").alias(f"_{c}") for c in keys])
    good = with_numbers(candidates, OPERANDS).filter(~fails).join(old, ["doc", "row"])
    same = [F.col(f"_n_{c}").eqNullSafe(F.col(f"_{c}")) for c in keys]
    good = good.filter(same[0] | same[1] | same[2])
    best = good.groupBy("doc", "row").agg(F.min_by(F.struct(*fields), "round").alias("_new"))
    out = items.join(best, ["doc", "row"], "left")
    pick = [F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(F.col(c)).alias(c) for c in fields]
    return out.select("doc", "row", *pick, F.col("_new").isNotNull().alias("repaired"))


def pen_overlay(rows: DataFrame, strips: DataFrame) -> DataFrame:
    """rows (file, page, row, top, bottom, name) with the handwriting of the strips (file, page, k, top,
    bottom, text) that lie, by over half their height, in exactly one row; the last strip wins."""
    s = strips.filter(F.regexp_like("text", F.lit(r"[\p{L}\p{N}]")) & ~F.col("text").contains("[...]"))
    s = s.select("file", "page", "k", F.col("top").alias("_t"), F.col("bottom").alias("_b"), "text")
    overlap = F.least("bottom", "_b") - F.greatest("top", "_t")
    hits = s.join(rows.select("file", "page", "row", "top", "bottom"), ["file", "page"]).filter(2 * overlap > F.col("_b") - F.col("_t"))
    one = hits.groupBy("file", "page", "k").agg(F.count(F.lit(1)).alias("n"), F.first("row").alias("row"), F.first("text").alias("text"))
    one = one.filter("n = 1").groupBy("file", "page", "row").agg(F.max_by("text", "k").alias("pen"))
    out = rows.join(one, ["file", "page", "row"], "left")
    return out.withColumn("name", F.coalesce("pen", "name")).withColumn("by_hand", F.col("pen").isNotNull()).drop("pen")


# answers of a model to records

HEAD_FIELDS = (
    "form", "series", "number", "date", "basis", "loading_point", "unloading_point", "vehicle", "trailer", "waybill", "driver",
    "released_by", "handed_by", "accepted_by", "power_of_attorney", "seal",
)
PARTIES = ("shipper", "consignee", "carrier_customer")
TOTAL_FIELDS = ("quantity", "cost", "vat", "cost_with_vat", "places", "mass", "vat_words", "cost_with_vat_words", "mass_words", "places_words")


def _field(v: Column, name: str) -> Column:
    return null_text(F.try_variant_get(v, f"$.{name}", "string"))


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _item(v: Column, page: Column) -> Column:
    return F.struct(*[_field(v, f).alias(f) for f in ITEM_FIELDS], page.alias("page"))


def _party(v: Column) -> Column:
    """A text is the name; an object has the fields; all else says nothing."""
    name = F.when(_is(v, "STRING"), null_text(F.try_variant_get(v, "$", "string"))).otherwise(_field(v, "name"))
    unp = F.regexp_replace(_field(v, "unp"), r"(?U)\s", "")
    return F.struct(name.alias("name"), unp.alias("unp"), _field(v, "address").alias("address"))


def coerce_item(answer: Column, page: Column | None = None) -> Column:
    """A struct of an item's fields from a model's JSON object (a string), read tolerantly."""
    return _item(F.try_parse_json(answer), F.lit(None).cast("int") if page is None else page)


def coerce_totals(answer: Column) -> Column:
    v = F.try_parse_json(answer)
    return F.struct(*[_field(v, f).alias(f) for f in TOTAL_FIELDS])


def coerce_waybill(answer: Column, page: Column | None = None) -> Column:
    """A record (``WAYBILL``) from a model's JSON object (a string): unknown keys go, numbers are texts, words for
    nothing are null, items that are no objects go. What is no JSON object is a record without values or items."""
    v = F.try_parse_json(answer)
    at = F.lit(None).cast("int") if page is None else page
    head = {f: _field(v, f) for f in HEAD_FIELDS}
    head["series"], head["number"] = series(head["series"]), form_number(head["number"])
    head |= {f: _party(F.try_variant_get(v, f"$.{f}", "variant")) for f in PARTIES}
    items = F.filter(F.try_variant_get(v, "$.items", "array<variant>"), lambda x: _is(x, "OBJECT"))
    head["items"] = F.coalesce(F.transform(items, lambda x: _item(x, at)), F.array().cast(f"array<{ITEM}>"))
    totals = F.try_variant_get(v, "$.totals", "variant")
    head["totals"] = F.struct(*[_field(totals, f).alias(f) for f in TOTAL_FIELDS])
    names = [part.split(":")[0] for part in _fields_of(WAYBILL)]
    return F.struct(*[head[n].alias(n) for n in names])


def _fields_of(form: str) -> list[str]:
    """The members of a struct type's text, cut at commas outside brackets."""
    out, depth = [""], 0
    for ch in form[len("struct<") : -1]:
        depth += {"<": 1, ">": -1}.get(ch, 0)
        if ch == "," and depth == 0:
            out.append("")
        else:
            out[-1] += ch
    return out
