"""The catalogue: one query per operator group over the driver's tables, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ..functions import geometry as G
from ..functions import numbers as N
from ..functions import text as T
from ..operators import answers, documents, layout, markdown, numbering, prompts, tables, waybill
from ..sources import files
from .inputs import BOXES, CENTS, ITEMS, LINES, LINES_DUCK, PAGES, derived, duck, money, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = duck(sql)
        return f

    return add


def _items(spark, sf):
    return derived(spark, sf, ITEMS).withColumnRenamed("rownum", "row")


def _boxes(spark, sf):
    return derived(spark, sf, BOXES).select("page", "id", "role", "score", F.struct("l", "t", "r", "b").alias("box"))


def _flat(df, *rest):
    return df.select(*rest, "box.l", "box.t", "box.r", "box.b")


# numbers and words

_STYLES = """SELECT l_orderkey AS doc, l_linenumber AS line, l_partkey AS part, c, CASE l_partkey % 6
  WHEN 0 THEN concat(th, ' ', lpad(concat(un, ''), 3, '0'), ',', ct) WHEN 1 THEN concat(th, '.', lpad(concat(un, ''), 3, '0'), ',', ct)
  WHEN 2 THEN concat(th, ',', lpad(concat(un, ''), 3, '0'), '.', ct) WHEN 3 THEN concat(' ', th * 1000 + un, '.', ct, ' руб.')
  WHEN 4 THEN concat('-', th * 1000 + un, ',', ct, '%') ELSE 'нет данных' END AS printed FROM (
  SELECT *, cast(floor(c / 100000) as bigint) AS th, cast(floor(c / 100) as bigint) % 1000 AS un, lpad(concat(c % 100, ''), 2, '0') AS ct FROM (
  SELECT *, cast(round(l_extendedprice * 100) as bigint) AS c FROM {lineitem}) AS a) AS b"""


@query(f"SELECT doc, line, part, printed, CASE part % 6 WHEN 5 THEN NULL WHEN 4 THEN -c / 100.0 ELSE c / 100.0 END::DOUBLE AS amount FROM ({_STYLES})")
def q01_number_parse(spark, sf):
    return derived(spark, sf, _STYLES).select("doc", "line", "part", "printed", N.to_number(F.col("printed")).cast("double").alias("amount"))


_NULLS = """SELECT o_orderkey AS doc, CASE o_orderkey % 7 WHEN 0 THEN ' None ' WHEN 1 THEN concat('  ', o_orderpriority, '  x') WHEN 2 THEN '—'
  WHEN 3 THEN '' WHEN 4 THEN 'НЕТ' WHEN 5 THEN NULL ELSE o_orderpriority END AS raw FROM {orders}"""


@query(
    f"""SELECT doc, CASE WHEN t = '' OR lower(t) IN ('null', 'none', '-', '—', 'нет') THEN NULL ELSE t END AS text
  FROM (SELECT doc, trim(regexp_replace(raw, '\\s+', ' ', 'g')) AS t FROM ({_NULLS}))"""
)
def q02_null_text(spark, sf):
    return derived(spark, sf, _NULLS).select("doc", T.null_text(F.col("raw")).alias("text"))


_SERIES = "SELECT p_partkey AS part, concat(substring(p_brand, 1, 2), ' .', lower(substring('ABCEHKMOPTXY', cast(p_partkey % 11 as int) + 1, 2))) AS raw, concat('№ ', p_size, '-', p_partkey) AS num FROM {part}"


@query(
    f"""SELECT part, translate(upper(regexp_replace(raw, '[\\s.]', '', 'g')), 'ABCEHKMOPTXY', 'АВСЕНКМОРТХУ') AS series,
  regexp_replace(replace(num, '№', ''), '[^\\w]', '', 'g') AS number FROM ({_SERIES})"""
)
def q03_series_homoglyph(spark, sf):
    return derived(spark, sf, _SERIES).select("part", T.series(F.col("raw")).alias("series"), T.form_number(F.col("num")).alias("number"))


_HUNDREDS = "сто двести триста четыреста пятьсот шестьсот семьсот восемьсот девятьсот".split()
_TENS = "двадцать тридцать сорок пятьдесят шестьдесят семьдесят восемьдесят девяносто".split()
_pick = lambda words, at: f"CASE {at} " + " ".join(f"WHEN {i + 1} THEN '{w}'" for i, w in enumerate(words)) + " ELSE '' END"
_WORDS = f"""SELECT o_orderkey AS doc, h, t, k, concat({_pick(_HUNDREDS, 'h')}, ' ', {_pick(_TENS, 't')}, ' тысяч ', 'Пять рублей ', k, ' копеек') AS said FROM (
  SELECT o_orderkey, cast(1 + o_orderkey % 9 as int) AS h, cast(1 + o_orderkey % 8 as int) AS t, cast(10 + o_orderkey % 90 as int) AS k FROM {{orders}}) AS x"""


@query(f"SELECT doc, said, ((h * 100 + (t + 1) * 10) * 1000 + 5 + k / 100.0)::DOUBLE AS amount FROM ({_WORDS})")
def q04_words_amount(spark, sf):
    return derived(spark, sf, _WORDS).select("doc", "said", N.words_to_amount(F.col("said")).cast("double").alias("amount"))


# checks

_ROW_ISSUES = f"""SELECT doc, n AS "row", 'row_cost' AS code, 'error' AS level FROM ({CENTS}) WHERE abs(qty * p - c) * 10 > 11 + 5 * qty
  UNION ALL SELECT doc, n, 'row_vat', 'error' FROM ({CENTS}) WHERE abs(c * rate - vat * 100) > 200
  UNION ALL SELECT doc, n, 'row_total', 'error' FROM ({CENTS}) WHERE abs(c + vat - total) * 10 > 11"""


@query(_ROW_ISSUES)
def q05_row_checks(spark, sf):
    return waybill.check_items(_items(spark, sf))


_SUMS = f"SELECT doc, sum(c) AS c, sum(vat) AS vat, sum(total) AS total, sum(qty % 7) AS places, sum(qty * 20 + 5) AS mass10 FROM ({CENTS}) AS i GROUP BY doc"
# printed totals: right but for some orders
_STATED = f"""SELECT doc, {money('c + CASE WHEN doc % 5 = 0 THEN 2 ELSE 0 END')} AS cost, {money('vat')} AS vat, {money('total + CASE WHEN doc % 6 = 1 THEN 300 ELSE 0 END')} AS cost_with_vat,
  concat(places + CASE WHEN doc % 9 = 4 THEN 1 ELSE 0 END, '') AS places, concat(cast(floor(mass10 / 10) as bigint), '.', mass10 % 10) AS mass FROM ({_SUMS}) AS s"""
_TOTAL_ISSUES = f"""SELECT doc, 'total_cost' AS code, 'error' AS level, (c + 2) / 100.0 AS stated, c / 100.0 AS summed FROM ({_SUMS}) WHERE doc % 5 = 0
  UNION ALL SELECT doc, 'total_cost_with_vat', 'error', (total + 300) / 100.0, total / 100.0 FROM ({_SUMS}) WHERE doc % 6 = 1
  UNION ALL SELECT doc, 'total_places', 'error', places + 1, places FROM ({_SUMS}) WHERE doc % 9 = 4"""


@query(f"SELECT doc, code, level, stated::DOUBLE AS stated, summed::DOUBLE AS summed FROM ({_TOTAL_ISSUES})")
def q06_totals_checks(spark, sf):
    out = waybill.check_totals(_items(spark, sf), derived(spark, sf, _STATED))
    return out.withColumn("stated", F.col("stated").cast("double")).withColumn("summed", F.col("summed").cast("double"))


_HEADS = """SELECT o_orderkey AS doc, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'АВС' ELSE 'АВ' END AS series,
  CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '12345' ELSE lpad(concat(o_orderkey % 9999999, ''), 7, '0') END AS number,
  CASE o_orderkey % 6 WHEN 0 THEN '31.02.2024' WHEN 1 THEN '5/6/21' WHEN 2 THEN '01-13-2020' WHEN 3 THEN NULL WHEN 4 THEN '15.08.2031' ELSE '7.11.2023' END AS date,
  CASE WHEN o_custkey % 3 = 0 THEN '12345678' ELSE '190000001' END AS shipper_unp, CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE '190000002' END AS consignee_unp FROM {orders}"""
_AS_OF = "2024-06-01"
_HEAD_ISSUES = f"""SELECT doc, 'series' AS code, CASE WHEN series IS NULL THEN 'warning' ELSE 'error' END AS level FROM ({_HEADS}) WHERE doc % 4 < 2
  UNION ALL SELECT doc, 'number', CASE WHEN doc % 5 = 0 THEN 'warning' ELSE 'error' END FROM ({_HEADS}) WHERE doc % 5 < 2
  UNION ALL SELECT doc, 'date', CASE WHEN doc % 6 = 3 THEN 'warning' ELSE 'error' END FROM ({_HEADS}) WHERE doc % 6 IN (0, 2, 3, 4)
  UNION ALL SELECT doc, 'shipper_unp', 'error' FROM ({_HEADS}) WHERE shipper_unp = '12345678'
  UNION ALL SELECT doc, 'consignee_unp', 'warning' FROM ({_HEADS}) WHERE consignee_unp IS NULL
  UNION ALL SELECT o_orderkey, 'items', 'error' FROM {{orders}} WHERE o_orderkey NOT IN (SELECT l_orderkey FROM {{lineitem}})"""


@query(_HEAD_ISSUES)
def q07_requisites(spark, sf):
    items = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("doc"))
    return waybill.check_requisites(derived(spark, sf, _HEADS), items, _AS_OF)


_ALL_ISSUES = f"""SELECT doc, 1 AS part, NULL::INT AS "row", code, level FROM ({_HEAD_ISSUES})
  UNION ALL SELECT doc, 2, "row", code, level FROM ({_ROW_ISSUES})
  UNION ALL SELECT doc, 3, NULL, code, level FROM ({_TOTAL_ISSUES})"""


def _validated(spark, sf):
    return waybill.validate(derived(spark, sf, _HEADS), _items(spark, sf), derived(spark, sf, _STATED), _AS_OF)


@query(_ALL_ISSUES)
def q08_validate_union(spark, sf):
    return _validated(spark, sf)


@query(
    f"""SELECT o_orderkey AS doc, coalesce(e, 0)::BIGINT AS errors, coalesce(w, 0)::BIGINT AS warnings, CASE WHEN coalesce(e, 0) + coalesce(w, 0) > 0 THEN 'check' ELSE 'ok' END AS status
  FROM {{orders}} LEFT JOIN (SELECT doc, count(*) FILTER (level = 'error') AS e, count(*) FILTER (level = 'warning') AS w FROM ({_ALL_ISSUES}) GROUP BY doc) ON doc = o_orderkey"""
)
def q09_doc_status(spark, sf):
    docs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc"))
    return waybill.status(docs, _validated(spark, sf))


# pages to documents

_KINDS = f"""SELECT *, CASE WHEN known THEN said WHEN opened THEN 'continuation' ELSE 'front' END AS kind FROM (
  SELECT *, coalesce(max((NOT excluded)::INT) OVER (PARTITION BY file ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS opened FROM (
    SELECT *, said IN ('front', 'continuation', 'back', 'other') AS known,
      (said = 'back' OR (said = 'other' AND zones_source <> 'layout')) AND NOT has_table AS excluded FROM (
        SELECT *, split_part(lower(kind_raw), ' ', 1) AS said FROM ({PAGES}))))"""
# the sequential rule as a recursion over pages, one file at a time
_DOCS = f"""WITH RECURSIVE k AS (SELECT * FROM ({_KINDS})),
walk AS (
  SELECT file, 0 AS page, 0 AS doc, false AS started, NULL::INT AS given FROM k WHERE page = 1
  UNION ALL
  SELECT k.file, k.page,
    CASE WHEN k.excluded THEN w.doc WHEN w.doc = 0 OR (k.kind = 'front' AND w.started) THEN w.doc + 1 ELSE w.doc END,
    CASE WHEN k.excluded THEN w.started ELSE
      (w.doc <> 0 AND NOT (k.kind = 'front' AND w.started) AND w.started) OR k.has_items OR (k.kind = 'front' AND k.has_number) END,
    CASE WHEN k.excluded THEN CASE WHEN k.kind = 'other' OR w.doc = 0 THEN NULL ELSE w.doc END
      WHEN w.doc = 0 OR (k.kind = 'front' AND w.started) THEN w.doc + 1 ELSE w.doc END
  FROM walk w JOIN k ON k.file = w.file AND k.page = w.page + 1)
SELECT k.file, k.page, k.kind, k.excluded, w.given::BIGINT AS doc FROM walk w JOIN k ON k.file = w.file AND k.page = w.page"""


def _segmented(spark, sf):
    return waybill.segment(waybill.page_kinds(derived(spark, sf, PAGES)))


@query(_DOCS)
def q10_segmentation(spark, sf):
    return _segmented(spark, sf).select("file", "page", "kind", "excluded", "doc")


_SIGNED = "SELECT file, page, cast(floor(page / 8) as int) AS doc, CASE WHEN v % 4 = 0 THEN NULL ELSE v % 6 END AS s FROM (" + PAGES + ") AS p"


@query(
    f"""SELECT file, page, doc, CASE WHEN s IS NOT NULL AND page > f THEN f END AS copy_of FROM (
  SELECT *, min(page) OVER (PARTITION BY file, doc, s) AS f FROM ({_SIGNED}))"""
)
def q11_copy_pages(spark, sf):
    p = derived(spark, sf, _SIGNED)
    p = p.withColumn("signature", F.when(F.col("s").isNull(), F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("name "), "s"), F.lit("1"), F.lit("2"))))
    return waybill.copies(p).select("file", "page", "doc", "copy_of")


_READ = f"SELECT file, cast(floor(page / 10) as int) AS page, page AS pos, concat(v % 3, '') AS n, CASE WHEN v % 5 = 0 THEN NULL ELSE concat('item ', v % 2) END AS name, '1,00' AS cost, '2' AS quantity FROM ({PAGES}) AS p"


@query(
    f"""SELECT file, page, pos AS "row", n, name FROM (SELECT *, lag(n) OVER w AS pn, lag(name) OVER w AS pm FROM ({_READ}) WINDOW w AS (PARTITION BY file, page ORDER BY pos))
  WHERE name IS NULL OR n IS DISTINCT FROM pn OR name IS DISTINCT FROM pm"""
)
def q12_adjacent_dedup(spark, sf):
    rows = derived(spark, sf, _READ).withColumnRenamed("pos", "row")
    return waybill.without_adjacent_repeats(rows).select("file", "page", "row", "n", "name")


_PARTIAL = """SELECT conv_id AS doc, turn AS page, role, CASE WHEN length(text) % 3 = 0 THEN NULL ELSE text END AS a,
  CASE WHEN role = 'user' THEN NULL ELSE text END AS b FROM {conversations}"""


@query(f"SELECT doc, min_by(a, (page, role)) FILTER (a IS NOT NULL) AS a, min_by(b, (page, role)) FILTER (b IS NOT NULL) AS b FROM ({_PARTIAL}) GROUP BY doc")
def q13_header_first_nonnull(spark, sf):
    return waybill.first_read(derived(spark, sf, _PARTIAL), ["doc"], ["page", "role"], ["a", "b"])


@query(
    f"SELECT doc, max_by(off, n) FILTER (off IS NOT NULL) AS off, max_by(rate, n) FILTER (rate IS NOT NULL) AS rate FROM (SELECT doc, n, nullif(off, 0) AS off, nullif(rate, 0) AS rate FROM ({CENTS})) GROUP BY doc"
)
def q14_totals_last_nonnull(spark, sf):
    c = derived(spark, sf, CENTS).select("doc", "n", F.nullif("off", F.lit(0)).alias("off"), F.nullif("rate", F.lit(0)).alias("rate"))
    return waybill.last_read(c, ["doc"], ["n"], ["off", "rate"])


_BAD = "(abs(qty * p - c) * 10 > 11 + 5 * qty OR abs(c * rate - vat * 100) > 200 OR abs(c + vat - total) * 10 > 11)"
_FIXED = f"""SELECT doc, n, 1 AS round, concat('part ', part) AS name, qty + 1 AS qty, p + 1 AS p, c + 1 AS c, rate, vat, total FROM ({CENTS}) AS i
  UNION ALL SELECT doc, n, 2, concat('part ', part), qty, CASE WHEN part % 2 = 0 THEN p - 3 ELSE p END, c, rate, vat - 5, c + vat - 5 FROM ({CENTS}) AS i WHERE part % 10 = 3
  UNION ALL SELECT doc, n, 3, 'reread', qty, p, c, rate, vat, c + vat FROM ({CENTS}) AS i"""


def _printed(sql: str) -> str:
    return f"""SELECT doc, n, round, name, concat(qty, '') AS quantity, {money('p')} AS price, {money('c')} AS cost, concat(rate, '') AS vat_rate,
  {money('vat')} AS vat, {money('total')} AS cost_with_vat FROM ({sql}) AS f"""


@query(
    f"""WITH i AS (SELECT * FROM ({CENTS})), good AS (SELECT f.* FROM ({_FIXED}) f JOIN i USING (doc, n)
    WHERE {_BAD.replace('qty', 'i.qty').replace(' p ', ' i.p ').replace('- c)', '- i.c)').replace('(c ', '(i.c ').replace('rate', 'i.rate').replace('vat', 'i.vat').replace('total', 'i.total')}
    AND NOT {_BAD.replace('qty', 'f.qty').replace(' p ', ' f.p ').replace('- c)', '- f.c)').replace('(c ', '(f.c ').replace('rate', 'f.rate').replace('vat', 'f.vat').replace('total', 'f.total')}
    AND NOT (f.qty <> i.qty AND f.p <> i.p AND f.c <> i.c)),
  best AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY doc, n ORDER BY round) = 1)
  SELECT i.doc, i.n AS "row", coalesce(best.name, concat('part ', i.part)) AS name, {money('coalesce(best.p, i.p)')} AS price, {money('coalesce(best.total, i.total)')} AS cost_with_vat,
    best.doc IS NOT NULL AS repaired FROM i LEFT JOIN best ON i.doc = best.doc AND i.n = best.n"""
)
def q15_repair_accept(spark, sf):
    items = _items(spark, sf).select("doc", "row", "name", "quantity", "price", "cost", "vat_rate", "vat", "cost_with_vat")
    found = derived(spark, sf, _printed(_FIXED)).withColumnRenamed("n", "row")
    return waybill.accept_repairs(items, found).select("doc", "row", "name", "price", "cost_with_vat", "repaired")


_BANDS = f"SELECT doc AS file, 1 AS page, n AS pos, n * 40 AS top, n * 40 + 40 AS bottom, concat('part ', part) AS name FROM ({CENTS}) AS i"
_STRIPS = f"SELECT doc AS file, 1 AS page, n AS k, n * 40 + qty % 40 AS top, n * 40 + qty % 40 + 20 + off * 4 AS bottom, CASE WHEN qty % 6 = 0 THEN '[...]' ELSE concat('pen ', part) END AS text FROM ({CENTS}) AS i"


@query(
    f"""WITH one AS (SELECT s.file, s.k, count(*) AS c, any_value(r.pos) AS pos, any_value(s.text) AS text FROM ({_STRIPS}) s JOIN ({_BANDS}) r ON s.file = r.file
    AND 2 * (least(s.bottom, r.bottom) - greatest(s.top, r.top)) > s.bottom - s.top WHERE s.text <> '[...]' GROUP BY s.file, s.k HAVING count(*) = 1),
  last AS (SELECT file, pos, max_by(text, k) AS text FROM one GROUP BY file, pos)
  SELECT r.file, r.pos AS "row", coalesce(last.text, r.name) AS name, last.text IS NOT NULL AS by_hand FROM ({_BANDS}) r LEFT JOIN last ON r.file = last.file AND r.pos = last.pos"""
)
def q16_pen_overlay(spark, sf):
    rows = derived(spark, sf, _BANDS).withColumnRenamed("pos", "row")
    return waybill.pen_overlay(rows, derived(spark, sf, _STRIPS)).select("file", "row", "name", "by_hand")


# texts and files

_TXT = "SELECT doc_id AS doc, CASE WHEN doc_id % 2 = 0 THEN replace(text, chr(10), concat(chr(13), chr(10), ' ', chr(10))) ELSE concat(chr(10), text) END AS text FROM {documents}"


@query(
    f"""SELECT doc, CASE WHEN len(p) = 0 THEN '' ELSE array_to_string(p, chr(10) || chr(10)) || chr(10) END AS md FROM (
  SELECT doc, list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n[ \\t]*\\n'),
    lambda x: regexp_replace(x, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g')), lambda x: x <> '') AS p FROM ({_TXT}))"""
)
def q17_txt_paragraphs(spark, sf):
    return derived(spark, sf, _TXT).select("doc", T.paragraphs(F.col("text")).alias("md"))


@query("SELECT doc_id AS doc, text FROM {documents}")
def q18_decode_cascade(spark, sf):
    """Texts written in turn with a mark, as UTF-16 and plainly, read back alike."""
    d = table(spark, sf, "documents")
    text = F.col("text")
    content = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.unhex(F.lit("EFBBBF")), F.encode(text, "UTF-8")))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.unhex(F.lit("FFFE")), F.encode(text, "UTF-16LE")))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.unhex(F.lit("FEFF")), F.encode(text, "UTF-16BE")))
        .otherwise(F.encode(text, "UTF-8"))
    )
    return d.select(F.col("doc_id").alias("doc"), files.decode_text(content).alias("text"))


_FEATURES = """SELECT doc_id AS doc, doc_id % 50 AS file, n_chars % 37 AS chars, cast(doc_id % 10 as double) / 10 AS coverage, cast(n_chars % 10 as double) / 10 AS garbage,
  cast(n_chars % 7 as double) / 7 AS invisible, doc_id % 3 > 0 AS drawn FROM {documents}"""
_TRIAGE = """CASE WHEN chars >= 20 AND garbage >= 0.3 THEN 'full_scan' WHEN chars >= 20 AND coverage >= 0.5 AND invisible >= 0.8 THEN 'hybrid' WHEN chars >= 20 THEN 'digital'
  WHEN coverage >= 0.5 THEN 'full_scan' WHEN chars = 0 AND NOT drawn THEN 'blank' ELSE 'digital' END"""


@query(
    f"""SELECT file, bool_or(kind IN ('digital', 'hybrid')) AS usable, count(*) FILTER (kind = 'full_scan') AS scans, count(*) FILTER (kind = 'hybrid') AS hybrids,
  coalesce(string_agg(CASE WHEN kind IN ('full_scan', 'blank') THEN doc::VARCHAR END, ',' ORDER BY doc), '') AS skipped FROM (SELECT *, {_TRIAGE} AS kind FROM ({_FEATURES})) GROUP BY file"""
)
def q19_triage(spark, sf):
    from ..operators import triage

    return triage.files(triage.pages(derived(spark, sf, _FEATURES)), ["file"], "doc")


_CAPTIONS = """SELECT p_partkey AS part, CASE p_partkey % 6 WHEN 0 THEN concat('Таблица ', p_size) WHEN 1 THEN concat('рис. ', p_size, '.', p_partkey % 9, ' – ', p_name) WHEN 2 THEN concat('Рисунок А.', p_size, ' — x')
  WHEN 3 THEN concat('таблица', p_name) WHEN 4 THEN concat(p_size, '.', p_partkey % 9, ' ', p_name) ELSE p_name END AS text FROM {part}"""


@query(
    f"""SELECT part, CASE part % 6 WHEN 0 THEN 'table' WHEN 1 THEN 'figure' WHEN 2 THEN 'figure' END AS kind, CASE WHEN part % 6 = 4 THEN regexp_extract(text, '^[0-9.]+') END AS number,
  CASE WHEN part % 6 = 4 THEN 2 END AS level FROM ({_CAPTIONS})"""
)
def q20_captions(spark, sf):
    n = T.section_number(F.col("text"))
    return derived(spark, sf, _CAPTIONS).select("part", T.caption_kind(F.col("text")).alias("kind"), n.alias("number"), T.section_level(n).alias("level"))


_L = "length(regexp_replace(text, '[^\\p{L}]', '', 'g'))"
_FITS = f"length(text) <= 100 AND text <> '' AND NOT regexp_matches(text, '[\\t\\n]') AND right(text, 1) NOT IN ('.', ',', ';', ':') AND NOT regexp_full_match(text, '[a-z_][a-z0-9_]*') AND {_L} >= 3"


@query(
    "WITH RECURSIVE x AS (SELECT *, "
    + _FITS
    + """ AS fits, regexp_full_match(regexp_replace(text, '[^\\p{L}]', '', 'g'), '\\p{Lu}*') AS caps, nullif(regexp_extract(text, '^(\\d+(?:\\.\\d+)*)\\.?\\s+\\S', 1), '') AS num FROM ("""
    + LINES_DUCK
    + """)),
  y AS (SELECT *, CASE WHEN fits AND in_list AND caps THEN 1 WHEN fits AND NOT in_list AND (bold OR (num IS NOT NULL AND caps)) THEN coalesce(len(string_split(num, '.')), 1) END AS sure FROM x),
  walk AS (SELECT doc, -1::BIGINT AS pos, []::VARCHAR[] AS known, NULL::BIGINT AS level FROM (SELECT DISTINCT doc FROM y)
    UNION ALL SELECT y.doc, y.pos, CASE WHEN ok AND num IS NOT NULL AND NOT in_list THEN list_append(known, num) ELSE known END, CASE WHEN ok THEN coalesce(sure, len(string_split(num, '.'))) END FROM (
      SELECT y.*, w.known, sure IS NOT NULL OR (fits AND NOT in_list AND num IS NOT NULL AND list_contains(w.known, regexp_extract(num, '^(.*)\\.[^.]*$', 1))) AS ok FROM walk w JOIN y ON y.doc = w.doc AND y.pos = w.pos + 1) AS y)
  SELECT doc, pos, level FROM walk WHERE level IS NOT NULL"""
)
def q21_heading_level(spark, sf):
    return markdown.headings(derived(spark, sf, LINES), ["doc"]).filter("level IS NOT NULL").select("doc", "pos", F.col("level").cast("long").alias("level"))


@query(
    """SELECT page_id, array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(html, '(?i)\\s*data-bbox="[^"]*"', '', 'g'),
  '(?i)</(?:p|div|li|tr|h[1-6]|table)>|<br\\s*/?>', chr(10), 'g'), '<[^>]+>', '', 'g'), chr(10)), lambda x: trim(regexp_replace(x, '[\\s\\x{00A0}]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) AS text FROM pages"""
)
def q22_html_text(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.html_text(F.col("html")).alias("text"))


@query(
    f"""SELECT a.page, a.id, a.l, a.t, a.r, a.b FROM ({BOXES}) a WHERE NOT EXISTS (SELECT 1 FROM ({BOXES}) o WHERE o.page = a.page AND o.l >= a.l AND o.t >= a.t AND o.r <= a.r AND o.b <= a.b
  AND (o.r - o.l) * (o.b - o.t) < (a.r - a.l) * (a.b - a.t))"""
)
def q23_html_blocks_leaf(spark, sf):
    return _flat(layout.leaf_boxes(_boxes(spark, sf), ["page"]), "page", "id")


@query(
    """SELECT n_regionkey AS id, '| nation | note |  |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || n_name || ' | a b |  |', chr(10) ORDER BY n_nationkey) AS md
  FROM nation GROUP BY n_regionkey"""
)
def q24_html_tables_gfm(spark, sf):
    row = F.format_string("<tr><td>%s</td><td colspan='2'>a<br>b</td></tr>", "n_name")
    row = F.replace(row, F.lit("'"), F.lit('"'))
    n = table(spark, sf, "nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", row.alias("x")))).alias("rows"))
    html = F.concat(F.lit("text <table class=x><tr><th>nation</th><th>note</th></tr>"), F.array_join(F.transform("rows", lambda r: r["x"]), ""), F.lit("</table><table><tr><td>one</td></tr></table>"))
    return n.select(F.col("n_regionkey").alias("id"), tables.html_tables(html).alias("md"))


# tables

# a grid of order rows: some cells, rows and columns are empty; the first column may reach over two
_CELLS = f"""SELECT doc, n - 1 AS r, k AS c, CASE WHEN n % 4 = 0 OR (k = 2 AND doc % 3 = 0) OR (k = 1 AND qty % 5 = 0) THEN '' WHEN k = 0 THEN concat('name ', part % 4) WHEN k = 1 THEN concat(qty, '')
  ELSE concat('note: ', supp % 9) END AS s FROM ({CENTS}) AS i CROSS JOIN (SELECT r_regionkey AS k FROM {{region}} WHERE r_regionkey < 3) AS k"""


def _cells(spark, sf):
    s = F.col("s")
    return derived(spark, sf, _CELLS).select(
        "doc", "r", "c", F.concat_ws(",", "r", "c").alias("key"), F.when(s == "", F.array().cast("array<string>")).otherwise(F.array(s)).alias("lines"),
        (F.col("r") == 0).alias("bold"), F.lit(False).alias("h_cont"), F.lit(False).alias("v_cont"),
    )


_DROPPED = f"""SELECT doc, (dense_rank() OVER (PARTITION BY doc ORDER BY r) - 1)::INT AS r, (dense_rank() OVER (PARTITION BY doc ORDER BY c) - 1)::INT AS c, s AS text FROM (
  SELECT *, bool_and(s = '') OVER (PARTITION BY doc, c) AS ec FROM (SELECT *, bool_and(s = '') OVER (PARTITION BY doc, r) AS er FROM ({_CELLS})) WHERE NOT er) WHERE NOT ec"""


@query(_DROPPED)
def q25_grid_drop_empty(spark, sf):
    return tables.drop_empty(_cells(spark, sf), ["doc"]).select("doc", "r", "c", "text")


@query()
def q26_table_kind(spark, sf):
    """Every order's table by its shape; tests hold it to a plain loop over cells."""
    return tables.kinds(tables.drop_empty(_cells(spark, sf), ["doc"]), ["doc"]).select("doc", "kind")


_NATIONS = """SELECT n_regionkey AS doc, cast(row_number() over (partition by n_regionkey order by n_nationkey) as int) AS r, n_name, n_nationkey AS k FROM {nation}"""


@query(
    f"""SELECT doc, '| name | n\\|o | description |' || chr(10) || '|---|---|---|' || chr(10) || string_agg('| ' || n_name || ' | ' || k || ' | a<br>b |', chr(10) ORDER BY r) AS md FROM ({_NATIONS}) GROUP BY doc"""
)
def q27_grid_gfm(spark, sf):
    n = derived(spark, sf, _NATIONS)
    lines = [F.array("n_name"), F.array(F.col("k").cast("string")), F.array(F.lit("a"), F.lit("b"))]
    body = n.select("doc", "r", F.posexplode(F.array(*lines)).alias("c", "lines"))
    head = n.select("doc").distinct().select("doc", F.lit(0).alias("r"), F.posexplode(F.array(*[F.array(F.lit(x)) for x in ("name", "n|o", "description")])).alias("c", "lines"))
    cells = head.unionByName(body).select("*", F.concat_ws(",", "r", "c").alias("key"), F.lit(False).alias("bold"), F.lit(False).alias("h_cont"), F.lit(False).alias("v_cont"))
    return tables.to_markdown(cells, ["doc"]).select("doc", "md")


@query(
    f"""SELECT doc, string_agg(CASE WHEN k % 2 = 0 THEN '- **' || n_name || ':** ' || k ELSE '- **' || n_name || '**' END, chr(10) ORDER BY r) AS md FROM ({_NATIONS}) GROUP BY doc"""
)
def q27b_key_value_list(spark, sf):
    n = derived(spark, sf, _NATIONS)
    value = F.when(F.col("k") % 2 == 0, F.array(F.col("k").cast("string"))).otherwise(F.array().cast("array<string>"))
    cells = n.select("doc", "r", F.posexplode(F.array(F.array(F.concat("n_name", F.lit(":"))), value)).alias("c", "lines"))
    cells = cells.select("*", F.concat_ws(",", "r", "c").alias("key"), F.lit(False).alias("bold"), F.lit(False).alias("h_cont"), F.lit(False).alias("v_cont"))
    return tables.render_key_value(tables.with_text(cells), ["doc"])


_TILES = """SELECT brand AS doc, cast(floor((n - 1) / 10) as int) AS tile, n, concat('| ', p_name, ' | ', p_size, ' |') AS line FROM (
  SELECT p_brand AS brand, p_name, p_size, cast(row_number() over (partition by p_brand order by p_partkey) as int) AS n FROM {part}) AS x"""


@query(
    f"""SELECT doc, '| a | b |' || chr(10) || '|---|---|' || chr(10) || '| 1 | 2 |' || chr(10) || string_agg(line, chr(10) ORDER BY n) AS md FROM (
  SELECT *, lag(line) OVER (PARTITION BY doc ORDER BY n) AS before FROM ({_TILES})) WHERE line IS DISTINCT FROM before GROUP BY doc"""
)
def q28_tile_concat(spark, sf):
    """Tiles repeat the head and the numbers of columns, and the row at each seam."""
    t = derived(spark, sf, _TILES)
    seam = t.groupBy("doc", "tile").agg(F.max_by("line", "n").alias("line")).select("doc", (F.col("tile") + 1).alias("tile"), F.lit(0).alias("n"), "line")
    seam = seam.join(t.select("doc", "tile").distinct(), ["doc", "tile"], "left_semi")
    x = t.unionByName(seam).groupBy("doc", "tile").agg(F.array_sort(F.collect_list(F.struct("n", "line"))).alias("x"))
    text = F.concat(F.lit("| a | b |\n|---|---|\n| 1 | 2 |\n"), F.array_join(F.transform("x", lambda e: e["line"]), "\n"))
    return tables.join_tiles(x.select("doc", "tile", text.alias("text")), ["doc"])


_PIPED = """SELECT doc_id AS doc, replace(replace(text, concat(chr(10), 'E'), concat(chr(10), '| E')), concat(chr(10), 'O'), concat(chr(10), '  | O')) AS text FROM {documents}"""


@query(
    f"""WITH l AS (SELECT doc, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM ({_PIPED})),
  m AS (SELECT doc, pos, regexp_replace(line, '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g') AS line FROM l),
  g AS (SELECT *, pos - row_number() OVER (PARTITION BY doc ORDER BY pos) AS g FROM m WHERE starts_with(line, '|')),
  runs AS (SELECT doc, g, min(pos) AS pos, string_agg(line, chr(10) ORDER BY pos) AS s FROM g GROUP BY doc, g HAVING count(*) >= 2)
  SELECT doc, string_agg(s, chr(10) || chr(10) ORDER BY pos) AS md FROM runs GROUP BY doc"""
)
def q29_pipe_runs(spark, sf):
    return tables.pipe_tables(derived(spark, sf, _PIPED), ["doc"])


# layout

_X = "greatest(0, least(a.r, o.r) - greatest(a.l, o.l)) * greatest(0, least(a.b, o.b) - greatest(a.t, o.t))"
_A = lambda x: f"({x}.r - {x}.l) * ({x}.b - {x}.t)"


@query(
    f"""SELECT page, id, other, round(x / (aa + oa - x)::DOUBLE, 9) AS iou FROM (SELECT a.page, a.id, o.id AS other, {_X} AS x, {_A('a')} AS aa, {_A('o')} AS oa
  FROM ({BOXES}) a JOIN ({BOXES}) o ON a.page = o.page AND a.id < o.id) WHERE 2 * x >= aa + oa - x AND x > 0"""
)
def q30_iou_pairs(spark, sf):
    return layout.overlapping_pairs(_boxes(spark, sf), ["page"]).withColumn("iou", F.round("iou", 9))


@query(
    f"""WITH RECURSIVE s AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY -score, id) AS k FROM ({BOXES})),
  walk AS (SELECT page, 0::BIGINT AS k, []::STRUCT(id INT, role VARCHAR, l INT, t INT, r INT, b INT)[] AS kept FROM (SELECT DISTINCT page FROM s)
    UNION ALL SELECT w.page, s.k, CASE WHEN len(list_filter(w.kept, lambda o: o.role = s.role AND greatest(0, least(s.r, o.r) - greatest(s.l, o.l)) * greatest(0, least(s.b, o.b) - greatest(s.t, o.t)) > 0
        AND 3 * greatest(0, least(s.r, o.r) - greatest(s.l, o.l)) * greatest(0, least(s.b, o.b) - greatest(s.t, o.t)) >= (s.r - s.l) * (s.b - s.t) + (o.r - o.l) * (o.b - o.t))) > 0
      THEN w.kept ELSE list_append(w.kept, {{'id': s.id, 'role': s.role, 'l': s.l, 't': s.t, 'r': s.r, 'b': s.b}}) END FROM walk w JOIN s ON s.page = w.page AND s.k = w.k + 1),
  last AS (SELECT page, max_by(kept, k) AS kept FROM walk GROUP BY page)
  SELECT page, k.id AS id, k.l AS l, k.t AS t, k.r AS r, k.b AS b FROM (SELECT page, unnest(kept) AS k FROM last)"""
)
def q31_nms(spark, sf):
    out = layout.suppress(_boxes(spark, sf).withColumnRenamed("id", "ord"), ["page"])
    return _flat(out, "page", F.col("ord").alias("id"))


@query(
    f"""SELECT a.page, a.id FROM ({BOXES}) a WHERE NOT EXISTS (SELECT 1 FROM ({BOXES}) o WHERE o.page = a.page AND o.role = a.role AND {_A('o')} > {_A('a')} AND 10 * ({_X}) >= 9 * ({_A('a')}))"""
)
def q32_contained_drop(spark, sf):
    return layout.drop_contained(_boxes(spark, sf), ["page"]).select("page", "id")


_ISLANDS = f"""SELECT file, i AS island, min(v) AS start, max(v) AS "end", count(*) AS n, floor(sum(v) / count(*))::BIGINT AS y FROM (
  SELECT *, sum(new) OVER (PARTITION BY file ORDER BY v, page ROWS UNBOUNDED PRECEDING) AS i FROM (
    SELECT *, CASE WHEN v - lag(v) OVER (PARTITION BY file ORDER BY v, page) > 3 THEN 1 ELSE 0 END AS new FROM ({PAGES}))) GROUP BY file, i"""


@query(_ISLANDS)
def q33_islands_lines(spark, sf):
    return layout.islands(derived(spark, sf, PAGES).select("file", F.col("v").alias("y")), ["file"], 3).select("file", "island", "start", "end", "n", F.col("y").cast("long").alias("y"))


@query(
    f"""SELECT file, start, "end", n FROM (SELECT *, row_number() OVER (PARTITION BY file ORDER BY n DESC, start) AS k FROM ({_ISLANDS}) WHERE n >= 4) WHERE k = 1"""
)
def q33b_longest_block(spark, sf):
    return layout.longest_block(derived(spark, sf, PAGES).select("file", F.col("v").alias("y")), ["file"], 3)


_SPANS = f"SELECT file, page AS id, v AS top, v + 1 + event_id % 9 AS bottom FROM ({PAGES}) AS p"


@query(
    f"""WITH e AS (SELECT file, top AS y, 1 AS d FROM ({_SPANS}) UNION ALL SELECT file, bottom, -1 FROM ({_SPANS})), s AS (SELECT file, y, sum(d) AS d FROM e GROUP BY file, y),
  n AS (SELECT *, sum(d) OVER (PARTITION BY file ORDER BY y) >= 3 AS act FROM s), c AS (SELECT *, coalesce(lag(act) OVER (PARTITION BY file ORDER BY y), false) AS was FROM n),
  e2 AS (SELECT file, y, act, lead(y) OVER (PARTITION BY file ORDER BY y) AS "end" FROM c WHERE act <> was) SELECT file, y AS start, "end" FROM e2 WHERE act"""
)
def q34_sweep_columns(spark, sf):
    return layout.active_bands(derived(spark, sf, _SPANS), ["file"])


@query(
    f"""SELECT a.file, a.id FROM ({_SPANS}) a WHERE EXISTS (SELECT 1 FROM ({_SPANS}) o WHERE o.file = a.file AND o.id <> a.id AND abs(o.top - a.top) <= 1 AND abs(o.bottom - a.bottom) <= 1)"""
)
def q34b_paired_spans(spark, sf):
    return layout.paired_spans(derived(spark, sf, _SPANS), ["file"], 1).select("file", "id")


_INTERVALS = f"SELECT doc, part % 900 AS top, part % 900 + qty AS bottom FROM ({CENTS}) AS i"


@query(
    f"""SELECT doc, min(top) AS top, max(bottom) AS bottom, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY doc ORDER BY top, bottom ROWS UNBOUNDED PRECEDING) AS g FROM (
  SELECT *, CASE WHEN top > 20 + max(bottom) OVER (PARTITION BY doc ORDER BY top, bottom ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM ({_INTERVALS}))) GROUP BY doc, g"""
)
def q35_interval_merge(spark, sf):
    return layout.merged_intervals(derived(spark, sf, _INTERVALS), ["doc"], 20)


@query(
    f"""SELECT page, id, l, t FROM (SELECT *, row_number() OVER (PARTITION BY page ORDER BY t, id) AS k FROM (SELECT *, max(columns >= 6) OVER (PARTITION BY page) AS many FROM (
  SELECT *, max(r - l) OVER (PARTITION BY page) AS most FROM (SELECT *, score % 9 AS columns FROM ({BOXES})) WHERE r - l >= 0.3 * 900 AND (r - l) * (b - t) >= 0.02 * 900 * 900)
  WHERE r - l >= 0.7 * most) WHERE NOT many OR columns >= 6) WHERE k = 1"""
)
def q36_items_table(spark, sf):
    b = _boxes(spark, sf).withColumn("columns", F.col("score") % 9)
    return layout.items_table(b, ["page"], 900, 900).select("page", "id", "box.l", "box.t")


@query(
    f"""SELECT a.page, a.id, min(o.l) AS l, min(o.t) AS t, max(o.r) AS r, max(o.b) AS b, count(*) AS n FROM ({BOXES}) a JOIN ({BOXES}) o ON a.page = o.page AND o.l >= a.r
    AND least(a.b, o.b) - greatest(a.t, o.t) >= 0.5 * least(a.b - a.t, o.b - o.t) AND o.b - o.t <= 3 * (a.b - a.t) WHERE a.l <= 0.15 * 1200 GROUP BY a.page, a.id"""
)
def q37_form_fields(spark, sf):
    f = layout.form_fields(_boxes(spark, sf), ["page"], 0, 1200)
    return f.select("page", "id", "values.l", "values.t", "values.r", "values.b", "n")


@query(f'SELECT doc, n AS "row", ((n - 1) // 10)::INT AS chunk FROM ({CENTS})')
def q38_chunks(spark, sf):
    return layout.row_chunks(derived(spark, sf, CENTS).select("doc", F.col("n").alias("row")), ["doc"], ["row"])


@query()
def q39_region_plan(spark, sf):
    """Crops depend on those taken before; tests hold it to a plain loop."""
    kind = F.when(F.col("id") % 5 == 0, "margin").when(F.col("role") == "picture", "figure").otherwise(F.col("role"))
    r = _boxes(spark, sf).select("page", F.col("id").alias("ord"), kind.alias("kind"), (F.col("score") / 10).alias("score"), "box")
    return layout.region_plan(r, ["page"], F.lit(400000))


@query()
def q39b_layout_fusion(spark, sf):
    """Two detectors and ruled tables to one layout; greedy, held to its parts by tests."""
    b = _boxes(spark, sf)
    source = F.when(F.col("id") % 2 == 0, "heron").otherwise("dots")
    dets = b.filter("NOT (id % 3 = 0 AND role = 'table')").select("page", F.col("id").alias("ord"), "role", (F.col("score") / 10).alias("score"), "box", source.alias("source"))
    ruled = b.filter("id % 3 = 0 AND role = 'table'").select("page", F.col("id").alias("ord"), "box")
    return layout.fuse(dets, ruled, ["page"], 1200, 1200)


@query()
def q39c_tile_merge(spark, sf):
    """Boxes of two half-page tiles put in place and suppressed."""
    b = _boxes(spark, sf).select("page", F.col("id").alias("ord"), "role", F.col("score").cast("double").alias("score"), "box")
    tile = G.box(F.lit(0), F.when(F.col("ord") % 4 == 1, 0).otherwise(540), F.lit(1200), F.when(F.col("ord") % 4 == 1, 660).otherwise(1200))
    out = layout.merge_tiles(b.filter("ord % 2 = 0"), b.filter("ord % 2 = 1").withColumn("tile", tile), ["page"], F.lit(1200), F.lit(1200))
    return _flat(out, "page", "ord")


# documents

_BLOCKS = """SELECT conv_id AS doc, turn AS pos, CASE WHEN turn % 3 = 1 THEN 'picture' ELSE 'block' END AS kind, CASE WHEN turn % 3 = 1 THEN '' WHEN conv_id % 4 = 0 AND turn % 3 = 0 THEN concat('Таблица ', turn + 1)
  WHEN conv_id % 4 = 1 AND turn % 3 = 2 THEN concat('Рис. ', turn, ' – x') WHEN conv_id % 4 = 2 AND turn % 3 = 2 THEN concat('Рисунок ', turn) ELSE concat('plain ', text) END AS md FROM {conversations}"""


@query(
    f"""SELECT doc, pos, CASE WHEN p1 LIKE 'Таблица%' THEN p1 WHEN n1 LIKE 'Рис. %' THEN n1 WHEN n1 LIKE 'Рисунок%' THEN CASE WHEN n2 <> '' AND length(n2) <= 200 AND n2 NOT LIKE 'Рис%' AND n2 NOT LIKE 'Табл%' THEN n1 || ' – ' || n2 ELSE n1 END
    WHEN p1 LIKE 'Рис%' THEN p1 ELSE 'image' END AS alt FROM (SELECT *, coalesce(lag(md) OVER w, '') AS p1, coalesce(lead(md) OVER w, '') AS n1, coalesce(lead(CASE WHEN kind = 'block' THEN md ELSE '' END, 2) OVER w, '') AS n2
    FROM ({_BLOCKS}) WINDOW w AS (PARTITION BY doc ORDER BY pos)) WHERE kind = 'picture'"""
)
def q40_captions_neighbours(spark, sf):
    return markdown.picture_captions(derived(spark, sf, _BLOCKS), ["doc"])


_BODY = """SELECT doc_id AS doc, concat('[TABLE 1]', chr(10), text, chr(10), '\\[FIGURE 2] and [TABLE 1]', CASE WHEN doc_id % 2 = 0 THEN ' [HAND 9]' ELSE '' END) AS body FROM {documents}"""
_PARTS = """SELECT doc_id AS doc, 'TABLE 1' AS k, 1 AS ord, concat('<t', doc_id, '>') AS text FROM {documents} UNION ALL SELECT doc_id, 'FIGURE 2', 2, '<fig>' FROM {documents} WHERE doc_id % 3 = 0
  UNION ALL SELECT doc_id, 'TABLE 7', 3, '<late>' FROM {documents} WHERE doc_id % 5 = 0"""


@query(
    """SELECT doc_id AS doc, trim(regexp_replace('<t' || doc_id || '>' || chr(10) || text || chr(10) || CASE WHEN doc_id % 3 = 0 THEN '<fig>' ELSE '' END || ' and ' || CASE WHEN doc_id % 2 = 0 THEN ' ' ELSE '' END
    || CASE WHEN doc_id % 5 = 0 THEN chr(10) || chr(10) || '<late>' ELSE '' END, '\\n{3,}', chr(10) || chr(10), 'g')) AS md FROM {documents}"""
)
def q41_marker_merge(spark, sf):
    body = derived(spark, sf, _BODY.replace("\\\\[", "[").replace("'\\[FIGURE", "'[FIGURE"))
    return markdown.merge_markers(body, derived(spark, sf, _PARTS).withColumnRenamed("k", "key"))


_LINKED = """SELECT conv_id AS doc, role, concat('intro', chr(10), CASE WHEN conv_id % 2 = 0 THEN '| x |' ELSE 'x' END, chr(10), CASE WHEN conv_id % 2 = 0 THEN '| ' ELSE '' END, '![a', turn, '](m/img-', turn % 3, '.png) ![b](m/img-', turn % 3, '.png)',
  chr(10), '![c](http://e.x/y.png) ![d](<m/my pic.jpg>)') AS md, turn FROM {conversations}"""


@query(
    f"""SELECT conv_id, turn, pos, anchor, stem, alt FROM (SELECT doc AS conv_id, turn, 2 AS pos, CASE WHEN doc % 2 = 0 THEN 1 ELSE 2 END AS anchor, 'img-' || turn % 3 AS stem, 'a' || turn AS alt FROM ({_LINKED})
  UNION ALL SELECT doc, turn, 3, 3, 'my pic', 'd' FROM ({_LINKED})) WHERE NOT ((conv_id + turn) % 7 = 0 AND stem = 'my pic')"""
)
def q42_enrich_first_link(spark, sf):
    """Links of every turn, by conversation and turn."""
    key = F.struct(F.col("doc").alias("conv_id"), "turn").alias("doc")
    docs = derived(spark, sf, _LINKED).select(key, "md")
    done = docs.filter("(doc.conv_id + doc.turn) % 7 = 0").select("doc", F.lit("my pic").alias("stem"))
    return markdown.to_describe(docs, done).select("doc.conv_id", "doc.turn", "pos", "anchor", "stem", "alt")


_ASKS = "SELECT doc_id AS doc, text, lang AS mode, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS model FROM {documents}"


@query(
    f"""SELECT DISTINCT sha256(text) AS sha256, mode, model FROM ({_ASKS}) a WHERE NOT EXISTS (SELECT 1 FROM ({_ASKS}) c WHERE c.doc % 4 = 1 AND sha256(c.text) = sha256(a.text) AND c.mode = a.mode AND c.model IS NOT DISTINCT FROM a.model)"""
)
def q43_cache_misses(spark, sf):
    asks = derived(spark, sf, _ASKS).select("doc", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), "mode", "model")
    cache = asks.filter("doc % 4 = 1 OR doc % 4 = 2").withColumn("answer", F.when(F.col("doc") % 4 == 1, "text").otherwise(" "))
    return answers.misses(asks.drop("doc"), cache).select("sha256", "mode", "model")


_ANSWERS = """SELECT event_id AS id, CASE event_id % 5 WHEN 0 THEN concat('```json', chr(10), props, chr(10), '```') WHEN 1 THEN concat('Here: ', props) WHEN 2 THEN concat('{bad} ', props, ' end')
  WHEN 3 THEN 'no object' ELSE concat(props, ' {"k": 1}') END AS answer, props FROM {events}"""


@query(f"SELECT id, CASE WHEN id % 5 = 3 THEN NULL ELSE props::VARCHAR END AS json FROM ({_ANSWERS})")
def q44_answer_json(spark, sf):
    return derived(spark, sf, _ANSWERS).select("id", answers.first_json(F.col("answer")).alias("json"))


_THOUGHT = """SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN '<think>a b</think> yes ' WHEN 1 THEN 'left</think> over' WHEN 2 THEN '' ELSE concat(event_type, ' ') END AS said, event_type AS why FROM {events}"""


@query(f"SELECT id, CASE id % 4 WHEN 0 THEN 'yes' WHEN 1 THEN 'over' ELSE why END AS text FROM ({_THOUGHT})")
def q44b_answer_text(spark, sf):
    message = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("said").alias("content"), F.col("why").alias("reasoning_content")).alias("message"))).alias("choices")))
    return derived(spark, sf, _THOUGHT).select("id", answers.answer_text(message).alias("text"))


@query(
    f"""SELECT page, id, role, l, t, r, b FROM (SELECT page, id, CASE role WHEN 'picture' THEN 'margin' ELSE role END AS role, l, t, r, b FROM ({BOXES}))"""
)
def q45_dots_parse(spark, sf):
    """Boxes printed as a model's JSON at half scale and read back."""
    b = _boxes(spark, sf)
    label = F.when(F.col("role") == "picture", "Page-header").when(F.col("role") == "table", "Table").otherwise("Text")
    # positions stand for ids, which count from 1 on a page
    one = F.format_string('{"bbox": [%s, %s, %s, %s], "category": "%s", "text": "t%d"}', *[F.col("box")[k] / 2 for k in "ltrb"], label, "id")
    a = b.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", one.alias("j")))), lambda x: x["j"]), ", ").alias("j"))
    a = a.select("page", F.concat(F.lit("<think>x</think>```json\n["), "j", F.lit("]\n```")).alias("answer"))
    d = answers.detected(a, ["page"], F.lit(2000), F.lit(2000), F.lit(1000), F.lit(1000))
    return _flat(d, "page", (F.col("ord") + 1).alias("id"), "role")


_SECTIONS = """SELECT conv_id, turn, text AS r, CASE turn % 4 WHEN 0 THEN concat('**Описание:** ', text, chr(10), 'Анализ: нет', chr(10), 'Анализ: second') WHEN 1 THEN concat('just ', text)
  WHEN 2 THEN concat('x', chr(10), 'Текст с изображения: ', text, chr(10), 'more', chr(10), 'Описание: «—»') ELSE 'Описание: ' END AS answer FROM {conversations}"""


@query(
    f"""SELECT conv_id, turn, CASE turn % 4 WHEN 0 THEN r WHEN 1 THEN 'just ' || r END AS description, CASE WHEN turn % 4 = 2 THEN r || chr(10) || 'more' END AS text, CASE WHEN turn % 4 = 0 THEN 'second' END AS analysis FROM ({_SECTIONS})"""
)
def q46_sections(spark, sf):
    s = derived(spark, sf, _SECTIONS).select("conv_id", "turn", answers.sections(F.col("answer")).alias("m"))
    return s.select("conv_id", "turn", *[F.col("m")[F.lit(k)].alias(n) for k, n in zip(answers.SECTIONS, ("description", "text", "analysis"))])


@query(
    """WITH x AS (SELECT event_id AS id, 1 + event_id % 70 AS n FROM {events}), a AS (SELECT id, n, 'abcdefghijklmnopqrstuvwxyz' AS e, 'абвгдежзиклмнопрстуфхцчшщэюя' AS u FROM x)
  SELECT id, lpad(n::VARCHAR, 2, '0') AS zero, repeat(substring(e, ((n - 1) % 26 + 1)::INT, 1), ((n - 1) // 26 + 1)::INT) AS letters, repeat(substring(u, ((n - 1) % 28 + 1)::INT, 1), ((n - 1) // 28 + 1)::INT) AS russian,
    repeat('L', (n // 50)::INT) || ['', 'X', 'XX', 'XXX', 'XL'][(n % 50 // 10 + 1)::INT] || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][(n % 10 + 1)::INT] AS roman FROM a"""
)
def q47_list_numbers(spark, sf):
    n = F.col("event_id") % 70 + 1
    forms = {"zero": "decimalZero", "letters": "lowerLetter", "russian": "russianLower", "roman": "upperRoman"}
    return table(spark, sf, "events").select(F.col("event_id").alias("id"), *[T.list_number(n, F.lit(f)).alias(k) for k, f in forms.items()])


_PARAS = f"SELECT file AS doc, page AS pos, concat(v % 2, '') AS num_id, v % 3 AS ilvl FROM ({PAGES}) AS p"


@query()
def q47b_multilevel_counters(spark, sf):
    """Numbers of paragraphs in two lists that share their counters; tests hold it to a plain loop."""
    level = lambda text, fmt, restart=None, legal=False: F.struct(
        F.lit(1).alias("start"), F.lit(fmt).alias("fmt"), F.lit(text).alias("text"), F.lit(restart).cast("int").alias("restart"), F.lit(legal).alias("legal")
    )
    nine = [level("%1.", "upperRoman"), level("%1.%2", "decimal", None, True), level("%3)", "russianLower", 1), *[level("", "bullet")] * 6]
    start = F.when((F.col("num_id") == "1") & (F.col("ilvl") == 0), F.lit(5))
    p = derived(spark, sf, _PARAS).withColumn("abs_id", F.lit("a")).withColumn("levels", F.array(*nine)).withColumn("start", start)
    return numbering.markers(p, ["doc"])


_STYLES_T = """SELECT concat('n', n_nationkey) AS style_id, CASE WHEN n_nationkey % 5 = 0 THEN concat('r', n_regionkey) ELSE concat('n', n_nationkey - 1) END AS based_on, CASE WHEN n_nationkey % 4 = 1 THEN concat(n_nationkey, '') END AS num_id,
  CASE WHEN n_nationkey % 3 = 2 THEN '1' END AS ilvl FROM {nation} UNION ALL SELECT concat('r', r_regionkey), NULL, 'top', '0' FROM {region}"""


@query(
    f"""WITH RECURSIVE s AS ({_STYLES_T}), chain AS (SELECT style_id, based_on AS at, num_id, ilvl, 1 AS hop FROM s UNION ALL SELECT c.style_id, s.based_on, coalesce(c.num_id, s.num_id), coalesce(c.ilvl, s.ilvl), c.hop + 1
  FROM chain c JOIN s ON c.at = s.style_id WHERE c.hop < 20) SELECT style_id, max_by(num_id, hop) AS num_id, max_by(ilvl, hop) AS ilvl FROM chain GROUP BY style_id"""
)
def q48_style_chain(spark, sf):
    return numbering.style_chain(derived(spark, sf, _STYLES_T))


@query()
def q49_hint_trim(spark, sf):
    """Repeats need a back reference, which DuckDB's patterns lack."""
    return table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), T.trim_hint(F.col("text")).alias("hint"))


_REPORT = f"""SELECT doc, n AS pos, concat('part ', part) AS name, concat(qty, '') AS q, CASE WHEN rate = 0 THEN NULL ELSE concat(rate, '%') END AS rate FROM ({CENTS}) AS i"""


@query(
    f"""WITH rows AS (SELECT doc, string_agg('| ' || pos || ' | ' || name || ' | ' || q || ' | ' || coalesce(rate, '—') || ' |', chr(10) ORDER BY pos) AS rows FROM ({_REPORT}) GROUP BY doc)
  SELECT o_orderkey AS doc, concat_ws(chr(10) || chr(10), '# Order ' || o_orderkey, '| Field | Value |' || chr(10) || '|---|---|' || chr(10) || '| status | ' || o_orderstatus || ' |' || chr(10) || '| priority | ' || o_orderpriority || ' |' || chr(10) || '| note | — |',
    '| n | name | quantity | rate |' || chr(10) || '|---|---|---|---|' || chr(10) || rows) AS md FROM {{orders}} LEFT JOIN rows ON doc = o_orderkey"""
)
def q50_report(spark, sf):
    field = lambda n, c: F.struct(F.lit(n).alias("name"), c.cast("string").alias("value"))
    o = table(spark, sf, "orders")
    docs = o.select(F.col("o_orderkey").alias("doc"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"), F.array(field("status", F.col("o_orderstatus")), field("priority", F.col("o_orderpriority")), field("note", F.lit(None))).alias("fields"))
    i = derived(spark, sf, _REPORT)
    items = i.select("doc", F.col("pos").alias("row"), F.array(F.col("pos").cast("string"), "name", "q", "rate").alias("cells"), F.array(*[F.lit(x) for x in ("n", "name", "quantity", "rate")]).alias("columns"))
    return markdown.report(docs, items)


@query("SELECT doc_id AS doc, 'page-' || substring(sha1('read: ' || text), 1, 8) AS mode FROM {documents}")
def q51_prompt_key(spark, sf):
    return table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), answers.prompt_key(F.lit("page"), F.concat(F.lit("read: "), "text")).alias("mode"))


_IMAGES = """SELECT p_partkey AS part, CASE p_partkey % 7 WHEN 0 THEN 'page-001' WHEN 1 THEN 'scan-3-fig-2' WHEN 2 THEN 'scan-004' ELSE 'img-001' END AS stem, CASE WHEN p_partkey % 2 = 0 THEN '.JPG' ELSE '.png' END AS suffix,
  CASE p_partkey % 11 WHEN 3 THEN 'Формула x' WHEN 4 THEN 'График' WHEN 5 THEN ' Таблица 1' WHEN 6 THEN 'блок-схема' WHEN 7 THEN 'график y' ELSE p_type END AS alt, p_size * 10 AS w, 200 AS h FROM {part}"""


@query(
    f"""SELECT part, kind, CASE WHEN kind IN ('logo', 'photo') THEN 'describe_only' ELSE 'extract_and_describe' END AS mode FROM (SELECT part, CASE WHEN alt LIKE 'Формула%' THEN 'equation_img' WHEN lower(alt) LIKE 'график%' THEN 'chart' WHEN part % 7 < 2 THEN 'diagram'
  WHEN part % 7 = 2 THEN 'text_scan' WHEN part % 11 = 5 THEN 'table_scan' WHEN part % 11 = 6 THEN 'diagram' WHEN w < 96 THEN 'logo' WHEN suffix = '.JPG' THEN 'photo' ELSE 'unknown' END AS kind FROM ({_IMAGES}))"""
)
def q52_image_kind(spark, sf):
    kind = T.image_kind(F.col("stem"), F.col("suffix"), F.col("alt"), F.col("w"), F.col("h"))
    return derived(spark, sf, _IMAGES).select("part", kind.alias("kind"), T.prompt_mode(kind).alias("mode"))


# answers and files as wholes

_RAW = """SELECT o_orderkey AS doc, concat('Here: {"form": " TTN  1 ", "series": "a b.", "number": "№ 00', o_orderkey, '-7", "date": null, "extra": [1], "basis": ', o_custkey, ', "shipper": ',
  CASE o_orderkey % 4 WHEN 0 THEN '" Firm  A "' WHEN 1 THEN '{"name": "none", "unp": "19 000 0001", "x": 1}' WHEN 2 THEN '7' ELSE 'null' END, ', "items": ',
  CASE o_orderkey % 3 WHEN 0 THEN 'null' WHEN 1 THEN '"no list"' ELSE concat('[{"name": " x  ', o_orderkey, '", "quantity": ', o_custkey, ', "note": "-"}, "stray", {"name": "НЕТ"}]') END,
  ', "totals": ', CASE WHEN o_orderkey % 5 = 0 THEN '"none"' ELSE concat('{"cost": "', o_custkey, ',50"}') END, '}', CASE WHEN o_orderkey % 7 = 0 THEN ']' ELSE ' ok' END) AS answer FROM {orders}"""


@query(
    """SELECT o_orderkey AS doc, 'TTN 1' AS form, 'АВ' AS series, '00' || o_orderkey || '7' AS number, NULL::VARCHAR AS date, o_custkey::VARCHAR AS basis, CASE WHEN o_orderkey % 4 = 0 THEN 'Firm A' END AS shipper, CASE WHEN o_orderkey % 4 = 1 THEN '190000001' END AS unp,
  CASE WHEN o_orderkey % 3 = 2 THEN 2 ELSE 0 END AS items, CASE WHEN o_orderkey % 3 = 2 THEN 'x ' || o_orderkey END AS item, CASE WHEN o_orderkey % 3 = 2 THEN o_custkey::VARCHAR END AS quantity, NULL::VARCHAR AS second, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey || ',50' END AS cost FROM {orders}"""
)
def q53_waybill_coercion(spark, sf):
    """Answers with unknown keys, numbers for texts and texts for lists, as records."""
    w = derived(spark, sf, _RAW).select("doc", waybill.coerce_waybill(answers.first_json(F.col("answer"))).alias("w"))
    first, second = F.get("w.items", F.lit(0)), F.get("w.items", F.lit(1))
    return w.select(
        "doc", "w.form", "w.series", "w.number", "w.date", "w.basis", F.col("w.shipper.name").alias("shipper"), F.col("w.shipper.unp").alias("unp"), F.size("w.items").alias("items"),
        first["name"].alias("item"), first["quantity"].alias("quantity"), second["name"].alias("second"), F.col("w.totals.cost").alias("cost"),
    )


_WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def _package(text: str) -> bytes:
    """A word document: its first paragraph a heading by its style, a line of text a paragraph, last a table."""
    run = lambda t: f'<w:r><w:t xml:space="preserve">{escape(t, {chr(13): "&#13;"})}</w:t></w:r>'
    para = lambda t, style="": f"<w:p>{style}{run(t)}</w:p>"
    row = lambda *t: "<w:tr>" + "".join(f"<w:tc>{para(x)}</w:tc>" for x in t) + "</w:tr>"
    body = para("Document", '<w:pPr><w:pStyle w:val="H"/></w:pPr>') + "".join(map(para, text.split("\n"))) + f"<w:tbl>{row('a', 'b', 'c')}{row('1', '2', '3')}</w:tbl>"
    styles = f'<w:styles xmlns:w="{_WORD}"><w:style w:type="paragraph" w:styleId="H"><w:name w:val="heading 2"/></w:style></w:styles>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="{_WORD}"><w:body>{body}</w:body></w:document>')
        z.writestr("word/styles.xml", styles)
    return out.getvalue()


@F.pandas_udf(BinaryType())
def _packages(texts: pd.Series) -> pd.Series:
    return texts.fillna("").map(_package)


_STRIPPED = "regexp_replace(x, '^[\\s\\x{00A0}]+|[\\s\\x{00A0}]+$', '', 'g')"


@query(
    f"""SELECT doc, format, CASE format WHEN 'txt' THEN CASE WHEN len(p) = 0 THEN '' ELSE array_to_string(p, chr(10) || chr(10)) || chr(10) END
    WHEN 'docx' THEN array_to_string(['## Document'] || w || ['| a | b | c |' || chr(10) || '|---|---|---|' || chr(10) || '| 1 | 2 | 3 |'], chr(10) || chr(10)) || chr(10) END AS md,
  CASE format WHEN 'pdf' THEN 'outside input needed: pdf' WHEN 'docm' THEN 'unreadable document' END AS error FROM (SELECT doc_id AS doc, CASE doc_id % 9 WHEN 0 THEN 'pdf' WHEN 1 THEN 'docm' ELSE CASE WHEN doc_id % 2 = 0 THEN 'docx' ELSE 'txt' END END AS format,
    list_filter(list_transform(regexp_split_to_array(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '\\n[ \\t]*\\n'), lambda x: {_STRIPPED}), lambda x: x <> '') AS p,
    list_filter(list_transform(string_split(text, chr(10)), lambda x: {_STRIPPED}), lambda x: x <> '') AS w FROM {{documents}})"""
)
def q54_parse_documents(spark, sf):
    """Documents as files of several formats, from bytes to Markdown."""
    d, text = table(spark, sf, "documents"), F.col("text")
    n = F.col("doc_id")
    kind = F.when(n % 9 == 0, "pdf").when(n % 9 == 1, "docm").when(n % 2 == 0, "docx").otherwise("txt")
    content = F.when(kind == "docx", _packages(F.when(kind == "docx", text))).otherwise(F.encode(text, "UTF-8"))
    f = d.select(F.concat(F.lit("in/"), n.cast("string"), F.lit("."), kind).alias("path"), content.alias("content"))
    doc = F.regexp_extract("path", r"(\d+)\.", 1).cast("long").alias("doc")
    return documents.parse(f).select(doc, "format", F.col("markdown").alias("md"), "error")


@query(
    """SELECT doc_id AS doc, 'На картинке из документа ' || CASE doc_id % 3 WHEN 0 THEN 'схема' WHEN 1 THEN 'логотип' ELSE 'изображение' END || '.' || CASE WHEN doc_id % 2 = 0 THEN ' Подпись: «' || source || '».' ELSE '' END || chr(10) || 'Ответь разделами:' || chr(10) || 'Описание: …'
    || CASE WHEN doc_id % 3 = 1 THEN '' ELSE chr(10) || 'Текст с изображения: …' || chr(10) || 'Анализ: …' END AS image,
  'Скан страницы ' || doc_id || '.' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN 'Перепиши все подписи схемы.' ELSE 'Перепиши страницу в Markdown, по порядку чтения.' END || CASE WHEN doc_id % 4 = 0 THEN chr(10) || 'Это полоса 1 из 2; обрезанные строки не дописывай.' ELSE '' END
    || CASE WHEN doc_id % 5 = 0 THEN chr(10) || 'Метки [FIGURE k], [TABLE k] и [HAND k] перепиши как есть, отдельной строкой.' ELSE '' END || chr(10) || 'Ответь разделами:' || chr(10) || 'Описание: …' || chr(10) || 'Текст с изображения: …' || chr(10) || 'Анализ: …' AS page,
  CASE WHEN doc_id % 6 < 3 THEN '' ELSE chr(10) || 'По линиям бланка столбцов: ' || doc_id % 6 || '. Пустая клетка остаётся пустой.' END AS grid,
  'Read' || CASE WHEN regexp_matches(text, '[^\\s\\x{00A0}]') THEN chr(10) || 'Подсказка; при расхождении верна картинка.' || chr(10) || '<<<' || chr(10) || substring(text, 1, 6000) || chr(10) || '>>>' ELSE '' END AS layer FROM {documents}"""
)
def q55_prompts(spark, sf):
    """Prompts of pictures, pages, grids and text layers; the limit of the layer is the model's."""
    d, n = table(spark, sf, "documents"), F.col("doc_id")
    kind = F.when(n % 3 == 0, "diagram").when(n % 3 == 1, "logo").otherwise("other")
    part = F.when(n % 4 == 0, 1)
    return d.select(
        n.alias("doc"), prompts.image_prompt(T.prompt_mode(kind), kind, F.when(n % 2 == 0, F.col("source")).otherwise("")).alias("image"),
        prompts.page_prompt(kind, n, n % 5 == 0, part, F.lit(2)).alias("page"), prompts.grid_hint(n % 6).alias("grid"), prompts.with_text_layer(F.lit("Read"), F.col("text")).alias("layer"),
    )


_SCANS = "SELECT conv_id AS doc, turn AS page, turn % 3 = 1 AS scanned, text AS md, CASE WHEN conv_id % 2 = 0 THEN concat('# h', chr(10), text) ELSE text END AS body, conv_id % 5 > 0 AS was_read FROM {conversations}"


@query(
    f"""SELECT doc, string_agg(CASE WHEN NOT scanned THEN md WHEN NOT was_read THEN '<!-- page ' || page || ': not read -->' ELSE '<!-- pdf-scan:begin page="' || page || '" sha256="' || sha256(md) || '" kind="text_scan" source="a –> ''b''" -->' || chr(10) || chr(10)
    || CASE WHEN doc % 2 = 0 THEN '' ELSE '## Page ' || page || chr(10) || chr(10) END || body || chr(10) || chr(10) || '<!-- pdf-scan:end page="' || page || '" -->' END, chr(10) || chr(10) ORDER BY page) AS md FROM ({_SCANS}) GROUP BY doc"""
)
def q56_scan_blocks(spark, sf):
    """Scanned pages take what was read of them, between marks, or say that nothing was."""
    p = derived(spark, sf, _SCANS)
    block = markdown.scan_block(F.col("page"), F.sha2(F.col("md").cast("binary"), 256), F.lit("text_scan"), F.lit(' a  --> "b"'), F.col("body"))
    return markdown.fill_pages(p.select("doc", "page", "md", "scanned"), p.filter("scanned AND was_read").select("doc", "page", block.alias("block")))


@query(
    """SELECT p_partkey AS part, p_name || ', (' || p_type || ')' AS joined, 'АБ ' || p_name || ' y' AS plain, p_partkey % 4 < 3 AS letterhead FROM {part}"""
)
def q57_text_rules(spark, sf):
    """Runs joined, letter macros resolved, letterheads told from headings: of a university's, no other letters stand beside the word."""
    name, kind = F.col("p_name"), F.col("p_type")
    n = F.col("p_partkey") % 4
    head = F.when(n == 0, F.concat(F.lit("Кафедра "), name)).when(n == 1, F.concat(F.lit("("), name, F.lit(")"))).when(n == 2, "«УНИВЕРСИТЕТ» № 2").otherwise(name)
    macros = F.concat(F.lit("\\CYRA \\CYRB "), name, F.lit(" \\text{y}"))
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("part"), T.join_runs(F.array(name, F.lit(","), F.lit("("), F.lit(""), kind, F.lit(")"))).alias("joined"),
        T.unlatex(macros, {"\\CYRA": "А", "\\CYRB": "Б"}).alias("plain"), T.title_block(head).alias("letterhead"),
    )


_PICTURES = "SELECT conv_id AS doc, turn AS pos, CASE turn % 3 WHEN 0 THEN 'image/PNG' WHEN 1 THEN 'image/jpeg' ELSE 'image/x' END AS mime, CASE WHEN turn % 4 = 2 THEN NULL ELSE text END AS content FROM {conversations}"


@query(
    f"""SELECT doc, pos, CASE WHEN content IS NOT NULL THEN 'm/img-' || lpad(n::VARCHAR, greatest(3, length(n::VARCHAR))::INT, '0') || CASE pos % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' ELSE '.bin' END END AS link
  FROM (SELECT *, count(content) OVER (PARTITION BY doc ORDER BY pos) AS n FROM ({_PICTURES}))"""
)
def q58_media_names(spark, sf):
    return markdown.media_names(derived(spark, sf, _PICTURES), ["doc"], "m/").select("doc", "pos", "link")


_TRIES = "SELECT cast(floor(event_id / 3) as bigint) AS id, event_id % 3 AS attempt, CASE WHEN event_id % 4 = 0 THEN 'none' ELSE concat('```json', chr(10), props, '```') END AS answer, event_id % 5 = 0 AS from_cache, event_id, props FROM {events}"


@query(f"SELECT id, min_by(props::VARCHAR, attempt) FILTER (event_id % 4 <> 0) AS json, count(*) FILTER (NOT from_cache) AS calls FROM ({_TRIES}) GROUP BY id")
def q59_attempts(spark, sf):
    return answers.attempts(derived(spark, sf, _TRIES), ["id"])


@query(
    f"""SELECT page, id, greatest(0, trunc(l - 2.5)::INT) AS l, greatest(0, trunc(t - 2.5)::INT) AS t, least(800, trunc(r + 3.0)::INT) AS r, least(700, trunc(b + 3.0)::INT) AS b, CASE WHEN score = 0 THEN 300 ELSE least(450, greatest(300, score * 60)) END AS render,
  round(CASE WHEN score * 20 > 96 THEN score * 20 ELSE greatest(score * 20, least(r, b) / {210 / 25.4!r}::DOUBLE) END, 4)::DOUBLE AS frame, greatest(28, round_even(r * least(1.0::DOUBLE, 1000::DOUBLE / greatest(r, b)) / 28, 0) * 28)::INT AS sent FROM ({BOXES})"""
)
def q60_pixel_rules(spark, sf):
    """Crops in whole pixels, resolutions, sides as sent."""
    x = _boxes(spark, sf)
    r, b, score = F.col("box.r"), F.col("box.b"), F.col("score")
    x = x.select(
        "page", "id", G.clamped(F.col("box"), F.lit(800), F.lit(700), 2.5).alias("box"), G.render_dpi(F.when(score > 0, score * 60)).alias("render"),
        F.round(G.frame_dpi((score * 20).cast("double"), r, b), 4).alias("frame"), G.sent_side(r, F.greatest(r, b), 1000).alias("sent"),
    )
    return _flat(x, "page", "id", "render", "frame", "sent")
