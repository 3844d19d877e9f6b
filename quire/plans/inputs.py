"""Logical inputs of the catalogue, derived from the driver's tables.

Each is one SQL text that Spark and DuckDB read alike; ``{table}`` stands for a driver
table. ``derived`` runs it in Spark, ``duck`` gives DuckDB's form.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = re.compile(r"\{(region|nation|customer|supplier|part|orders|lineitem|events|documents|conversations|pages)\}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    names = sorted(set(TABLES.findall(sql)))
    text = sql.replace("{", "{{").replace("}", "}}")  # other braces are text
    for n in names:
        text = text.replace("{{" + n + "}}", "{" + n + "}")
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


def duck(sql: str) -> str:
    return TABLES.sub(r"\1", sql)


def money(cents: str) -> str:
    """Cents printed with a decimal comma."""
    return f"concat(cast(floor(({cents}) / 100) as bigint), ',', lpad(concat(({cents}) % 100, ''), 2, '0'))"


_ROW = """cast(row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_quantity,
  l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) as int)"""

#: Item rows in whole cents: prices are exact, some VAT and totals are off.
CENTS = f"""SELECT *, c + vat + CASE WHEN supp % 13 = 1 THEN 100 ELSE 0 END AS total FROM (
  SELECT *, cast(round(c * rate / 100) as bigint) + CASE WHEN part % 10 = 3 THEN 5 ELSE 0 END AS vat FROM (
    SELECT l_orderkey AS doc, {_ROW} AS n, l_partkey AS part, l_suppkey AS supp, cast(l_quantity as int) AS qty,
      cast(round(l_extendedprice * 100) as bigint) AS c,
      cast(round(l_extendedprice * 100 / l_quantity) as bigint) + CASE WHEN l_partkey % 17 = 2 THEN 3 ELSE 0 END AS p,
      cast(round(l_tax * 100) as int) AS rate, cast(round(l_discount * 100) as int) AS off
    FROM {{lineitem}}) AS a) AS b"""

#: The same rows as printed on a form.
ITEMS = f"""SELECT doc, n AS rownum, concat('part ', part) AS name, concat(qty, '') AS quantity, {money('p')} AS price, {money('c')} AS cost,
  concat(rate, '%') AS vat_rate, {money('vat')} AS vat, {money('total')} AS cost_with_vat, concat(qty % 7, '') AS places,
  concat(qty * 2, '.5') AS mass FROM ({CENTS}) AS i"""

#: Boxes: a page is an order, a box is one of its rows.
BOXES = f"""SELECT page, id, role, score, l, t, l + w AS r, t + h AS b FROM (
  SELECT l_orderkey AS page, {_ROW} AS id, CASE l_linenumber % 3 WHEN 0 THEN 'table' WHEN 1 THEN 'text' ELSE 'picture' END AS role,
    cast(round(l_discount * 100) as int) AS score, cast(l_partkey * 7 % 500 as int) AS l, cast(l_suppkey * 13 % 500 as int) AS t,
    cast(l_quantity as int) * 9 + 20 AS w, l_linenumber * 60 AS h FROM {{lineitem}}) AS x"""

#: Pages of files: a file is a user, a page an event in order of time.
PAGES = """SELECT user_id AS file, cast(row_number() over (partition by user_id order by ts, event_id) as int) AS page,
  CASE event_type WHEN 'purchase' THEN 'front' WHEN 'view' THEN 'Continuation.' WHEN 'signup' THEN 'front page' WHEN 'error' THEN 'back' ELSE 'other' END AS kind_raw,
  CASE WHEN event_id % 3 = 0 THEN 'layout' ELSE 'lines' END AS zones_source, event_id % 5 = 0 AS has_table,
  value > 50 AS has_number, event_id % 4 = 0 AS has_items, event_id, cast(floor(value) as int) AS v FROM {events}"""

_NUMBERED = """SELECT doc, pos, CASE pos % 4 WHEN 1 THEN concat(1 + pos % 3, ' ', head) WHEN 2 THEN concat(1 + pos % 3, '.', 1 + pos % 2, ' ', head)
  WHEN 3 THEN concat(1 + pos % 3, '.', 1 + pos % 2, '.1 ', head) ELSE head END AS text, pos % 8 = 1 AS bold, pos % 11 = 5 AS in_list FROM ("""

#: All lines of whole documents, with section numbers put before some; in Spark's dialect and in DuckDB's.
LINES = _NUMBERED + "SELECT doc_id AS doc, pos, head FROM {documents} LATERAL VIEW posexplode(split(text, '\\n')) AS pos, head) AS x"
LINES_DUCK = _NUMBERED + """SELECT doc_id AS doc, unnest(range(len(parts))) AS pos, unnest(parts) AS head
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)) AS x"""
