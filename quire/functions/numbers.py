"""Column functions from printed amounts to decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

AMOUNT, NUMBER = "decimal(38,6)", "decimal(28,6)"
# Number words, and stems of scales.
UNITS = {
    "ноль": 0, "один": 1, "одна": 1, "одно": 1, "два": 2, "две": 2, "три": 3, "четыре": 4, "пять": 5,
    "шесть": 6, "семь": 7, "восемь": 8, "девять": 9, "десять": 10, "одиннадцать": 11, "двенадцать": 12,
    "тринадцать": 13, "четырнадцать": 14, "пятнадцать": 15, "шестнадцать": 16, "семнадцать": 17,
    "восемнадцать": 18, "девятнадцать": 19, "двадцать": 20, "тридцать": 30, "сорок": 40, "пятьдесят": 50,
    "шестьдесят": 60, "семьдесят": 70, "восемьдесят": 80, "девяносто": 90, "сто": 100, "двести": 200,
    "триста": 300, "четыреста": 400, "пятьсот": 500, "шестьсот": 600, "семьсот": 700, "восемьсот": 800,
    "девятьсот": 900,
}
SCALES = {"тысяч": 1_000, "миллион": 1_000_000, "миллиард": 1_000_000_000}


def to_number(c: Column) -> Column:
    """A printed number as a decimal, null if it is none or has over 32 digits before the point. Of both
    separators the last one is the decimal one; several of one kind part thousands; a single one is decimal.

    Plain digits with one separator take one match; only other forms are cleaned. An operator that needs the
    number more than once makes a column of it first (``with_numbers``)."""
    c = c.cast("string")
    plain = F.regexp_like(c, F.lit(r"\A-?\d+(?:[.,]\d+)?%?\z"))
    s = F.lower(strip(F.replace(c, F.lit("\u00a0"), F.lit(" "))))
    s = F.replace(F.regexp_replace(s, r"руб\.?|коп\.?|byn|%", ""), F.lit(" "), F.lit(""))
    # several of one kind and none of the other: all part thousands; else the last one is decimal
    thousands = F.regexp_like(s, F.lit(r"\A[^.]*,[^.]*,[^.]*\z|\A[^,]*\.[^,]*\.[^,]*\z"))
    last = F.replace(F.regexp_replace(s, r"[.,](?=.*[.,])", ""), F.lit(","), F.lit("."))
    clean = F.when(thousands, F.regexp_replace(s, "[.,]", "")).otherwise(last)
    general = F.when(F.regexp_like(s, F.lit(r"\A-?[\d.,]*\d[\d.,]*\z")), clean.try_cast(AMOUNT))
    return F.when(plain, F.translate(c, ",%", ".").try_cast(AMOUNT)).otherwise(general)


def with_numbers(df: DataFrame, names: list[str], prefix: str = "_n_") -> DataFrame:
    """``df`` with the printed numbers of columns as decimals in columns of their own, null beyond 22 digits
    before the point. Each is parsed once: readers refer to the column."""
    return df.withColumns({prefix + n: to_number(F.col(n)).try_cast(NUMBER) for n in names})


def words_to_amount(c: Column) -> Column:
    """An amount in words or digits, roubles and kopecks; null without any number.

    A fold over the words: ``now`` gathers units until a scale moves them to ``total``; the
    first rouble word closes the whole part, and what follows counts in hundredths."""
    number = "decimal(20,2)"
    t = F.replace(F.lower(c), F.lit("ё"), F.lit("е"))
    t = F.regexp_replace(t, r"(?U)(?<=\d)\s+(?=\d{3}\b)", "")
    words = F.regexp_extract_all(t, F.lit(r"(\d+(?:[.,]\d+)?|[а-я]+)"), F.lit(1))
    units = F.create_map(*[F.lit(x).cast(number) if not isinstance(x, str) else F.lit(x) for kv in UNITS.items() for x in kv])
    zero, nothing = F.lit(0).cast(number), F.lit(None).cast(number)
    start = F.struct(zero.alias("total"), zero.alias("now"), nothing.alias("whole"), F.lit(False).alias("seen"), F.lit(False).alias("done"))

    def fold(a: Column, w: Column) -> Column:
        scale = nothing
        for stem, value in SCALES.items():
            scale = F.when(w.startswith(stem), F.lit(value).cast(number)).otherwise(scale)
        digit = F.regexp_like(w, F.lit(r"\A\d"))
        unit = units[w]
        add = F.when(digit, F.replace(w, F.lit(","), F.lit(".")).try_cast(number)).otherwise(unit)
        scaled = F.when(a["now"] == 0, F.lit(1).cast(number)).otherwise(a["now"]) * scale
        rouble = w.startswith("руб") & a["whole"].isNull()
        to = lambda total, now, whole, seen, done: F.struct(
            total.cast(number).alias("total"), now.cast(number).alias("now"), whole.cast(number).alias("whole"), seen.alias("seen"), done.alias("done")
        )
        yes, no = F.lit(True), F.lit(False)
        return (
            F.when(a["done"], a)
            .when(add.isNotNull(), to(a["total"], a["now"] + add, a["whole"], yes, no))
            .when(scale.isNotNull(), to(a["total"] + scaled, zero, a["whole"], yes, no))
            .when(rouble, to(zero, zero, a["total"] + a["now"], a["seen"], no))
            .when(w.startswith("коп"), to(a["total"], a["now"], a["whole"], a["seen"], yes))
            .otherwise(a)
        )

    def finish(a: Column) -> Column:
        rest = a["total"] + a["now"]
        return F.when(a["seen"], F.when(a["whole"].isNull(), rest).otherwise(a["whole"] + rest / 100)).cast(AMOUNT)

    return F.aggregate(words, start, fold, finish)


def amount_text(c: Column) -> Column:
    """1234567.5 as 1 234 567,50; half to even."""
    return F.translate(F.format_number(F.bround(c, 2), 2), ",.", " ,")
