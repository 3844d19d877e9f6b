"""Column functions over printed text: clean-up, captions, headings, links, list marks.

Java's ``\\s``, ``\\w`` and ``\\b`` are ASCII unless ``(?U)`` is given; all patterns here
that mean any script give it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that stand for no value, and printed look-alikes of Cyrillic letters.
NULL_WORDS = ("null", "none", "-", "—", "нет")
LATIN, CYRILLIC = "ABCEHKMOPTXY", "АВСЕНКМОРТХУ"
# Caption and heading forms.
CAPTION = r"(таблица|табл\.?|рисунок|рис\.?)\s*(?:[а-яa-z]\.)?\d+(?:\.\d+)*(?:[\s.–—:-].*)?"
BARE_CAPTION = r"(?:таблица|табл\.?|рисунок|рис\.?)\s*(?:[а-яa-z]\.)?\d+(?:\.\d+)*\.?"
SCHEME_CAPTION = r"схема\s+\S.{0,78}[^.]"
MAX_HEADING, MAX_LEVEL = 100, 6
# Letters and numerals of list numbers.
RUSSIAN = "абвгдежзиклмнопрстуфхцчшщэюя"
LATIN_LETTERS = "abcdefghijklmnopqrstuvwxyz"
ROMAN = ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i"))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(c, r"(?U)\s+", " "))


def count_of(c: Column, what: str) -> Column:
    """How often a string of one character occurs."""
    return F.length(c) - F.length(F.replace(c, F.lit(what), F.lit("")))


def null_text(c: Column) -> Column:
    """Collapsed text; words that stand for no value are null."""
    t = collapse(c.cast("string"))
    return F.when((t == "") | F.lower(t).isin(*NULL_WORDS), None).otherwise(t)


def series(c: Column) -> Column:
    """A form's series: no space or point, upper case, Cyrillic letters for their Latin look-alikes."""
    return F.translate(F.upper(F.regexp_replace(c, r"(?U)[\s.]", "")), LATIN, CYRILLIC)


def form_number(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit("№"), F.lit("")), r"(?U)[^\w]", "")


def comment_safe(c: Column) -> Column:
    """Text that may stand in an HTML comment's attribute."""
    return F.replace(F.replace(collapse(c), F.lit("-->"), F.lit("–>")), F.lit('"'), F.lit("'"))


def trim_hint(c: Column, limit: int = 1500) -> Column:
    """Units of up to 12 characters that repeat 7 times and more become one; cut at ``limit``,
    at the last line end if that lies in the second half."""
    t = F.regexp_replace(c, r"(?s)(.{1,12}?)\1{6,}", "$1")
    cut = F.substring(t, 1, limit)
    at = limit - F.instr(F.reverse(cut), "\n")  # characters before the last line end
    at_line = (F.instr(cut, "\n") > 0) & (at > limit // 2)
    return F.when(F.length(t) <= limit, t).when(at_line, F.substring(cut, F.lit(1), at)).otherwise(cut)


def html_text(c: Column) -> Column:
    """Markup to lines of text: block ends and breaks are line ends, tags go, entities stay."""
    t = F.regexp_replace(c, r'(?i)\s*data-bbox="[^"]*"', "")
    t = F.regexp_replace(t, r"(?i)</(?:p|div|li|tr|h[1-6]|table)>|<br\s*/?>", "\n")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    lines = F.transform(F.split(t, "\n"), lambda x: collapse(x))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def paragraphs(c: Column) -> Column:
    """Plain text to Markdown: blank lines part paragraphs, and one follows each but the last."""
    t = F.regexp_replace(c, r"\r\n?", "\n")
    parts = F.filter(F.transform(F.split(t, r"\n[ \t]*\n"), strip), lambda x: x != "")
    return F.when(F.size(parts) == 0, "").otherwise(F.concat(F.array_join(parts, "\n\n"), F.lit("\n")))


def caption_kind(c: Column) -> Column:
    """table or figure for a caption, else null."""
    t = strip(c)
    is_caption = F.regexp_like(t, F.lit(r"(?isU)\A" + CAPTION + r"\z"))
    return F.when(is_caption, F.when(F.lower(t).startswith("табл"), "table").otherwise("figure"))


def section_number(c: Column) -> Column:
    n = F.regexp_extract(c, r"(?U)^(\d+(?:\.\d+)*)\.?\s+\S", 1)
    return F.when(n != "", n)


def section_level(number: Column) -> Column:
    return F.when(number.isNotNull(), F.least(count_of(number, ".") + 1, F.lit(MAX_LEVEL)))


def section_parent(number: Column) -> Column:
    return F.regexp_extract(number, r"^(.*)\.[^.]*$", 1)


def heading_features(text: Column, bold: Column, in_list: Column) -> dict[str, Column]:
    """What of a heading depends on its line alone. ``sure``: its level if it is one without
    regard to what came before; ``number``: set where a known parent would make it one."""
    letters = F.regexp_replace(text, r"[^\p{L}]", "")
    fits = (
        (F.length(text) <= MAX_HEADING)
        & (text != "")
        & ~F.regexp_like(text, F.lit(r"[\t\n]"))
        & ~F.right(text, F.lit(1)).isin(".", ",", ";", ":")
        & ~F.regexp_like(text, F.lit(r"\A[a-z_][a-z0-9_]*\z"))
        & caption_kind(text).isNull()
        & (F.length(letters) >= 3)
    )
    fits = F.coalesce(fits, F.lit(False))
    caps = F.regexp_like(letters, F.lit(r"\A\p{Lu}*\z"))
    number = section_number(text)
    level = F.when(number.isNotNull(), section_level(number)).otherwise(F.lit(1))
    sure = F.when(fits & in_list & caps, F.lit(1)).when(fits & ~in_list & (bold | (number.isNotNull() & caps)), level)
    return {"sure": sure, "number": F.when(fits & ~in_list, number), "level": level}


def title_block(c: Column) -> Column:
    """Letterhead lines, which are no headings."""
    head = F.regexp_like(c, F.lit(r"(?iU)\A(?:(?:министерство|учреждение образования|факультет|кафедра)\b.*|\(.*\))\z"))
    body = F.regexp_like(c, F.lit(r"(?iuU)\A[^a-zа-яё]*(?:УНИВЕРСИТЕТ|ИНСТИТУТ|АКАДЕМИЯ)[^a-zа-яё]*\z"))
    return head | (body & ~F.regexp_like(c, F.lit(r"\p{Ll}")))


def image_markdown(alt: Column, link: Column) -> Column:
    a = collapse(F.regexp_replace(alt, r"(?U)(?<!\w)\*+|\*+(?!\w)", ""))
    a = F.regexp_replace(a, r"([\[\]\\])", r"\\$1")
    to = F.when(F.regexp_like(link, F.lit(r"(?U)[\s()<>]")), F.concat(F.lit("<"), link, F.lit(">"))).otherwise(link)
    return F.concat(F.lit("!["), a, F.lit("]("), to, F.lit(")"))


def is_numeric(c: Column) -> Column:
    return F.regexp_like(strip(c), F.lit(r"(?U)\A[-+−–]?\d[\d\s.,]*%?\z"))


# marks that the word processor's numbers and scripts leave in texts

MARK = r"zqxnum([0-9a-f]*)zqx[ \t]?"


def marker_of(c: Column) -> Column:
    """The first number mark, decoded: "" for a bullet, null without one."""
    found = F.regexp_like(c, F.lit(MARK))
    return F.when(found, F.decode(F.unhex(F.regexp_extract(c, MARK, 1)), "UTF-8"))


def without_markers(c: Column) -> Column:
    return F.regexp_replace(c, MARK, "")


def list_bullet(marker: Column) -> Column:
    simple = F.regexp_like(marker, F.lit(r"\A\d+[.)]\z"))
    return F.when(marker.isNull() | (marker == ""), "-").when(simple, marker).otherwise(F.concat(F.lit("- "), marker))


def render_scripts(c: Column) -> Column:
    t = F.regexp_replace(c, r"(?sU)zqx(?:sup|sub)zqx(\s*)zqxendzqx", "$1")
    t = F.regexp_replace(t, r"(?s)zqx(sup|sub)zqx(.*?)zqxendzqx", "<$1>$2</$1>")
    return F.regexp_replace(t, r"(?U)</(sup|sub)>(\s*)<\1>", "$2")


def plain(c: Column) -> Column:
    """Without any marks."""
    return F.regexp_replace(c, r"zqx(?:num[0-9a-f]*|sup|sub|end)zqx[ \t]?", "")


def finalize(c: Column) -> Column:
    """Marks left over become their numbers and a space."""
    marks = F.regexp_extract_all(c, F.lit(MARK), F.lit(1))

    def put(text: Column, mark: Column) -> Column:
        number = F.decode(F.unhex(mark), "UTF-8")
        whole = F.concat(F.lit("zqxnum"), mark, F.lit("zqx"))
        shown = F.when(number == "", "").otherwise(F.concat(number, F.lit(" ")))
        at = F.position(whole, text)
        after = F.substring(text, at + F.length(whole), F.length(text))
        after = F.when(F.substring(after, 1, 1).isin(" ", "\t"), F.substring(after, F.lit(2), F.length(after))).otherwise(after)
        return F.concat(F.substring(text, F.lit(1), at - 1), shown, after)

    return render_scripts(F.aggregate(marks, c, put))


def _letters(n: Column, alphabet: str) -> Column:
    n = F.greatest(n, F.lit(1))
    size = len(alphabet)
    letter = F.substring(F.lit(alphabet), F.pmod(n - 1, F.lit(size)) + 1, F.lit(1))
    return F.repeat(letter, F.floor((n - 1) / size).cast("int") + 1)


def _roman(n: Column) -> Column:
    """Greedy by value; as each value is used as often as it goes, division does."""
    out, left = [], n
    for value, sign in ROMAN:
        out.append(F.repeat(F.lit(sign), F.greatest(F.floor(left / value), F.lit(0)).cast("int")))
        left = left % value
    return F.concat(*out)


def list_number(n: Column, form: Column) -> Column:
    """A list number in the form that its level asks for."""
    n = n.cast("int")
    return (
        F.when(form == "decimalZero", F.format_string("%02d", n))
        .when(form == "lowerLetter", _letters(n, LATIN_LETTERS))
        .when(form == "upperLetter", F.upper(_letters(n, LATIN_LETTERS)))
        .when(form == "lowerRoman", _roman(n))
        .when(form == "upperRoman", F.upper(_roman(n)))
        .when(form == "russianLower", _letters(n, RUSSIAN))
        .when(form == "russianUpper", F.upper(_letters(n, RUSSIAN)))
        .when(form == "none", "")
        .otherwise(n.cast("string"))
    )


def image_kind(stem: Column, suffix: Column, alt: Column, width: Column, height: Column) -> Column:
    """What a picture shows, by its caption, name and size; the first rule that holds decides."""
    head = F.lower(strip(alt))
    return (
        F.when(head.startswith("формула") | head.startswith("объект"), "equation_img")
        .when(head.startswith("график"), "chart")
        .when(stem.startswith("page-") | F.regexp_like(stem, F.lit(r"\Ascan-\d+-fig-")), "diagram")
        .when(stem.startswith("scan-"), "text_scan")
        .when(head.startswith("таблица"), "table_scan")
        .when(head.contains("схем") | head.contains("диаграмм"), "diagram")
        .when(head.contains("график"), "chart")
        .when(head.contains("формул"), "equation_img")
        .when(F.least(width, height) < 96, "logo")
        .when(F.lower(suffix).isin(".jpg", ".jpeg"), "photo")
        .otherwise("unknown")
    )


def prompt_mode(kind: Column) -> Column:
    return F.when(kind.isin("logo", "photo"), "describe_only").otherwise("extract_and_describe")


def join_runs(runs: Column) -> Column:
    """Text runs with a space between, but not before closing or after opening punctuation."""
    tight = lambda acc, x: F.regexp_like(x, F.lit(r"\A[,.;:!?)\]}»…%]")) | F.regexp_like(acc, F.lit(r"[(\[{«„]\z"))
    full = F.filter(runs, lambda x: x != "")
    return F.aggregate(
        full, F.lit(""), lambda acc, x: F.when(acc == "", x).when(tight(acc, x), F.concat(acc, x)).otherwise(F.concat(acc, F.lit(" "), x))
    )


def rich_text(runs: Column) -> Column:
    """Runs (text, bold, italic, url) as Markdown. What all of them share is no emphasis; closing punctuation stays outside."""
    full = F.filter(runs, lambda r: strip(r["text"]) != "")
    all_bold, all_italic = F.forall(full, lambda r: r["bold"]), F.forall(full, lambda r: r["italic"])

    def piece(r: Column) -> Column:
        text = strip(r["text"])
        text = F.when(r["url"].isNotNull(), F.concat(F.lit("["), text, F.lit("]("), r["url"], F.lit(")"))).otherwise(text)
        mark = F.concat(F.when(r["bold"] & ~all_bold, "**").otherwise(""), F.when(r["italic"] & ~all_italic, "*").otherwise(""))
        core = F.regexp_replace(text, "[.,;:!?]+$", "")
        marked = F.concat(mark, core, mark, F.substring(text, F.length(core) + 1, F.length(text)))
        return F.when(F.regexp_like(text, F.lit(r"[\p{L}\p{N}]")), marked).otherwise(text)

    return join_runs(F.transform(full, piece))


def unlatex(c: Column, macros: dict[str, str]) -> Column:
    """Macros of letters to the letters, longest first; a single space between letters goes, of two one stays."""
    t = F.regexp_replace(c, r"\\text\{([^{}]*)\}", "$1")
    ordered = sorted(macros, key=len, reverse=True)
    t = reduce(lambda s, m: F.replace(s, F.lit(m), F.lit(macros[m])), ordered, t)
    return F.regexp_replace(t, r"(?U)(?<=\p{IsCyrillic}) (?=\p{IsCyrillic})", "")
