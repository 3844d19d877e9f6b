"""Prompts as columns. Wordings are parameters: a prompt is part of a cached answer's key, so an edit asks anew."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .answers import SECTIONS, TEXT_LAYER_LIMIT

# Own wordings; a caller with a cache of answers passes those that it was filled with.
KINDS = {"logo": "логотип", "photo": "фотография", "diagram": "схема", "table_scan": "таблица", "chart": "график", "equation_img": "формула", "text_scan": "страница"}
TASKS = {
    "text_scan": "Перепиши страницу в Markdown, по порядку чтения.",
    "table_scan": "Перепиши таблицу в Markdown, клетка в клетку.",
    "table_tile": "Перепиши эту часть таблицы в Markdown вместе с шапкой.",
    "diagram": "Перепиши все подписи схемы.",
}
MARKS = "Метки [FIGURE k], [TABLE k] и [HAND k] перепиши как есть, отдельной строкой."


def _sections(*names: str) -> str:
    return "Ответь разделами:\n" + "\n".join(f"{n}: …" for n in names)


def image_prompt(mode: Column, kind: Column, caption: Column, kinds: dict[str, str] = KINDS) -> Column:
    """What to ask of a picture: a description alone, or its text and an analysis too; the caption is named if there is one."""
    what = F.coalesce(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair])[kind], F.lit("изображение"))
    named = F.when(F.coalesce(caption, F.lit("")) != "", F.concat(F.lit(" Подпись: «"), caption, F.lit("»."))).otherwise("")
    form = F.when(mode == "describe_only", _sections(SECTIONS[0])).otherwise(_sections(*SECTIONS))
    return F.concat(F.lit("На картинке из документа "), what, F.lit("."), named, F.lit("\n"), form)


def page_prompt(kind: Column, page: Column, markers: Column, part: Column, parts: Column, tasks: dict[str, str] = TASKS) -> Column:
    """What to ask of a scanned page; of a band of it if ``part`` is set, with marks of crops if ``markers``."""
    table = F.create_map(*[F.lit(x) for pair in tasks.items() for x in pair])
    lines = [
        F.format_string("Скан страницы %d.", page),
        F.coalesce(table[kind], F.lit(tasks["text_scan"])),
        F.when(part.isNotNull(), F.format_string("Это полоса %d из %d; обрезанные строки не дописывай.", part, parts)),
        F.when(markers, MARKS),
        F.lit(_sections(*SECTIONS)),
    ]
    return F.concat_ws("\n", *lines)


def grid_hint(columns: Column) -> Column:
    """How many columns the rules of a form have; under three they are a frame, not a grid."""
    return F.when(columns >= 3, F.format_string("\nПо линиям бланка столбцов: %d. Пустая клетка остаётся пустой.", columns)).otherwise("")


def with_text_layer(prompt: Column, text: Column, limit: int = TEXT_LAYER_LIMIT) -> Column:
    """A prompt with the start of the page's text layer as a hint, if that holds anything."""
    has = F.regexp_like(F.coalesce(text, F.lit("")), F.lit(r"(?U)\S"))
    hint = F.concat(F.lit("\nПодсказка; при расхождении верна картинка.\n<<<\n"), F.substring(text, 1, limit), F.lit("\n>>>"))
    return F.when(has, F.concat(prompt, hint)).otherwise(prompt)
