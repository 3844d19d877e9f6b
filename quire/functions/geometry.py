"""Box algebra over struct<l, t, r, b> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What a detector's label counts as.
ROLES = {
    "table": "table",
    "picture": "picture",
    "chart": "picture",
    "page_header": "margin",
    "page_footer": "margin",
    "form": "container",
    "key_value_region": "container",
    "document_index": "container",
}
# Lowest score by role that a raw detection needs.
LOWEST_SCORE = {"table": 0.15, "text": 0.3, "margin": 0.3, "picture": 0.5}


def box(l: Column, t: Column, r: Column, b: Column) -> Column:  # noqa: E741
    return F.struct(l.alias("l"), t.alias("t"), r.alias("r"), b.alias("b"))


def area(a: Column) -> Column:
    return F.greatest(F.lit(0), a["r"] - a["l"]) * F.greatest(F.lit(0), a["b"] - a["t"])


def cross(a: Column, b: Column) -> Column:
    """Area of the intersection."""
    w = F.least(a["r"], b["r"]) - F.greatest(a["l"], b["l"])
    h = F.least(a["b"], b["b"]) - F.greatest(a["t"], b["t"])
    return F.greatest(F.lit(0), w) * F.greatest(F.lit(0), h)


def iou(a: Column, b: Column) -> Column:
    x = cross(a, b)
    return F.when(x == 0, F.lit(0.0)).otherwise(x / (area(a) + area(b) - x))


def inside(a: Column, b: Column) -> Column:
    """Share of a's area that lies in b."""
    return F.when(area(a) == 0, F.lit(0.0)).otherwise(cross(a, b) / area(a))


def role(label: Column) -> Column:
    key = F.replace(F.lower(label), F.lit("-"), F.lit("_"))
    out = F.lit("text")
    for k, v in ROLES.items():
        out = F.when(key == k, v).otherwise(out)
    return out


def sure_enough(role_: Column, score: Column) -> Column:
    least = F.lit(None).cast("double")
    for k, v in LOWEST_SCORE.items():
        least = F.when(role_ == k, v).otherwise(least)
    return score >= least


def clamped(a: Column, width: Column, height: Column, pad: float) -> Column:
    """Padded to whole pixels within the page, cut towards zero."""
    cut = lambda x: x.cast("int")
    return box(
        F.greatest(F.lit(0), cut(a["l"] - pad)),
        F.greatest(F.lit(0), cut(a["t"] - pad)),
        F.least(width, cut(a["r"] + pad + 0.5)),
        F.least(height, cut(a["b"] + pad + 0.5)),
    )


def render_dpi(native: Column) -> Column:
    """The resolution to render at: the scan's own within 300 and 450."""
    return F.least(F.lit(450), F.greatest(F.lit(300), F.coalesce(native, F.lit(300))))


def frame_dpi(tag: Column, width: Column, height: Column) -> Column:
    """An image's resolution: its tag if that is over 96, else at least what makes it as wide as A4."""
    return F.when(tag > 96, tag).otherwise(F.greatest(tag, F.least(width, height) / F.lit(210 / 25.4)))


def sent_side(side: Column, longest: Column, long_edge: int) -> Column:
    """A side as sent to the layout model: a multiple of 28, at least 28, half to even."""
    scale = F.least(F.lit(1.0), F.lit(long_edge) / longest)
    return F.greatest(F.lit(28), F.bround(side * scale / 28) * 28).cast("int")
