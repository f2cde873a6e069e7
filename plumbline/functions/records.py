"""Fields of loosely typed records: kinds, ranges, boxes, numbers and truth values, null where they make no sense."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names and synonyms must equal those that predictions are read with.
KINDS = {
    "door": "door", "doorway": "door", "entry": "door", "entrance": "door",
    "window": "window", "windows": "window",
    "pass-through": "pass-through", "passthrough": "pass-through", "arch": "pass-through", "archway": "pass-through",
}
PROVENANCE = ("geometry", "rgb", "roomformer", "fused")
FALSE = ("false", "0", "no", "none", "unknown", "unobserved", "missing")


def _stripped(x: Column) -> Column:
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def finite(x: Column, default: float | None = None) -> Column:
    """x as a number, or the default where it is null, not a number or not finite."""
    x = x.try_cast("double")
    return F.coalesce(F.when(~F.isnan(x) & (F.abs(x) < math.inf), x), F.lit(default).cast("double"))


def status(x: Column) -> Column:
    """A status word: trimmed, lower case, blanks as underscores; `unknown` if there is none."""
    s = F.replace(F.lower(_stripped(x)), F.lit(" "), F.lit("_"))
    return F.when(F.coalesce(s, F.lit("")) == "", "unknown").otherwise(s)


def truth(x: Column, default: bool = False) -> Column:
    """A truth value from a word; other words are true, a null is the default."""
    s = status(x)
    return F.when(x.isNull(), F.lit(default)).when(s.isin(*FALSE), False).otherwise(True)


def opening_kind(x: Column) -> Column:
    """door, window or pass-through; null for any other word."""
    s = F.regexp_replace(F.regexp_replace(F.lower(_stripped(x)), r"^[.,;:]+|[.,;:]+$", ""), "_", "-")
    s = F.regexp_replace(_stripped(s), r"\s+", "-")
    names = F.create_map(*[F.lit(v) for pair in KINDS.items() for v in pair])
    return F.try_element_at(names, s)


def value_range(a: Column, b: Column) -> Column:
    """(low, high) of two numbers; null unless both are finite and they differ."""
    a, b = finite(a), finite(b)
    return F.when(a != b, F.struct(F.least(a, b).alias("low"), F.greatest(a, b).alias("high")))


def metric_range(direct: Column, offset: Column, size: Column) -> Column:
    """The given (low, high) if it makes sense, else the range from an offset and a size."""
    start = finite(offset)
    return F.coalesce(value_range(direct["low"], direct["high"]), value_range(start, start + finite(size)))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """(x0, y0, x1, y1) with its corners in order; null if it is empty or not finite."""
    u, v = value_range(x0, x1), value_range(y0, y1)
    return F.when(u.isNotNull() & v.isNotNull(), F.array(u["low"], v["low"], u["high"], v["high"]))


def box_pixels(b: Column, height: Column, width: Column, form: Column) -> Column:
    """A box in pixels, from pixels, shares of the image or thousandths; an unnamed form is guessed from the numbers."""
    form = F.lower(F.coalesce(form, F.lit("")))
    low, high = F.array_min(b), F.array_max(b)
    pixels = form.isin("pixel", "pixels", "xyxy")
    share = form.isin("normalized", "normalized_01", "01") | ((form == "") & (high <= 1) & (low >= 0))
    thousandth = form.isin("sd-tq", "normalized_1000", "1000") | ((form == "") & (high <= 1000) & (low >= 0))
    scaled = lambda k: F.array(b[0] * width / k, b[1] * height / k, b[2] * width / k, b[3] * height / k)
    return F.when(pixels, b).when(share, scaled(1.0)).when(thousandth, scaled(1000.0)).otherwise(b)


def provenance(values: Column) -> Column:
    """Known sources in their order, each once; `geometry` if there is none."""
    known = F.array_distinct(F.filter(F.transform(values, lambda v: F.lower(_stripped(v))), lambda v: v.isin(*PROVENANCE)))
    return F.when(F.coalesce(F.size(known), F.lit(0)) <= 0, F.array(F.lit("geometry"))).otherwise(known)


def wall_index(x: Column, names: Column) -> Column:
    """A wall's number from its name in the map `names`, or from digits; else null."""
    return F.coalesce(F.try_element_at(names, x), F.when(F.trim(x).rlike(r"^[+-]?\d+$"), F.trim(x).try_cast("int")))


def sigma_of(uncertainty: Column, key: str) -> Column:
    """A number of 0 or more from a map of texts; 0 where it is missing or no number."""
    return F.greatest(F.lit(0.0), F.coalesce(F.try_element_at(uncertainty, F.lit(key)).try_cast("double"), F.lit(0.0)))


def fill_fraction(pixels: Column, b: Column) -> Column:
    """Mask pixels by the box's area, which counts as 1 at least."""
    return pixels / F.greatest((b[2] - b[0]) * (b[3] - b[1]), F.lit(1.0))


def region_text(surface: Column, area: Column, damage_class: Column, combined: Column, category: Column, subtype: Column, v0: Column, v1: Column) -> Column:
    """A damage region as a sentence."""
    band = F.when(v0 < 0.15, F.format_string("lower %.2f m affected", v1)).otherwise(F.format_string("between %.2f and %.2f m", v0, v1))
    label = F.when((damage_class == "combined") & (F.coalesce(F.size(combined), F.lit(0)) > 1), F.concat(combined[0], F.lit("+"), combined[1], F.lit(" combined")))
    label = label.when((damage_class == "water") & F.coalesce(category > 0, F.lit(False)), F.format_string("Cat %d water", category))
    label = label.when(F.coalesce(subtype != "", F.lit(False)), F.concat(damage_class, F.lit(" ("), subtype, F.lit(")"))).otherwise(damage_class)
    return F.concat(surface, F.format_string(": %.2f m2 ", area), label, F.lit(", "), band)


def wall_name(name: Column, numbers: list[Column]) -> Column:
    """A wall's own name, or one made from its geometry to eight places."""
    shown = [F.when(n.isNull() | F.isnan(n) | (F.abs(n) == math.inf), "nan").otherwise(F.format_string("%.8f", n)) for n in numbers]
    nx, ny, offset, x0, y0, x1, y1 = shown
    text = F.concat_ws("|", F.concat_ws(",", nx, ny), offset, F.concat_ws(",", x0, y0), F.concat_ws(",", x1, y1))
    made = F.concat(F.lit("wall_"), F.substring(F.sha1(text), 1, 12))
    return F.when(F.coalesce(name, F.lit("")) != "", name).otherwise(made)
