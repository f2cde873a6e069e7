"""The scope rules: damage regions and rooms in, line items and concealed flags out.

regions(id, room_id, surface_key, surface_kind, damage_class, combined_classes, area, v0, v1, width,
height_extent, water_category, water_class, mold_condition, subtype), rooms(room_id, room_area,
room_height, perimeter, room_name), lengths of walls by region as run_length.  Rule values are
data: RULES can be replaced, from a file too.

A line item is (code, action, material, quantity, rule_id, source, basis), `catalogued` adds its
description, unit and trade.  Region items carry the region's keys, room items the room's and
derived_from, the regions that they stand for.
"""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .rule_values import RULES as RULES
from .rule_values import load_rules as load_rules

#: Height of a room that has none.
ROOM_HEIGHT = 2.4


def override(path: str, value: object, rules: dict | None = None) -> dict:
    """A copy of the rules with one dotted path set."""
    out = copy.deepcopy(rules or RULES)
    *head, last = path.split(".")
    at = out
    for p in head:
        at = at[p]
    at[last] = value
    return out


def involves(damage_class: str) -> Column:
    """Whether a region is of the class, or combined of classes that include it."""
    combined = F.coalesce(F.array_contains("combined_classes", damage_class), F.lit(False))
    return F.coalesce((F.col("damage_class") == damage_class) | ((F.col("damage_class") == "combined") & combined), F.lit(False))


def or_default(x: Column, default: float) -> Column:
    """x, or the default where it is null or 0."""
    return F.when(x.isNull() | (x == 0), F.lit(default)).otherwise(x)


def _lookup(table: dict, key: Column, default: object) -> Column:
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def _text(form: str, *cols: Column) -> Column:
    return F.format_string(form, *cols)


def _items(rows: DataFrame, *made: tuple[Column, str, str, Column | str, Column, str, str, Column | str], keep: tuple[str, ...] = ("id", "room_id")) -> DataFrame:
    """A line item for each (condition, code, action, material, quantity, rule, source, basis) that holds."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    keep = tuple(c for c in (*keep, "surface_key", "room_name", "derived_from") if c in rows.columns)
    items = [
        F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(code).alias("code"), F.lit(action).alias("action"), as_column(material).alias("material"), q.cast("double").alias("quantity"), F.lit(rule).alias("rule_id"), as_column(source).alias("source"), as_column(basis).alias("basis")))
        for c, code, action, material, q, rule, source, basis in made
    ]
    return rows.select(*keep, F.explode(F.filter(F.array(*items), lambda x: x.isNotNull())).alias("i")).select(*keep, "i.*")


def catalogued(items: DataFrame, rules: dict = RULES) -> DataFrame:
    """items with description, unit and trade by code; a code that the catalogue lacks is an error."""
    rows = [(k, v["description"], v["unit"], v["trade"]) for k, v in rules["line_items"].items()]
    table = items.sparkSession.createDataFrame(rows, "code string, description string, unit string, trade string")
    unknown = F.raise_error(F.concat(F.lit("no such line item: "), F.col("code")))
    out = items.join(F.broadcast(table), "code", "left")  # a row per code of the rules
    return out.withColumn("trade", F.when(F.col("trade").isNull(), unknown.cast("string")).otherwise(F.col("trade")))


def flood_cut(waterline: Column, rules: dict = RULES) -> Column:
    """Height to cut at: a margin above the waterline, at least a minimum, snapped up to a sheet line."""
    w = rules["water"]["flood_cut"]
    h = F.greatest(waterline + w["base_height"], F.lit(w["minimum_height"]))
    if not w.get("snap_to_standard"):
        return h
    out = F.lit(w["standard_heights"][-1])
    for s in reversed(w["standard_heights"]):
        out = F.when(h <= s + 1e-6, F.lit(s)).otherwise(out)
    return out


def flood_cut_basis(waterline: Column, rules: dict = RULES) -> Column:
    """The steps that led to the cut, as a sentence."""
    w = rules["water"]["flood_cut"]
    raw = waterline + w["base_height"]
    h = F.greatest(raw, F.lit(w["minimum_height"]))
    out = [_text("waterline %.2f m + %.2f m margin = %.2f m", waterline, F.lit(w["base_height"]), raw)]
    out.append(F.when(h > raw, _text(", raised to %.2f m minimum", F.lit(w["minimum_height"]))).otherwise(""))
    if w.get("snap_to_standard"):
        last = w["standard_heights"][-1]
        step = _text(", capped at full-height removal (%.2f m)", F.lit(last))
        for s in reversed(w["standard_heights"]):
            step = F.when(h <= s + 1e-6, F.when(h < s, _text(", snapped up to the %.2f m sheet line", F.lit(s))).otherwise("")).otherwise(step)
        out.append(step)
    return F.concat(*out)


def _drywall(rules: dict) -> tuple[Column, Column, Column, Column]:
    """(whether drywall is cut out, its area, the cut's height, its run) of a water region."""
    cat, known = _category(), rules["water"]["category_actions"]
    floor, ceiling = F.col("surface_kind") == "floor", F.col("surface_kind") == "ceiling"
    action = _lookup({k: v["drywall"] for k, v in known.items()}, cat, known[1]["drywall"])
    cut = ~floor & (action == "flood_cut") & (ceiling | F.coalesce(F.col("run_length") != 0, F.lit(False)))
    height, run = flood_cut(F.col("v1"), rules), F.least("width", "run_length")
    return cut, F.when(ceiling, F.col("area")).otherwise(height * run), height, run


def _category() -> Column:
    return or_default(F.col("water_category"), 1).cast("int")


def water_items(regions: DataFrame, rules: dict = RULES) -> DataFrame:
    w = rules["water"]
    cat, area = _category(), F.col("area")
    known = w["category_actions"]
    action = lambda part: _lookup({k: v[part] for k, v in known.items()}, cat, known[1][part])
    floor, ceiling = F.col("surface_kind") == "floor", F.col("surface_kind") == "ceiling"
    cut, removed, height, run = _drywall(rules)
    basis = F.when(ceiling, _text("ceiling water damage scoped by affected area (a ceiling has no waterline to cut above): %.2f m2", area)).otherwise(F.concat(flood_cut_basis(F.col("v1"), rules), _text("; cut %.2f m x %.2f m affected run", height, run)))
    replace = cat.isin(w["baseboard"]["replace_if_category"])
    along = _text("Baseboard follows the full %.2f m affected run, not the stain", run)
    why, s = action("source"), w["flood_cut"]["source"]
    matched = "Replacement matches the removed area"
    return _items(
        regions.where(involves("water")),
        (floor & (action("carpet") == "remove"), "carpet_remove", "remove", "carpet", area, "water.category_actions.3", why, _text("Cat %d: carpet is porous and not restorable; %.2f m2 affected", cat, area)),
        (floor & (action("carpet") == "clean_and_dry"), "carpet_clean", "clean", "carpet", area, "water.category_actions.2", why, _text("Cat %d: carpet cleanable, pad removed", cat)),
        (floor & (action("pad") == "remove"), "pad_remove", "remove", "carpet pad", area, "water.category_actions", why, "Pad is the most absorbent layer and is removed whenever wet"),
        (cut & ceiling, "drywall_remove", "remove", "drywall", removed, "water.category_actions.ceiling", s, basis),
        (cut & ~ceiling, "drywall_remove", "remove", "drywall", removed, "water.flood_cut", s, basis),
        (cut & ceiling, "drywall_replace", "replace", '1/2" drywall', removed, "water.category_actions.ceiling", s, matched),
        (cut & ~ceiling, "drywall_replace", "replace", '1/2" drywall', removed, "water.flood_cut", s, matched),
        (cut, "insulation_remove", "remove", "batt insulation", removed, "W-01", "IICRC S500 §12.2.4", "Cavity opened by the flood cut is inspected and wet batt removed"),
        (cut & ~ceiling & replace, "baseboard_replace", "replace", "baseboard", run, "water.baseboard", w["baseboard"]["source"], along),
        (cut & ~ceiling & ~replace, "baseboard_detach", "detach_and_reset", "baseboard", run, "water.baseboard", w["baseboard"]["source"], along),
        (~floor & cat.isin(w["antimicrobial"]["apply_for_categories"]), "antimicrobial_apply", "treat", "antimicrobial", area, "water.antimicrobial", w["antimicrobial"]["source"], _text("Cat %d requires antimicrobial over the affected area", cat)),
    )


def _per_room(regions: DataFrame, rooms: DataFrame, damage_class: str, *sums: Column) -> DataFrame:
    """Rooms with regions of the class, their total and other sums, and the regions' ids in order.

    derived_from holds what one room has of regions, which is the item's own value.
    """
    ids = F.array_sort(F.collect_list("id")).alias("derived_from")
    return regions.where(involves(damage_class)).groupBy("room_id").agg(F.sum("area").alias("total"), *sums, ids).join(rooms, "room_id")


def _height() -> Column:
    return or_default(F.col("room_height"), ROOM_HEIGHT)


def drying_items(regions: DataFrame, rooms: DataFrame, rules: dict = RULES) -> DataFrame:
    """Equipment per room: every area off the floor counts as wet wall, a room without height is 2.4 m high."""
    e = rules["water"]["drying_equipment"]
    m, h, v = e["air_movers"], e["dehumidifier"], e["monitoring_days"]
    floor = F.col("surface_kind") == "floor"
    part = lambda c: F.sum(F.when(c, F.col("area")).otherwise(0.0))
    x = _per_room(regions, rooms, "water", part(floor).alias("floor"), part(~floor).alias("wall"), F.max(or_default(F.col("water_class"), 2)).cast("int").alias("cls"))
    days = _lookup(v["class_days"], F.col("cls"), v["default"])
    count = F.greatest(F.lit(m["minimum"]), F.ceil(F.col("floor") * m["per_floor_area"] + F.col("wall") * m["per_wet_wall_area"]))
    volume = F.col("room_area") * _height()
    units = F.greatest(F.lit(h["minimum"]), F.ceil(volume * h["base_per_volume"] * _lookup(h["class_factors"], F.col("cls"), 1.0) / 10.0))
    yes = F.lit(True)
    return _items(
        x,
        (yes, "air_mover", "operate", "air mover", count * days, "water.drying_equipment.air_movers", m["source"], _text("%d units x %d days; %.1f m2 wet floor + %.1f m2 wet wall, Class %d", count, days, F.col("floor"), F.col("wall"), F.col("cls"))),
        (yes, "dehumidifier", "operate", "LGR dehumidifier", units * days, "water.drying_equipment.dehumidifier", h["source"], _text("%d unit(s) x %d days; %.1f m3 at Class %d", units, days, volume, F.col("cls"))),
        (yes, "monitoring_visit", "monitor", "drying monitoring", days, "water.drying_equipment.monitoring_days", v["source"], _text("Daily monitoring for %d days until drying goals are met", days)),
        keep=("room_id",),
    )


def mold_items(regions: DataFrame, rules: dict = RULES) -> DataFrame:
    """Material beyond the visible growth is removed and treated where it grows, and vacuumed at any condition."""
    m = rules["mold"]
    margin, passes = m["removal_margin"], m["hepa_vacuum_passes"]
    grown = (F.col("width") + 2 * margin) * (F.col("height_extent") + 2 * margin)
    treat = _lookup(m["condition_actions"], or_default(F.col("mold_condition"), 3).cast("int"), "remove_and_treat") == "remove_and_treat"
    return _items(
        regions.where(involves("mold")),
        (treat, "mold_remove", "remove", "contaminated material", grown, "mold.removal_margin", "IICRC S520 §12.1", _text("Visible growth %.2f m2 expanded by a %.2f m margin on all sides = %.2f m2", F.col("area"), F.lit(margin), grown)),
        (treat, "mold_treat", "treat", "antimicrobial", grown, "mold.condition_actions", "IICRC S520 §12", "Treatment covers the full remediated area"),
        (F.lit(True), "hepa_vacuum", "clean", "HEPA vacuum", grown * passes, "mold.hepa_vacuum_passes", "IICRC S520 §12.4", _text("%d passes over %.2f m2", F.lit(passes), grown)),
    )


def containment_items(regions: DataFrame, rooms: DataFrame, rules: dict = RULES) -> DataFrame:
    """Barrier, air scrubber and protection of rooms with much mold, sized to the room."""
    m = rules["mold"]
    c, a = m["containment"], m["air_scrubber"]
    total = F.col("total")
    x = _per_room(regions, rooms, "mold").where(total >= c["trigger_area"])
    size = F.when(total < m["size_thresholds"]["small"], "small").when(total < m["size_thresholds"]["medium"], "medium").otherwise("large")
    h, area, around = _height(), F.col("room_area"), F.col("perimeter")
    units = F.greatest(F.lit(a["minimum"]), F.ceil(area * h * a["per_volume"] / 10.0))
    ppe = _lookup({k: v for k, v in m["ppe"].items() if k != "source"}, size, None)
    return _items(
        x,
        (F.lit(True), "containment_barrier", "install", "6 mil poly", around * h + area, "mold.containment", c["source"], _text("%s remediation (%.2f m2 growth) requires %s containment: %.1f m perimeter x %.2f m + %.1f m2 ceiling", size, total, _lookup(c["type_by_size"], size, None), around, h, area)),
        (total >= c["negative_air_trigger"], "negative_air", "operate", "HEPA air scrubber", units * 3, "mold.air_scrubber", a["source"], _text("%d unit(s) x 3 days maintaining negative pressure in %.1f m3 of containment", units, area * h)),
        (F.lit(True), "ppe_set", "supply", ppe, F.lit(6.0), "mold.ppe", m["ppe"]["source"], _text("%s remediation: %s for 2 technicians x 3 days", size, ppe)),
        keep=("room_id",),
    )


def fire_items(regions: DataFrame, rules: dict = RULES) -> DataFrame:
    f = rules["fire"]
    subtype = F.when(F.coalesce("subtype", F.lit("")) == "", "soot").otherwise(F.col("subtype"))
    clean = _lookup(f["subtype_actions"], subtype, "clean_and_seal") == "clean_and_seal"
    area, s = F.col("area"), f["source"]
    return _items(
        regions.where(involves("fire")),
        (clean, "soot_clean", "clean", "soot residue", area, "fire.subtype_actions", s, _text("Soot on a sound substrate is cleaned: %.2f m2", area)),
        (clean & F.lit(f["seal_after_cleaning"]), "seal_surface", "seal", "odour-blocking primer", area * f["seal_coverage"], "fire.seal_after_cleaning", s, "Sealed after cleaning to lock down odour-bearing residue"),
        (~clean, "char_remove", "remove", "fire-damaged material", area, "fire.subtype_actions", s, _text("%s: substrate is compromised and replaced, %.2f m2", subtype, area)),
    )


def odour_items(regions: DataFrame, rooms: DataFrame, rules: dict = RULES) -> DataFrame:
    o = rules["fire"]["odour_treatment"]
    x = _per_room(regions, rooms, "fire").where(F.col("total") >= o["trigger_area"])
    basis = _text("%.2f m2 of fire damage exceeds the %.2f m2 deodorisation trigger", F.col("total"), F.lit(o["trigger_area"]))
    return _items(x, (F.lit(True), "odour_treatment", "treat", o["method"], F.lit(1.0), "fire.odour_treatment", o["source"], basis), keep=("room_id",))


def scope_build(regions: DataFrame, rooms: DataFrame, rules: dict = RULES) -> DataFrame:
    """The whole scope of work: (code, description, action, material, quantity, unit, trade, surface_ref, room_id,
    rule_id, source, basis, derived_from).

    Region items keep regions of unknown rooms; room items exist for known rooms only.  A combined
    region has the items of all of its classes.
    """
    part = regions.where(involves("water") | involves("mold") | involves("fire"))
    per_region = [f(part, rules).withColumn("derived_from", F.array("id")).withColumnRenamed("surface_key", "surface_ref") for f in (water_items, mold_items, fire_items)]
    per_room = [f(part, rooms, rules).withColumnRenamed("room_name", "surface_ref") for f in (drying_items, containment_items, odour_items)]
    columns = ["code", "action", "material", "quantity", "surface_ref", "room_id", "rule_id", "source", "basis", "derived_from"]
    out = None
    for x in per_region + per_room:
        out = x.select(*columns) if out is None else out.unionByName(x.select(*columns))
    return catalogued(out, rules).select("code", "description", "action", "material", "quantity", "unit", "trade", "surface_ref", "room_id", "rule_id", "source", "basis", "derived_from")


def concealed_rules(spark: SparkSession, rules: dict = RULES) -> DataFrame:
    keys = ("damage_class", "min_category", "min_class", "min_condition", "subtype", "surface_kind", "adjacent_to_floor", "material_hint")
    rows = [(i, r["id"], r["infer"], float(r["probability"]), r["rationale"], r["source"], *(r["when"].get(k) for k in keys)) for i, r in enumerate(rules["concealed"])]
    return spark.createDataFrame(rows, "rule_no int, rule_id string, infer string, probability double, rationale string, source string, cls string, min_category int, min_class int, min_condition int, sub string, kind string, adjacent boolean, hint string")


def concealed_flags(regions: DataFrame, rules: dict = RULES) -> DataFrame:
    """(id, room_id, surface_key, rule_id, infer, probability, rationale, source) where a rule matches a region.

    A rule's missing condition always passes; classes are compared as they are, so a combined
    region is never flagged.
    """
    r = F.broadcast(concealed_rules(regions.sparkSession, rules))  # a row per rule of the file
    ok = F.col("damage_class") == F.col("cls")
    for col, least in (("water_category", "min_category"), ("water_class", "min_class"), ("mold_condition", "min_condition")):
        ok = ok & (F.col(least).isNull() | (F.coalesce(col, F.lit(0)) >= F.col(least)))
    ok = ok & (F.col("sub").isNull() | F.coalesce(F.col("subtype") == F.col("sub"), F.lit(False))) & (F.col("kind").isNull() | (F.col("surface_kind") == F.col("kind")))
    ok = ok & (~F.coalesce("adjacent", F.lit(False)) | (F.col("v0") <= 0.2)) & (F.col("hint").isNull() | (F.col("surface_kind") == "floor"))
    return regions.join(r, ok).select(*[c for c in ("id", "room_id", "surface_key") if c in regions.columns], "rule_id", "infer", "probability", "rationale", "source")


def margin_sweep(regions: DataFrame, margins: list[float], rules: dict = RULES) -> DataFrame:
    """(margin, snapped, area): drywall to remove under each base height, with and without sheet lines.

    Each pair is the scope's own water rules with two values set; all pairs are sums of one pass.
    """
    pairs = [(float(m), snap) for m in margins for snap in (False, True)]
    sums = []
    for i, (m, snap) in enumerate(pairs):
        cut, removed, _, _ = _drywall(override("water.flood_cut.snap_to_standard", snap, override("water.flood_cut.base_height", m, rules)))
        sums.append(F.sum(F.when(cut, removed).otherwise(0.0)).alias(f"s{i}"))
    rows = F.array(*[F.struct(F.lit(m).alias("margin"), F.lit(snap).alias("snapped"), F.coalesce(f"s{i}", F.lit(0.0)).alias("area")) for i, (m, snap) in enumerate(pairs)])
    return regions.where(involves("water")).agg(*sums).select(F.inline(rows))


def scope_delta(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, old, new, change): items added, removed or changed between two scopes."""
    a, b = before.groupBy(*keys).agg(F.sum("quantity").alias("old")), after.groupBy(*keys).agg(F.sum("quantity").alias("new"))
    x = a.join(b, keys, "full")
    kind = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(F.abs(F.col("new") - F.col("old")) >= 1e-6, "changed")
    return x.select(*keys, "old", "new", kind.alias("change")).where("change is not null")
