"""Queries of the scope rules, measurements and scores, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures
from ..operators import joins, scope, scoring
from ..sources.tables import SQL, regions, rooms, table
from .series import r6


def _q(df, *keys):
    return df.select(*keys, "code", "action", F.round("quantity", 7).alias("quantity"), "rule_id")


def scope_water(s, d):
    return _q(scope.water_items(regions(s, d)), "id", "room_id")


def scope_drying(s, d):
    return _q(scope.drying_items(regions(s, d), rooms(s, d)), "room_id")


def scope_mold(s, d):
    return _q(scope.mold_items(regions(s, d)), "id", "room_id")


def scope_containment(s, d):
    return _q(scope.containment_items(regions(s, d), rooms(s, d)), "room_id")


def scope_fire(s, d):
    return _q(scope.fire_items(regions(s, d)), "id", "room_id")


def scope_odour(s, d):
    return _q(scope.odour_items(regions(s, d), rooms(s, d)), "room_id")


def scope_build(s, d):
    """Every line item of the whole scope, with its catalogue entry and the regions it stands for."""
    x = scope.scope_build(regions(s, d), rooms(s, d))
    return x.select("code", "description", "action", "material", F.round("quantity", 7).alias("quantity"), "unit", "trade", "surface_ref", "room_id", "rule_id", "source", F.array_join(F.col("derived_from").cast("array<string>"), "+").alias("derived_from"))


def concealed_flags(s, d):
    return scope.concealed_flags(regions(s, d)).select("id", "rule_id", "infer", "probability")


def scope_delta(s, d):
    """Mold items with a margin of 0.5 against those of 0.3."""
    r = regions(s, d)
    x = scope.scope_delta(scope.mold_items(r), scope.mold_items(r, scope.override("mold.removal_margin", 0.5)), ["room_id", "code"])
    return x.select("room_id", "code", *r6("old", "new"), "change")


def scope_delta_all(s, d):
    """The older name of scope_delta, from when that read a part of the rooms."""
    return scope_delta(s, d)


def margin_sweep(s, d):
    """Drywall to remove over seven base heights, with and without sheet lines."""
    x = scope.margin_sweep(regions(s, d), [round(0.1 * i, 1) for i in range(1, 8)])
    return x.select("margin", "snapped", F.round("area", 4).alias("area"))


def measurement_interval(s, d):
    """Half-widths of lengths, heights, areas and damage for each region."""
    r = regions(s, d)
    n = F.pmod("id", F.lit(900)) + 1
    rms = F.col("area") / 1000
    return r.select(
        "id",
        F.round(measures.length_half_width(rms, n, F.col("v0") / 100, F.pmod("id", F.lit(5)) / 5.0, F.pmod("id", F.lit(2)) == 0), 6).alias("length"),
        F.round(measures.height_half_width(rms, n, rms * 2, n + 5), 6).alias("height"),
        F.round(measures.area_half_width(F.col("width") * 4, measures.plane_sigma(rms, n)), 6).alias("area"),
        F.round(measures.damage_half_width(F.col("area"), F.pmod("id", F.lit(6)), F.pmod("id", F.lit(3)) == 0), 6).alias("damage"),
        F.round(measures.evidence_confidence(F.pmod("id", F.lit(6)) + 1, F.col("area"), F.col("v0")), 6).alias("confidence"),
    )


def evidence_flags(s, d):
    r = regions(s, d)
    f = measures.flags((F.col("area") < 1, "small"), (F.col("area") > 3, "large"), (F.col("v0") <= 0.2, "low"), (F.coalesce(F.col("run_length") < 1, F.lit(True)), "inferred"), (F.col("width") == 0, "thin"))
    return r.select("id", F.array_join(f, "+").alias("flags"))


def scope_export(s, d):
    """Line items left-joined with rooms, blank where unmeasured, as the CSV sink writes them."""
    from ..sources.sinks import line_item_rows

    return line_item_rows(scope.water_items(regions(s, d)).withColumn("quantity", F.col("quantity") * 1.0123), rooms(s, d))


def _truth(s, d):
    lab, doc = table(s, d, "labels"), table(s, d, "documents").select("doc_id", "n_chars", "lang")
    return lab.join(doc, "doc_id").withColumn("found", (F.col("n_chars") % 3 > 0).cast("int"))


def gate_report(s, d):
    t = _truth(s, d)
    err = (F.col("n_chars") % 97) / 10.0 - F.col("quality") * 3
    return scoring.gate_report(t, "lang", err, F.lit(4.0), F.lit(5.0)).select("lang", "n", *r6("passed", "median_error", "p90_error", "max_error", "covered"))


def macro_f1(s, d):
    return scoring.macro_f1(_truth(s, d), "quality", "found").select(*r6("macro_f1"), "n_classes")


def set_precision_recall(s, d):
    t = _truth(s, d)
    return scoring.set_scores(t.where("quality = 1"), t.where("found = 1"), ["doc_id"]).select("n_truth", "n_found", "n_both", *r6("precision", "recall"))


def line_item_recall(s, d):
    """Items of 1% more material that the plain scope has within a tenth."""
    w = scope.water_items(regions(s, d)).groupBy("room_id", "code", "action").agg(F.sum("quantity").alias("quantity"))
    ref = w.withColumn("quantity", F.col("quantity") * (1 + F.pmod("room_id", F.lit(20)) * 0.01))
    hit = joins.agreeing(ref, w, ["room_id", "code", "action"], "quantity", 0.1)
    return hit.groupBy("code").agg(F.count("*").alias("n_hit"))


def truth_missing(s, d):
    """Rooms with water that have no fire, against all rooms with water."""
    r = regions(s, d)
    matched, missing = joins.truth_join(r.where("damage_class = 'water'").select("room_id").distinct(), r.where("damage_class = 'fire'").select("room_id").distinct(), ["room_id"])
    return matched.withColumn("missing", F.lit(False)).unionByName(missing.withColumn("missing", F.lit(True)))


def box_iou(s, d):
    """Largest water box against largest fire box of each room; 0 without one."""
    b = regions(s, d).select("room_id", "damage_class", "area", "id", F.lit(0.0).alias("u0"), F.col("width").alias("u1"), "v0", "v1")
    w, f = (scoring.largest(b.where(f"damage_class = '{c}'"), "room_id", "area", "id") for c in ("water", "fire"))
    f = f.select("room_id", *[F.col(c).alias(f"f{c}") for c in ("u0", "u1", "v0", "v1")])
    x = w.join(f, "room_id", "left")
    iou = scoring.box_iou([F.col(c) for c in ("u0", "u1", "v0", "v1")], [F.col(f"f{c}") for c in ("u0", "u1", "v0", "v1")])
    return x.select("room_id", F.round(iou, 6).alias("iou"))


def head_to_head(s, d):
    t = _truth(s, d)
    return scoring.head_to_head(t, (F.col("n_chars") % 97) / 10.0 - F.col("quality"), (F.col("n_chars") % 89) / 10.0 - F.col("quality"), 0.5)


def area_by_class(s, d):
    return regions(s, d).groupBy("damage_class").agg(F.count("*").alias("n"), F.round(F.sum("area"), 4).alias("area"), F.round(F.stddev_pop("v1"), 6).alias("std"))


_R = "WITH " + SQL["regions"]
_RR = f"{_R}, {SQL['rooms']}"
_END = "SELECT {k}, code, action, round(quantity, 7) AS quantity, rule_id FROM i"
_CUT = "CASE WHEN greatest(v1 + 0.30::DOUBLE, 0.61) <= 0.61 + 1e-6 THEN 0.61 WHEN greatest(v1 + 0.30::DOUBLE, 0.61) <= 1.22 + 1e-6 THEN 1.22 ELSE 2.44 END::DOUBLE"
_HAS = "(damage_class = '{c}' OR (damage_class = 'combined' AND list_contains(combined_classes, '{c}')))"
_WET, _MOLDY, _BURNT = (_HAS.format(c=c) for c in ("water", "mold", "fire"))
_WATER = f"""w AS (SELECT *, coalesce(nullif(water_category, 0), 1) AS cat, surface_kind = 'floor' AS fl, surface_kind = 'ceiling' AS ce, least(width, run_length) AS run
 FROM regions WHERE {_WET}),
c AS (SELECT *, NOT fl AND cat IN (2, 3) AND (ce OR coalesce(run_length <> 0, false)) AS cut, CASE WHEN ce THEN area ELSE {_CUT} * run END AS ca FROM w),
i AS (SELECT id, room_id, 'carpet_remove' AS code, 'remove' AS action, area AS quantity, 'water.category_actions.3' AS rule_id FROM c WHERE fl AND cat = 3
 UNION ALL SELECT id, room_id, 'carpet_clean', 'clean', area, 'water.category_actions.2' FROM c WHERE fl AND cat = 2
 UNION ALL SELECT id, room_id, 'pad_remove', 'remove', area, 'water.category_actions' FROM c WHERE fl AND cat IN (2, 3)
 UNION ALL SELECT id, room_id, 'drywall_remove', 'remove', ca, CASE WHEN ce THEN 'water.category_actions.ceiling' ELSE 'water.flood_cut' END FROM c WHERE cut
 UNION ALL SELECT id, room_id, 'drywall_replace', 'replace', ca, CASE WHEN ce THEN 'water.category_actions.ceiling' ELSE 'water.flood_cut' END FROM c WHERE cut
 UNION ALL SELECT id, room_id, 'insulation_remove', 'remove', ca, 'W-01' FROM c WHERE cut
 UNION ALL SELECT id, room_id, 'baseboard_replace', 'replace', run, 'water.baseboard' FROM c WHERE cut AND NOT ce
 UNION ALL SELECT id, room_id, 'antimicrobial_apply', 'treat', area, 'water.antimicrobial' FROM c WHERE NOT fl AND cat IN (2, 3))"""
_MOLD = """{m} AS (SELECT *, (width + 2 * {x}) * (height_extent + 2 * {x}) AS g, coalesce(nullif(mold_condition, 0), 3) AS cond FROM regions WHERE """ + _MOLDY + """),
{i} AS (SELECT id, room_id, 'mold_remove' AS code, 'remove' AS action, g AS quantity, 'mold.removal_margin' AS rule_id FROM {m} WHERE cond NOT IN (1, 2)
 UNION ALL SELECT id, room_id, 'mold_treat', 'treat', g, 'mold.condition_actions' FROM {m} WHERE cond NOT IN (1, 2)
 UNION ALL SELECT id, room_id, 'hepa_vacuum', 'clean', g * 2, 'mold.hepa_vacuum_passes' FROM {m})"""
_FIRE = f"""f AS (SELECT *, coalesce(subtype, 'soot') IN ('char', 'consumed') AS burnt FROM regions WHERE {_BURNT}),
i AS (SELECT id, room_id, 'soot_clean' AS code, 'clean' AS action, area AS quantity, 'fire.subtype_actions' AS rule_id FROM f WHERE NOT burnt
 UNION ALL SELECT id, room_id, 'seal_surface', 'seal', area, 'fire.seal_after_cleaning' FROM f WHERE NOT burnt
 UNION ALL SELECT id, room_id, 'char_remove', 'remove', area, 'fire.subtype_actions' FROM f WHERE burnt)"""
_DRYING = f"""g AS (SELECT room_id, sum(CASE WHEN surface_kind = 'floor' THEN area ELSE 0 END) AS fl, sum(CASE WHEN surface_kind <> 'floor' THEN area ELSE 0 END) AS wa,
 max(coalesce(water_class, 2)) AS cls, list_sort(list(id)) AS ids FROM regions WHERE {_WET} GROUP BY room_id),
x AS (SELECT g.*, CASE cls WHEN 3 THEN 4 WHEN 4 THEN 5 ELSE 3 END AS days, greatest(1, ceil(fl * 0.065::DOUBLE + wa * 0.25::DOUBLE)) AS mv,
 greatest(1, ceil(room_area * coalesce(nullif(room_height, 0), 2.4::DOUBLE) * 0.35::DOUBLE * CASE cls WHEN 1 THEN 0.6 WHEN 2 THEN 1.0 ELSE 1.5 END::DOUBLE / 10)) AS un
 FROM g JOIN rooms ON g.room_id = rooms.room_id),
i AS (SELECT room_id, 'air_mover' AS code, 'operate' AS action, (mv * days)::DOUBLE AS quantity, 'water.drying_equipment.air_movers' AS rule_id, ids FROM x
 UNION ALL SELECT room_id, 'dehumidifier', 'operate', (un * days)::DOUBLE, 'water.drying_equipment.dehumidifier', ids FROM x
 UNION ALL SELECT room_id, 'monitoring_visit', 'monitor', days::DOUBLE, 'water.drying_equipment.monitoring_days', ids FROM x)"""
_CONTAIN = f"""g AS (SELECT room_id, sum(area) AS total, list_sort(list(id)) AS ids FROM regions WHERE {_MOLDY} GROUP BY room_id HAVING sum(area) >= 1.0),
x AS (SELECT g.*, room_area, perimeter, coalesce(nullif(room_height, 0), 2.4::DOUBLE) AS h FROM g JOIN rooms ON g.room_id = rooms.room_id),
i AS (SELECT room_id, 'containment_barrier' AS code, 'install' AS action, perimeter * h + room_area AS quantity, 'mold.containment' AS rule_id, total, ids FROM x
 UNION ALL SELECT room_id, 'negative_air', 'operate', greatest(1, ceil(room_area * h * 0.03::DOUBLE / 10)) * 3, 'mold.air_scrubber', total, ids FROM x
 UNION ALL SELECT room_id, 'ppe_set', 'supply', 6.0, 'mold.ppe', total, ids FROM x)"""
_ODOUR = f"""i AS (SELECT room_id, 'odour_treatment' AS code, 'treat' AS action, 1.0::DOUBLE AS quantity, 'fire.odour_treatment' AS rule_id, list_sort(list(id)) AS ids
 FROM regions WHERE {_BURNT} AND room_id IN (SELECT room_id FROM rooms) GROUP BY room_id HAVING sum(area) >= 0.5)"""


def _catalogue() -> str:
    """The rules' line items as SQL values; the texts are data, not logic."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    rows = ", ".join(f"({quote(k)}, {quote(v['description'])}, {quote(v['unit'])}, {quote(v['trade'])})" for k, v in scope.RULES["line_items"].items())
    return f"cat(code, description, unit, trade) AS (VALUES {rows})"


def _build() -> str:
    """The six parts of the scope, each under names of its own, with what a code's material and source are."""
    r = scope.RULES
    w, m, f = r["water"], r["mold"], r["fire"]
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    material = {"carpet_remove": "carpet", "carpet_clean": "carpet", "pad_remove": "carpet pad", "drywall_remove": "drywall", "drywall_replace": '1/2" drywall', "insulation_remove": "batt insulation", "baseboard_replace": "baseboard", "antimicrobial_apply": "antimicrobial", "mold_remove": "contaminated material", "mold_treat": "antimicrobial", "hepa_vacuum": "HEPA vacuum", "soot_clean": "soot residue", "seal_surface": "odour-blocking primer", "char_remove": "fire-damaged material", "air_mover": "air mover", "dehumidifier": "LGR dehumidifier", "monitoring_visit": "drying monitoring", "containment_barrier": "6 mil poly", "negative_air": "HEPA air scrubber", "odour_treatment": f["odour_treatment"]["method"]}
    e = w["drying_equipment"]
    source = {"drywall_remove": w["flood_cut"]["source"], "drywall_replace": w["flood_cut"]["source"], "insulation_remove": "IICRC S500 §12.2.4", "baseboard_replace": w["baseboard"]["source"], "antimicrobial_apply": w["antimicrobial"]["source"], "mold_remove": "IICRC S520 §12.1", "mold_treat": "IICRC S520 §12", "hepa_vacuum": "IICRC S520 §12.4", "soot_clean": f["source"], "seal_surface": f["source"], "char_remove": f["source"], "air_mover": e["air_movers"]["source"], "dehumidifier": e["dehumidifier"]["source"], "monitoring_visit": e["monitoring_days"]["source"], "containment_barrier": m["containment"]["source"], "negative_air": m["air_scrubber"]["source"], "ppe_set": m["ppe"]["source"], "odour_treatment": f["odour_treatment"]["source"]}
    both = ", ".join(f"({quote(k)}, {quote(v)})" for k, v in material.items()), ", ".join(f"({quote(k)}, {quote(v)})" for k, v in source.items())
    by_category = " ".join(f"WHEN {k} THEN {quote(v['source'])}" for k, v in w["category_actions"].items())
    per_region = lambda sql: f"(WITH {sql} SELECT i.id, i.room_id, code, action, quantity, rule_id, NULL::DOUBLE AS total, NULL::BIGINT[] AS ids FROM i)"
    per_room = lambda sql, total: f"(WITH {sql} SELECT NULL::BIGINT AS id, room_id, code, action, quantity, rule_id, {total} AS total, ids FROM i)"
    parts = [per_region(_WATER), per_region(_MOLD.format(x="0.30::DOUBLE", m="m", i="i")), per_region(_FIRE), per_room(_DRYING, "NULL::DOUBLE"), per_room(_CONTAIN, "total"), per_room(_ODOUR, "NULL::DOUBLE")]
    return f"""{_RR}, {_catalogue()}, mat(code, material) AS (VALUES {both[0]}), src(code, source) AS (VALUES {both[1]}),
al AS ({" UNION ALL ".join("SELECT * FROM " + p for p in parts)})
SELECT al.code, description, action, CASE WHEN al.code = 'ppe_set' THEN CASE WHEN total < 1.0 THEN 'N95_gloves_goggles' WHEN total < 9.3 THEN 'half_face_respirator_suit' ELSE 'full_face_PAPR_suit' END ELSE material END AS material,
 round(quantity, 7) AS quantity, unit, trade, coalesce(regions.surface_key, room_name) AS surface_ref, al.room_id, rule_id,
 coalesce(source, CASE coalesce(nullif(water_category, 0), 1) {by_category} END) AS source, coalesce(al.id::VARCHAR, array_to_string(ids, '+')) AS derived_from
FROM al JOIN cat ON cat.code = al.code LEFT JOIN mat ON mat.code = al.code LEFT JOIN src ON src.code = al.code LEFT JOIN regions ON regions.id = al.id LEFT JOIN rooms ON rooms.room_id = al.room_id"""


_T = "WITH t AS (SELECT l.doc_id, l.quality, d.n_chars, d.lang, (d.n_chars % 3 > 0)::INT AS found FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"

QUERIES = {f.__name__: f for f in (scope_water, scope_drying, scope_mold, scope_containment, scope_fire, scope_odour, scope_build, concealed_flags, scope_delta, scope_delta_all, margin_sweep, measurement_interval, evidence_flags, scope_export, gate_report, macro_f1, set_precision_recall, line_item_recall, truth_missing, box_iou, head_to_head, area_by_class)}

ORACLES = {
    "scope_water": f"{_R}, {_WATER} " + _END.format(k="id, room_id"),
    "scope_drying": f"{_RR}, {_DRYING} " + _END.format(k="room_id"),
    "scope_mold": f"{_R}, {_MOLD.format(x='0.30::DOUBLE', m='m', i='i')} " + _END.format(k="id, room_id"),
    "scope_containment": f"{_RR}, {_CONTAIN} " + _END.format(k="room_id"),
    "scope_fire": f"{_R}, {_FIRE} " + _END.format(k="id, room_id"),
    "scope_odour": f"{_RR}, {_ODOUR} " + _END.format(k="room_id"),
    "scope_build": _build(),
    "concealed_flags": f"""{_R}, r(rule_id, cls, infer, probability, mcat, mcls, mcon, sub, kind, adj) AS (VALUES ('W-01', 'water', 'insulation_behind_drywall', 0.72::DOUBLE, 2, NULL, NULL, NULL, 'wall', NULL), ('W-02', 'water', 'pad_and_subfloor', 0.85, NULL, NULL, NULL, NULL, 'floor', NULL), ('W-03', 'water', 'adjacent_wall_cavity', 0.65, NULL, 3, NULL, NULL, 'wall', NULL), ('W-04', 'water', 'baseboard_and_sill_plate', 0.60, NULL, NULL, NULL, NULL, 'wall', true), ('M-01', 'mold', 'back_of_substrate_growth', 0.78, NULL, NULL, 3, NULL, NULL, NULL), ('M-02', 'mold', 'hidden_moisture_source', 0.55, NULL, NULL, NULL, NULL, 'wall', NULL), ('F-01', 'fire', 'structural_member_charring', 0.58, NULL, NULL, NULL, 'char', NULL, NULL), ('F-02', 'fire', 'smoke_residue_in_cavities_and_hvac', 0.70, NULL, NULL, NULL, NULL, NULL, NULL))
        SELECT id, rule_id, infer, probability FROM regions JOIN r ON damage_class = cls AND (mcat IS NULL OR coalesce(water_category, 0) >= mcat) AND (mcls IS NULL OR coalesce(water_class, 0) >= mcls) AND (mcon IS NULL OR coalesce(mold_condition, 0) >= mcon) AND (sub IS NULL OR subtype = sub) AND (kind IS NULL OR surface_kind = kind) AND (adj IS NULL OR v0 <= 0.2)""",
    "scope_delta": f"""{_R}, {_MOLD.format(x='0.30::DOUBLE', m='m1', i='i1')}, {_MOLD.format(x='0.5::DOUBLE', m='m2', i='i2')},
a AS (SELECT room_id, code, sum(quantity) AS old FROM i1 GROUP BY ALL), b AS (SELECT room_id, code, sum(quantity) AS new FROM i2 GROUP BY ALL),
x AS (SELECT coalesce(a.room_id, b.room_id) AS room_id, coalesce(a.code, b.code) AS code, old, new,
 CASE WHEN old IS NULL THEN 'added' WHEN new IS NULL THEN 'removed' WHEN abs(new - old) >= 1e-6 THEN 'changed' END AS change FROM a FULL JOIN b ON a.room_id = b.room_id AND a.code = b.code)
SELECT room_id, code, round(old, 6) AS old, round(new, 6) AS new, change FROM x WHERE change IS NOT NULL""",
    "margin_sweep": f"""{_R}, m AS (SELECT round((range + 1) * 0.1::DOUBLE, 1) AS margin FROM range(7)), k AS (SELECT unnest([false, true]) AS snapped),
x AS (SELECT margin, snapped, surface_kind, area, greatest(v1 + margin, 0.61) AS raw, least(width, run_length) AS run FROM regions, m, k
 WHERE {_WET} AND surface_kind <> 'floor' AND coalesce(water_category, 1) IN (2, 3) AND (surface_kind = 'ceiling' OR coalesce(run_length <> 0, false)))
SELECT margin, snapped, round(sum(CASE WHEN surface_kind = 'ceiling' THEN area WHEN NOT snapped THEN raw * run
 ELSE CASE WHEN raw <= 0.61 + 1e-6 THEN 0.61 WHEN raw <= 1.22 + 1e-6 THEN 1.22 ELSE 2.44 END::DOUBLE * run END), 4) AS area FROM x GROUP BY ALL""",
    "measurement_interval": f"""{_R}, x AS (SELECT *, id % 900 + 1 AS n, area / 1000 AS rms FROM regions), y AS (SELECT *, greatest(rms / sqrt(n), 0.002) AS p1, greatest(rms * 2 / sqrt(n + 5), 0.002) AS p2 FROM x)
        SELECT id, round(1.645::DOUBLE * 2 * sqrt(p1 * p1 + (v0 / 100) * (v0 / 100)) * (1 + 1.5::DOUBLE * ((id % 5) / 5.0::DOUBLE)) * CASE WHEN id % 2 = 0 THEN 1 ELSE 3 END, 6) AS length, round(1.645::DOUBLE * sqrt(p1 * p1 + p2 * p2), 6) AS height, round(width * 4 * p1 / 2 * 1.645::DOUBLE, 6) AS area, round(area * (0.12::DOUBLE / sqrt(greatest(id % 6, 1)) + CASE WHEN id % 3 = 0 THEN 0 ELSE 0.25 END) * 1.645::DOUBLE, 6) AS damage, round(0.5::DOUBLE * (1 - exp(-0.55::DOUBLE * (id % 6))) + 0.25 * least(greatest(area / 3, 0), 1) + 0.25 * v0, 6) AS confidence FROM y""",
    "evidence_flags": f"{_R} SELECT id, array_to_string(list_sort(list_filter([CASE WHEN area < 1 THEN 'small' END, CASE WHEN area > 3 THEN 'large' END, CASE WHEN v0 <= 0.2 THEN 'low' END, CASE WHEN coalesce(run_length < 1, true) THEN 'inferred' END, CASE WHEN width = 0 THEN 'thin' END], lambda x: x IS NOT NULL)), '+') AS flags FROM regions",
    "scope_export": f"{_RR}, {_WATER} SELECT i.room_id, code, action, printf('%.3f', quantity * 1.0123::DOUBLE) AS quantity, coalesce(printf('%.3f', room_area), '') AS room_area, coalesce(printf('%.3f', room_height), '') AS room_height, rule_id FROM i LEFT JOIN rooms ON i.room_id = rooms.room_id",
    "gate_report": f"{_T}, e AS (SELECT lang, abs((n_chars % 97) / 10.0::DOUBLE - quality * 3) AS e FROM t) SELECT lang, count(*) AS n, round(avg((e <= 4)::INT), 6) AS passed, round(median(e), 6) AS median_error, round(quantile_cont(e, 0.9), 6) AS p90_error, round(max(e), 6) AS max_error, round(avg((e <= 5)::INT), 6) AS covered FROM e GROUP BY lang",
    "macro_f1": f"{_T}, c AS (SELECT DISTINCT quality AS c FROM t UNION SELECT DISTINCT found FROM t), p AS (SELECT c, count(*) FILTER (quality = c AND found = c) AS tp, count(*) FILTER (quality <> c AND found = c) AS fp, count(*) FILTER (quality = c AND found <> c) AS fn FROM t, c GROUP BY c) SELECT round(avg(2 * tp / (2 * tp + fp + fn)::DOUBLE), 6) AS macro_f1, count(*) AS n_classes FROM p WHERE tp + fp + fn > 0",
    "set_precision_recall": f"{_T} SELECT count(DISTINCT doc_id) FILTER (quality = 1) AS n_truth, count(DISTINCT doc_id) FILTER (found = 1) AS n_found, count(DISTINCT doc_id) FILTER (quality = 1 AND found = 1) AS n_both, round(count(DISTINCT doc_id) FILTER (quality = 1 AND found = 1) / count(DISTINCT doc_id) FILTER (found = 1)::DOUBLE, 6) AS precision, round(count(DISTINCT doc_id) FILTER (quality = 1 AND found = 1) / count(DISTINCT doc_id) FILTER (quality = 1)::DOUBLE, 6) AS recall FROM t",
    "line_item_recall": f"{_R}, {_WATER}, q AS (SELECT room_id, code, action, sum(quantity) AS quantity FROM i GROUP BY ALL), r AS (SELECT * REPLACE (quantity * (1 + (room_id % 20) * 0.01::DOUBLE) AS quantity) FROM q) SELECT code, count(*) AS n_hit FROM r WHERE EXISTS (SELECT 1 FROM q WHERE q.room_id = r.room_id AND q.code = r.code AND q.action = r.action AND abs(r.quantity - q.quantity) <= 0.1::DOUBLE * greatest(r.quantity, 1e-6)) GROUP BY code",
    "truth_missing": f"{_R} SELECT DISTINCT room_id, room_id NOT IN (SELECT room_id FROM regions WHERE damage_class = 'fire') AS missing FROM regions WHERE damage_class = 'water'",
    "box_iou": f"{_R}, b AS (SELECT *, row_number() OVER (PARTITION BY room_id, damage_class ORDER BY area DESC, id) AS k FROM regions), x AS (SELECT w.room_id, greatest(0, least(w.width, f.width)) * greatest(0, least(w.v1, f.v1) - greatest(w.v0, f.v0)) AS shared, w.width * (w.v1 - w.v0) AS a1, f.width * (f.v1 - f.v0) AS a2, f.id AS fid FROM (SELECT * FROM b WHERE k = 1 AND damage_class = 'water') w LEFT JOIN (SELECT * FROM b WHERE k = 1 AND damage_class = 'fire') f ON w.room_id = f.room_id) SELECT room_id, round(CASE WHEN fid IS NULL OR a1 + a2 - shared = 0 THEN 0 ELSE shared / (a1 + a2 - shared) END, 6) AS iou FROM x",
    "head_to_head": f"{_T}, e AS (SELECT abs((n_chars % 97) / 10.0::DOUBLE - quality) - abs((n_chars % 89) / 10.0::DOUBLE - quality) AS d FROM t) SELECT count(*) FILTER (d < -0.5) AS wins, count(*) FILTER (abs(d) <= 0.5) AS ties, count(*) FILTER (d > 0.5) AS losses FROM e",
    "area_by_class": f"{_R} SELECT damage_class, count(*) AS n, round(sum(area), 4) AS area, round(stddev_pop(v1), 6) AS std FROM regions GROUP BY 1",
}
ORACLES["scope_delta_all"] = ORACLES["scope_delta"]
