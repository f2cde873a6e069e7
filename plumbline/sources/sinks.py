"""Sinks: blanks for what is unmeasured, three decimals, lists joined by a plus sign."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def measured(x: Column) -> Column:
    """A measurement as CSV text: three decimals, or nothing."""
    return F.when(x.isNull(), F.lit("")).otherwise(F.format_string("%.3f", x))


def line_item_rows(items: DataFrame, rooms: DataFrame) -> DataFrame:
    """Line items with their rooms, ready for CSV; an item of an unknown room stays, with blanks."""
    x = items.join(rooms, "room_id", "left")
    shown = [measured(F.col(c)).alias(c) for c in ("quantity", "room_area", "room_height")]
    return x.select("room_id", "code", "action", *shown, "rule_id")


def openings_rows(openings: DataFrame) -> DataFrame:
    """Openings with their list columns joined."""
    lists = [f.name for f in openings.schema.fields if f.dataType.typeName() == "array"]
    return openings.select(*[F.array_join(c, "+").alias(c) if c in lists else F.col(c) for c in openings.columns])


SKETCH = {"area": "room_area_m2", "ceiling_height": "ceiling_height_m", "interior_area": "room_interior_face_area_m2", "centerline_area": "room_wall_centerline_area_m2", "outer_area": "room_outer_footprint_area_m2", "height_min": "height_min_m", "height_mean": "height_mean_m", "height_max": "height_max_m"}


def sketch_rows(walls: DataFrame, rooms: DataFrame) -> DataFrame:
    """The sketch file's rows: a row per wall with its room, blank where unmeasured or without a room.

    walls(wall, room_id, name, length, half_width, confidence, status, extent, thickness, thickness_status),
    rooms(room_id, room_name, interior_confidence and the measures that SKETCH names), all measures numbers.
    """
    x = walls.join(rooms, "room_id", "left")
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    room = {new: measured(F.col(old)) for old, new in SKETCH.items()}
    columns = {
        "room": text("room_name"), "room_area_m2": room["room_area_m2"], "ceiling_height_m": room["ceiling_height_m"], "wall": text("name"),
        "wall_length_m": measured(F.col("length")), "wall_length_ci_half_width_m": measured(F.col("half_width")), "wall_length_confidence": text("confidence"), "wall_length_status": F.coalesce("status", F.lit("measured")),
        "wall_inlier_vertical_extent_m": measured(F.col("extent")), "wall_thickness_m": measured(F.col("thickness")), "wall_thickness_status": F.coalesce("thickness_status", F.lit("unmeasured")),
        "room_interior_face_area_m2": room["room_interior_face_area_m2"], "room_interior_face_confidence": text("interior_confidence"), **{c: room[c] for c in ("room_wall_centerline_area_m2", "room_outer_footprint_area_m2", "height_min_m", "height_mean_m", "height_max_m")},
    }
    return x.select(*[c.alias(n) for n, c in columns.items()])


def scope_rows(items: DataFrame, rooms: DataFrame) -> DataFrame:
    """The scope file's rows: line items as scope_build gives them with the name of their room, blank if it is unknown."""
    x = items.join(rooms.select("room_id", "room_name"), "room_id", "left")
    return x.select(F.coalesce("room_name", F.lit("")).alias("room"), "surface_ref", "action", "material", "description", "quantity", "unit", "trade", "rule_id", "source", "basis")


def plane_document(planes: DataFrame, key: str) -> DataFrame:
    """(key, document): one JSON text per key with its planes in order of their id; a capture has tens of planes."""
    rest = [c for c in planes.columns if c != key]
    return planes.groupBy(key).agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("id", *[c for c in rest if c != "id"]))).alias("planes"))).alias("document"))


def manifest_documents(rows: DataFrame) -> DataFrame:
    """(document): each row as one JSON text, missing values as null, for manifests of runs, poses and failures."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("document"))


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """One document per line, missing values written as null."""
    rows.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def conformance(rows: DataFrame, *rules: tuple[str, Column]) -> DataFrame:
    """(message, n): for each named predicate how many rows break it; a null breaks it too."""
    broken = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"b{i}") for i, (_, ok) in enumerate(rules)]
    pairs = F.array(*[F.struct(F.lit(n).alias("message"), F.col(f"b{i}").alias("n")) for i, (n, _) in enumerate(rules)])
    return rows.agg(*broken).select(F.inline(pairs)).where("n > 0")
