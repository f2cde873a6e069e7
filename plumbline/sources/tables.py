"""Logical inputs over the given tables: observations, surface votes, points, regions, rooms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timed observations (track, t seconds, value, kind, id, props), whatever the session's time zone."""
    t = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts)") / 1e6
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("track"), t.alias("t"), "value", F.col("event_type").alias("kind"), F.col("event_id").alias("id"), "props")


def surface_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Votes on surfaces (surface, frame, u, v, weight, cls)."""
    return table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("surface"), F.col("l_orderkey").alias("frame"), (F.col("l_quantity") * 0.1).alias("u"), (F.col("l_tax") * 30).alias("v"), (1 - F.col("l_discount")).alias("weight"), F.col("l_returnflag").alias("cls"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points with normals (id, x, y, z, nx, ny, nz, label)."""
    e = lambda i: F.col("embedding")[i].cast("double")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), *[e(i).alias(n) for i, n in enumerate(("x", "y", "z", "nx", "ny", "nz"))], "label")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage regions as the scope rules take them."""
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    kind = F.element_at(F.array(F.lit("wall"), F.lit("floor"), F.lit("ceiling")), (F.pmod(k, F.lit(3)) + 1).cast("int"))
    both = F.array(*[F.array(*map(F.lit, x)) for x in (("water", "fire"), ("water", "mold"), ("mold", "fire"))])
    combined = F.pmod(k, F.lit(10)) == 3
    return table(spark, sf_dir, "orders").select(
        k.alias("id"),
        F.col("o_custkey").alias("room_id"),
        kind.alias("surface_kind"),
        F.concat(F.lit("r"), F.col("o_custkey"), F.lit("-"), kind).alias("surface_key"),
        F.when(combined, F.element_at(both, (F.pmod(k, F.lit(3)) + 1).cast("int"))).alias("combined_classes"),
        F.when(combined, "combined").when(status == "F", "fire").when(status == "O", "water").otherwise("mold").alias("damage_class"),
        (F.col("o_totalprice") / 1e5).alias("area"),
        (F.pmod(k, F.lit(7)) * 0.1).alias("v0"),
        (F.pmod(k, F.lit(7)) * 0.1 + F.pmod(k, F.lit(11)) * 0.25).alias("v1"),
        (F.pmod(k, F.lit(13)) * 0.4).alias("width"),
        (F.pmod(k, F.lit(11)) * 0.25).alias("height_extent"),
        F.when(F.pmod(k, F.lit(5)) > 0, F.least(F.pmod(k, F.lit(5)), F.lit(3))).cast("int").alias("water_category"),
        F.when(F.pmod(k, F.lit(6)) > 1, F.pmod(k, F.lit(6)) - 1).cast("int").alias("water_class"),
        F.when(F.pmod(k, F.lit(4)) > 0, F.pmod(k, F.lit(4))).cast("int").alias("mold_condition"),
        F.when(F.pmod(k, F.lit(8)) == 1, "char").when(F.pmod(k, F.lit(8)) == 2, "consumed").when(F.pmod(k, F.lit(8)) < 6, "soot").alias("subtype"),
        F.when(F.pmod(k, F.lit(9)) > 0, F.pmod(k, F.lit(9)) * 0.6).cast("double").alias("run_length"),
    )


def rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("room_id"), (F.abs(b) / 97).alias("room_area"), F.when(b >= 0, 2.2 + F.pmod("c_custkey", F.lit(5)) * 0.2).cast("double").alias("room_height"), (4 * F.sqrt(F.abs(b) / 97)).alias("perimeter"), F.concat(F.lit("room "), F.col("c_custkey")).alias("room_name"))


#: The same inputs as DuckDB SQL, to put after WITH.
SQL = {
    "obs": "obs AS (SELECT user_id AS track, epoch_us(ts) / 1e6 AS t, value, event_type AS kind, event_id AS id, props FROM events)",
    "votes": "votes AS (SELECT l_suppkey AS surface, l_orderkey AS frame, l_quantity * 0.1 AS u, l_tax * 30 AS v, 1 - l_discount AS weight, l_returnflag AS cls FROM lineitem)",
    "pts": "pts AS (SELECT vec_id AS id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z, embedding[4]::DOUBLE AS nx, embedding[5]::DOUBLE AS ny, embedding[6]::DOUBLE AS nz, label FROM embeddings)",
    "regions": """regions AS (SELECT o_orderkey AS id, o_custkey AS room_id, ['wall','floor','ceiling'][(o_orderkey % 3 + 1)::INT] AS surface_kind,
        'r' || o_custkey || '-' || ['wall','floor','ceiling'][(o_orderkey % 3 + 1)::INT] AS surface_key,
        CASE WHEN o_orderkey % 10 = 3 THEN [['water', 'fire'], ['water', 'mold'], ['mold', 'fire']][(o_orderkey % 3 + 1)::INT] END AS combined_classes,
        CASE WHEN o_orderkey % 10 = 3 THEN 'combined' WHEN o_orderstatus = 'F' THEN 'fire' WHEN o_orderstatus = 'O' THEN 'water' ELSE 'mold' END AS damage_class, o_totalprice / 1e5 AS area,
        (o_orderkey % 7) * 0.1::DOUBLE AS v0, (o_orderkey % 7) * 0.1::DOUBLE + (o_orderkey % 11) * 0.25::DOUBLE AS v1, (o_orderkey % 13) * 0.4::DOUBLE AS width, (o_orderkey % 11) * 0.25::DOUBLE AS height_extent,
        CASE WHEN o_orderkey % 5 > 0 THEN least(o_orderkey % 5, 3) END AS water_category, CASE WHEN o_orderkey % 6 > 1 THEN o_orderkey % 6 - 1 END AS water_class,
        CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 END AS mold_condition, CASE WHEN o_orderkey % 8 = 1 THEN 'char' WHEN o_orderkey % 8 = 2 THEN 'consumed' WHEN o_orderkey % 8 < 6 THEN 'soot' END AS subtype,
        CASE WHEN o_orderkey % 9 > 0 THEN (o_orderkey % 9) * 0.6::DOUBLE END AS run_length FROM orders)""",
    "rooms": "rooms AS (SELECT c_custkey AS room_id, abs(c_acctbal) / 97 AS room_area, CASE WHEN c_acctbal >= 0 THEN 2.2::DOUBLE + (c_custkey % 5) * 0.2::DOUBLE END AS room_height, 4 * sqrt(abs(c_acctbal) / 97) AS perimeter, 'room ' || c_custkey AS room_name FROM customer)",
}
