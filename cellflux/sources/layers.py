"""SC2 / SK2: vector layers as GeoJSON features, one per line.

A layer row has its attributes and one geometry: ``geom_type`` (Point,
LineString, MultiLineString, Polygon, MultiPolygon) with ``x, y`` for points,
``lines`` (one array of points for each part) for lines, and ``parts`` (one
list of rings for each part) for polygons.  ``rings`` is the first part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

GEOMETRY_COLUMNS = ["geom_type", "x", "y", "lines", "parts", "rings"]
#: depth of the coordinate arrays of each kind
DEPTHS = {"Point": 1, "LineString": 2, "MultiLineString": 3, "Polygon": 3, "MultiPolygon": 4}


def _nested(depth: int) -> str:
    return "array<" * depth + "double" + ">" * depth


def _point(p: Column) -> Column:
    return F.struct(F.get(p, 0).alias("x"), F.get(p, 1).alias("y"))


def _pair(p: Column) -> Column:
    return F.array(p["x"], p["y"])


def read_features(spark: SparkSession, path: str, props: T.StructType) -> DataFrame:
    """GeoJSON features, one per line, as layer rows (attributes typed by ``props``)."""
    geometry = T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())])
    schema = T.StructType([T.StructField("type", T.StringType()), T.StructField("properties", props), T.StructField("geometry", geometry)])
    rows = spark.read.schema(schema).json(path)
    kind, raw = F.col("geometry.type"), F.col("geometry.coordinates")

    def coords(name):
        return F.when(kind == name, F.from_json(raw, _nested(DEPTHS[name])))

    def path_of(a):
        return F.transform(a, _point)

    def rings_of(a):
        return F.transform(a, path_of)

    point = coords("Point")
    lines = F.coalesce(F.when(kind == "LineString", F.array(path_of(coords("LineString")))), F.transform(coords("MultiLineString"), path_of))
    parts = F.coalesce(F.when(kind == "Polygon", F.array(rings_of(coords("Polygon")))), F.transform(coords("MultiPolygon"), rings_of))
    out = rows.select("properties.*", kind.alias("geom_type"), F.get(point, 0).alias("x"), F.get(point, 1).alias("y"), lines.alias("lines"), parts.alias("parts"))
    return out.withColumn("rings", F.get("parts", 0))


def write_features(layer: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Layer rows as GeoJSON features, one per line; the geometry columns that the layer has are used."""
    have = set(layer.columns)
    kind = F.col("geom_type")
    text: list[Column] = []

    def line(a):
        return F.transform(a, _pair)

    def rings(a):
        return F.transform(a, line)

    def when(name, value):
        return F.when(kind == name, F.to_json(value))

    if {"x", "y"} <= have:
        text.append(when("Point", F.array("x", "y")))
    if "lines" in have:
        text += [when("LineString", line(F.get("lines", 0))), when("MultiLineString", F.transform(F.col("lines"), line))]
    if "parts" in have:
        text += [when("Polygon", rings(F.get("parts", 0))), when("MultiPolygon", F.transform(F.col("parts"), rings))]
    elif "rings" in have:
        text.append(when("Polygon", rings(F.col("rings"))))
    props = [c for c in layer.columns if c not in GEOMETRY_COLUMNS]
    value = F.concat(
        F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*props)) if props else F.lit("{}"),
        F.lit(',"geometry":{"type":'), F.to_json(F.array(kind)).substr(F.lit(2), F.length(F.to_json(F.array(kind))) - 2),
        F.lit(',"coordinates":'), F.coalesce(*text), F.lit("}}"))
    layer.select(value.alias("value")).write.mode(mode).text(path)
