"""Zone polygons from WKT text and from JSON features -> vertex table: POLYGON and MULTIPOLYGON, with holes.

Parsing is built-in string functions only: every innermost pair of brackets is
a ring; rings and points are numbered with ``posexplode``.  Rings are kept
apart, so the even-odd rule sees holes and parts alike.  The closing vertex
(equal to the first) is dropped, so the edges are formed again by ``lead``
over the vertex order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_NUMBER = r"[-+]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][-+]?[0-9]+)?"


def _parsed(df: DataFrame, wkt_col: str) -> DataFrame:
    """Add ``_rings`` (array of arrays of point texts) and ``_ok``: at least one ring, every point two numbers."""
    body = F.regexp_extract(F.col(wkt_col), r"(?is)^\s*(?:MULTI)?POLYGON\s*(?:Z\s*|M\s*|ZM\s*)?\((.*)\)\s*$", 1)
    rings = F.transform(F.regexp_extract_all(body, F.lit(r"\(([^()]+)\)"), F.lit(1)),
                        lambda ring: F.split(F.trim(ring), r"\s*,\s*"))
    numbers = F.forall(F.flatten("_rings"), lambda pt: pt.rlike(rf"^\s*{_NUMBER}\s+{_NUMBER}(\s|$)"))
    return df.withColumn("_rings", rings).withColumn("_ok", (F.size("_rings") > 0) & numbers)


def wkt_rejects(df: DataFrame, wkt_col: str = "wkt") -> DataFrame:
    """Rows whose text is no polygon: empty, another geometry, or with a coordinate that is no number."""
    return _parsed(df, wkt_col).where(~F.coalesce("_ok", F.lit(False))).select(*df.columns)


def wkt_to_vertices(df: DataFrame, wkt_col: str = "wkt", keys=("z",)) -> DataFrame:
    """(keys, wkt) -> (keys, ring, i, x, y); rejected texts (see ``wkt_rejects``) give no rows."""
    good = _parsed(df, wkt_col).where("_ok")
    rings = good.select(*keys, F.posexplode("_rings").alias("ring", "pts"))
    pts = rings.select(*keys, "ring", F.posexplode("pts").alias("i", "pt"))
    xy = F.split(F.trim("pt"), r"\s+")
    return open_rings(pts.select(*keys, "ring", "i", xy[0].try_cast("double").alias("x"), xy[1].try_cast("double").alias("y")), keys)


def open_rings(v: DataFrame, keys=("z",)) -> DataFrame:
    """Drop the closing vertex of every ring, where it repeats the first."""
    w = Window.partitionBy(*keys, "ring")
    first = F.first(F.struct("x", "y")).over(w.orderBy("i").rowsBetween(Window.unboundedPreceding, 0))
    v = v.select("*", F.max("i").over(w).alias("_n"), first.alias("_f"))
    closing = (F.col("i") == F.col("_n")) & (F.col("x") == F.col("_f.x")) & (F.col("y") == F.col("_f.y")) & (F.col("_n") > 0)
    return v.where(~closing).drop("_n", "_f")


_POLYGON = "array<array<array<double>>>"


_FEATURE = "type string, properties map<string,string>, geometry string"


def _features(df: DataFrame, json_col: str, name_property: str) -> DataFrame:
    """One row per feature: its place ``_at``, ``_name``, ``_rings``, and why it is rejected (``_reason``, or null).

    The text is a feature or a collection of features.  Geometry and
    coordinates are read as JSON text first: coordinates are nested three deep
    in a Polygon and four deep in a MultiPolygon, and the type says which.
    """
    doc = F.from_json(F.col(json_col), f"features array<struct<{_FEATURE.replace(' string', ':string').replace(' map', ':map')}>>, {_FEATURE}")
    x = df.withColumn("_doc", doc)
    alone = F.array(F.struct("_doc.type", "_doc.properties", "_doc.geometry"))
    x = x.select(*df.columns, F.posexplode_outer(F.when(F.lower("_doc.type") == "featurecollection", F.col("_doc.features"))
                                                 .otherwise(alone)).alias("_at", "_f"))
    x = x.withColumn("_geo", F.from_json("_f.geometry", "type string, coordinates string"))
    kind, text = F.lower("_geo.type"), F.col("_geo.coordinates")
    rings = (F.when(kind == "polygon", F.from_json(text, _POLYGON))
             .when(kind == "multipolygon", F.flatten(F.from_json(text, f"array<{_POLYGON}>"))))
    x = x.select(*df.columns, "_at", F.element_at(F.col("_f.properties"), F.lit(name_property)).alias("_name"), kind.alias("_kind"),
                 rings.alias("_rings"))
    points = F.forall(F.flatten("_rings"), lambda pt: F.get(pt, 0).isNotNull() & F.get(pt, 1).isNotNull())
    whole = (F.size("_rings") > 0) & F.forall("_rings", lambda ring: F.size(ring) >= 3) & points
    reason = (F.when(F.col("_kind").isNull(), "no geometry").when(~F.col("_kind").isin("polygon", "multipolygon"), "no polygon")
              .when(~F.coalesce(whole, F.lit(False)), "broken coordinates").when(F.col("_name").isNull(), "no name"))
    return x.withColumn("_reason", reason)


def features_to_vertices(df: DataFrame, json_col: str = "feature", name_property: str = "name", keys=("z",)) -> DataFrame:
    """(keys, JSON of a feature or a collection) -> (keys, feature, name, ring, i, x, y).

    ``feature`` numbers the features of a text.  Built-in functions only;
    rejected features (see ``feature_rejects``) give no rows.
    """
    good = _features(df, json_col, name_property).where(F.col("_reason").isNull())
    rings = good.select(*keys, F.col("_at").alias("feature"), F.col("_name").alias("name"), F.posexplode("_rings").alias("ring", "pts"))
    pts = rings.select(*keys, "feature", "name", "ring", F.posexplode("pts").alias("i", "pt"))
    return open_rings(pts.select(*keys, "feature", "name", "ring", "i", F.col("pt")[0].alias("x"), F.col("pt")[1].alias("y")),
                      (*keys, "feature", "name"))


def feature_rejects(df: DataFrame, json_col: str = "feature", name_property: str = "name", keys=("z",)) -> DataFrame:
    """(keys, feature, reason) of features that are no named polygon: other geometry, broken coordinates, no name, no JSON."""
    bad = _features(df, json_col, name_property).where(F.col("_reason").isNotNull())
    return bad.select(*keys, F.coalesce("_at", F.lit(0)).alias("feature"), F.col("_reason").alias("reason"))


def vertices_to_features(vertices: DataFrame, keys=("z",), name_col: str = "n", name_property: str = "name", multi=None) -> DataFrame:
    """Vertex table (keys, name, ring, i, x, y) -> one JSON feature per zone; those where ``multi`` holds as MultiPolygon."""
    pts = vertices.groupBy(*keys, name_col, "ring").agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("p"))
    xy = F.transform("p", lambda e: F.array(e["x"], e["y"]))
    rings = pts.select(*keys, name_col, "ring", F.concat(xy, F.array(F.element_at(xy, 1))).alias("xy")).groupBy(*keys, name_col).agg(
        F.sort_array(F.collect_list(F.struct("ring", "xy"))).alias("rs"))
    coords = F.transform("rs", lambda r: r["xy"])
    head = (F.lit("Feature").alias("type"), F.create_map(F.lit(name_property), F.col(name_col)).alias("properties"))

    def feature(kind: str, c):
        return F.to_json(F.struct(*head, F.struct(F.lit(kind).alias("type"), c.alias("coordinates")).alias("geometry")))

    plain = feature("Polygon", coords)
    return rings.select(*keys, (plain if multi is None else F.when(multi, feature("MultiPolygon", F.array(coords))).otherwise(plain)).alias("feature"))


def vertices_to_wkt(vertices: DataFrame, keys=("z",)) -> DataFrame:
    """Vertex table (keys, ring, i, x, y) -> closed WKT polygon text per zone, holes as further rings.

    One group is one polygon outline, bounded by its vertex count.
    """
    pts = vertices.groupBy(*keys, "ring").agg(F.sort_array(F.collect_list(F.struct("i", "x", "y"))).alias("p"))
    txt = F.transform("p", lambda e: F.concat_ws(" ", e["x"].cast("string"), e["y"].cast("string")))
    ring = F.concat(F.lit("("), F.array_join(F.concat(txt, F.array(F.element_at(txt, 1))), ", "), F.lit(")"))
    rings = pts.select(*keys, "ring", ring.alias("txt")).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("ring", "txt"))).alias("rs"))
    return rings.select(*keys, F.concat(F.lit("POLYGON("), F.array_join(F.transform("rs", lambda r: r["txt"]), ", "),
                                        F.lit(")")).alias("wkt"))
