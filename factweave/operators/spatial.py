"""Spatial filters and joins (J19, J20, Q25, Q28): candidates meet in grid cells, exact tests run on them in Arrow batches."""

from __future__ import annotations

import functools

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factweave.functions.arrow import arrow_udf
from factweave.functions import geo
from factweave.operators.rows import q

RELATIONS = {
    "within": lambda g, area: geo.within(g, area),
    "intersects": lambda g, area: geo.intersects(g, area),
    "not_intersects": lambda g, area: not geo.intersects(g, area),
    "centroid_within": lambda g, area: geo.contains(area, geo.centroid(g)),
}


def shape(df: DataFrame) -> Column:
    """A row's geometry, or else its point."""
    return F.coalesce(F.nullif(q("geometry"), F.lit("")), F.nullif(q("point"), F.lit("")))


def related(df: DataFrame, area_wkt: str, relation: str) -> DataFrame:
    """Rows whose geometry (else point) stands in a relation to one area."""
    if relation not in RELATIONS:
        raise ValueError(f"Invalid geometric_relation: '{relation}'. Must be one of {list(RELATIONS)}.")
    area = geo.parse_wkt(area_wkt)
    test = RELATIONS[relation]

    @arrow_udf("boolean")
    def holds(values: pd.Series) -> pd.Series:
        return values.map(lambda v: bool((g := geo.parse_wkt(v)) and geo.first_position(g) and test(g, area)), na_action="ignore")

    where = shape(df) if relation != "centroid_within" else F.coalesce(F.nullif(q("point"), F.lit("")), F.nullif(q("geometry"), F.lit("")))
    return df.where(F.coalesce(holds(where), F.lit(False)))


@functools.lru_cache(maxsize=4096)
def _parsed(wkt: str) -> geo.Geometry | None:
    """A geometry, remembered by a worker, so that one that meets many others is parsed once."""
    return geo.parse_wkt(wkt)


@arrow_udf("double")
def _overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([geo.overlap_area(_parsed(x), _parsed(y)) for x, y in zip(a, b)], dtype=float)


#: Levels of the grid; a cell's side is four times that of the level below.
LEVELS = 9


def _box_pairs(shapes: DataFrame, cell: float) -> DataFrame:
    """Pairs ``a, b`` (structs ``entity, box``) whose boxes touch, each once, the smaller entity first.

    A box is kept at the level whose cells are as large as it, where it covers at most four, and looks for others at
    this level and at all above, where it covers at most four again. So a pair meets at the level of the larger, in
    the one cell that holds the lower left corner of the boxes' intersection, and the number of rows does not
    depend on how large boxes are.
    """
    side = F.greatest(F.col("box.max_x") - F.col("box.min_x"), F.col("box.max_y") - F.col("box.min_y"))
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        level = F.when(side <= cell * 4**k, F.lit(k)).otherwise(level)
    shapes = shapes.select(F.struct("entity", "box").alias("own"), level.alias("level"))
    sizes = F.array(*(F.lit(cell * 4**k) for k in range(LEVELS)))

    def placed(df: DataFrame, at: str, name: str) -> DataFrame:
        size = F.get(sizes, F.col(at))
        low_x, high_x, low_y, high_y = (F.floor(F.col(f"own.box.{c}") / size) for c in ("min_x", "max_x", "min_y", "max_y"))
        df = df.withColumn("cx", F.explode(F.sequence(low_x, high_x))).withColumn("cy", F.explode(F.sequence(low_y, high_y)))
        return df.withColumnRenamed("own", name)

    kept = placed(shapes, "level", "a")
    asks = placed(shapes.withColumnRenamed("level", "own_level").withColumn("level", F.explode(F.sequence(F.col("own_level"), F.lit(LEVELS - 1)))), "level", "b")
    met = kept.join(asks, ["level", "cx", "cy"]).where("own_level < level or a.entity < b.entity")
    met = met.where("a.box.min_x <= b.box.max_x and b.box.min_x <= a.box.max_x and a.box.min_y <= b.box.max_y and b.box.min_y <= a.box.max_y")
    size = F.get(sizes, F.col("level"))
    corner = (F.floor(F.greatest("a.box.min_x", "b.box.min_x") / size) == F.col("cx")) & (F.floor(F.greatest("a.box.min_y", "b.box.min_y") / size) == F.col("cy"))
    turned = F.col("a.entity") > F.col("b.entity")
    return met.where(corner).select(F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"))


#: Entities of one shape that travel in one row, about.
CHUNK = 256


def duplicate_geometries(entities: DataFrame, cell: float = 0.05, threshold: float = 0.95) -> DataFrame:
    """Pairs of entities whose areas overlap, ``kind`` two-way, one-way or any by the share of each that is covered.

    Only boxes and areas travel through the grid, each distinct shape once, however many entities have it. Of pairs of
    rectangles they tell the overlap; the others fetch their geometries then. At last every pair of shapes is written
    out for its entities, which lie in rows of about ``CHUNK``, so that shapes of many entities spread over all tasks.
    """
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = entities.where("geometry <> '' and entity is not null").select("entity", "geometry", F.sha2("geometry", 256).alias("shape"))
    drawn = rows.groupBy("shape").agg(F.count("*").alias("n"), F.first("geometry").alias("geometry"))
    chunk = F.pmod(F.xxhash64("entity"), F.ceil(F.col("n") / CHUNK))
    members = rows.select("entity", "shape").join(drawn.select("shape", "n"), "shape").groupBy("shape", chunk.alias("chunk")).agg(F.collect_list("entity").alias("members"))
    shapes = drawn.select(F.col("shape").alias("entity"), "n", geo.measures_of("geometry").alias("box")).where("box.min_x is not null")
    own = F.struct("entity", "box")
    pairs = _box_pairs(shapes.select("entity", "box"), cell).unionByName(shapes.where("n > 1").select(own.alias("a"), own.alias("b")))
    width = F.least("a.box.max_x", "b.box.max_x") - F.greatest("a.box.min_x", "b.box.min_x")
    height = F.least("a.box.max_y", "b.box.max_y") - F.greatest("a.box.min_y", "b.box.min_y")
    pairs = pairs.withColumn("plain", F.col("a.box.rectangle") & F.col("b.box.rectangle"))
    pairs = pairs.select(F.col("a.entity").alias("shape_a"), F.col("b.entity").alias("shape_b"), F.col("a.box.area").alias("area_a"), F.col("b.box.area").alias("area_b"), "plain", (width * height).alias("common"))
    known = pairs.where("plain")
    texts = [drawn.select(F.col("shape").alias(f"shape_{k}"), F.col("geometry").alias(f"geometry_{k}")) for k in "ab"]
    rest = pairs.where("not plain").join(texts[0], "shape_a").join(texts[1], "shape_b").withColumn("common", _overlap("geometry_a", "geometry_b")).select(known.columns)
    pairs = known.unionByName(rest).where("common > 0")
    pairs = pairs.withColumn("share_a", F.col("common") / F.col("area_a")).withColumn("share_b", F.col("common") / F.col("area_b"))
    both, either = (F.least("share_a", "share_b") >= threshold), (F.greatest("share_a", "share_b") >= threshold)
    pairs = pairs.select("shape_a", "shape_b", "share_a", "share_b", F.when(both, "two-way").when(either, "one-way").otherwise("any").alias("kind"))
    for k in "ab":
        pairs = pairs.join(members.select(F.col("shape").alias(f"shape_{k}"), F.col("chunk").alias(f"chunk_{k}"), F.col("members").alias(f"members_{k}")), f"shape_{k}")
    # Chunks of one shape meet once; within a chunk, so do its entities.
    pairs = pairs.where("shape_a <> shape_b or chunk_a <= chunk_b").repartition(parts, "shape_a", "shape_b", "chunk_a", "chunk_b")
    within = (F.col("shape_a") == F.col("shape_b")) & (F.col("chunk_a") == F.col("chunk_b"))
    pairs = pairs.select("members_b", "share_a", "share_b", "kind", within.alias("within"), F.explode("members_a").alias("one"))
    pairs = pairs.select("one", "share_a", "share_b", "kind", "within", F.explode("members_b").alias("other")).where("one < other or not within and one > other")
    turned = F.col("one") > F.col("other")
    return pairs.select(
        F.least("one", "other").alias("entity_a"),
        F.greatest("one", "other").alias("entity_b"),
        F.when(turned, F.col("share_b")).otherwise(F.col("share_a")).alias("share_a"),
        F.when(turned, F.col("share_a")).otherwise(F.col("share_b")).alias("share_b"),
        "kind",
    )


def best_overlap(pairs: DataFrame) -> DataFrame:
    """The closest pair of each first entity."""
    window = Window.partitionBy("entity_a").orderBy((F.col("share_a") + F.col("share_b")).desc(), "entity_b")
    return pairs.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def equal_points(entities: DataFrame) -> DataFrame:
    """J19 for points: entities that share their point with a smaller one."""
    points = entities.where("point <> ''").select("entity", F.regexp_replace("point", r"\s+", " ").alias("point"))
    least = points.groupBy("point").agg(F.min("entity").alias("entity_a"), F.count("*").alias("n")).where("n > 1").drop("n")
    return points.join(least, "point").where("entity <> entity_a").select("entity_a", F.col("entity").alias("entity_b"), "point")
