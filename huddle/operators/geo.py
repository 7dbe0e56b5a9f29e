"""Region of a point: the matching bounding box of the point's country.

Matching is inclusive on all four edges and only for points with a location.
Among several matching boxes the winner is the alphabetically first state
(NULL state first, as an ascending sort puts it), or the smallest box with
``tie="smallest_area"``.

One physical form at any size and mix of boxes: a multi-resolution cover. A box is listed
at the level whose cells are the smallest ones not smaller than the box, so it reaches
into four cells at most (nine if wider than 512 degrees), whether it is a city or half a continent. Levels are a factor of
eight apart (``SIDES``), and a point looks up one cell per level that has boxes, each a
left equi-join on (country, cell). Rows are kept as they are (no id is needed, repeated
and NULL ids are fine), the winner is picked per row with array functions, adaptive
execution broadcasts a level's cells when they are measured small and splits hot cells
otherwise. Which levels have boxes is the one thing looked up when the plan is built: a
single row over the box table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

EDGES = ("min_lat", "max_lat", "min_lng", "max_lng")
# Cell sides of the levels, in degrees: a factor of eight apart, from city blocks to the whole map.
SIDES = tuple(8.0 ** k for k in range(-2, 4))
LIMIT = 512.0


def _tie_key(b: Column, tie: str) -> Column:
    # struct compared ascending; FALSE < TRUE puts a NULL state first
    named = [b["state"].isNotNull().alias("n"), b["state"].alias("state")]
    if tie == "smallest_area":
        area = (b["max_lat"] - b["min_lat"]) * (b["max_lng"] - b["min_lng"])
        return F.struct(area.alias("a"), *named)
    if tie != "state":
        raise ValueError(f"unknown tie rule {tie!r}")
    return F.struct(*named)


def box_level() -> Column:
    """Index into ``SIDES`` of the cell side that a box is listed at; the last one takes every larger box."""
    extent = F.greatest(F.col("max_lat") - F.col("min_lat"), F.col("max_lng") - F.col("min_lng"))
    level = F.lit(len(SIDES) - 1)
    for i in range(len(SIDES) - 2, -1, -1):
        level = F.when(extent <= SIDES[i], i).otherwise(level)
    return level


def usable_boxes(boxes: DataFrame) -> DataFrame:
    """Boxes that a point can match, with their level; edges in the wrong order or NULL match nothing."""
    return (boxes.where(F.col("country_code").isNotNull() & (F.col("min_lat") <= F.col("max_lat"))
                        & (F.col("min_lng") <= F.col("max_lng"))).withColumn("__level", box_level()))


def used_levels(boxes: DataFrame) -> list[int]:
    """The levels that have boxes (at most ``len(SIDES)`` numbers)."""
    row = usable_boxes(boxes).agg(F.sort_array(F.collect_set("__level"))).first()
    return list(row[0])


def _cell(value: Column, side: float) -> Column:
    """Cell number along one axis, NULL for NULL; values beyond ``LIMIT`` share the border's cells."""
    return F.when(value.isNotNull(), F.floor(F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), value)) / side))


def box_cells(boxes: DataFrame, level: int) -> DataFrame:
    """(country, cell row, cell column) of one level -> the boxes that reach into the cell."""
    side = SIDES[level]

    def cells(lo: str, hi: str) -> Column:
        return F.explode(F.sequence(_cell(F.col(lo), side), _cell(F.col(hi), side)))

    b = usable_boxes(boxes).where(F.col("__level") == level)
    return (b.withColumn("__by", cells("min_lat", "max_lat")).withColumn("__bx", cells("min_lng", "max_lng"))
            .groupBy(F.col("country_code").alias("__geo_cc"), "__by", "__bx")
            .agg(F.collect_list(F.struct("state", *EDGES)).alias("__boxes")))


def _with_hits(points: DataFrame, boxes: DataFrame, country: str, lat: str, lng: str,
               has_loc: str | Column | None) -> DataFrame:
    """Every point with the array of its matching boxes in ``__hits`` (empty or NULL: none)."""
    la, lo = F.col(lat), F.col(lng)
    none = F.array().cast("array<struct<state:string,min_lat:double,max_lat:double,min_lng:double,max_lng:double>>")
    j = points.withColumn("__hits", none)
    for level in used_levels(boxes):
        grid, side = box_cells(boxes, level), SIDES[level]
        j = j.join(grid, (F.col(country) == F.col("__geo_cc")) & (_cell(la, side) == F.col("__by"))
                   & (_cell(lo, side) == F.col("__bx")), "left")
        found = F.filter("__boxes", lambda b: la.between(b["min_lat"], b["max_lat"]) & lo.between(b["min_lng"], b["max_lng"]))
        j = j.withColumn("__hits", F.concat("__hits", F.coalesce(found, none))).drop("__geo_cc", "__by", "__bx", "__boxes")
    if has_loc is None:
        return j
    return j.withColumn("__hits", F.when(F.col(has_loc) if isinstance(has_loc, str) else has_loc, F.col("__hits")))


def with_region(points: DataFrame, boxes: DataFrame, *, country: str = "country_code", lat: str = "latitude",
                lng: str = "longitude", has_loc: str | Column | None = "has_location", out: str = "region",
                tie: str = "state") -> DataFrame:
    """Every point row with its region (NULL without a matching box)."""
    best = F.array_min(F.transform("__hits", lambda b: _tie_key(b, tie)))
    return _with_hits(points, boxes, country, lat, lng, has_loc).withColumn(out, best["state"]).drop("__hits")


def box_matches(points: DataFrame, boxes: DataFrame, *, country: str = "country_code", lat: str = "latitude",
                lng: str = "longitude", has_loc: str | None = "has_location") -> DataFrame:
    """Every matching box per point; a point without one is kept with NULL box columns."""
    hits = _with_hits(points, boxes, country, lat, lng, has_loc).withColumn("__b", F.explode_outer("__hits"))
    return hits.select(*points.columns, *[F.col(f"__b.{c}").alias(c) for c in ("state", *EDGES)])
