"""Multi-resolution box cover: few cells for boxes of any size, and the same regions as all pairs."""

import random

from pyspark.sql import functions as F

from huddle import schemas
from huddle.operators import geo as G

EXTENTS = (0.0, 0.01, 1 / 64, 0.3, 1.0, 7.9, 8.0, 30.0, 64.0, 100.0, 360.0)
POINTS = "id int, country_code string, latitude double, longitude double, has_location boolean"


def _case(spark, seed=5):
    rng = random.Random(seed)
    boxes = []
    for i in range(150):
        h, w = rng.choice(EXTENTS), rng.choice(EXTENTS)
        lat, lng = rng.choice([rng.uniform(-90, 90), float(rng.randrange(-80, 80, 8))]), rng.choice([rng.uniform(-180, 180), -64.0])
        boxes.append((rng.choice(["NOR", "USA"]), rng.choice([None, f"s{i}"]), lat, lng, lat + h, lng + w))
    boxes += [("NOR", "wrong", 5.0, 5.0, 4.0, 6.0), ("NOR", "null", None, 0.0, 1.0, 1.0), (None, "x", -90.0, -180.0, 90.0, 180.0),
              ("USA", "world", -5000.0, -5000.0, 5000.0, 5000.0), boxes[0]]
    pts = [(i, rng.choice(["NOR", "USA", "GBR", None]), rng.uniform(-90, 90), rng.uniform(-180, 180), True) for i in range(300)]
    for i, b in enumerate(boxes[:150]):  # corners and edges are inside
        pts.append((1000 + i, b[0], rng.choice([b[2], b[4]]), rng.choice([b[3], b[5], (b[3] + b[5]) / 2]), True))
    pts += [(2000, "USA", 4000.0, -4000.0, True), (2001, "USA", None, 1.0, True), (2002, "USA", 1.0, 1.0, False),
            (2003, "USA", 1.0, 1.0, None), (2004, "NOR", float("nan"), 1.0, True), pts[0]]
    return boxes, pts, spark.createDataFrame(boxes, schemas.GEO_BOXES), spark.createDataFrame(pts, POINTS)


def test_cells_per_box_are_bounded_for_any_mix(spark):
    _, _, bdf, _ = _case(spark)
    cells = {}
    for level in G.used_levels(bdf):
        for r in G.box_cells(bdf, level).select(F.explode("__boxes").alias("b")).select("b.*").collect():
            cells[r] = cells.get(r, 0) + 1
    one = spark.createDataFrame([("NOR", "a", 10.0, 10.0, 10.01, 10.01), ("NOR", "b", -90.0, -180.0, 90.0, 180.0)], schemas.GEO_BOXES)
    assert G.used_levels(one) == [0, 5]
    assert sum(G.box_cells(one, n).count() for n in (0, 5)) == 5
    wide = [n for r, n in cells.items() if r.max_lat - r.min_lat > 512]
    assert wide == [9] and all(n <= 8 for r, n in cells.items() if r.state is None)  # stateless boxes may be equal rows
    assert max(n for r, n in cells.items() if r.state and r.state not in ("world", "s0")) <= 4


def test_matches_equal_all_pairs(spark):
    boxes, pts, bdf, pdf = _case(spark)

    def hits(p):
        return [b for b in boxes if p[4] and None not in (p[1], p[2], p[3], b[2]) and p[1] == b[0]
                and b[2] <= p[2] <= b[4] and b[3] <= p[3] <= b[5]]

    def state(p):
        return min((b[1] for b in hits(p)), key=lambda s: (s is not None, s or ""), default=None)
    got = [(r.id, r.region) for r in G.with_region(pdf, bdf).collect()]
    assert sorted(got, key=repr) == sorted(((p[0], state(p)) for p in pts), key=repr)
    pairs = [(r.id, r.state, r.min_lat, r.max_lng) for r in G.box_matches(pdf, bdf).collect()]
    want = [(p[0], *((b[1], b[2], b[5]) if b else (None,) * 3)) for p in pts for b in (hits(p) or [None])]
    assert sorted(pairs, key=repr) == sorted(want, key=repr)
    tight = {r.id: r.region for r in G.with_region(pdf, bdf, tie="smallest_area").collect()}
    for p in pts:
        area = min(((b[4] - b[2]) * (b[5] - b[3]) for b in hits(p)), default=None)
        assert area is None or tight[p[0]] in [b[1] for b in hits(p) if (b[4] - b[2]) * (b[5] - b[3]) == area]


def test_no_boxes(spark):
    _, pts, _, pdf = _case(spark)
    none = spark.createDataFrame([], schemas.GEO_BOXES)
    assert G.used_levels(none) == []
    assert G.with_region(pdf, none).where("region IS NULL").count() == len(pts)
    assert G.box_matches(pdf, none).count() == len(pts)
