import json
import math
import os

import pytest
from pyspark.sql import functions as F

from climagrid.operators import spatial as S
from climagrid.sources import regions as R

from conftest import rows


def ring(*points):
    return [list(p) for p in points]


SQUARE = ring((0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0))
HOLE = ring((0.5, 0.5), (1.0, 0.5), (1.0, 1.0), (0.5, 1.0), (0.5, 0.5))
CONCAVE = ring((2.5, -0.5), (6.0, -1.0), (4.0, 0.7), (5.5, 3.0), (2.5, 2.2), (2.5, -0.5))


def features():
    return [
        {"type": "Feature", "properties": {"NAME_1": "AliSabieh", "GID_1": "x"}, "geometry": {"type": "MultiPolygon", "coordinates": [[SQUARE, HOLE]]}},
        {"type": "Feature", "properties": {"NAME_1": "East"}, "geometry": {"type": "Polygon", "coordinates": [CONCAVE]}},
    ]


@pytest.fixture
def edges(spark, folder):
    os.makedirs(folder)
    path = f"{folder}/regions.json"
    with open(path, "w") as out:
        json.dump({"type": "FeatureCollection", "name": "r", "features": features()}, out, indent=1)
    return R.region_names(R.regions_from_geojson(spark, path))


def clip(points, inside, cross):
    out = []
    for a, b in zip(points, points[1:] + points[:1]):
        if inside(a):
            out.append(a)
        if inside(a) != inside(b):
            out.append(cross(a, b))
    return out


def brute_area(outline, x0, y0, x1, y1):
    """Area of a polygon inside a box by clipping it at the four sides."""
    points = [tuple(p) for p in outline[:-1]]

    def at_x(x):
        return lambda a, b: (x, a[1] + (b[1] - a[1]) * (x - a[0]) / (b[0] - a[0]))

    def at_y(y):
        return lambda a, b: (a[0] + (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]), y)

    for inside, cross in [
        (lambda p: p[0] >= x0, at_x(x0)), (lambda p: p[0] <= x1, at_x(x1)),
        (lambda p: p[1] >= y0, at_y(y0)), (lambda p: p[1] <= y1, at_y(y1)),
    ]:
        points = clip(points, inside, cross)
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:] + points[:1]))) / 2


@pytest.mark.parametrize("tile", [0.3, 1.0, 50.0])
def test_overlaps_match_clipping(spark, edges, tile):
    points = [(y / 4 - 1.1, x / 4 - 0.4) for y in range(20) for x in range(28)]
    cells = S.cell_envelope(spark.createDataFrame(points, "latitude double, longitude double"), 0.125)
    found = {(r.latitude, r.longitude, r.region): r.overlap_area for r in S.join_spatial_overlap(cells, edges, tile).collect()}
    expected = {}
    for lat, lon in points:
        box = (lon - 0.125, lat - 0.125, lon + 0.125, lat + 0.125)
        for name, area in [
            ("Ali Sabieh", brute_area(SQUARE, *box) - brute_area(HOLE, *box)), ("East", brute_area(CONCAVE, *box)),
        ]:
            if area > 1e-10:
                expected[(lat, lon, name)] = area
    found = {key: area for key, area in found.items() if area > 0}
    assert found.keys() == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in expected)


def test_ring_direction_does_not_matter(spark):
    rows_ = []
    for name, outline in [("a", SQUARE), ("b", SQUARE[::-1])]:
        rows_ += [(name, 0, 0, i, *outline[i], *outline[i + 1]) for i in range(4)]
    edges = spark.createDataFrame(rows_, "region string, poly int, ring int, seq int, x1 double, y1 double, x2 double, y2 double")
    cells = S.cell_envelope(spark.createDataFrame([(1.9, 1.9)], "latitude double, longitude double"), 0.25)
    assert {r.region: r.overlap_area for r in S.join_spatial_overlap(cells, edges).collect()} == {"a": 0.1225, "b": 0.1225}
    assert S.cell_region_map(cells, edges).first()["region"] == "a"


@pytest.mark.parametrize("tile", [0.25, 1.0])
def test_touching_counts_as_meeting(spark, tile):
    """Beside an edge, at a corner, inside a hole along its border; not beyond or in the open hole."""
    corners = [(*SQUARE[i], *SQUARE[i + 1]) for i in range(4)]
    hole = [(0.5, 0.5, 1.5, 0.5), (1.5, 0.5, 1.5, 1.5), (1.5, 1.5, 0.5, 1.5), (0.5, 1.5, 0.5, 0.5)]
    edges = spark.createDataFrame(
        [("s", 0, 0, i, *e) for i, e in enumerate(corners)] + [("s", 0, 1, i, *e) for i, e in enumerate(hole)],
        "region string, poly int, ring int, seq int, x1 double, y1 double, x2 double, y2 double",
    )
    points = {(1.0, 2.125): 0.0, (2.125, 2.125): 0.0, (1.0, -0.125): 0.0, (0.625, 1.0): 0.0, (1.0, 1.0): None, (1.0, 2.25): None, (1.0, 1.875): 0.0625}
    cells = S.cell_envelope(spark.createDataFrame(list(points), "latitude double, longitude double"), 0.125)
    found = {(r.latitude, r.longitude): r.overlap_area for r in S.join_spatial_overlap(cells, edges, tile).collect()}
    assert found == {p: area for p, area in points.items() if area is not None}


def test_cell_region_map_takes_the_largest(spark, edges):
    points = spark.createDataFrame([(0.25, 0.25), (0.75, 0.75), (50.0, 50.0), (0.25, 0.25)], "latitude double, longitude double")
    found = S.cell_region_map(S.cell_envelope(points, 0.125), edges)
    assert rows(found.select("latitude", "longitude", "region")) == [(0.25, 0.25, "Ali Sabieh")]
    assert found.first()["coord_id"] == spark.range(1).select(F.md5(F.lit("0.25-0.25"))).first()[0]


def test_edges_of_features(spark, edges, folder):
    assert rows(edges.groupBy("region", "poly", "ring").count()) == [("Ali Sabieh", 0, 0, 4), ("Ali Sabieh", 0, 1, 4), ("East", 0, 0, 5)]
    first = edges.where("region = 'East' and seq = 1").first()
    assert (first.x1, first.y1, first.x2, first.y2) == (6.0, -1.0, 4.0, 0.7)
    lines = f"{folder}/lines.json"
    with open(lines, "w") as out:
        out.write("\n".join(json.dumps(f) for f in features()))
    again = R.region_names(R.regions_from_geojson(spark, lines, line_delimited=True))
    assert rows(again) == rows(edges)
    assert R.read_features(spark, lines, True).first()["properties"] == {"NAME_1": "AliSabieh", "GID_1": "x"}


def edge_rows(name, outline, poly=0, ring_number=0):
    return [(name, poly, ring_number, i, *outline[i], *outline[i + 1]) for i in range(len(outline) - 1)]


EDGES = "region string, poly int, ring int, seq int, x1 double, y1 double, x2 double, y2 double"
POINTS = "latitude double, longitude double"


def provinces():
    """Six regions in two rows that share winding borders, from a rule: every inner point of a border belongs to two outlines."""

    def border(a, b, steps, depth, phase):
        (x0, y0), (x1, y1) = a, b
        points = [a]
        for i in range(1, steps):
            t = i / steps
            bend = depth * math.sin(math.pi * t) * math.sin(phase + 37 * t)
            points.append((x0 + (x1 - x0) * t - (y1 - y0) * bend, y0 + (y1 - y0) * t + (x1 - x0) * bend))
        return [*points, b]

    corner = {(i, j): (41.75 + 0.6 * i + 0.05 * j, 10.9 + 0.8 * j - 0.07 * i) for i in range(4) for j in range(3)}
    across = {(i, j): border(corner[i, j], corner[i + 1, j], 60, 0.12, i + 3 * j) for i in range(3) for j in range(3)}
    up = {(i, j): border(corner[i, j], corner[i, j + 1], 45, 0.1, 5 + i + 4 * j) for i in range(4) for j in range(2)}
    outlines = {}
    for j in range(2):
        for i in range(3):
            outline = across[i, j] + up[i + 1, j][1:] + across[i, j + 1][::-1][1:] + up[i, j][::-1][1:]
            outlines[f"province {i}{j}"] = outline if (i + j) % 2 else outline[::-1]
    return outlines


@pytest.mark.parametrize("half", [S.MONTHLY_HALF_CELL, S.DAILY_HALF_CELL])
def test_detailed_borders(spark, monkeypatch, half):
    """Areas, cell counts and largest regions on lattices over winding borders, with crowded tiles dealt to several keys."""
    monkeypatch.setattr(S, "EDGES_PER_KEY", 50)
    outlines = provinces()
    edges = spark.createDataFrame([r for name, o in outlines.items() for r in edge_rows(name, o)], EDGES)
    step = 2 * half
    points = [(round(10.4 + i * step, 6), round(41.4 + j * step, 6)) for i in range(int(2.6 / step)) for j in range(int(2.6 / step))]
    cells = S.cell_envelope(spark.createDataFrame(points, POINTS), half)
    expected = {}
    for lat, lon in points:
        for name, outline in outlines.items():
            area = brute_area([*outline[:-1], outline[0]], lon - half, lat - half, lon + half, lat + half)
            if area > 1e-10:
                expected[lat, lon, name] = area
    found = {(r.latitude, r.longitude, r.region): r.overlap_area for r in S.join_spatial_overlap(cells, edges, 0.5).collect()}
    assert {k for k, area in found.items() if area > 1e-10} == expected.keys()
    assert all(abs(found[k] - expected[k]) < 1e-9 for k in expected)
    shape = sum(abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(o, o[1:]))) / 2 for o in outlines.values())
    assert abs(sum(found.values()) - shape) < 1e-6  # the lattice holds all of them, and they share no area
    best = {}
    for (lat, lon, name), area in expected.items():
        best[lat, lon] = min(best.get((lat, lon), (0, "")), (-area, name))
    chosen = {(r.latitude, r.longitude): r.region for r in S.cell_region_map(cells, edges, 0.5).collect()}
    assert {k: name for k, (_, name) in best.items()} == {k: chosen[k] for k in best}


def test_height_of_a_region_costs_nothing(spark):
    """A region of ten million rows of tiles is listed like one of ten."""
    listed = {}
    for height in (10.0, 1e7):
        outline = [(0.25, 0.5), (2.5, 0.5), (2.5, height), (0.25, height + 0.25), (0.25, 0.5)]
        edges = spark.createDataFrame(edge_rows("tall", [(x, float(y)) for x, y in outline]), EDGES)
        steep = S._in_columns(S._oriented_edges(edges), 1.0).where("slope IS NOT NULL")
        listed[height] = S._covered(steep).count()
    assert listed[10.0] <= listed[1e7] <= 3 * 2 * S.MAX_LEVEL + 3 * 1e7 / 2**S.MAX_LEVEL
    outline = [(0.25, -1000.5), (2.5, -1000.5), (2.5, 3000.0), (0.25, 3000.0), (0.25, -1000.5)]
    edges = spark.createDataFrame(edge_rows("tall", outline), EDGES)
    points = [(y + 0.3, 1.9) for y in (-1002.0, -1000.9, -700.0, 0.0, 1234.0, 2999.5, 3001.0)]
    cells = S.cell_envelope(spark.createDataFrame(points, POINTS), 0.5)
    found = {r.latitude: r.overlap_area for r in S.join_spatial_overlap(cells, edges).collect()}
    expected = {y: round(brute_area(outline, x - 0.5, y - 0.5, x + 0.5, y + 0.5), 9) for y, x in points}
    assert {y: round(a, 9) for y, a in found.items()} == {y: a for y, a in expected.items() if a > 0}


def test_corners_and_borders_of_tiles(spark):
    """Outlines whose points, edges and crossings lie exactly on tile borders, and a region around a hole of whole tiles."""
    shapes = {
        "diamond": [(1.0, 0.0), (2.0, 1.0), (1.0, 2.0), (0.0, 1.0), (1.0, 0.0)],
        "steps": [(3.0, 0.0), (6.0, 0.0), (6.0, 1.0), (5.0, 1.0), (5.0, 2.0), (4.0, 2.0), (4.0, 3.0), (3.0, 3.0), (3.0, 0.0)],
        "slab": [(-4.0, -3.0), (8.0, -3.0), (8.0, -1.0), (-4.0, -1.0), (-4.0, -3.0)],
        "frame": [(-4.0, 4.0), (4.0, 4.0), (4.0, 12.0), (-4.0, 12.0), (-4.0, 4.0)],
    }
    hole = [(-2.0, 6.0), (2.0, 6.0), (2.0, 10.0), (-2.0, 10.0), (-2.0, 6.0)]
    rows_ = [r for name, o in shapes.items() for r in edge_rows(name, o)] + edge_rows("frame", hole, 0, 1)
    edges = spark.createDataFrame(rows_, EDGES)
    points = [(y / 2 - 4, x / 2 - 5) for y in range(36) for x in range(30)]
    for half in (0.25, 0.4):
        cells = S.cell_envelope(spark.createDataFrame(points, POINTS), half)
        found = {(r.latitude, r.longitude, r.region): r.overlap_area for r in S.join_spatial_overlap(cells, edges).collect() if r.overlap_area > 0}
        expected = {}
        for lat, lon in points:
            box = (lon - half, lat - half, lon + half, lat + half)
            for name, outline in shapes.items():
                area = brute_area(outline, *box) - (brute_area(hole, *box) if name == "frame" else 0)
                if area > 1e-10:
                    expected[lat, lon, name] = area
        assert found.keys() == expected.keys()
        assert all(abs(found[k] - expected[k]) < 1e-9 for k in expected)
