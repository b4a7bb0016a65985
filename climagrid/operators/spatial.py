"""Grid cells to regions by largest overlap, without a geometry library."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from climagrid.functions.arithmetic import round_half_away
from climagrid.functions.text import surrogate_key
from climagrid.operators.ordering import top1_per_group

# Half cell widths, in degrees, of the monthly and the daily grid.
MONTHLY_HALF_CELL = 0.125
DAILY_HALF_CELL = 0.05

# Edges of one tile that share a key; a tile with more is dealt to several.
EDGES_PER_KEY = 4_096

# Rows of tiles that one covered stretch is listed for at most are 2 to the power of this.
MAX_LEVEL = 16

# Digits kept of an overlap area in square degrees. Float noise stays below.
AREA_DIGITS = 12


def cell_envelope(
    points: DataFrame, half: float, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Distinct points with the bounds of the square cell around each."""
    lat, lon = F.col("latitude"), F.col("longitude")
    return (
        points.select(F.col(latitude).alias("latitude"), F.col(longitude).alias("longitude"))
        .distinct()
        .select(
            "latitude",
            "longitude",
            (lon - half).alias("x0"),
            (lat - half).alias("y0"),
            (lon + half).alias("x1"),
            (lat + half).alias("y1"),
        )
    )


def _area_above(level: str) -> str:
    """Integral of max(y - level, 0) along a straight line from height a to b over width w."""
    u, v = f"(a - {level})", f"(b - {level})"
    crossing = f"pow(greatest({u}, {v}), 2) / (2 * abs({v} - {u})) * w"
    return (
        f"CASE WHEN {u} >= 0 AND {v} >= 0 THEN ({u} + {v}) / 2 * w "
        f"WHEN {u} <= 0 AND {v} <= 0 THEN 0D ELSE {crossing} END"
    )


def _oriented_edges(edges: DataFrame) -> DataFrame:
    """Edges from left to right with a weight: +1 if the region lies below, -1 if it lies above.

    Outer rings count plus, holes minus, whatever direction they are drawn in. A vertical edge runs
    from its first point to its second.
    """
    ring = ["region", "poly", "ring"]
    rings = edges.groupBy(*ring).agg(F.expr("signum(sum(x1 * y2 - x2 * y1))").alias("turn"))
    return edges.join(rings, ring).selectExpr(
        "region",
        "hash(poly, ring, seq) AS edge",
        "CASE WHEN ring = 0 THEN -turn ELSE turn END * CASE WHEN x1 <= x2 THEN 1D ELSE -1D END AS weight",
        "least(x1, x2) AS xmin",
        "greatest(x1, x2) AS xmax",
        "CASE WHEN x1 <= x2 THEN y1 ELSE y2 END AS yl",
        "CASE WHEN x1 <= x2 THEN y2 ELSE y1 END AS yr",
        "(y2 - y1) / nullif(x2 - x1, 0D) AS slope",
    )


def _in_columns(oriented: DataFrame, tile: float) -> DataFrame:
    """Each edge cut at the borders of the tile columns, from (xl, ya) to (xr, yb), with the tile rows of both ends."""
    def height(x: str) -> str:
        """Exact where the edge itself ends."""
        return f"CASE WHEN {x} >= xmax AND xmax > xmin THEN yr WHEN {x} <= xmin THEN yl ELSE yl + slope * ({x} - xmin) END"

    columns = oriented.selectExpr("*", f"explode(sequence(floor(xmin / {tile}D), floor(xmax / {tile}D))) AS tx")
    return columns.selectExpr(
        "region", "edge", "weight", "slope", "tx", f"greatest(xmin, tx * {tile}D) AS xl", f"least(xmax, (tx + 1) * {tile}D) AS xr",
        f"xmin / {tile}D <= tx AND tx < xmax / {tile}D AS enters", f"xmin = xmax AND xmin / {tile}D = tx AS on_border",
        f"{height('xl')} AS ya", f"CASE WHEN xmin = xmax THEN yr ELSE {height('xr')} END AS yb",
        f"floor(ya / {tile}D) AS row_a", f"floor(yb / {tile}D) AS row_b",
    )


def _covered(pieces: DataFrame) -> DataFrame:
    """(tx, level, node, region, cover): where the upper left corner of a tile lies in a region.

    Down the left border of a tile column, the weights of the edges that enter there add up to the cover of what lies
    below them. It is the same for all rows between two edges, however many: such a stretch is listed by its largest aligned pieces of
    2**level rows, at most two per level.
    """
    # The running sum takes all edges of a row together; between two of them the stretch is empty.
    down = W.partitionBy("region", "tx").orderBy(F.desc("row_a"))
    stretches = pieces.where("enters").select(
        "region", "tx", F.round(F.sum("weight").over(down)).alias("cover"), F.lead("row_a").over(down).alias("low"),
        (F.col("row_a") - 1).alias("high"),
    ).where("cover <> 0 AND low <= high")
    both = "filter(array(CASE WHEN pmod(first, 2) = 1 THEN first END, CASE WHEN pmod(last, 2) = 0 THEN last END), n -> n IS NOT NULL)"
    nodes = f"CASE WHEN first > last THEN array() WHEN level < {MAX_LEVEL} THEN array_distinct({both}) ELSE sequence(first, last) END"
    return stretches.selectExpr("*", f"explode(sequence(0, {MAX_LEVEL})) AS level").selectExpr(
        "region", "tx", "cover", "level", "ceil(low / pow(2D, level)) AS first", "floor((high + 1) / pow(2D, level)) - 1 AS last", f"{nodes} AS nodes"
    ).selectExpr("region", "tx", "cover", "level", "explode(nodes) AS node")


def join_spatial_overlap(cells: DataFrame, edges: DataFrame, tile: float = 1.0) -> DataFrame:
    """Overlap area of every (cell, region) that meet; 0 where they only touch.

    Cells and edges are cut at the borders of square tiles, and an edge is listed only in tiles that it runs through.
    In a tile, the region covers a part of a cell, seen from the top border of the tile downwards:

    * as much as covers the tile's upper left corner (see ``_covered``), over the whole width;
    * more or less to the right of each place where an edge crosses the top border;
    * less what lies above the edges inside the tile, or more what lies below them.

    Tiles without edges are covered as a whole or not at all, and how many of them a region has does not matter. Edges of a
    crowded tile are dealt to as many keys as their number asks for. Partial areas are summed before the shuffle.
    """
    pieces = _in_columns(_oriented_edges(edges), tile)
    listed = pieces.selectExpr("*", "explode(sequence(least(row_a, row_b), greatest(row_a, row_b))) AS ty")
    crowded = (
        listed.groupBy("tx", "ty").agg(F.expr(f"int(ceil(count(*) / {EDGES_PER_KEY}))").alias("salts")).where("salts > 1")
    )
    tiled = cells.selectExpr("*", f"explode(sequence(floor(x0 / {tile}D), floor(x1 / {tile}D))) AS tx").selectExpr(
        "*", f"explode(sequence(floor(y0 / {tile}D), floor(y1 / {tile}D))) AS ty"
    )
    parts = tiled.selectExpr(
        "*", f"greatest(x0, tx * {tile}D) AS px0", f"least(x1, (tx + 1) * {tile}D) AS px1",
        f"greatest(y0, ty * {tile}D) AS py0", f"least(y1, (ty + 1) * {tile}D) AS py1", f"(ty + 1) * {tile}D AS top",
    )
    dealt = parts.join(crowded, ["tx", "ty"], "left").selectExpr("*", "explode(sequence(0, coalesce(salts, 1) - 1)) AS salt")
    keyed = listed.join(crowded, ["tx", "ty"], "left").selectExpr(
        "tx", "ty", "pmod(edge, coalesce(salts, 1)) AS salt", "region", "weight", "slope", "xl", "xr", "on_border", "ya", "yb", "row_a", "row_b"
    )
    # An edge that crosses the top border matters to everything right of it, any other one to what it runs over.
    met = dealt.join(keyed, ["tx", "ty", "salt"]).where("xl <= px1 AND (px0 <= xr OR (row_a > ty) <> (row_b > ty))")

    def height(x: str) -> str:
        return f"CASE WHEN {x} <= xl THEN ya WHEN {x} >= xr THEN yb ELSE ya + slope * ({x} - xl) END"

    # From l to r is the part of the edge below the top border over the width of the cell's part, from tl to tr the whole edge; c is
    # where the edge crosses the border.
    crossing = "CASE WHEN slope IS NULL THEN xl ELSE greatest(xl, least(xr, xl + (top - ya) / slope)) END"
    heights = met.selectExpr(
        "*", "int(row_b > ty) - int(row_a > ty) AS rise", f"CASE WHEN rise <> 0 THEN {crossing} END AS c",
        "greatest(px0, CASE WHEN rise < 0 THEN c ELSE xl END) AS l", "least(px1, CASE WHEN rise > 0 THEN c ELSE xr END) AS r",
        "greatest(px0, xl) AS tl", "least(px1, xr) AS tr",
        "greatest(r - l, 0D) AS w", f"{height('l')} AS a", f"{height('r')} AS b",
        f"{height('tl')} AS ta", f"CASE WHEN xl = xr THEN yb ELSE {height('tr')} END AS tb",
    )
    step = "CASE WHEN rise = 0 OR on_border THEN 0D ELSE weight * rise * greatest(px1 - greatest(c, px0), 0D) * (py1 - py0) END"
    at_edges = heights.selectExpr(
        "latitude", "longitude", "region", f"weight * (({_area_above('py0')}) - ({_area_above('py1')})) + {step} AS area",
        "px0 <= xr AND least(ta, tb) <= y1 AND greatest(ta, tb) >= y0 AS touching",
    )
    asked = tiled.select("tx", "ty").distinct().selectExpr("*", f"explode(sequence(0, {MAX_LEVEL})) AS level").selectExpr(
        "*", "floor(ty / pow(2D, level)) AS node"
    )
    cover = asked.join(_covered(pieces), ["tx", "level", "node"]).select("tx", "ty", "region", "cover")
    inside = parts.join(cover, ["tx", "ty"]).selectExpr(
        "latitude", "longitude", "region", "cover * (px1 - px0) * (py1 - py0) AS area", "false AS touching"
    )
    return (
        at_edges.unionAll(inside)
        .groupBy("latitude", "longitude", "region")
        .agg(round_half_away(F.sum("area"), AREA_DIGITS).alias("overlap_area"), F.max("touching").alias("touching"))
        .where("overlap_area > 0 OR touching")
        .drop("touching")
    )


def cell_region_map(cells: DataFrame, edges: DataFrame, tile: float = 1.0) -> DataFrame:
    """The region with the largest overlap for every cell; equal areas go by name.

    A cell that only touches regions still gets one; a cell that meets none is left out.
    """
    overlaps = join_spatial_overlap(cells, edges, tile)
    best = top1_per_group(
        overlaps, ["latitude", "longitude"], [F.desc("overlap_area"), F.asc("region")]
    )
    return best.select(
        surrogate_key(best, ["latitude", "longitude"]).alias("coord_id"), "latitude", "longitude", "region"
    )
