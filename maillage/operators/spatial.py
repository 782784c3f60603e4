"""Which zone contains a point."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maillage.session import cut

# A cell in which more vertices of a zone lie is cut into FANOUT x FANOUT smaller ones, at most FINER times.
LEAF_VERTICES, FANOUT, FINER, COARSER = 16, 8, 3, 2
# Cells are taken to be larger by this part of their side when edges are sought, far more than rounding amounts to.
MARGIN = 1e-6


def _odd(edges: Column, test) -> Column:
    return F.size(F.filter(edges, test)) % 2 == 1


def _crossings_odd(edges: Column, lon: Column, lat: Column) -> Column:
    """Whether a ray from the point to the east crosses an odd number of the edges."""

    def crossed(e: Column) -> Column:
        at = (e["q_lon"] - e["p_lon"]) * (lat - e["p_lat"]) / F.nullif(e["q_lat"] - e["p_lat"], F.lit(0.0)) + e["p_lon"]
        return ((e["p_lat"] > lat) != (e["q_lat"] > lat)) & F.coalesce(lon < at, F.lit(False))

    return _odd(edges, crossed)


def _ends_odd(edges: Column, right: Column, reference: Column, lat: Column) -> Column:
    """Whether an odd number of edges end between two latitudes, east of a cell.

    There the edges go on as ones that do not touch the cell, so this is what those others add to a ray's
    crossings when its origin moves from one latitude to the other. An edge with both ends there adds nothing
    or two ends that count by themselves.
    """

    def ends(e: Column, end: str) -> Column:
        return (e[f"{end}_lon"] > right) & ((e[f"{end}_lat"] > lat) != (e[f"{end}_lat"] > reference))

    return _odd(edges, lambda e: ends(e, "p") != ends(e, "q"))


def _meets(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether an edge meets a box: their bounds overlap, and the box is not on one side of the edge."""
    dx, dy = e["q_lon"] - e["p_lon"], e["q_lat"] - e["p_lat"]
    sides = [dx * (y - e["p_lat"]) - dy * (x - e["p_lon"]) for x in (x0, x1) for y in (y0, y1)]
    within = (F.greatest(e["p_lon"], e["q_lon"]) >= x0) & (F.least(e["p_lon"], e["q_lon"]) <= x1)
    return within & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)


def _refine(cells: DataFrame, side: float, columns: Column, rows: Column, right: Column | None, reference: Column | None) -> DataFrame:
    """Cells of width ``side`` with the edges that meet each, from cells or whole polygons.

    ``odd`` of a cell is the parity of the crossings of a ray from its lower left corner with all edges but its
    own. It follows from the parity of the larger cell and from that one's edges, so nothing is looked up elsewhere;
    first edges are thinned by rows of cells, then by cells. Cells outside of the zone are dropped. Each step is one
    generator, which the optimiser neither repeats nor moves.
    """
    margin = side * MARGIN

    def band(cy: Column) -> Column:
        low = cy * F.lit(side)
        near = F.filter("edges", lambda e: (F.greatest(e["p_lat"], e["q_lat"]) >= low - margin) & (F.least(e["p_lat"], e["q_lat"]) <= low + side + margin))
        parity = F.col("odd") if right is None else F.col("odd") != _ends_odd(F.col("edges"), right, reference, low)
        return F.struct(cy.alias("cy"), near.alias("_near"), parity.alias("_parity"))

    def placed(cx: Column) -> Column:
        left, low, near = cx * F.lit(side), F.col("cy") * F.lit(side), F.col("_near")
        met = F.filter(near, lambda e: _meets(e, left - margin, low - margin, left + side + margin, low + side + margin))
        parity = F.col("_parity") != _crossings_odd(near, left, low)
        one = F.transform(F.array(met), lambda own: F.struct(cx.alias("cx"), own.alias("edges"), (parity != _crossings_odd(own, left, low)).alias("odd")))
        return F.get(one, F.lit(0))

    kept = [c for c in cells.columns if c not in ("cx", "cy", "edges", "odd")]
    bands = F.filter(F.transform(rows, band), lambda b: b["_parity"] | (F.size(b["_near"]) > 0))
    banded = cells.select(*kept, columns.alias("_columns"), F.inline(bands))
    small = F.filter(F.transform("_columns", placed), lambda c: c["odd"] | (F.size(c["edges"]) > 0))
    return banded.select(*kept, "cy", F.inline(small))


def _children(cells: DataFrame, side: float) -> DataFrame:
    """The smaller cells of every cell of width ``side * FANOUT``."""
    inner = [F.sequence(F.col(c) * FANOUT, F.col(c) * FANOUT + (FANOUT - 1)) for c in ("cx", "cy")]
    larger = side * FANOUT
    return _refine(cells.withColumns({"_right": (F.col("cx") + 1) * larger, "_low": F.col("cy") * larger}), side, *inner, F.col("_right"), F.col("_low")).drop("_right", "_low")


def polygon_edges(zones: DataFrame) -> DataFrame:
    """zone_id, polygon (its number in the zone), edges of all rings of it, with its bounds."""
    polygons = zones.select("zone_id", F.posexplode("geom").alias("polygon", "rings"))
    rings = F.transform("rings", lambda r: F.zip_with(
        F.slice(r, F.lit(1), F.size(r) - 1), F.slice(r, F.lit(2), F.size(r) - 1),
        lambda p, q: F.struct(p["lon"].alias("p_lon"), p["lat"].alias("p_lat"), q["lon"].alias("q_lon"), q["lat"].alias("q_lat")),
    ))
    solid = F.filter("rings", lambda r: F.size(r) > 1)
    edges = polygons.withColumn("rings", solid).select("zone_id", "polygon", F.flatten(rings).alias("edges")).where(F.size("edges") > 0)
    # Rings are closed, so first ends are all ends there are.
    return edges.select("*", *[
        pick(F.transform("edges", lambda e: e[f"p_{axis}"])).alias(f"{axis}_{end}") for axis in ("lon", "lat") for end, pick in (("min", F.array_min), ("max", F.array_max))
    ])


def _crowded(side: float) -> Column:
    left, low = F.col("cx") * F.lit(side), F.col("cy") * F.lit(side)
    return F.size(F.filter("edges", lambda e: e["p_lon"].between(left, left + side) & e["p_lat"].between(low, low + side))) > LEAF_VERTICES


def zone_cells(zones: DataFrame, cell: float) -> list[DataFrame]:
    """Cover of the zones by cells, from width ``cell`` on to ever smaller ones: zone_id, polygon, cx, cy, edges, odd.

    A cell with no edges lies inside its polygon. Where edges are NULL, the next table has the smaller cells that
    the cell is made of: so many vertices lie in it that its edges are no longer carried along. Edges that only pass
    do not make a cell smaller, as they would be copied to the smaller ones.
    """
    whole = polygon_edges(zones).withColumn("odd", F.lit(False))

    def span(axis: str, side: float) -> Column:
        return F.sequence(*(F.floor(F.col(f"{axis}_{end}") / side).cast("long") for end in ("min", "max")))

    def placed(polygons: DataFrame, side: float) -> DataFrame:
        return _refine(polygons, side, span("lon", side), span("lat", side), None, None).select("zone_id", "polygon", "cx", "cy", "edges", "odd")

    # Polygons over many cells start from larger ones, so that not every cell looks at all edges.
    narrow = (F.greatest(F.col("lon_max") - F.col("lon_min"), F.col("lat_max") - F.col("lat_min")) < cell * FANOUT)
    cells, side = placed(whole.where(narrow), cell), cell
    if not whole.where(~narrow).isEmpty():
        wide = placed(whole.where(~narrow), cell * FANOUT**COARSER)
        for power in range(COARSER - 1, -1, -1):
            wide = _children(wide, cell * FANOUT**power)
        cells = cells.unionByName(wide)
    tables = []
    for level in range(FINER + 1):
        cells = cut(cells)  # two readers: the join and the next level
        crowded = cells.where(_crowded(side))
        last = level == FINER or crowded.isEmpty()
        edges = F.col("edges") if last else F.when(~_crowded(side), F.col("edges")).alias("edges")
        tables.append(cells.select("zone_id", "polygon", "cx", "cy", edges, "odd"))
        if last:
            break
        side /= FANOUT
        cells = _children(crowded, side)
    return tables


def join_point_in_polygon(points: DataFrame, zones: DataFrame, cell: float = 0.1) -> DataFrame:
    """(point columns, zone_id) for every zone that contains the point.

    ``points``: lon, lat. ``zones``: zone_id and ``geom``, polygons of closed rings (the first ring is the outline,
    the others are holes). A ring is crossed once more per hole, so the parity over all rings of a polygon decides.
    The polygons of one zone are taken not to overlap, so a point comes out once per zone.

    Zones are covered by a quadtree of cells. ``cell``, which should be of the order of the size of a zone, is the
    width of those on which all points meet zones. A cell inside a zone carries no geometry. A cell on its border
    carries the edges that meet it and one parity, which together decide for its points exactly as all edges would;
    where these are many, points go on to smaller cells of that zone. So an edge is copied to the few small cells it
    passes, and the bytes shuffled grow with the edges. A polygon is read as one row, as it is given. Zones of one
    geometry are covered and tested once, and each of them gets the points found.
    """
    columns = points.columns
    shape = F.unhex(F.md5(F.to_json("geom").cast("binary")))
    shapes = zones.groupBy(shape.alias("_shape")).agg(F.first("geom").alias("geom"))
    found = _points_in_zones(points, shapes.withColumnRenamed("_shape", "zone_id"), cell).withColumnRenamed("zone_id", "_shape")
    return found.join(zones.select(shape.alias("_shape"), "zone_id"), "_shape").select(*columns, "zone_id")


def _points_in_zones(points: DataFrame, zones: DataFrame, cell: float) -> DataFrame:
    columns = points.columns
    left, out, side = points, None, cell
    for level, cells in enumerate(zone_cells(zones, cell)):
        keys = ["_cx", "_cy"] if level == 0 else ["zone_id", "_polygon", "_cx", "_cy"]
        placed = left.withColumns({"_cx": F.floor(F.col("lon") / side).cast("long"), "_cy": F.floor(F.col("lat") / side).cast("long")})
        met = placed.join(cells.withColumnsRenamed({"cx": "_cx", "cy": "_cy", "polygon": "_polygon"}), keys)
        right, low = (F.col("_cx") + 1) * F.lit(side), F.col("_cy") * F.lit(side)
        inside = F.col("odd") != (_ends_odd(F.col("edges"), right, low, F.col("lat")) != _crossings_odd(F.col("edges"), F.col("lon"), F.col("lat")))
        found = met.where(F.col("edges").isNotNull() & inside).select(*columns, "zone_id")
        out = found if out is None else out.unionAll(found)
        left = met.where("edges is null").select(*columns, "zone_id", "_polygon")
        side /= FANOUT
    return out
