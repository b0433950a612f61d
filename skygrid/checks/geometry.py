"""Geometry, rasters, regions and box queries."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from skygrid.checks.layout import CELL_NUMS, stored
from skygrid.checks.registry import query, sql
from skygrid.functions import color, columns, geo
from skygrid.operators import bitmaps as bm, boxes, grid, rasters as ra, regions as rg, stations as st
from skygrid.params import BITMAP_BLOCK, BITMAP_RAMP
from skygrid.schema import CELL_VARIABLES, MAP_VARIABLES
from skygrid.sources import adapters as ad, folders, tables

# Map template of the checks: 5 km cells over the grid, drawn at a fifth of a degree (about a 20 km block).
MAP = ra.Raster(ad.CELL_XMIN, ad.CELL_YMAX, 5000.0, 100, 100)
MAP_LONLAT = ra.Raster(-5.6, 41.7, 0.2, 24, 32)
EXTENT = (ad.CELL_XMIN, ad.CELL_XMAX, ad.CELL_YMIN, ad.CELL_YMAX)

# The projection written out for the second engine from a published form of the series (Karney 2011
# coefficients), with sums over a table of coefficients instead of chained expressions.
_N = "(1e0 / 298.257222101e0) / (2e0 - 1e0 / 298.257222101e0)"
_CONST = f"""select n, 6378137e0 / (1e0 + n) * (1e0 + power(n, 2) / 4e0 + power(n, 4) / 64e0) * 0.9996e0 as ka,
  2e0 * sqrt(n) / (1e0 + n) as ec,
  n / 2e0 - 2e0 * power(n, 2) / 3e0 + 5e0 * power(n, 3) / 16e0 + 41e0 * power(n, 4) / 180e0 as a1,
  13e0 * power(n, 2) / 48e0 - 3e0 * power(n, 3) / 5e0 + 557e0 * power(n, 4) / 1440e0 as a2,
  61e0 * power(n, 3) / 240e0 - 103e0 * power(n, 4) / 140e0 as a3, 49561e0 * power(n, 4) / 161280e0 as a4,
  n / 2e0 - 2e0 * power(n, 2) / 3e0 + 37e0 * power(n, 3) / 96e0 - power(n, 4) / 360e0 as b1,
  power(n, 2) / 48e0 + power(n, 3) / 15e0 - 437e0 * power(n, 4) / 1440e0 as b2,
  17e0 * power(n, 3) / 480e0 - 37e0 * power(n, 4) / 840e0 as b3, 4397e0 * power(n, 4) / 161280e0 as b4,
  2e0 * n - 2e0 * power(n, 2) / 3e0 - 2e0 * power(n, 3) + 116e0 * power(n, 4) / 45e0 as d1,
  7e0 * power(n, 2) / 3e0 - 8e0 * power(n, 3) / 5e0 - 227e0 * power(n, 4) / 45e0 as d2,
  56e0 * power(n, 3) / 15e0 - 136e0 * power(n, 4) / 35e0 as d3, 4279e0 * power(n, 4) / 630e0 as d4
  from (select {_N} as n)"""


def to_lonlat_sql(source: str, ids: str) -> str:
    p = ", ".join(ids.split())
    sn = " + ".join(f"b{j} * sin({2 * j} * xi) * (exp({2 * j} * eta) + exp(-{2 * j} * eta)) / 2e0" for j in range(1, 5))
    cn = " + ".join(f"b{j} * cos({2 * j} * xi) * (exp({2 * j} * eta) - exp(-{2 * j} * eta)) / 2e0" for j in range(1, 5))
    dl = " + ".join(f"d{j} * sin({2 * j} * chi)" for j in range(1, 5))
    return f"""select {p}, -3e0 + degrees(atan2((exp(e1) - exp(-e1)) / 2e0, cos(x1))) as lon, degrees(chi + {dl}) as lat
      from (select *, asin(sin(x1) * 2e0 / (exp(e1) + exp(-e1))) as chi
      from (select *, xi - ({sn}) as x1, eta - ({cn}) as e1
      from (select {p}, y / ka as xi, (x - 500000e0) / ka as eta, k.* from {source} cross join ({_CONST}) k)))"""


def to_xy_sql(source: str, ids: str) -> str:
    p = ", ".join(ids.split())
    sx = " + ".join(f"a{j} * cos({2 * j} * xi) * (exp({2 * j} * eta) - exp(-{2 * j} * eta)) / 2e0" for j in range(1, 5))
    sy = " + ".join(f"a{j} * sin({2 * j} * xi) * (exp({2 * j} * eta) + exp(-{2 * j} * eta)) / 2e0" for j in range(1, 5))
    return f"""select {p}, 500000e0 + ka * (eta + {sx}) as px, ka * (xi + {sy}) as py
      from (select *, atan2(t, cos(lam)) as xi, ln((1e0 + q) / (1e0 - q)) / 2e0 as eta
      from (select *, sin(lam) / sqrt(1e0 + t * t) as q
      from (select *, (exp(m) - exp(-m)) / 2e0 as t
      from (select *, ln((1e0 + s) / (1e0 - s)) / 2e0 - ec * ln((1e0 + ec * s) / (1e0 - ec * s)) / 2e0 as m
      from (select {p}, sin(radians(lat)) as s, radians(lon + 3e0) as lam, k.* from {source} cross join ({_CONST}) k)))))"""


LONLAT_STEP = {"v_ll": to_lonlat_sql("v_topo", "cell_id partition x y")}


@query("crs_transform", sql("v_topo", "select cell_id, lon * 1e4 as lon, lat * 1e4 as lat, px, py from ("
    + to_xy_sql("v_ll", "cell_id lon lat") + ")", "", "cell_id", "lon lat px py", more=LONLAT_STEP))
def crs_transform(spark, sf):
    lon, lat = geo.xy_to_lonlat(F.col("x"), F.col("y"))
    cells = ad.topo(spark, sf).select("cell_id", lon.alias("lon"), lat.alias("lat"))
    px, py = geo.lonlat_to_xy(F.col("lon"), F.col("lat"))
    # Degrees are shown times 10,000, so that four decimals are 1e-8 degrees.
    return cells.select("cell_id", (F.col("lon") * 1e4).alias("lon"), (F.col("lat") * 1e4).alias("lat"), px.alias("px"), py.alias("py"))


@query("peninsula_bbox", sql("v_obs", """
  select stationid as "stationID", dates, lon, lat from (
    select *, (x - 300000e0) / 10000e0 - 20e0 as lon, (y - 4100000e0) / 20000e0 + 25e0 as lat from v_obs)
  where lon between -15 and 5 and lat between 35 and 44.4e0""", "stationID dates", "", "lon lat"))
def peninsula_bbox(spark, sf):
    # Positions spread wider than the box, so that it cuts.
    obs = ad.obs(spark, sf).withColumns({
        "lon": (F.col("x") - 300000.0) / 10000.0 - 20.0, "lat": (F.col("y") - 4100000.0) / 20000.0 + 25.0})
    return st.keep_peninsula(obs).select("stationID", "dates", "lon", "lat")


@query("partition_bbox", sql("v_boxes", "select * from v_boxes", "", "i_step topo_ncells", "xmin xmax ymin ymax"))
def partition_bbox(spark, sf):
    return grid.partition_boxes(ad.topo(spark, sf))


@query("buffer_predicate", sql("v_stations v_boxes", """
  select sid, i_step,
    greatest(xmin - x, 0e0, x - xmax) as dx, greatest(ymin - y, 0e0, y - ymax) as dy
  from v_stations join v_boxes on sqrt(power(greatest(xmin - x, 0e0, x - xmax), 2) + power(greatest(ymin - y, 0e0, y - ymax), 2)) <= 99000e0""",
    "", "sid i_step", "dx dy"))
def buffer_predicate(spark, sf):
    boxes_ = grid.partition_boxes(ad.topo(spark, sf))
    near = st.stations_in_partitions(ad.stations(spark, sf), boxes_).join(boxes_, "i_step")
    x, y = F.col("x"), F.col("y")
    return near.select(
        "sid", "i_step", F.greatest(F.col("xmin") - x, F.lit(0.0), x - F.col("xmax")).alias("dx"),
        F.greatest(F.col("ymin") - y, F.lit(0.0), y - F.col("ymax")).alias("dy"))


@query("wkt_text", sql("v_stations v_boxes", """
  select sid as id, printf('POINT (%.1f %.1f)', x, y) as wkt from v_stations
  union all select i_step, printf('POLYGON ((%.1f %.1f, %.1f %.1f, %.1f %.1f, %.1f %.1f, %.1f %.1f))',
    xmin - 99000e0, ymin - 99000e0, xmax + 99000e0, ymin - 99000e0, xmax + 99000e0, ymax + 99000e0, xmin - 99000e0, ymax + 99000e0,
    xmin - 99000e0, ymin - 99000e0) from (select i_step, round(xmin, 0) as xmin, round(xmax, 0) as xmax, round(ymin, 0) as ymin, round(ymax, 0) as ymax from v_boxes)""",
    "wkt", "id"))
def wkt_text(spark, sf):
    points = ad.stations(spark, sf).select(F.col("sid").alias("id"), geo.point_wkt(F.col("x"), F.col("y")).alias("wkt"))
    b = 99000.0
    r = {c: F.round(c, 0) for c in ("xmin", "ymin", "xmax", "ymax")}
    outlines = grid.partition_boxes(ad.topo(spark, sf)).select(
        F.col("i_step").cast("bigint").alias("id"),
        geo.box_wkt(r["xmin"] - b, r["ymin"] - b, r["xmax"] + b, r["ymax"] + b).alias("wkt"))
    return points.unionByName(outlines)


@query("wkb_hex")
def wkb_hex(spark, sf):
    return ad.topo(spark, sf).select("cell_id", "x", "y", geo.point_wkb_hex(F.col("x"), F.col("y")).alias("geom_hex"))


def edges(spark, sf):
    return rg.wkt_edges(ad.regions(spark, sf), "rid")


def members(spark, sf):
    return rg.cells_in_regions(ad.cells(spark, sf), edges(spark, sf), "rid")


_CORNERS = "(values (0,-50000,-30000),(1,-30000,-50000),(2,30000,-50000),(3,50000,-30000),(4,50000,30000),(5,30000,50000),(6,-30000,50000),(7,-50000,30000),(8,-50000,-30000)) p(i,dx,dy)"
_HOLE = "(values (0,-10000,-10000),(1,10000,-10000),(2,10000,10000),(3,-10000,10000),(4,-10000,-10000)) p(i,dx,dy)"


def _edge_sql(ring, corners, where=""):
    return f"""select rid, 0 as part, {ring} as ring, a.i as edge, cx + a.dx as x1, cy + a.dy as y1, cx + b.dx as x2, cy + b.dy as y2
      from v_centres cross join {corners.replace('p(', 'a(')} join {corners.replace('p(', 'b(')} on b.i = a.i + 1 {where}"""


@query("wkt_edges", sql("v_centres", _edge_sql(0, _CORNERS) + " union all " + _edge_sql(1, _HOLE, "where rid % 5 = 0"),
    "", "rid part ring edge", "x1 y1 x2 y2"))
def wkt_edges(spark, sf):
    return edges(spark, sf)


@query("point_in_polygon", sql("v_inside", "select rid, cell_id from v_inside", "", "rid cell_id"))
def point_in_polygon(spark, sf):
    return members(spark, sf)


@query("mask_by_polygon", sql(
    "v_inside", "select cell_id, x, y from v_cells where cell_id in (select cell_id from v_inside where rid % 3 <> 1)", "", "cell_id", "x y"))
def mask_by_polygon(spark, sf):
    kept = rg.wkt_edges(ad.regions(spark, sf).filter("rid % 3 <> 1"), "rid")
    cells = ad.cells(spark, sf)
    return rg.mask_by_regions(cells, rg.cells_in_regions(cells, kept, "rid")).select("cell_id", "x", "y")


@query("join_regions_cells", sql("v_inside v_regions", """
  select r.name, count(*) as n_cells, avg(c.elevation) as elevation from v_inside i
  join v_cells c on c.cell_id = i.cell_id join v_regions r on r.rid = i.rid group by r.name""", "name", "n_cells", "elevation"))
def join_regions_cells(spark, sf):
    cells = ad.cells(spark, sf).select("cell_id", "elevation")
    named = members(spark, sf).join(ad.regions(spark, sf).select("rid", "name"), "rid")
    return named.join(cells, "cell_id").groupBy("name").agg(F.count(F.lit(1)).alias("n_cells"), F.avg("elevation").alias("elevation"))


# Tiles of a height raster from order lines: row and column are keys, tiles overlap.
_TILES = """select l_linenumber as tile, (l_orderkey % 211) as "row", (l_partkey % 193) as col,
  max(case when l_suppkey % 9 <> 0 then l_quantity * 10e0 end) as value from lineitem
  group by l_linenumber, l_orderkey % 211, l_partkey % 193"""
_MOSAIC = "select \"row\", col, arg_min(value, tile) as value from v_tiles where value is not null group by \"row\", col"


def tile_rows(spark, sf):
    return ad.table(spark, sf, "lineitem").groupBy(
        F.col("l_linenumber").alias("tile"), (F.col("l_orderkey") % 211).alias("row"), (F.col("l_partkey") % 193).alias("col")
    ).agg(F.max(F.when(F.col("l_suppkey") % 9 != 0, F.col("l_quantity") * 10.0)).alias("value"))


def height_raster(spark, sf):
    return grid.mosaic_rows(tile_rows(spark, sf))


@query("raster_mosaic", sql("", _MOSAIC, "", "row col", "value", more={"v_tiles": _TILES}))
def raster_mosaic(spark, sf):
    return height_raster(spark, sf)


@query("raster_aggregate_median", sql("", """
  select floor("row" / 20) as r, floor(col / 20) as c, median(value) as value from v_mosaic group by 1, 2""",
    "", "r c", "value", more={"v_tiles": _TILES, "v_mosaic": _MOSAIC}))
def raster_aggregate_median(spark, sf):
    return grid.block_median(height_raster(spark, sf), 20).select(F.col("row").alias("r"), F.col("col").alias("c"), "value")


@query("raster_to_points", sql("", """
  select "row" as r, col as c, value, 1000e0 + (col + 5e-1) * 25e0 as x, 9000e0 - ("row" + 5e-1) * 25e0 as y from v_mosaic where value is not null""",
    "", "r c", "value x y", more={"v_tiles": _TILES, "v_mosaic": _MOSAIC}))
def raster_to_points(spark, sf):
    return grid.raster_to_points(height_raster(spark, sf), 1000.0, 9000.0, 25.0).select(
        F.col("row").alias("r"), F.col("col").alias("c"), "value", "x", "y")


_NEAR = {f"z{3 * (dr + 1) + dc + 1}": (dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1)}
_TERRAIN = """
  select cell_id, elevation, case when whole then degrees(atan(sqrt(gx * gx + gy * gy))) end as slope,
    case when whole then case when gx = 0 and gy = 0 then 90e0 else fmod(degrees(atan2(-gx, -gy)) + 360e0, 360e0) end end as aspect,
    case when whole then z4 - (z0 + z1 + z2 + z3 + z5 + z6 + z7 + z8) / 8e0 end as tpi
  from (select *, (z0 + z1 + z2 + z3 + z5 + z6 + z7 + z8) is not null as whole,
      (z2 + 2e0 * z5 + z8 - z0 - 2e0 * z3 - z6) / (8e0 * 100e0) as gx, (z0 + 2e0 * z1 + z2 - z6 - 2e0 * z7 - z8) / (8e0 * 100e0) as gy
    from (select a.cell_id, a.elevation, a.elevation as z4, """ + ", ".join(
    f"{z}.elevation as {z}" for z in _NEAR if z != "z4") + " from v_cells a " + " ".join(
    f"left join v_cells {z} on {z}.r = a.r + {dr} and {z}.c = a.c + {dc}" for z, (dr, dc) in _NEAR.items() if z != "z4") + "))"


@query("terrain", sql("v_cells", _TERRAIN, "", "cell_id", "elevation slope aspect TPI"))
def terrain(spark, sf):
    cells = ad.cells(spark, sf).select("cell_id", F.col("r").alias("row"), F.col("c").alias("col"), F.col("elevation").alias("value"))
    return grid.terrain(cells.drop("cell_id"), 100.0).join(cells.select("cell_id", "row", "col"), ["row", "col"]).select(
        "cell_id", "elevation", "slope", "aspect", "TPI")


_CELL = "floor((4600137e0 - y) / 5000e0) as r_, floor((x - 300137e0) / 5000e0) as c_"


@query("point_to_cell", sql("v_stations", f"""
  select sid, r_ * 100 + c_ + 1 as cell from (select sid, {_CELL} from v_stations) where r_ between 0 and 99 and c_ between 0 and 99
  union all select sid, null from (select sid, {_CELL} from v_stations) where not (r_ between 0 and 99 and c_ between 0 and 99)""",
    "", "sid cell"))
def point_to_cell(spark, sf):
    return ra.point_to_cell(ad.stations(spark, sf), MAP).select("sid", "cell")


_LAYERS = {"v_layers": "select dates, r_, c_, var, value from (select dates, r_, c_, " + ", ".join(
    f'arg_max_null({v}, cell_id) as "{v}"' for v in MAP_VARIABLES) + f""" from (select *, {_CELL} from v_icells)
  where r_ between 0 and 99 and c_ between 0 and 99 group by dates, r_, c_) unpivot include nulls (value for var in (""" + ", ".join(
    f'"{v}"' for v in MAP_VARIABLES) + "))",
    "v_blocks": """select dates, var, floor(r_ / 4) as r_, floor(c_ / 4) as c_, avg(value) as value
      from v_layers group by dates, var, floor(r_ / 4), floor(c_ / 4)"""}


def layers(spark, sf):
    return ra.rasterize(ad.interpolated_cells(spark, sf), MAP)


def blocks(spark, sf):
    return ra.rasterize_blocks(ad.interpolated_cells(spark, sf), MAP, BITMAP_BLOCK)


@query("rasterize_layers", sql("v_icells", "select *, r_ as \"row\", c_ as col from v_layers", "dates var", "r_ c_", "value", more=_LAYERS))
def rasterize_layers(spark, sf):
    return layers(spark, sf).withColumnsRenamed({"row": "r_", "col": "c_"})


@query("raster_aggregate_mean", sql("v_icells", "select * from v_blocks", "dates var", "r_ c_", "value", more=_LAYERS))
def raster_aggregate_mean(spark, sf):
    return blocks(spark, sf).withColumnsRenamed({"row": "r_", "col": "c_"})


_TARGET = """select cast(floor(i / 32) as bigint) as tr, i % 32 as tc, -5.6e0 + (i % 32 + 5e-1) * 2e-1 as lon,
  41.7e0 - (floor(i / 32) + 5e-1) * 2e-1 as lat from range(24 * 32) t(i)"""
_LONLAT = _LAYERS | {
    "v_target": _TARGET,
    "v_uv": "select tr, tc, (px - 300137e0) / 20000e0 - 5e-1 as u, (4600137e0 - py) / 20000e0 - 5e-1 as v from ("
            + to_xy_sql("v_target", "tr tc lon lat") + ")",
    "v_weights": """select tr, tc, r_, c_, greatest(1e0 - abs(v - r_), 0e0) * greatest(1e0 - abs(u - c_), 0e0) as w from v_uv
      join (select cast(a.i as bigint) as r_, cast(b.i as bigint) as c_ from range(25) a(i) cross join range(25) b(i)) g
      on abs(v - r_) < 1e0 and abs(u - c_) < 1e0""",
    "v_maps": """select dates, var, tr, tc, round(1000e0 * value, 0) as value from (
      select b.dates, b.var, w.tr, w.tc, sum(w.w * b.value) / sum(w.w) as value from v_blocks b
      join v_weights w on w.r_ = b.r_ and w.c_ = b.c_ where b.value is not null and w.w > 0 group by b.dates, b.var, w.tr, w.tc)""",
}


def maps_table(spark, sf):
    """The same as a written table, for steps that read it several times."""
    return spark.read.parquet(stored(spark, sf, "maps", lambda path: tables.materialize(maps(spark, sf), path)))


def maps(spark, sf):
    """Layers as drawn: coarser, in degrees, scaled and rounded."""
    weights = ra.projection_weights(spark, MAP.coarser(BITMAP_BLOCK), MAP_LONLAT)
    projected = ra.reproject(blocks(spark, sf), weights)
    # Scaling sees values cut to nine decimals, so that the order of summation cannot move a tie.
    return projected.withColumn("value", ra.scale_round(F.round("value", 9)))


@query("raster_reproject", sql("v_icells", """
  select dates, var, count(*) as n, avg(value) as value, min(value) as lo, max(value) as hi from v_maps group by dates, var""".replace(
    "v_maps", "(select b.dates, b.var, w.tr, w.tc, sum(w.w * b.value) / sum(w.w) as value from v_blocks b join v_weights w on w.r_ = b.r_ and w.c_ = b.c_ where b.value is not null and w.w > 0 group by b.dates, b.var, w.tr, w.tc)"),
    "dates var", "n", "value lo hi", more=_LONLAT))
def raster_reproject(spark, sf):
    weights = ra.projection_weights(spark, MAP.coarser(BITMAP_BLOCK), MAP_LONLAT)
    return ra.reproject(blocks(spark, sf), weights).groupBy("dates", "var").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("value"), F.min("value").alias("lo"), F.max("value").alias("hi"))


def _lab() -> list[list[float]]:
    """The ramp's colours in L*a*b*, worked out apart from the operator's own way."""
    rgb = np.array([[int(c[k:k + 2], 16) for k in (1, 3, 5)] for c in BITMAP_RAMP]) / 255
    linear = np.where(rgb <= 0.04045, rgb / 12.92, ((rgb + 0.055) / 1.055) ** 2.4)
    xyz = linear @ np.array(color.TO_XYZ).T / np.array(color.WHITE)
    f = np.where(xyz > (6 / 29) ** 3, np.cbrt(xyz), xyz * (29 / 6) ** 2 / 3 + 4 / 29)
    return [(116 * f[:, 1] - 16).tolist(), (500 * (f[:, 0] - f[:, 1])).tolist(), (200 * (f[:, 1] - f[:, 2])).tolist()]


def _blend(values: list[float]) -> str:
    levels = "[" + ", ".join(f"{v!r}e0" if "e" not in repr(v) else repr(v) for v in values) + "]"
    return f"({levels}[seg + 1] + ({levels}[seg + 2] - {levels}[seg + 1]) * part)"


def _cubed(f: str, white: float) -> str:
    return f"(case when {f} > 6e0 / 29e0 then power({f}, 3) else ({f} - 4e0 / 29e0) * 3e0 * power(6e0 / 29e0, 2) end) * {white}e0"


def _level(row: tuple[float, float, float]) -> str:
    c = f"greatest(0e0, {row[0]}e0 * cx + {row[1]}e0 * cy + {row[2]}e0 * cz)"
    shown = f"case when {c} <= 0.0031308e0 then 12.92e0 * {c} else 1.055e0 * power({c}, 1e0 / 2.4e0) - 0.055e0 end"
    return f"printf('%02X', cast(floor(least(1e0, {shown}) * 255e0 + 5e-1) as bigint))"


_L, _A, _B = _lab()


@query("color_ramp", sql("v_icells", f"""
  select dates, var, color, count(*) as n from (
    select dates, var, '#' || {" || ".join(_level(row) for row in color.TO_RGB)} || 'FF' as color from (
      select *, {_cubed("(fy + ca / 500e0)", color.WHITE[0])} as cx, {_cubed("fy", color.WHITE[1])} as cy, {_cubed("(fy - cb / 200e0)", color.WHITE[2])} as cz from (
        select *, ({_blend(_L)} + 16e0) / 116e0 as fy, {_blend(_A)} as ca, {_blend(_B)} as cb from (
          select *, t * 8e0 - seg as part from (
            select *, cast(least(floor(t * 8e0), 7) as int) as seg from (
              select dates, var, case when var in ('MeanRelativeHumidity', 'MinRelativeHumidity', 'MaxRelativeHumidity', 'Precipitation', 'PET')
                then f else 1e0 - f end as t from (
                select dates, var, case when max(value) over w > min(value) over w
                  then (value - min(value) over w) / (max(value) over w - min(value) over w) else 5e-1 end as f
                from v_maps window w as (partition by dates, var))))))))
  group by dates, var, color""", "dates var color", "n", more=_LONLAT))
def color_ramp(spark, sf):
    return ra.colorize(maps_table(spark, sf)).groupBy("dates", "var", "color").agg(F.count(F.lit(1)).alias("n"))


@query("layer_min_max", sql("v_icells", "select dates, var, min(value) as lo, max(value) as hi from v_layers group by dates, var",
    "dates var", "", "lo hi", more=_LAYERS))
def layer_min_max(spark, sf):
    return ra.layer_ranges(layers(spark, sf))


@query("bitmap_rows", sql("v_icells", """
  select strftime(dates, '%Y%m%d') as date, var, 'ag_GrnYl' as palette_selected, -5.6e0 as left_ext, 41.7e0 - 24 * 2e-1 as down_ext,
    -5.6e0 + 32 * 2e-1 as right_ext, 41.7e0 as up_ext, min(value) / 1000e0 as min_value, max(value) / 1000e0 as max_value
  from v_maps group by dates, var""", "date var palette_selected", "", "left_ext down_ext right_ext up_ext min_value max_value", more=_LONLAT))
def bitmap_rows(spark, sf):
    return bm.bitmap_rows(maps(spark, sf), MAP_LONLAT)


def published_bitmaps(spark, sf):
    drawn = maps_table(spark, sf)
    return bm.bitmaps(ra.colorize(drawn), drawn, MAP_LONLAT)


@query("bitmap_images")
def bitmap_images(spark, sf):
    return published_bitmaps(spark, sf)


@query("write_bitmaps", sql("v_icells", """
  select strftime(dates, '%Y%m%d') as date, count(*) as n, max(most) as max_value from (
    select dates, var, max(value) / 1000e0 as most from v_maps group by dates, var) group by dates""", "date", "n", "max_value", more=_LONLAT))
def write_bitmaps(spark, sf):
    path = stored(spark, sf, "bitmaps", lambda path: tables.write_bitmaps(published_bitmaps(spark, sf), path))
    return tables.scan_bitmaps(spark, path).groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.max("max_value").alias("max_value"))


@query("scan_bitmaps_by_date", sql("v_icells", """
  select strftime(dates, '%Y%m%d') as date, var, 'ag_GrnYl' as palette_selected, -5.6e0 as left_ext, 41.7e0 - 24 * 2e-1 as down_ext,
    -5.6e0 + 32 * 2e-1 as right_ext, 41.7e0 as up_ext, min(value) / 1000e0 as min_value, max(value) / 1000e0 as max_value, true as is_image
  from v_maps where strftime(dates, '%Y%m%d') = '20000501' group by dates, var""", "date var palette_selected", "",
    "left_ext down_ext right_ext up_ext min_value max_value", "is_image", more=_LONLAT))
def scan_bitmaps_by_date(spark, sf):
    # The images themselves are the result of bitmap_images, and are read back by a test.
    path = stored(spark, sf, "bitmaps", lambda path: tables.write_bitmaps(published_bitmaps(spark, sf), path))
    return tables.scan_bitmaps(spark, path, "20000501").select(
        "date", "var", "palette_selected", "left_ext", "down_ext", "right_ext", "up_ext", "min_value", "max_value",
        F.col("base64_string").startswith("data:image/png;base64,").alias("is_image"))


@query("polygon_area_topk", sql("v_centres", """
  select rid, 0 as part, case when rid % 5 = 0 then 8800e0 else 9200e0 end as area_km from v_centres
  order by rid % 5 <> 0 desc, rid limit 12""", "", "rid part", "area_km"))
def polygon_area_topk(spark, sf):
    return rg.area_top(edges(spark, sf), "rid", 10.0, 12)


@query("partition_stats", sql("v_boxes", """
  select i_step as partition, topo_ncells as topo_nrow, (xmax - xmin) * (ymax - ymin) as bbox_area, xmin, xmax, ymin, ymax from v_boxes""",
    "", "partition topo_nrow", "bbox_area xmin xmax ymin ymax"))
def partition_stats(spark, sf):
    return grid.partition_stats(ad.topo(spark, sf))


def _geohash_sql(p):
    bits = 5 * p
    lb, tb = (bits + 1) // 2, bits // 2
    out = []
    for c in range(p):
        digits = []
        for b in range(5):
            k = 5 * c + b
            # The bit is the parity of the half-range the coordinate falls in at that depth.
            v = f"floor((lon + 180e0) / 360e0 * {2 ** (k // 2 + 1)}e0) % 2" if k % 2 == 0 else f"floor((lat + 90e0) / 180e0 * {2 ** (k // 2 + 1)}e0) % 2"
            digits.append(f"{2 ** (4 - b)} * ({v})")
        out.append(f"substr('0123456789bcdefghjkmnpqrstuvwxyz', cast({' + '.join(digits)} + 1 as int), 1)")
    return " || ".join(out)


@query("geohash", sql("v_topo", "select cell_id, " + ", ".join(f"{_geohash_sql(p)} as g{p}" for p in range(2, 7)) + " from v_ll",
    "g2 g3 g4 g5 g6", "cell_id", more=LONLAT_STEP))
def geohash(spark, sf):
    lon, lat = geo.xy_to_lonlat(F.col("x"), F.col("y"))
    cells = ad.topo(spark, sf).select("cell_id", lon.alias("lon"), lat.alias("lat"))
    return cells.select("cell_id", *[geo.geohash(F.col("lon"), F.col("lat"), p).alias(f"g{p}") for p in range(2, 7)])


@query("point_envelope", sql("v_stations", """
  select sid, x - 141.43e0 as xmin, x + 141.43e0 as xmax, y - 141.43e0 as ymin, y + 141.43e0 as ymax from v_stations""",
    "", "sid", "xmin xmax ymin ymax"))
def point_envelope(spark, sf):
    return boxes.envelopes(ad.stations(spark, sf), 141.43).select("sid", "xmin", "xmax", "ymin", "ymax")


_BOX_NUMS = "elevation " + CELL_NUMS
_BOX_AVG = ", ".join(f"avg({c}) as {c}" for c in _BOX_NUMS.split())
_TEXT = "printf('POINT (%.1f %.1f)', round(x, 0), round(y, 0))"


def texted_cells(spark, sf):
    # Coordinates in the text are rounded first: the two engines format ties differently.
    return ad.interpolated_cells(spark, sf).withColumn("geom_text", geo.point_wkt(F.round("x", 0), F.round("y", 0)))


@query("bbox_query", sql("v_icells", f"""
  select dates, {_BOX_AVG}, min({_TEXT}) as geom_text from v_icells
  where x > 400000 and x < 640000 and y > 4200000 and y < 4500000 group by dates""", "dates geom_text", "", _BOX_NUMS))
def bbox_query(spark, sf):
    return boxes.box_query(texted_cells(spark, sf), 400000.0, 640000.0, 4200000.0, 4500000.0)


_BOXES = {"v_box": "select sid as box_id, x - 12000e0 as xmin, x + 12000e0 as xmax, y - 12000e0 as ymin, y + 12000e0 as ymax from v_stations"}


def box_table(spark, sf):
    return boxes.envelopes(ad.stations(spark, sf).withColumnRenamed("sid", "box_id"), 12000.0)


@query("multi_bbox_query", sql("v_icells v_stations", f"""
  select b.box_id, c.dates, {_BOX_AVG}, min({_TEXT}) as geom_text from v_box b
  join v_icells c on c.x > b.xmin and c.x < b.xmax and c.y > b.ymin and c.y < b.ymax group by b.box_id, c.dates""",
    "dates geom_text", "box_id", _BOX_NUMS, more=_BOXES))
def multi_bbox_query(spark, sf):
    return boxes.each_box(texted_cells(spark, sf), box_table(spark, sf), 24000.0)


@query("multi_bbox_query_or", sql("v_icells v_stations", f"""
  select dates, {_BOX_AVG}, min({_TEXT}) as geom_text from v_icells c
  where exists (select 1 from v_box b where c.x > b.xmin and c.x < b.xmax and c.y > b.ymin and c.y < b.ymax) group by dates""",
    "dates geom_text", "", _BOX_NUMS, more=_BOXES))
def multi_bbox_query_or(spark, sf):
    return boxes.any_box(texted_cells(spark, sf), box_table(spark, sf), 24000.0)


@query("join_points_grid", sql("v_topo0", "select cell_id, raw_partition as partition from v_topo0", "", "cell_id partition"))
def join_points_grid(spark, sf):
    return ad.cells(spark, sf).select("cell_id", grid.partition_id(F.col("x"), F.col("y"), EXTENT).alias("partition"))
