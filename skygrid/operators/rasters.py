"""Map layers as tables of (date, var, row, col, value)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skygrid.functions import color, geo
from skygrid.params import BITMAP_RAMP, BITMAP_SCALE, BITMAP_UNREVERSED, BITMAP_MISSING
from skygrid.schema import MAP_VARIABLES, NOT_LAYERS


@dataclass(frozen=True)
class Raster:
    """Square cells in grid metres or in degrees; row 0 is the northern one."""

    xmin: float
    ymax: float
    resolution: float
    nrow: int
    ncol: int

    @property
    def extent(self) -> tuple[float, float, float, float]:
        """Left, down, right, up."""
        return (
            self.xmin, self.ymax - self.nrow * self.resolution, self.xmin + self.ncol * self.resolution, self.ymax)

    def row(self, y: Column) -> Column:
        return F.floor((self.ymax - y) / self.resolution).cast("bigint")

    def col(self, x: Column) -> Column:
        return F.floor((x - self.xmin) / self.resolution).cast("bigint")

    def holds(self, row: Column, col: Column) -> Column:
        return row.between(0, self.nrow - 1) & col.between(0, self.ncol - 1)

    def coarser(self, factor: int) -> Raster:
        return Raster(
            self.xmin, self.ymax, self.resolution * factor, -(-self.nrow // factor), -(-self.ncol // factor))


def point_to_cell(points: DataFrame, raster: Raster) -> DataFrame:
    """Row, column and cell number (row by row from 1); points outside get no cell."""
    placed = points.withColumns({"row": raster.row(F.col("y")), "col": raster.col(F.col("x"))})
    inside = raster.holds(F.col("row"), F.col("col"))
    return placed.withColumn("cell", F.when(inside, F.col("row") * raster.ncol + F.col("col") + 1))


def layers_of(cells: DataFrame) -> list[str]:
    """The variables drawn: every column that is not identity, terrain or wind direction."""
    return [c for c in cells.columns if c not in NOT_LAYERS]


def rasterize(cells: DataFrame, raster: Raster, variables=MAP_VARIABLES, order: str = "cell_id") -> DataFrame:
    """One row per date, raster cell and variable; of points in one cell the last by ``order`` holds.

    Variables stay columns until each cell is settled, so the shuffle carries one row per cell-day.
    """
    return _settled(cells, raster, variables, order, 1).drop("brow", "bcol").unpivot(["dates", "row", "col"], list(variables), "var", "value")


def rasterize_blocks(cells: DataFrame, raster: Raster, factor: int, variables=MAP_VARIABLES, order: str = "cell_id") -> DataFrame:
    """``block_mean`` of ``rasterize``: points move once, to the task of their block, and variables stay columns until it has its means."""
    settled = _settled(cells, raster, variables, order, factor)
    means = settled.groupBy("dates", "brow", "bcol").agg(*[F.avg(v).alias(v) for v in variables])
    long = means.withColumnsRenamed({"brow": "row", "bcol": "col"}).unpivot(["dates", "row", "col"], list(variables), "var", "value")
    return long.select("dates", "var", "row", "col", "value")


def _block(c: str, factor: int) -> Column:
    return F.floor(F.col(c) / factor).cast("bigint")


def _settled(cells: DataFrame, raster: Raster, variables, order: str, factor: int) -> DataFrame:
    """One row per date and raster cell, in the task of its block of ``factor`` by ``factor`` cells (``brow, bcol``).

    Variables are picked one by one, which picks the same point for all: numbers keep the aggregate on the hash path, a struct would have
    every cell-day sorted.
    """
    points = point_to_cell(cells, raster).filter(F.col("cell").isNotNull()).select(
        "dates", "row", "col", _block("row", factor).alias("brow"), _block("col", factor).alias("bcol"), F.col(order).alias("_order"), *variables)
    home = ["dates", "brow", "bcol"]
    return points.repartition(*home).groupBy(*home, "row", "col").agg(*[F.max_by(v, "_order").alias(v) for v in variables])


def block_mean(layers: DataFrame, factor: int) -> DataFrame:
    """Mean of each block of cells, missing cells left out."""
    return layers.groupBy(
        "dates", "var", _block("row", factor).alias("row"), _block("col", factor).alias("col")).agg(F.avg("value").alias("value"))


def projection_weights(spark: SparkSession, source: Raster, target: Raster) -> DataFrame:
    """Bilinear weights of the four source cells around each target centre; one table per raster pair.

    Its size is four rows per target cell, whatever the number of dates.
    """
    cells = spark.range(target.nrow * target.ncol).select(
        F.floor(F.col("id") / target.ncol).cast("bigint").alias("trow"), (F.col("id") % target.ncol).alias("tcol"))
    lon = target.xmin + (F.col("tcol") + 0.5) * target.resolution
    lat = target.ymax - (F.col("trow") + 0.5) * target.resolution
    x, y = geo.lonlat_to_xy(lon, lat)
    at = cells.select(
        "trow", "tcol", ((x - source.xmin) / source.resolution - 0.5).alias("u"),
        ((source.ymax - y) / source.resolution - 0.5).alias("v"))
    at = at.withColumns({"c0": F.floor("u").cast("bigint"), "r0": F.floor("v").cast("bigint")})
    fu, fv = F.col("u") - F.col("c0"), F.col("v") - F.col("r0")
    def corner(dr: int, dc: int) -> Column:
        w = (fv if dr else 1.0 - fv) * (fu if dc else 1.0 - fu)
        return F.struct((F.col("r0") + dr).alias("row"), (F.col("c0") + dc).alias("col"), w.alias("w"))

    near = at.select("trow", "tcol", F.inline(F.array(*[corner(dr, dc) for dr in (0, 1) for dc in (0, 1)])))
    return near.filter((F.col("w") > 0) & source.holds(F.col("row"), F.col("col")))


def reproject(layers: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted mean over the source cells that hold a value."""
    present = layers.filter(F.col("value").isNotNull())
    return present.join(weights, ["row", "col"]).groupBy("dates", "var", "trow", "tcol").agg(
        (F.sum(F.col("w") * F.col("value")) / F.sum("w")).alias("value")
    ).select("dates", "var", F.col("trow").alias("row"), F.col("tcol").alias("col"), "value")


def scale_round(value: Column | str, scale: int = BITMAP_SCALE) -> Column:
    """Colours are worked out on whole numbers."""
    return F.round((F.col(value) if isinstance(value, str) else value) * float(scale), 0)


def layer_ranges(layers: DataFrame) -> DataFrame:
    return layers.groupBy("dates", "var").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))


def colorize(layers: DataFrame) -> DataFrame:
    """Layers with the colour of each cell, ``#RRGGBBAA``, linear in L*a*b* between the colours of the ramp over the layer's range.

    The ramp is reversed but for five variables; missing values are transparent, and a layer without
    range takes the middle colour.
    """
    last = len(BITMAP_RAMP) - 1
    value, lo, hi = F.col("value"), F.col("lo"), F.col("hi")
    t = F.when(hi > lo, (value - lo) / (hi - lo)).otherwise(0.5)
    ranged = layers.join(layer_ranges(layers), ["dates", "var"])
    placed = ranged.withColumn("_t", F.when(F.col("var").isin(*BITMAP_UNREVERSED), t).otherwise(1.0 - t) * float(last))
    placed = placed.withColumn("_k", F.least(F.floor("_t").cast("int"), F.lit(last - 1))).withColumn("_part", F.col("_t") - F.col("_k"))
    anchors = dict(zip(("_l", "_a", "_b"), zip(*[color.lab_of(c) for c in BITMAP_RAMP])))

    def between(levels: tuple[float, ...]) -> Column:
        known = F.array(*[F.lit(v) for v in levels])
        low = F.element_at(known, F.col("_k") + 1)
        return low + (F.element_at(known, F.col("_k") + 2) - low) * F.col("_part")

    named = color.with_hex(placed.withColumns({c: between(levels) for c, levels in anchors.items()}), ("_l", "_a", "_b"), "_hex")
    shown = F.when(value.isNull(), BITMAP_MISSING).otherwise(F.concat(F.lit("#"), "_hex", F.lit("FF")))
    return named.withColumn("color", shown).drop("lo", "hi", "_t", "_k", "_part", "_l", "_a", "_b", "_hex")
