"""The terrain grid: tiles to cells, terrain, spatial partitions."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from skygrid.params import PARTITION_COLS, PARTITION_MERGES, PARTITION_ROWS
from skygrid.sources import folders, tables


def partition_id(
    x: Column, y: Column, extent: tuple[float, float, float, float],
    rows: int = PARTITION_ROWS, cols: int = PARTITION_COLS,
) -> Column:
    """Number of the partition a point lies in, row by row from the upper left, from 1.

    Half-open cells give one partition per point without a join; points on the far edges stay inside.
    """
    xmin, xmax, ymin, ymax = extent
    row = F.least(F.floor((ymax - y) / ((ymax - ymin) / rows)), F.lit(rows - 1))
    col = F.least(F.floor((x - xmin) / ((xmax - xmin) / cols)), F.lit(cols - 1))
    return (row * cols + col + 1).cast("int")


def merged_partition(partition: Column) -> Column:
    """The partition a small one is merged into; others are unchanged. No target is merged itself."""
    lookup = F.create_map(*[F.lit(v) for v in chain.from_iterable(PARTITION_MERGES.items())])
    return F.coalesce(lookup[partition], partition)


def merge_partitions(topo: DataFrame) -> DataFrame:
    return topo.withColumn("partition", merged_partition(F.col("partition")))


def dedupe_lowest_partition(points: DataFrame) -> DataFrame:
    """Rows equal but for the partition, once, with the lowest partition."""
    others = [c for c in points.columns if c != "partition"]
    return points.groupBy(*others).agg(F.min("partition").alias("partition"))


def mosaic(tiles: list[DataFrame]) -> DataFrame:
    """Tiles as one raster; where tiles overlap the first holds. Tiles have row, col, value."""
    numbered = [t.select("row", "col", "value", F.lit(i).alias("tile")) for i, t in enumerate(tiles)]
    rows = reduce(DataFrame.unionByName, numbered).filter(F.col("value").isNotNull())
    return rows.groupBy("row", "col").agg(F.min_by("value", "tile").alias("value"))


def mosaic_rows(tiles: DataFrame) -> DataFrame:
    """The same for a table of all tiles with a tile number."""
    return tiles.filter(F.col("value").isNotNull()).groupBy("row", "col").agg(F.min_by("value", "tile").alias("value"))


def block_median(raster: DataFrame, factor: int) -> DataFrame:
    """Median of each block of ``factor`` by ``factor`` cells, missing cells left out."""
    block = [F.floor(F.col(c) / factor).cast("bigint").alias(c) for c in ("row", "col")]
    return raster.groupBy(*block).agg(F.median("value").alias("value"))


def terrain(raster: DataFrame, resolution: float) -> DataFrame:
    """Slope and aspect in degrees (Horn 1981) and TPI from the 3 x 3 neighbourhood.

    Each cell is sent to its nine targets, so one shuffle on the target gathers the neighbourhood.
    Where a neighbour is missing the results are NULL. Row numbers grow to the south.
    """
    offsets = [(dr, dc) for dr in (-1, 0, 1) for dc in (-1, 0, 1)]
    sent = raster.select(
        "row", "col", "value",
        F.explode(F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in offsets])).alias("o"),
    ).select(
        (F.col("row") - F.col("o.dr")).alias("row"), (F.col("col") - F.col("o.dc")).alias("col"), "value",
        ((F.col("o.dr") + 1) * 3 + F.col("o.dc") + 1).alias("k"),
    )
    near = sent.groupBy("row", "col").agg(
        *[F.max(F.when(F.col("k") == k, F.col("value"))).alias(f"z{k}") for k in range(9)]
    ).filter(F.col("z4").isNotNull())
    z = [F.col(f"z{k}") for k in range(9)]
    # East and north gradients; z0..z2 is the northern row.
    gx = (z[2] + 2.0 * z[5] + z[8] - z[0] - 2.0 * z[3] - z[6]) / (8.0 * resolution)
    gy = (z[0] + 2.0 * z[1] + z[2] - z[6] - 2.0 * z[7] - z[8]) / (8.0 * resolution)
    whole = reduce(lambda a, b: a & b, [c.isNotNull() for c in z])
    # The aspect is the compass direction of the downward slope; flat cells face 90 degrees.
    direction = F.pmod(F.degrees(F.atan2(-gx, -gy)) + 360.0, F.lit(360.0))
    aspect = F.when((gx == 0) & (gy == 0), F.lit(90.0)).otherwise(direction)
    around = reduce(lambda a, b: a + b, [z[k] for k in range(9) if k != 4])
    return near.select(
        "row", "col", F.col("z4").alias("elevation"),
        F.when(whole, F.degrees(F.atan(F.sqrt(gx * gx + gy * gy)))).alias("slope"),
        F.when(whole, aspect).alias("aspect"),
        F.when(whole, z[4] - around / 8.0).alias("TPI"),
    )


def raster_to_points(raster: DataFrame, xmin: float, ymax: float, resolution: float) -> DataFrame:
    """Cells that hold a value, as points at their centres."""
    return raster.filter(F.col("value").isNotNull()).withColumns({
        "x": xmin + (F.col("col") + 0.5) * resolution, "y": ymax - (F.col("row") + 0.5) * resolution,
    })


def partition_stats(topo: DataFrame) -> DataFrame:
    """Box, box area and cell count of each partition."""
    box = topo.groupBy("partition").agg(
        F.min("x").alias("xmin"), F.max("x").alias("xmax"), F.min("y").alias("ymin"), F.max("y").alias("ymax"),
        F.count(F.lit(1)).alias("topo_nrow"),
    )
    return box.withColumn("bbox_area", (F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))


def partition_boxes(topo: DataFrame) -> DataFrame:
    return partition_stats(topo).select(
        F.col("partition").alias("i_step"), "xmin", "xmax", "ymin", "ymax", F.col("topo_nrow").alias("topo_ncells"))


def _numbered(df: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """Rows with ``_row``, their place in the order from 1, and how many there are.

    Rows are dealt out by ranges of the whole order, so that no group of equal first columns is one task's work, and written: each row with its task
    and its place there. What comes before a task is known from the tasks' counts, one number each.
    """
    spark = df.sparkSession
    within = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"_task": F.spark_partition_id(), "_place": within})
    ranged = tables.materialize(ranged, folders.new_folder(spark, "ranges"))
    counts = sorted(tuple(r) for r in ranged.groupBy("_task").agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = [], 0
    for task, n in counts:
        before.append((task, total))
        total += n
    offsets = spark.createDataFrame(before, "_task int, _before long")
    return ranged.join(F.broadcast(offsets), "_task").withColumn("_row", F.col("_before") + F.col("_place") + 1).drop("_task", "_place", "_before"), total


def row_numbers(df: DataFrame, bucket: list[str], order: list[str], name: str) -> DataFrame:
    """The place of each row in the order of ``bucket`` then ``order``, from 1."""
    return _numbered(df, [*bucket, *order])[0].withColumnRenamed("_row", name)


def row_chunks(df: DataFrame, bucket: list[str], order: list[str], chunks: int) -> DataFrame:
    """Rows in order of ``bucket`` then ``order``, cut into equal chunks."""
    rows, total = _numbered(df, [*bucket, *order])
    size = max(1, -(-total // chunks))
    return rows.withColumn("chunk", F.ceil(F.col("_row") / size).cast("bigint")).drop("_row")
