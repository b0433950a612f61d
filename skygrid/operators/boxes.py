"""Box queries over interpolated cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skygrid.functions import columns

BOX_PATTERNS = ("elevation", "Temperature", "Prec", "Humidity", "Radiation", "Wind", "PET", "Thermal")


def _day_means(df: DataFrame, keys: list[str]) -> DataFrame:
    # The least text instead of the first keeps the result the same on every run.
    return df.groupBy(*keys).agg(
        *columns.means(columns.matching(df, *BOX_PATTERNS)), F.min("geom_text").alias("geom_text"))


def box_query(cells: DataFrame, xmin: float, xmax: float, ymin: float, ymax: float) -> DataFrame:
    """Daily means in an open box. The bounds are literals, so they reach the Parquet scan."""
    inside = cells.filter(
        (F.col("x") > xmin) & (F.col("x") < xmax) & (F.col("y") > ymin) & (F.col("y") < ymax))
    return _day_means(inside, ["dates"])


def envelopes(points: DataFrame, radius: float) -> DataFrame:
    """Square envelope of each point's circle."""
    x, y = F.col("x"), F.col("y")
    return points.withColumns({"xmin": x - radius, "xmax": x + radius, "ymin": y - radius, "ymax": y + radius})


def cells_in_boxes(cells: DataFrame, boxes: DataFrame, tile: float) -> DataFrame:
    """Pairs of cell-day and box, met on square tiles; ``tile`` is about the width of a box."""
    def t(c):
        return F.floor(c / tile).cast("bigint")

    spread = boxes.withColumn("tx", F.explode(F.sequence(t(F.col("xmin")), t(F.col("xmax"))))).withColumn(
        "ty", F.explode(F.sequence(t(F.col("ymin")), t(F.col("ymax")))))
    placed = cells.withColumns({"tx": t(F.col("x")), "ty": t(F.col("y"))})
    x, y = F.col("x"), F.col("y")
    return placed.join(spread.select("box_id", "xmin", "xmax", "ymin", "ymax", "tx", "ty"), ["tx", "ty"]).filter(
        (x > F.col("xmin")) & (x < F.col("xmax")) & (y > F.col("ymin")) & (y < F.col("ymax"))
    ).drop("tx", "ty", "xmin", "xmax", "ymin", "ymax")


def each_box(cells: DataFrame, boxes: DataFrame, tile: float) -> DataFrame:
    """Daily means of each box."""
    return _day_means(cells_in_boxes(cells, boxes, tile), ["box_id", "dates"])


def any_box(cells: DataFrame, boxes: DataFrame, tile: float) -> DataFrame:
    """Daily means over the cells in at least one box, each cell counted once."""
    ids = cells_in_boxes(cells.select("cell_id", "x", "y").distinct(), boxes, tile).select("cell_id").distinct()
    return _day_means(cells.join(ids, "cell_id", "left_semi"), ["dates"])
