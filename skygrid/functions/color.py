"""Colours in CIE L*a*b* (D65), the space in which a ramp looks even."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Fixed values of the sRGB and CIE L*a*b* standards: white point D65, linear sRGB to XYZ and back.
WHITE = (0.95047, 1.0, 1.08883)
TO_XYZ = ((0.4124564, 0.3575761, 0.1804375), (0.2126729, 0.7151522, 0.0721750), (0.0193339, 0.1191920, 0.9503041))
TO_RGB = ((3.2404542, -1.5371385, -0.4985314), (-0.9692660, 1.8760108, 0.0415560), (0.0556434, -0.2040259, 1.0572252))
EDGE = 6.0 / 29.0


def lab_of(hex_color: str) -> tuple[float, float, float]:
    """L, a, b of ``#RRGGBB``."""
    levels = [int(hex_color[k:k + 2], 16) / 255.0 for k in (1, 3, 5)]
    linear = [c / 12.92 if c <= 0.04045 else ((c + 0.055) / 1.055) ** 2.4 for c in levels]
    xyz = [sum(m * c for m, c in zip(row, linear)) / w for row, w in zip(TO_XYZ, WHITE)]
    x, y, z = (v ** (1.0 / 3.0) if v > EDGE**3 else v / (3.0 * EDGE**2) + 4.0 / 29.0 for v in xyz)
    return 116.0 * y - 16.0, 500.0 * (x - y), 200.0 * (y - z)


def with_hex(df: DataFrame, lab: tuple[str, str, str], name: str) -> DataFrame:
    """``RRGGBB`` of the colours in three columns; what sRGB cannot show is cut to its range.

    Step by step, in columns of their own: as one expression every step would be repeated wherever it is used.
    """
    l, a, b = map(F.col, lab)  # noqa: E741
    df = df.withColumn("_fy", (l + 16.0) / 116.0).withColumns({"_fx": F.col("_fy") + a / 500.0, "_fz": F.col("_fy") - b / 200.0})
    cubed = {
        f"_{axis}": F.when(F.col(f"_f{axis}") > EDGE, F.pow(F.col(f"_f{axis}"), 3.0)).otherwise((F.col(f"_f{axis}") - 4.0 / 29.0) * (3.0 * EDGE**2)) * w
        for axis, w in zip("xyz", WHITE)}
    df = df.withColumns(cubed).withColumns({
        f"_{c}": F.greatest(F.lit(0.0), F.col("_x") * row[0] + F.col("_y") * row[1] + F.col("_z") * row[2]) for c, row in zip("rgb", TO_RGB)})
    shown = [F.when(F.col(f"_{c}") <= 0.0031308, F.col(f"_{c}") * 12.92).otherwise(F.pow(F.col(f"_{c}"), 1.0 / 2.4) * 1.055 - 0.055) for c in "rgb"]
    levels = [F.lpad(F.hex(F.floor(F.least(F.lit(1.0), v) * 255.0 + 0.5).cast("bigint")), 2, "0") for v in shown]
    return df.withColumn(name, F.concat(*levels)).drop("_fx", "_fy", "_fz", "_x", "_y", "_z", "_r", "_g", "_b")
