"""Map images: one row per date and variable with a PNG as text.

An image is compressed in strips of rows, each a group of its own, and the strips are joined at the
end. A deflate stream may be cut at full flushes, and PNG allows any number of data chunks, so the
joined strips are one valid image and no task ever holds the pixels of a whole one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skygrid.functions import calendar as cal
from skygrid.operators.rasters import Raster
from skygrid.params import BITMAP_PALETTE_NAME, BITMAP_SCALE

STRIP_ROWS = 64
ADLER_MOD = 65521
STRIP_SCHEMA = "dates date, var string, strip int, chunk binary, a bigint, b bigint, len bigint"


def _strip_encoder(nrow: int, ncol: int, strip_rows: int):
    def encode(pdf):
        import struct
        import zlib

        import numpy as np
        import pandas as pd

        strip = int(pdf["strip"].iloc[0])
        first = strip * strip_rows
        rows = min(strip_rows, nrow - first)
        pixels = np.zeros((rows, ncol, 4), dtype=np.uint8)
        pixels[:, :, :3] = 255
        drawn = pdf[pdf["color"].notna()]
        if len(drawn):
            rgba = np.frombuffer(bytes.fromhex("".join(c[1:] for c in drawn["color"])), dtype=np.uint8).reshape(-1, 4)
            pixels[drawn["row"].to_numpy(dtype=int) - first, drawn["col"].to_numpy(dtype=int)] = rgba
        # Each scanline starts with filter type 0.
        data = np.concatenate([np.zeros((rows, 1), np.uint8), pixels.reshape(rows, -1)], axis=1).tobytes()
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        body = packer.compress(data) + packer.flush(zlib.Z_FULL_FLUSH)
        if strip == 0:
            body = b"\x78\x9c" + body
        chunk = struct.pack(">I", len(body)) + b"IDAT" + body + struct.pack(">I", zlib.crc32(b"IDAT" + body))
        adler = zlib.adler32(data)
        return pd.DataFrame({
            "dates": [pdf["dates"].iloc[0]], "var": [pdf["var"].iloc[0]], "strip": [strip], "chunk": [chunk],
            "a": [adler & 0xFFFF], "b": [adler >> 16], "len": [len(data)],
        })

    return encode


def _png_start(nrow: int, ncol: int) -> bytes:
    import struct
    import zlib

    header = b"IHDR" + struct.pack(">IIBBBBB", ncol, nrow, 8, 6, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + header + struct.pack(">I", zlib.crc32(header))


def bitmap_images(colored: DataFrame, raster: Raster, strip_rows: int = STRIP_ROWS) -> DataFrame:
    """PNG text of each date and variable from coloured layer cells."""
    nrow, ncol = raster.nrow, raster.ncol
    strips = -(-nrow // strip_rows)
    pixels = colored.select(
        "dates", "var", F.floor(F.col("row") / strip_rows).cast("int").alias("strip"), F.col("row").cast("int"),
        F.col("col").cast("int"), "color")
    # A row without colour per strip, so that empty strips are drawn too.
    marks = colored.select("dates", "var").distinct().select(
        "dates", "var", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))).alias("strip"),
        F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(None).cast("string").alias("color"))
    encoded = pixels.unionByName(marks).groupBy("dates", "var", "strip").applyInPandas(
        _strip_encoder(nrow, ncol, strip_rows), STRIP_SCHEMA)
    joined = encoded.groupBy("dates", "var").agg(
        F.array_sort(F.collect_list(F.struct("strip", "chunk", "a", "b", "len"))).alias("s"))
    adler = F.aggregate(
        "s", F.struct(F.lit(1).cast("bigint").alias("a"), F.lit(0).cast("bigint").alias("b")),
        lambda acc, s: F.struct(
            F.pmod(acc["a"] + s["a"] - 1, F.lit(ADLER_MOD)).alias("a"),
            F.pmod(acc["b"] + s["b"] + s["len"] * F.pmod(acc["a"] - 1, F.lit(ADLER_MOD)), F.lit(ADLER_MOD)).alias("b")))
    tail = F.unhex(F.concat(  # "IDAT", the empty last block, and the checksum of all pixels
        F.lit("494441540300"), F.lpad(F.hex(adler["b"]), 4, "0"), F.lpad(F.hex(adler["a"]), 4, "0")))
    crc = F.unhex(F.lpad(F.hex(F.crc32(tail)), 8, "0"))
    end = F.unhex(F.lit("0000000049454E44AE426082"))
    start = F.unhex(F.lit(_png_start(nrow, ncol).hex()))
    chunks = F.array_join(F.transform("s", lambda s: F.hex(s["chunk"])), "")
    png = F.concat(start, F.unhex(chunks), F.unhex(F.lit("00000006")), tail, crc, end)
    return joined.select(
        "dates", "var", F.concat(F.lit("data:image/png;base64,"), F.base64(png)).alias("base64_string"))


def bitmap_rows(layers: DataFrame, raster: Raster) -> DataFrame:
    """Extent, palette and value range of each date and variable; ``layers`` are scaled and rounded."""
    left, down, right, up = raster.extent
    return layers.groupBy("dates", "var").agg(
        (F.min("value") / float(BITMAP_SCALE)).alias("min_value"), (F.max("value") / float(BITMAP_SCALE)).alias("max_value")
    ).select(
        cal.compact(F.col("dates")).alias("date"), "var", F.lit(BITMAP_PALETTE_NAME).alias("palette_selected"),
        F.lit(left).alias("left_ext"), F.lit(down).alias("down_ext"), F.lit(right).alias("right_ext"),
        F.lit(up).alias("up_ext"), "min_value", "max_value")


def bitmaps(colored: DataFrame, layers: DataFrame, raster: Raster) -> DataFrame:
    """The published table: rows with their images."""
    images = bitmap_images(colored, raster).select(cal.compact(F.col("dates")).alias("date"), "var", "base64_string")
    return bitmap_rows(layers, raster).join(images, ["date", "var"])
