"""A filter of fixed size that keeps rows from being moved to a join which would drop them.

It only saves work: rows that it lets through are still joined. When a table has too many numbers for it, there is none, and all
rows are joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skygrid.llm import words as wd

# Two megabytes, whatever the table.
FILTER_BITS = 1 << 24


def _place(x: np.ndarray) -> np.ndarray:
    return (wd.mixed(np.ascontiguousarray(x).view(np.uint64)) % np.uint64(FILTER_BITS)).astype(np.int64)


def may_hold(bits: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whether each number may be in the filtered column; never wrong about one that is."""
    at = _place(x)
    return (bits[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


def filter_bits(table: DataFrame, column: str) -> np.ndarray | None:
    """Bits of the hashes of a column of numbers; none when there are too many for the filter to tell apart."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _place(batch.column(0).fill_null(0).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], ["w", "bits"])

    if table.count() * 4 > FILTER_BITS:
        return None
    # At most FILTER_BITS / 32 rows of two numbers.
    rows = table.select(column).mapInArrow(hashed, "w long, bits long").groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 32, np.int64)
    bits[rows["w"].to_numpy()] = rows["bits"].to_numpy()
    return bits.astype(np.uint32)
