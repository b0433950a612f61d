"""Truncated Gaussian smoothing around targets (Thornton, Running & White 1997).

A target (grid cell or left-out station) and a source (station) meet on the group that defines the
station set, e.g. date and partition. Groups are cut into chunks of targets of bounded size, with the
group's sources repeated per chunk, so no group is one task's work however many targets it has. The
radius passes of a chunk are array operations in the task that holds it (``reach``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skygrid.operators import reach as rc
from skygrid.params import DEFAULTS, InterpolationParams

ROWS_PER_CHUNK = 4096


def gaussian_weight(r2: Column, rp2: Column, alpha: Column) -> Column:
    """``exp(-a (r/Rp)^2) - exp(-a)`` within the radius, else 0; arguments are squared distances."""
    return F.when(r2 <= rp2, F.exp(-alpha * r2 / rp2) - F.exp(-alpha)).otherwise(0.0)


def mean_weight(alpha: Column) -> Column:
    """Mean of the weight over the untruncated disc."""
    return (1.0 - F.exp(-alpha)) / alpha - F.exp(-alpha)


def chunk_targets(targets: DataFrame, group: list[str], target_id: str, rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Targets with a ``chunk`` number so that about ``rows`` of them share a group and a chunk."""
    sizes = chunk_counts(targets, group, rows)
    spread = F.pmod(F.xxhash64(target_id), F.col("chunks")).cast("int")
    return targets.join(sizes, group).withColumn("chunk", spread).drop("chunks")


def chunk_counts(targets: DataFrame, group: list[str], rows: int = ROWS_PER_CHUNK) -> DataFrame:
    return targets.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / rows).cast("int").alias("chunks"))


def place(keyed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows hashed on the keys into the session's number of tasks.

    Called while rows are few: what each key then grows into stays in its task, and every later join and
    aggregate on the keys finds them in place. The number is given so that it is not cut down to suit the
    few rows.
    """
    return keyed.repartition(int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def repeat_sources(sources: DataFrame, counts: DataFrame, group: list[str]) -> DataFrame:
    """The group's sources once per chunk."""
    return sources.join(counts, group).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")


def _squared_distance() -> Column:
    dx = F.col("x") - F.col("sx")
    dy = F.col("y") - F.col("sy")
    return dx * dx + dy * dy


def near_pairs(
    targets: DataFrame, sources: DataFrame, keys: list[str], reach2: Column, leave_out: tuple[str, str] | None = None
) -> DataFrame:
    """Targets with the sources of their chunk in reach; targets without any are kept."""
    # Sources grow with dates, so they are not broadcast: the merge join finds the targets in place,
    # shuffles only the sources, and spills where a group has very many.
    t, s = targets.alias("t"), sources.hint("merge").alias("s")
    meet = F.lit(True)
    for k in keys:
        meet = meet & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    if leave_out:
        meet = meet & (F.col(f"t.{leave_out[0]}") != F.col(f"s.{leave_out[1]}"))
    kept = [F.col(f"s.{c}") for c in sources.columns if c not in keys]
    return t.join(s, meet & (_squared_distance() <= reach2), "left").select("t.*", *kept).withColumn(
        "r2", _squared_distance())


def near_stations(targets: DataFrame, sources: DataFrame, keys: list[str], target_id: str, source_id: str, reach: float) -> DataFrame:
    """Per target the number of sources of its chunk within ``reach``, the nearest one's distance and their mean distance.

    Like an aggregate of ``near_pairs``, but no pair is a row: a chunk's distances are arrays in the task that holds it.
    """
    schema = T.StructType([
        targets.schema[target_id], T.StructField("n", T.LongType()), T.StructField("_k", T.LongType()),
        T.StructField("nearest", T.DoubleType()), T.StructField("_total", T.DoubleType())])
    left, right = targets.select(*keys, target_id, "x", "y"), sources.select(*keys, "sx", "sy", F.col(source_id).isNotNull().alias("_known"))

    def work(t, s):
        return rc.near_sums(t, s, target_id, reach * reach)

    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)
    return parts.groupBy(target_id).agg(
        F.sum("n").alias("n"), F.min("nearest").alias("nearest"), F.try_divide(F.sum("_total"), F.sum("_k")).alias("mean_r"))


def widest(variables) -> Column:
    """The largest squared radius of a target's variables: how far its sources are looked for."""
    radii = [F.col(f"rp2_{v}") for v in variables]
    return F.greatest(*radii) if len(radii) > 1 else radii[0]


def carried(df: DataFrame, ids: list[str]) -> list[Column]:
    """Columns that are the same in all rows of a target, kept without being grouping keys."""
    return [F.any_value(c).alias(c) for c in df.columns if c not in ids]


def estimate_radii(
    targets: DataFrame, sources: DataFrame, keys: list[str], ids: list[str], variables: dict[str, str],
    smoothing: dict[str, tuple[Column, Column]], leave_out: tuple[str, str] | None = None,
    p: InterpolationParams = DEFAULTS,
) -> DataFrame:
    """Targets with ``rp2_<v>``, the squared radius that holds about N sources with a value.

    ``variables`` maps a variable to the source column that is not NULL where the source counts, and
    ``smoothing`` to its N and alpha. Targets carry ``x, y`` and are told apart by ``ids``, which hold
    the ``keys``; sources carry ``sx, sy``. All variables share each pass. A target whose disc holds no
    weight keeps its radius.
    """
    smooth = {f"_{c}_{v}": choice[k].cast("double") for v, choice in smoothing.items() if v in variables for k, c in enumerate(("n", "alpha"))}
    left = targets.withColumns(smooth)
    other = [leave_out[1]] if leave_out else []
    # Both sides may come from one frame: the keys of one are named anew.
    right = sources.select(*[F.col(k).alias(k) for k in keys], "sx", "sy", *other, *[F.col(value).isNotNull().alias(f"_has_{v}") for v, value in variables.items()])
    schema = T.StructType([*targets.schema.fields, *[T.StructField(f"rp2_{v}", T.DoubleType()) for v in variables]])
    rest, names = [c for c in ids if c not in keys], list(variables)
    numbers = {"radius": p.initial_radius_m, "passes": p.radius_passes}

    def work(t, s):
        return rc.radii(t, s, rest, names, leave_out, numbers)

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)


def radius_m(v: str) -> Column:
    return F.sqrt(F.col(f"rp2_{v}"))
