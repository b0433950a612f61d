"""Mixing sources to target weights.

Sizes are words. The mix shares out as many words as the corpus has. Targets follow the weights of the
sources, are held at ``max_passes`` times a source's size, and the excess goes to the others by weight.
Blocks of equally many words are then apportioned by highest quotients (Sainte-Lague): first to sources by
target, then inside a source to its shards by size. Every shard thereby has a whole number of blocks to take.

A shard lays its documents end to end in an order drawn from the seed, ``max_passes`` times over, and cuts
that line into blocks. Whole passes are taken first; what the quota leaves is a run of blocks of the next
pass that starts at a seeded place and goes round. All of it is arithmetic on running sums: one shuffle of
(document, size) rows, and no block is ever a row.

Defined results: null and empty texts have size 0 and take 0; the null source is a source of its own, last
in order; repeated rows are documents of their own; an empty table gives an empty mix. Extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skygrid.llm.common import WORD, whole_text, written

BLOCK_WORDS = 16
# A shard is one task's sort of narrow rows. Both numbers only set how finely a source is cut.
SHARD_WORDS = 1 << 17
MAX_SHARDS = 1 << 12


def word_count(text: str | Column = "text") -> Column:
    return F.regexp_count(whole_text(text), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_passes: int) -> DataFrame:
    """One row per source: size, weight, target. ``sizes`` has source and size, one row per document.

    Filling to a common level: sources are capped in the order of cap / weight, and the level is the
    first at which no cap is met. The window runs over one row per source, not over documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = per.withColumn("_at", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_at") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("_cap", F.col("source_size").cast("double") * max_passes)
    order = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("_at"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    filled = (
        ranked.withColumn("_total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("_level", (F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
        .withColumn("_held", F.col("_cap") <= F.col("_level") * F.col("weight")))
    # Sources not held share the level of the first of them; the values computed past it only fall.
    level = F.max(F.when(~F.col("_held"), F.col("_level"))).over(everything)
    target = F.when(F.col("_held"), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("weight")))
    return filled.withColumn("target", target).select("source", "source_size", "weight", "target", "_total")


def apportion(rows: DataFrame, group: list[str], claim: str, cap: str, seats: Column) -> DataFrame:
    """Whole numbers ``quota`` by highest quotients claim / (2k + 1), k counted up to ``cap``, per group.

    ``rows`` has a distinct ``_id`` per claimant of a group; ``seats`` is the group's number of seats. Rounded shares
    are right but for some seats; those go to (or come from) the next quotients in line. How many quotients
    a claimant can be concerned with follows from its share, so the list of candidates is about as long as
    the list of claimants.
    """
    # Ordered, so that sums of doubles are the same in every run.
    w = Window.partitionBy(*group).orderBy("_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = F.when(F.col("_sum") > 0, F.col(claim) * F.col("_seats") / F.col("_sum")).otherwise(F.lit(0.0))
    start = (
        rows.withColumn("_seats", seats.cast("long")).withColumn("_sum", F.sum(claim).over(w)).withColumn("_n", F.count(F.lit(1)).over(w))
        .withColumn("_first", F.least(F.col(cap), F.round(share).cast("long")))
        .withColumn("_open", F.sum(F.when(F.col("_first") < F.col(cap), F.col(claim)).otherwise(0.0)).over(w))
        .withColumn("_lack", F.col("_seats") - F.sum("_first").over(w)))
    most = F.when(F.col("_lack") > 0, F.col("_open")).otherwise(F.col("_sum"))
    reach = F.least(
        F.abs("_lack"),
        F.when(most > 0, F.ceil(F.col(claim) * (F.col("_n") + F.abs("_lack")) / most) + 2).otherwise(0)).cast("long")
    reach = F.when(F.col("_lack") > 0, F.least(reach, F.col(cap) - F.col("_first"))).otherwise(F.least(reach, F.col("_first")))
    sign = F.when(F.col("_lack") > 0, 1).otherwise(-1)
    quotient = F.col(claim) / (2 * F.when(sign > 0, F.col("_first") + F.col("_k")).otherwise(F.col("_first") - 1 - F.col("_k")) + 1)
    turn = Window.partitionBy(*group).orderBy((-sign * quotient).asc(), "_id", "_k")
    moved = (
        start.where((F.col("_lack") != 0) & (reach > 0)).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), reach - 1)))
        .withColumn("_turn", F.row_number().over(turn)).where(F.col("_turn") <= F.abs("_lack"))
        .groupBy(*group, "_id").agg(F.sum(sign).alias("_more")))
    keys = [*group, "_id"]
    return (
        start.join(moved, keys, "left").withColumn("quota", F.col("_first") + F.coalesce("_more", F.lit(0)))
        .drop("_seats", "_sum", "_n", "_first", "_open", "_lack", "_more"))


def _taken_before(x: Column, block: int) -> Column:
    """Words taken in the first ``x`` of a shard's line, from m (blocks of whole passes), n, o, r (see ``mix``)."""
    def blocks(j: Column) -> Column:
        y = F.least(F.greatest(j - F.col("_m"), F.lit(0)), F.col("_n"))
        wrap = F.greatest(F.col("_o") + F.col("_r") - F.col("_n"), F.lit(0))
        run = F.least(F.greatest(y - F.col("_o"), F.lit(0)), F.col("_r") - wrap) + F.least(y, wrap)
        return F.least(j, F.col("_m")) + run

    whole = F.floor(x / block)
    return block * blocks(whole) + (x % block) * (blocks(whole + 1) - blocks(whole))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_passes: int = 3, block_words: int = BLOCK_WORDS,
        seed: int = 17, size: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, shard, taken for every row of ``docs`` (doc_id, text, source)."""
    counted = written(docs.select(
        "doc_id", "source", (word_count() if size is None else size).cast("long").alias("size")), "mix-sizes")
    sources = written(source_targets(counted, weights, max_passes), "mix-sources")
    shards = F.least(F.lit(MAX_SHARDS), F.floor(F.col("source_size") / SHARD_WORDS) + 1)
    place = F.xxhash64(F.lit(seed), "doc_id")
    # Spark broadcasts the sources only while their written table is below its threshold.
    s = sources.withColumnRenamed("source", "_source")
    dealt = (
        counted.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "weight")
        .withColumn("_place", place).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "_place"), shards)))
    by_source = dealt.groupBy("source", "shard").agg(
        F.sum("size").alias("_z"), F.first("source_size").alias("source_size"), F.first("target").alias("target"), F.first("_total").alias("_total"))
    # A claimant may get as many blocks as fit into its line; a source's line is that of its shards.
    room = written(by_source.withColumn("_cap", F.floor(F.col("_z") * max_passes / block_words)), "mix-shards")
    claims = (
        room.groupBy("source").agg(F.sum("_cap").alias("_cap"), F.first("target").alias("target"), F.first("_total").alias("_total"))
        .withColumn("_id", F.to_json(F.struct("source"))).withColumn("_all", F.lit(0)))
    quotas = apportion(claims, ["_all"], "target", "_cap", F.round(F.col("_total") / block_words)).select("source", F.col("quota").alias("_blocks"))
    quotas = quotas.withColumnRenamed("source", "_source")
    parts = (
        room.join(quotas, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        .withColumn("_id", F.col("shard")).withColumn("_claim", F.col("_z").cast("double")))
    per_shard = apportion(parts, ["source"], "_claim", "_cap", F.col("_blocks"))
    passes = F.when(F.col("_z") > 0, F.floor(F.col("quota") * block_words / F.col("_z"))).otherwise(0)
    plan = (
        per_shard.withColumn("_e", passes).withColumn("_m", F.least(F.col("quota"), F.floor(F.col("_e") * F.col("_z") / block_words)))
        .withColumn("_n", F.greatest(F.floor((F.col("_e") + 1) * F.col("_z") / block_words) - F.col("_m"), F.lit(1)))
        .withColumn("_r", F.col("quota") - F.col("_m")).withColumn("_o", F.pmod(F.xxhash64(F.lit(seed + 2), "source", "shard"), F.col("_n")))
        .select(F.col("source").alias("_source"), F.col("shard").alias("_shard"), "_z", "_m", "_n", "_r", "_o"))
    line = Window.partitionBy("source", "shard").orderBy("_place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    laid = dealt.withColumn("_end", F.sum("size").over(line))
    planned = laid.join(plan, F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")))
    taken = F.lit(0).cast("long")
    for p in range(max_passes):
        end = F.col("_end") + p * F.col("_z")
        taken = taken + _taken_before(end, block_words) - _taken_before(end - F.col("size"), block_words)
    return planned.select("doc_id", "source", "size", "source_size", "target", "shard", taken.cast("long").alias("taken"))


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as the mix has them: a row as often as it is taken, in whole documents (the one or two that a shard's
    run enters or leaves in mid-text count when at least half of them is taken)."""
    taken = (
        mix(docs, **how).where("size > 0").groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"))
        .agg(F.round(F.sum("taken") / F.sum("size")).cast("int").alias("copies")).where("copies > 0"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), word_count(docs["text"]).alias("words"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & F.col("row.source").eqNullSafe(F.col("_source")) & (F.col("words") == F.col("_size"))
    return rows.join(taken, same).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
