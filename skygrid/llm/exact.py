"""Exact dedup by distributed MSD radix partitioning.

Documents are split by their leading bytes, groups of two or more by the bytes that follow, and so on until
a group has one member or its texts have ended: members of a group that has ended are equal byte for byte,
and no digest decides it. A round reads a stride of successive bytes, eight times as many as the one before,
so a text of n bytes takes about log8(n / 256) rounds and every byte is moved at most once, by those texts
only that still share everything before it. What follows a text's stride is moved only if another text shares all up to there, as
long as the hashes of such strides are few enough to be given to every task. A group of copies is never gathered: its rows are counted with
partial sums, and the join with the counts is one that Spark can split.

Defined results: null texts are empty texts and equal each other; the row with the smallest doc_id stays,
null doc_id last; of repeated rows with that doc_id exactly one stays; an empty table gives an empty result.
Other columns are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skygrid.llm.common import BLANKS, is_empty, whole_text, written

FIRST_STRIDE = 256
WIDER = 8
# Hashes of shared strides that every task gets, eight megabytes; with more of them all texts are moved to the join.
MARKS = 1 << 20


def squeezed(text: str | Column = "text") -> Column:
    """Every run of blanks becomes one space."""
    return F.regexp_replace(whole_text(text), BLANKS, " ")


def _copies(docs: DataFrame, whole: list[Column], first_stride: int) -> tuple[DataFrame, DataFrame]:
    """Numbered rows (_rid, doc_id, text_sha256, ``whole``), and for those with copies _rid, keep_id, group_size, _keep (_rid that stays)."""
    base = written(
        docs.select("doc_id", squeezed().alias("_s"), *whole).select(
            F.monotonically_increasing_id().alias("_rid"), "doc_id", F.sha2("_s", 256).alias("text_sha256"), *(["row"] if whole else []),
            F.col("_s").cast("binary").alias("_rest")), "radix-base")
    live = base.select("_rid", "doc_id", F.lit(0).cast("long").alias("_group"), "_rest")
    ended, stride = [], first_stride
    while True:
        step = live.select(
            "*", F.expr(f"substring(_rest, 1, {stride})").alias("_head"), (F.length("_rest") <= stride).alias("_over"))
        keys = ["_group", "_head", "_over"]
        heads = step.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min(F.struct(F.isnull("doc_id").alias("n"), F.col("doc_id").alias("d"), F.col("_rid").alias("r"))).alias("_first")).where("group_size > 1")
        heads = written(heads, "radix-groups")
        # Merged at every size: the table of groups grows with the corpus, and skewed keys of this join can be split.
        mark = F.xxhash64(*keys).alias("_mark")
        marks = written(heads.select(mark).distinct(), "radix-marks")
        if marks.count() <= MARKS:
            step = step.join(F.broadcast(marks), mark == F.col("_mark"), "left_semi")
        split = step.join(heads.hint("merge"), keys).select(
            "_rid", "doc_id", "_over", F.col("_first.r").alias("_group"), F.col("_first.d").alias("keep_id"), "group_size",
            F.when(~F.col("_over"), F.expr(f"substring(_rest, {stride + 1})")).alias("_rest"))
        split = written(split, "radix-split")
        ended.append(split.where("_over").select("_rid", "keep_id", "group_size", F.col("_group").alias("_keep")))
        live = split.where("not _over").select("_rid", "doc_id", "_group", "_rest")
        if is_empty(live):
            break
        stride *= WIDER
    copies = ended[0]
    for more in ended[1:]:
        copies = copies.unionByName(more)
    return base.drop("_rest"), copies


def groups(docs: DataFrame, first_stride: int = FIRST_STRIDE) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    base, copies = _copies(docs, [], first_stride)
    return base.join(copies, "_rid", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("_keep") == F.col("_rid"), F.lit(True)).alias("kept"), "text_sha256")


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows that stay, with the columns they came with."""
    base, copies = _copies(docs, [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")], FIRST_STRIDE)
    # Written, so that Spark knows how short the list of dropped rows is; rows with their texts need not be shuffled then.
    gone = written(copies.where("_keep <> _rid").select("_rid"), "radix-gone")
    return base.join(gone, "_rid", "left_anti").select("row.*")
