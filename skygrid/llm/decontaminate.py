"""Benchmark decontamination with suffix arrays of the training texts.

*Shards.* Each task cuts the documents it reads into shards of some ``SHARD`` words, whole documents each, and stores for a
shard its words as ranks among the shard's different words, and the order of all its suffixes (sorted by their first
words, then by doubling). A number of its own after each document keeps matches inside it. Nothing is shuffled.

*Search.* The test items come in blocks of ``BLOCK`` words, each a broadcast of bounded size. In every shard all suffixes of a block
are binary-searched at once: the two neighbours of a suffix's place hold its longest verbatim match, and when that is as
long as the suffix's window, the suffixes that begin with the window are one stretch of the array: their places are all
its occurrences. A window is ``WINDOW`` successive words of an item, or the whole item when it has fewer.

*Removal.* Hits are gathered per document over the blocks; ``remove`` drops the documents that have any.

Words are compared as 64-bit hashes; a false hit needs collisions in all words of a window. Very long texts make a shard of their own, so
memory is in proportion to the longest text. Defined results: null, empty and wordless texts have no words, are never hit and never
hit others; equal rows give equal results; item rows with one item_id are one item, null item_ids count as the empty
name; without documents the result is empty, without items nothing is hit. Ties of longest matches go to the first of the
shard's order. Other columns are ignored, or carried along by ``remove``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skygrid.llm import words as wd
from skygrid.llm.common import whole_text, written
from skygrid.sources.folders import new_folder

WINDOW = 10
SHARD = 1 << 17
# A reader holds a row group at a time, a writer one per task.
ROW_GROUP_BYTES = 16 << 20
BLOCK = 1 << 19
# Letters A-Z become small; every ASCII byte but digits and letters parts words.
FOLD = np.full(256, 32, np.uint8)
FOLD[128:] = np.arange(128, 256)
FOLD[48:58] = np.arange(48, 58)
FOLD[97:123] = np.arange(97, 123)
FOLD[65:91] = np.arange(97, 123)


def suffix_order(x: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``x`` in order; the last number occurs once."""
    n = len(x)
    bits = max(1, int(x.max()).bit_length())
    depth = max(1, 62 // bits)
    padded = np.concatenate([x, np.zeros(depth, np.int64)]).astype(np.int64)
    key = np.zeros(n, np.int64)
    for d in range(depth):
        key = (key << bits) | padded[d:n + d]
    order = np.argsort(key)
    key = key[order]
    at = np.arange(n)
    new = np.append(True, key[1:] != key[:-1])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, at, 0))
    alone = new & np.append(new[1:], True)
    tied = order[~alone]
    while len(tied):
        # Tied suffixes have this many words in common, so none of them ends within these.
        key = rank[tied] * n + rank[tied + depth]
        by = np.argsort(key)
        tied, key = tied[by], key[by]
        r = key // n
        at = np.arange(len(r))
        group = np.append(True, r[1:] != r[:-1])
        part = np.append(True, key[1:] != key[:-1])
        starts = np.maximum.accumulate(np.where(part, at, 0))
        rank[tied] = r + starts - np.maximum.accumulate(np.where(group, at, 0))
        tied = tied[~(part & np.append(part[1:], True))]
        depth *= 2
    order[rank] = np.arange(n)
    return order


def _packed(x: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(x).astype(kind).tobytes()


def _shard(rids: list[int], ids: list, texts: list[np.ndarray]) -> pa.RecordBatch:
    sizes = np.array([len(w) for w in texts], np.int64)
    seen, rank = np.unique(np.concatenate([*texts, np.zeros(0, np.uint64)]), return_inverse=True)
    x = np.empty(len(rank) + len(texts), np.int64)
    ends = np.cumsum(sizes + 1) - 1
    inside = np.ones(len(x), bool)
    inside[ends] = False
    x[inside] = rank + len(texts)
    x[ends] = np.arange(len(texts))
    rows = [pa.array([v], t) for v, t in (
        (rids, pa.list_(pa.int64())), (ids, pa.list_(pa.int64())), (sizes.tolist(), pa.list_(pa.int64())), (_packed(seen, np.uint64), pa.binary()),
        (_packed(x, np.int32), pa.binary()), (_packed(suffix_order(x), np.int32), pa.binary()))]
    return pa.RecordBatch.from_arrays(rows, ["rids", "doc_ids", "sizes", "seen", "words", "suffixes"])


def suffix_arrays(docs: DataFrame) -> DataFrame:
    """The index: a row per shard of ``docs`` (doc_id long, text), written; rows of documents are numbered by ``rids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rids, ids, texts, size = [], [], [], 0
        for batch in batches:
            numbers, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, hashes, cut in wd.words(batch.column(2), FOLD):
                for k in range(len(cut) - 1):
                    rids.append(numbers[first + k])
                    ids.append(names[first + k])
                    texts.append(hashes[cut[k]:cut[k + 1]])
                    size += len(texts[-1])
                    if size >= SHARD:
                        yield _shard(rids, ids, texts)
                        rids, ids, texts, size = [], [], [], 0
        if rids:
            yield _shard(rids, ids, texts)

    picked = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), "text")
    shards = picked.mapInArrow(
        run, "rids array<long>, doc_ids array<long>, sizes array<long>, seen binary, words binary, suffixes binary")
    path = new_folder(docs.sparkSession, "suffix-arrays")
    shards.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return docs.sparkSession.read.schema(shards.schema).parquet(path)


class Queries:
    """The suffixes of a block of test items."""

    def __init__(self, items: list[np.ndarray], window: int):
        sizes = np.array([len(w) for w in items], np.int64)
        self.words = np.concatenate([*items, np.zeros(0, np.uint64)])
        end = np.repeat(np.cumsum(sizes), sizes)
        self.item = np.repeat(np.arange(len(items)), sizes)
        self.start = np.arange(len(self.words))
        self.left = end - self.start
        # The window that a suffix begins with; the last ones of a long item begin with none.
        self.window = np.minimum(window, np.repeat(sizes, sizes))
        self.window[self.left < self.window] = 0


def _compared(q: np.ndarray, start: np.ndarray, most: np.ndarray, x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words in common, whether the query is greater) of queries q[start:start + most] and the suffixes of x at ``at``."""
    common = np.zeros(len(start), np.int64)
    greater = np.zeros(len(start), bool)
    live = np.flatnonzero(most > 0)
    while len(live):
        d = common[live]
        a, b = q[start[live] + d], x[at[live] + d]
        greater[live[a > b]] = True
        live = live[a == b]
        common[live] += 1
        # Whole queries that are a suffix's beginning come before it; a suffix never ends inside a match.
        live = live[common[live] < most[live]]
    return common, greater


def _place(q: np.ndarray, start: np.ndarray, most: np.ndarray, x: np.ndarray, order: np.ndarray, after: bool) -> np.ndarray:
    """Number of suffixes below each query, those that begin with it included if ``after``."""
    lo, hi = np.zeros(len(start), np.int64), np.full(len(start), len(order), np.int64)
    live = np.arange(len(start))
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        common, greater = _compared(q, start[live], most[live], x, order[mid])
        up = greater | (common == most[live]) if after else greater
        lo[live[up]] = mid[up] + 1
        hi[live[~up]] = mid[~up]
        live = live[lo[live] < hi[live]]
    return lo


def _in_shard(asked: Queries, seen: np.ndarray, n_docs: int) -> np.ndarray:
    """The block's words as numbers of the shard; words that it lacks are -1, below every number."""
    at = np.minimum(np.searchsorted(seen, asked.words), max(0, len(seen) - 1))
    known = seen[at] == asked.words if len(seen) else np.zeros(len(at), bool)
    return np.where(known, at + n_docs, -1)


def matches(asked: Queries, x: np.ndarray, order: np.ndarray, seen: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(longest match, its place, first and end of the window's stretch in the order) of every suffix of the block."""
    q = _in_shard(asked, seen, n_docs)
    n = len(q)
    longest, place = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    first, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    # Suffixes of which the first word is nowhere in the shard match nothing.
    hope = np.flatnonzero(q >= 0)
    if not len(hope):
        return longest, place, first, end
    start, left = asked.start[hope], asked.left[hope]
    at = _place(q, start, left, x, order, False)
    for neighbour in (at - 1, at):
        beside = order[np.clip(neighbour, 0, len(order) - 1)]
        common, _ = _compared(q, start, left, x, beside)
        common[(neighbour < 0) | (neighbour >= len(order))] = 0
        better = common > longest[hope]
        longest[hope[better]] = common[better]
        place[hope[better]] = beside[better]
    full = np.flatnonzero((asked.window > 0) & (longest >= asked.window))
    if len(full):
        start, window = asked.start[full], asked.window[full]
        first[full] = _place(q, start, window, x, order, False)
        end[full] = _place(q, start, window, x, order, True)
    return longest, place, first, end


def _rows(batch: pa.RecordBatch) -> Iterator[dict[str, np.ndarray]]:
    """Shards (rids, sizes, seen, words, suffixes) where they lie in the batch."""
    for k in range(batch.num_rows):
        row = {name: batch.column(name)[k].values.to_numpy() for name in ("rids", "sizes")}
        yield row | {name: np.frombuffer(batch.column(name)[k].as_buffer(), kind) for name, kind in (("seen", np.uint64), ("words", np.int32), ("suffixes", np.int32))}


def _ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _hits(asked: Queries, row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the covered stretches, and (document, item) as one number each, of a shard."""
    sizes, x, order = row["sizes"], row["words"], row["suffixes"]
    n_docs = len(sizes)
    _, _, first, end = matches(asked, x, order, row["seen"], n_docs)
    # Equal windows have one stretch of the order: its places are listed once, its documents met by each item once.
    windows = np.flatnonzero(end > first)
    stretch, name = np.unique(np.column_stack([first[windows], end[windows], asked.window[windows]]), axis=0, return_inverse=True)
    name = name.ravel()
    n = stretch[:, 1] - stretch[:, 0]
    places = order[_ranges(stretch[:, 0], n)].astype(np.int64)
    edge = np.zeros(len(x) + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + np.repeat(stretch[:, 2], n), -1)
    hit = np.cumsum(edge)[:-1] > 0
    starts, ends = wd.runs(hit, np.zeros(0, np.int64))
    ends_of = np.cumsum(sizes + 1)
    in_doc = np.searchsorted(ends_of, starts, "right")
    base = ends_of[in_doc] - sizes[in_doc] - 1
    # (stretch, document) without repetition, then the items that ask for the stretch.
    width = np.int64(n_docs)
    docs_of = np.unique(np.repeat(np.arange(len(stretch)), n) * width + np.searchsorted(ends_of, places, "right"))
    asks = np.unique(name * np.int64(len(asked.words) + 1) + asked.item[windows]) if len(name) else np.zeros(0, np.int64)
    by, item = asks // (len(asked.words) + 1), asks % (len(asked.words) + 1)
    cut = np.searchsorted(by, np.arange(len(stretch) + 1))
    many = np.diff(cut)[docs_of // width]
    pairs = np.repeat(docs_of % width, many) * np.int64(len(asked.words) + 1) + item[_ranges(cut[docs_of // width], many)]
    return np.column_stack([in_doc, starts - base, ends - base]), np.unique(pairs), np.int64(len(asked.words) + 1)


def _blocks(items: DataFrame) -> DataFrame:
    """(block, item_id, words as packed hashes) of the items that have words; blocks are bounded by their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [h[cut[k]:cut[k + 1]] for _, h, cut in wd.words(batch.column(1), FOLD) for k in range(len(cut) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).fill_null(""), pa.array([w.tobytes() for w in texts], pa.binary()), pa.array([len(w) for w in texts], pa.int64())],
                ["item_id", "words", "n"])

    found = items.select(F.col("item_id").cast("string"), "text").mapInArrow(run, "item_id string, words binary, n long").where("n > 0")
    found = written(found.dropDuplicates(["item_id", "words"]).withColumn("at", F.monotonically_increasing_id()), "items")
    n_blocks = 1 + (found.agg(F.sum("n")).first()[0] or 0) // BLOCK
    return found.select(F.expr(f"pmod(xxhash64(at), {n_blocks})").alias("block"), "item_id", "words")


def _each_block(items: DataFrame) -> Iterator[tuple[list[np.ndarray], list[str]]]:
    """The blocks one after the other: some BLOCK words, or one longer item."""
    blocks = written(_blocks(items), "item-blocks")
    for (block,) in blocks.select("block").distinct().orderBy("block").collect():
        rows = blocks.where(F.col("block") == block).select("item_id", "words").collect()
        yield [np.frombuffer(bytes(r["words"]), np.uint64) for r in rows], [r["item_id"] for r in rows]


def find(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """rid, spans (start, end in words), items (sorted item_ids) of the indexed documents that hold a window of ``items`` (item_id, text)."""
    spark = index.sparkSession
    schema = "rid long, spans array<struct<start: long, end: long>>, items array<string>"
    found = []
    for texts, item_ids in _each_block(items):
        names, codes = np.unique(np.array(item_ids, object), return_inverse=True)
        shared = spark.sparkContext.broadcast((Queries(texts, window), codes, names))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked, codes, names = shared.value
            for batch in batches:
                for row in _rows(batch):
                    spans, pairs, width = _hits(asked, row)
                    if not len(spans):
                        continue
                    docs = np.unique(spans[:, 0])
                    named = np.unique(pairs // width * len(names) + codes[pairs % width])
                    at = np.searchsorted(named // len(names), docs), np.searchsorted(named // len(names), docs, "right")
                    cut = np.searchsorted(spans[:, 0], np.append(docs, len(row["rids"])))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(row["rids"][docs]),
                        pa.array([[{"start": s, "end": e} for s, e in spans[a:b, 1:].tolist()] for a, b in zip(cut[:-1], cut[1:])],
                                 pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        pa.array([names[named[a:b] % len(names)].tolist() for a, b in zip(*at)], pa.list_(pa.string()))], ["rid", "spans", "items"])

        found.append(index.select("rids", "sizes", "seen", "words", "suffixes").mapInArrow(run, schema))
    if not found:
        return spark.createDataFrame([], schema)
    if len(found) == 1:
        return found[0]
    union = found[0]
    for part in found[1:]:
        union = union.unionByName(part)
    return union.groupBy("rid").agg(
        F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))


def longest_matches(index: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, start, length, rid, at: the longest verbatim match of every suffix of every item, and one of its places."""
    spark = index.sparkSession
    schema = "item_id string, start long, length long, rid long, at long"
    best = spark.createDataFrame([], schema)
    for texts, item_ids in _each_block(items):
        shared = spark.sparkContext.broadcast((Queries(texts, WINDOW), item_ids))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            asked, names = shared.value
            head = asked.start - np.maximum.accumulate(np.where(np.append(True, asked.item[1:] != asked.item[:-1])[:len(asked.item)], asked.start, 0))
            for batch in batches:
                for row in _rows(batch):
                    sizes = row["sizes"]
                    longest, place, _, _ = matches(asked, row["words"], row["suffixes"], row["seen"], len(sizes))
                    good = np.flatnonzero(longest > 0)
                    ends = np.cumsum(sizes + 1)
                    doc = np.searchsorted(ends, place[good], "right")
                    yield pa.RecordBatch.from_arrays([
                        pa.array([names[k] for k in asked.item[good]], pa.string()), pa.array(head[good]), pa.array(longest[good]),
                        pa.array(row["rids"][doc]), pa.array(place[good] - (ends[doc] - sizes[doc] - 1))], ["item_id", "start", "length", "rid", "at"])

        best = best.unionByName(index.select("rids", "sizes", "seen", "words", "suffixes").mapInArrow(run, schema))
    top = F.max(F.struct("length", (-F.col("rid")).alias("r"), (-F.col("at")).alias("a"))).alias("m")
    return best.groupBy("item_id", "start").agg(top).select(
        "item_id", "start", F.col("m.length").alias("length"), (-F.col("m.r")).alias("rid"), (-F.col("m.a")).alias("at"))


def documents_of(index: DataFrame) -> DataFrame:
    """rid, doc_id, n_words of the indexed rows."""
    each = index.select(F.explode(F.arrays_zip("rids", "doc_ids", "sizes")).alias("d"))
    return each.select(F.col("d.rids").alias("rid"), F.col("d.doc_ids").alias("doc_id"), F.col("d.sizes").alias("n_words"))


def covered(spans: str = "spans") -> F.Column:
    """Number of words that the stretches cover; those of different blocks may overlap."""
    return F.expr(
        f"aggregate(array_sort({spans}), named_struct('n', 0L, 'upto', 0L), (a, s) -> named_struct("
        "'n', a.n + greatest(0L, s.end - greatest(s.start, a.upto)), 'upto', greatest(a.upto, s.end)), a -> a.n)")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted), contaminated for every row of ``docs`` (doc_id long, text)."""
    index = suffix_arrays(docs)
    hits = find(index, items, window)
    return documents_of(index).join(hits, "rid", "left").select(
        "doc_id", "n_words", F.coalesce(covered(), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("array()").cast("array<string>")).alias("items"), F.col("spans").isNotNull().alias("contaminated"))


def remove(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of the items, with the columns they came with."""
    held = written(docs.select(
        F.monotonically_increasing_id().alias("rid"), whole_text().alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "uncleaned")
    index = suffix_arrays(held.select(F.col("rid").alias("doc_id"), "text"))
    gone = documents_of(index).join(find(index, items, window).select("rid"), "rid").select(F.col("doc_id").alias("rid"))
    return held.join(gone, "rid", "left_anti").select("row.*")
