"""Language-model scores: stupid backoff on the corpus itself, each document left out of its own counts.

With the order 2, for a word w after v in document d, with counts over all other documents (count less the document's own):
count(v w) / count(v as a context) when the pair occurs elsewhere, else 0.4 * count(w) / number of words elsewhere, where a word
that occurs nowhere else counts one half. With a higher order the longest n-gram of that many words comes first, and each word less
costs another 0.4. Words near the start of a document begin with what context they have, without the 0.4. A document's
score is the sum of logarithms; backed off are words that do not occur elsewhere after the longest context they have.

Below, pairs stand for n-grams of whatever order.

It is a join of every document's n-grams with tables of counts, both partitioned by hash. A document's distinct pairs, with their
own counts, are dealt by their second word into buckets; a bucket holds all there is of its words and pairs, so counting and
joining are one grouping. What then lacks the count of its context is dealt once more, by context. N-grams travel as packed and compressed
columns, a row per bucket and half a million n-grams that a task holds.

Those half a million are a chunk, and its n-grams name their document by its place in the chunk: some bits, as places ascend. The documents of a chunk
travel once. Sums go back to the bucket of their chunk, packed, and are added there by place, so that a chunk makes a row per document.

The number of buckets follows the number of words, so that a bucket, which a task holds whole, has some half a million pairs
whatever the corpus and the settings. Words and pairs that make a 4,096th of the corpus or more, or more than a bucket shall
hold (4,096 of each at most, or the number of buckets, so of a proven size), are found first by counts in 65,536 groups, counted
exactly, and given to every task: such pairs, and such words at the start of a document, are scored where they are read, and
other pairs with such a second word are dealt by the whole pair. So no key has more rows than a bucket shall hold.
Contexts that make a 262,144th or more (262,144 at most, 4 MB) are given to every task as well; only pairs of the rarer ones
are dealt a second time.

Words are lower-cased (A to Z) and held as 48-bit hashes: of a billion different words, some thousand share theirs.

Defined results: null, empty and blank texts have no words and the score 0; repeated rows are documents of their own; a corpus of
one document scores its words as occurring nowhere else; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skygrid.llm import words as wd
from skygrid.llm.common import WORD, whole_text, written

BACKOFF = 0.4
GROUPS = 1 << 16
SHARE = 1 << 12
CONTEXTS = 1 << 18
_MASK = np.uint64((1 << 48) - 1)
# Pairs of a bucket on average, and of one key at most.
BUCKET = 1 << 19
# Pairs that a task holds before it deals them out, and as many parts of sums before it adds them up: some 20 MB each.
HELD = 1 << 19
_PACKED = "bucket int, kind int, n long, data binary"
NAMES = ["bucket", "kind", "n", "data"]

def _pair(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return wd.mixed(v * wd._STEP + w) & _MASK


def _gram(xs: list[np.ndarray]) -> np.ndarray:
    out = xs[0]
    for x in xs[1:]:
        out = _pair(out, x)
    return out


def _windows(h: np.ndarray, row: np.ndarray, order: int) -> list[np.ndarray]:
    """The last ``order`` words at every position, the word itself last; 0 before the start of a row."""
    out = [h]
    for back in range(1, order):
        x = np.zeros_like(h)
        x[back:] = np.where(row[back:] == row[:-back], h[:-back], np.uint64(0))
        out.insert(0, x)
    return out


def _grams(xs: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """(k, n-grams of the last k words, where there are so many, their contexts), k from 1; a word has no context."""
    for k in range(1, len(xs) + 1):
        yield k, _gram(xs[-k:]), xs[-k] > 0, _gram(xs[-k:-1]) if k > 1 else None


def _six(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _eight(b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = b.reshape(-1, 6)
    return out.view("<u8").ravel().astype(np.uint64)


def _words(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, words, their rows counted from it); no word is 0."""
    for first, h, off in wd.words(column):
        yield first, np.maximum(h & _MASK, np.uint64(1)), np.repeat(np.arange(len(off) - 1), np.diff(off))


def _own(row: np.ndarray, x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How often the (row, x) of each position ``at`` occurs among all positions."""
    key = wd.mixed(x * wd._STEP + row.astype(np.uint64))
    if 4 * len(at) < len(key):
        # Only what has an x of those is counted.
        wanted = np.unique(x[at])
        key = np.concatenate([key[at], key[wanted[np.minimum(np.searchsorted(wanted, x), len(wanted) - 1)] == x]])
        _, back, n = np.unique(key, return_inverse=True, return_counts=True)
        asked = back[:len(at)]
        return (n - np.bincount(asked, minlength=len(n)))[asked]
    _, back, n = np.unique(key, return_inverse=True, return_counts=True)
    return n[back[at]]


def _grouped(docs: DataFrame, order: int) -> tuple[np.ndarray, int]:
    """Counts of n-grams of each length in 65,536 groups, and the number of words: of a fixed size, so collected."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(order * GROUPS, np.int64)
        for batch in batches:
            for _, h, row in _words(batch.column(0)):
                for k, g, there, _ in _grams(_windows(h, row, order)):
                    total[(k - 1) * GROUPS:k * GROUPS] += np.bincount((g[there] % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["g", "n"])

    rows = docs.select("text").mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(order * GROUPS, np.int64)
    out[rows["g"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return out, int(out[:GROUPS].sum())


def _n_buckets(total: int, partitions: int) -> int:
    """So many that a bucket has BUCKET of ``total`` words on average, and enough for every task."""
    return max(4 * partitions, -(-total // BUCKET))


def _frequent(docs: DataFrame, groups: np.ndarray, total: int, order: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Exact counts of frequent n-grams of k words (k), 4,096 of each k at most, and of contexts of k words (-k), 262,144 at most;
    more only where a word of a smaller share would fill a bucket."""
    share = max(SHARE, -(-total // BUCKET))
    contexts = max(CONTEXTS, share)
    hot, context = groups * share >= max(total, 1), groups * contexts >= max(total, 1)
    shared = docs.sparkSession.sparkContext.broadcast((hot, context))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, context = shared.value
        for batch in batches:
            kinds, keys, counts = [], [], []
            for _, h, row in _words(batch.column(0)):
                wanted = []
                for k, g, there, c in _grams(_windows(h, row, order)):
                    wanted.append((k, g[there], k - 1, hot))
                    if k > 1:
                        wanted.append((1 - k, c[there], k - 2, context))
                for kind, x, base, which in wanted:
                    x = x[which[(x % np.uint64(GROUPS)).astype(np.int64) + base * GROUPS]]
                    k, n = np.unique(x, return_counts=True)
                    kinds += [kind] * len(k)
                    keys.append(k)
                    counts.append(n)
            if keys:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kinds, pa.int32()), pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(counts))], ["kind", "key", "n"])

    counts = docs.select("text").mapInArrow(count, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    rows = written(counts, "lm-frequent")
    # A count of that share, which at most so many words, pairs or contexts can have.
    limit = F.when(F.col("kind") < 0, -(-max(total, 1) // contexts)).otherwise(-(-max(total, 1) // share))
    found = rows.where(F.col("n") >= limit).select("kind", "key", "n").toArrow().to_pandas()
    out = {}
    for kind in (*range(1, order + 1), *range(-1, -order, -1)):
        part = found[found["kind"] == kind].sort_values("key")
        out[kind] = (part["key"].to_numpy(np.int64).view(np.uint64), part["n"].to_numpy(np.int64))
    return out


def _lookup(table: tuple[np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Counts of x, 0 for what is not in the table."""
    keys, n = table
    if not len(keys):
        return np.zeros(len(x), np.int64)
    at = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
    return np.where(keys[at] == x, n[at], 0)


def _dealt(often: dict, xs: list[np.ndarray]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """The n-grams with their frequent counts, what deals them out (the shortest that is not frequent), and where all are frequent."""
    grams = [(k, g, there, c, _lookup(often[k], g)) for k, g, there, c in _grams(xs)]
    key, all_known = grams[-1][1], np.ones(len(xs[0]), bool)
    for _, g, there, _, f in reversed(grams):
        lacks = there & (f == 0)
        key, all_known = np.where(lacks, g, key), all_known & ~lacks
    return grams, key, all_known


def _chosen(often: dict, grams: list[tuple], counts: dict[int, np.ndarray], own_c: dict[int, np.ndarray]) -> tuple[np.ndarray, ...]:
    """s without the number of all words, backed off, scored as a word alone, and context, its own count, and whether it is still to count.
    ``counts`` are those elsewhere."""
    s = np.log(np.maximum(counts[1], 0.5))
    level, top = np.ones(len(s), np.int64), np.ones(len(s), np.int64)
    context, own, more = np.zeros(len(s), np.uint64), np.zeros(len(s), np.int64), np.zeros(len(s), bool)
    for k, _, there, c, _ in grams[1:]:
        top[there] = k
        have = there & (counts[k] > 0)
        b = _lookup(often[1 - k], c)
        s = np.where(have, np.log(np.maximum(counts[k], 1)) - np.where(b > 0, np.log(np.maximum(b - own_c[k], 1)), 0.0), s)
        level[have], more = k, np.where(have, b == 0, more)
        context, own = np.where(have, c, context), np.where(have, own_c[k], own)
    return s + (top - level) * np.log(BACKOFF), (level < top).astype(np.int64), (level == 1).astype(np.int64), context, own, more


class _Chunks:
    """Documents by chunk and place in it, in one numbering of all that a task has met."""

    def __init__(self):
        self.names: list[tuple[int, int]] = []
        self.first: dict[int, int] = {}
        self.starts: list[int] = []
        self.total = 0

    def slots(self, names: np.ndarray, number: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The documents at a place of the chunk of that number among ``names`` (chunk, size)."""
        for chunk, size in names.tolist():
            if chunk not in self.first:
                self.first[chunk] = self.total
                self.names.append((chunk, size))
                self.starts.append(self.total)
                self.total += size
        return np.array([self.first[chunk] for chunk, _ in names.tolist()], np.int64)[number] + place

    def split(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the chunk and place in it."""
        starts = np.array(self.starts, np.int64)
        number = np.searchsorted(starts, slots, "right") - 1
        return number, slots - starts[number]


class _Sums:
    def __init__(self, chunks: _Chunks | None = None, n_buckets: int = 1):
        self.chunks, self.n_buckets = chunks, n_buckets
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, rid: np.ndarray, *cols: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Sums of s, words backed off and words alone. Those of the same document may come more than once; they go out when
        the different ones fill the memory set aside."""
        if len(rid):
            self.parts.append((rid, *cols))
            self.rows += len(rid)
        if self.rows >= HELD:
            self.parts = [self.merged()]
            self.rows = len(self.parts[0][0])
            if 2 * self.rows >= HELD:
                yield from self.rest()

    def merged(self) -> tuple[np.ndarray, ...]:
        rid, *cols = (np.concatenate(x) for x in zip(*self.parts))
        low = int(rid.min())
        if int(rid.max()) - low < 4 * HELD:
            at = rid - low
            there = np.flatnonzero(np.bincount(at))
            return there + low, *[np.bincount(at, x)[there] for x in cols]
        ids, at = np.unique(rid, return_inverse=True)
        return ids, *[np.bincount(at, x, len(ids)) for x in cols]

    def rest(self) -> Iterator[pa.RecordBatch]:
        """A row of kind -1, or a row of kind 4 for every chunk."""
        if self.parts:
            rid, s, *n = self.merged()
            self.parts, self.rows = [], 0
            if self.chunks is not None:
                number, place = self.chunks.split(rid)
                first = np.concatenate([[0], np.flatnonzero(np.diff(number)) + 1, [len(rid)]])
                rows = []
                for a, b in zip(first, first[1:]):
                    chunk = self.chunks.names[number[a]][0]
                    data = _planes(np.diff(place[a:b], prepend=0)) + s[a:b].astype("<f8").tobytes() + b"".join(_planes(x[a:b]) for x in n)
                    rows.append((chunk % self.n_buckets, 4, int(b - a), chunk.to_bytes(8, "little", signed=True) + pa.compress(data, "zstd", asbytes=True)))
                yield _batch(rows)
                return
            data = rid.astype("<i8").tobytes() + s.astype("<f8").tobytes() + b"".join(x.astype("<i8").tobytes() for x in n)
            yield _batch([(0, -1, len(rid), pa.compress(data, "zstd", asbytes=True))])


def _planes(x: np.ndarray) -> bytes:
    """Counts, lowest bytes first, so that the high ones are runs of zeros."""
    return np.ascontiguousarray(x.astype(np.int64).astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _flat(x: np.ndarray, n: int) -> list[np.ndarray]:
    """The columns of n counts that ``_planes`` made."""
    return [np.ascontiguousarray(c.T).view("<u4").ravel() for c in x.reshape(-1, 4, n)]


def _row(bucket: int, kind: int, hashes: list[np.ndarray], names: list[tuple[int, int]], number: np.ndarray, place: np.ndarray, counts: list[np.ndarray]) -> tuple:
    """The chunks, then what is compressed. Places follow as steps, which are small where documents lie in order."""
    data = b"".join([*[_six(x) for x in hashes], _planes(number), _planes(np.diff(place, prepend=0)), *[_planes(x) for x in counts]])
    head = np.array([(len(names), 0), *names], "<i8").tobytes()
    return bucket, kind, len(number), head + pa.compress(data, "zstd", asbytes=True)


class _Held:
    """Pairs to deal out, gathered over batches: a task makes one packed row a bucket and HELD pairs, whatever it reads."""

    def __init__(self, kind: int, n_buckets: int, n_hashes: int, chunks: _Chunks | None = None):
        self.kind, self.n_buckets, self.n_hashes, self.chunks = kind, n_buckets, n_hashes, chunks
        self.parts: list[list[np.ndarray]] = []
        self.rows = 0

    def add(self, key: np.ndarray, hashes: list[np.ndarray], rid: np.ndarray, counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        """Pairs that go to the bucket of their key; those of a document lie together. ``rid`` are numbers in ``chunks``, if there are any."""
        if len(key):
            self.parts.append([(wd.mixed(key) % np.uint64(self.n_buckets)).astype(np.int32), *hashes, rid, *[c.astype(np.uint32) for c in counts]])
            self.rows += len(key)
        if self.rows >= HELD:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            buckets, *cols = (np.concatenate(x) for x in zip(*self.parts))
            self.parts, self.rows = [], 0
            n, rows = self.n_hashes, []
            rid = cols[n]
            if self.chunks is None:
                # A new chunk: its documents are a row of kind 3. Its name follows from them, so it is the same in a task that is repeated.
                new = np.concatenate([[True], rid[1:] != rid[:-1]])
                docs = rid[new].astype("<i8").tobytes()
                chunk = int.from_bytes(hashlib.blake2b(docs, digest_size=8).digest(), "little", signed=True)
                number, place, names = np.zeros(len(rid), np.int64), np.cumsum(new) - 1, [(chunk, len(docs) // 8)]
                if self.kind == 0:
                    rows.append((chunk % self.n_buckets, 3, 0, chunk.to_bytes(8, "little", signed=True) + docs))
            else:
                number, place = self.chunks.split(rid)
            order = np.argsort(buckets, kind="stable")
            limits = np.flatnonzero(np.diff(buckets[order])) + 1
            for part in np.split(order, limits):
                of = number[part]
                if self.chunks is not None:
                    used, of = np.unique(of, return_inverse=True)
                    names = [self.chunks.names[i] for i in used]
                rows.append(_row(int(buckets[part[0]]), self.kind, [c[part] for c in cols[:n]], names, of, place[part], [c[part] for c in cols[n + 1:]]))
            yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int64(), pa.binary()))], NAMES)


def _unpacked(rows: list[tuple[int, bytes]], n_hashes: int, n_counts: int, chunks: _Chunks) -> list[np.ndarray]:
    """Hashes, documents numbered by ``chunks`` and counts of packed rows, each in one array that is filled row by row."""
    total, at = sum(n for n, _ in rows), 0
    out = [np.empty(total, t) for t in (*[np.uint64] * n_hashes, np.int64, *[np.uint32] * n_counts)]
    for n, data in rows:
        n_names = int.from_bytes(data[:8], "little")
        names = np.frombuffer(data, "<i8", 2 * n_names, 16).reshape(-1, 2)
        x = np.frombuffer(pa.decompress(memoryview(data)[16 + 16 * n_names:], n * (6 * n_hashes + 8 + 4 * n_counts), "zstd", asbytes=True), np.uint8)
        hashes, rest = np.split(x, [6 * n_hashes * n])
        number, step, *counts = _flat(rest, n)
        rid = chunks.slots(names, number, np.cumsum(step, dtype=np.uint32).astype(np.int64))
        for to, part in zip(out, [*map(_eight, hashes.reshape(n_hashes, -1)), rid, *counts]):
            to[at:at + n] = part
        at += n
    return out


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, list[tuple[int, bytes]]]]:
    """Rows sorted by bucket, a bucket at a time, by kind."""
    now, held = None, {}
    for batch in batches:
        for bucket, kind, *rest in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != now:
                if held:
                    yield held
                now, held = bucket, {}
            held.setdefault(kind, []).append(rest)
    if held:
        yield held


def _by_bucket(df: DataFrame) -> DataFrame:
    return df.repartition("bucket").sortWithinPartitions("bucket")


def _by_document(df: DataFrame) -> DataFrame:
    """Rows of kinds 3 and 4 as rid, s, n, alone: the sums of a chunk added up, a row per document of it."""
    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for kinds in _buckets(batches):
            docs = {data[:8]: np.frombuffer(data, "<i8", offset=8) for _, data in kinds[3]}
            sums = {chunk: [np.zeros(len(rid)) for _ in range(3)] for chunk, rid in docs.items()}
            for n, data in kinds.get(4, []):
                x = np.frombuffer(pa.decompress(memoryview(data)[8:], 20 * n, "zstd", asbytes=True), np.uint8)
                place = np.cumsum(_flat(x[:4 * n], n)[0], dtype=np.uint32)
                for to, part in zip(sums[data[:8]], [x[4 * n:12 * n].view("<f8"), *_flat(x[12 * n:], n)]):
                    to[place] += part
            for chunk, (s, n, alone) in sums.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[chunk]), pa.array(s), pa.array(n.astype(np.int64)), pa.array(alone.astype(np.int64))], ["rid", "s", "n", "alone"])

    # Dealt as buckets are, by the chunk.
    dealt = df.where("kind in (3, 4)").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(added, "rid long, s double, n long, alone long")


def _sums_of(df: DataFrame) -> DataFrame:
    """The rows of kind -1 as rid, s, n, alone."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, data in zip(*(c.to_pylist() for c in batch.columns)):
                x = pa.decompress(data, 32 * n, "zstd", asbytes=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(x, t, n, 8 * n * i)) for i, t in enumerate(("<i8", "<f8", "<i8", "<i8"))], ["rid", "s", "n", "alone"])

    return df.where("kind = -1").select("n", "data").mapInArrow(unpack, "rid long, s double, n long, alone long")


def score(docs: DataFrame, order: int = 2) -> DataFrame:
    """doc_id, n_words, n_backed_off, log_score for every row of ``docs`` (doc_id, text); n-grams of up to ``order`` words."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    docs = docs.select("doc_id", whole_text().alias("text"), F.xxhash64("doc_id", "text").alias("rid"))
    groups, total = _grouped(docs, order)
    often = _frequent(docs, groups, total, order)
    shared = spark.sparkContext.broadcast(often)
    n_buckets = _n_buckets(total, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def read(batches: Iterator[pa.RecordBatch], pairs_only: bool) -> Iterator[pa.RecordBatch]:
        """The pairs to deal out (kind 0), or what is small beside them: contexts (1) and sums of what is scored here (-1)."""
        often, sums, held = shared.value, _Sums(), _Held(0, n_buckets, order) if pairs_only else _Held(1, n_buckets, 1)
        for batch in batches:
            rids = batch.column(1).to_numpy()
            for first, h, row in _words(batch.column(0)):
                if not len(h):
                    continue
                windows = _windows(h, row, order)
                if not pairs_only:
                    # Contexts of the batch with their counts, for the second dealing.
                    for k, _, there, c in _grams(windows):
                        if k > 1:
                            c, n = np.unique(c[there], return_counts=True)
                            seldom = _lookup(often[1 - k], c) == 0
                            c, n = c[seldom], n[seldom]
                            yield from held.add(c, [c], np.zeros(len(c), np.int64), [n])
                pair = wd.mixed(_gram(windows) * wd._STEP + row.astype(np.uint64))
                # Of the few that are scored here, the others are not told apart first.
                among = slice(None) if pairs_only else np.flatnonzero(_dealt(often, windows)[2])
                pair = pair[among]
                _, at, m = np.unique(pair, return_index=True, return_counts=True)
                by_place = np.argsort(at)
                at, m = at[by_place], m[by_place]
                if not pairs_only:
                    at = among[at]
                xs, r = [x[at] for x in windows], rids[first + row[at]]
                grams, key, now = _dealt(often, xs)
                # What has all its counts is scored here: frequent pairs, and frequent words at the start.
                wanted = np.flatnonzero(now != pairs_only)
                if not len(wanted):
                    continue
                own_g, own_c = {order: m[wanted]}, {}
                for k, g, there, c in _grams(windows):
                    if k < order:
                        own_g[k] = _own(row, g, at[wanted])
                    if k > 1:
                        own_c[k] = np.where(there[at[wanted]], _own(row, c, at[wanted]), 0)
                m, r = m[wanted], r[wanted]
                if pairs_only:
                    counts = [own_g[k] for k in range(order, 0, -1)] + [own_c[k] for k in range(order, 1, -1)]
                    yield from held.add(key[wanted], [x[wanted] for x in xs], r, counts)
                else:
                    grams = [(k, *[x if x is None else x[wanted] for x in rest]) for k, *rest in grams]
                    s, back, alone, *_ = _chosen(often, grams, {k: f - own_g[k] for k, *_, f in grams}, own_c)
                    yield from sums.add(r, m * s, m * back, m * alone)
        yield from held.rest()
        yield from sums.rest()

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _Chunks()
        often, sums, held = shared.value, _Sums(chunks, n_buckets), _Held(2, n_buckets, 1, chunks)
        for kinds in _buckets(batches):
            if 3 in kinds:
                yield _batch([(int.from_bytes(data[:8], "little", signed=True) % n_buckets, 3, n, data) for n, data in kinds[3]])
            if 0 not in kinds:
                continue
            # A part of the bucket at a time, by the key that dealt it.
            cols = _unpacked(kinds.pop(0), order, 2 * order - 1, chunks)
            of = (wd.mixed(_dealt(often, cols[:order])[1]) >> np.uint64(61)).astype(np.uint8)
            for part in range(8):
                yield from scored(often, sums, held, [c[of == part] for c in cols])
        yield from held.rest()
        yield from sums.rest()

    def scored(often: dict, sums: _Sums, held: _Held, cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        xs, rid, counts = cols[:order], cols[order], [x.astype(np.int64) for x in cols[order + 1:]]
        if len(rid):
            m, own_g = counts[0], dict(zip(range(order, 0, -1), counts))
            own_c = dict(zip(range(order, 1, -1), counts[order:]))
            grams, elsewhere = _dealt(often, xs)[0], {}
            for k, g, there, _, f in grams:
                _, at = np.unique(g, return_inverse=True)
                elsewhere[k] = np.where(f > 0, f, np.bincount(at, m)[at].astype(np.int64)) - own_g[k]
            s, back, alone, context, own, more = _chosen(often, grams, elsewhere, own_c)
            yield from sums.add(rid, m * s, m * back, m * alone)
            yield from held.add(context[more], [context[more]], rid[more], [m[more], own[more]])

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = _Chunks()
        sums = _Sums(chunks, n_buckets)
        for kinds in _buckets(batches):
            if 2 not in kinds:
                continue
            c, _, n = _unpacked(kinds[1], 1, 1, _Chunks())
            keys, at = np.unique(c, return_inverse=True)
            v, rid, m, own = _unpacked(kinds[2], 1, 2, chunks)
            b = _lookup((keys, np.bincount(at, n.astype(np.int64)).astype(np.int64)), v) - own.astype(np.int64)
            none = np.zeros(len(m))
            yield from sums.add(rid, -m.astype(np.int64) * np.log(np.maximum(b, 1)), none, none)
        yield from sums.rest()

    # The pairs are as large as the corpus: they are moved once and never written.
    dealt = docs.select("text", "rid").mapInArrow(lambda b: read(b, True), _PACKED)
    second = written(_by_bucket(dealt).mapInArrow(pairs, _PACKED), "lm-pairs")
    first = written(docs.select("text", "rid").mapInArrow(lambda b: read(b, False), _PACKED), "lm-contexts")
    third = _by_bucket(first.where("kind = 1").unionByName(second.where("kind = 2"))).mapInArrow(contexts, _PACKED)
    sums = _sums_of(first).unionByName(_by_document(second.unionByName(third))).groupBy("rid").agg(F.sum("s").alias("s"), F.sum("n").alias("n"), F.sum("alone").alias("alone"))
    # Rows that are the same share a number; each has its part of the sums.
    sized = docs.select("doc_id", "rid", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"))
    alike = sized.groupBy("rid").agg(F.count(F.lit(1)).alias("k"))
    joined = sized.join(sums, "rid", "left").join(alike, "rid")
    backed, alone = (F.coalesce(F.round(F.col(c) / F.col("k")), F.lit(0)).cast("long") for c in ("n", "alone"))
    rest = F.log(F.greatest(F.lit(total) - F.col("n_words"), F.lit(1)).cast("double"))
    value = F.coalesce(F.col("s") / F.col("k"), F.lit(0.0)) - alone * rest
    return joined.select(
        "doc_id", "n_words", backed.alias("n_backed_off"), F.when(F.col("n_words") > 0, value).otherwise(0.0).alias("log_score"))
