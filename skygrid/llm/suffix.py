"""Removal of repeated strings with suffix arrays, built by Lyndon grouping in linear time.

A byte goes when a string of ``LENGTH`` bytes that covers it starts anywhere else too, in any document, overlaps
included. Texts are compared as UTF-8 bytes and every decision is on the input.

*Anchors.* The anchor of a window of LENGTH bytes is its string of ``ANCHOR`` bytes with the least hash, leftmost. Equal
windows have equal anchors at equal places, so a window whose anchor occurs once cannot repeat. Anchors are
counted over the whole corpus, and only documents with repeated ones go on.

*Pieces.* Up to ``STARTS`` windows round one place of an anchor share a core of LENGTH - STARTS + 1 bytes; they
differ only by bytes to its left and right. Pieces with the same core (a 64-bit hash of it) are a class, and in it
the core is one symbol: a window is STARTS symbols of left bytes, core and right bytes.

*Suffix arrays.* Of the different pieces of a class, joined by separators, the suffix array tells which windows begin
alike: neighbours in it with STARTS symbols in common. It is built by Lyndon grouping. Suffixes are grouped by their Lyndon
prefix: groups are taken in descending order, each member finds the previous smaller suffix through pointers already set,
and those found move to new groups behind their own, by how many members point to them. Then groups are emitted
in ascending order, a suffix following the suffix that comes after its Lyndon prefix. No ranks are renamed.
A piece that occurs twice repeats as a whole and needs no array. A class with more than ``CLASS`` different pieces (a
passage's edge in very many documents) is not one task: its windows are counted one by one with partial sums.

Defined results: null and empty texts have no bytes and lose none; rows that are the same repeat each other; an empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skygrid.llm import words as wd
from skygrid.llm.common import whole_text, written
from skygrid.llm.filters import filter_bits, may_hold

LENGTH = 400
ANCHOR = 150
STARTS = 32
CLASS = 4096
JOINED = 1 << 15
_LOW = np.uint64((1 << 24) - 1)


def suffix_array(t: Sequence[int]) -> list[int]:
    """Starts of the suffixes of ``t`` in ascending order; linear in its length."""
    n = len(t)
    symbols = sorted(set(t))
    name = {c: g for g, c in enumerate(symbols)}
    group = [name[c] for c in t]
    members: list[list[int]] = [[] for _ in symbols]
    for s, g in enumerate(group):
        members[g].append(s)
    size = [1] * len(symbols)
    lower = list(range(-1, len(symbols) - 1))
    upper = list(range(1, len(symbols) + 1))
    if upper:
        upper[-1] = -1
    done = [False] * len(symbols)
    smaller = [-1] * n
    final: list[tuple[int, list[int]]] = []
    g = len(symbols) - 1
    while g >= 0:
        mine = [s for s in members[g] if group[s] == g]
        if mine:
            mine.sort()
            done[g] = True
            final.append((g, mine))
            hits: dict[int, int] = {}
            for s in mine:
                p = s - 1
                while p >= 0 and done[group[p]]:
                    p = smaller[p]
                smaller[s] = p
                if p >= 0:
                    hits[p] = hits.get(p, 0) + 1
            moved: dict[tuple[int, int], list[int]] = {}
            for p, c in hits.items():
                moved.setdefault((-c, group[p]), []).append(p)
            # More hits make the larger suffix: of one group's new ones, those with most hits end up on top.
            for (c, h), ps in sorted(moved.items()):
                new, above = len(size), upper[h]
                size.append(size[h] - c * size[g])
                members.append(ps)
                done.append(False)
                lower.append(h)
                upper.append(above)
                upper[h] = new
                if above >= 0:
                    lower[above] = new
                for p in ps:
                    group[p] = new
        g = lower[g]
    at, place = 0, {}
    for g, mine in reversed(final):
        place[g] = at
        at += len(mine)
    follows: list[list[int]] = [[] for _ in range(n + 1)]
    for s in range(n):
        follows[s + size[group[s]]].append(s)
    out = [0] * n
    for r in range(-1, n):
        for s in follows[out[r] if r >= 0 else n]:
            out[place[group[s]]] = s
            place[group[s]] += 1
    return out


def _prefix_hash(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    powers = np.full(len(b) + 1, wd._STEP, np.uint64)
    powers[0] = 1
    back = np.full(len(b) + 1, wd._BACK, np.uint64)
    back[0] = 1
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(wd._BYTE[b] * np.multiply.accumulate(powers)[:-1], out=total[1:])
    return total, np.multiply.accumulate(back)


def anchor_runs(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first start, number of starts) for the runs of windows with the same anchor."""
    none = np.zeros(0, np.int64)
    if len(b) < LENGTH:
        return none.astype(np.uint64), none, none, none
    total, back = _prefix_hash(b)
    h = wd.mixed((total[ANCHOR:] - total[:-ANCHOR]) * back[:len(b) - ANCHOR + 1])
    m, w = len(h), LENGTH - ANCHOR + 1
    place = np.arange(m, dtype=np.uint64)
    # Least hash, leftmost among equal ones; places stay below 2^24 inside a stride of windows.
    out = []
    for a in range(0, m - w + 1, (1 << 23)):
        part = slice(a, min(m, a + (1 << 23) + w - 1))
        v = (h[part] & ~_LOW) | (place[part] - np.uint64(a))
        k = len(v)
        grid = np.concatenate([v, np.full(-k % w, ~np.uint64(0))]).reshape(-1, w)
        ahead = np.minimum.accumulate(grid, axis=1).ravel()
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        out.append((np.minimum(behind[:k - w + 1], ahead[w - 1:k]) & _LOW).astype(np.int64) + a)
    at = np.concatenate(out)
    first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
    return h[at[first]], at[first], first, np.diff(np.append(first, len(at)))


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    data, off = wd.buffers(column)
    for i in range(len(off) - 1):
        yield data[off[i]:off[i + 1]]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [anchor_runs(b) for b in _texts(batch.column(1))]
        rows = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        h, at, first, n = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(4))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows)), pa.array(h.view(np.int64)), *[pa.array(x.astype(np.int64)) for x in (at, first, n)]],
            ["rid", "anchor", "place", "first", "n"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rid, text, runs) to rows (key, left, right, rid, core)."""
    span = LENGTH - STARTS + 1
    for batch in batches:
        key, left, right, rids, cores = [], [], [], [], []
        for rid, b, runs in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), batch.column(2).to_pylist()):
            total, back = _prefix_hash(b)
            raw = b.tobytes()
            start, above = [], []
            for r in sorted({(r["place"], r["first"], r["n"]) for r in runs}):
                place, first, n = r
                # Starts place - STARTS * j - x with x below STARTS have the core that begins at place - STARTS * j.
                lo, hi = (place - (first + n - 1)) // STARTS, (place - first) // STARTS
                for j in range(lo, hi + 1):
                    c = place - STARTS * j
                    s, e = max(first, c - STARTS + 1), min(first + n - 1, c)
                    left.append(raw[s:c])
                    right.append(raw[c + span:e + LENGTH])
                    start.append(c)
                    rids.append(rid)
            c = np.array(start, np.int64)
            cores += start
            if len(c):
                key.append(wd.mixed((total[c + span] - total[c]) * back[c]))
        keys = np.concatenate(key).view(np.int64) if key else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), pa.array(left, pa.binary()), pa.array(right, pa.binary()), pa.array(rids, pa.int64()), pa.array(cores, pa.int64())],
            ["key", "left", "right", "rid", "core"])


def repeated_windows(classes: list[list[tuple[bytes, bytes, int]]]) -> list[list[int]]:
    """For each (left, right, count) of each class, the windows that occur elsewhere too: bit x stands for the one
    that begins x bytes left of the core."""
    masks = [[0] * len(c) for c in classes]
    text: list[int] = []
    owner: list[tuple[int, int, int]] = []
    for i, pieces in enumerate(classes):
        for j, (left, right, count) in enumerate(pieces):
            windows = range(STARTS - 1 - len(right), len(left) + 1)
            if count > 1:
                masks[i][j] = sum(1 << x for x in windows)
            elif len(pieces) == 1:
                continue
            if len(pieces) == 1:
                continue
            at = len(text)
            text += [b + 1 for b in left]
            text.append(257 + i)
            text += [b + 1 for b in right]
            text.append(0)
            owner += [(i, j, len(left) - k) if k <= len(left) - windows.start else (-1, -1, -1) for k in range(len(text) - at)]
    last, last_text = -1, None
    for s in suffix_array(text):
        if owner[s][0] < 0:
            continue
        now = text[s:s + STARTS]
        if now == last_text:
            for i, j, x in (owner[last], owner[s]):
                masks[i][j] |= 1 << x
        last, last_text = s, now
    return masks


def _masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, piece, left, right, n) sorted by key to rows (key, piece, mask); a class is bounded, some share an array."""
    held: list[tuple[int, list[tuple[bytes, bytes, int]]]] = []
    names: list[list[int]] = []
    size = 0

    def solved() -> pa.RecordBatch:
        masks = repeated_windows([c for _, c in held])
        rows = [(k, i, m) for (k, c), ids, ms in zip(held, names, masks) for i, m in zip(ids, ms) if m]
        cols = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["key", "piece", "mask"])

    for batch in batches:
        for k, piece, left, right, n in zip(*(c.to_pylist() for c in batch.columns)):
            if not held or held[-1][0] != k:
                if size > JOINED:
                    yield solved()
                    held, names, size = [], [], 0
                held.append((k, []))
                names.append([])
            held[-1][1].append((left, right, n))
            names[-1].append(piece)
            size += len(left) + len(right) + 2
    if held:
        yield solved()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (rid, text, found: core and mask) to rows (rid, n_removed, n_spans, kept)."""
    for batch in batches:
        removed, spans, kept = [], [], []
        for b, found in zip(_texts(batch.column(1)), batch.column(2).to_pylist()):
            edge = np.zeros(len(b) + 1, np.int64)
            core = np.array([f["core"] for f in found], np.int64)
            mask = np.array([f["mask"] for f in found], np.int64)
            for x in range(STARTS):
                s = core[(mask >> x) & 1 == 1] - x
                np.add.at(edge, s, 1)
                np.add.at(edge, s + LENGTH, -1)
            gone = np.cumsum(edge)[:-1] > 0
            removed.append(int(gone.sum()))
            spans.append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()))
            kept.append(b[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["rid", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, outcome: Callable[[Column], Column] = lambda rest: rest) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and ``rest`` for every row (doc_id, text).

    ``rest`` is what ``outcome`` makes of the remaining bytes (binary): the bytes themselves, or a digest of them when
    the texts need not be moved.
    """
    whole = F.col("text").cast("binary")
    docs = docs.select("doc_id", whole_text().alias("text"), F.xxhash64("doc_id", "text").alias("rid"))
    runs = written(docs.select("rid", "text").mapInArrow(_runs, "rid long, anchor long, place long, first long, n long"), "suffix-anchors")
    # Written, so that the join below is between two shuffles and a hot anchor's rows can be split.
    twice = written(runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("anchor"), "suffix-repeated")
    wanted = written(
        runs.join(twice, "anchor").groupBy("rid").agg(F.collect_set(F.struct("place", "first", "n")).alias("runs")), "suffix-wanted")
    shared = docs.sparkSession.sparkContext.broadcast(filter_bits(wanted, "rid"))

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch if shared.value is None else batch.filter(pa.array(may_hold(shared.value, batch.column(0).to_numpy())))

    texts = written(docs.select("rid", "text").mapInArrow(asked, "rid long, text string").join(wanted, "rid"), "suffix-texts")

    occurring = texts.select("rid", "text", "runs").mapInArrow(_pieces, "key long, left binary, right binary, rid long, core long")
    # A piece goes by the hash of its bytes beside the core; the bytes are moved once, for the arrays.
    named = occurring.select("key", F.xxhash64("left", F.lit(0), "right").alias("piece"), "left", "right", "rid", "core")
    pieces = written(named.groupBy("key", "piece", "left", "right").agg(F.count(F.lit(1)).alias("n")), "suffix-pieces")
    crowd = pieces.groupBy("key").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > CLASS).select("key")
    crowd = written(crowd, "suffix-crowd")
    few = pieces.join(crowd, "key", "left_anti").repartition("key").sortWithinPartitions("key").select("key", "piece", "left", "right", "n")
    masks = few.mapInArrow(_masks, "key long, piece long, mask long")
    window = F.explode(F.sequence(STARTS - 1 - F.length("right"), F.length("left"))).alias("x")
    each = pieces.join(crowd, "key").select("key", "piece", "left", "right", "n", window).select(
        "key", "piece", "n", "x", F.expr("substring(left, length(left) - x + 1, x)").alias("l"), F.expr(f"substring(right, 1, {STARTS - 1} - x)").alias("r"))
    more = each.groupBy("key", "x", "l", "r").agg(F.sum("n").alias("k")).where("k > 1").select("key", "x", "l", "r")
    crowded = each.join(more, ["key", "x", "l", "r"]).groupBy("key", "piece").agg(F.bit_or(F.expr("shiftleft(1L, x)")).alias("mask"))
    found = written(masks.unionByName(crowded), "suffix-masks")

    hits = named.select("key", "piece", "rid", "core").join(found, ["key", "piece"]).groupBy("rid").agg(F.collect_set(F.struct("core", "mask")).alias("found"))
    cut = texts.select("rid", "text").join(hits, "rid").select("rid", "text", "found").mapInArrow(
        _cut, "rid long, n_removed long, n_spans long, kept binary")
    # Rows that are the same have one number and one result.
    cut = cut.select("rid", "n_removed", "n_spans", outcome(F.col("kept")).alias("_kept")).dropDuplicates(["rid"])
    same = docs.select("doc_id", "rid", F.octet_length("text").cast("long").alias("n_bytes"), outcome(whole).alias("_whole"))
    return same.join(cut, "rid", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("_kept", "_whole").alias("rest"))
