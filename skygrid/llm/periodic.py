"""Runs of repeated words: maximal periodic stretches, found with extensions over a difference cover.

A run is a stretch of words with smallest period q, at least ``LEAST`` words and two periods long, which no neighbouring
word extends keeping that period.

*Extensions.* The texts of a batch are one array of word numbers with a number of its own after each text. Only the suffixes at
places whose remainder modulo ``MODULUS`` is in ``COVER`` are sorted, by their first words and then by doubling along the
places one modulus further, which are covered too. Any two places are followed, within fewer than MODULUS words, by two
covered ones at the same distance: an extension compares those few words, and from there on is the least common prefix
between two ranks, looked up in a sparse table. The same on the reversed array extends to the left.

*Harmonic grid.* A run of period q covers a multiple i of q at which words i and i + q are equal. For all q there are n log n such
places; those whose words and a neighbour's agree are extended both ways, and the stretch is a run if it is long enough.
The same stretch is also found for multiples of its period; the smallest one stays.

All work on a document is in the task that reads it, nothing is shuffled. Very long texts: the grid is worked through in blocks
of ``BLOCK`` words, so memory is in proportion to the text. Defined results: a null or empty text has no words and no
runs; equal rows give equal results; an empty table gives an empty result; other columns are ignored whatever their names.
Among longest runs the leftmost, then the one of smaller period, counts as first.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

LEAST = 12
# A perfect difference set: every difference modulo 31 occurs once.
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
BLOCK = 1 << 15
# Words whose suffixes are sorted together, unless one text has more.
TOGETHER = 1 << 18

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


def _meeting_points() -> np.ndarray:
    """For each difference d the residue r of the cover with r + d in it too."""
    out = np.zeros(MODULUS, np.int64)
    for r in COVER:
        for s in COVER:
            out[(s - r) % MODULUS] = r
    return out


class Extensions:
    """Common prefixes of any two suffixes of an array whose last number occurs once."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        self.x = x
        self.meet = _meeting_points()
        covered = np.zeros(MODULUS, bool)
        covered[list(COVER)] = True
        place = np.flatnonzero(covered[np.arange(n) % MODULUS])
        self.index = np.full(n + 1, -1, np.int64)
        self.index[place] = np.arange(len(place))
        self.rank, levels = self._sorted(place)
        self._table(place, levels)

    def _sorted(self, place: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Ranks of the covered suffixes, and those by their first MODULUS * 2^k words."""
        padded = np.concatenate([self.x, np.zeros(MODULUS, np.int64)])
        bits = max(1, int(padded.max()).bit_length())
        packed = max(1, 62 // bits)
        rank = np.zeros(len(place), np.int64)
        tied = np.arange(len(place))
        for t in range(0, MODULUS, packed):
            key = np.zeros(len(tied), np.int64)
            for d in range(t, min(t + packed, MODULUS)):
                key = (key << bits) | padded[place[tied] + d]
            tied = _refined(rank, tied, key)
        levels, step = [rank.copy()], MODULUS
        while len(tied):
            # A tied suffix has a covered one at this distance: its own last number would have told it apart.
            tied = _refined(rank, tied, rank[self.index[place[tied] + step]])
            levels.append(rank.copy())
            step *= 2
        return rank, levels

    def _table(self, place: np.ndarray, levels: list[np.ndarray]) -> None:
        order = np.empty(len(place), np.int64)
        order[self.rank] = place
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            same = levels[k][self.index[a]] == levels[k][self.index[b]]
            far = same * (MODULUS << k)
            a += far
            b += far
            common += far
        live = np.arange(len(a))
        while len(live):
            live = live[self.x[a[live]] == self.x[b[live]]]
            a[live] += 1
            b[live] += 1
            common[live] += 1
        self.least = [common.astype(np.int32)]
        width = 1
        while 2 * width <= len(common):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes at i and j (different places)."""
        out = np.zeros(len(i), np.int64)
        ahead = (self.meet[(j - i) % MODULUS] - i) % MODULUS
        live = np.arange(len(i))
        synchronised = []
        t = 0
        while len(live):
            there = ahead[live] == t
            synchronised.append(live[there])
            live = live[~there]
            live = live[self.x[i[live] + t] == self.x[j[live] + t]]
            t += 1
            out[live] = t
        live = np.concatenate(synchronised) if synchronised else live
        r, s = (self.rank[self.index[p[live] + ahead[live]]] for p in (i, j))
        lo, hi = np.minimum(r, s), np.maximum(r, s)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        for k in range(len(self.least)):
            here = level == k
            if here.any():
                table = self.least[k]
                out[live[here]] += np.minimum(table[lo[here]], table[hi[here] - (1 << k)])
        return out


def _refined(rank: np.ndarray, tied: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Splits groups of equal rank by a key, in place; returns what is still tied."""
    order = np.lexsort((key, rank[tied]))
    tied, key = tied[order], key[order]
    r = rank[tied]
    group = np.append(True, r[1:] != r[:-1])[:len(r)]
    part = group | np.append(True, key[1:] != key[:-1])[:len(r)]
    at = np.arange(len(r))
    starts = np.maximum.accumulate(np.where(part, at, 0))
    rank[tied] = r + starts - np.maximum.accumulate(np.where(group, at, 0))
    alone = part & np.append(part[1:], True)[:len(r)]
    return tied[~alone]


class Grid:
    """Multiples j of q with j - q in the text, by j: those of a short text are the head of a longer one's."""

    def __init__(self):
        self.size, self.j, self.q, self.upto = 0, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)

    @staticmethod
    def made(lo: int, hi: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """(j, q) for lo <= j < hi and divisors q <= most."""
        q = np.arange(1, most + 1)
        before = (lo - 1) // q
        count = (hi - 1) // q - before
        q, count, before = q[count > 0], count[count > 0], before[count > 0]
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        q_all = np.repeat(q, count)
        return q_all * (np.repeat(before, count) + 1 + nth), q_all

    def blocks(self, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        need = min(n, BLOCK)
        if need > self.size:
            self.size = min(BLOCK, max(2 * need, 1024))
            j, q = self.made(1, self.size, self.size)
            order = np.argsort(j, kind="stable")
            self.j, self.q = j[order], q[order]
            self.upto = np.searchsorted(self.j, np.arange(self.size + 1))
        yield self.j[:self.upto[need]], self.q[:self.upto[need]]
        for lo in range(BLOCK, n, BLOCK):
            yield self.made(lo, min(n, lo + BLOCK), n // 2)


def _likely(w: np.ndarray, j: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The grid places whose words, and those on one side of them, are equal: no shorter agreement makes a run."""
    same = np.flatnonzero(w[j] == w[j - q])
    j, q = j[same], q[same]
    # Numbers of words are positive; at the ends of the text nothing agrees.
    edged = np.concatenate([[-1], w, [-2]])
    side = (edged[j + 2] == edged[j - q + 2]) | ((j > q) & (edged[j] == edged[j - q]))
    side &= 2 * q <= len(w)
    return j[side], q[side]


def runs_of(texts: list[np.ndarray], grid: Grid | None = None, least: int = LEAST) -> list[np.ndarray]:
    """Rows (start, length, period) of the runs of each array of word numbers, by start, then period."""
    grid = grid or Grid()
    sizes = np.array([len(w) for w in texts], np.int64)
    first = np.cumsum(sizes + 1) - (sizes + 1)
    total = int(sizes.sum()) + len(texts)
    x = np.empty(total, np.int64)
    for k, w in enumerate(texts):
        x[first[k]:first[k] + len(w)] = w + len(texts)
        x[first[k] + len(w)] = k
    both: list[Extensions] = []
    found = [np.zeros((0, 4), np.int64)]
    held: list[tuple[int, np.ndarray, np.ndarray]] = []

    def extended() -> None:
        if not held:
            return
        if not both:
            # Reversed, the text ends where it began: a number before it that occurs nowhere else.
            both.extend([Extensions(x), Extensions(np.append(x[::-1], np.int64(x.max() + 1)))])
        k = np.concatenate([np.full(len(j), k) for k, j, _ in held])
        j = np.concatenate([j for _, j, _ in held]) + first[k]
        q = np.concatenate([q for _, _, q in held])
        held.clear()
        ahead = both[0].common(j - q, j)
        # The words before j are those from total - j on in the reversed array.
        behind = both[1].common(total - j + q, total - j)
        good = (ahead + behind >= q) & (ahead + behind + q >= least)
        start = (j - q - behind - first[k])[good]
        rows = np.column_stack([k[good], start, (ahead + behind + q)[good], q[good]])
        found.append(np.unique(rows, axis=0))

    waiting = 0
    for k, w in enumerate(texts):
        for j, q in grid.blocks(len(w)) if len(w) >= least else ():
            j, q = _likely(w, j, q)
            if len(j):
                held.append((k, j, q))
                waiting += len(j)
                if waiting > 16 * BLOCK:
                    extended()
                    waiting = 0
    extended()
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 3], rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.append(True, (rows[1:, :3] != rows[:-1, :3]).any(axis=1))[:len(rows)]
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    cut = np.searchsorted(rows[:, 0], np.arange(len(texts) + 1))
    return [rows[cut[k]:cut[k + 1], 1:] for k in range(len(texts))]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The text without what a run repeats: every word that a run contains after its first period goes."""
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.flatnonzero(np.cumsum(edge)[:-1] == 0)
    return b" ".join(map(words.__getitem__, kept.tolist()))


def collapse(docs: DataFrame, rewrite: Rewrite | None = None, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period by start, then period), collapsed (binary) for every row (doc_id, text).

    ``rewrite`` may change the words of a document before they are searched.
    """
    def solved(ids: list, words: list[list[bytes]], grid: Grid) -> pa.RecordBatch:
        number: dict[bytes, int] = {}
        texts = [np.array([number.setdefault(w, len(number)) for w in ws], np.int64) for ws in words]
        runs = runs_of(texts, grid, least)
        rows = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        cut = np.cumsum([0] + [len(r) for r in runs])
        items = pa.StructArray.from_arrays([pa.array(rows[:, c]) for c in range(3)], ["start", "length", "period"])
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(ws) for ws in words], pa.int64()), pa.ListArray.from_arrays(pa.array(cut, pa.int32()), items),
             pa.array([collapsed(ws, r) for ws, r in zip(words, runs)], pa.binary())], ["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = Grid()
        for batch in batches:
            at, held, size = 0, [], 0
            ids = batch.column(0)
            texts = batch.column(1).cast(pa.binary())
            for i in range(batch.num_rows):
                # Without arguments, split cuts at runs of the six blanks of ASCII.
                words = (texts[i].as_py() or b"").split()
                held.append(rewrite(ids[i].as_py(), words) if rewrite else words)
                size += len(words)
                if size >= TOGETHER:
                    yield solved(ids.slice(at, len(held)), held, grid)
                    at, held, size = i + 1, [], 0
            if held:
                yield solved(ids.slice(at, len(held)), held, grid)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")


def one_in_ten(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents (by checksum of doc_id) with a stretch of words repeated to the end; no doc_id, no change."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]
