"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

*Vectors.* Tokens are runs of letters, of digits or of other signs. Each is hashed to one of 2^14 entries; every
entry has a fixed sparse index vector of +1 and -1. The context of an entry is the sum of the index vectors of its
neighbours (two on either side) over every occurrence in the whole corpus: whole numbers, summed per task, then per
entry. A few more entries stand for shapes (capitals, digits, signs). The vector of an entry is its index
vector and its context, scaled to one length each.

*Document.* The mean of the vectors of its tokens and shapes, how often a token repeats the one
before it, and the logarithm of their number.

*Network.* One hidden layer, trained with numpy on the pooled documents of at most ``max_rows`` labelled rows outside the
held-out fold (bounded and documented; the rows with the smallest hash of doc_id). A tenth of them is set aside to fit
the temperature that divides the scores before they become probabilities.

Defined results: null and empty texts pool to zeros and get the network's score of that; rows without doc_id are not held
out; without any labels every score is 0.5; repeated labels count as often as they occur; an empty table gives an empty
result. Other columns are ignored by the score and carried along by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skygrid.llm import words as wd

BITS = 14
DIM = 48
SIGNS = 4
SHAPES = 16
WINDOW = 2
HIDDEN = 32
MAX_ROWS = 20_000
THRESHOLD = 0.3
ENTRIES = (1 << BITS) + SHAPES
SLICE = 1 << 19
# Kinds of bytes: 0 blank, 1 letter (any byte of a letter outside ASCII too), 2 digit, 3 other.
_KIND = np.full(256, 3, np.uint8)
_KIND[128:] = 1
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 2
_KIND[wd.BLANK] = 0


def held_out(doc_id: str | Column = "doc_id") -> Column:
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def index_vectors(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the non-zero parts of every entry."""
    rng = np.random.default_rng(seed)
    places = np.argsort(rng.random((ENTRIES, DIM)), axis=1)[:, :SIGNS]
    return places, rng.choice([-1.0, 1.0], (ENTRIES, SIGNS))


def tokens(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, entries of tokens, entries of their shapes, offsets per row) of successive slices."""
    data, off = wd.buffers(texts)
    for a, b in wd.slices(off, SLICE):
        part = data[off[a]:off[b]]
        cuts = off[a:b + 1] - off[a]
        kind = _KIND[part]
        change = np.ones(len(part), bool)
        change[1:] = kind[1:] != kind[:-1]
        change[cuts[cuts < len(part)]] = True
        limits = np.flatnonzero(change)
        ends = np.append(limits[1:], len(part))
        real = kind[limits] > 0 if len(part) else np.zeros(0, bool)
        starts, ends = limits[real], ends[real] if len(part) else limits
        h = wd.hashes(wd.LOWER[part], starts, ends)
        upper = np.concatenate([[0], np.cumsum((part >= 65) & (part <= 90))])
        caps, size = upper[ends] - upper[starts], ends - starts
        k = kind[starts] if len(starts) else np.zeros(0, np.uint8)
        shape = np.where(k == 1, np.where(caps == 0, 0, np.where(caps == 1, 1, 2)), np.where(k == 2, 3, 7)) + np.where(k == 1, 0, np.minimum(size, 4) - 1)
        yield a, (h >> np.uint64(64 - BITS)).astype(np.int64), (1 << BITS) + shape.astype(np.int64), np.searchsorted(starts, cuts)


def contexts(docs: DataFrame) -> np.ndarray:
    """Sums of neighbours' index vectors per entry over every text. Collected: one row per entry, of fixed number."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(ENTRIES * DIM)
        rows: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> None:
            if not rows:
                return
            at, near = (np.concatenate(x) for x in zip(*rows))
            for k in range(SIGNS):
                total[:] += np.bincount(at * DIM + places[near, k], weights=signs[near, k], minlength=len(total))
            rows.clear()

        held = 0
        for batch in batches:
            for _, t, _, off in tokens(batch.column(0)):
                row = np.repeat(np.arange(len(off) - 1), np.diff(off))
                for d in range(1, WINDOW + 1):
                    same = row[d:] == row[:-d]
                    x, y = t[:-d][same], t[d:][same]
                    rows.append((np.concatenate([x, y]), np.concatenate([y, x])))
                    held += 2 * len(x)
                if held > 2_000_000:
                    flush()
                    held = 0
        flush()
        total = total.reshape(ENTRIES, DIM)
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([v.astype("<i4").tobytes() for v in total[used]], pa.binary())], ["entry", "v"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((ENTRIES, DIM), np.int64)
        for batch in batches:
            for e, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                total[e] += np.frombuffer(v.as_py(), "<i4")
        used = np.flatnonzero(total.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array([v.tobytes() for v in total[used]], pa.binary())], ["entry", "v"])

    rows = docs.select("text").mapInArrow(add, "entry long, v binary").repartition("entry").mapInArrow(gather, "entry long, v binary").collect()
    out = np.zeros((ENTRIES, DIM))
    for r in rows:
        out[r.entry] = np.frombuffer(bytes(r.v), np.int64)
    return out


def entry_vectors(context: np.ndarray) -> np.ndarray:
    places, signs = index_vectors()
    own = np.zeros((ENTRIES, DIM))
    np.put_along_axis(own, places, signs, axis=1)
    size = np.linalg.norm(context, axis=1, keepdims=True)
    return np.hstack([own / SIGNS**0.5, context / np.maximum(size, 1.0)]).astype(np.float32)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """A row of features per text."""
    d = vectors.shape[1]
    out = np.zeros((len(texts), 2 * d + 2), np.float32)
    shape_vectors = vectors[1 << BITS:]
    for first, t, s, off in tokens(texts):
        count = np.diff(off)
        some = np.flatnonzero(count)
        if not len(some):
            continue
        each = 1.0 / count[some][:, None]
        out[first + some, :d] = np.add.reduceat(vectors[t], off[some], axis=0) * each
        row = np.repeat(np.arange(len(count)), count)
        shapes = np.bincount(row * SHAPES + s - (1 << BITS), minlength=len(count) * SHAPES).reshape(-1, SHAPES)
        out[first + some, d:2 * d] = (shapes[some] @ shape_vectors) * each
        repeats = np.flatnonzero((t[1:] == t[:-1]) & (row[1:] == row[:-1]))
        out[first + some, 2 * d] = np.bincount(row[repeats], minlength=len(count))[some] / count[some]
        out[first + some, 2 * d + 1] = np.log1p(count[some])
    return out


@dataclass(frozen=True)
class Network:
    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.shift) / self.scale) @ self.w1 + self.b1, 0)
        return hidden @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(x: np.ndarray, y: np.ndarray, seed: int = 3, epochs: int = 40) -> Network:
    """Adam on the log loss, with weight decay; then the temperature with the least loss on a tenth not trained on."""
    width = x.shape[1]
    if not len(y):
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), 0.0, 1.0)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    aside, rows = (order[:len(y) // 10], order[len(y) // 10:]) if len(y) >= 50 else (order, order)
    shift, scale = x[rows].mean(axis=0), x[rows].std(axis=0) + 1e-3
    z = (x - shift) / scale
    p = [rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        rng.shuffle(rows)
        for a in range(0, len(rows), 128):
            b = rows[a:a + 128]
            pre = z[b] @ p[0] + p[1]
            hid = np.maximum(pre, 0)
            err = (1 / (1 + np.exp(-np.clip(hid @ p[2] + p[3], -40, 40))) - y[b]) / len(b)
            back = np.outer(err, p[2]) * (pre > 0)
            grads = [z[b].T @ back + 1e-4 * p[0], back.sum(axis=0), hid.T @ err + 1e-4 * p[2], np.array([err.sum()])]
            step += 1
            rate = 2e-3 * (1 - epoch / epochs)
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(shift, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    raw = net.logits(x[aside])
    best = min(np.geomspace(0.25, 8, 60), key=lambda t: _loss(raw / t, y[aside]))
    return Network(shift, scale, p[0], p[1], p[2], float(p[3][0]), float(best))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, Network]:
    """Vectors over all texts, and the network. ``labels`` has doc_id and quality."""
    vectors = entry_vectors(contexts(docs))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    # max_rows rows of two numbers: bounded whatever the corpus.
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .select(F.col("doc_id").alias("_label_id"), F.col("quality").cast("int").alias("_quality"))
        .orderBy(F.xxhash64("_label_id"), "_label_id", "_quality").limit(max_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pooled(batch.column(1), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array([r.astype("<f4").tobytes() for r in x], pa.binary())], ["id", "y", "x"])

    rows = (
        docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_label_id"))
        .select("doc_id", "text", "_quality").mapInArrow(run, "id long, y int, x binary").toPandas())
    if not len(rows):
        return vectors, train(np.zeros((0, 2 * vectors.shape[1] + 2)), np.zeros(0))
    rows = rows.sort_values(["id", "y", "x"], kind="stable")
    x = np.stack([np.frombuffer(b, "<f4") for b in rows["x"]]).astype(float)
    return vectors, train(x, rows["y"].to_numpy(float))


def scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, max_rows: int = MAX_ROWS, carry: bool = False) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs`` (doc_id, text); ``carry`` adds the row."""
    vectors, net = fit(docs, labels, max_rows)
    # Vectors of a fixed number of entries; the network is a few kilobytes.
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = net.probabilities(pooled(batch.column(1), shared.value).astype(float))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), *batch.columns[2:]], ["doc_id", "score", *batch.schema.names[2:]])

    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    picked = docs.select("doc_id", "text", *row)
    kind = picked.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, score double" + (f", row {picked.schema['row'].dataType.simpleString()}" if carry else "")
    return picked.mapInArrow(run, schema).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), *(["row"] if carry else []))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    return scores(docs, labels, carry=True).where("predicted = 1").select("row.*")
