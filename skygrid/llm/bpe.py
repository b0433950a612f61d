"""Byte-level BPE through a sentencepiece model written from the vocabulary.

Every byte string of the vocabulary becomes a piece of printable letters, one letter per byte, with the score
minus its rank, so that sentencepiece merges in the order of the ranks. The model is serialised here, field by field;
normalisation is the identity, and nothing is trained. Texts are split by the pattern first; a pre-token that
is itself in the vocabulary is that id (as the ranks' own library has it), any other is merged by the model. Decoding maps
ids back to their bytes.

Ids travel as binary of little-endian unsigned 32-bit integers. Defined results: null is the empty text, whose ids
are empty; a decoded text is bytes and need not be valid UTF-8 when ids were cut. Other columns are
carried along under the name ``row``.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CACHED = 400_000


def read_ranks(path: str) -> list[bytes]:
    """Byte strings in the order of their ranks, from lines of base64 and rank."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    out: list[bytes] = [b""] * (max(int(r) for _, r in pairs) + 1)
    for word, rank in pairs:
        out[int(rank)] = base64.b64decode(word)
    return out


def _letters() -> list[str]:
    """One printable letter per byte: 256 successive ones that sentencepiece gives no meaning."""
    return [chr(0x4E00 + b) for b in range(256)]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, b: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(b)) + b


def serialised_model(ranks: list[bytes]) -> bytes:
    """A sentencepiece model of the byte strings: piece 0 is the unknown one, piece r + 1 has rank r.

    Fixed values, the numbers of the public model format: pieces 1 (text 1, score 2, type 3; type 2 is unknown),
    trainer 2 (model type 3, BPE is 2; vocabulary size 4; unknown, begin, end, padding 40 to 43), normaliser 3 (name 1,
    dummy prefix 3, extra blanks 4, escaped blanks 5).
    """
    letters = _letters()
    out = [_bytes(1, _bytes(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _number(3, 2))]
    for rank, word in enumerate(ranks):
        text = "".join(letters[b] for b in word).encode()
        out.append(_bytes(1, _bytes(1, text) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank))))
    out.append(_bytes(2, _number(3, 2) + _number(4, len(ranks) + 1) + _number(40, 0) + _number(41, -1) + _number(42, -1) + _number(43, -1)))
    out.append(_bytes(3, _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)))
    return b"".join(out)


class Encoder:
    """Ids of texts, in a task."""

    def __init__(self, ranks: list[bytes], model: bytes, pattern: str):
        import regex
        import sentencepiece

        self.split = regex.compile(pattern).findall
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.whole = {w: r for r, w in enumerate(ranks) if w}
        self.letters = {b: c for b, c in enumerate(_letters())}
        self.known: dict[str, bytes] = {}

    def learn(self, tokens: set[str]) -> None:
        """Ids of pre-tokens not met before; the memory of them is bounded."""
        if len(self.known) + len(tokens) > CACHED:
            self.known.clear()
        merge = []
        for t in tokens:
            if t not in self.known:
                rank = self.whole.get(t.encode())
                if rank is None:
                    merge.append(t)
                else:
                    self.known[t] = struct.pack("<I", rank)
        mapped = [t.encode().decode("latin-1").translate(self.letters) for t in merge]
        for t, ids in zip(merge, self.pieces.encode(mapped, num_threads=1) if merge else []):
            self.known[t] = struct.pack(f"<{len(ids)}I", *[i - 1 for i in ids])

    def encode(self, text: str) -> bytes:
        tokens = self.split(text)
        self.learn(set(tokens))
        return b"".join(map(self.known.__getitem__, tokens))


def encode(docs: DataFrame, ranks: list[bytes], pattern: str, carry: bool = False) -> DataFrame:
    """doc_id, ids (binary), n_tokens for every row of ``docs`` (doc_id, text); ``carry`` adds the row."""
    spark = docs.sparkSession
    # A vocabulary: some megabytes, whatever the corpus.
    shared = spark.sparkContext.broadcast((ranks, serialised_model(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(*shared.value, pattern)
            ids = [encoder.encode(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64()), *batch.columns[2:]],
                ["doc_id", "ids", "n_tokens", *batch.schema.names[2:]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids binary, n_tokens long"
    if not carry:
        return docs.select("doc_id", "text").mapInArrow(run, schema)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    picked = docs.select("doc_id", "text", row)
    return picked.mapInArrow(run, f"{schema}, row {picked.schema['row'].dataType.simpleString()}")


def decode(encoded: DataFrame, ranks: list[bytes], others: list[str]) -> DataFrame:
    """``others`` of the encoded rows, ids, and decoded (binary)."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = shared.value.__getitem__
            out = []
            for ids in batch.column("ids"):
                b = ids.as_py() or b""
                out.append(b"".join(map(word, struct.unpack(f"<{len(b) // 4}I", b))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "decoded"])

    picked = encoded.select(*others, "ids")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema)
    return picked.mapInArrow(run, f"{fields}, decoded binary")
