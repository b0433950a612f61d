"""Alignment of two tokenizers' tokens over the same bytes, by merge-path partitioning.

Both tokenizers cut space + text; the ends of their tokens, as byte offsets, are two ascending lists A and B. Merging them
shows which tokens overlap, where both end together (a *link* of the two tokens that end there), and the *groups* of tokens
between two such places.

*Pieces.* The merge of a text is a path of |A| + |B| steps. A binary search along a diagonal finds how many ends of either list come before
any step, so the path is cut into pieces of ``PIECE`` steps that need nothing of each other. An end that both lists share
stays in one piece. Pieces are rows of a written table: Spark deals them out, and a long text is not one task's work.
A piece emits its overlaps, links and whole groups, with the tokens before its first and after its last common end; those are
stitched along the text, piece after piece in one sorted pass that holds no more than a piece and a group.

*Counts.* Links are counted per pair of ids inside the tasks and then summed by Spark. Pairs with a share of 1 / ``OFTEN`` of all links
or more, of which there are OFTEN at most, go to every task; the links of all others are joined with their counts on the pair.

Defined results: a null or empty text, and one whose tokens joined are not space + text byte for byte under either tokenizer, has
no tokens; rows that are the same have the same tokens and each counts; an empty table gives an empty result; ties for the
highest count are all best; other columns are ignored. A tokenizer works on a whole text at once, so memory is in
proportion to the longest one.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skygrid.llm.common import whole_text, written

PIECE = 1 << 16
OFTEN = 1 << 18
# Different pairs that a task counts before it hands them on.
COUNTED = 1 << 20
BLANK = "▁"
# Fixed value, the public pattern by which byte-level tokenizers cut a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters of Latin, Cyrillic and Chinese scripts, signs and blanks whose kind is the same in every edition of Unicode.
PLAIN = r"[\t\n\r\x20-\x7E\xA1-\xAC\xAE-\u021F\u0410-\u044F\u2010-\u2027\u20AC\u4E00-\u9FA5]*"


class Tokens:
    """The two tokenizers in a task: ids of texts, and the bytes of every id.

    Byte-level texts are cut by a merger that knows only ranks, if the file's merges allow (``by_rank``). A text with letters on which
    editions of Unicode may differ is left to the file's own tokenizer.
    """

    def __init__(self, byte_level: bytes, piece_model: bytes, by_rank: bool = False):
        import os

        # One thread a task; Spark deals out the texts.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = _byte_letters()
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.bytes_a = [b""] * (max(names) + 1)
        plain = {}
        for i, name in names.items():
            # A name with other letters is a special token's, which no text is cut into.
            if all(c in letters for c in name):
                self.bytes_a[i] = bytes(letters[c] for c in name)
                plain[self.bytes_a[i]] = i
            else:
                self.bytes_a[i] = name.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(w) for w in ws], np.int64) for ws in (self.bytes_a, self.bytes_b))
        self.plain = re.compile(PLAIN).fullmatch
        self.ranks = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL, mergeable_ranks=plain, special_tokens={}) if by_rank else None

    def _ids_a(self, full: str) -> np.ndarray | None:
        if self.ranks and self.plain(full):
            return self.ranks.encode_to_numpy(full, disallowed_special=()).astype(np.int32)
        return _checked(self.a.encode_batch_fast([full], add_special_tokens=False)[0].ids, self.bytes_a, full)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of both for every text; none where the tokens are not the text."""
        none = np.zeros(0, np.int32)
        for t in texts:
            a = self._ids_a(" " + t) if t else None
            b = _checked(self.b.encode(t), self.bytes_b, " " + t) if a is not None else None
            yield (none, none) if b is None else (a, b)


def _checked(ids: list[int], words: list[bytes], want: str) -> np.ndarray | None:
    return np.array(ids, np.int32) if b"".join(map(words.__getitem__, ids)) == want.encode() else None


def ranks_suffice(byte_level: bytes) -> bool:
    """Whether merging whatever pair has the lowest rank as a whole cuts every text as the file's list of merges does.

    Ids must be in the order of the merges, and every token's own bytes must merge to that token: a pair that is not
    listed can then never stand side by side, as the bytes of both would have merged in the listed way before.
    """
    asked = json.loads(byte_level)
    cutter = asked.get("pre_tokenizer") or {}
    as_known = asked.get("normalizer") is None and cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space", True)
    if not as_known or asked["model"].get("ignore_merges") or asked["model"].get("dropout"):
        return False
    vocabulary = asked["model"]["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in asked["model"]["merges"]]
    made = [vocabulary.get(x + y, -1) for x, y in merges]
    letters = _byte_letters()
    if any(c not in vocabulary for c in letters) or made != sorted(set(made)) or set(vocabulary.values()) - set(made) != {vocabulary[c] for c in letters}:
        return False
    rank = {m: r for r, m in enumerate(merges)}

    def merged(parts: list[str]) -> list[str]:
        while len(parts) > 1:
            r, k = min((rank.get(pair, len(rank)), k) for k, pair in enumerate(zip(parts, parts[1:])))
            if r == len(rank):
                break
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return parts

    return all(len(merged(list(name))) == 1 for name in vocabulary)


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 as itself and the other bytes, in order, from letter 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def diagonal(a: np.ndarray, b: np.ndarray, steps: int) -> tuple[int, int]:
    """How many of ``a`` and of ``b`` the merge has passed after ``steps`` steps (one more if it would part equal ends)."""
    lo, hi = max(0, steps - len(b)), min(steps, len(a))
    while lo < hi:
        mid = (lo + hi) // 2
        if a[mid] <= b[steps - mid - 1]:
            lo = mid + 1
        else:
            hi = mid
    i, j = lo, steps - lo
    if i and j < len(b) and a[i - 1] == b[j]:
        j += 1
    return i, j


def cuts(a: np.ndarray, b: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """The borders of pieces of the merge, first and last included."""
    inner = [diagonal(a, b, s) for s in range(piece, len(a) + len(b), piece)]
    return list(dict.fromkeys([(0, 0), *inner, (len(a), len(b))]))


def met(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every end of A the token of B that holds it, and whether that ends there too.

    At a piece's border the token may reach over it, and then has the number after the piece's last.
    """
    of_b = np.searchsorted(b, a)
    both = of_b < len(b)
    both[both] = a[both] == b[of_b[both]]
    return of_b, both


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, whether both end there) at every step of the merge of ends, numbered inside the piece.

    The bytes before each different end belong to one token of either list.
    """
    of_b, both = met(a, b)
    of_a, same = met(b, a)
    rest = np.flatnonzero(~same)
    return np.append(np.arange(len(a)), of_a[rest]), np.append(of_b, rest), np.append(both, np.zeros(len(rest), bool))


class Digits:
    """Decimal ids with the sign before them, as rows of bytes."""

    def __init__(self, n: int):
        self.n, width = n, len(str(max(0, n - 1)))
        self.rows = np.zeros((3 * n, width + 1), np.uint8)
        for s, sign in enumerate(b",;|"):
            self.rows[s * n:(s + 1) * n, 0] = sign
            for d in range(width):
                value = np.arange(n) // 10 ** d
                self.rows[s * n:(s + 1) * n, width - d] = np.where((value > 0) | (d == 0), 48 + value % 10, 0)

    def text(self, sign: np.ndarray, ids: np.ndarray) -> bytes:
        flat = self.rows[sign * self.n + ids].ravel()
        return flat[flat != 0].tobytes()


def _group_text(digits: Digits, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> bytes:
    """``;a1,a2|b1`` for every group; a group's tokens end at the cuts."""
    if not len(cut_a):
        return b""
    n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    ids = np.empty(len(a) + len(b), np.int64)
    sign = np.zeros(len(ids), np.int64)
    place_a = np.arange(len(a)) + np.repeat(cut_b - n_b, n_a)
    place_b = np.arange(len(b)) + np.repeat(cut_a, n_b)
    ids[place_a], ids[place_b] = a, b
    sign[(cut_a - n_a) + (cut_b - n_b)] = 1
    sign[cut_a + (cut_b - n_b)] = 2
    return digits.text(sign, ids)


def _pieces(docs: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = None
        for batch in batches:
            tokens = tokens or Tokens(*shared.value)
            kinds = [_kind(len(size)) for size in (tokens.size_a, tokens.size_b)]
            rows = []
            for rid, doc_id, (a, b) in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), tokens.encode(batch.column(2).to_pylist())):
                size_a, size_b = tokens.size_a[a], tokens.size_b[b]
                end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
                borders = cuts(end_a, end_b, PIECE)
                n = max(1, len(borders) - 1)
                for k in range(n):
                    (i, j), (i2, j2) = borders[k], borders[min(k + 1, len(borders) - 1)]
                    # Ends are kept as sizes from the piece's first token on; the place where each list begins goes with them.
                    at_a, at_b = int(end_a[i - 1]) if i else 0, int(end_b[j - 1]) if j else 0
                    rows.append((rid, doc_id, k, n, at_a - at_b, a[i:i2].astype(kinds[0]).tobytes(), b[j:j2].astype(kinds[1]).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 7, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                ["rid", "doc_id", "piece", "n_pieces", "shift", "a", "b"])

    picked = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), whole_text().alias("text"))
    return written(picked.mapInArrow(run, "rid long, doc_id long, piece int, n_pieces int, shift long, a binary, b binary"), "token-pieces")


def _kind(n: int) -> type:
    """The type in which ids below n are stored."""
    return np.uint16 if n <= 1 << 16 else np.int32


class Part:
    """What a piece of the merge emits: links, whole groups, and the tokens before its first and after its last common end."""

    def __init__(self, a: np.ndarray, b: np.ndarray, shift: int, size_a: np.ndarray, size_b: np.ndarray):
        end_a, end_b = np.cumsum(size_a[a]) + shift, np.cumsum(size_b[b])
        of_b, both = met(end_a, end_b)
        self.cut_a = np.flatnonzero(both) + 1
        self.cut_b = of_b[both] + 1
        # Every end is a step; those that both lists share are one.
        self.n_overlaps = len(a) + len(b) - len(self.cut_a)
        self.a, self.b = a, b

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        return self.a[self.cut_a - 1], self.b[self.cut_b - 1]


def _merged(pieces: DataFrame, sizes) -> DataFrame:
    """Pieces to (rid, doc_id, piece, n_pieces, sizes, head, body, tail, links as pairs with their number)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size_a, size_b = sizes.value
        digits = Digits(max(len(size_a), len(size_b)))
        kinds = _kind(len(size_a)), _kind(len(size_b))
        width = np.int64(len(size_b))
        for batch in batches:
            n_a, n_b, n_groups, n_overlaps, head, tail, body, digest, pairs, times = ([] for _ in range(10))
            n_pieces = batch.column(3).to_pylist()
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[k].as_buffer(), kind).astype(np.int64) for c, kind in zip((5, 6), kinds))
                part = Part(a, b, batch.column(4)[k].as_py(), size_a, size_b)
                n_a.append(len(a))
                n_b.append(len(b))
                n_groups.append(len(part.cut_a))
                n_overlaps.append(part.n_overlaps)
                pair, many = np.unique(part.links()[0] * width + part.links()[1], return_counts=True)
                pairs.append(pair)
                times.append(many)
                whole = n_pieces[k] == 1
                # The first group of a piece may have begun before it: its tokens go apart unless the text is one piece.
                i, j = (part.cut_a[0], part.cut_b[0]) if len(part.cut_a) else (len(a), len(b))
                if whole:
                    i = j = 0
                i2, j2 = (part.cut_a[-1], part.cut_b[-1]) if len(part.cut_a) else (i, j)
                later = slice(0 if whole else 1, None)
                text = _group_text(digits, a[i:i2], b[j:j2], part.cut_a[later] - i, part.cut_b[later] - j)
                head.append(b"" if whole else _both(a[:i], b[:j]))
                tail.append(b"" if whole else _both(a[i2:], b[j2:]))
                body.append(b"" if whole else text)
                digest.append(None if not whole else hashlib.sha256(text[1:]).hexdigest() if len(a) else "")
            cut = np.cumsum([0] + [len(p) for p in pairs]).astype(np.int32)
            flat = [np.concatenate([*x, np.zeros(0, np.int64)]) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in range(4)], *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_overlaps)],
                 *[pa.array(x, pa.binary()) for x in (head, body, tail)], pa.array(digest, pa.string()),
                 *[pa.ListArray.from_arrays(pa.array(cut), pa.array(x)) for x in flat]], names)

    names = ["rid", "doc_id", "piece", "n_pieces", "n_a", "n_b", "n_groups", "n_overlaps", "head", "body", "tail", "digest", "pairs", "times"]
    return written(pieces.mapInArrow(
        run, "rid long, doc_id long, piece int, n_pieces int, n_a long, n_b long, n_groups long, n_overlaps long, head binary, body binary, "
        "tail binary, digest string, pairs array<long>, times array<long>"), "token-groups")


def _both(a: np.ndarray, b: np.ndarray) -> bytes:
    return np.concatenate([[len(a)], a, b]).astype(np.int32).tobytes()


def _stitched(merged: DataFrame) -> DataFrame:
    """(rid, digest) of the texts of several pieces: the open group is carried from piece to piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid, state, a, b, some = None, hashlib.sha256(), [], [], False

        def closed() -> bytes:
            text = b";" + b",".join(b"%d" % i for i in a) + b"|" + b",".join(b"%d" % i for i in b)
            return text if some else text[1:]

        for batch in batches:
            out = []
            for now, groups, head, body, tail in zip(*(c.to_pylist() for c in batch.columns)):
                if now != rid:
                    if rid is not None:
                        out.append((rid, state.hexdigest()))
                    rid, state, a, b, some = now, hashlib.sha256(), [], [], False
                head, tail = np.frombuffer(head, np.int32), np.frombuffer(tail, np.int32)
                a, b = a + head[1:head[0] + 1].tolist(), b + head[head[0] + 1:].tolist()
                if groups:
                    state.update(closed())
                    state.update(body)
                    a, b, some = tail[1:tail[0] + 1].tolist(), tail[tail[0] + 1:].tolist(), True
            yield _named(out)
        if rid is not None:
            yield _named([(rid, state.hexdigest())])

    def _named(rows: list[tuple[int, str]]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [(), ()]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string())], ["rid", "digest"])

    several = merged.where("n_pieces > 1").select("rid", "piece", "n_groups", "head", "body", "tail")
    return several.repartition("rid").sortWithinPartitions("rid", "piece").select("rid", "n_groups", "head", "body", "tail").mapInArrow(
        run, "rid long, digest string")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (pairs, times) to sums per pair, one batch for many rows."""
    held: list[np.ndarray] = []
    many: list[np.ndarray] = []
    waiting = 0

    def summed() -> tuple[np.ndarray, np.ndarray]:
        pair, at = np.unique(np.concatenate(held), return_inverse=True)
        return pair, np.bincount(at, np.concatenate(many), len(pair)).astype(np.int64)

    for batch in batches:
        held.append(batch.column(0).flatten().to_numpy())
        many.append(batch.column(1).flatten().to_numpy())
        waiting += len(held[-1])
        if waiting > 2 * COUNTED:
            pair, n = summed()
            if len(pair) > COUNTED:
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])
                held, many, waiting = [], [], 0
            else:
                held, many, waiting = [pair], [n], len(pair)
    if held:
        pair, n = summed()
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], ["pair", "n"])


def link_counts(merged: DataFrame, width: int) -> DataFrame:
    """pair (A id * width + B id), n, best: how many links of the corpus hold it, and whether no pair of its B id has more."""
    counts = written(merged.select("pairs", "times").mapInArrow(_counted, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "link-counts")
    # A row per id of B: no more than its vocabulary.
    top = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("top"))
    return written(counts.join(F.broadcast(top), F.col("pair") % width == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best")), "link-best")


def _weighed(merged: DataFrame, counts: DataFrame) -> DataFrame:
    """(rid, n_best, count_sum, pair, times): the sums over frequent pairs with no pair, and a row per other pair with no sums."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    # A share of all links that at most OFTEN pairs can have.
    often = counts.where(F.col("n") * OFTEN >= total).toPandas().sort_values("pair")
    shared = merged.sparkSession.sparkContext.broadcast((often["pair"].to_numpy(np.int64), often["n"].to_numpy(np.int64), often["best"].to_numpy(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, n, best = shared.value
        for batch in batches:
            rids = batch.column(0).to_numpy()
            pairs, times = (batch.column(c).flatten().to_numpy() for c in (1, 2))
            row = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(1).offsets.to_numpy()))
            at = np.minimum(np.searchsorted(names, pairs), max(0, len(names) - 1))
            known = names[at] == pairs if len(names) else np.zeros(len(pairs), bool)
            good, rest = np.flatnonzero(known), np.flatnonzero(~known)
            sums = np.zeros((2, batch.num_rows), np.int64)
            np.add.at(sums[0], row[good], times[good] * best[at[good]])
            np.add.at(sums[1], row[good], times[good] * n[at[good]])
            blank = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums[0]), pa.array(sums[1]), blank, blank], columns)
            zero = pa.array(np.zeros(len(rest), np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(rids[row[rest]]), zero, zero, pa.array(pairs[rest]), pa.array(times[rest])], columns)

    columns = ["rid", "n_best", "count_sum", "pair", "times"]
    return written(merged.select("rid", "pairs", "times").mapInArrow(
        run, "rid long, n_best long, count_sum long, pair long, times long"), "link-weights")


def align(docs: DataFrame, byte_level: bytes, piece_model: bytes) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_best, count_sum, groups_sha256 for every row (doc_id long, text).

    ``byte_level`` is a byte-level BPE tokenizer's file, ``piece_model`` a sentencepiece model that adds the space
    itself: some megabytes, whatever the corpus.
    """
    context = docs.sparkSession.sparkContext
    tokens = Tokens(byte_level, piece_model)
    sizes = context.broadcast((tokens.size_a, tokens.size_b))
    merged = _merged(_pieces(docs, context.broadcast((byte_level, piece_model, ranks_suffice(byte_level)))), sizes)
    counts = link_counts(merged, len(tokens.size_b))
    weights = _weighed(merged, counts)
    rare = weights.where("pair is not null").select("rid", "pair", "times").join(counts, "pair").groupBy("rid").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    known = weights.where("pair is null").select("rid", "n_best", "count_sum")
    weights = known.unionByName(rare).groupBy("rid").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    whole = merged.groupBy("rid").agg(
        F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_overlaps")], F.max("digest").alias("digest"))
    return whole.join(weights, "rid").join(_stitched(merged).withColumnRenamed("digest", "long_digest"), "rid", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_overlaps", "n_best", "count_sum",
        F.coalesce("long_digest", "digest").alias("groups_sha256"))
