"""Token alignment, benchmark decontamination and periodic runs against brute force, on odd rows, and on an empty table."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from skygrid.llm import align, decontaminate, periodic, queries
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=repr)


# 11 token alignment

@pytest.fixture(scope="module")
def files():
    return [open(public_tokenizers.path(n), "rb").read() for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


def brute_alignment(docs, files):
    import sentencepiece
    import tokenizers

    a_tok = tokenizers.Tokenizer.from_str(files[0].decode())
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_proto=files[1])
    decoder = tokenizers.decoders.ByteLevel()
    rows, count = [], collections.Counter()
    for doc_id, text in docs:
        links, groups, n_a, n_b = [], [], 0, 0
        if text:
            a, b = a_tok.encode(" " + text, add_special_tokens=False), b_tok.encode(text)
            want = (" " + text).encode()
            letters = align._byte_letters()
            parts_a = [bytes(letters[c] for c in t) for t in a.tokens]
            parts_b = [bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b_tok.id_to_piece(i)) for i in b)]
            if b"".join(parts_a) == want == b"".join(parts_b):
                assert decoder.decode(a.tokens) == " " + text
                # The property makes a new list each time.
                ids = a.ids
                n_a, n_b = len(ids), len(b)
                end_b, at = {}, 0
                for k, p in enumerate(parts_b):
                    at += len(p)
                    end_b[at] = k
                at, i, j = 0, 0, 0
                for k, p in enumerate(parts_a):
                    at += len(p)
                    if at in end_b:
                        links.append((ids[k], b[end_b[at]]))
                        groups.append(",".join(map(str, ids[i:k + 1])) + "|" + ",".join(map(str, b[j:end_b[at] + 1])))
                        i, j = k + 1, end_b[at] + 1
        count.update(links)
        rows.append((doc_id, n_a, n_b, links, ";".join(groups)))
    top = collections.Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return ordered(
        (d, n_a, n_b, len(x), len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for d, n_a, n_b, x, g in rows)


def alignment(df):
    return ordered((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


STRANGE = [
    (900, "<|endoftext|> <s></s> <0x41>"), (901, "a▁b"), (902, "ñandú ✓ 𝕏 été\x00 \x01"), (903, "a  b\n\n\tc "), (904, "ﬁ ½ é"), (905, " "), (906, "lorem ipsum " * 900),
    (907, "x" * 3000)]


@pytest.mark.parametrize("piece,often", [(1 << 16, 1 << 18), (64, 8), (1000, 1)])
def test_alignment(llm, files, monkeypatch, piece, often):
    monkeypatch.setattr(align, "PIECE", piece)
    monkeypatch.setattr(align, "OFTEN", often)
    docs = texts(llm.read.parquet(f"{SF}/documents.parquet"))[:120] + [r[:2] for r in ODD if len(r[1] or "") < 1000] + STRANGE
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert alignment(align.align(df, *files)) == brute_alignment(docs, files)


def test_alignment_rows(llm, files, odd, none):
    assert alignment(align.align(odd, *files)) == brute_alignment(texts(odd), files)
    assert align.align(none, *files).count() == 0


def test_both_ways_to_cut(files):
    assert align.ranks_suffice(files[0])
    quick, slow = align.Tokens(*files, True), align.Tokens(*files)
    rng = random.Random(4)
    letters = "ab'sS tTre  ..,\n\t\r\x85\xa0\xad　 \x1c\x0b½²ªßñЖж中日ह़ा̀▁<s></s>0123٣JxX_€“”\x00🙂"
    odd = ["".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 10, 40]))) for _ in range(5000)] + ["<|endoftext|> and <|endoftext|>"]
    for (a, b), (c, d) in zip(quick.encode(odd), slow.encode(odd)):
        assert a.tolist() == c.tolist() and b.tolist() == d.tolist()


@pytest.mark.parametrize("seed", range(5))
def test_merge_path(seed):
    rng = np.random.default_rng(seed)
    a, b = (np.unique(rng.integers(1, 400, rng.integers(1, 200))) for _ in range(2))
    for piece in (1, 2, 7, 50):
        borders = align.cuts(a, b, piece)
        common, met = [], 0
        for (i, j), (i2, j2) in zip(borders, borders[1:]):
            assert i2 - i + j2 - j <= piece + 1
            of_a, of_b, both = align.overlaps(a[i:i2], b[j:j2])
            common += a[i:i2][of_a[both]].tolist()
            met += len(of_a)
        assert common == np.intersect1d(a, b).tolist() and met == len(np.union1d(a, b))


# 12 decontamination

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def leak_words(text):
    return LETTERS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_leaks(docs, items, window=10):
    of = collections.defaultdict(set)
    for name, text in items:
        w = leak_words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            of[tuple(w[k:k + n])].add(name or "")
    out = []
    for doc_id, text in docs:
        w = leak_words(text)
        hit, named = set(), set()
        for n in {len(g) for g in of}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in of:
                    hit.update(range(k, k + n))
                    named |= of[tuple(w[k:k + n])]
        out.append((doc_id, len(w), len(hit), sorted(named, key=str.encode), bool(hit)))
    return ordered(out)


def leaks(df):
    return ordered((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_leaks(llm, monkeypatch, seed):
    rng = random.Random(seed)
    if seed % 2:
        # Many shards and several blocks of items.
        monkeypatch.setattr(decontaminate, "SHARD", 200)
        monkeypatch.setattr(decontaminate, "BLOCK", 300)
    letters = ["a", "B", "Cc", "é", "9", "z z", "foo-bar"][:2 + 5 * (seed > 1)] + [f"w{i}" for i in range(30 * (seed > 1))]

    def text(sizes):
        return " ".join(rng.choice(letters) for _ in range(rng.choice(sizes)))

    items = [(f"i{rng.randrange(40)}" if rng.random() > .05 else None, text([0, 1, 2, 5, 9, 10, 11, 30])) for _ in range(40)]
    docs = [(i % 100, text([0, 3, 20, 60]) + (" , " + rng.choice(items)[1] + ". end" if rng.random() < .3 else "")) for i in range(110)] + [(None, None), (None, "a a")]
    df = llm.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = llm.createDataFrame([(*r, 1) for r in items], "item_id string, text string, doc_id int")
    want = brute_leaks(docs, items)
    assert leaks(decontaminate.scan(df, asked)) == want
    clean = collections.Counter((d, t) for d, t in docs if not brute_leaks([(d, t)], items)[0][4])
    assert collections.Counter(map(tuple, decontaminate.remove(df, asked).collect())) == clean
    padded = [" " + " ".join(leak_words(t)) + " " for _, t in docs]
    longest = {}
    for name, t in set(items):
        w = leak_words(t)
        for k in range(len(w)):
            n = 0
            while k + n < len(w) and any(" " + " ".join(w[k:k + n + 1]) + " " in p for p in padded):
                n += 1
            if n:
                longest[name or "", k] = max(n, longest.get((name or "", k), 0))
    index = decontaminate.suffix_arrays(df)
    found = decontaminate.longest_matches(index, asked).collect()
    assert {(r.item_id, r.start): r.length for r in found} == longest
    numbered = {r.rid: r.doc_id for r in decontaminate.documents_of(index).collect()}
    by_doc = collections.defaultdict(list)
    for d, t in docs:
        by_doc[d].append(leak_words(t))
    words_of = collections.defaultdict(list)
    for name, t in items:
        words_of[name or ""].append(leak_words(t))
    for r in found:
        assert any(w[r.at:r.at + r.length] == v[r.start:r.start + r.length] for w in by_doc[numbered[r.rid]] for v in words_of[r.item_id])


def test_leak_rows(llm, odd, none):
    asked = llm.createDataFrame([("q", "Two, words"), ("p", "four five six seven eight"), ("p", "ipsum dolor sit"), (None, "ñandú"), ("e", None), ("f", " ")], "item_id string, text string")
    items = [tuple(r) for r in asked.collect()]
    assert leaks(decontaminate.scan(odd, asked)) == brute_leaks(texts(odd), items)
    assert decontaminate.remove(odd, asked).columns == odd.columns
    assert decontaminate.scan(none, asked).count() == decontaminate.remove(none, asked).count() == 0
    assert decontaminate.scan(odd, asked.limit(0)).where("contaminated").count() == 0
    assert decontaminate.remove(odd, asked.limit(0)).count() == len(ODD)


@pytest.mark.parametrize("seed", range(5))
def test_suffix_order(seed):
    rng = random.Random(seed)
    x = [rng.randrange(1, 3 + 40 * (seed % 2)) for _ in range(300)] * (1 + seed % 3) + [0]
    assert decontaminate.suffix_order(np.array(x)).tolist() == sorted(range(len(x)), key=lambda s: x[s:])


# 13 periodic runs

def brute_runs(w, least=12):
    number = {}
    x = np.array([number.setdefault(v, len(number)) for v in w], np.int64)
    found = {}
    for q in range(1, len(x) // 2 + 1):
        # Stretches of places whose word is the one q places on.
        edge = np.flatnonzero(np.diff(np.concatenate([[False], x[:-q] == x[q:], [False]]).astype(np.int8)))
        for s, e in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if e - s + q >= max(least, 2 * q):
                found.setdefault((s, e - s + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone).encode()


def test_cover():
    assert {(a - b) % periodic.MODULUS for a in periodic.COVER for b in periodic.COVER} == set(range(periodic.MODULUS))


def some_words(rng):
    n, k = rng.choice([0, 1, 5, 11, 12, 13, 40, 100, 300]), rng.choice([1, 2, 3, 50])
    w = [rng.randrange(k) for _ in range(n)]
    if n > 4 and rng.random() < .4:
        a = rng.randrange(n)
        p = 1 + rng.randrange(max(1, (n - a) // 2))
        w = w[:a] + [w[a + i % p] for i in range(n - a)]
    return w


@pytest.mark.parametrize("seed", range(30))
def test_runs(seed):
    rng = random.Random(seed)
    many = [some_words(rng) for _ in range(rng.choice([1, 3, 20]))]
    assert [list(map(tuple, r.tolist())) for r in periodic.runs_of([np.array(w, np.int64) for w in many])] == [brute_runs(w) for w in many]


def test_runs_in_blocks(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 256)
    rng = random.Random(5)
    for k in (1, 2, 4, 1000):
        w = [rng.randrange(k) for _ in range(1200)] + [7] * 50
        assert list(map(tuple, periodic.runs_of([np.array([1, 1]), np.array(w)])[1].tolist())) == brute_runs(w)


@pytest.mark.parametrize("seed", range(4))
def test_extensions(seed):
    rng = np.random.default_rng(seed)
    x = np.append(np.tile(rng.integers(1, 4, 40), 12)[:rng.integers(200, 480)], 0)
    i, j = (rng.integers(0, len(x), 400) for _ in range(2))
    i, j = i[i != j], j[i != j]
    want = [next(t for t in range(len(x)) if x[a + t] != x[b + t] or max(a, b) + t == len(x) - 1) for a, b in zip(i, j)]
    assert periodic.Extensions(x).common(i, j).tolist() == want


def test_collapse(llm, odd, none):
    docs = texts(odd)
    got = ordered((r.doc_id, r.n_words, [tuple(x) for x in r.runs], bytes(r.collapsed)) for r in periodic.collapse(odd).collect())
    want = []
    for d, t in docs:
        w = (t or "").split(" ") if t and t.strip() and not re.search(r"[\t\n]", t) else []
        w = [x for x in w if x]
        # The long texts are one phrase over and over: their runs are known without search.
        runs = [(0, 60_000, 5)] if len(w) >= 60_000 else brute_runs(w)
        want.append((d, len(w), runs, brute_collapsed(w, runs)))
    assert got == ordered(want)
    assert periodic.collapse(none).count() == 0


def test_periodic_query(llm):
    want = []
    for d, t in texts(llm.read.parquet(f"{SF}/documents.parquet")):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h, n = zlib.crc32(str(d).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        s, m, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        want.append((
            d, len(runs), s, m, q, 1000 * m // q if runs else None, hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(brute_collapsed(w, runs)).hexdigest()))
    got = queries.op13_periodic_runs(llm, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert ordered(map(tuple, got.collect())) == ordered(want) and sum(r[1] > 0 for r in want) > 10


def test_alignment_query(llm, files):
    docs = texts(llm.read.parquet(f"{SF}/documents.parquet"))
    assert alignment(queries.op11_token_alignment(llm, SF)) == brute_alignment(docs, files)
