"""Each operator against brute force, on odd rows, and on an empty table."""

import collections
import hashlib
import math
import random
import re
import struct
import textwrap

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skygrid.llm import bpe, exact, graph, jaccard, licences, lm, mixing, pii, pq, quality, queries, suffix
from tests.llm.conftest import ODD, SCHEMA

SPACE = re.compile(r"[\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def shingle_set(text, size=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def linked_components(sets, percent=75):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    by = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    common = collections.Counter((a, b) for v in by.values() for k, b in enumerate(v) for a in v[:k])
    for (a, b), c in common.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            root[find(b)] = find(a)
    return [find(i) for i in range(len(sets))]


# 1 mixing

def brute_targets(sizes, weights, most):
    """Excess over the caps is shared again by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    held, free = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(held.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] >= most * sizes[s]}
        if not over:
            return held | share
        held |= {s: float(most * sizes[s]) for s in over}
        free -= over
        if not free:
            return held


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(llm, seed):
    rng = random.Random(seed)
    rows = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a", "b", "é", "𝕏", "z", "~", None, "tiny"] if i > 3 else ["tiny"])) for i in range(400)]
    rows = [(i, t if s != "tiny" else "just three words", s) for i, t, s in rows if s != "tiny" or i < 4]
    df = llm.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(df).collect()
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len(t.split())
    want = brute_targets(size, (5, 2, 1), 3)
    taken = collections.Counter()
    for r in out:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size and r.source_size == size[r.source]
        assert r.target == pytest.approx(want[r.source])
    for s in want:
        assert abs(taken[s] - want[s]) <= 2 * mixing.BLOCK_WORDS
    again = mixing.mix(df.repartition(7)).collect()
    key = lambda r: (r.doc_id, r.taken)
    assert sorted(map(key, out)) == sorted(map(key, again))


def test_apportion_is_highest_quotients(llm):
    rng = random.Random(4)
    for _ in range(3):
        claims = [(0, f"{i:03}", rng.choice([0.0, rng.random() * 100, 5.0]), rng.randrange(0, 60)) for i in range(25)]
        seats = rng.randrange(0, 300)
        got = {r["_id"]: r.quota for r in mixing.apportion(
            llm.createDataFrame(claims, "g int, _id string, c double, cap long"), ["g"], "c", "cap", F.lit(seats)).collect()}
        line = sorted(((-c / (2 * k + 1), i) for _, i, c, cap in claims for k in range(cap) if c > 0))[:seats]
        want = collections.Counter(i for _, i in line)
        if sum(got.values()) == seats:
            assert sorted(-c / (2 * k + 1) for _, i, c, _ in claims for k in range(got[i])) == pytest.approx([q for q, _ in line])
        assert all(got[i] <= cap for _, i, _, cap in claims) and (sum(want.values()) < seats or sum(got.values()) == seats)


def test_mix_odd(odd, none):
    out = mixing.mix(odd).collect()
    assert len(out) == len(ODD) and sum(r.taken for r in out if not r.size) == 0
    assert mixing.mix(none).collect() == []
    rows = mixing.mixed_rows(odd)
    assert rows.columns == odd.columns and rows.where("text is null or text = ''").count() == 0
    assert mixing.mixed_rows(none).count() == 0


# 2 n-gram Jaccard join

def near_copies(seed, n=260):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghij") * rng.randrange(1, 4) + str(rng.randrange(90)) for _ in range(rng.randrange(2, 120))] for _ in range(25)]
    passage = [f"p{i}" for i in range(40)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice(["new", "Word", "x"])
        if rng.random() < 0.3:
            w = w + passage
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("seed, tile", [(1, 4096), (2, 8)])
def test_jaccard(llm, monkeypatch, seed, tile):
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "BUNDLE", 2 * tile)
    rows = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [shingle_set(t) for _, t in rows]
    roots = linked_components(sets)
    least = {}
    for i, r in enumerate(roots):
        least[r] = min(least.get(r, i), i)
    assert got == {i: (len(sets[i]), least[roots[i]]) for i in range(len(rows))}


def test_bundles_are_searched_again_only_for_pairs_kept_back(llm, monkeypatch):
    turns, between = [], jaccard._between
    monkeypatch.setattr(jaccard, "coarse_counts", lambda *_: np.zeros(1 << jaccard.COARSE_BITS, np.uint8))
    monkeypatch.setattr(jaccard, "_between", lambda *args: turns.append(args[-1]) or between(*args))
    # A common beginning makes them meet, and is too short to link them.
    common = " ".join(f"c{i}" for i in range(40))
    rows = [(k, common + " " + " ".join(f"w{k}x{i}" for i in range(30))) for k in range(6)]
    got = jaccard.near_duplicates(llm.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(k, k) for k in range(6)] and turns == [True]
    # With none given out, the second search finds every link that the centres left.
    turns.clear()
    monkeypatch.setattr(jaccard, "FEW", 0)
    monkeypatch.setattr(jaccard, "ENDS", "array(xxhash64(sig))")
    near = [(k, common + " " + " ".join(f"w{k}x{i}" for i in range(3))) for k in range(6)] + [(k + 10, t) for k, t in rows]
    got = jaccard.near_duplicates(llm.createDataFrame(near, "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(k, 0) for k in range(6)] + [(k + 10, k + 10) for k in range(6)]
    assert turns == [True, False]


def test_tree_keeps_every_linkable_pair():
    rng = np.random.default_rng(0)
    rule = jaccard.Rule()
    base = [np.unique(rng.integers(0, 1 << 63, k, dtype=np.uint64) << np.uint64(1)) for k in rng.integers(1, 900, 30)]
    sets = []
    for _ in range(150):
        s = base[rng.integers(30)].copy()
        s[rng.random(len(s)) < rng.choice([0, 0.05, 0.2])] ^= np.uint64(1 << 62)
        sets.append(np.unique(s))
    n = np.array([len(s) for s in sets])
    a, b = jaccard.tree_pairs(n, [jaccard.point(jaccard.counts_of(s), len(s)) for s in sets], rule, np.arange(len(sets)))
    found = {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())}
    for i in range(len(sets)):
        for j in range(i):
            c = len(np.intersect1d(sets[i], sets[j]))
            if 100 * c >= 75 * (n[i] + n[j] - c):
                assert (j, i) in found


@pytest.mark.parametrize("most", [15, 16, 255, 256, 70_000])
def test_points_keep_counts(most):
    n = 100
    groups = jaccard.fineness(n)
    want = np.zeros(groups, np.int64)
    want[[0, 1, groups - 1]] = most, 3, 1
    shift = np.uint64(64 - groups.bit_length() + 1)
    got = jaccard.counts_of_groups(np.repeat(np.arange(groups, dtype=np.uint64), want) << shift, groups)
    assert (jaccard.point(got, n) == want).all()


def test_jaccard_odd(odd, none):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(odd).collect())
    assert got[(5, 3, 1)] == 2 and got[(11, 3, 1)] == 1 and got[(2, 0, 2)] == 1 and got[(10, 1, 6)] == 1 and got[(8, 6, 8)] + got[(8, 6, 7)] == 1
    assert sum(got.values()) == len(ODD) and jaccard.near_duplicates(none).collect() == []
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.where("doc_id is not null").collect())[:4] == [1, 2, 3, 4]
    assert kept.where("doc_id is null").count() == 2


def test_keep_one_goes_by_row(llm):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    other = "a text that links with nothing at all in this small table"
    rows = [(1, text), (2, text + " extra"), (2, other), (None, text), (None, text + " extra"), (1, text), (3, ""), (3, ""), (4, None)]
    kept = jaccard.keep_one(llm.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert collections.Counter(map(tuple, kept)) == collections.Counter([(1, text), (2, other), (3, ""), (3, ""), (4, None)])
    nulls = jaccard.keep_one(llm.createDataFrame(rows[3:5], "doc_id long, text string")).collect()
    assert len(nulls) == 1


@pytest.mark.parametrize("keep", [jaccard.keep_one, exact.deduplicate])
def test_rows_that_stay_are_not_shuffled(llm, keep):
    rows = [(k, f"text {k} of its own " + "word " * (k % 7 + 9) + str(k)) for k in range(40)] + [(50, "text 3 of its own " + "word " * 12 + "3")]
    kept = keep(llm.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, kept.collect())) == sorted(rows[:-1])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert " Exchange " not in plan and "BroadcastExchange" in plan


def test_components(llm):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)] + [(7, 7), (999, 1000)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in graph.components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


# 3 licence scan

def test_licences(llm, odd, none):
    mit = licences.KNOWN[9][1]
    rows = [
        (1, "Copyright (c) 2020 Somebody\n\n" + mit.upper() + "\nAll rights reserved."), (2, "Released under the MIT Licence!"), (3, None), (4, ""),
        (5, "prose\nLICENSED under CC-BY-NC 4.0\n\nmore prose\nreleased, under the mit license"), (6, "released under the MIT License. And more."),
        (7, "Released under the MIT License.\n" * 500), (7, "Released under the MIT License.\n" * 500),
    ]
    got = [(r.doc_id, r.whole, r.notices, r.n_notices) for r in licences.scan(llm.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == [
        (1, "MIT", "", 0), (2, "MIT", "MIT", 1), (3, None, "", 0), (4, None, "", 0), (5, None, "CC-BY-NC-4.0,MIT", 2), (6, None, "", 0),
        (7, None, "MIT", 1), (7, None, "MIT", 1)]
    assert licences.scan(odd).where("n_notices = 0 and whole is null").count() == len(ODD) and licences.scan(none).collect() == []


def test_licence_texts(llm):
    """Whole texts in their usual forms: titled, wrapped, with copyright lines that name no year; SQL agrees."""
    mit, isc, apache = licences.KNOWN[9][1], licences.KNOWN[8][1], next(t for i, t in licences.KNOWN if i == "Apache-2.0" and len(t) > 5000)
    rows = [
        ("MIT", "MIT License\n\nCopyright (c) 2020 Jane Doe\n\n" + textwrap.fill(mit, 78)), ("MIT", "The MIT License (MIT)\n\nCopyright Jane Doe\n\n" + textwrap.fill(mit, 60)),
        ("MIT", "Copyright (c) The Authors\n" + mit), ("ISC", "ISC License\n\nCopyright (c) 2004 A, B\nCopyright The Others\n\n" + textwrap.fill(isc, 70)),
        ("Apache-2.0", textwrap.fill(apache, 100)), (None, "MIT License\n" + mit + " And more."), (None, "Copyright Jane Doe\n\n"), (None, "\n" * 5000),
        (None, mit.replace("free of charge", "for a fee")),
    ]
    rows += [(i, f"\n{t.upper()}\n") for i, t in licences.KNOWN if len(t) > 500]
    assert {"BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "Unlicense", "Zlib", "BSL-1.0", "MPL-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-3.0-only", "CC0-1.0"} <= {i for i, _ in rows}
    docs = [(k, t) for k, (_, t) in enumerate(rows)]
    got = sorted(tuple(r) for r in licences.scan(llm.createDataFrame(docs, "doc_id long, text string")).collect())
    assert [(g[0], g[1]) for g in got] == [(k, i) for k, (i, _) in enumerate(rows)]
    db = duckdb.connect()
    db.execute("create table documents (doc_id bigint, text varchar)")
    db.executemany("insert into documents values (?, ?)", docs)
    assert sorted(db.execute(queries.SQL["op3_licence_scan"]).fetchall()) == got


# 4 BPE

def library():
    import tiktoken

    ranks, pattern = queries.vocabulary()
    return ranks, pattern, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={w: i for i, w in enumerate(ranks)}, special_tokens={})


def test_bpe_like_its_library():
    ranks, pattern, known = library()
    encoder = bpe.Encoder(ranks, bpe.serialised_model(ranks), pattern)
    rng = random.Random(2)
    some = ["".join(chr(c) for c in (rng.choice([rng.randrange(32, 127), rng.randrange(0x110000), rng.randrange(0x3000), rng.randrange(64)])
                                     for _ in range(rng.randrange(60))) if not 0xD800 <= c < 0xE000) for _ in range(1500)]
    for t in some + ["", "a" * 3000, " " * 500 + "x", "zqxj" * 5000, "I'LL 's 're", "<|endoftext|>", "\x00\x1c\u0085"] + [w.decode("utf8", "ignore") for w in ranks[::7]]:
        ids = encoder.encode(t)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == known.encode_ordinary(t)


def test_bpe_round_trip(llm, odd, none):
    ranks, pattern, known = library()
    encoded = bpe.encode(odd, ranks, pattern)
    got = bpe.decode(encoded, ranks, ["doc_id", "n_tokens"]).collect()
    want = sorted((r[1] or "").encode() for r in ODD)
    assert sorted(bytes(r.decoded) for r in got) == want
    assert sorted(r.n_tokens for r in got) == sorted(len(known.encode_ordinary(r[1] or "")) for r in ODD)
    assert bpe.encode(none, ranks, pattern).collect() == []
    assert bpe.encode(odd, ranks, pattern, carry=True).select("row.kept").count() == len(ODD)


# 5 embeddings

@pytest.mark.parametrize("block", [2048, 64])
def test_embeddings(llm, monkeypatch, block):
    monkeypatch.setattr(pq, "BLOCK", block)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(400, 64))
    near = base[rng.integers(0, 60, 500)]
    near = near + rng.uniform(0.15, 0.4, (500, 1)) * rng.normal(size=near.shape)
    rows = [v.astype(np.float32).tolist() for v in np.concatenate([base, near, np.repeat(base[:1], 30, axis=0), 3 * base[1:2]])]
    odd = [None, [], [0.0] * 64, [math.nan] * 64, [math.inf] + [1.0] * 63, [None] + [1.0] * 63, [1.0]]
    df = llm.createDataFrame([(i, v, 1) for i, v in enumerate(rows + odd)], "vec_id long, embedding array<float>, n int")
    got = {r.vec_id: r for r in pq.near_duplicates(df).collect()}
    x = np.array(rows, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    link = x @ x.T >= 0.95
    np.fill_diagonal(link, False)
    assert sum(r.n_links for r in got.values()) >= 0.9 * link.sum() and all(got[i].n_links <= link[i].sum() for i in range(len(x)))
    # At this margin nothing is lost here.
    assert [got[i].n_links for i in range(len(x))] == link.sum(axis=1).tolist()
    label = np.arange(len(x))
    for _ in range(50):
        label = np.array([min([label[i], *label[link[i]]]) for i in range(len(x))])
    assert [got[i].component_id for i in range(len(x))] == label.tolist() and all(r.kept == (r.vec_id == r.component_id) for r in got.values())
    assert all((got[i].n_links, got[i].component_id) == (0, i) for i in range(len(rows), len(rows) + len(odd)))
    assert pq.near_duplicates(df.limit(0)).collect() == []


# 6 LM scores

def test_scores(llm, odd, none, monkeypatch):
    monkeypatch.setattr(lm, "SHARE", 16)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["a", "b", "The", "the", "c", f"w{rng.randrange(40)}", f"r{rng.randrange(10**6)}"]) for _ in range(rng.randrange(60)))) for i in range(60)]
    rows += [(60, rows[3][1]), (3, rows[3][1]), (61, None)]
    got = sorted((r.doc_id, r.n_words, r.n_backed_off, round(r.log_score, 6)) for r in lm.score(llm.createDataFrame(rows, "doc_id long, text string")).collect())
    docs = [(i, (t or "").lower().split()) for i, t in rows]
    words = collections.Counter(w for _, d in docs for w in d)
    pairs = collections.Counter(p for _, d in docs for p in zip(d, d[1:]))
    heads = collections.Counter(v for _, d in docs for v in d[:-1])
    want = []
    for i, d in docs:
        w_, p_, h_ = collections.Counter(d), collections.Counter(zip(d, d[1:])), collections.Counter(d[:-1])
        total, back, s = sum(words.values()) - len(d), 0, 0.0
        for k, w in enumerate(d):
            v = d[k - 1] if k else None
            if k and pairs[v, w] > p_[v, w]:
                s += math.log((pairs[v, w] - p_[v, w]) / (heads[v] - h_[v]))
            else:
                s += math.log(max(words[w] - w_[w], 0.5) / total) + (math.log(0.4) if k else 0)
                back += k > 0
        want.append((i, len(d), back, round(s, 6)))
    assert [g[:3] for g in got] == [w[:3] for w in sorted(want)] and [g[3] for g in got] == pytest.approx([w[3] for w in sorted(want)], abs=1e-5)
    assert lm.score(odd).count() == len(ODD) and lm.score(none).collect() == []


def lm_rows(seed):
    rng = random.Random(seed)
    some = ["a", "b", "The", "the", "c"]
    rows = [(i, " ".join(rng.choice([*some, f"w{rng.randrange(40)}", f"r{rng.randrange(10**6)}"]) for _ in range(rng.randrange(60)))) for i in range(60)]
    return rows + [(60, rows[3][1]), (3, rows[3][1]), (61, None), (62, "solo solo " * 300), (63, "a")] + [(100 + i, f"the u{i}") for i in range(400)]


def backed_off(rows, order):
    """Brute force over words: doc_id, n_words, words scored below the longest context they have, log score."""
    docs = [(i, (t or "").lower().split()) for i, t in rows]

    def grams(d):
        return [collections.Counter(tuple(d[i:i + k]) for i in range(len(d) - k + 1)) for k in range(order + 1)]

    def heads(d):
        return [collections.Counter(tuple(d[i:i + k]) for i in range(len(d) - k)) for k in range(order)]

    all_g, all_h = ([sum((f(d)[k] for _, d in docs), collections.Counter()) for k in range(order + n)] for f, n in ((grams, 1), (heads, 0)))
    want = []
    for i, d in docs:
        own_g, own_h, back, s = grams(d), heads(d), 0, 0.0
        for at, w in enumerate(d):
            for k in range(min(order, at + 1), 0, -1):
                g = tuple(d[at + 1 - k:at + 1])
                n = all_g[k][g] - own_g[k][g]
                if k == 1:
                    s += math.log(max(n, 0.5) / max(sum(len(x) for _, x in docs) - len(d), 1))
                elif n > 0:
                    s += math.log(n / (all_h[k - 1][g[:-1]] - own_h[k - 1][g[:-1]]))
                    break
                else:
                    s += math.log(0.4)
            back += k < min(order, at + 1)
        want.append((i, len(d), back, s))
    return sorted(want)


def like(got, want):
    got = sorted((r.doc_id, r.n_words, r.n_backed_off, r.log_score) for r in got)
    assert [g[:3] for g in got] == [w[:3] for w in want] and [g[3] for g in got] == pytest.approx([w[3] for w in want], abs=1e-5)


def test_buckets_follow_the_corpus(llm, monkeypatch):
    """However few tasks there are, a bucket has a bounded number of n-grams, also where many documents start alike."""
    assert lm._n_buckets(8 * 10**9, 12) >= 8 * 10**9 / lm.BUCKET and lm._n_buckets(10, 12) == 48
    for name, value in (("BUCKET", 32), ("SHARE", 16), ("CONTEXTS", 16)):
        monkeypatch.setattr(lm, name, value)
    most, by_bucket = [], lm._by_bucket

    def seen(df):
        most.append(max(r.n for r in df.where("kind <> 1").groupBy("bucket").agg(F.sum("n").alias("n")).collect()))
        return by_bucket(df)

    monkeypatch.setattr(lm, "_by_bucket", seen)
    like(lm.score(llm.createDataFrame(lm_rows(1), "doc_id long, text string")).collect(), backed_off(lm_rows(1), 2))
    assert len(most) == 2 and max(most) <= 4 * 32


def test_trigrams_back_off_to_pairs_and_words(llm, none, monkeypatch):
    for name, value in (("BUCKET", 32), ("SHARE", 16), ("CONTEXTS", 16)):
        monkeypatch.setattr(lm, name, value)
    like(lm.score(llm.createDataFrame(lm_rows(2), "doc_id long, text string"), order=3).collect(), backed_off(lm_rows(2), 3))
    assert lm.score(none, order=3).collect() == []


def test_sums_make_a_row_a_document(llm, monkeypatch):
    """Sums of a document from many buckets are added in packed form: one row of what was dealt out, one of what was scored where it was read."""
    for name, value in (("BUCKET", 32), ("HELD", 64), ("SHARE", 16), ("CONTEXTS", 16)):
        monkeypatch.setattr(lm, name, value)
    sums = []
    for name in ("_sums_of", "_by_document"):
        def seen(df, made=getattr(lm, name, None)):
            sums.append(made(df))
            return sums[-1]

        monkeypatch.setattr(lm, name, seen, raising=False)
    rows = lm_rows(3)
    like(lm.score(llm.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect(), backed_off(rows, 2))
    assert 0 < sum(x.count() for x in sums) <= 2 * len(rows)


def test_own_counts_of_some_positions():
    rng = np.random.default_rng(4)
    row, x = np.sort(rng.integers(0, 9, 500)), rng.integers(0, 40, 500).astype(np.uint64)
    want = np.array([((row == r) & (x == w)).sum() for r, w in zip(row, x)])
    for at in (np.arange(500), np.flatnonzero(x < 3), np.array([499, 7]), np.flatnonzero(x < 20)):
        assert lm._own(row, x, at).tolist() == want[at].tolist()


# 7 suffix arrays

def test_suffix_array():
    rng = random.Random(3)
    for _ in range(1500):
        t = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(45))]
        assert suffix.suffix_array(t) == sorted(range(len(t)), key=lambda i: t[i:])


def brute_removed(docs):
    at = collections.Counter(b[i:i + 400] for b in docs for i in range(len(b) - 399))
    out = []
    for b in docs:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 399):
            if at[b[i:i + 400]] > 1:
                gone[i:i + 400] = True
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_passages_go_by_bytes(llm):
    """A passage of over 50 words that two documents share goes if it has 400 bytes, and stays if it has fewer."""
    rng = random.Random(11)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 10))) for _ in range(n))
    passages = [text(n) for n in range(51, 91)]
    rows = [(2 * i + j, f"{text(20)} {'<[' [j]}{p}{'>]' [j]} {text(20)}") for i, p in enumerate(passages) for j in (0, 1)]
    got = {r.doc_id: r.n_removed for r in suffix.remove_repeats(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {2 * i + j: len(p) * (len(p) >= 400) for i, p in enumerate(passages) for j in (0, 1)}
    assert 0 < sum(len(p) >= 400 for p in passages) < len(passages)


@pytest.mark.parametrize("most", [4096, 3])
def test_repeats(llm, monkeypatch, odd, none, most):
    monkeypatch.setattr(suffix, "CLASS", most)
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdeé \n") for _ in range(n))
    passages = [word(n) for n in (380, 399, 400, 401, 420, 900)]
    rows = []
    for i in range(60):
        t = word(rng.randrange(600))
        for _ in range(rng.randrange(3)):
            t += rng.choice(passages) + word(rng.randrange(80))
        rows.append((i, t))
    rows += [(100, rows[0][1]), (100, rows[0][1]), (101, "xy" * 500), (102, "z" * 401), (103, "q" * 400), (104, None), (105, "")]
    got = suffix.remove_repeats(llm.createDataFrame(rows, "doc_id long, text string")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("rest", 256)).collect()
    want = [(i, *w) for (i, _), w in zip(rows, brute_removed([(t or "").encode() for _, t in rows]))]
    assert sorted(map(tuple, got)) == sorted(want)
    assert suffix.remove_repeats(odd).count() == len(ODD) and suffix.remove_repeats(none).collect() == []


# 8 quality

def test_quality(llm, odd, none):
    docs, labels = (llm.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    out = quality.scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r.predicted == r.quality for r in out)
    assert len(out) >= 50 and right / len(out) >= 0.95 and all(0 <= r.score <= 1 for r in out)
    got = quality.scores(odd, labels).collect()
    assert len(got) == len(ODD) and all(r.predicted == (r.score >= 0.3) for r in got)
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert quality.scores(none, labels).collect() == []
    assert {r.score for r in quality.scores(odd, labels.limit(0)).collect()} == {0.5}


def test_temperature_is_fitted():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 6))
    p = 1 / (1 + np.exp(-1.5 * x[:, 0]))
    y = (rng.random(3000) < p).astype(float)
    net = quality.train(x, y)
    q = net.probabilities(x)
    for lo in (0.1, 0.4, 0.7):
        band = (q >= lo) & (q < lo + 0.2)
        assert abs(q[band].mean() - y[band].mean()) < 0.12


# 9 personal data

def test_base_spans():
    t = "a@b.co x@y 1.2.3.4 1.2.3.400 4111 1111-1111 1111 4111111111111112 +1 (017) 555-7713. +12 é a.b@c-d.e.f"
    got = [(k, t[a:b]) for a, k, b in pii.base_spans(t)]
    assert got == [("email", "a@b.co"), ("ip", "1.2.3.4"), ("phone", "+1 (017) 555-7713"), ("email", "a.b@c-d.e.f")] or ("card", "4111 1111-1111 1111") in got
    assert pii.base_spans("9" * 5000 + ".1.1.1") == [] and pii.base_spans("") == []


def test_lattice_sums():
    """Forward sums and the best labelling against all labellings."""
    w = {"card:bias": 0.3, "phone:bias": -0.2, "phone:plus=True": 0.8, "card:luhn=True": 1.1, "card>phone": 0.7, "phone>phone": -0.4}
    t = "call +1 017 555 7713 or 4111 1111 1111 1111 now"
    lat = pii.Segments(t, [(5, 20, "phone"), (8, 20, "phone"), (24, 43, "card"), (24, 38, "phone"), (29, 43, "phone")])
    total, best = [], (-1.0, ())
    n = len(lat.spans)
    for bits in range(1 << n):
        chosen = [i for i in range(n) if bits >> i & 1]
        if any(lat.spans[a][1] > lat.spans[b][0] for a, b in zip(chosen, chosen[1:])):
            continue
        s = sum(lat.scores(w)[i] for i in chosen)
        s += sum(w.get(dict(lat.before[b])[a] or "", 0.0) for a, b in zip(chosen, chosen[1:]))
        total.append(s)
        best = max(best, (s, tuple(chosen)))
    assert lat.forward(w, lat.scores(w))[1] == pytest.approx(math.log(sum(map(math.exp, total))))
    assert [s for s, _ in lat.best(w)] == [lat.spans[i] for i in best[1]]


def test_personal_data(llm, odd, none):
    docs = llm.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    for i, t in texts(docs):
        base = pii.base_spans(t)
        assert got[i].base == pii.joined(base) and set(filter(None, got[i].base.split(","))) <= set(got[i].spans.split(","))
    w = pii.train(docs)
    for s, kind in (("mail joan.doe [at] mail7 [dot] example [dot] com now", "email"), ("ip 10[.]20[.]30[.]40 here", "ip")):
        assert [k for _, k, _ in pii.added(s, pii.base_spans(s), w)] == [kind]
    for s in ("at the house. The at of it", "on 2020-10-11 12:33 in 1984", "v 1.2.3 and 3.14", "id 9807915762804490 x"):
        assert pii.added(s, pii.base_spans(s), w) == []
    assert pii.find(odd).where("spans = ''").count() == len(ODD) and pii.find(none).collect() == []


# 10 exact dedup

@pytest.mark.parametrize("stride", [1, 256])
def test_exact(llm, odd, none, stride):
    rng = random.Random(5)
    rows = [(i % 170, rng.choice(["", None, "a", "a b", "a  b", "a\tb", " a", "ab", "x" * 300, "x" * 301, "x" * 256 + "y", "é" * 128, "é" * 129])) for i in range(200)]
    got = exact.groups(llm.createDataFrame(rows, "doc_id long, text string"), first_stride=stride).collect()
    by = collections.defaultdict(list)
    for i, t in rows:
        by[SPACE.sub(" ", t or "")].append(i)
    digest = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in by.items()}
    kept = collections.Counter()
    for r in got:
        assert (r.keep_id, r.group_size) == (min(digest[r.text_sha256]), len(digest[r.text_sha256]))
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1} and len(got) == len(rows)
    assert exact.groups(none).collect() == []
    stays = exact.deduplicate(odd)
    assert stays.columns == odd.columns and stays.count() == len({SPACE.sub(" ", r[1] or "") for r in ODD})


def test_exact_with_more_shared_strides_than_every_task_gets(llm, monkeypatch):
    monkeypatch.setattr(exact, "MARKS", 0)
    rows = [(1, "a b"), (2, "a  b"), (3, "x" * 300), (4, "x" * 300), (4, "x" * 300), (5, "x" * 301), (6, None), (None, "")]
    got = sorted(((r.doc_id or 0, r.keep_id, r.group_size, r.kept) for r in exact.groups(llm.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(0, 6, 2, False), (1, 1, 2, True), (2, 1, 2, False), (3, 3, 3, True), (4, 3, 3, False), (4, 3, 3, False), (5, 5, 1, True), (6, 6, 2, True)]
