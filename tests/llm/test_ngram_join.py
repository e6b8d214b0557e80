"""Operator 7: components against brute force over all pairs; the bounds that make it exact."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from relaysql.llm import components as cc
from relaysql.llm import ngram_join as j


def brute(rows, k, percent):
    sets = {}
    for key, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        sets[key] = {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()
    up = {key: key for key in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    holders = {}
    for key, s in sets.items():
        common = Counter(e for x in s for e in holders.get(x, ()))
        for e, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[e]) - n):
                a, b = sorted((root(key), root(e)))
                up[b] = a
        for x in s:
            holders.setdefault(x, []).append(key)
    return {key: (len(s), root(key)) for key, s in sets.items()}


def made(seed=2):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "É", "x\x1fy", " "]
    text = lambda n: [r.choice(vocab) for _ in range(n)]
    rows, key = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, "a " * 500), (8, "A  a " * 200)], 100
    passage = text(40)
    for size in (5, 8, 12, 20, 30, 50, 90, 200, 700):
        for _ in range(4):
            base = text(size)
            for _ in range(r.randint(1, 9)):                    # copies of copies, so that chains arise
                w = list(base)
                for _ in range(r.choice([0, 0, 1, 1, 2, size // 25 + 1])):
                    p = r.randrange(len(w))
                    w[p:p + r.randint(0, 1)] = [r.choice(vocab)]
                if r.random() < .6:
                    base = w
                rows.append((key, r.choice([" ", "\n"]).join(w)))
                key += r.choice([1, 1, 7])
    for _ in range(40):                                         # one passage that many share
        rows.append((key, " ".join(text(r.randint(5, 60)) + passage)))
        key += 1
    hub = text(150)
    for _ in range(60):                                         # one large group of near copies
        w = list(hub)
        for _ in range(r.randint(1, 6)):
            w[r.randrange(150)] = r.choice(vocab)
        rows.append((key, " ".join(w)))
        key += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("k,percent,across", [(4, 85, "bits"), (5, 80, "tiles")])
def test_components_against_brute_force(spark, monkeypatch, k, percent, across):
    rows = made()
    docs = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows],
                                 "doc_id bigint, text string, component_id string, key bigint, s0 bigint").repartition(6)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in
           j.similar_documents(docs, shingle_words=k, percent=percent, across=across).collect()}
    assert got == brute(rows, k, percent)


def test_empty_null_ids_and_repeated_rows(spark):
    docs = spark.createDataFrame([(9, "a b c d e f"), (9, "a b c d e f"), (3, "A b c d e f"), (None, "a b c d e f"), (5, None), (5, None)],
                                 "doc_id bigint, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in j.similar_documents(docs).collect())
    assert got == [(0, 2, 0), (3, 2, 3), (5, 0, 5), (5, 0, 5), (9, 2, 3), (9, 2, 3)]
    assert j.similar_documents(docs.limit(0)).count() == 0


def test_pigeonhole_and_sketch_bounds():
    r = np.random.default_rng(1)
    for percent in (80, 85):
        bands = j.Bands(percent)
        for _ in range(300):
            n = int(r.integers(3, 900))
            a = np.unique(r.integers(0, 1 << 53, n, dtype=np.uint64))
            b = a.copy()
            while True:                                         # as far apart as linked sets can be
                c = np.unique(np.append(np.delete(b, r.integers(len(b))), r.integers(0, 1 << 53, dtype=np.uint64)) if r.random() < .5
                              else np.delete(b, r.integers(len(b))))
                common = len(np.intersect1d(a, c))
                if not len(c) or 100 * common < percent * (len(a) + len(c) - common):
                    break
                b = c
            both, bounds = np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)])
            if len(a) == len(b) and (a == b).all():
                continue
            keys = [set(), set()]
            for shift in (0, -1):
                group = bands.of(np.diff(bounds)) + shift
                for i in range(2):
                    if group[i] >= 0 and bands.d[group[i]] > 0:
                        edge = np.array([0, bounds[i + 1] - bounds[i]])
                        keys[i] |= set(j.block_words(both[bounds[i]:bounds[i + 1]], edge, group[i:i + 1], bands)[0].tolist())
            assert keys[0] & keys[1]
            s = j.bit_sketches(both, bounds).view(np.uint64)
            hamming = int(np.bitwise_count(s[0] ^ s[1]).sum())
            assert hamming <= len(np.setxor1d(a, b))
            assert (100 + percent) * hamming <= (100 - percent) * (len(a) + len(b))


def test_pairs_come_out_of_their_first_bucket_only(spark):
    r = random.Random(4)
    lists = [sorted(r.sample(range(60), r.randint(0, 9))) for _ in range(50)]
    first = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    rank = np.array([v for x in lists for v in x], np.int64)
    x, y = (np.array([r.randrange(50) for _ in range(400)]) for _ in range(2))
    assert list(j._met_before(rank, first, x, y)) == [bool(set(lists[a]) & set(lists[b])) for a, b in zip(x, y)]
    assert not j._met_before(rank[:0], np.zeros(3, np.int64), np.array([0]), np.array([1])).any()
    # 30 alike sets in ten buckets each, all components of their own: every pair once
    sets = spark.range(30).selectExpr("id AS doc_id", "100L AS n_shingles", *(f"0L AS {s}" for s in j.SKETCH))
    members = spark.range(30).crossJoin(spark.range(10).withColumnRenamed("id", "key")).selectExpr("key", "id AS doc", "id AS component")
    pairs = [(p.a, p.b) for p in j._across_by_tiles(members, sets, 80).collect()]
    assert sorted(pairs) == [(a, b) for a in range(30) for b in range(a + 1, 30)]


def test_shingles_of_slices_and_long_words():
    texts = pa.array(["x y", None, "a b c d e", "q" * 9_000_000 + " r s t", ""])
    sets, bounds = j.shingle_sets(texts, 4)
    assert list(np.diff(bounds)) == [1, 0, 2, 1, 0]
    for i in range(5):
        own, edge = j.shingle_sets(texts.slice(i, 1), 4)
        assert list(own) == list(sets[bounds[i]:bounds[i + 1]])


@pytest.mark.parametrize("seed", [1, 2])
def test_connected_components(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(200)] + [(5000, 5001 + i) for i in range(50)] + [(7, 7)]
    r.shuffle(edges)
    up = {}
    root = lambda x: x if up.setdefault(x, x) == x else root(up[x])
    for a, b in edges:
        if a != b:
            lo, hi = sorted((root(a), root(b)))
            up[hi] = lo
    got = {x.node: x.component for x in cc.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {n: root(n) for n in up}
    assert cc.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_words_that_a_polynomial_hash_confuses(spark):
    word = "a"
    while len(word) < 2048:
        word = "".join({"a": "ab", "b": "ba"}[c] for c in word)
    other = word.translate({97: 98, 98: 97})
    df = spark.createDataFrame([(1, word), (2, other), (3, word)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in j.similar_documents(df).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_mid_sketches_never_exceed_the_difference():
    r = np.random.default_rng(6)
    sizes = [100, 1500, 1540, 2500, 4000, 9000, 9000, 130_000]
    sets = [np.unique(r.integers(0, 1 << 53, n, dtype=np.uint64)) for n in sizes]
    sets.append(np.unique(np.concatenate([sets[3][:-200], sets[0]])))       # linked with it
    column = j.mid_sketches(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])]))
    assert column.is_null().to_pylist() == [True, True, *[False] * 7]
    assert column[7].values is not None and len(column[7].as_py()) * 64 == j.MID_BITS
    n = np.array([len(x) for x in sets])
    x, y = (k.ravel() for k in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    near = j.Mids(column).near(x, y, n, 80)
    for a, b, found in zip(x.tolist(), y.tolist(), near.tolist()):
        common = len(np.intersect1d(sets[a], sets[b]))
        if min(a, b) < 2 or 100 * common >= 80 * (n[a] + n[b] - common):
            assert found
        elif min(n[a], n[b]) * 2 > max(n[a], n[b]):
            assert not found


def test_unlike_long_sets_do_not_come_out_of_tiles(spark):
    r = np.random.default_rng(7)
    common = r.integers(0, 1 << 53, 2000, dtype=np.uint64)                 # 40 sets of 5,000 that share two fifths
    sets = [np.unique(np.concatenate([common, r.integers(0, 1 << 53, 3000, dtype=np.uint64)])) for _ in range(40)]
    sets.append(np.unique(np.append(sets[5][30:], r.integers(0, 1 << 53, 20, dtype=np.uint64))))
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
    every = np.concatenate(sets)
    first, mids = j.bit_sketches(every, bounds), j.mid_sketches(every, bounds).to_pylist()
    rows = [(i, len(x), *map(int, first[i]), mids[i]) for i, x in enumerate(sets)]
    sets_ = spark.createDataFrame(rows, "doc_id long, n_shingles long, " + ", ".join(f"{s} long" for s in j.SKETCH) + ", mid array<long>")
    members = spark.range(41).selectExpr("7L AS key", "id AS doc", "id AS component")
    assert [(p.a, p.b) for p in j._across_by_tiles(members, sets_, 80).collect()] == [(5, 40)]
    assert j._across_by_tiles(members, sets_.drop("mid"), 80).count() == 41 * 40 // 2      # as it was


def test_stars_are_components_already(spark, monkeypatch):
    names = []
    monkeypatch.setattr(cc, "written", lambda df, name, own=cc.written: names.append(name) or own(df, name))
    got = {x.node: x.component for x in cc.components(spark.createDataFrame([(3, 1), (1, 2), (9, 8)], "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8} and names == ["cc"]


def test_late_links_join_components(spark, monkeypatch):
    """Links found after the first components are formed merge these."""
    r = random.Random(9)
    base = [r.choice("abcdefghijklmnopqrstuvwxyz") * 3 + str(r.randrange(50)) for _ in range(300)]

    def edited(words, n):
        w = list(words)
        for p in r.sample(range(len(w)), n):
            w[p] = "z" + str(r.randrange(10**6))
        return w

    rows = [(i, " ".join(edited(base, r.randint(3, 9)))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    rest = []
    monkeypatch.setattr(j, "written", lambda df, name, own=j.written: rest.append(name) or own(df, name))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in j.similar_documents(docs).collect()}
    assert got == brute(rows, 5, 80)
    assert rest.count("join-labels") == 1
