"""Operator 13 against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from relaysql.llm import spelling_variants as op

LETTERS = "abcxyzÀéÿ"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        near = [(-m, v) for v, m in counts.items() if one_edit(v, w)]
        form = min(near)[1] if near and -min(near)[0] >= 10 * n else None
        out[w] = (form, n, len(near), counts[form] if form else None)
    rows = []
    for w, (form, n, near, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, near, form_n))
    return sorted(rows)


def run(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return sorted(tuple(r) for r in op.spelling_variants(df).collect())


def vocabulary(rng, n):
    counts = {}
    while len(counts) < n:
        base = "".join(rng.choice(LETTERS) for _ in range(rng.choice([1, 2, 3, 6, 7, 8, 9, 12])))
        m = rng.choice([2, 3, 20, 400, 9000])
        for _ in range(rng.randrange(1, 7)):
            counts[base] = m
            at = rng.randrange(len(base) + 1)
            base = rng.choice([base[:at] + rng.choice(LETTERS) + base[at:], base[:at] + base[at + 1:], base[:at] + rng.choice(LETTERS) + base[at + 1:]]) or "q"
            m = rng.choice([m, m * 10, max(2, m // 10), max(2, m // 11)])
    return counts


@pytest.mark.parametrize("tile,cells,batch", [(256, 1 << 24, 1 << 16), (3, 200, 40), (8, 1, 7)])
def test_equals_brute_force(spark, monkeypatch, tile, cells, batch):
    monkeypatch.setattr(op, "TILE", tile)
    monkeypatch.setattr(op, "CELLS", cells)
    monkeypatch.setattr(op, "BATCH_ROWS", batch)
    counts = vocabulary(random.Random(tile), 250)
    # one front that very many words share, chains of forms, very long words
    counts.update({f"commonly{a}{b}": 2 for a in LETTERS for b in LETTERS})
    counts.update({"chainword" + "s" * i: 2 * 10 ** i for i in range(9)})
    counts.update({"x" * 5000: 100, "x" * 4999: 5, "x" * 4998 + "y": 7})
    assert run(spark, counts) == brute(counts)


def model_counts(rows):
    counts = Counter()
    for d, text in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                i = h % len(w)
                w = w[:i] + w[i + 1:]
            if len(w) >= 7:
                counts[w] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_query_equals_model(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(op, "MOST_HELD", 20)
    rng = random.Random(4)
    base = ["Spelling", "spellings", "VARIANT", "Éléphant", "éléphants", "short", "documents", "document", "a" * 300]
    rows = [(i, " ".join(rng.choice(base) + rng.choice([" ", ", ", "-", "1", "Ā"]) for _ in range(rng.randrange(0, 60)))) for i in range(150)]
    rows += [(None, "documents Documents"), (7, None), (8, ""), rows[3], rows[3]]
    spark.createDataFrame([(*r, "en", 3) for r in rows], "doc_id long, text string, word string, n int").write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in op.op13_spelling_variants(spark, str(tmp_path)).collect())
    counts = model_counts(rows)
    assert len(counts) > 20 and got == brute(counts)


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert op.op13_spelling_variants(spark, str(tmp_path)).collect() == []


def test_blocks_hold_every_near_pair():
    rng = random.Random(9)
    words = sorted(vocabulary(rng, 120))
    n = len(words)
    z = np.zeros(n, bool)
    lengths = np.array([len(w) for w in words])
    got = set()
    for size in set(lengths):
        keep = [k for k in range(n) if lengths[k] in (size, size + 1)]
        i, j = op.near_pairs([words[k] for k in keep], np.zeros(len(keep)), np.full(len(keep), size), z[:len(keep)],
                             np.array([lengths[k] > size for k in keep]), z[:len(keep)], z[:len(keep)])
        got |= {frozenset((keep[a], keep[b])) for a, b in zip(i, j)}
    assert got == {frozenset((a, b)) for a in range(n) for b in range(a) if one_edit(words[a], words[b])}
