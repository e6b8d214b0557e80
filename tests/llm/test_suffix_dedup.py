"""Operator 3: against brute force over all 100-byte strings; the queues in files; edge cases."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from relaysql.llm import suffix_dedup as s


def brute(rows):
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: r[0]):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            w = b[i:i + 100]
            if w in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(w)
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[key] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def made(seed=3, n=120):
    r = random.Random(seed)
    text = lambda k: "".join(r.choice("abcdefghij é\n") for _ in range(k))
    passages = [text(r.randint(60, 400)) for _ in range(6)] + ["-" * 30, "ab" * 90, "x" * 250]
    line = text(76)                                              # shorter than a repeat
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 101), (6, "ab" * 300), (7, "é" * 400), (9, text(100))]
    for i in range(20, 20 + n):
        parts = [text(r.randint(0, 200))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 3)
            parts += [p[a:a + r.randint(40, 400)], text(r.randint(0, 120)), line]
        rows.append((i, "".join(parts)))
        if r.random() < .3:
            w = list(r.choice(rows)[1] or "")
            for _ in range(r.randint(0, 3)):
                if w:
                    w[r.randrange(len(w))] = "#"
            rows.append((1000 - i, "".join(w)))
    r.shuffle(rows)
    return rows


def run(spark, rows, schema="doc_id bigint, text string, spans string, doc int"):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], schema).repartition(5)
    out = s.dedup(docs).collect()
    assert len(out) == len(rows)
    return [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.text)).hexdigest()) for r in out]


def test_against_brute_force(spark):
    rows = made()
    got = {k: tuple(v) for k, *v in run(spark, rows)}
    assert got == brute(rows)


def test_ties_null_ids_and_repeated_rows(spark):
    r = random.Random(1)
    a, b = ("".join(r.choice("abcdef") for _ in range(300)) for _ in range(2))
    # equal in id and text: one document, nothing of it is earlier than itself
    got = sorted(run(spark, [(1, a), (1, a), (2, a + b), (None, b)]), key=str)
    assert [(k, removed) for k, _, removed, *_ in got] == [(1, 0), (1, 0), (2, 300), (None, 300)]
    # one id, two texts: the order is by hash, exactly one of the two keeps the shared part
    got = run(spark, [(1, a + "1"), (1, a + "2")])
    assert sorted(removed for _, _, removed, *_ in got) == [0, 300]
    assert run(spark, []) == []


@pytest.mark.parametrize("portion", [7, 64, 1 << 15])
def test_queues_in_files_give_the_same_spans(spark, monkeypatch, portion):
    """The second scan lets every gram through, so that shards are many and large."""
    rows = made(5, 60)
    docs = spark.createDataFrame([(i, 0, t or "") for i, t in rows], "doc bigint, tie bigint, text string").coalesce(1)
    full = spark.sparkContext.broadcast(np.full(1 << (s.BITMAP_BITS - 3), 255, np.uint8))
    tuples = s._tuples(docs, full).withColumnRenamed("shard", "s").selectExpr(
        "s % 5 AS shard", "doc", "tie", "sample", "low", "high", "before", "after").coalesce(1).sortWithinPartitions("shard", "after")
    table = tuples.toArrow()
    monkeypatch.setattr(s, "PORTION", portion)
    spans = [b for b in s._sorted_repeats(table.to_batches(max_chunksize=50))]
    gone = {}
    for b in spans:
        for doc, a, e in zip(*(b.column(c).to_pylist() for c in ("doc", "start", "end"))):
            gone.setdefault(doc, set()).update(range(a, e))
    want = brute(rows)
    # windows repeated within one slice and class are known before the sort: they are not among the tuples
    classes = s._classes(docs).where("tag = 1").collect()
    for r in classes:
        gone.setdefault(r.doc, set()).update(range(r.start, r.end))
    assert {k: len(gone.get(k, ())) for k in want} == {k: v[1] for k, v in want.items()}


def test_long_text_is_cut_in_blocks(monkeypatch):
    r = np.random.default_rng(2)
    data = r.integers(97, 101, 30000).astype(np.uint8)
    offsets = np.array([0, 20000, 20050, 30000])
    whole = [np.concatenate(x) for x in zip(*s.runs(data, offsets))]
    covered = np.zeros(len(data), int)
    for a, b in zip(whole[0], whole[1]):
        covered[a:b + 1] += 1
    valid = np.zeros(len(data), int)
    for a, b in zip(offsets[:-1], offsets[1:]):
        valid[a:max(a, b - 99)] = 1
    assert (covered == valid).all()                              # every window in exactly one run
    assert (whole[2] >= whole[1]).all() and (whole[2] - whole[0] <= s.REACH).all()
    monkeypatch.setattr(s, "BLOCK", 1000)
    s._POWERS.clear()
    parts = [np.concatenate(x) for x in zip(*s.runs(data, offsets))]
    s._POWERS.clear()
    sample = lambda x: {int(w): (int(a), int(g)) for f, l, a, g in zip(*x[:4]) for w in range(f, l + 1)}  # noqa: E731, E741
    assert sample(parts) == sample(whole)                        # blocks choose the same samples


def test_least_between():
    r = np.random.default_rng(3)
    v = r.integers(0, 100, 500).astype(np.int16)
    a = r.integers(0, 500, 2000)
    b = np.minimum(499, a + r.integers(0, 300, 2000))
    assert list(s.least_between(v, a, b)) == [v[x:y + 1].min() for x, y in zip(a, b)]


def test_merged_spans():
    got = s.merged(*(np.array(x) for x in ([1, 1, 2, 1, 1], [0, 0, 0, 0, 0], [5, 0, 0, 8, 30], [9, 5, 3, 12, 31])))
    assert [list(x) for x in got] == [[1, 1, 2], [0, 0, 0], [0, 30, 0], [12, 31, 3]]
    assert len(s.merged(*(np.zeros(0, np.int64) for _ in range(4)))[0]) == 0


def test_padded_rows():
    got = s._padded(pa.array([b"abc", b"", b"z"]), 4, True)
    assert got.tobytes() == b"cba\0\0\0\0\0z\0\0\0"
