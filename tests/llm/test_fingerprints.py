"""Operator 12 against a byte-by-byte model, and its fingerprints' behaviour."""

import hashlib
import random

import pytest

from relaysql.llm import fingerprints as op

MASK = (1 << 32) - 1


def model_cuts(text: bytes):
    """The rule one byte after another."""
    gear = op._GEAR.tolist()
    ends, start = [], 0
    for i in range(len(text)):
        h = 0
        for b in text[max(0, i - op.WINDOW + 1):i + 1]:
            h = ((h << 1) + gear[b]) & MASK
        size = i + 1 - start
        bits = op.STRICT_BITS if size < op.NORMAL else op.LOOSE_BITS
        if size == op.LONGEST or (size >= op.SHORTEST and h >> (32 - bits) == 0):
            ends.append(i + 1)
            start = i + 1
    if start < len(text):
        ends.append(len(text))
    return ends


def model_set(text: bytes):
    ends = model_cuts(text)
    return {hashlib.blake2b(text[a:b], digest_size=8).hexdigest(): b - a for a, b in zip([0] + ends, ends)}


def brute(rows):
    def key(r):
        return (-r[0], r[1] is not None, (r[1] or "").encode())

    order = sorted((r for r in rows if r[0] is not None), key=key)
    out = []
    pairs = [(r[0], r[1] or "", order[(i + 1) % len(order)][1] or "") for i, r in enumerate(order)]
    pairs += [(None, r[1] or "", "") for r in rows if r[0] is None]
    for d, t, u in pairs:
        half = len(t) // 2
        e = t[:len(t) - half] + u[:half]
        own, made, following = (model_set(x.encode()) for x in (t, e, u))
        near = [1.0 if not own and not other else 0.0 if not own or not other else
                sum(n for k, n in own.items() if k in other) / sum(own.values()) for other in (made, following)]
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(),
                    ",".join(f"{k}:{n}" for k, n in sorted(own.items())), ",".join(f"{k}:{n}" for k, n in sorted(made.items())), *near))
    return sorted(out, key=repr)


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefgéßж😀 ") for _ in range(rng.randrange(1, 9))) for _ in range(n))


@pytest.mark.parametrize("pieces", [1 << 20, 300])
def test_equals_the_model(spark, monkeypatch, pieces):
    monkeypatch.setattr(op, "SLICE_BYTES", pieces)
    rng = random.Random(7)
    rows = [(i, prose(rng, rng.choice([0, 1, 3, 30, 200]))) for i in rng.sample(range(-50, 1000), 60)]
    rows += [(2000, None), (2001, ""), (2002, rows[0][1]), (2003, rows[0][1]), (None, "without an id " * 9), (None, None), (None, "")]
    rows += [rows[5], rows[5], (rows[6][0], "another text of the same id"), (2004, "x" * 5000), (2005, prose(rng, 4000))]
    df = spark.createDataFrame([(*r, "e", 1) for r in rows], "doc_id long, text string, part string, tail int").repartition(5)
    got = sorted((tuple(r) for r in op.compare_with_edits(df).collect()), key=repr)
    assert got == brute(rows)


def test_one_row_and_none(spark):
    def run(rows):
        return [tuple(r) for r in op.compare_with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()]

    assert run([]) == []
    assert run([(7, "abcd")]) == brute([(7, "abcd")])         # "ab" + "ab"
    assert run([(None, None)])[0][1:] == (0, hashlib.sha256(b"").hexdigest(), "", "", 1.0, 1.0)


def test_shifts_hurt_little():
    rng = random.Random(3)
    text = prose(rng, 3000).encode()
    whole = op.chunk_sets([text])[0]
    moved = op.chunk_sets([b"put in front " + text[:5000] + b"and within" + text[5000:]])[0]
    assert op.likeness(whole, moved) > 0.97
    half = op.chunk_sets([text[:len(text) // 2]])[0]
    assert 0.47 < op.likeness(whole, half) < 0.51 and op.likeness(half, whole) > 0.98
    assert op.likeness(whole, op.chunk_sets([prose(rng, 3000).encode()])[0]) == 0
    sizes = [n for n in whole.values()]
    assert 40 < sum(sizes) / len(sizes) < 100 and max(sizes) <= op.LONGEST


def test_column_of_fingerprints(spark):
    df = spark.createDataFrame([(1, "some text"), (2, None), (3, "some text")], "doc_id int, text string")
    got = {r.doc_id: r.fingerprint for r in op.with_fingerprints(df).collect()}
    assert got[1] == got[3] == op.fingerprint(op.chunk_sets([b"some text"])[0]) and got[2] == ""
