"""Operator 11 against brute force: every anchor and row, whole numbers in Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from relaysql.llm import hard_negatives as op

SCHEMA = "vec_id long, embedding array<float>, label int, extra string, q string, length string"


def brute(rows, every, n_pos=5, n_neg=10):
    one = {}
    for r in rows:
        if r[0] is None or r[2] is None or r[1] is None or any(x is None or not math.isfinite(x) for x in r[1]):
            continue
        v = (r[2], [math.floor(256 * x) for x in r[1]])
        one[r[0]] = max(one.get(r[0], v), v)
    out = []
    for a, (label, q) in one.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), b, other) for b, (other, p) in one.items() if b != a and len(p) == len(q))
        for s, b, _ in [t for t in scored if t[2] == label][:n_pos]:
            kept = [(-t, i) for t, i, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s][:n_neg]
            out += [(a, b, k + 1, i, -s, t) for k, (t, i) in enumerate(kept)]
    return sorted(out)


def make(rng, n, d=6, labels=3):
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    rows = []
    for i in range(n):
        c = rng.choice(centres)
        scale = rng.choice([0.1, 1.0, 5.0])
        v = [float(f"{scale * (x + rng.gauss(0, 0.7)):.3f}") for x in c]
        rows.append((i, [F32(x) for x in v], rng.randrange(labels), "e", "q", "l"))
    return rows


def F32(x):
    import numpy as np

    return float(np.float32(x))


def run(spark, rows, every=10, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = op.hard_negatives(df, F.col("vec_id") % every == 0, **kw)
    return sorted(tuple(r) for r in out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(op, "BUCKET_ROWS", 16)
    monkeypatch.setattr(op, "CHUNK_BYTES", 3000)       # several passes
    rows = make(rng, 300)
    found = run(spark, rows)
    assert found and found == brute(rows, 10)


def test_edges(spark):
    rng = random.Random(5)
    rows = make(rng, 60)
    base = rows[10]
    rows += [(None, base[1], 1, "", "", ""), (61, None, 1, "", "", ""), (62, base[1], None, "", "", ""),
             (63, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1, "", "", ""), (64, [float("nan")] * 6, 1, "", "", ""),
             (65, [float("inf")] * 6, 1, "", "", ""), (70, [], 1, "", "", ""), (71, [], 1, "", "", ""), (72, [], 2, "", "", ""),
             (80, [1.0, 2.0], 1, "", "", ""), (81, [1.0, 2.0], 1, "", "", ""), (82, [1.0, 1.0], 2, "", "", ""),
             (90, [0.0] * 6, 0, "", "", "")]
    rows += [rows[20], rows[20], (30, rows[5][1], 2, "", "", ""), rows[40]]     # repeated rows and ids
    rows += [(100 + i, base[1], base[2], "", "", "") for i in range(30)]        # ties
    assert run(spark, rows) == brute(rows, 10)
    assert run(spark, rows, n_positives=2, n_negatives=3) == brute(rows, 10, 2, 3)


def test_empty_and_long(spark):
    assert run(spark, []) == []
    with pytest.raises(Exception, match="do not fit"):
        run(spark, [(0, [3e30], 1, "", "", ""), (1, [1.0], 1, "", "", "")])


def test_candidates_lose_nothing_and_prune():
    import numpy as np

    rng = np.random.default_rng(3)
    q = rng.integers(-300, 300, (500, 8))
    lengths = np.sqrt((q.astype(float) ** 2).sum(1))
    bucket = op.Bucket(np.arange(500), np.zeros(500), q, lengths)
    fewer = 0
    for i in range(0, 500, 7):
        v = q[i].astype(float)
        scores = q @ q[i]
        least = int(np.sort(scores)[-5])
        places = bucket.candidates(v, float(np.sqrt(v @ v)), least)
        assert set(np.flatnonzero(scores >= least)) <= set(places.tolist())
        fewer += len(places) < 500
    assert fewer > 50
