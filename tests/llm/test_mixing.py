"""Operator 5: windows and deviation of the schedule; every document used; edge cases."""

import math
from collections import Counter, defaultdict

import pytest

from relaysql.llm import mixing as m

SCHEMA = "doc_id bigint, text string, source string, slot int, place string"


def docs(spark, sizes, start=0):
    rows = []
    for source, n in sizes.items():
        rows += [(start + len(rows) + i, f"t{i}", source, 5, "x") for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def weights(spark, w):
    return spark.createDataFrame([("null" if k is None else "s" + k, float(v)) for k, v in w.items()], "source_key string, weight double")


def check(rows, sizes, slots_of, period, block, repeat=True):
    """The promises of the schedule, from its rows alone."""
    at = {}
    for r in rows:
        at.setdefault(r.slot, set()).add((r.source_key, r.block))
        w = slots_of[r.source_key]
        assert r.release == r.block * period // w and r.deadline == math.ceil((r.block + 1) * period / w)
        assert r.release <= r.slot < r.deadline
    assert all(len(x) == 1 for x in at.values())
    if repeat:
        assert sorted(at) == list(range(max(at) + 1))            # no slot is left empty
        given = Counter()
        for t in range(max(at) + 1):
            given[next(iter(at[t]))[0]] += 1
            for s, w in slots_of.items():
                assert abs(given[s] - w * (t + 1) / period) < 1
    used = defaultdict(Counter)
    for r in rows:
        used[r.source_key][r.place] += 1
        n = sizes[r.source_key]
        blocks = math.ceil(n / block)
        assert r.block == r.epoch * blocks + r.place // block
    for s, n in sizes.items():
        assert sorted(used[s]) == list(range(n))                 # every document at least once
        assert max(used[s].values()) - min(used[s].values()) <= 1


@pytest.mark.parametrize("repeat", [True, False])
def test_schedule_keeps_its_windows(spark, monkeypatch, repeat):
    monkeypatch.setattr(m, "BUCKET_DOCS", 40)
    sizes = {"hot": 400, "b": 90, "c": 33, "d": 1, None: 7}
    w = {"hot": 0.31, "b": 0.29, "c": 0.2, "d": 0.05, None: 0.15, "absent": 3.0}
    plan = m.schedule(docs(spark, sizes), weights(spark, w), block_docs=4, period=97, repeat=repeat)
    rows = plan.collect()
    keys = {"null" if k is None else "s" + k: n for k, n in sizes.items()}
    counts = spark.createDataFrame(list(keys.items()), "source_key string, n bigint")
    slots_of = {r.source_key: r.w for r in m.slot_counts(counts, weights(spark, w), 97).collect()}
    assert sum(slots_of.values()) == 97 and slots_of["shot"] > slots_of["sc"] > slots_of["sd"] >= 1
    check(rows, keys, slots_of, 97, 4, repeat)
    if not repeat:
        assert len(rows) == sum(sizes.values()) and {r.epoch for r in rows} == {0}


def test_slot_counts_for_odd_weights(spark):
    counts = spark.createDataFrame([("sa", 5), ("sb", 5), ("sc", 5)], "source_key string, n bigint")
    for w in ({}, {"a": 0, "b": -1, "c": None}, {"a": 1}, {"a": 1e-9, "b": 1e9, "c": 1}):
        given = spark.createDataFrame([("s" + k, None if v is None else float(v)) for k, v in w.items()], "source_key string, weight double")
        got = {r.source_key: r.w for r in m.slot_counts(counts, given, 50).collect()}
        assert sum(got.values()) == 50 and min(got.values()) >= 1, w
    with pytest.raises(Exception, match="more sources than slots"):
        m.slot_counts(counts, given, 2).collect()


def test_slots_are_the_weights_within_one_slot(spark):
    w = {f"s{i}": 1.0 + i * i for i in range(40)}
    counts = spark.createDataFrame([(k, 5) for k in w], "source_key string, n bigint")
    got = {r.source_key: r.w for r in m.slot_counts(counts, spark.createDataFrame(list(w.items()), "source_key string, weight double")).collect()}
    exact = {k: 1000 * v / sum(w.values()) for k, v in w.items()}
    assert all(abs(got[k] - exact[k]) < 1.05 for k in w) and sum(got.values()) == 1000


def test_more_sources_than_slots_follow_the_weights(spark):
    small = 1100                                                   # over PERIOD; a third of all rows in one source
    sizes = {"hot": 1650, **{f"c{i}": 2 + i % 3 for i in range(small)}}
    key = lambda k: "s" + k
    weight = {key(k): n ** m.ALPHA for k, n in sizes.items()}
    total = sum(weight.values())
    rows = m.schedule(docs(spark, sizes), block_docs=1).collect()
    assert {r.slot for r in rows} == set(range(max(r.slot for r in rows) + 1)) and len({r.slot for r in rows}) == len(rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)
    used = defaultdict(Counter)
    for r in rows:
        used[r.source_key][r.place] += 1
        assert r.block == r.epoch * sizes[r.source_key[1:]] + r.place
    for k, n in sizes.items():
        assert sorted(used[key(k)]) == list(range(n)) and max(used[key(k)].values()) - min(used[key(k)].values()) <= 1
    count = {k: sum(c.values()) for k, c in used.items()}
    share = {k: v / total for k, v in weight.items()}
    assert abs(count["shot"] / len(rows) - share["shot"]) < 0.002
    off = [abs(count[k] - len(rows) * share[k]) / (2 + 0.2 * len(rows) * share[k]) for k in share]
    assert max(off) < 1                                            # two levels: two blocks, and the slots' rounding


def test_tiny_sources_share_a_slot(spark):
    w = {"big": 1.0, "b": 0.2, **{f"t{i}": 1e-6 * 7.0 ** (i % 3) for i in range(90)}}
    sizes = {"big": 300, "b": 60, **{f"t{i}": 1 for i in range(90)}}
    counts = spark.createDataFrame([("s" + k, n) for k, n in sizes.items()], "source_key string, n bigint")
    tree = m.levels(counts, weights(spark, w))
    root = {r.source_key: r.w for r in tree[-1][0].collect()}
    assert len(tree) > 1 and abs(root["sbig"] - 1000 / 1.2) < 3 and abs(root["sb"] - 200 / 1.2) < 3
    sums = Counter()
    for level, period in tree:
        per = Counter()
        for r in level.collect():
            per[r.g] += r.w
        assert set(per.values()) == {period}
        sums.update(per.keys())
    assert max(sums.values()) == 1
    only = m.levels(counts, weights(spark, {"none": 1.0}))          # no weight at all
    assert sum(r.w for r in only[-1][0].collect()) == 1000


def test_documents_come_in_the_order_of_the_schedule(spark):
    table = docs(spark, {"a": 30, "b": 10})
    out = m.mixed_documents(table, weights=weights(spark, {"a": 1, "b": 1}), block_docs=2, period=10)
    rows = out.collect()
    assert out.columns == table.columns
    assert [r.source for r in rows][:20] == [r.source for r in rows][20:40]
    assert Counter(r.source for r in rows) == {"a": 30, "b": 28}  # until the last block of a has run
    for i in range(0, 58, 2):
        assert rows[i].source == rows[i + 1].source              # whole blocks
    assert len({r.doc_id for r in rows}) == 40


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(1, "a", "s", 1, None), (1, "a", "s", 1, None), (1, "b", "s", 1, None), (None, "c", "s", 1, None), (None, "d", None, 1, None)]
    table = spark.createDataFrame(rows, SCHEMA)
    out = m.mixed_documents(table, repeat=False, period=10).collect()
    assert sorted(map(tuple, out), key=str) == sorted(rows, key=str)
    assert m.schedule(table.limit(0)).count() == 0
    assert m.mixed_documents(table.limit(0)).count() == 0


def test_main_path_is_native(spark):
    plan = m.mixed_documents(docs(spark, {"a": 3}))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
