"""Operator 1: hits and longest matches against brute force; blocks; edge cases."""

import random
import re

import pytest

from relaysql.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def toks(text):
    return WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items):
    out = {}
    for key, text in docs:
        w, hit, ids = toks(text), set(), set()
        for item, item_text in items:
            v = toks(item_text)
            k = min(10, len(v))
            wins = {tuple(v[i:i + k]) for i in range(len(v) - k + 1)} if k else set()
            for p in range(len(w) - k + 1):
                if wins and tuple(w[p:p + k]) in wins:
                    hit |= set(range(p, p + k))
                    ids.add(item)
        out[key] = (len(w), len(hit), sorted(str(i) for i in ids if i is not None))
    return out


def made():
    r = random.Random(4)
    vocab = ["the", "a", "Ünï", "x1", "of", "b", "c", "日本"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([1, 3, 9, 10, 11, 25, 40]))) for i in range(6, 30) if i % 4] + [
        (1, "Only SHORT one"), (2, ""), (3, None), (4, "..."), (5, text(30)), (5, text(12)), (None, "no id but words " + text(9))]
    items += [(40, items[-2][1]), (41, "prefix " + items[-3][1])]
    docs = [(0, None), (1, ""), (2, "only, short-ONE"), (3, "x")]
    for i in range(10, 60):
        parts = [text(r.randint(0, 30)) for _ in range(3)]
        for _ in range(r.randint(0, 2)):
            v = (r.choice(items)[1] or "").split()
            a = r.randint(0, max(0, len(v) - 8))
            parts.insert(r.randint(0, 3), ", ".join(v[a:a + r.randint(5, 30)]))
        docs.append((i, "\n".join(parts)))
    docs.append((60, text(30000) + " " + items[5][1]))
    return docs, items


DOCS, ITEMS = made()


def run(spark, docs, items, **k):
    a = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id bigint, text string, matches string, n_words int")
    b = spark.createDataFrame(items, "item_id bigint, text string")
    return d.find_matches(a, b, **k)


# one block, several in one pass, and several passes
@pytest.mark.parametrize("limit,step", [(d.BLOCK_BYTES, d.STEP_BYTES), (700, d.STEP_BYTES), (700, 1)])
def test_against_brute_force(spark, limit, step):
    found = run(spark, DOCS, ITEMS, block_bytes=limit, step_bytes=step)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and ("decontaminate-step" in plan) == (step == 1)
    got = {r.doc_id: (r.n_words, r.n_hit, r.items) for r in found.selectExpr(
        "doc_id", "n_words", f"{d.N_HIT} AS n_hit", f"{d.ITEMS} AS items").collect()}
    assert got == brute(DOCS, ITEMS)


def test_matches_are_verbatim_and_longest(spark):
    texts, items = dict(DOCS), {}
    for i, t in ITEMS:
        items.setdefault(i, []).append(toks(t))
    seen = 0
    for r in run(spark, DOCS, ITEMS).collect():
        w = toks(texts[r.doc_id])
        for m in r.matches:
            i = None if m.item_id is None else int(m.item_id)
            a, b, n = m.start, m.item_start, m.length
            fits = [v for v in items[i] if w[a:a + n] == v[b:b + n] and len(v[b:b + n]) == n
                    and (a == 0 or b == 0 or w[a - 1] != v[b - 1])
                    and (a + n == len(w) or b + n == len(v) or w[a + n] != v[b + n])]
            assert fits
            seen += 1
    assert seen > 20


def test_empty_tables_and_repeated_rows(spark):
    assert run(spark, [], ITEMS).count() == 0
    assert [len(r.matches) for r in run(spark, DOCS, []).collect()] == [0] * len(DOCS)
    twice = run(spark, [(1, "only short one"), (1, "only short one"), (None, "only short one")], ITEMS).collect()
    assert [len(r.matches) for r in twice] == [1, 1, 1]


def test_removal_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "only short one", "x", 2), (2, "clean", None, None)], "doc_id bigint, text string, matches string, _row int")
    out = d.remove_contaminated(docs, spark.createDataFrame([(1, "only short one")], "item_id bigint, text string"))
    assert out.columns == docs.columns and [tuple(r) for r in out.collect()] == [(2, "clean", None, None)]
