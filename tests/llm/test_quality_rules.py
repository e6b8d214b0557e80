"""Operator 4: counts against a plain loop, models against a NumPy MCD, edge cases."""

import collections
import re

import numpy as np
import pytest

from relaysql.llm import quality_rules as q


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    under = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(under),
            n < 50 or 100 * len(under) > 50 * n)


TEXTS = [None, "", "   \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y z x y z x y", "é ü ñ # <b>|$%&*",
         "one\none\n\n \none two\none\r\n", "a b c d a b c e b c d", "w " * 60000, " ".join(f"w{i}" for i in range(40000)),
         "p q r " * 30 + "tail words here", "\x0b\x0cx\x0dy \x1fz", "line\n" * 500]


def test_counts_against_a_loop(spark):
    docs = spark.createDataFrame([(i, t, 7, "c") for i, t in enumerate(TEXTS)], "doc_id int, text string, n_words int, _words string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in q.text_stats(docs, "text", ("doc_id",)).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


def features(r):
    n = r["n_words"]
    return [np.log(n), np.log(r["word_chars"] / n), np.log(1 + 20 * r["n_symbols"] / n),
            np.log(1 + 100 * r["n_dup_lines"] / n), r["n_repeat_words"] / n]


def mcd(x):
    """Plain MCD: the same two starts, concentration on the closest share, one reweighting."""
    floor = np.diag([s ** 2 for _, s in q.FEATURES.values()])
    h = int(np.ceil(q.COVERED * len(x)))
    fit = lambda rows, f: (rows.mean(0), f * np.cov(rows.T, bias=True) + floor)
    far = lambda m: np.einsum("ni,ij,nj->n", x - m[0], np.linalg.inv(m[1]), x - m[0])
    lo, mid, hi = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    best = None
    for m in ((mid, np.diag(((hi - lo) / 1.349) ** 2) + floor), fit(x, 1.0)):
        for _ in range(q.C_STEPS):
            m = fit(x[np.argsort(far(m), kind="stable")[:h]], q.consistency(q.COVERED))
        if best is None or np.linalg.det(m[1]) < np.linalg.det(best[1]):
            best = m
    return far(fit(x[far(best) <= q.chi2_quantile(q.REWEIGHT, q.P)], q.consistency(q.REWEIGHT)))


def made(n, seed=1, bad=0.2):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = int(np.exp(r.normal(6, 0.8))) + 60
        junk = r.random() < bad
        rows.append((i, "en" if i % 4 else "de", "hot" if i % 3 else "cold", words, int(words * r.normal(5, 0.2)),
                     int(words * r.uniform(1, 3)) if junk else int(r.integers(0, 3)), int(r.integers(0, 2)), int(words * r.uniform(0, .05)), False))
    return rows


SCHEMA = ("doc_id int, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, "
          "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean")


def test_models_against_numpy(spark):
    stats = spark.createDataFrame(made(3000), SCHEMA)
    rows = stats.collect()
    got = {r.doc_id: r.kept for r in q.judge(stats, q.fit_outlier_models(stats)).collect()}
    for key in {(r.lang, r.source) for r in rows}:
        group = [r for r in rows if (r.lang, r.source) == key]
        d2 = mcd(np.array([features(r.asDict()) for r in group]))
        want = {r.doc_id: bool(d <= q.CUTOFF) for r, d in zip(group, d2)}
        near = {r.doc_id for r, d in zip(group, d2) if 0.8 < d / q.CUTOFF < 1.25}   # the share is cut at a bin's edge
        assert all(got[i] == k for i, k in want.items() if i not in near)
        assert sum(not k for k in want.values()) > 0.1 * len(group)


def test_small_groups_use_coarser_models_and_nulls_are_a_group(spark):
    rows = made(1000) + [(5000 + i, None, None, 300, 1500, 0, 0, 0, False) for i in range(3)]
    rows += [(6000, "en", "tiny", 300, 1500, 900, 0, 0, False), (6001, "xx", "tiny", 300, 1500, 0, 0, 0, False),
             (6002, "en", "hot", 0, 0, 0, 0, 0, True), (6001, "xx", "tiny", 300, 1500, 0, 0, 0, False)]
    stats = spark.createDataFrame(rows, SCHEMA)
    got = collections.defaultdict(list)
    for r in q.judge(stats, q.fit_outlier_models(stats)).collect():
        got[r.doc_id].append(r.kept)
    assert len(got[6001]) == 2 and all(got[6001]) and got[6000] == [False] and got[6002] == [False]
    assert all(got[5000 + i] == [True] for i in range(3))


def test_clear_cases_fall_on_one_feature(spark):
    far = [(300, 1500, 60, 0, 0), (300, 1500, 0, 12, 0), (300, 1500, 0, 0, 120), (4500, 22500, 0, 0, 0), (300, 2300, 0, 0, 0)]
    near = [(300, 1500, 2, 0, 0), (300, 1500, 0, 1, 0), (300, 1500, 0, 0, 40), (900, 4500, 0, 0, 0), (300, 1700, 0, 0, 0)]
    rows = [(i, "en", "plain", 300, 1500, 0, 0, 0, False) for i in range(400)]
    rows += [(1000 + i, "en", "plain", *x, False) for i, x in enumerate(far)]
    rows += [(2000 + i, "en", "plain", *x, False) for i, x in enumerate(near)]
    stats = spark.createDataFrame(rows, SCHEMA)
    got = q.judge(stats, q.fit_outlier_models(stats)).where("not kept").collect()
    assert sorted(r.doc_id for r in got) == [1000 + i for i in range(len(far))]


@pytest.mark.parametrize("n", [0, 5])
def test_few_rows_are_never_rejected_by_distance(spark, n):
    stats = spark.createDataFrame(made(n), SCHEMA)
    assert q.judge(stats, q.fit_outlier_models(stats)).where("kept").count() == n


def test_filter_returns_the_columns_of_its_input(spark):
    text = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text, "en", "s", 3, "x"), (2, "short", "en", "s", 3, "x"), (1, text, None, None, 3, None)],
                                 "doc_id int, text string, lang string, source string, n_words int, m0 string")
    out = q.quality_filter(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 1]


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s")], "doc_id int, text string, lang string, source string")
    plan = q.quality_filter(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_chi_square():
    assert abs(q.chi2_cdf(q.chi2_quantile(0.975, 5), 5) - 0.975) < 1e-12
    assert abs(q.chi2_quantile(0.95, 1) - 3.841458820694124) < 1e-9
