"""Operator 4: rule statistics of texts and robust multivariate outliers.

``text_stats`` adds word, symbol, line and repetition counts with SQL functions.
``fit_outlier_models`` estimates location and scatter of the transformed counts
per language and source by the minimum covariance determinant: from two starts
(medians and quartiles; mean and covariance) concentration steps move each
estimate to the fraction ``COVERED`` of its rows that lie closest, the start
with the smaller determinant wins, and a reweighting step follows.
``judge`` rejects what lies beyond a chi-square bound in Mahalanobis distance.

Each step is one pass over a narrow table of counts: rows are aggregated to
moments per model and distance bin (partial aggregation, a bounded number of
bins), and the covered share is cut at a bin's edge, so no group is ever sorted
or collected, however large one source is. Sums are exact integers; a rerun gives
the same models. Rows that fail the base rules are not used for fitting.

A language and source with fewer than ``MIN_ROWS`` rows uses its language's
model, a language with fewer the model of all rows; where even those are fewer
nothing is rejected by distance. Null lang or source is a group of its own.
Null and blank texts have no words and fail the base rule. Repeated rows count as
often as they stand there; an empty table gives an empty result. Columns of the
input with names used here are not passed on by ``text_stats`` except those named
in ``keep``.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.llm.common import table, written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
COVERED = 0.75            # share of a group's rows that the determinant is minimised over
C_STEPS = 3
MIN_ROWS = 200            # fewer rows: the next coarser model
TAIL = 1e-3               # chance that a row of the fitted normal law is rejected
REWEIGHT = 0.975
BINS = 32                 # distance bins per unit of ln(d2)
SCALE = 10000             # features are whole numbers of this fraction

# name -> (SQL over the counts, least standard deviation that a model may have: its
# square is added to the variance, so that a source that never varies has a model)
FEATURES = {
    "f1": ("ln(n_words)", 0.5),
    "f2": ("ln(cast(word_chars as double) / n_words)", 0.08),
    "f3": ("ln(1 + 20 * cast(n_symbols as double) / n_words)", 0.2),
    "f4": ("ln(1 + 100 * cast(n_dup_lines as double) / n_words)", 0.25),
    "f5": ("cast(n_repeat_words as double) / n_words", 0.08),
}
P = len(FEATURES)
NAMES = list(FEATURES)
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


def chi2_cdf(x: float, k: int) -> float:
    """Series of the regularised lower incomplete gamma function."""
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return total * math.exp(a * math.log(half) - half - math.lgamma(a))


def chi2_quantile(q: float, k: int) -> float:
    lo, hi = 1e-9, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, k) < q else (lo, mid)
    return hi


def consistency(q: float) -> float:
    """What the covariance of the closest share ``q`` is too small by."""
    return q / chi2_cdf(chi2_quantile(q, P), P + 2)


CUTOFF = chi2_quantile(1 - TAIL, P)


# ---------------------------------------------------------------- counts

def text_stats(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(
        *keep, text.alias("_text"),
        F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("_lines"))
    w = F.col("_words")
    df = df.select(
        *keep, F.size(w).cast("bigint").alias("n_words"),
        F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"[#*$%&|<>]+", ""))).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(w) < 3, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))).alias("_windows"))
    # windows found twice: sorted by hash, equal neighbours; then the words under them
    some = F.size(F.array_distinct("_windows")) < F.size("_windows")
    pairs = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(some, pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    s = F.col("_sorted")

    def twin(x: Column, k: Column) -> Column:
        before = F.get(s, k - 1)["h"]
        after = F.get(s, k + 1)["h"]
        return x["h"].eqNullSafe(before) | x["h"].eqNullSafe(after)

    df = df.withColumn("_at", F.array_sort(F.transform(F.filter(s, twin), lambda x: x["i"])))
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3)))),
        F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    # through a generator: filters that users put on the counts stay above them, and do
    # not carry copies of these expressions down to the scan
    counts = F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words"))
    df = df.select(*keep, F.inline(F.array(counts)))
    return df.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


# ---------------------------------------------------------------- models
# The expressions below are plain SQL, so that the oracle can run the same arithmetic.

def feature_sql(name: str) -> str:
    return f"CAST(round({SCALE} * ({FEATURES[name][0]})) AS BIGINT)"


def moment_sql(kind: str) -> list[tuple[str, str]]:
    """Sums over rows; ``kind`` is the exact integer type to add in."""
    return ([("c", "count(*)")] + [(f"s{i}", f"sum(CAST({n} AS {kind}))") for i, n in enumerate(NAMES)]
            + [(f"s{i}_{j}", f"sum(CAST({NAMES[i]} * {NAMES[j]} AS {kind}))") for i, j in PAIRS])


MOMENTS = ["c", *(f"s{i}" for i in range(P)), *(f"s{i}_{j}" for i, j in PAIRS)]


def scatter_layers(factor: float) -> list[list[tuple[str, str]]]:
    """From moments to means ``m`` and covariances ``v``; each layer uses the one before."""
    def num(name: str) -> str:
        return f"CAST({name} AS DOUBLE)"
    return [
        [(f"m{i}", f"{num(f's{i}')} / c / {SCALE}") for i in range(P)],
        [(f"v{i}_{j}", f"{factor!r} * ({num(f's{i}_{j}')} / c / {SCALE * SCALE} - m{i} * m{j})"
          + (f" + {FEATURES[NAMES[i]][1] ** 2!r}" if i == j else "")) for i, j in PAIRS],
    ]


def factor_layers() -> list[list[tuple[str, str]]]:
    """From covariances to the inverse ``k`` of the Cholesky factor, and ``logdet``."""
    layers = []
    for j in range(P):
        before = "".join(f" - l{j}_{t} * l{j}_{t}" for t in range(j))
        layers.append([(f"l{j}_{j}", f"sqrt(greatest(v{j}_{j}{before}, 1e-9))")])
        below = [(f"l{i}_{j}", f"(v{i}_{j}" + "".join(f" - l{i}_{t} * l{j}_{t}" for t in range(j)) + f") / l{j}_{j}")
                 for i in range(j + 1, P)]
        if below:
            layers.append(below)
    layers.append([(f"k{i}_{i}", f"1 / l{i}_{i}") for i in range(P)])
    for gap in range(1, P):
        layers.append([(f"k{i}_{i - gap}", "-(" + " + ".join(f"l{i}_{t} * k{t}_{i - gap}" for t in range(i - gap, i))
                        + f") / l{i}_{i}") for i in range(gap, P)])
    layers.append([("logdet", " + ".join(f"ln(l{i}_{i})" for i in range(P)))])
    return layers


MODEL = [f"m{i}" for i in range(P)] + [f"k{i}_{j}" for i, j in PAIRS] + ["logdet"]


def distance_sql() -> str:
    x = [f"({n} / CAST({SCALE} AS DOUBLE) - m{i})" for i, n in enumerate(NAMES)]
    z = ["(" + " + ".join(f"k{i}_{j} * {x[j]}" for j in range(i + 1)) + ")" for i in range(P)]
    return " + ".join(f"{t} * {t}" for t in z)


BIN_SQL = f"CAST(floor(ln(d2 + 1e-12) * {BINS}) AS INT)"
NEED_SQL = f"CAST(ceil({COVERED} * n) AS BIGINT)"


def _layered(df: DataFrame, layers) -> DataFrame:
    for layer in layers:
        df = df.selectExpr("*", *(f"{sql} AS {name}" for name, sql in layer))
    return df


def _model(moments: DataFrame, keys: list[str], factor: float) -> DataFrame:
    return _layered(moments, [*scatter_layers(factor), *factor_layers()]).select(*keys, *MODEL)


def _closest(moments: DataFrame, models: DataFrame) -> DataFrame:
    """Moments of each model's covered share, from moments per distance bin."""
    running = "sum(c) OVER (PARTITION BY g, start ORDER BY bin ROWS UNBOUNDED PRECEDING) - c AS before_bin"
    within = moments.selectExpr("*", running).join(models, "g").where(f"before_bin < {NEED_SQL}")
    return within.groupBy("g", "start").agg(*(F.sum(m).alias(m) for m in MOMENTS))


def fit_outlier_models(stats: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang_key, source_key and the model that judges them; one row per language and
    source that has a model. ``stats`` is what ``text_stats`` made, kept narrow."""
    passed = stats.where("not base_failed").select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("\0")).alias("lang_key"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("\0")).alias("source_key"),
        *(F.expr(feature_sql(n)).alias(n) for n in NAMES))
    counts = written(passed.groupBy("lang_key", "source_key").agg(F.count("*").alias("n")), "mcd-counts")
    # the finest model with rows enough, per language and source
    by_lang = counts.groupBy("lang_key").agg(F.sum("n").alias("n_lang"))
    total = counts.agg(F.sum("n").alias("n_all"))
    fine = F.to_json(F.array("lang_key", "source_key"))
    coarse = F.to_json(F.array("lang_key"))
    uses = written(counts.join(by_lang, "lang_key").join(F.broadcast(total)).select(
        "lang_key", "source_key",
        F.when(F.col("n") >= MIN_ROWS, fine).when(F.col("n_lang") >= MIN_ROWS, coarse)
         .when(F.col("n_all") >= MIN_ROWS, "[]").alias("g"),
        F.when(F.col("n") >= MIN_ROWS, F.col("n")).when(F.col("n_lang") >= MIN_ROWS, F.col("n_lang"))
         .otherwise(F.col("n_all")).alias("n")).where("g is not null"), "mcd-uses")
    sizes = uses.select("g", "n").distinct()
    # a coarse model is fitted on all rows of its language, or on all rows
    vectors = passed.select(F.explode(F.array(fine, coarse, F.lit("[]"))).alias("g"), *NAMES).join(sizes.select("g"), "g")

    quart = ", ".join(f"'{n}', CAST(floor({n} / CAST({SCALE // 100} AS DOUBLE)) AS BIGINT)" for n in NAMES)
    hist = vectors.selectExpr("g", f"stack({P}, {quart}) AS (feature, bin)").groupBy("g", "feature", "bin").agg(
        F.count("*").alias("c"))
    cumulated = hist.selectExpr("*", "sum(c) OVER (PARTITION BY g, feature ORDER BY bin ROWS UNBOUNDED PRECEDING) AS upto",
                                "sum(c) OVER (PARTITION BY g, feature) AS n")
    at = lambda q: f"min(CASE WHEN upto >= {q} * n THEN bin END) / 100.0D"
    quartiles = cumulated.groupBy("g", "feature").agg(
        F.expr(at(0.5)).alias("mid"), ((F.expr(at(0.75)) - F.expr(at(0.25))) / 1.349).alias("sd"))
    first = quartiles.groupBy("g").agg(*(
        F.max(F.when(F.col("feature") == n, F.col(c))).alias(f"{c}{i}") for i, n in enumerate(NAMES) for c in ("mid", "sd")))
    zero = F.lit(0.0)
    robust = _layered(first.select("g", F.lit(1).alias("start"), *(F.col(f"mid{i}").alias(f"m{i}") for i in range(P)), *(
        (F.col(f"sd{i}") * F.col(f"sd{i}") + F.lit(FEATURES[NAMES[i]][1] ** 2) if i == j else zero).alias(f"v{i}_{j}")
        for i, j in PAIRS)), factor_layers()).select("g", "start", *MODEL)
    moments = [F.expr(sql).alias(name) for name, sql in moment_sql("DECIMAL(20,0)")]
    plain = _model(vectors.groupBy("g", F.lit(2).alias("start")).agg(*moments), ["g", "start"], 1.0)
    models = written(robust.unionByName(plain), "mcd-start")

    for step in range(C_STEPS):
        binned = vectors.join(models, "g").selectExpr("g", "start", *NAMES, f"{distance_sql()} AS d2").selectExpr(
            "*", f"{BIN_SQL} AS bin").groupBy("g", "start", "bin").agg(*moments)
        models = written(_model(_closest(binned, sizes), ["g", "start"], consistency(COVERED)), f"mcd-step{step}")

    best = models.groupBy("g").agg(F.min_by(F.struct(*MODEL), F.struct("logdet", "start")).alias("m")).select("g", "m.*")
    inside = vectors.join(best, "g").selectExpr("g", *NAMES, f"{distance_sql()} AS d2").where(
        F.col("d2") <= chi2_quantile(REWEIGHT, P)).groupBy("g").agg(*moments)
    final = _model(inside, ["g"], consistency(REWEIGHT))
    return written(uses.select("lang_key", "source_key", "g").join(final, "g").drop("g"), "mcd-models")


def judge(stats: DataFrame, models: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``stats`` with ``kept``. The models are one small row per language and source;
    Spark broadcasts them only if their file is below its threshold."""
    # distinct names, so that the input's own columns cannot clash
    m = models.select(*(F.col(c).alias(f"_model_{c}") for c in models.columns))
    df = stats.withColumns({f"_model_{n}": F.when(F.col("n_words") > 0, F.expr(feature_sql(n))) for n in NAMES})
    df = df.join(m, (F.coalesce(F.col(lang_col).cast("string"), F.lit("\0")) == F.col("_model_lang_key"))
                 & (F.coalesce(F.col(source_col).cast("string"), F.lit("\0")) == F.col("_model_source_key")), "left")
    sql = distance_sql()
    for c in sorted([*NAMES, *MODEL], key=len, reverse=True):
        sql = _renamed(sql, c)
    far = F.coalesce(F.expr(sql) > CUTOFF, F.lit(False))
    return df.withColumn("kept", ~F.col("base_failed") & ~far).drop(*m.columns, *(f"_model_{n}" for n in NAMES))


def _renamed(sql: str, name: str) -> str:
    return re.sub(rf"(?<![A-Za-z0-9_]){name}(?![A-Za-z0-9_])", f"_model_{name}", sql)


def quality_filter(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without the rejected ones, columns unchanged. Texts are not shuffled:
    counts are made anew beside each text and judged by the small model table."""
    columns = docs.columns
    stats = written(text_stats(docs, text_col, ("lang", "source")), "quality-stats")
    models = fit_outlier_models(stats)
    packed = docs.select(F.struct(*(F.col(c) for c in columns)).alias("_row"), F.col(text_col).alias("_in"),
                         F.col("lang").alias("_lang"), F.col("source").alias("_source"))
    counted = text_stats(packed, "_in", ("_row", "_lang", "_source"))
    return judge(counted, models, "_lang", "_source").where("kept").select("_row.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = written(text_stats(table(spark, sf_dir, "documents"), "text", ("doc_id", "lang", "source")), "op4-stats")
    return judge(stats, fit_outlier_models(stats)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# ---------------------------------------------------------------- oracle

def _layers_sql(source: str, layers) -> str:
    for layer in layers:
        source = f"(SELECT *, {', '.join(f'{sql} AS {name}' for name, sql in layer)} FROM {source})"
    return source


def oracle() -> str:
    """The query in DuckDB SQL: counts by its own functions, models by the same arithmetic
    on exact integer sums."""
    moments = ", ".join(f"{sql} AS {name}" for name, sql in moment_sql("HUGEINT"))
    summed = ", ".join(f"sum({m}) AS {m}" for m in MOMENTS)
    model = lambda source, factor, keys: (
        f"SELECT {keys}, {', '.join(MODEL)} FROM " + _layers_sql(source, [*scatter_layers(factor), *factor_layers()]))
    at = lambda q: f"min(CASE WHEN upto >= {q} * n THEN bin END) / CAST(100 AS DOUBLE)"
    first = ", ".join(f"max(CASE WHEN feature = '{n}' THEN mid END) AS m{i}, max(CASE WHEN feature = '{n}' THEN sd END) AS sd{i}"
                      for i, n in enumerate(NAMES))
    diagonal = [[(f"v{i}_{j}", f"sd{i} * sd{i} + {FEATURES[NAMES[i]][1] ** 2!r}" if i == j else "CAST(0 AS DOUBLE)") for i, j in PAIRS]]
    parts = [
        """docs AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS words,
  [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM docs),
windows AS (SELECT doc_id, i, list_slice(words, i, i + 2) AS win FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS k FROM windows) WHERE k > 1),
under AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
counted AS (SELECT w.doc_id, coalesce('' || lang, chr(0)) AS lang_key, coalesce('' || source, chr(0)) AS source_key, CAST(len(words) AS BIGINT) AS n_words,
  CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(under.n, 0) AS n_repeat_words
  FROM w LEFT JOIN under ON under.doc_id = w.doc_id)""".replace("\\\\", "\\"),
        f"stats AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counted)",
        f"featured AS (SELECT *, {', '.join(f'CASE WHEN n_words > 0 THEN {feature_sql(n)} END AS {n}' for n in NAMES)} FROM stats)",
        "passed AS (SELECT * FROM featured WHERE NOT base_failed)",
        "cnt AS (SELECT lang_key, source_key, count(*) AS n FROM passed GROUP BY 1, 2)",
        f"""uses AS (SELECT lang_key, source_key,
  CASE WHEN n >= {MIN_ROWS} THEN lang_key || chr(1) || source_key WHEN n_lang >= {MIN_ROWS} THEN lang_key WHEN n_all >= {MIN_ROWS} THEN '' END AS g,
  CASE WHEN n >= {MIN_ROWS} THEN n WHEN n_lang >= {MIN_ROWS} THEN n_lang ELSE n_all END AS n
  FROM (SELECT *, sum(n) OVER (PARTITION BY lang_key) AS n_lang, sum(n) OVER () AS n_all FROM cnt))""",
        "sizes AS (SELECT DISTINCT g, n FROM uses WHERE g IS NOT NULL)",
        f"""vectors AS (SELECT v.g, {', '.join(NAMES)} FROM (SELECT unnest([lang_key || chr(1) || source_key, lang_key, '']) AS g, {', '.join(NAMES)} FROM passed) v
  JOIN sizes ON sizes.g = v.g)""",
        "hist AS (SELECT g, feature, bin, count(*) AS c FROM (" + " UNION ALL ".join(
            f"SELECT g, '{n}' AS feature, CAST(floor({n} / CAST({SCALE // 100} AS DOUBLE)) AS BIGINT) AS bin FROM vectors" for n in NAMES) + ") GROUP BY 1, 2, 3)",
        """cumulated AS (SELECT *, sum(c) OVER (PARTITION BY g, feature ORDER BY bin ROWS UNBOUNDED PRECEDING) AS upto,
  sum(c) OVER (PARTITION BY g, feature) AS n FROM hist)""",
        f"quartiles AS (SELECT g, feature, {at(0.5)} AS mid, ({at(0.75)} - {at(0.25)}) / CAST(1.349 AS DOUBLE) AS sd FROM cumulated GROUP BY 1, 2)",
        f"spread AS (SELECT g, {first} FROM quartiles GROUP BY g)",
        f"model0 AS (SELECT g, 1 AS start, {', '.join(MODEL)} FROM " + _layers_sql("spread", [*diagonal, *factor_layers()])
        + " UNION ALL " + model(f"(SELECT g, 2 AS start, {moments} FROM vectors GROUP BY g)", 1.0, "g, start") + ")",
    ]
    for k in range(C_STEPS):
        parts += [
            f"binned{k} AS (SELECT g, start, bin, {moments} FROM (SELECT *, {BIN_SQL} AS bin FROM (SELECT v.g, start, {', '.join(NAMES)}, "
            f"{distance_sql()} AS d2 FROM vectors v JOIN model{k} m ON m.g = v.g)) GROUP BY 1, 2, 3)",
            f"ranked{k} AS (SELECT *, sum(c) OVER (PARTITION BY g, start ORDER BY bin ROWS UNBOUNDED PRECEDING) - c AS before_bin FROM binned{k})",
            f"closest{k} AS (SELECT r.g, start, {summed} FROM ranked{k} r JOIN sizes ON sizes.g = r.g WHERE before_bin < {NEED_SQL} GROUP BY 1, 2)",
            f"model{k + 1} AS ({model(f'closest{k}', consistency(COVERED), 'g, start')})",
        ]
    parts += [
        f"best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY logdet, start) AS k FROM model{C_STEPS}) WHERE k = 1)",
        f"inside AS (SELECT g, {moments} FROM (SELECT v.g, {', '.join(NAMES)}, {distance_sql()} AS d2 FROM vectors v JOIN best m ON m.g = v.g) "
        f"WHERE d2 <= {chi2_quantile(REWEIGHT, P)!r} GROUP BY g)",
        f"final AS ({model('inside', consistency(REWEIGHT), 'g')})",
    ]
    return "WITH " + ",\n".join(p.replace(" AS (", " AS MATERIALIZED (", 1) for p in parts) + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce({distance_sql()} > {CUTOFF!r}, false) AS kept
FROM featured f LEFT JOIN uses u ON u.lang_key = f.lang_key AND u.source_key = f.source_key LEFT JOIN final m ON m.g = u.g
"""
