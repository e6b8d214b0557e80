"""Operator 5: sources mixed to target weights by Pfair scheduling.

Documents of a source are numbered in a seeded order and cut into blocks. A source
with ``w`` of every ``PERIOD`` slots gives its j-th block (from 0) the release time
floor(j * PERIOD / w) and the deadline ceil((j + 1) * PERIOD / w); among the blocks
released, the earliest deadline takes the slot. With weights that add up to the
period every block runs inside its window, so at any slot a source has had less
than one block more or less than its share. The pattern repeats after ``PERIOD``
slots, so it is made once, for one period, with an SQL aggregate over slots.

Slots follow the weights by largest remainder, within one slot of a period. Where a
period has too few slots for that (more than ``FLAT`` sources, or several below one
slot), small sources (share under 1 / ``FLAT``) of like weight are scheduled as one
group, whose slots are dealt out among its members in the same way, in a period of
their own; groups may be grouped again, so any number of sources is scheduled. A
member's window is then made of those of its levels, and it has had less than one
block for each level more or less than its share. Of a group of ``GROUP`` members
or so, none has under ``PERIOD`` / (2 * ``GROUP``) slots while weights within it
differ by a factor of two at most; the group itself is within one slot of its period.

All documents are used: the mixture runs until every source has been gone through
at least once, and a source that ends before starts over (``epoch``), as target
weights above its natural share ask for. ``repeat=False`` gives every document
once: a source's slots stay empty after its last block.

``target_weights`` makes weights from counts: share ** ``ALPHA``. Numbering is
distributed: each source is dealt into buckets by hash, buckets are numbered apart
and start where the buckets before them end, so no source is sorted in one task.

Null sources are a source of their own. Sources without a weight, or with one that
is not positive, get the smallest weight, one slot. Weights of absent sources are
left out. More sources than slots in a period are an error. Rows are numbered, so
repeated rows and ids each get a place; equal rows are interchangeable. An empty
table gives an empty result. ``mixed_documents`` returns the input's columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relaysql.llm.common import table, written

PERIOD = 1000
FLAT = 100                # as many sources or groups stand side by side
GROUP = 32                # members that a group is made for
BLOCK_DOCS = 16
ALPHA = 0.8
BUCKET_DOCS = 2_000
SEED = 17


def source_key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("s"), F.col(column).cast("string")), F.lit("null"))


def target_weights(counts: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """source_key, weight from source_key, n."""
    return counts.select("source_key", F.pow(F.col("n"), F.lit(alpha)).alias("weight"))


def slot_counts(counts: DataFrame, weights: DataFrame, period: int = PERIOD) -> DataFrame:
    """source_key, n, w: whole slots per period that add up to ``period``, by largest
    remainder, one slot at least. One row per source."""
    df = counts.join(weights, "source_key", "left").select("source_key", "n", positive("weight").alias("weight"))
    return dealt(df.withColumn("g", F.lit("")), period).select("source_key", "n", "w")


def positive(weight: str) -> Column:
    return F.greatest(F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.lit(0.0))


def dealt(df: DataFrame, period: int) -> DataFrame:
    """``df`` (g, source_key, weight and more) with ``w``, which adds up to ``period`` in each ``g``."""
    group = Window.partitionBy("g")
    df = df.withColumn("k", F.count("*").over(group)).withColumn(
        "k", F.when(F.col("k") > period, F.raise_error(F.lit("more sources than slots in a period")).cast("bigint")).otherwise(F.col("k")))
    df = df.withColumn("total", F.sum("weight").over(group)).withColumn(
        "above", F.when(F.col("total") > 0, F.greatest(F.col("weight") / F.col("total") * period - 1, F.lit(0.0))).otherwise(0.0))
    # one slot each; what shares ask for beyond that, scaled down by what went to shares below one slot
    df = df.withColumn("sum_above", F.sum("above").over(group)).withColumn(
        "quota", F.when(F.col("sum_above") > 0, F.col("above") / F.col("sum_above") * (period - F.col("k"))).otherwise(0.0))
    df = df.withColumn("whole", F.floor("quota")).withColumn(
        "nth", F.row_number().over(group.orderBy((F.col("whole") - F.col("quota")), "source_key")))
    spare = period - F.col("k") - F.sum("whole").over(group)
    # at most one more each by remainder; what is left when no weight is given goes round
    extra = F.floor(spare / F.col("k")) + F.when(F.col("nth") <= F.pmod(spare, F.col("k")), 1).otherwise(0)
    return df.withColumn("w", (1 + F.col("whole") + extra).cast("bigint")).drop(
        "k", "total", "above", "sum_above", "quota", "whole", "nth")


def levels(counts: DataFrame, weights: DataFrame, period: int = PERIOD) -> list[tuple[DataFrame, int]]:
    """(g, source_key, w) and the period of each level, the root's last: the entry
    ``source_key`` has ``w`` slots in a period of the group ``g``, and ``g`` is an entry
    of a later level. What a level does not name goes on to the next as it is."""
    flat = max(1, min(FLAT, period // 2))
    entries = written(counts.join(weights, "source_key", "left").select("source_key", positive("weight").alias("weight")), "mix-entries")
    out, width = [], 1
    while True:
        total = entries.agg(F.sum("weight")).first()[0] or 0.0
        share = F.col("weight") / total if total > 0 else F.lit(1.0) / max(1, entries.count())
        entries = entries.withColumn("share", share)
        small = F.col("share") < 1 / flat
        k, smalls, tiny = entries.agg(F.count("*"), F.count_if(small), F.count_if(F.col("share") * period < 1)).first()
        if smalls < 2 or (k <= flat and tiny < 2):
            break
        # like weights together; wider classes each time, so that in the end all meet
        like = entries.where(small).withColumn("class", F.floor(F.least(-F.log2(F.greatest("share", F.lit(2.0 ** -60))), F.lit(60.0)) / width))
        like = like.join(like.groupBy("class").agg(F.ceil(F.count("*") / GROUP).alias("parts")), "class")
        like = like.withColumn("g", F.concat_ws("/", F.lit(f"g{len(out)}"), "class", F.pmod(F.xxhash64("source_key"), "parts")))
        out.append((written(dealt(like.select("g", "source_key", "weight"), PERIOD).select("g", "source_key", "w"), "mix-group"), PERIOD))
        grouped = like.groupBy(F.col("g").alias("source_key")).agg(F.sum("weight").alias("weight"))
        entries = written(entries.where(~small).select("source_key", "weight").unionByName(grouped), "mix-entries")
        width *= 2
    root = dealt(entries.select(F.lit("").alias("g"), "source_key", "weight"), period)
    return [*out, (written(root.select("g", "source_key", "w"), "mix-sources"), period)]


def period_slots(sources: DataFrame, period: int = PERIOD) -> DataFrame:
    """g, source_key, j, w, slot for each block of one period of each group."""
    one = sources.groupBy("g").agg(F.array_sort(F.collect_list(F.struct("source_key", "w"))).alias("s"))      # at most ``period`` entries
    simulated = one.select("g", "s", F.expr(f"""
      aggregate(sequence(0, {period - 1}),
        named_struct('given', transform(s, x -> 0L), 'plan', CAST(array() AS array<struct<i:int,j:bigint>>)),
        (acc, slot) -> transform(array(array_min(filter(
            transform(s, (x, i) -> named_struct(
              'deadline', ((acc.given[i] + 1) * {period} + x.w - 1) div x.w,
              'w', x.w, 'i', i, 'release', (acc.given[i] * {period}) div x.w)),
            c -> c.release <= slot))),
          c -> named_struct('given', transform(acc.given, (g, i) -> IF(i = c.i, g + 1L, g)),
                            'plan', concat(acc.plan, array(named_struct('i', c.i, 'j', acc.given[c.i])))))[0],
        acc -> acc.plan)""").alias("plan"))
    p = simulated.select("g", "s", F.posexplode("plan").alias("slot", "p"))
    return p.select("g", F.expr("s[p.i].source_key").alias("source_key"), F.expr("p.j").alias("j"),
                    F.expr("s[p.i].w").alias("w"), F.col("slot").cast("bigint").alias("slot"))


def paths(sources: DataFrame, tree: list[tuple[DataFrame, int]]) -> DataFrame:
    """``sources`` with e0, w0, e1, w1, ...: the entry that stands for a source at each
    level and its slots there, no slots where it goes on as it is."""
    df = sources.withColumn("e0", F.col("source_key"))
    for i, (level, _) in enumerate(tree):
        df = df.join(level.select(F.col("source_key").alias(f"e{i}"), F.col("w").alias(f"w{i}"), F.col("g").alias(f"g{i}")), f"e{i}", "left")
        df = df.withColumn(f"e{i + 1}", F.coalesce(f"g{i}", f"e{i}")).drop(f"g{i}")
    return df


def in_slots(blocks: DataFrame, tree: list[tuple[DataFrame, int]], slots: list[DataFrame]) -> DataFrame:
    """``blocks`` (``b`` and the columns of ``paths``) with release, deadline and slot."""
    df = blocks.withColumns({"slot": F.col("b"), "release": F.col("b"), "deadline": F.col("b") + 1})
    last = len(tree) - 1
    for i, (_, period) in enumerate(tree):
        w = f"w{i}"
        # where the level does not name a source, its blocks find nothing and stay as they are
        df = df.withColumn("j", F.expr(f"slot % {w}") if i == last else F.expr(f"IF({w} IS NULL, slot, slot % {w})"))
        at = slots[i].select(F.col("source_key").alias(f"e{i}"), "j", F.col("slot").alias("_at"))
        df = df.join(at, [f"e{i}", "j"], "inner" if i == last else "left")
        df = df.withColumns({
            "slot": F.expr(f"IF({w} IS NULL, slot, (slot div {w}) * {period} + _at)"),
            "release": F.expr(f"IF({w} IS NULL, release, (release * {period}) div {w})"),
            "deadline": F.expr(f"IF({w} IS NULL, deadline, (deadline * {period} + {w} - 1) div {w})")}).drop("_at", "j")
    return df


def given_blocks(tree: list[tuple[DataFrame, int]], slots: list[DataFrame], horizon: DataFrame) -> DataFrame:
    """source_key, given: how many blocks every entry has had up to the slot ``horizon``."""
    every = None
    upto = horizon.select(F.lit("").alias("g"), "horizon")
    for (_, period), at in reversed(list(zip(tree, slots))):
        # the slots of a level's groups up to where the levels above have come
        had = at.join(upto, "g").groupBy("source_key").agg(F.sum(F.expr(
            f"CASE WHEN slot <= horizon THEN (horizon - slot) div {period} + 1 ELSE 0 END")).alias("given"))
        every = had if every is None else every.unionByName(had)
        every = written(every, "mix-had") if len(tree) > 1 else every
        upto = every.select(F.col("source_key").alias("g"), (F.col("given") - 1).alias("horizon"))
    return every


def numbered(docs: DataFrame, key: Column, order: Column) -> DataFrame:
    """``docs`` with ``place``, from 0 within each ``source_key``, in a seeded order."""
    df = docs.withColumn("source_key", key).withColumn("_h", order)
    sizes = written(df.groupBy("source_key").agg(F.count("*").alias("n")), "mix-sizes")
    # buckets are ranges of the hash, as many as the source's size asks for
    parts = sizes.select("source_key", "n", F.ceil(F.col("n") / BUCKET_DOCS).alias("parts"))
    unsigned = F.shiftrightunsigned("_h", 33)                       # 31 bits
    df = df.join(parts.select("source_key", "parts"), "source_key").withColumn(
        "_bucket", F.shiftright(unsigned * F.col("parts"), 31))
    ahead = df.groupBy("source_key", "_bucket").agg(F.count("*").alias("m"))
    ahead = ahead.select("source_key", "_bucket", (F.sum("m").over(
        Window.partitionBy("source_key").orderBy("_bucket")) - F.col("m")).alias("_ahead"))
    rank = F.row_number().over(Window.partitionBy("source_key", "_bucket").orderBy(unsigned, "_h", "doc_id"))
    df = df.withColumn("_rank", rank).join(ahead, ["source_key", "_bucket"])
    return df.withColumn("place", F.col("_ahead") + F.col("_rank") - 1).drop("_bucket", "_ahead", "_rank", "_h", "parts")


def schedule(docs: DataFrame, weights: DataFrame | None = None, source_col: str = "source", id_col: str = "doc_id",
             block_docs: int = BLOCK_DOCS, period: int = PERIOD, repeat: bool = True, seed: int = SEED) -> DataFrame:
    """doc_id, source_key, epoch, block, release, deadline, slot, place: one row for
    each time that a document is used; ``place`` counts the source's documents.

    ``weights``: source_key (see ``source_key``), weight."""
    ids = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).alias("source"))
    df = written(numbered(ids, source_key("source"), F.xxhash64("doc_id", F.lit(seed))), "mix-numbered")
    counts = written(df.groupBy("source_key").agg(F.count("*").alias("n")), "mix-counts")
    tree = levels(counts, weights if weights is not None else target_weights(counts), period)
    slots = [written(period_slots(level, p), "mix-period") for level, p in tree]
    blocks = written(paths(counts.withColumn("n_blocks", F.ceil(F.col("n") / block_docs)), tree), "mix-blocks")
    # slots until every source has been gone through once
    last = in_slots(blocks.withColumn("b", F.col("n_blocks") - 1), tree, slots)
    horizon = written(last.agg(F.max("slot").alias("horizon")), "mix-horizon")
    # how often a source starts over: its blocks up to the horizon
    given = blocks.join(F.broadcast(horizon)).join(given_blocks(tree, slots, horizon), "source_key")
    path = [c for i in range(len(tree)) for c in (f"e{i}", f"w{i}")]
    given = written(given.select("source_key", *path, "n_blocks", "horizon", F.ceil(F.col("given") / F.col("n_blocks")).alias("epochs")), "mix-given")
    epochs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("epochs") - 1)) if repeat else F.lit(0).cast("bigint")
    used = df.select("doc_id", "source_key", "place").join(given, "source_key").select(
        "*", epochs.alias("epoch")).withColumn("b", F.expr(f"epoch * n_blocks + place div {block_docs}"))
    return in_slots(used, tree, slots).select(
        "doc_id", "source_key", "epoch", F.col("b").alias("block"), "release", "deadline", "slot", "place", "horizon"
    ).where("slot <= horizon").drop("horizon")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in the order of the schedule, each row as often as it is used."""
    id_col = options.get("id_col", "doc_id")
    columns = docs.columns
    plan = schedule(docs, **options).select(F.col("doc_id").alias("_id"), "source_key", "epoch", "slot", "place")
    rows = docs.select(F.struct(*(F.col(c) for c in columns)).alias("_row"), F.col(id_col).cast("bigint").alias("_id2"),
                       source_key(options.get("source_col", "source")).alias("_source"))
    on = F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("source_key") == F.col("_source"))
    if not rows.groupBy("_id2").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        # rows with one id: the plan has a line for each, dealt out by their number
        plan = plan.withColumn("_nth", F.row_number().over(Window.partitionBy("_id", "source_key", "epoch").orderBy("place")))
        rows = rows.withColumn("_nth2", F.row_number().over(Window.partitionBy("_id2", "_source").orderBy(F.lit(1))))
        on = on & (F.col("_nth") == F.col("_nth2"))
    joined = rows.join(plan, on)
    return joined.orderBy("slot", "place").select("_row.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedule(table(spark, sf_dir, "documents"))
