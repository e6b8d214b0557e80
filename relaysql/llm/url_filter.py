"""Operator 8: URL rules in a sorted digest array.

The rules' strings (host and path, like ``example.com/en/``) and the blocked
hosts are hashed with 64-bit xxhash and kept as one sorted array of keys beside
the full strings. Each Python worker maps that file into memory once and probes
it with a vectorised binary search; a key that is found is confirmed against the
stored string, so two strings with one key are told apart.

What is looked up per page: every suffix of its host at a dot, followed by each
path prefix whose length occurs among the rules. Longest rule wins, then the
longer host, then block. Where no rule fits, the page is blocked when its host or
a parent domain is a blocked host, else allowed.

The array is shipped in blocks of at most ``BLOCK_BYTES`` of strings (measured
before anything is collected). One pass over the pages probes up to ``STEP_BYTES`` of
blocks with one Python worker per task: a page's strings are made and hashed once and
looked up in each block. Only a list beyond that takes further passes, each over the stored
findings of the one before, so a worker's memory is bounded whatever the list's size.

Null urls and urls without ``://`` have an empty host and path, so nothing fits
and they are allowed. Repeated rows are judged each; an empty table gives an
empty result; other columns are not read. Rules with a null or empty string are
ignored; of a rule listed as allow and block, block wins.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relaysql.llm.common import bounded_blocks, release, table, written
from relaysql.session import ship_package

BLOCK_BYTES = 32 << 20
STEP_BYTES = 256 << 20      # of images, all held by a worker during one pass

# The production rules.
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]
BLOCKED_HOSTS = ["ads-track.example.com", "spam-farm.example.org", "casino-win.example.net",
                 "adult-x.example.com", "cheap-pills.example.net", "free-bets.example.net"]

ALLOW, BLOCK, HOST = 0, 1, 2     # kinds of entries
HOST_MARK = "host:"              # cannot begin a rule: a rule's host part has no colon before its path


class DigestArray:
    """A sorted array of 64-bit keys, the entries' kinds and their strings."""

    def __init__(self, entries: list[tuple[str, int]]):
        raw = [(xxhash.xxh64_intdigest(s.encode()), s.encode(), kind) for s, kind in entries]
        raw.sort()
        self.n = len(raw)
        lengths = np.array([len(s) for _, s, _ in raw], dtype=np.int64)
        self.image = b"".join([
            np.array([k for k, _, _ in raw], dtype=np.uint64).tobytes(),
            np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64).tobytes(),
            np.array([kind for _, _, kind in raw], dtype=np.uint8).tobytes(),
            b"".join(s for _, s, _ in raw)])


class MappedArray:
    """The array mapped from an unlinked file, so its pages are the system's to drop."""

    def __init__(self, image: bytes, n: int):
        with tempfile.TemporaryFile() as f:
            f.write(image or b"\0")
            f.flush()
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        self.n = n
        self.keys = np.frombuffer(self.map, np.uint64, n)
        self.offsets = np.frombuffer(self.map, np.int64, n + 1, 8 * n)
        self.kinds = np.frombuffer(self.map, np.uint8, n, 16 * n + 8)
        self.strings = 17 * n + 8

    def find(self, strings: list[bytes], keys: np.ndarray) -> np.ndarray:
        """For each string its kind, or -1."""
        out = np.full(len(strings), -1, np.int64)
        at = np.searchsorted(self.keys, keys)
        open_ = np.flatnonzero((at < self.n) & (self.keys[np.minimum(at, max(self.n - 1, 0))] == keys)) if self.n else []
        for i in open_:
            j = int(at[i])
            while j < self.n and self.keys[j] == keys[i]:      # entries with one key stand side by side
                a, b = self.offsets[j], self.offsets[j + 1]
                if self.map[self.strings + a:self.strings + b] == strings[i]:
                    out[i] = max(out[i], int(self.kinds[j]))
                j += 1
        return out


def judge_urls(pages: DataFrame, rules: DataFrame, blocked_hosts: DataFrame, id_col: str = "page_id",
               url_col: str = "url", block_bytes: int = BLOCK_BYTES, step_bytes: int = STEP_BYTES) -> DataFrame:
    """``rules``: rule, verdict; ``blocked_hosts``: host. Returns page_id, host, path,
    rule, verdict."""
    spark = pages.sparkSession
    ship_package(spark)
    az = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    host_part = F.substring_index("rule", "/", 1)
    rule_entries = rules.where("rule is not null and instr(rule, '/') > 1").select(
        F.concat(F.translate(host_part, *az), F.col("rule").substr(F.length(host_part) + 1, F.length("rule"))).alias("entry"),
        F.when(F.col("verdict") == "block", BLOCK).otherwise(ALLOW).alias("kind"))
    entries = rule_entries.unionByName(blocked_hosts.where("host is not null and host <> ''").select(
        F.concat(F.lit(HOST_MARK), F.translate("host", *az)).alias("entry"), F.lit(HOST).alias("kind"))
    ).groupBy("entry").agg(F.max("kind").alias("kind"))
    cuts = sorted(r[0] for r in rule_entries.select(
        F.length("entry") - F.length(F.substring_index("entry", "/", 1))).distinct().toLocalIterator())

    url = F.col(url_col).cast("string")
    has = F.instr(url, "://") > 0
    rest = F.when(has, url.substr(F.instr(url, "://") + 3, F.length(url))).otherwise("")
    df = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(rest, F.lit("")).alias("rest")).select(
        "page_id", F.regexp_extract("rest", r"^[^/?#]*", 0).alias("raw_host"), "rest").select(
        "page_id", F.translate("raw_host", *az).alias("host"),
        F.regexp_extract(F.expr("substr(rest, length(raw_host) + 1)"), r"^[^?#]*", 0).alias("path"),
        F.lit(None).cast("string").alias("rule"), F.lit(-1).alias("kind"))
    found = "page_id bigint, host string, path string, rule string, kind int"
    step, size, before = [], 0, None
    for block in bounded_blocks(entries, "octet_length(entry) + 32", "entry", block_bytes):
        array = DigestArray([(r["entry"], r["kind"]) for r in block])
        if step and size + len(array.image) > step_bytes:
            stored = written(df.mapInArrow(_prober(step, cuts), found), "url-step")
            if before is not None:
                release(before)
            df = before = stored
            step, size = [], 0
        step.append(spark.sparkContext.broadcast((array.image, array.n)))
        size += len(array.image)
    df = df.mapInArrow(_prober(step, cuts), found)
    return df.select("page_id", "host", "path", "rule",
                     F.when(F.col("kind").isin(BLOCK, HOST), "block").otherwise("allow").alias("verdict"))


def _prober(blocks: list, cuts: list[int]):
    def better(new, old):
        """Rules before host entries; longer first, then the longer host, then block."""
        rank = lambda e: (e[0] != HOST, len(e[1]), len(e[1].split("/", 1)[0]), e[0])
        return old is None or rank(new) > rank(old)

    def probe(batches):
        arrays = [MappedArray(*block.value) for block in blocks]
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            rules, kinds = batch.column("rule").to_pylist(), batch.column("kind").to_pylist()
            asked, owner = [], []
            for i, (host, path) in enumerate(zip(hosts, paths)):
                labels = host.split(".")
                for k in range(len(labels)):
                    suffix = ".".join(labels[k:])
                    if not suffix:
                        continue
                    asked.append(HOST_MARK + suffix)
                    owner.append(i)
                    for cut in cuts:
                        if cut <= len(path):
                            asked.append(suffix + path[:cut])
                            owner.append(i)
            raw = [a.encode() for a in asked]
            keys = np.fromiter((xxhash.xxh64_intdigest(r) for r in raw), np.uint64, len(raw))
            kind = np.full(len(raw), -1, np.int64)
            for array in arrays:                   # an entry is in one block only
                kind = np.maximum(kind, array.find(raw, keys))
            best = [None if k < 0 else (k, r or "") for k, r in zip(kinds, rules)]
            for j in np.flatnonzero(kind >= 0):
                new = (int(kind[j]), "" if kind[j] == HOST else asked[j])
                if better(new, best[owner[j]]):
                    best[owner[j]] = new
            yield pa.RecordBatch.from_arrays([
                batch.column("page_id"), batch.column("host"), batch.column("path"),
                pa.array([None if b is None or b[0] == HOST else b[1] for b in best], pa.string()),
                pa.array([-1 if b is None else b[0] for b in best], pa.int32())],
                names=["page_id", "host", "path", "rule", "kind"])
    return probe


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), spark.createDataFrame(RULES, "rule string, verdict string"),
                      spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "host string"))


ORACLE = f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r(rule, verdict) AS (VALUES {', '.join(f"('{r}', '{v}')" for r, v in RULES)}),
b(bad) AS (VALUES {', '.join(f"('{x}')" for x in BLOCKED_HOSTS)}),
fits AS (
  SELECT page_id, host, path, rule, verdict, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule) DESC) AS k
  FROM h JOIN r ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/'))))
SELECT h.page_id, h.host, h.path, f.rule,
       coalesce(f.verdict, CASE WHEN EXISTS (SELECT 1 FROM b WHERE h.host = bad OR ends_with(h.host, '.' || bad))
                                THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN (SELECT * FROM fits WHERE k = 1) f
  ON h.page_id IS NOT DISTINCT FROM f.page_id AND h.host = f.host AND h.path = f.path
"""
