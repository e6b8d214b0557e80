"""Compare a Spark query result with its DuckDB oracle, order-insensitively.

Usable from tests and as ``python -m tests.oracle SF_DIR [NAME ...]``.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    # floats are compared exactly: results are built to be bit-identical across
    # engines (sums rounded to cents, averages over integers, no reordering)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if hasattr(v, "tolist"):
        return tuple(v.tolist())
    if isinstance(v, list):
        return tuple(v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
                 "string": "VARCHAR", "boolean": "BOOLEAN", "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(spark_df, rel) -> list[str]:
    d_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for f in spark_df.schema.fields:
        want = SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
        if d_types.get(f.name) != want:
            out.append(f"{f.name}: spark {f.dataType.simpleString()} vs duck {d_types.get(f.name)}")
    return out


def compare(spark_df, sql: str, con) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    types = type_mismatches(spark_df, rel)
    if types:
        return False, "types differ: " + "; ".join(types)
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if len(a) != len(b):
        return False, f"row count spark={len(a)} duck={len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return False, f"{len(diff)} rows differ, first: spark={diff[0][0]} duck={diff[0][1]}"
    return True, f"{len(a)} rows"


def main(argv):
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0]
    names = argv[1:] or sorted(entry.queries())
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = entry.queries()[name](spark, sf_dir)
            if name in oracles:
                ok, msg = compare(df, oracles[name], con)
            else:
                ok, msg = True, f"rows only: {df.count()} rows"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:300]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t0:6.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
