"""Decode against an independent Python model of the coercion rules.

Random messages mix well-typed JSON with values a lenient producer might send
(numbers as text, thousands separators, spaces, booleans for numbers, nulls,
missing keys, garbage, overflow); the typed parse, the text fallback and the
bad-record reason must agree with the model for every message.
"""

from __future__ import annotations

import json
from decimal import Decimal, InvalidOperation

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from relaysql.operators.decode import decode
from relaysql.operators.schema import parse_schema_spec

SPEC = {"s": "string", "i": "int", "l": "long", "d": "double", "b": "boolean"}
FIELDS = parse_schema_spec(json.dumps(SPEC))
RANGES = {"int": (-(2**31), 2**31 - 1), "long": (-(2**63), 2**63 - 1)}
MISSING = object()


def _text_of(v):
    """The text the all-text parse gives for a JSON scalar."""
    if isinstance(v, bool):
        return "true" if v else "false"
    return str(v) if not isinstance(v, str) else v


def _absent(t):
    return t is None or t.strip() in ("", "null", "NULL")


def model_integral(v, kind):
    """-> (value, ok)."""
    if v is MISSING or v is None:
        return 0, True
    if isinstance(v, bool):
        return int(v), True
    if isinstance(v, float):
        v = int(v)                   # a JSON number truncates like its text
    if isinstance(v, int):
        lo, hi = RANGES[kind]
        return (v, True) if lo <= v <= hi else (None, False)
    t = _text_of(v)
    if _absent(t):
        return 0, True
    if t.strip().lower() in ("true", "false"):
        return int(t.strip().lower() == "true"), True
    try:
        d = Decimal(t.replace(",", "").strip())
    except InvalidOperation:
        return None, False
    if not d.is_finite():
        return None, False
    n = int(d)                       # toward zero
    lo, hi = RANGES[kind]
    return (n, True) if lo <= n <= hi else (None, False)


def model_double(v):
    if v is MISSING or v is None:
        return 0.0, True
    if isinstance(v, bool):
        return float(v), True
    if isinstance(v, (int, float)):
        return float(v), True
    t = _text_of(v)
    if _absent(t):
        return 0.0, True
    if t.strip().lower() in ("true", "false"):
        return float(t.strip().lower() == "true"), True
    try:
        return float(t.replace(",", "").strip()), True
    except ValueError:
        return None, False


def model_boolean(v):
    if v is MISSING or v is None:
        return False, True
    t = _text_of(v).strip().lower()
    if _absent(t):
        return False, True
    if t in ("true", "1", "y", "t"):
        return True, True
    if t in ("false", "0", "n", "f"):
        return False, True
    return None, False


def model_string(v):
    if v is MISSING or v is None:
        return None, False
    return _text_of(v), True


def model(record: dict):
    """-> ("ok", row tuple) or ("bad", reason)."""
    out = []
    for name, kind in SPEC.items():
        v = record.get(name, MISSING)
        if kind == "string":
            value, ok = model_string(v)
            if not ok:
                return "bad", f"missing:{name}"
        else:
            if kind in RANGES:
                value, ok = model_integral(v, kind)
            elif kind == "double":
                value, ok = model_double(v)
            else:
                value, ok = model_boolean(v)
            if not ok:
                return "bad", f"coercion:{name}"
        out.append(value)
    return "ok", tuple(out)


ints = st.integers(min_value=-(2**40), max_value=2**40)
plain_floats = st.decimals(min_value=-10**6, max_value=10**6, places=3, allow_nan=False).map(
    lambda d: float(d))
texts_of_numbers = st.one_of(
    ints.map(str),
    ints.map(lambda n: f"{n:,}"),
    ints.map(lambda n: f"  {n} "),
    plain_floats.map(repr),
    plain_floats.map(lambda f: f"{f:,.2f}"),
)
odd_texts = st.sampled_from(["\t", " \n", "-0.9999999", "21.9999999", "0.00001e7", "12.5E-1", "1e-400", "2147483647.9999999", "", "null", "NULL", "true", "FALSE", "y", "N", "t", "abc", "1e3", "-0", "12x", " "])
value = st.one_of(st.none(), st.booleans(), ints, plain_floats, texts_of_numbers, odd_texts,
                  st.text(alphabet="abcxyz ", max_size=5))


class Number(str):
    """The digits of a JSON number, written into the message as they are."""


numbers = st.builds(lambda sign, whole, point, e: Number(f"{sign}{whole}.{point}e{e}"), st.sampled_from(["", "-"]),
                    st.integers(0, 10**24), st.integers(0, 10**20), st.integers(-30, 30))
integral = st.one_of(value, numbers)
# a key left out of the dictionary is a missing key
record = st.fixed_dictionaries({}, optional={name: integral if kind in RANGES else value for name, kind in SPEC.items()})


def message(r):
    return "{" + ", ".join(f"{json.dumps(k)}: {v if isinstance(v, Number) else json.dumps(v)}" for k, v in r.items()) + "}"


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])
@given(st.lists(record, min_size=30, max_size=30))
def test_decode_matches_model(spark, records):
    msgs = [message(r) for r in records]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "i_ long, value string")
    out = decode(df, FIELDS, "quarantine")
    got_rows = sorted((tuple(r) for r in out.rows.collect()), key=repr)
    got_bad = sorted((r.value, r.reason) for r in out.rejected.collect())
    want_rows, want_bad = [], []
    for m, r in zip(msgs, records):
        kind, v = model(r)
        (want_rows if kind == "ok" else want_bad).append(v if kind == "ok" else (m, v))
    assert got_bad == sorted(want_bad)
    assert got_rows == sorted(want_rows, key=repr)
