"""Functions a job can register by name.

Most are :class:`SqlFunction` objects: a SQL body that Spark inlines into the
plan as ordinary expressions (``CREATE TEMPORARY FUNCTION ... RETURN ...``), so
they run inside whole-stage codegen with no Python worker. User code that needs
Python is registered as an Arrow-batched UDF instead (see ``registry``).

String concatenation follows JVM semantics, where a null operand is written as
the text ``null`` (``null + "_new"`` is ``"null_new"``); a plain SQL ``concat``
would give NULL, so every operand is wrapped in ``coalesce(x, 'null')``.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd


@dataclass(frozen=True)
class SqlFunction:
    """A SQL-bodied function: ``params`` are ``(name, sql type)`` pairs."""

    params: tuple[tuple[str, str], ...]
    returns: str
    body: str

    @property
    def arity(self) -> int:
        return len(self.params)

    def create_statement(self, name: str) -> str:
        args = ", ".join(f"{p} {t}" for p, t in self.params)
        return f"CREATE OR REPLACE TEMPORARY FUNCTION `{name}`({args}) RETURNS {self.returns} RETURN {self.body}"


def jvm_text(expr: str) -> str:
    """SQL for a value as a JVM string concatenation would print it."""
    return f"coalesce(CAST({expr} AS STRING), 'null')"


def suffix(text: str) -> SqlFunction:
    """``t1 + text``."""
    return SqlFunction((("t1", "STRING"),), "STRING", f"concat({jvm_text('t1')}, '{text}')")


# The suffixes of the common function (F1, registered as MyUDF)
# and of the sample configured function.
suffix_test = suffix("_Test")
suffix_new = suffix("_new")

# Two- and three-argument functions, joined with "_".
join2 = SqlFunction(
    (("t1", "STRING"), ("t2", "STRING")),
    "STRING",
    f"concat({jvm_text('t1')}, '_', {jvm_text('t2')})",
)
join3 = SqlFunction(
    (("t1", "STRING"), ("t2", "STRING"), ("t3", "STRING")),
    "STRING",
    f"concat({jvm_text('t1')}, '_', {jvm_text('t2')}, '_', {jvm_text('t3')})",
)

# a function returning several columns, used as ``SELECT m.* FROM (SELECT f(x) AS m ...)``.
head_tail = SqlFunction(
    (("t1", "STRING"),),
    "STRUCT<head: STRING, tail: STRING>",
    "named_struct('head', substr(t1, 1, 1), 'tail', substr(t1, 2))",
)


def reverse_text(s: pd.Series) -> pd.Series:
    """Python user code (Series in, Series out): reverse each text, keep nulls."""
    return s.str[::-1]


reverse_text.vectorized = True  # type: ignore[attr-defined]


def split_text(s: pd.Series) -> pd.DataFrame:
    """Python user code with several columns: first letter, the rest, and the length."""
    return pd.DataFrame({"head": s.str[:1], "tail": s.str[1:], "size": s.str.len().astype("Int64")})


split_text.vectorized = True  # type: ignore[attr-defined]


def split_row(text: str | None) -> tuple | None:
    """The same for one value: a tuple in the order of the fields, None for a null struct."""
    return None if text is None else (text[:1], text[1:], len(text))
