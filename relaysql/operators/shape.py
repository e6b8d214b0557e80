"""Shape a SQL result by the output schema and encode it as JSON messages.

* :func:`shape` (O1, O2d) keeps only the declared names, matched by exact case,
  in declared order; undeclared SQL columns are dropped. Declared types are
  checked against the result schema *before* anything runs: ``int`` needs an
  INT column, ``long`` a BIGINT (declare ``count(*)`` as ``long``), and so on;
  ``string`` and unknown types accept any column and carry it as text. Nulls
  follow the encode rules: numbers become ``0``/``0.0``, booleans ``false``,
  strings stay null (their key is omitted), a null array is an error, a null
  element of ``array<int>`` becomes ``0``. JSON has no NaN and no infinity:
  a ``double`` or ``float`` that is not finite counts as null.
* :func:`encode_json` (O2) turns each shaped row into one JSON object text in a
  ``value`` column, ready for a topic or text sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaysql.operators.schema import Field


class OutputSchemaError(ValueError):
    """The SQL result cannot be shaped by the output schema."""


def qcol(name: str) -> Column:
    """Column by exact name, safe for dots and spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


_NULL_DEFAULTS = {"int": 0, "long": 0, "double": 0.0, "float": 0.0, "boolean": False}


def _check(f: Field, actual: T.DataType) -> None:
    if f.kind in ("string", "text"):
        return
    if actual.simpleString() != f.data_type.simpleString():  # element nullability is not part of the type
        raise OutputSchemaError(
            f"output field {f.name!r} is declared {f.declared!r} ({f.data_type.simpleString()}) "
            f"but the SQL result column is {actual.simpleString()}"
        )


def shape(result: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """Project ``result`` onto the declared output fields (by exact name)."""
    types: dict[str, list[T.DataType]] = {}
    for sf in result.schema.fields:
        types.setdefault(sf.name, []).append(sf.dataType)
    cols = []
    for f in fields:
        found = types.get(f.name)
        if not found:
            near = [n for n in types if n.lower() == f.name.lower()]
            hint = f" (result has {near[0]!r}; names are case-sensitive)" if near else ""
            raise OutputSchemaError(f"output field {f.name!r} is not a column of the SQL result{hint}")
        if len(found) > 1:
            raise OutputSchemaError(f"output field {f.name!r} is ambiguous in the SQL result")
        _check(f, found[0])
        c = qcol(f.name)
        if f.kind in ("string", "text"):
            if found[0] != T.StringType():
                c = c.cast("string")
        elif f.kind in _NULL_DEFAULTS:
            if f.kind in ("double", "float"):
                c = F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
            c = F.coalesce(c, F.lit(_NULL_DEFAULTS[f.kind]).cast(f.data_type))
        else:  # arrays
            c = F.when(c.isNull(), F.raise_error(F.lit(f"output field {f.name!r}: array is null"))).otherwise(
                F.transform(c, lambda x: F.coalesce(x, F.lit(0))) if f.kind == "array<int>" else c)
        cols.append(c.alias(f.name))
    return result.select(*cols)


def encode_json(shaped: DataFrame) -> DataFrame:
    """One JSON object text per row, in a ``value`` column (null keys omitted)."""
    return shaped.select(
        F.to_json(F.struct(*[qcol(n) for n in shaped.columns]), {"ignoreNullFields": "true"}).alias("value")
    )
