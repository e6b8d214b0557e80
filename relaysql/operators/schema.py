"""Schema specs: a flat JSON object mapping field name to type name.

A spec such as ``{"name": "string", "age": "int"}`` is parsed once on the
driver into an ordered tuple of :class:`Field`. Declaration order is kept (the
order of the JSON object), so ``select *`` over the decoded table is stable.

Type names are matched exactly (case-sensitive). A name outside the table below
is *unknown*: under ``unknown="string"`` (the default) the field is carried as
text; under ``unknown="drop"`` the prototype rules apply, which know only
``string`` and ``int`` and drop every other field.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

# The type names a spec may use and their Spark types.
FIELD_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
    "array<int>": T.ArrayType(T.IntegerType()),
}

# The only types the prototype mode (unknown="drop") keeps.
PROTOTYPE_TYPES = ("string", "int")

UNKNOWN_POLICIES = ("string", "drop")


class SchemaSpecError(ValueError):
    """The schema spec is not a flat JSON object of name -> type name."""


@dataclass(frozen=True)
class Field:
    """One declared field.

    ``kind`` is the type name the engine acts on: one of ``FIELD_TYPES`` keys,
    or ``"text"`` for an unknown type carried as a string.
    """

    name: str
    declared: str
    kind: str

    @property
    def data_type(self) -> T.DataType:
        return FIELD_TYPES.get(self.kind, T.StringType())

    @property
    def is_array(self) -> bool:
        return self.kind.startswith("array<")

    @property
    def is_numeric(self) -> bool:
        return self.kind in ("int", "long", "double", "float")


def _load(spec: str | Mapping) -> Mapping:
    if isinstance(spec, Mapping):
        return spec
    if not isinstance(spec, str) or not spec.strip():
        raise SchemaSpecError("schema spec must be a non-empty JSON object")
    try:
        obj = json.loads(spec)
    except json.JSONDecodeError as e:
        raise SchemaSpecError(f"schema spec is not valid JSON: {e}") from e
    if not isinstance(obj, dict):
        raise SchemaSpecError("schema spec must be a JSON object")
    return obj


def parse_schema_spec(spec: str | Mapping, unknown: str = "string") -> tuple[Field, ...]:
    """Parse a schema spec into ordered fields (D1; ``unknown="drop"`` is D1b)."""
    if unknown not in UNKNOWN_POLICIES:
        raise SchemaSpecError(f"unknown must be one of {UNKNOWN_POLICIES}, got {unknown!r}")
    fields = []
    for name, declared in _load(spec).items():
        if not isinstance(name, str) or not name:
            raise SchemaSpecError(f"field name must be a non-empty string, got {name!r}")
        declared = declared if isinstance(declared, str) else json.dumps(declared)
        if unknown == "drop":
            if declared not in PROTOTYPE_TYPES:
                continue
            kind = declared
        else:
            kind = declared if declared in FIELD_TYPES else "text"
        fields.append(Field(name, declared, kind))
    if not fields:
        raise SchemaSpecError("schema spec declares no usable field")
    return tuple(fields)


def struct_type(fields: tuple[Field, ...]) -> T.StructType:
    """The Spark struct of the decoded table."""
    return T.StructType([T.StructField(f.name, f.data_type, True) for f in fields])

