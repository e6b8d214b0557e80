"""Config-driven function registration (F2).

A function config is a JSON array of objects::

    [{"name": "m1", "mainClass": "relaysql.functions.library:suffix_new",
      "param": "(String)", "returnType": "string"}]

``mainClass`` names a Python object as ``module:attribute`` (a dotted
``module.attribute`` is accepted too). The object may be

* a :class:`~relaysql.functions.library.SqlFunction` -> registered as a SQL
  temporary function, inlined by Catalyst (no Python at run time);
* a pandas UDF, or a callable flagged ``vectorized = True`` taking and returning
  ``pandas.Series`` -> registered as an Arrow-batched pandas UDF;
* a function that makes one of these from the entry's ``"options"`` object, such as
  ``relaysql.functions.lookup:const_lookup`` (it names the lookup's view, columns and
  key, so a lookup is configured without code);
* any other callable -> registered as an Arrow-optimised row function.

Arity comes from ``param`` the way the configs were written: drop the
parentheses, split on commas, trailing empty parts do not count, so ``"()"``
counts as one argument. Only 1, 2 or 3 arguments are allowed, and the object must
take as many. ``returnType`` takes the schema type names (``string``, ``int``,
``long``, ...); anything else, including the default, means ``string``. A SQL
function's result is cast to it; one that returns a struct keeps its own type.
Several columns from Python are named as ``"struct<head:string,tail:int>"`` (fields of
schema type names, nested structs too): a vectorized object then returns a
``pandas.DataFrame`` with a column for each field, any other callable a tuple or a dict, and
the SQL takes the result apart with ``m.*``. A ``struct<`` that cannot be read is an error.
A blank config registers nothing.
"""

from __future__ import annotations

import importlib
import inspect
import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaysql.functions.library import SqlFunction
from relaysql.operators.schema import FIELD_TYPES
from relaysql.session import ship_package

MAX_ARITY = 3


class FunctionConfigError(ValueError):
    """The function config cannot be registered."""


def param_arity(param: str) -> int:
    """Number of arguments written in ``param`` (JVM ``String.split`` rules)."""
    text = param.replace("(", "").replace(")", "")
    parts = text.split(",")
    if text != "":
        while parts and parts[-1] == "":
            parts.pop()
    return len(parts)


@dataclass(frozen=True)
class FunctionSpec:
    name: str
    target: str
    param: str = "(String)"
    return_type: str = "string"
    options: dict | None = None

    @property
    def arity(self) -> int:
        return param_arity(self.param)

    @property
    def spark_return_type(self) -> T.DataType:
        if self.return_type.strip().lower().startswith("struct<"):
            return self._struct_type(self.return_type)
        return FIELD_TYPES.get(self.return_type, T.StringType())

    def _struct_type(self, text: str) -> T.DataType:
        try:
            return T.DataType.fromDDL(text)
        except Exception as e:        # the parser's own exception types differ between Spark modes
            raise FunctionConfigError(f"function {self.name!r}: returnType {text!r} cannot be read") from e

    def validate(self) -> None:
        if not self.name or not isinstance(self.name, str):
            raise FunctionConfigError("function entry needs a non-empty 'name'")
        if not self.target:
            raise FunctionConfigError(f"function {self.name!r} needs a 'mainClass'")
        if self.options is not None and not isinstance(self.options, dict):
            raise FunctionConfigError(f"function {self.name!r}: 'options' must be a JSON object")
        if not 1 <= self.arity <= MAX_ARITY:
            raise FunctionConfigError(
                f"function {self.name!r}: param {self.param!r} gives {self.arity} arguments; 1 to {MAX_ARITY} allowed"
            )


def parse_function_config(config: str | list | None) -> tuple[FunctionSpec, ...]:
    """Parse the JSON array of function entries; blank -> no functions."""
    if config is None or (isinstance(config, str) and not config.strip()):
        return ()
    entries = json.loads(config) if isinstance(config, str) else config
    if not isinstance(entries, list):
        raise FunctionConfigError("function config must be a JSON array")
    specs = []
    for e in entries:
        if not isinstance(e, dict):
            raise FunctionConfigError("each function entry must be a JSON object")
        if e.get("param") is None:
            raise FunctionConfigError(f"function {e.get('name')!r} needs a 'param'")
        spec = FunctionSpec(
            name=e.get("name"),
            target=e.get("mainClass"),
            param=e["param"],
            return_type=e.get("returnType") or "string",
            options=e.get("options"),
        )
        spec.validate()
        specs.append(spec)
    return tuple(specs)


def resolve(target: str):
    """Import ``module:attribute`` (or ``module.attribute``)."""
    if ":" in target:
        module, attr = target.split(":", 1)
    else:
        module, _, attr = target.rpartition(".")
    if not module:
        raise FunctionConfigError(f"cannot resolve {target!r}: use module:attribute")
    try:
        obj = importlib.import_module(module)
        for part in attr.split("."):
            obj = getattr(obj, part)
    except (ImportError, AttributeError) as e:
        raise FunctionConfigError(f"cannot resolve {target!r}: {e}") from e
    return obj


def register_function(session: SparkSession, name: str, obj, arity: int | None = None,
                      return_type: T.DataType | None = None) -> None:
    """Register one function object under ``name`` in ``session``. Without a
    ``return_type`` a SQL function keeps its own and a Python one returns text."""
    if isinstance(obj, SqlFunction):
        if arity is not None and arity != obj.arity:
            raise FunctionConfigError(f"function {name!r} takes {obj.arity} arguments, config says {arity}")
        if return_type is not None and not obj.returns.upper().startswith("STRUCT"):
            if isinstance(return_type, T.StructType):
                raise FunctionConfigError(f"function {name!r} returns {obj.returns}, config says {return_type.simpleString()}")
            obj = SqlFunction(obj.params, return_type.simpleString(), f"CAST({obj.body} AS {return_type.simpleString()})")
        session.sql(obj.create_statement(name))
        return
    if not callable(obj):
        raise FunctionConfigError(f"function {name!r}: {type(obj).__name__} is not callable")
    if arity is not None:
        _check_arity(name, obj, arity)
    return_type = return_type or T.StringType()
    ship_package(session)
    if hasattr(obj, "evalType"):  # already a Spark UDF (pandas or Python)
        session.udf.register(name, obj)
    elif getattr(obj, "vectorized", False):
        session.udf.register(name, F.pandas_udf(obj, return_type))
    else:
        session.udf.register(name, F.udf(obj, return_type, useArrow=True))


def _check_arity(name: str, obj, arity: int) -> None:
    try:
        signature = inspect.signature(getattr(obj, "func", obj))
    except (TypeError, ValueError):      # some built-in callables have none
        return
    try:
        signature.bind(*[None] * arity)
    except TypeError as e:
        raise FunctionConfigError(f"function {name!r} cannot be called with {arity} arguments: {e}") from e


def build(spec: FunctionSpec):
    """The object a config entry names; made from its options when it has some."""
    obj = resolve(spec.target)
    if getattr(obj, "from_options", False):
        try:
            return obj(**(spec.options or {}))
        except (TypeError, ValueError) as e:
            raise FunctionConfigError(f"function {spec.name!r}: {e}") from e
    if spec.options is not None:
        raise FunctionConfigError(f"function {spec.name!r}: {spec.target} takes no options")
    return obj


def register_functions(session: SparkSession, specs: tuple[FunctionSpec, ...]) -> None:
    for spec in specs:
        register_function(session, spec.name, build(spec), spec.arity, spec.spark_return_type)
