"""Decode JSON message text into the typed table ``source``.

The decode is column expressions over the message text: a typed ``from_json``
for every message, a text ``from_json`` only for messages that do not fit the
declared types, then the rules below. It runs map-side with no shuffle, and
every field is checked (a bad record is bad whichever columns the SQL reads).

Rules (per declared type):

* A field whose JSON value does not have the declared type is read as text
  (arrays as ``array<string>``) and cast; ``int`` and ``long`` are always read so.
  This is what makes ``"21"``, ``21.9``, ``"1,234"`` and ``true`` usable as
  numbers, as a lenient JSON library would.
* ``int``/``long``/``double``/``float``/``boolean``: a missing key, JSON
  ``null``, ``""``, ``"null"`` or ``"NULL"`` gives ``0`` / ``0.0`` / ``false``.
* ``string``, arrays and unknown types are non-nullable: a missing value is a
  bad record. Nested objects and arrays given for a text field become their
  JSON text.
* ``array<int>`` elements go through the integer coercion; a null element is 0.

Numbers for ``int`` and ``long`` are truncated toward zero, however many digits and
decimals they have, and any exponent is decided by moving the point in the text, so a
message costs what its length costs. The parser hands out a fraction as the text of
its nearest double; where that may hide digits that decide the result (see
``_may_be_rounded``) the message's own digits are read instead. Numbers for ``double`` and ``float`` must be
finite: ``NaN``, ``Infinity``, ``1e400``, a float out of range, and Java spellings
like ``5f`` are bad records. White space of any kind around a number counts for
nothing; a message of white space only is an empty message.

Declared deviations: an integer that overflows the declared type is a bad record
(it would wrap silently in a JVM library), and the text ``"21.9"`` for an
``int`` is accepted as 21 (after the text parse a JSON number and a JSON string
cannot be told apart). A JSON number in a ``string`` field becomes the text of the
nearest double (``1e2`` gives ``100.0``, digits beyond a double's are lost). JSON keys
are case-sensitive; the last of duplicate keys wins; trailing text after the object is
ignored; unquoted field names and single quotes are accepted.

Bad records: ``on_bad_record="fail"`` raises on the first one (the reference has
no error handling, so one bad message fails the batch); ``"quarantine"`` keeps
them aside in a second DataFrame with the message text and a reason.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaysql.operators.schema import Field
from relaysql.operators.shape import qcol

BAD_RECORD_POLICIES = ("fail", "quarantine")

# Texts that mean "no value" for a numeric or boolean field.
ABSENT_TEXTS = ("", "null", "NULL")
# Accepted boolean spellings (compared in lower case).
TRUE_TEXTS = ("true", "1", "y", "t")
FALSE_TEXTS = ("false", "0", "n", "f")

JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "locale": "en-US",  # decimals read from JSON text drop "," separators
    "allowUnquotedFieldNames": "true",
    "allowSingleQuotes": "true",
    "allowNumericLeadingZeros": "true",
    "allowNonNumericNumbers": "true",
}

# Fixed value: the white space that JSON texts and numbers may be surrounded by.
WHITE_SPACE = " \t\n\x0b\f\r"
NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
# A number that fits a long whatever its digits are, decimals ignored.
SHORT_NUMBER = r"^-?[0-9]{1,18}([.][0-9]*)?$"
# A double keeps any 15 digits: a message without a longer run of them hides none.
LONG_DIGITS = "[0-9.]{16}"
# Everything up to a number that stands as a value, and the number. Texts are passed
# over whole, and no part gives back what it took, so the match is linear.
VALUE_NUMBER = (r"""\G((?:"(?:[^"\\]|\\[\s\S])*+"|'(?:[^'\\]|\\[\s\S])*+'|[^"':,\[]|[:,\[](?!\s*[-+.0-9]))*+[:,\[]\s*+)"""
                r"([-+.0-9][-+.0-9eE]*+)")


@dataclass(frozen=True)
class Decoded:
    """Result of :func:`decode`: the typed rows and, under quarantine, the rejects.

    ``checked`` is the stage both come from (the typed fields plus, under
    quarantine, the message and reason of bad rows); persisting it makes the
    rows and the rejects share one parse.
    """

    rows: DataFrame
    rejected: DataFrame | None
    checked: DataFrame


def _trim(v: Column) -> Column:
    return F.trim(v, F.lit(WHITE_SPACE))


def _absent(v: Column) -> Column:
    return v.isNull() | _trim(v).isin(*ABSENT_TEXTS)


def _bool_number(v: Column, dtype: T.DataType) -> Column:
    lv = F.lower(_trim(v))
    return F.when(lv == "true", F.lit(1).cast(dtype)).when(lv == "false", F.lit(0).cast(dtype))


def _no_commas(v: Column) -> Column:
    return F.replace(_trim(v), F.lit(","), F.lit(""))


def _let(value: Column, rule: Callable[[Column], Column]) -> Column:
    """``rule(value)`` with the value computed once, in a lambda: an expression tree,
    not inlined into generated code."""
    return F.transform(F.array(value), rule).getItem(0)


def _truncated(s: Column, dtype: T.DataType) -> Column:
    """A number's text, with point or exponent, truncated toward zero; NULL when it is
    no number or out of range. The exponent moves the point in the digits, so its size
    costs nothing."""
    def parts(p: Column) -> Column:
        digits = F.replace(p["mantissa"], F.lit("."), F.lit(""))
        size = (F.when(p["exponent"] == "", 0).when(F.length(p["exponent"]) > 6, 1_000_000)
                .otherwise(p["exponent"].try_cast(T.IntegerType())))
        return F.struct(digits.alias("digits"), F.ltrim(digits, F.lit("0")).alias("bare"),
                        (F.length(F.substring_index(p["mantissa"], ".", 1)) + F.when(s.rlike("[eE]-"), -size).otherwise(size)).alias("point"))

    def whole(p: Column) -> Column:
        n = p["point"] - (F.length(p["digits"]) - F.length(p["bare"]))        # digits before the point
        return _let(n, lambda n: F.when((p["bare"] == "") | (n <= 0), F.lit("0"))
                    .when(n <= 19, F.rpad(F.substr(p["bare"], F.lit(1), n), n, F.lit("0"))))

    text = _let(_let(F.struct(F.regexp_extract(s, r"^[+-]?([0-9.]*)", 1).alias("mantissa"),
                              F.regexp_extract(s, r"[eE][+-]?0*([0-9]+)$", 1).alias("exponent")), parts), whole)
    return F.when(s.rlike(NUMBER), F.concat(F.when(s.startswith("-"), "-").otherwise(""), text).try_cast(dtype))


# Every cast below is reached only with text that has already passed the cheap
# checks before it, so a cast fails (and pays for an exception) only on text
# that is a bad record anyway.


def short_integral(v: Column, dtype: T.DataType) -> Column:
    """Text of digits, with or without decimals and ``,`` separators -> int/long;
    NULL for any other text."""
    plain = F.replace(v, F.lit(","), F.lit(""))
    return F.when(plain.rlike(SHORT_NUMBER), F.substring_index(plain, ".", 1).try_cast(dtype))


def coerce_integral(v: Column, dtype: T.DataType) -> Column:
    """Text -> int/long, or NULL when absent or not coercible.

    ``21``, ``21.9`` (-> 21), ``1e2`` and, once separators are dropped, ``1,234``.
    """
    number = _let(_no_commas(v), lambda s: F.when(s.rlike("[.eE]"), _truncated(s, dtype)).otherwise(s.try_cast(dtype)))
    return F.when(_absent(v), F.lit(None).cast(dtype)).otherwise(F.coalesce(_bool_number(v, dtype), number))


def _may_be_rounded(text: Column) -> Column:
    """Could this text be a double that stands for other digits with another whole part?
    Below 2^53 a double with a fraction lies between the same whole numbers as what it
    was read from, so only whole doubles and those written with an exponent could."""
    return F.endswith(text, F.lit(".0")) | F.contains(text, F.lit("E"))


def _finite(v: Column) -> Column:
    """NULL for NaN and the infinities."""
    return F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")), v)


def coerce_fractional(v: Column, dtype: T.DataType) -> Column:
    """Text -> double/float, or NULL when absent, not coercible or not finite."""
    plain = _no_commas(v)
    as_double = F.when(_absent(v), F.lit(None).cast(T.DoubleType())).otherwise(
        F.coalesce(_bool_number(v, T.DoubleType()), F.when(plain.rlike(NUMBER), plain.try_cast(T.DoubleType())))
    )
    return _finite(as_double if isinstance(dtype, T.DoubleType) else as_double.cast(dtype))


def coerce_boolean(v: Column) -> Column:
    lv = F.lower(_trim(v))
    return F.when(lv.isin(*TRUE_TEXTS), F.lit(True)).when(lv.isin(*FALSE_TEXTS), F.lit(False))


def _coerce(v: Column, kind: str) -> Column:
    if kind in ("int", "long"):
        return coerce_integral(v, T.IntegerType() if kind == "int" else T.LongType())
    if kind in ("double", "float"):
        return coerce_fractional(v, T.DoubleType() if kind == "double" else T.FloatType())
    return coerce_boolean(v)


INTEGRAL = ("int", "long", "array<int>")
_DEFAULTS = {"int": 0, "long": 0, "double": 0.0, "float": 0.0, "boolean": False}


def text_value(f: Field, raw: Column) -> Column:
    """One field of the text parse, coerced; NULL when absent or not coercible."""
    if f.kind in _DEFAULTS:
        return _coerce(raw, f.kind)
    if f.kind == "array<int>":
        return F.transform(raw, lambda x: coerce_integral(x, T.IntegerType()))
    return raw          # string, array<string>, unknown types carried as text


def text_rule(f: Field, raw: Column, value: Column) -> tuple[Column, Column]:
    """(typed value, bad-record reason or NULL) from a field's text and coerced value."""
    missing = F.lit(f"missing:{f.name}")
    coercion = F.lit(f"coercion:{f.name}")
    if f.kind in _DEFAULTS:
        return (F.coalesce(value, F.lit(_DEFAULTS[f.kind]).cast(f.data_type)),
                F.when(value.isNull() & ~_absent(raw), coercion))
    if f.kind == "array<int>":
        not_coercible = F.exists(F.zip_with(value, raw, lambda v, t: v.isNull() & ~_absent(t)), lambda bad: bad)
        return (F.transform(value, lambda x: F.coalesce(x, F.lit(0))),
                F.when(raw.isNull(), missing).when(not_coercible, coercion))
    return raw, F.when(raw.isNull(), missing)


def typed_rule(f: Field, parsed: Column) -> tuple[Column, Column | None, Column | None]:
    """(typed value, reason, must the text rules decide) for one field of a record that
    the typed parse accepted.

    Integral fields were read as text. Plain digits are cast here, all else is left to
    the text rules. Other fields were read with their declared type; what is left are
    defaults for nulls, finite numbers, and non-null for the rest.
    """
    if f.kind in ("int", "long"):
        value = short_integral(parsed, f.data_type)
        return (F.when(parsed.isNull(), F.lit(0).cast(f.data_type)).otherwise(value), None,
                parsed.isNotNull() & value.isNull())
    if f.kind == "array<int>":
        value = F.transform(parsed, lambda x: F.when(x.isNull(), F.lit(0)).otherwise(short_integral(x, T.IntegerType())))
        return value, F.when(parsed.isNull(), F.lit(f"missing:{f.name}")), F.exists(value, lambda x: x.isNull())
    if f.kind == "boolean":
        return F.coalesce(parsed, F.lit(False)), None, None
    if f.kind in _DEFAULTS:
        value = _finite(parsed.cast(f.data_type) if f.kind == "float" else parsed)
        return (F.coalesce(value, F.lit(_DEFAULTS[f.kind]).cast(f.data_type)),
                F.when(parsed.isNotNull() & value.isNull(), F.lit(f"coercion:{f.name}")), None)
    return parsed, F.when(parsed.isNull(), F.lit(f"missing:{f.name}")), None


def _text_type(f: Field) -> T.DataType:
    return T.ArrayType(T.StringType()) if f.is_array else T.StringType()


def raw_schema(fields: tuple[Field, ...], corrupt_col: str) -> T.StructType:
    """The schema of the fallback parse: text."""
    cols = [T.StructField(f.name, _text_type(f), True) for f in fields]
    return T.StructType(cols + [T.StructField(corrupt_col, T.StringType(), True)])


def _typed_read_type(f: Field) -> T.DataType:
    if f.kind in INTEGRAL:
        return _text_type(f)
    if f.kind == "float":
        return T.DoubleType()
    return f.data_type


def typed_schema(fields: tuple[Field, ...], corrupt_col: str) -> T.StructType:
    """The schema of the first, typed parse: integral values are read as text, whose
    digits cost no exception when they are no plain integer, and floats as doubles."""
    cols = [T.StructField(f.name, _typed_read_type(f), True) for f in fields]
    return T.StructType(cols + [T.StructField(corrupt_col, T.StringType(), True)])


def _corrupt_name(fields: tuple[Field, ...]) -> str:
    names = {f.name for f in fields}
    name = "_corrupt_record"
    while name in names:
        name = "_" + name
    return name


class Decoder:
    """Decode JSON message text into typed ``fields``.

    Only the declared fields come out, in declaration order; other columns of
    the messages (topic metadata and so on) are not carried.

    Two parses, the second only when needed: every message is parsed once with
    the declared types (integral ones read as text, so ``21.9`` or ``"1,234"``
    for an int already fit), which is the cheap path. A message that
    does not fit (a number sent as text for a double, ``true`` for a double,
    ``"Y"`` for a boolean, malformed text) is marked by the
    parser; only those messages are parsed again as text and go through the
    coercion rules. So are the few whose integers may be rounded doubles; their
    numbers are set in quotes first, and so read digit by digit.

    The column expressions are built once here and reused for every batch, so a
    micro-batch costs the driver only a few plan calls.
    """

    def __init__(self, fields: tuple[Field, ...], on_bad_record: str = "fail"):
        if on_bad_record not in BAD_RECORD_POLICIES:
            raise ValueError(f"on_bad_record must be one of {BAD_RECORD_POLICIES}, got {on_bad_record!r}")
        reserved = [f.name for f in fields if f.name.startswith("__")]
        if reserved:
            raise ValueError(f"field names starting with '__' are reserved for the decoder: {reserved}")
        self.fields = fields
        self.on_bad_record = on_bad_record
        corrupt = _corrupt_name(fields)
        self._typed_schema = typed_schema(fields, corrupt)
        t = F.col("__t")
        whole = [f for f in fields if f.kind in INTEGRAL]
        long_digits = F.col("__msg").rlike(LONG_DIGITS)

        # The typed-path values and reason are computed in a projection of their
        # own. The lambda keeps it out of the whole-stage generated code: Spark then
        # splits its expressions into small methods, and the generated stage above
        # only picks between ready values, so its code does not grow with the
        # number of fields.
        values, reasons, left = [], [], [_let(t.getField(corrupt), lambda c: c.isNotNull())]
        for i, f in enumerate(fields):
            value, why, undecided = typed_rule(f, t.getField(f.name))
            values.append(value.alias(f"__f{i}"))
            reasons += [why] if why is not None else []
            left += [undecided] if undecided is not None else []
        if whole:
            left.append(reduce(or_, [F.exists(t.getField(f.name), _may_be_rounded) if f.is_array
                                     else _may_be_rounded(t.getField(f.name)) for f in whole]) & long_digits)
        again = F.coalesce(*[F.when(x, F.lit(True)) for x in left], F.lit(False))
        self._fast = [*values, (F.coalesce(*reasons) if reasons else F.lit(None).cast("string")).alias("__fr"), again.alias("__again")]

        # Text path, for the other messages only: parse again as text and apply the
        # coercion rules, all inside lambdas over one-element arrays. A lambda is
        # evaluated as an expression tree, not inlined into generated code, so the
        # hot loop of the stage keeps only the typed path and stays small enough
        # for the JIT (inlining the text rules of ten fields made a 24 KB method
        # the JVM refuses to compile).
        def with_value(f: Field) -> Callable[[Column], Column]:
            return lambda text: F.struct(text.alias("t"), text_value(f, text).alias("c"))

        def coerced(x: Column) -> Column:
            raw, exact = x.getField("raw"), x.getField("exact")
            parts = [raw.getField(corrupt).isNotNull().alias("malformed")]
            for i, f in enumerate(fields):
                given = raw.getField(f.name)
                if f in whole:
                    given = F.when(exact.isNotNull() & exact.getField(corrupt).isNull(), exact.getField(f.name)).otherwise(given)
                parts.append(_let(given, with_value(f)).alias(f"f{i}"))
            return F.struct(*parts)

        def ruled(x: Column) -> Column:
            parts = [x.getField("malformed").alias("malformed")]
            for i, f in enumerate(fields):
                value, why = text_rule(f, x.getField(f"f{i}").getField("t"), x.getField(f"f{i}").getField("c"))
                parts += [value.alias(f"v{i}"), why.alias(f"r{i}")]
            return F.struct(*parts)

        parses = [F.from_json(F.col("__msg"), raw_schema(fields, corrupt), JSON_OPTIONS).alias("raw")]
        quoted = F.regexp_replace(F.col("__msg"), F.lit(VALUE_NUMBER), F.lit('$1"$2"'))
        parses.append(F.when(long_digits, F.from_json(quoted, raw_schema(tuple(whole), corrupt), JSON_OPTIONS)).alias("exact"))
        misfit = F.col("__again")
        self._text = F.when(misfit, _let(_let(F.struct(*parses), coerced), ruled)).alias("__s")
        self._fast_cols = [F.col(f"__f{i}") for i in range(len(fields))]
        s = F.col("__s")
        typed = [F.when(misfit, s.getField(f"v{i}")).otherwise(F.col(f"__f{i}")).alias(f.name)
                 for i, f in enumerate(fields)]
        m = F.col("__msg")
        reason = F.coalesce(
            F.when(m.isNull() | (_trim(m) == ""), F.lit("empty")),
            F.when(misfit & s.getField("malformed"), F.lit("malformed")),
            F.when(misfit, F.coalesce(*[s.getField(f"r{i}") for i in range(len(fields))]))
            .otherwise(F.col("__fr")),
        )
        # The reason is computed once in a projection; then typed values and
        # reason come out of a one-row generator. Filters on generator outputs
        # cannot be pushed below it - neither the guard nor a user's filter on a
        # decoded column - so Catalyst cannot inline the parses into a predicate
        # once per reference.
        self._names = [qcol(f.name) for f in fields]
        if on_bad_record == "fail":
            # The error is raised inside the generator, which runs for every
            # message whatever filters the SQL adds above it (Catalyst may order
            # an inferred IS NOT NULL of a user filter before a guard filter).
            # Its text is built for bad rows only, so the message itself does not
            # travel past the generator.
            error = F.when(reason.isNotNull(), F.concat(
                F.lit("bad record ("), reason, F.lit("): "), F.coalesce(m, F.lit("NULL"))))
            self._stage = [misfit, s, *self._fast_cols, error.alias("__r")]
            e = F.col("__r")
            ok = F.when(e.isNull(), F.lit(True)).otherwise(F.raise_error(e))
            self._generate = F.inline(F.array(F.struct(ok.alias("__ok"), *typed)))
            self._guard = F.col("__ok")
        else:
            r0 = F.col("__r")
            self._stage = [m, misfit, s, *self._fast_cols, reason.alias("__r")]
            self._generate = F.inline(F.array(F.struct(
                F.when(r0.isNotNull(), m).alias("__msg"), r0.alias("__reason"), *typed)))

    def __call__(self, messages: DataFrame, value_col: str = "value") -> Decoded:
        msg = F.col(value_col).cast("string")
        first = messages.select(msg.alias("__msg"), F.from_json(msg, self._typed_schema, JSON_OPTIONS).alias("__t"))
        fast = first.select("__msg", *self._fast)
        parsed = fast.select("*", self._text)
        checked = parsed.select(*self._stage).select(self._generate)
        return self.split(checked)

    def split(self, checked: DataFrame) -> Decoded:
        """The rows and rejects of a decode stage, as it was made or stored and read again."""
        if self.on_bad_record == "fail":
            return Decoded(checked.where(self._guard).select(*self._names), None, checked)
        r = F.col("__reason")
        rows = checked.where(r.isNull()).select(*self._names)
        rejected = checked.where(r.isNotNull()).select(F.col("__msg").alias("value"), r.alias("reason"))
        return Decoded(rows, rejected, checked)


@lru_cache(maxsize=256)
def _decoder(application: str, fields: tuple[Field, ...], on_bad_record: str) -> Decoder:
    return Decoder(fields, on_bad_record)


def decoder_for(session: SparkSession, fields: tuple[Field, ...], on_bad_record: str = "fail") -> Decoder:
    """The decoder of these fields, its expressions built once per application: some
    hundred calls to the JVM, which jobs and batches of one schema need not repeat."""
    return _decoder(session.sparkContext.applicationId, fields, on_bad_record)


def decode(
    messages: DataFrame,
    fields: tuple[Field, ...],
    on_bad_record: str = "fail",
    value_col: str = "value",
) -> Decoded:
    """Decode the ``value_col`` text of ``messages`` (see :class:`Decoder`)."""
    return decoder_for(messages.sparkSession, fields, on_bad_record)(messages, value_col)
