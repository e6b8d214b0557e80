import json

import pytest

from relaysql.operators.schema import parse_schema_spec
from relaysql.operators.shape import OutputSchemaError, encode_json, shape


def _df(spark, sql):
    return spark.sql(sql)


def test_project_by_name_order_free_and_drop_undeclared(spark):
    df = _df(spark, "select 1 as age, 'x' as extra, 'jack' as newname")
    out = shape(df, parse_schema_spec('{"newname":"string","age":"int"}'))
    assert out.columns == ["newname", "age"]
    assert [json.loads(r.value) for r in encode_json(out).collect()] == [{"newname": "jack", "age": 1}]


def test_null_handling_on_encode(spark):
    df = _df(spark, "select cast(null as string) s, cast(null as int) i, cast(null as bigint) l, "
                    "cast(null as double) d, cast(null as float) f, cast(null as boolean) b")
    fields = parse_schema_spec('{"s":"string","i":"int","l":"long","d":"double","f":"float","b":"boolean"}')
    (r,) = encode_json(shape(df, fields)).collect()
    assert json.loads(r.value) == {"i": 0, "l": 0, "d": 0.0, "f": 0.0, "b": False}


def test_null_array_is_an_error(spark):
    df = _df(spark, "select cast(null as array<string>) a")
    out = encode_json(shape(df, parse_schema_spec('{"a":"array<string>"}')))
    with pytest.raises(Exception, match="array is null"):
        out.collect()


def test_arrays_encode(spark):
    df = _df(spark, "select array('code','game') a, array(1, 2) b")
    (r,) = encode_json(shape(df, parse_schema_spec('{"a":"array<string>","b":"array<int>"}'))).collect()
    assert json.loads(r.value) == {"a": ["code", "game"], "b": [1, 2]}


def test_type_mismatch_fails_before_running(spark):
    df = _df(spark, "select count(*) as n from range(3)")
    with pytest.raises(OutputSchemaError, match="declared 'int'"):
        shape(df, parse_schema_spec('{"n":"int"}'))
    assert shape(df, parse_schema_spec('{"n":"long"}')).collect()[0].n == 3


def test_missing_or_case_differing_name_fails(spark):
    df = _df(spark, "select 1 as Age")
    with pytest.raises(OutputSchemaError, match="case-sensitive"):
        shape(df, parse_schema_spec('{"age":"int"}'))
    with pytest.raises(OutputSchemaError, match="not a column"):
        shape(df, parse_schema_spec('{"other":"int"}'))


def test_string_and_unknown_types_take_any_column_as_text(spark):
    df = _df(spark, "select 12 as n, date'2024-01-02' as d")
    (r,) = encode_json(shape(df, parse_schema_spec('{"n":"string","d":"date"}'))).collect()
    assert json.loads(r.value) == {"n": "12", "d": "2024-01-02"}
