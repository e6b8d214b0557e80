import pytest
from pyspark.sql import types as T

from relaysql.operators.schema import SchemaSpecError, parse_schema_spec, struct_type

ALL_TYPES = ('{"s":"string","i":"int","l":"long","d":"double","f":"float","b":"boolean",'
             '"sa":"array<string>","ia":"array<int>","x":"timestamp"}')


def test_every_type_maps_and_order_is_kept():
    fields = parse_schema_spec(ALL_TYPES)
    assert [f.name for f in fields] == ["s", "i", "l", "d", "f", "b", "sa", "ia", "x"]
    st = struct_type(fields)
    assert [f.dataType for f in st.fields] == [
        T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType(), T.BooleanType(),
        T.ArrayType(T.StringType()), T.ArrayType(T.IntegerType()), T.StringType(),
    ]
    assert fields[-1].kind == "text"


def test_prototype_mode_keeps_only_string_and_int():
    fields = parse_schema_spec(ALL_TYPES, unknown="drop")
    assert [(f.name, f.kind) for f in fields] == [("s", "string"), ("i", "int")]


def test_type_names_are_case_sensitive():
    (f,) = parse_schema_spec('{"age":"Int"}')
    assert f.kind == "text" and f.data_type == T.StringType()


@pytest.mark.parametrize("bad", ["", "[]", "not json", "{}", '{"a":"string"}x'])
def test_bad_specs(bad):
    with pytest.raises(SchemaSpecError):
        parse_schema_spec(bad)


def test_bad_unknown_policy():
    with pytest.raises(SchemaSpecError):
        parse_schema_spec('{"a":"string"}', unknown="keep")
