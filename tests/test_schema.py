import pytest
from pyspark.sql import types as T

from pagelake.functions.schema import Paging, dataset_spec, struct_type

READINGS = """
responsePath: readings
pagination: {enabled: true, maxPages: 7}
columns:
  - {name: sensor, type: integer}
  - {name: level, type: decimal}
  - {name: taken, type: timestamp}
"""


def test_type_words_and_fallback():
    s = struct_type([
        {"name": "a", "type": "float"}, {"name": "b", "type": "integer"}, {"name": "c", "type": "string"},
        {"name": "d", "type": "boolean"}, {"name": "e", "type": "timestamp"}, {"name": "f", "type": "double"},
        {"name": "g", "type": "long"}, {"name": "h"}, {"name": "i", "type": "dict"}, {"name": "j", "type": "list"},
    ])
    assert [f.dataType for f in s.fields] == [
        T.FloatType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.TimestampType(),
        T.StringType(), T.StringType(), T.StringType(), T.StringType(), T.StringType(),
    ]
    assert all(f.nullable for f in s.fields)


def test_nested_dict_and_list():
    s = struct_type([
        {"name": "d", "type": "dictionary", "columns": [
            {"name": "x", "type": "integer"},
            {"name": "inner", "type": "list", "columns": [{"name": "y", "type": "boolean"}]},
        ]},
        {"name": "l", "type": "list", "columns": [{"name": "z", "type": "string"}]},
    ])
    d = s["d"].dataType
    assert isinstance(d, T.StructType) and d["x"].dataType == T.IntegerType()
    assert d["inner"].dataType == T.ArrayType(T.StructType([T.StructField("y", T.BooleanType())]))
    assert s["l"].dataType == T.ArrayType(T.StructType([T.StructField("z", T.StringType())]))


def test_dataset_spec_from_yaml(tmp_path):
    spec = dataset_spec(READINGS, source="src", name="readings", endpoint="v2/x", params={"unit": "cm"})
    assert (spec.qualified_name, spec.response_path) == ("src.readings", "readings")
    assert spec.paging == Paging(enabled=True, max_pages=7)
    assert [(f.name, f.dataType) for f in spec.schema.fields] == [
        ("sensor", T.IntegerType()), ("level", T.StringType()), ("taken", T.TimestampType())]
    assert spec.endpoint == "v2/x" and spec.params == {"unit": "cm"}
    (tmp_path / "r.yaml").write_text(READINGS)
    assert dataset_spec(str(tmp_path / "r.yaml"), source="src", name="readings").schema == spec.schema
    with pytest.raises(FileNotFoundError, match="absent.yaml"):
        dataset_spec(str(tmp_path / "absent.yaml"), source="src")


def test_required_keys():
    with pytest.raises(ValueError, match="responsePath"):
        dataset_spec({"pagination": {"enabled": True}}, source="s", name="d")
    for paging in (None, {"maxPages": 2}, [True]):
        with pytest.raises(ValueError, match="pagination.enabled"):
            dataset_spec({"responsePath": "body", "pagination": paging}, source="s", name="d")
    with pytest.raises(ValueError, match="mapping"):
        dataset_spec("[1, 2]", source="s", name="d")
