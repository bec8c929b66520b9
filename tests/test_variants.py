import json

import pytest

from tests.test_plan_shapes import plan, scans
from tidemark.operators.variants import rejected_json, typed_json


def frame(spark, values):
    return spark.createDataFrame([(i, v if v is None or isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)], "id int, p string")


def typed(spark, values):
    out = typed_json(frame(spark, values), "p")
    return dict(out.dtypes), [r.asDict() for r in out.orderBy("id").collect()]


def test_types_are_found_at_any_depth(spark):
    values = [{"a": 1, "b": {"c": True, "d": {"e": 1.5, "f g": "x", "it's": 1}}, "l": [1, 2], "n": None}, {"a": None, "b": {"d": {"e": 2}}, "l": []}, "no json", None]
    kinds, rows = typed(spark, values)
    assert kinds == {
        "id": "int", "p__a": "bigint", "p__b__c": "boolean", "p__b__d__e": "double", "p__b__d__f g": "string", "p__b__d__it's": "bigint", "p__l": "array<bigint>", "p__n": "string",
    }
    assert rows[0] == {"id": 0, "p__a": 1, "p__b__c": True, "p__b__d__e": 1.5, "p__b__d__f g": "x", "p__b__d__it's": 1, "p__l": [1, 2], "p__n": None}
    assert rows[1]["p__b__d__e"] == 2.0 and rows[1]["p__l"] == []
    assert set(rows[2].values()) == {2, None} and set(rows[3].values()) == {3, None}
    assert [r.id for r in rejected_json(frame(spark, values), "p").collect()] == [2]


def test_a_conflict_inside_an_object_is_split_and_loses_nothing(spark):
    values = [{"o": {"k": v}} for v in [1, 2.5, "x", "y", "z", "w", True, {"q": 1}, [1], None]] + [{"o": {}}, {}]
    kinds, rows = typed(spark, values)
    assert kinds == {"id": "int", "p__o__k": "string", "p__o__k__v_double": "double", "p__o__k__v_json": "string", "p__o__k__v_boolean": "boolean"}
    for value, row in zip(values, rows):
        want = value.get("o", {}).get("k")
        got = [v for k, v in row.items() if k != "id" and v is not None]
        assert got == ([] if want is None else [json.dumps(want).replace(" ", "")] if isinstance(want, (dict, list)) else [want])


def test_other_tops_and_empty_columns(spark):
    assert typed(spark, [1, 2]) == ({"id": "int", "p": "bigint"}, [{"id": 0, "p": 1}, {"id": 1, "p": 2}])
    assert typed(spark, [[1, "x"]])[1] == [{"id": 0, "p": '[1,"x"]'}]
    assert typed(spark, [None, None]) == ({"id": "int"}, [{"id": 0}, {"id": 1}])
    assert typed(spark, [])[1] == []
    assert typed(spark, [{}, {}]) == ({"id": "int"}, [{"id": 0}, {"id": 1}])


def test_clashing_names_are_refused_and_the_plan_is_one_scan(spark, tmp_path):
    with pytest.raises(ValueError, match="p__a"):
        typed_json(spark.createDataFrame([(1, '{"a": 1}')], "p__a int, p string"), "p")
    frame(spark, [{"a": 1}, {"a": "x"}]).write.parquet(str(tmp_path / "t"))
    text = plan(typed_json(spark.read.parquet(str(tmp_path / "t")), "p"))
    assert len(scans(text)) == 1 and "Python" not in text and "Exchange" not in text
