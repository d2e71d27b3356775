"""Typed metadata against Python's own equality."""

import json

import pytest
from pyspark.sql import functions as F

from vecloom.functions import typed

OBJECTS = [
    {}, {"a": None}, {"a": 0}, {"a": 1}, {"a": 1.0}, {"a": 1.5}, {"a": True}, {"a": False}, {"a": "1"}, {"a": "true"}, {"a": ""},
    {"a": {"b": 1}}, {"a": {"b": 1.0, "c": None}}, {"a": {"b": "1"}}, {"a": []}, {"a": [1, "x"]}, {"a": [True, "x"]}, {"a": [1, "x", 2]},
    {"a.b": 1}, {"a": {}, "b": 2}, {"a": 2**53 + 1}, {"a": -1e300}, {"A": 1}, {"it's": 3}, {"é": "ü"},
]
FILTERS = [
    {"a": value} for value in (None, 0, 1, 1.0, 1.5, True, False, "1", "true", "", {"b": 1}, {"b": 1, "c": None}, {"b": 1, "d": None}, {}, [], [1, "x"], [1.0, "x"], ["x", 1], 2**53, 2**53 + 1, -1e300, float("nan"))
] + [{"metadata.a": 1}, {"a.b": 1}, {"a": {}, "b": 2}, {"it's": 3}, {"é": "ü"}, {}, {"none": None}]


def test_filters_compare_like_values(spark, tmp_path):
    rows = [(i, json.dumps(x)) for i, x in enumerate(OBJECTS)]
    held = spark.createDataFrame(rows, "i int, j string").select("i", typed.typed(F.col("j")).alias("v"))
    held.write.parquet(str(tmp_path / "held"))
    held = spark.read.parquet(str(tmp_path / "held"))
    assert dict(held.dtypes)["v"] == "variant"
    found = held.select("i", *(typed.matches(F.col("v"), f).alias(f"f{n}") for n, f in enumerate(FILTERS))).collect()
    for row in found:
        for n, wanted in enumerate(FILTERS):
            same = all(OBJECTS[row.i].get(k.removeprefix("metadata.")) == v for k, v in wanted.items())
            assert row[f"f{n}"] == same, (OBJECTS[row.i], wanted)
    back = {r.i: json.loads(r.j) for r in held.select("i", typed.as_json(F.col("v")).alias("j")).collect()}
    assert [back[i] for i in range(len(OBJECTS))] == OBJECTS


def test_what_is_no_json_has_no_value(spark):
    rows = spark.createDataFrame([(None,), ("",), ("{",), ("null",), ('"x"',)], "j string").select(typed.typed(F.col("j")).alias("v"))
    assert [r.a for r in rows.select(typed.matches(F.col("v"), {"a": 1}).alias("a")).collect()] == [False] * 5
    assert [r.a for r in rows.select(typed.matches(F.col("v"), {"a": None}).alias("a")).collect()] == [True] * 5


def test_text_forms_and_literals(spark):
    values = ["x", 1, True, None, {"b": [1]}]
    row = spark.range(1).select(*(typed.text_form(typed.literal(v)).alias(f"t{i}") for i, v in enumerate(values))).first()
    assert list(row) == ["x", "1", "true", None, '{"b":[1]}']
    with pytest.raises(ValueError):
        typed.member(F.lit(None), "a'b\"c")
    with pytest.raises(TypeError):
        typed.equals(F.lit(None), object())
