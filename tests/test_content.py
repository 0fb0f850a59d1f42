import json

from pyspark.sql import functions as F

from threadtables.functions import content as C

CONTENT = {
    "wrapped": {"value": "a"}, "plain": "b", "null": None, "wrapped_null": {"value": None}, "empty": {"value": ""},
    "zero": {"value": 0}, "zero_text": "0", "false": False, "true": {"value": True}, "list": {"value": ["x", "y"]},
    "empty_list": {"value": []}, "empty_object": {}, "whole": {"value": 7.0}, "half": 7.5, "int": 3,
    "object": {"other": 1}, "accent": "é\n\"q\"", "zero_float": 0.0,
}


def _value(spark, column):
    df = spark.createDataFrame([(json.dumps(CONTENT),)], "content string")
    return df.select(C.parse(F.col("content")).alias("p")).select(column(F.col("p"))).first()[0]


def test_content_value(spark):
    expected = {
        "wrapped": "a", "plain": "b", "null": "-", "missing": "-", "wrapped_null": None, "empty": "", "zero": "0",
        "zero_text": "0", "false": "False", "true": "True", "list": '["x","y"]', "whole": "7.0", "half": "7.5",
        "int": "3", "object": '{"other":1}', "accent": 'é\n"q"',
    }
    found = _value(spark, lambda p: F.array(*[C.content_value(p, k, "-") for k in expected]))
    assert dict(zip(expected, found)) == expected


def test_truthy_follows_the_json_type(spark):
    falsy = {"null", "missing", "wrapped_null", "empty", "zero", "false", "empty_list", "empty_object", "zero_float"}
    keys = [*CONTENT, "missing"]
    found = _value(spark, lambda p: F.array(*[C.truthy(p, k) for k in keys]))
    assert {k for k, t in zip(keys, found) if not t} == falsy


def test_lists_and_texts(spark):
    assert _value(spark, lambda p: C.string_list(p, "list")) == ["x", "y"]
    assert _value(spark, lambda p: C.string_list(p, "plain")) == []
    assert _value(spark, lambda p: C.list_or_text(p, "list")) == "x, y"
    assert _value(spark, lambda p: C.list_or_text(p, "plain")) == "b"
    assert _value(spark, lambda p: C.list_or_text(p, "missing")) == ""


def test_has_key_counts_null_values(spark):
    assert _value(spark, lambda p: C.has_key(p, "null")) is True
    assert _value(spark, lambda p: C.has_key(p, "missing")) is False


def test_values_except_and_pick(spark):
    rest = [k for k in CONTENT if k not in ("int", "null")]
    scores = _value(spark, lambda p: C.values_except(p, rest))
    assert scores == {"int": "3", "null": ""}
    picked = _value(spark, lambda p: C.pick(C.values_except(p, rest), ["gone", "int"]))
    assert picked == {"gone": "", "int": "3"}


def test_broken_content_is_empty(spark):
    df = spark.createDataFrame([("bad{",), (None,), ("[1]",), ("{}",)], "content string")
    p = F.col("p")
    rows = df.select(C.parse(F.col("content")).alias("p")).select(
        C.content_value(p, "a", "-"), C.truthy(p, "a"), C.has_key(p, "a"), C.any_truthy(p, ["a", "b"]))
    assert [tuple(r) for r in rows.collect()] == [("-", False, False, False)] * 4


def test_entries_are_made_on_demand(spark):
    """A step that asks only for keys makes no text of a value; asked for, the entry is that of the whole map."""
    keys = [*CONTENT, "missing"]
    whole, asked = _value(spark, lambda p: F.struct(C.entries(p), F.array(*[C.entry(p, k) for k in keys])))
    assert dict(zip(keys, asked)) == whole | {"missing": None}
    df = spark.createDataFrame([("{}",)], "content string").select(C.has_key(C.parse(F.col("content")), "a"))
    assert "schemaofvariant" not in df._jdf.queryExecution().toString().lower()


def test_shown_values_are_the_content_values(spark):
    """Several values in one pass, equal to those read one by one."""
    keys = [*CONTENT, "missing"]
    one = _value(spark, lambda p: F.array(*[C.content_value(p, k) for k in keys]))
    lists = _value(spark, lambda p: F.array(*[C.shown_list(C.shown_values(p, keys), k) for k in keys]))
    assert _value(spark, lambda p: F.array(*[C.shown_text(C.shown_values(p, keys), k) for k in keys])) == one
    assert {k: x for k, x in zip(keys, lists) if x is not None} == {"list": ["x", "y"], "empty_list": []}


def test_blocks_look_only_at_keys_that_are_there(spark):
    labels = {"plain": "P:", "missing": "M:", "zero": "Z:", "wrapped": "W:", "null": "N:", "int": "I:"}
    assert _value(spark, lambda p: C.truthy_blocks(p, labels, "|")) == "P:b|W:a|I:3"
    df = spark.createDataFrame([("bad{",)], "content string").select(C.parse(F.col("content")).alias("p"))
    found = df.select(C.truthy_blocks(F.col("p"), labels, "|"), C.any_truthy(F.col("p"), []))
    assert tuple(found.first()) == ("", False)
    assert "array_intersect" in found._jdf.queryExecution().toString()
