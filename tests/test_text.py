"""Edge cases of the string operations."""

import pytest
from pyspark.errors import AnalysisException

from tillhouse.functions.text import apply_string_op


def run(spark, values, operation, dest="out", source="s", **params):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    config = {"stringop.operation": operation, "stringop.source.column": source, "stringop.dest.column": dest}
    config |= {f"stringop.param.{k}": v for k, v in params.items()}
    result = apply_string_op(df, config)
    return result, [r[dest] for r in result.collect()] if dest in result.columns else None


CASES = [
    ("trim", {}, [" a b ", "\ta ", "", None], ["a b", "\ta", "", None]),
    ("LTRIM", {}, [" a ", "\n a"], ["a ", "\n a"]),
    ("rTrim", {}, [" a ", "a \t"], [" a", "a \t"]),
    ("left", {"length": "3"}, ["abcdef", "ab", "", None], ["abc", "ab", "", None]),
    ("left", {"length": "0"}, ["abc"], [""]),
    ("left", {"length": "-2"}, ["abc"], [""]),
    ("left", {}, ["abc"], [""]),
    ("right", {"length": "3"}, ["abcdef", "ab", "", None], ["def", "ab", "", None]),
    ("right", {"length": "0"}, ["abc"], [""]),
    ("substring", {"start": "1", "length": "2"}, ["abcdef", "a"], ["bc", ""]),
    ("substring", {"start": "-3", "length": "2"}, ["abcdef"], ["ef"]),
    ("toUpper", {}, ["abÄß"], ["ABÄSS"]),
    ("upper", {}, ["x"], ["X"]),
    ("toLower", {}, ["ABÄ"], ["abä"]),
    ("lower", {}, ["X"], ["x"]),
    ("replace", {"target": "a.c", "replacement": "-"}, ["a.c abc"], ["- abc"]),
    ("replace", {"target": ".", "replacement": "[$0]"}, ["a.b"], ["a[.]b"]),
    ("replace", {"target": "", "replacement": "-"}, ["ab"], ["-a-b-"]),
    ("replace", {"target": "\\E(", "replacement": "x"}, ["1\\E(2"], ["1x2"]),
    ("regexReplace", {"regex": r"(\d)(\d)", "replacement": "$2$1"}, ["12 34 5"], ["21 43 5"]),
    ("padLeft", {"totalLength": "5"}, ["ab", "abcdefg", None], ["   ab", "abcde", None]),
    ("padLeft", {"totalLength": "6", "padChar": "xyz"}, ["ab"], ["xyzxab"]),
    ("padRight", {"totalLength": "5", "padChar": "0"}, ["ab", "abcdefg"], ["ab000", "abcde"]),
]


@pytest.mark.parametrize("operation,params,values,expected", CASES)
def test_operation(spark, operation, params, values, expected):
    assert run(spark, values, operation, **params)[1] == expected


def test_destination_replaces_a_column(spark):
    result, values = run(spark, [" a "], "trim", dest="s")
    assert result.columns == ["s"] and values == ["a"]


@pytest.mark.parametrize("operation,params", [
    ("shout", {}), ("left", {"length": "x"}), ("left", {"length": ""}), ("left", {"length": "99999999999"}),
    ("padLeft", {"totalLength": "2.0"}), ("", {}),
])
def test_unusable_configuration_changes_nothing(spark, operation, params):
    assert run(spark, ["a"], operation, **params)[0].columns == ["s"]


def test_unknown_column_is_an_error(spark):
    with pytest.raises(AnalysisException):
        run(spark, ["a"], "trim", source="missing")


def test_odd_column_name(spark):
    df = spark.createDataFrame([("abc",)], "`a column` string")
    config = {"stringop.operation": "right", "stringop.source.column": "a column",
              "stringop.dest.column": "out", "stringop.param.length": "2"}
    assert apply_string_op(df, config).first()["out"] == "bc"
