"""Scalar-function edge cases (FIXTURES.md part C)."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import dates as D
from tessera.functions import strings as S
from tessera.functions import values as V


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_fiscal_session_boundaries(spark):
    rows = [(dt.date(2020, 3, 31),), (dt.date(2020, 4, 1),), (None,)]
    assert one(spark, rows, "d date", D.fiscal_session("d")) == ["2019-2020", "2020-2021", None]
    assert one(spark, [(3, 2020), (4, 2020)], "m int, y int", D.fiscal_session_my("m", "y")) == \
        ["2019-2020", "2020-2021"]


def test_serial_month_and_labels(spark):
    assert one(spark, [(1, 1990)], "m int, y int", D.serial_month("m", "y")) == [11]
    assert one(spark, [(dt.date(1998, 1, 5),)], "d date", D.month_label("d")) == ["JAN-1998"]
    assert one(spark, [("JAN-1998",)], "s string", D.parse_month_label("s")) == [dt.date(1998, 1, 1)]
    assert one(spark, [("JAN-98",), ("FEB-49",)], "s string", D.expand_year("s", pivot=50)) == \
        ["JAN-1998", "FEB-2049"]


def test_dash_digits_responsibility(spark):
    assert one(spark, [("ABCDE-FG",), ("AB-CDEFG",), (None,)], "s string", S.remove_dash("s")) == \
        ["ABCDEFG", "AB-CDEFG", None]
    assert one(spark, [("ab12c3",), ("none",), (None,)], "s string", S.digits("s")) == [123, 0, 0]
    got = one(spark, [(" EN dept",), ("qa",), ("Quality",), (None,), ("yo",)], "s string",
              S.responsibility("s"))
    assert got == ["DESIGN", "VENDOR", "PRODUCTION", "PRODUCTION", "DESIGN"]


def test_engine_type(spark):
    rows = [("K12", "swift K12M petrol"), (None, "no match"), ("K12", "swift petrol"), ("QQQ", "x")]
    got = one(spark, rows, "p string, t string", S.engine_type("p", "t"))
    assert got == ["K12M", "XXX", "K12M", None]


def test_trim_escaped_matches_rule(spark):
    texts = ["plain ascii text that is long enough", "café au lait et crème brûlée",
             "tab\there and\nnewline", "emoji 😀 word after", "abc", None, "a\\b" * 20]
    for n in (5, 10, 17, 30):
        got = one(spark, [(t,) for t in texts], "t string", S.trim_escaped("t", n))
        assert got == [S.trim_escaped_py(t, n) for t in texts]


def test_clean_text(spark):
    t = "<b>Hello</b> @dealer the BRAKE_noise https://x.y/z #recall ok, brake brake"
    got = one(spark, [(t,)], "t string", S.clean_text("t"))[0]
    assert got == "hello dealer brake noise recall brake"


def test_values(spark):
    assert one(spark, [("2",), ("7",), ("x",), (None,)], "s string", V.norm_sentiment("s")) == [2, 0, 0, 0]
    assert one(spark, [(None, 2.0)], "a double, b double", V.sum_measures("a", "b")) == [2.0]
    assert one(spark, [("  ",), ("x",)], "s string", V.blank_to_null("s")) == [None, "x"]
