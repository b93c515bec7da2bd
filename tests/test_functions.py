"""Scalar expressions on literal rows, with nulls and edges."""

import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from tidemart.functions import jsonio, keys, text, times


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def lit(v, kind="string"):
    return F.lit(v).cast(kind)


def test_times(spark):
    ms = lit(1_734_821_068_999, "bigint")
    assert one(spark, times.event_time(ms)) == (datetime(2024, 12, 21, 22, 44, 28),)
    assert one(spark, times.date_id(ms)) == (1_734_739_200,)
    assert one(spark, times.millis_text(ms), times.previous_day(ms)) == ("2024-12-21 22:44:28", "2024-12-20")
    assert one(spark, times.to_millis(lit(9_999_999_999, "bigint"))) == (9_999_999_999_000,)
    assert one(spark, times.to_millis(lit(10_000_000_000, "bigint"))) == (10_000_000_000,)
    assert one(spark, times.event_time(lit(None, "bigint"))) == (None,)


def test_day_range(spark):
    day = lambda d: F.lit(d)
    assert one(spark, times.day_range(day(date(2023, 12, 31)), day(date(2024, 1, 2)))) == (
        [20231231, 20240101, 20240102],)
    assert one(spark, times.day_range(day(date(2024, 1, 2)), day(date(2024, 1, 1)))) == ([],)
    assert one(spark, times.day_range(lit(None, "date"), day(date(2024, 1, 1)))) == (None,)


def test_last_token(spark):
    cases = {"a,b,,": "b", "a": "a", "": "", ",": "", ",,x": "x", "a, b": " b"}
    for given, expected in cases.items():
        assert one(spark, text.last_token(lit(given))) == (expected,), given
    assert one(spark, text.last_token(lit(None))) == (None,)


def test_text(spark):
    assert one(spark, text.capitalise(lit("abc")), text.uncapitalise(lit("ABC")), text.capitalise(lit(""))) == (
        "Abc", "aBC", "")
    assert one(spark, text.zeros(3), text.repeat("x", 0)) == ("000", "")
    assert one(spark, text.is_blank(lit(" \t\n")), text.is_blank(lit("　")), text.is_empty(lit(" "))) == (
        True, False, False)
    assert one(spark, text.is_blank(lit(None)), text.is_empty(lit(None))) == (True, True)
    assert one(spark, text.to_csv(F.array(lit("a"), lit("b"))), text.join_list(lit(None, "array<string>"), "-")) == (
        "a, b", None)


def test_allowed_characters(spark):
    good, bad = ["中文abc123", "[x]-_+{}", "“hi<>", "a!b?", "（ok）"], ["a b", "", "a,b", "a\n", "ab\n", "é"]
    for value in good:
        assert one(spark, text.only_allowed_characters(lit(value))) == (True,), value
    for value in bad:
        assert one(spark, text.only_allowed_characters(lit(value))) == (False,), value


def test_keys(spark):
    assert one(spark, keys.salt_bucket(lit("abc"))) == ("0114",)
    hot = "0xDAC17F958D2EE523A2206206994597C13D831EC7"
    assert one(spark, keys.salt_bucket(lit(hot), hot=keys.HOT_BUCKETS)) == ("9002",)
    assert one(spark, keys.salt_bucket(lit("abc"), hot=keys.HOT_BUCKETS)) == ("0114",)
    frame = spark.createDataFrame([("a", "b")], "x string, y string")
    got = frame.select(keys.rowkey(["x", "y"], "_"), keys.rowkey(["x", "y"], "_", ["y"]),
                       keys.rowkey(["x", "y"], "_", hash_all=True)).first()
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert tuple(got) == ("a_b", f"a_{md5('b')}", md5("a_b"))


def test_json(spark):
    assert one(spark, jsonio.json_ts(lit('{"t": 5}'), "t"), jsonio.json_ts(lit('{"t": "x"}'), "t"),
               jsonio.json_ts(lit("{bad"), "t"), jsonio.json_ts(lit(None), "t")) == (5, 0, 0, 0)
    assert one(spark, jsonio.first_seconds(lit('{"timestamp": 7}'), "block_timestamp", "timestamp")) == (7000,)
    both = '{"timestamp": 7, "block_timestamp": 8}'
    assert one(spark, jsonio.first_seconds(lit(both), "block_timestamp", "timestamp")) == (8000,)
    items = F.array(lit('{"window_start_time": 3}'), lit('{"window_start_time": 9}'))
    assert one(spark, jsonio.first_element_ts(items), jsonio.first_element_ts(F.array().cast("array<string>"))) == (
        3, None)
    assert one(spark, jsonio.append_to_list(lit('["a"]'), lit("b")), jsonio.append_to_list(lit(None), lit("b"))) == (
        '["a","b"]', '["b"]')
    assert one(spark, jsonio.row_json([lit(None).alias("a"), F.lit(1).alias("b")])) == ('{"a":null,"b":1}',)


def test_numbers(spark):
    assert one(spark, jsonio.amount(lit("12.345")).cast("string"), jsonio.amount(lit("x"))) == ("12.35", None)
    ratio = lambda n, d: jsonio.safe_ratio(lit(n, "double"), lit(d, "double"))
    assert one(spark, ratio(1, 4), ratio(1, 0), ratio(1, None)) == (0.25, 0.0, 0.0)
