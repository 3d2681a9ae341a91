"""Scalar functions against plain Python on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from blocktide.functions import wei
from blocktide.functions.hexnum import (
    hex_to_decimal_string,
    hex_to_timestamp,
    hex_to_uint64,
)
from blocktide.functions.labels import (
    labels_from_json,
    labels_json,
    labels_key,
    set_entry,
)
from blocktide.functions.timebucket import (
    lateness_micros,
    micros,
    native_window,
    time_bucket,
    window_micros,
)


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def test_hex_to_uint64(spark):
    cases = {
        "0x0": 0,
        "0x1": 1,
        "0xff": 255,
        "FF": 255,
        "0x": None,
        "": None,
        "0xzz": None,
        "1z": None,
        "0xffffffffffffffff": 2**64 - 1,
        "0x10000000000000000": None,
        "0x" + "0" * 30 + "a": 10,
    }
    rows = one_column(spark, cases).select("v", hex_to_uint64(F.col("v")).alias("n")).collect()
    assert {r.v: None if r.n is None else int(r.n) for r in rows} == cases


def test_hex_to_decimal_string_any_width(spark):
    rng = random.Random(7)
    numbers = [rng.getrandbits(bits) for bits in range(1, 400, 3)]
    numbers += [2**k + d for k in (60, 63, 64, 123, 124, 125, 128, 255, 256) for d in (-1, 0, 1)]
    cases = {hex(n): str(n) for n in numbers}
    cases |= {"": "0", "0x": "0", "0xzz": None, "0x-ff": "-255", "0xde0b6b3a7640000": str(10**18)}
    rows = one_column(spark, cases).select("v", hex_to_decimal_string(F.col("v")).alias("n"))
    assert {r.v: r.n for r in rows.collect()} == cases


def test_hex_to_timestamp(spark):
    rows = one_column(spark, ["0x64000000", "0xzz", "0xffffffffffffffff"]).select(
        F.unix_seconds(hex_to_timestamp(F.col("v"))).alias("s")
    )
    assert [r.s for r in rows.collect()] == [0x64000000, None, None]


def test_labels(spark):
    df = spark.createDataFrame(
        [({},), ({"type": "block"},), ({"b": "2", "a": "1"},)], "m map<string,string>"
    )
    rows = df.select(
        labels_key(F.col("m")).alias("k"),
        labels_json(F.col("m")).alias("j"),
        labels_from_json(labels_json(F.col("m"))).alias("back"),
    ).collect()
    assert [r.k for r in rows] == ["", "type=block", "a=1,b=2"]
    assert [r.j for r in rows] == ["{}", '{"type":"block"}', '{"a":"1","b":"2"}']
    assert [r.back for r in rows] == [None, {"type": "block"}, {"a": "1", "b": "2"}]


def test_set_entry_overwrites_and_keeps(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"},)], "m map<string,string>")
    row = df.select(
        set_entry(F.col("m"), "a", F.lit("9")).alias("x"),
        set_entry(F.col("m"), "a", F.lit(None).cast("string")).alias("y"),
    ).first()
    assert row.x == {"a": "9", "b": "2"}
    assert row.y == {"a": "1", "b": "2"}


def wei_total(spark, values):
    sums = wei.with_parts(one_column(spark, values), "v").agg(*wei.sum_parts())
    row = wei.with_totals(sums).first()
    return row.wei_exact, row.wei_value


@pytest.mark.parametrize(
    "values",
    [
        ["1000000000000000000", "2000000000000000000", "500000000000000000"],
        ["+5", " 12 ", "1e3", "1.5", "", "not-a-number", None, "-", "+"],
        ["9" * 38, "9" * 38, "1"],
        [str(2**256 - 1)] * 3 + ["7"],
        ["-" + "9" * 60, "1" + "0" * 59, "-3"],
        ["9" * 60, "-" + "9" * 60],
        ["-" + "1" + "0" * 52, "5"],
        ["-" + "1" + "0" * 52],
        ["-" + "1" + "0" * 26],
        ["-7", "2"],
        ["0" * 100 + "12"],
    ],
)
def test_wei_sum_is_exact(spark, values):
    def parse(text):
        body = text[1:] if text and text[0] in "+-" else text
        return int(text) if body and body.isdigit() else 0

    exact = sum(parse(v) for v in values if v is not None)
    assert wei_total(spark, values) == (str(exact), float(exact))


def test_wei_sum_beyond_256_bits(spark):
    exact, double = wei_total(spark, ["1" + "0" * 90, "5"])
    assert exact is None
    assert double == pytest.approx(1e90)


@pytest.mark.parametrize("size", ["1 second", "1 minute", "7 minutes", "1 hour", "1 day", "7 days"])
def test_buckets_count_from_year_one(spark, size):
    step = dt.timedelta(microseconds=micros(size))
    origin = dt.datetime(1, 1, 1)
    moments = [dt.datetime(2024, 2, 29, 13, 37, 11, 250_000), dt.datetime(1969, 12, 31, 23, 59, 59)]
    df = one_column(spark, moments, "timestamp_ntz").select(F.col("v").cast("timestamp").alias("v"))
    rows = df.select(
        F.col("v").cast("timestamp_ntz").alias("v"),
        time_bucket(F.col("v"), size).cast("timestamp_ntz").alias("b"),
        native_window(F.col("v"), size)["start"].cast("timestamp_ntz").alias("w"),
    ).collect()
    for r in rows:
        expected = r.v - (r.v - origin) % step
        assert (r.b, r.w) == (expected, expected)


def test_duration_checks():
    assert micros("1h30m") == 5_400_000_000
    assert micros(30) == 30_000_000
    with pytest.raises(ValueError):
        window_micros(0)
    with pytest.raises(ValueError):
        lateness_micros("-1 second")


def test_a_trailing_newline_is_no_digit(spark):
    row = spark.createDataFrame([("0x12\n", "12\n")], "h string, d string").select(
        hex_to_uint64(F.col("h")).alias("a"), hex_to_decimal_string(F.col("h")).alias("b"), F.col("d").alias("value_wei")
    )
    assert row.first()[:2] == (None, None)
    assert wei.with_parts(row).first().wei_small is None
