import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from graphloom.functions import constructors as C
from graphloom.functions import typed as V


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(columns))).first())


def test_integer_widths_at_their_bounds(spark):
    for kind, (least, most, _) in V.INTEGERS.items():
        got = one(spark, *(V.integer(F.lit(str(x)), kind).cast("string") for x in (least, most, least - 1, most + 1)))
        assert got == (str(least), str(most), None, None), kind
    assert one(spark, V.integer(F.lit("1.5"), "int64"), V.integer(F.lit("x"), "int8")) == (None, None)


def test_int128(spark):
    for n in (0, 1, -1, 2**64, -(2**127), 2**127 - 1):
        high, low = n >> 64, n & (2**64 - 1)
        assert one(spark, V.int128(F.lit(high).cast("long"), F.lit(str(low)))) == (str(n),)
        assert one(spark, V.int128_text(F.lit(str(n)))) == (str(n),)
    assert one(spark, V.int128_text(F.lit(str(2**127))), V.int128_text(F.lit("-0")), V.int128_text(F.lit("007"))) == (None, "0", "7")


@pytest.mark.parametrize(
    ("text", "precision", "scale", "expected"),
    [
        ("12345.6789", 18, 4, "12345.6789"),
        ("12345678901234567890123456789012345678", 38, 0, "12345678901234567890123456789012345678"),
        ("9" * 38, 38, 0, "9" * 38),
        ("-" + "9" * 38, 38, 0, "-" + "9" * 38),
        ("-123.45", 10, 2, "-123.45"),
        ("123", 18, 4, "123.0000"),
        ("123.456", 18, 2, "123.46"),
        ("1.005", 18, 2, "1.01"),
        ("-1.005", 18, 2, "-1.01"),
        ("1.015", 18, 2, "1.02"),
        ("1.025", 18, 2, "1.03"),
        ("2.675", 18, 2, "2.68"),
        ("12345.67", 5, 2, None),
        ("1" * 39, 38, 0, None),
    ],
)
def test_decimals(spark, text, precision, scale, expected):
    assert one(spark, V.decimal(F.lit(text), precision, scale).cast("string")) == (expected,)


def test_decimal_literals_pass_a_double(spark):
    got = one(spark, *(V.decimal_literal(F.lit(x), 18, 2) for x in (1.005, 1.015, 1.025, 2.675)))
    assert got == tuple(map(Decimal, ("1.00", "1.01", "1.02", "2.68")))


def test_decimal_size_and_narrow(spark):
    for text, size in (("100", (3, 0)), ("1.2300", (5, 4)), ("0.05", (2, 2)), ("0", (1, 0)), ("9" * 38, (38, 0)), ("9" * 39, None), ("x", None)):
        got = one(spark, V.decimal_size(F.lit(text)))[0]
        assert (tuple(got) if got else None) == size, text
    big = F.lit("79228162514264337593543950335").cast("decimal(38,0)")
    assert one(spark, V.narrow_decimal(big).isNotNull(), V.narrow_decimal(big + 1).isNull()) == (True, True)


def test_temporal(spark):
    us = 1785242096789000  # 2026-07-28 12:34:56.789
    t = [V.instant(F.lit(us // 1_000_000), "s"), V.instant(F.lit(us // 1000), "ms"), V.instant(F.lit(us), "us"), V.instant(F.lit(us * 1000 + 123), "ns")]
    assert one(spark, *(F.unix_micros(x) for x in t)) == (us // 1_000_000 * 1_000_000, us, us, us)
    assert one(spark, F.unix_micros(V.instant(F.lit(-1500), "ns"))) == (-1,)
    assert one(spark, V.instant(F.lit(10**12), "s"), V.day(F.lit(V.DAYS[1] + 1)), V.day(F.lit(V.DAYS[0] - 1))) == (None, None, None)
    assert one(spark, V.day(F.lit(0))) == (datetime.date(1970, 1, 1),)
    assert one(spark, C.date(F.lit("2026-07-29"))) == (datetime.date(2026, 7, 29),)


def test_intervals_of_odd_texts(spark):
    import re

    units = {"year": (0, 12), "month": (0, 1), "week": (1, 7), "day": (1, 1), "hour": (2, 3_600_000_000), "minute": (2, 60_000_000), "second": (2, 1_000_000), "millisecond": (2, 1_000), "microsecond": (2, 1)}
    texts = ["3 days 5 day", "5-3 DAYS-2hours", "2years3days", "1 dayhour 4\nWeeks", "1 second 2 milliseconds 3 microseconds 4 minutes", "--7 month", "7 wee\u212as 1 day", "12 34 days", "days 3", "", None, "1 Year 2 MONTHS 3 years"]
    want = []
    for t in texts:
        found = {u: re.search(rf"(-?[0-9]+)\s*{u}s?\b", t or "", re.I | re.A) for u in units}
        sums = [sum(int(m[1]) * units[u][1] for u, m in found.items() if m and units[u][0] == k) for k in range(3)]
        want.append(tuple(sums) if any(found.values()) else None)
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", C.interval(F.col("t")).alias("i")).orderBy("k")
    assert [r["i"] and tuple(r["i"]) for r in df.collect()] == want
    # two searches a text, whatever the units
    plan = spark.createDataFrame([("1 day",)], "t string").select(C.interval(F.col("t")).alias("i"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") + plan.count("RLIKE") == 2


def test_intervals(spark):
    i = C.interval(F.lit("3 days"))
    assert one(spark, V.interval_seconds(i["months"], i["days"], i["micros"])) == (259200.0,)
    far = C.interval(F.lit("100000000 months"))
    assert one(spark, V.interval_seconds(far["months"], far["days"], far["micros"])) == (None,)
    back = V.interval_of(F.lit(123456))
    assert one(spark, V.interval_seconds(back["months"], back["days"], back["micros"])) == (123456.0,)
    assert one(spark, C.interval(F.lit("soon"))) == (None,)


def test_uuid_blob_escape(spark):
    u = "3fa85f64-5717-4562-b3fc-2c963f66afa6"
    assert one(spark, V.uuid(F.lit(u.upper())), V.uuid(F.lit(u.replace("-", ""))), V.uuid(F.lit("{" + u + "}")), V.uuid(F.lit(u[:-1]))) == (u, u, u, None)
    assert bytes(one(spark, C.blob(F.lit("\\xDE\\xAD\\xBE\\xEF")))[0]) == b"\xde\xad\xbe\xef"
    assert one(spark, C.escaped(F.lit("a\\b'c"))) == ("a\\\\b\\'c",)


def test_unions(spark):
    members = [("num", "bigint"), ("txt", "string")]
    v = [V.union_of(F.lit(x), members) for x in ("42", "hello")] + [V.union_value("txt", F.lit("42"), members)]
    rows = one(spark, *v)
    assert [(r["tag"], r["num"], r["txt"]) for r in rows] == [("num", 42, None), ("txt", None, "hello"), ("txt", None, "42")]
    assert one(spark, V.union_of(F.lit("true"), [("flag", "boolean"), ("txt", "string")])["flag"]) == (True,)
    with pytest.raises(ValueError):
        V.union_value("none", F.lit(1), members)


def test_strict_and_quarantine(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "t string")
    good, bad = V.quarantine(df, "t", "n", V.integer(F.col("t"), "int8"), "not an int8")
    assert good.count() == 2 and [tuple(r) for r in bad.collect()] == [("x", "not an int8")]
    with pytest.raises(Exception, match="not an int8: x"):
        df.select(V.strict(F.col("t"), V.integer(F.col("t"), "int8"), "not an int8")).collect()
    with pytest.raises(TypeError):
        V.require_type(df, "t", "bigint")
    deep = F.lit(1)
    for _ in range(65):
        deep = F.array(deep)
    with pytest.raises(ValueError):
        V.require_depth(spark.range(1).select(deep.alias("d")))


def test_maps(spark):
    df = spark.createDataFrame([(1, {"k1": "v1", "k2": "v2"})], "id long, m map<string,string>")
    rows = C.map_to_rows(df, "id", "m")
    assert rows.count() == 2 and C.rows_to_map(rows, "id", "name", "value", "m").first()["m"] == {"k1": "v1", "k2": "v2"}
    coded, names = C.reencoded(spark.createDataFrame([("42/DESC",), ("7/NAME",), ("7/DESC",)], "akey string"), "akey")
    assert sorted((r["owner"], r["name_id"]) for r in coded.collect()) == [(7, 0), (7, 1), (42, 0)] and names.count() == 2
