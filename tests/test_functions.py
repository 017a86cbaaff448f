"""Column functions against the standard library."""

import base64
import hashlib
import uuid
from decimal import Decimal

from pyspark.sql import functions as F

from rivermark import functions as fn
from rivermark.functions.decode import clock
from rivermark.functions.ids import FILE_NAMESPACE


def values(spark, column, items, kind="string"):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[1] for r in rows.select("i", column.alias("y")).orderBy("i").collect()]


def packed(number: int, size: int) -> str:
    return base64.b64encode(number.to_bytes(size, "big", signed=True)).decode()


def test_ids(spark):
    df = spark.createDataFrame([("t", 1, 5)], "t string, p int, o bigint")
    got = df.select(fn.event_id("t", "p", "o")).first()[0]
    assert got == hashlib.sha256(b"t:1:5").hexdigest()
    names = ["a", "banking:VCB:abc", "é"]
    got = values(spark, fn.uuid5(FILE_NAMESPACE, F.col("x")), names)
    assert got == [str(uuid.uuid5(FILE_NAMESPACE, n)) for n in names]


def test_money(spark):
    cases = {
        "123.45": "123.45",
        " 12 ": "12.00",
        "1E2": "100.00",
        ".5": "0.50",
        "2.345": "2.34",
        "2.355": "2.36",
        "-0.005": "0.00",
        packed(12345, 2): "123.45",
        packed(-12345, 2): "-123.45",
        packed(-12345, 8): "-123.45",
        packed(12345, 12): "123.45",
        packed(-1, 10): "-0.01",
        packed(10**18, 8): None,
        "not-decimal": None,
        "": None,
        "NaN": None,
        "Infinity": None,
        "1_000": None,
        "12345678901234567": None,
        "9999999999999999.99": "9999999999999999.99",
        "1234": "1234.00",
    }
    got = values(spark, fn.money(F.col("x")), list(cases))
    assert got == [None if v is None else Decimal(v) for v in cases.values()]
    assert values(spark, fn.money(F.col("x"), encoding="base64"), ["1234"]) == [
        Decimal(int.from_bytes(base64.b64decode("1234"), "big", signed=True)) / 100
    ]


def test_clock(spark):
    cases = {
        "1753185600000000": "2025-07-22 12:00:00",
        "1753185600000": "2025-07-22 12:00:00",
        '"2025-07-22T12:00:00Z"': "2025-07-22 12:00:00",
        '"2025-07-22T19:00:00.250+07:00"': "2025-07-22 12:00:00.25",
        '"2025-07-22T12:00:00"': None,
        '"1753185600000"': None,
        '"soon"': None,
        "true": None,
        "99999999999999999999": None,
    }
    token, text = F.col("x"), F.replace("x", F.lit('"'), F.lit(""))
    got = values(spark, clock(text, token).cast("string"), list(cases))
    assert got == list(cases.values())


def test_json(spark):
    cases = {
        '{"b":1,"a":{"z":null,"k":12.50}}': '{"a":{"k":"12.50","z":null},"b":1}',
        '{"a":"1.5 and 2.5","b":[1.0,-2.50e1]}': '{"a":"1.5 and 2.5","b":["1.0","-2.50e1"]}',
        '{"a":1,"a":2}': '{"a":2}',
        '{"t":"q\\"1.5"}': '{"t":"q\\"1.5"}',
    }
    assert values(spark, fn.canonical(F.col("x")), list(cases)) == list(cases.values())
    texts = ['{"a":1}', "[1", '{"a":1} x', "1,2", "", "5", '{"a":1}} {', "null", "1] [2"]
    strict = values(spark, fn.parse_strict(F.col("x")).isNotNull(), texts)
    whole = values(spark, fn.read_fields(F.col("x"), "a: INT")["e"].isNotNull(), texts)
    assert strict == whole == [True, False, False, False, False, True, False, True, False]


def test_long_strings_do_not_overflow_the_pattern(spark):
    text = '{"a":"' + 'x\\"' * 200_000 + '","b":1.50}'
    assert values(spark, F.length(fn.quote_decimals(F.col("x"))), [text]) == [len(text) + 2]


def test_names_and_metadata(spark):
    names = ["Ann Lee", "Ann", "  Ann van  Lee ", "", None]
    assert values(spark, fn.first_name(F.col("x")), names) == ["Ann", "Ann", "Ann", None, None]
    assert values(spark, fn.last_name(F.col("x")), names) == ["Lee", None, "van  Lee", None, None]
    df = spark.createDataFrame(
        [({"Partner-ID": " A\nB ", "secret": "x", "topic": None, "record_count": "1" * 2000},)],
        "m map<string,string>",
    )
    got = df.select(fn.safe_metadata(F.col("m"))).first()[0]
    assert got == {"partner_id": "A B", "record_count": "1" * 1024}


def test_clean_strips_unicode_white_space(spark):
    row = spark.createDataFrame([("\u00a0\u2003 x\u00a0y \u3000", "\u00a0")], "a string, b string")
    assert tuple(row.select(fn.clean(F.col("a")), fn.clean(F.col("b"))).first()) == ("x\u00a0y", "")
