import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bulkflow.functions import names, parse, times
from bulkflow.functions.types import ColumnDef, primary_key, struct_type


def values(spark, cells, parser):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    p = parser(F.col("c"))
    return [(r[0], r[1]) for r in df.orderBy("i").select(p.value, p.error).collect()]


def test_parse_int(spark):
    got = values(spark, ["123", "-5", "+7", "0", "abc", "12.34", "", " 12 ", "1_0", "9223372036854775808"], parse.parse_int)
    assert [v for v, _ in got] == [123, -5, 7, 0, None, None, None, None, None, None]
    assert [e is None for _, e in got] == [True] * 4 + [False] * 6


def test_parse_float(spark):
    good = ["123.45", "-5.5", "0", ".5", "5.", "1e3", "+1E-2", "inf", "-Infinity", "0x1p3", "1_000.5"]
    got = values(spark, good, parse.parse_float)
    assert [v for v, _ in got] == [123.45, -5.5, 0, 0.5, 5, 1000, 0.01, float("inf"), float("-inf"), 8, 1000.5]
    bad = ["abc", "", " 1", "1d", "1f", "1e400", "1__0", "_1", "0x1", "--1", ".", "1e", "1\n"]
    assert all(v is None and e is not None for v, e in values(spark, bad, parse.parse_float))


def test_parse_nullable(spark):
    assert values(spark, ["", "hello"], parse.parse_nullable_string) == [(None, None), ("hello", None)]
    got = values(spark, ["", "123", "abc"], parse.parse_nullable_int)
    assert got[:2] == [(None, None), (123, None)] and got[2][1] is not None


def test_parse_string_keeps_empty(spark):
    assert values(spark, ["", "a"], parse.parse_string) == [("", None), ("a", None)]


def test_parse_number(spark):
    got = values(spark, ["", "42", "4.5", "1e2", "99999999999999999999", "x1"], parse.parse_number)
    assert [v for v, _ in got] == [None, 42, 4.5, 100, 1e20, None]
    assert [e is None for _, e in got] == [True] * 5 + [False]


def test_first_error_names_the_first_field(spark):
    df = spark.createDataFrame([("abc", "x", "1.5"), ("1", "x", "1.5"), ("1", "2", "bad")], "a string, b string, c string")
    fields = [("BadInt", parse.parse_int(F.col("a"))), ("B", parse.parse_nullable_int(F.col("b"))), ("C", parse.parse_float(F.col("c")))]
    gated = parse.gated_value(fields[2][1], [fields[0][1], fields[1][1]])
    got = df.select(parse.first_error(fields), gated).collect()
    assert got[0][0].startswith("BadInt") and got[1][0].startswith("B:") and got[2][0].startswith("C:")
    assert [r[1] for r in got] == [None, None, None]


def test_normalize_identifiers(spark):
    cells = [" first name ", "1abc", "añb-c", "", "   ", "_x", "a" * 40, "ok_1", "日本", "a ", "x😀y"]
    expected = ["FIRST_NAME", "X1ABC", "A_B_C", "", "", "X_X", "A" * 30, "OK_1", "X__", "A", "X_Y"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r[0] for r in df.orderBy("i").select(names.normalize_identifiers(F.col("c"))).collect()]
    assert got == expected
    assert [names.normalize_name(c) for c in cells] == expected


def test_strict_identifiers(spark):
    cells = ["ABC_1", "1abc", "a b", "a" * 31, "a" * 30, None, ""]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, c string")
    got = [r[0] is None for r in df.orderBy("i").select(names.identifier_errors(F.col("c"))).collect()]
    assert got == [True, False, False, False, True, False, False]
    assert names.strict_name("abc") == "ABC"
    for bad in ("1abc", "a" * 31, "a\n"):
        with pytest.raises(ValueError):
            names.strict_name(bad)


def test_column_definitions():
    schema = struct_type(
        [
            ColumnDef("id", "NUMBER", nullable=False, primary_key=True),
            ColumnDef("price", "number", precision=10, scale=2),
            ColumnDef("level", "NUMBER", precision=5),
            ColumnDef("name", "VARCHAR"),
            ColumnDef("code", "VARCHAR2", length=50),
            ColumnDef("at", "DATE"),
            ColumnDef("body", "CLOB"),
        ]
    )
    assert schema.names == ["ID", "PRICE", "LEVEL", "NAME", "CODE", "AT", "BODY"]
    assert [f.dataType.simpleString() for f in schema.fields] == [
        "decimal(38,10)", "decimal(10,2)", "decimal(5,0)", "string", "string", "timestamp_ntz", "string"
    ]
    assert schema["NAME"].metadata["length"] == 255 and schema["CODE"].metadata["length"] == 50
    assert primary_key(schema) == ["ID"] and not schema["ID"].nullable
    for bad in ([], [ColumnDef("a", "JSON")], [ColumnDef("1a", "NUMBER")], [ColumnDef("a", "NUMBER"), ColumnDef("A", "DATE")]):
        with pytest.raises(ValueError):
            struct_type(bad)


def test_times(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-02-29 23:59:59.987654' AS t, timestamp_ntz'1969-12-31 23:59:59.5' AS old")
    t = F.col("t")
    r = df.select(
        times.format_seconds(t),
        times.format_millis(t),
        times.in_zone(t).cast("string"),
        times.whole_second(F.col("old")).cast("string"),
        times.seconds_between(F.col("old"), F.lit("1970-01-01 00:00:01").cast("timestamp_ntz")),
        times.timestamp_or(F.lit("2024-01-02 03:04:05"), t).cast("string"),
        times.timestamp_or(F.lit("not a time"), t).cast("string"),
    ).first()
    assert tuple(r) == (
        "2024-02-29 23:59:59", "2024-02-29 23:59:59.987", "2024-03-01 06:59:59.987654", "1969-12-31 23:59:59",
        1.5, "2024-01-02 03:04:05", "2024-02-29 23:59:59.987654",
    )


def test_time_format_ignores_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist there on that day.
        got = spark.range(1).select(times.parse_by(F.lit("2024-03-10 02:30:00"), times.SECONDS).cast("string")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == "2024-03-10 02:30:00"


def test_types_schema_is_struct():
    assert isinstance(struct_type([ColumnDef("a", "CLOB")]), T.StructType)
