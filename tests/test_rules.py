"""Edge rows for every rule (C1-C20, X1, X2): one small frame per rule, one job each."""

import datetime as dt
from decimal import Decimal

from tidystar.functions import privacy as P
from tidystar.functions import rules as R


def col_values(spark, values, expr, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    rows = df.select("i", expr.alias("out")).orderBy("i").collect()
    return [r.out for r in rows]


def test_clean_text(spark):
    assert col_values(spark, ['"  josé "', None], R.clean_text("v")) == ["JOSÉ", None]
    assert col_values(spark, [' "+57 300" '], R.clean_text("v", upper=False)) == ["+57 300"]


def test_key_int(spark):
    got = col_values(spark, ['"1 2"', "x9", "3000000000", "   "], R.key_int("v"))
    assert got == [12, None, None, None]  # blank key is NULL, not 0 (note N1)


def test_safe_int(spark):
    assert col_values(spark, [" 12 ", "12.5", "+5", '"7"', "", None],
                      R.safe_int("v")) == [12, None, 5, 7, None, None]


def test_safe_decimal(spark):
    got = col_values(spark, ["12.345", "1,234.5", "$5", "1e3", "100000000.00", "-0.5", ".5"],
                     R.safe_decimal("v", 10, 2))
    assert got == [Decimal("12.35"), None, None, None, None, Decimal("-0.50"), Decimal("0.50")]


def test_safe_timestamp(spark):
    got = col_values(spark, ["2023/1/5", "2023-02-30", "01/15/2023", "15/01/2023", "2023",
                             '"2023-01-05 10:11:12"', "20230105", "1700-01-01", None],
                     R.safe_timestamp("v"))
    d = dt.datetime
    assert got == [d(2023, 1, 5), None, d(2023, 1, 15), None, d(2023, 1, 1),
                   d(2023, 1, 5, 10, 11, 12), d(2023, 1, 5), None, None]


def test_null_outside(spark):
    assert col_values(spark, [-1, 0, 120, 121, None], R.null_outside("v", 0, 120),
                      "v int") == [None, 0, 120, None, None]


def test_floor_zero(spark):
    expr = R.floor_zero(R.safe_decimal("v", 10, 2), 0, "decimal(10,2)")
    assert col_values(spark, ["-3", "abc", None, "9.99"], expr) == [
        Decimal("0.00"), Decimal("0.00"), Decimal("0.00"), Decimal("9.99")]


def test_clamp(spark):
    expr = R.clamp(R.safe_decimal("v", 5, 2), 0, 100, "decimal(5,2)")
    got = col_values(spark, ["-5", "100.01", "1000", "abc", "12.5"], expr)
    # 1000 overflows DECIMAL(5,2) -> invalid -> 0, not 100 (note N6)
    assert got == [Decimal("0.00"), Decimal("100.00"), Decimal("0.00"), Decimal("0.00"),
                   Decimal("12.50")]


def test_label_or_default(spark):
    assert col_values(spark, [None, "   ", "null", " oro", '"NULL"'],
                      R.label_or_default("v")) == ["NO DETERMINADO"] * 3 + ["ORO",
                                                                          "NO DETERMINADO"]


def test_match_or_default(spark):
    got = col_values(spark, ["proveedor b", "PROVEEDOR BB", "PROVEEDOR 1", "PROVEEDOR Ñ", None],
                     R.match_or_default("v"))
    assert got == ["PROVEEDOR B"] + ["NO DETERMINADO"] * 4


def test_flag(spark):
    got = col_values(spark, ["1", "true", "Activo", "yes", "0", None], R.flag("v"))
    assert got == ["ACTIVO"] * 4 + ["INACTIVO"] * 2


def test_ratio_if_invalid(spark):
    rows = [(0, "0", "11.99", "2.00"), (1, None, "10", "0"), (2, "2.0", "9", "3"),
            (3, "4", "1", "1"), (4, "-1", "-6", "2")]
    df = spark.createDataFrame(rows, "i int, q string, t string, u string")
    expr = R.ratio_if_invalid(R.safe_int("q"), R.safe_decimal("t"), R.safe_decimal("u"))
    got = [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]
    assert got == [5, None, 3, 4, -3]


def test_null_if_before(spark):
    d = dt.datetime
    rows = [(0, d(2023, 1, 2), d(2023, 1, 1)), (1, d(2023, 1, 1), d(2023, 1, 1)),
            (2, None, d(2023, 1, 1))]
    df = spark.createDataFrame(rows, "i int, o timestamp_ntz, s timestamp_ntz")
    got = [r.out for r in df.select("i", R.null_if_before("s", "o").alias("out"))
           .orderBy("i").collect()]
    assert got == [None, d(2023, 1, 1), d(2023, 1, 1)]


def test_net_amount(spark):
    df = spark.createDataFrame([(0, Decimal("5.00"), Decimal("10.00")),
                                (1, None, Decimal("10.00"))],
                               "i int, t decimal(10,2), d decimal(5,2)")
    out = df.select("i", R.net_amount("t", "d").alias("net")).orderBy("i")
    assert out.schema["net"].dataType.simpleString() == "decimal(25,10)"
    assert [r.net for r in out.collect()] == [Decimal("4.5000000000"), None]


def test_hash_column(spark):
    got = col_values(spark, [" A@B.CO ", None, "   ", "null"], P.hash_column("v"))
    assert got == ["80305c9bb1bb2480e03894350e0a8a366dcbdeb302e69e0817aa0743abd77054",
                   None, "   ", "null"]
    salted = col_values(spark, ["a@b.co"], P.hash_column("v", salt="s1"))
    assert salted[0] != got[0] and len(salted[0]) == 64


def test_mask_column(spark):
    got = col_values(spark, ["1234", "4111111111111234", "7", None, "  ", "null", "1234.0"],
                     P.mask_column("v"))
    assert got == ["****1234", "****1234", "****7", "****0000", "****0000", "****0000",
                   "****34.0"]


def test_python_strip_set(spark):
    # tab, no-break space and ideographic space are stripped like str.strip()
    got = col_values(spark, ["\t\xa0x\u3000"], P.py_strip("v"))
    assert got == ["x"]


def test_rules_are_plain_expressions(spark, capsys):
    """No rule leaves the JVM: the plan holds no Python UDF evaluation."""
    df = spark.createDataFrame([("1",)], "v string")
    out = df.select(R.safe_timestamp("v"), R.key_int("v"), P.hash_column("v"),
                    P.mask_column("v"), R.label_or_default("v"))
    out.explain(True)
    plan = capsys.readouterr().out
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "Project" in plan


def test_safe_timestamp_shapes(spark):
    d = dt.datetime
    got = col_values(spark, ["2023-1-5T8:3:4", "2023-01-05 10:11", "12/31/2023", " 2023-1-5 ",
                             "２０２３-01-05", "2023-001-05", "99999999"], R.safe_timestamp("v"))
    assert got == [d(2023, 1, 5, 8, 3, 4), d(2023, 1, 5, 10, 11), d(2023, 12, 31), d(2023, 1, 5), None, None, None]


def test_safe_timestamp_times_and_names(spark):
    d = dt.datetime
    got = col_values(spark, ["2023-01-05 08:30:00.123", "2023-01-05 08:30:00.124", "2023-01-05T08:30:00.5", "Jan 5 2023",
                             "1-5-23", "1-5-75", "20230105 08:30:00", "01/15/2023 10:30:00", "2023-12-31 23:59:59.999",
                             "2023-01-05T08:30", "2023-01-05 08:30:00.1234", "Janu 5 2023", "2023-01-05 8:30 PM"],
                     R.safe_timestamp("v"))
    assert got == [d(2023, 1, 5, 8, 30, 0, 123000), d(2023, 1, 5, 8, 30, 0, 123000), d(2023, 1, 5, 8, 30, 0, 500000),
                   d(2023, 1, 5), d(2023, 1, 5), d(1975, 1, 5), d(2023, 1, 5, 8, 30), d(2023, 1, 15, 10, 30),
                   d(2024, 1, 1), None, None, None, None]


def test_a_final_line_break_is_not_part_of_a_match(spark):
    values = ["12\n", "9.99\n", "2023-01-05\n", "PROVEEDOR A\n"]
    assert col_values(spark, values, R.safe_int("v")) == [None] * 4
    assert col_values(spark, values, R.key_int("v")) == [None] * 4
    assert col_values(spark, values, R.safe_decimal("v")) == [None] * 4
    assert col_values(spark, values, R.safe_timestamp("v")) == [None] * 4
    assert col_values(spark, values, R.match_or_default("v")) == ["NO DETERMINADO"] * 4


def test_safe_timestamp_first_year(spark):
    first = dt.datetime(1753, 1, 1)
    assert col_values(spark, ["1753", "1752", "1753-01-01", "1752-12-31", "1752-12-31 23:59:59", "0000", "12-31-1752",
                              "1752-12-31 23:59:59.999"], R.safe_timestamp("v")) == [first, None, first, *[None] * 4, first]
