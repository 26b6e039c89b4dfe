import pytest
from pyspark.sql import functions as F

from peerbench.functions import fieldnames as fn
from peerbench.functions import labels, numbers, text


def column(spark, values, expr):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_null_token(spark):
    got = column(spark, ["", " nan ", "None", "NAN", None, " RL.N "], text.null_token)
    assert got == [None, None, None, None, None, "RL.N"]


def test_norm_key_strips_any_whitespace(spark):
    assert column(spark, [" rl.n\t", " RL.N\n"], text.norm_key) == ["RL.N", "RL.N"]


@pytest.mark.parametrize(
    ("given", "want"),
    [("1e5", 1e5), ("1.23E+09", 1.23e9), (" 7 ", 7.0), ("1,234", None), ("12%", None),
     ("1d", None), ("nan", None), ("abc", None), ("Infinity", None), ("1e999", None),
     ("-.5", -0.5), ("5.", 5.0), ("", None), (None, None), ("1_000", None), ("0x10", None)],
)
def test_to_number(spark, given, want):
    assert column(spark, [given], numbers.to_number) == [want]


def test_display_value(spark):
    given = ["0.5", "999.99", "1000", "1234567", "-5000000", "n. a.", None]
    want = ["0.50", "999.99", "1,000", "1,234,567", "-5000000.00", "n. a.", ""]
    assert column(spark, given, numbers.display_value) == want


def test_display_magnitude(spark):
    given = ["0.5", "-0.25", "12", "1234567.891", "text", "1e5", None]
    want = ["0.5000", "-0.2500", "12.00", "1,234,567.89", "text", "1e5", None]
    assert column(spark, given, numbers.display_magnitude) == want


def test_error_text(spark):
    given = ["#N/A", "The record could not be found", "ANNULLED", "Error code: 0", "12", None]
    assert column(spark, given, numbers.is_error_text) == [True, True, True, True, False, False]


def test_code_like(spark):
    given = ["RL.N", "usd", "ABCDEFG", "RL.NYSE", "12", "own id 1", None]
    got = column(spark, given, lambda c: numbers.is_code_like(c, F.lit("Own ID 1")))
    assert got == [True, True, False, False, False, True, False]


def test_field_names(spark):
    given = ["TR.EBIT(Period=FY-1)", "EBIT", "TR.TR.X", "a TR.b"]
    assert column(spark, given, fn.strip_prefix) == ["EBIT(Period=FY-1)", "EBIT", "X", "a TR.b"]
    assert column(spark, given, fn.add_prefix)[1] == "TR.EBIT"
    assert column(spark, given, fn.field_period) == ["FY-1", None, None, None]
    assert column(spark, given, fn.field_base)[0] == "EBIT"
    assert column(spark, ["A(Period=FY0)", "A(Period=FY-3)", "A", "A(Period=Q1)"], fn.years_back) == [
        0, 3, 0, None]
    assert fn.field_keys(["TR.A", " A ", "", "B"]) == ["A", "B"]


def test_flag(spark):
    got = column(spark, ["X", " x ", "Y", "1", "true", "", None], labels.flag_set)
    assert got == [True, True, False, False, False, False, False]


def test_sector_of_file(spark):
    given = ["Consumer_A.xlsx", "Basic_Consumer.xlsx", "Healthy.xlsx", "IT.xlsx", "it.xlsx",
             "Housing_IT.xlsx", "Banks.xlsx", "Basic.xlsx"]
    assert column(spark, given, labels.sector_of_file) == [
        "Consumer Discretionary", "Consumer Staples", "Health Care", "Information Technology",
        None, "Information Technology", "Financials", None]


def test_entity_name(spark):
    rows = [("Hermes", "U", "1"), ("ab", "Universe", "2"), ("nan", None, "3"), (None, "xy", "4")]
    df = spark.createDataFrame(rows, "h string, u string, i string")
    got = df.select(labels.entity_name(F.col("h"), F.col("u"), F.col("i"))).collect()
    assert [r[0] for r in got] == ["Hermes", "Universe", "Company_3", "Company_4"]
