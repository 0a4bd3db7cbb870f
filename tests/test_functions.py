from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from coverlens import layouts
from coverlens.functions import labels, numbers, periods, text


def one(spark, value, kind, column):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("raw", "wanted"),
    [("  a b ", "a b"), ("\t\xa0x　\n", "x"), ("\x1cq\x1f", "q"), ("", ""), (None, None)],
)
def test_strip_removes_all_white_space(spark, raw, wanted):
    assert one(spark, raw, "string", text.strip("x")) == wanted


@pytest.mark.parametrize(
    ("raw", "wanted"),
    [("7", "0007"), ("12345", "12345"), ("-5", "-005"), ("+5", "+005"), (" 3 ", "0003"), ("", "0000"), (None, None)],
)
def test_pad_code_never_truncates_and_keeps_the_sign(spark, raw, wanted):
    assert one(spark, raw, "string", text.pad_code("x", 4)) == wanted
    if raw is not None:
        assert raw.strip().zfill(4) == wanted


@pytest.mark.parametrize(("raw", "wanted"), [("RR", "RR"), ("ZZ", "XX"), (None, "XX")])
def test_domain_with_unknown(spark, raw, wanted):
    assert one(spark, raw, "string", text.to_domain("x", layouts.STATE_CODES, "XX")) == wanted


def test_domain_without_unknown_is_null(spark):
    assert one(spark, "ZZ", "string", text.to_domain("x", layouts.STATE_CODES, None)) is None


@pytest.mark.parametrize("raw", text.NULL_TOKENS)
def test_null_tokens(spark, raw):
    assert one(spark, raw, "string", text.tokens_to_null("x")) is None


def test_other_texts_stay(spark):
    assert one(spark, "Nanci", "string", text.tokens_to_null("x")) == "Nanci"


@pytest.mark.parametrize(
    ("raw", "wanted"), [("140010", True), ("1400100", True), ("14001", False), ("14001x", False), (None, False)]
)
def test_full_match(spark, raw, wanted):
    assert one(spark, raw, "string", text.full_match("x", "[0-9]{6,7}")) is wanted


@pytest.mark.parametrize(
    ("raw", "wanted"),
    [("Razao_Social", "razao_social"), ("NM_CODE", "nm_code"), ("Data Registro ABC", "data_registro_abc"),
     ("  aBc ", "a_bc")],
)
def test_snake_name(raw, wanted):
    assert text.snake_name(raw) == wanted


def test_folded_text_ignores_case_and_accents(spark):
    rows = spark.createDataFrame([("São",), ("SAO",), ("sáo",), ("Rio",)], "x string")
    assert rows.groupBy(text.folded("x").alias("k")).count().count() == 2


@pytest.mark.parametrize(
    ("raw", "wanted"),
    [("10", 10), ("10.9", 10), ("-3.7", -3), (" 4 ", 4), ("abc", 0), ("", 0), (None, 0),
     ("9007199254740993", 9007199254740993), ("inf", 0)],
)
def test_safe_long(spark, raw, wanted):
    assert one(spark, raw, "string", numbers.safe_long("x")) == wanted


@pytest.mark.parametrize(("raw", "wanted"), [("2020-01-31", dt.date(2020, 1, 31)), ("31/31/2020", None), (None, None)])
def test_safe_date(spark, raw, wanted):
    assert one(spark, raw, "string", numbers.safe_date("x")) == wanted


def test_ratio_is_null_without_divisor(spark):
    rows = spark.createDataFrame([(7, 2), (7, 0), (7, None)], "n long, d long")
    got = [r[0] for r in rows.select(numbers.guarded_ratio("n", "d")).collect()]
    assert got == [Decimal("3.5"), None, None]


def test_percent_change(spark):
    rows = spark.createDataFrame([(110, 100), (90, 100), (5, 0), (5, None), (600_000, 1)], "c long, p long")
    got = [r[0] for r in rows.select(numbers.percent_change("c", "p")).collect()]
    assert got == [Decimal("10.00"), Decimal("-10.00"), None, None, Decimal("59999900.00")]
    # The narrow type gives null where it does not fit instead of failing the job.
    narrow = rows.select(numbers.percent_change("c", "p", "decimal(6,2)")).collect()
    assert narrow[4][0] is None


def test_percent_rounds_half_away_from_zero(spark):
    rows = spark.createDataFrame([(1, 800), (-1, 800)], "a long, b long")
    got = [r[0] for r in rows.select(numbers.percent_of("a", "b")).collect()]
    assert got == [Decimal("0.13"), Decimal("-0.13")]


def test_periods_round_trip():
    assert periods.parse_period("2024-12") == 202412
    assert periods.format_period(202412) == "2024-12"
    assert periods.format_period(periods.parse_period("2026-01")) == "2026-01"
    with pytest.raises(ValueError):
        periods.parse_period("2024-13")


def test_period_attributes(spark):
    row = periods.period_attributes(spark.createDataFrame([(202412,)], "period_key int")).first()
    assert row["period_date"] == dt.date(2024, 12, 1)
    assert (row["year"], row["month"], row["quarter"], row["half"]) == (2024, 12, 4, 2)
    assert row["period_label"] == "Dezembro/2024"


def test_landing_file_name(spark):
    got = one(spark, "RR", "string", periods.landing_file_name("x", F.lit(202402)))
    assert got == "pda-024-icb-RR-2024_02.zip"


def test_labels(spark):
    assert one(spark, 1234567, "long", labels.integer_label("x")) == "1.234.567"
    assert one(spark, 1234.5, "double", labels.decimal_label("x", 1)) == "1.234,5"
    assert one(spark, 12.34, "double", labels.percent_label("x")) == "12,3%"
    assert one(spark, 202412, "int", labels.month_label("x")) == "dezembro/2024"
    assert one(spark, dt.datetime(2024, 5, 6, 7, 8), "timestamp", labels.moment_label("x")) == "06/05/2024 07:08"
    for kind, label in (
        ("long", labels.integer_label),
        ("double", labels.decimal_label),
        ("double", labels.percent_label),
        ("int", labels.month_label),
        ("timestamp", labels.moment_label),
    ):
        assert one(spark, None, kind, label("x")) == "-"


def test_state_table(spark):
    rows = {r["state"]: r for r in layouts.states(spark).collect()}
    assert len(rows) == 28
    assert rows["RR"]["region"] == "Norte" and rows["DF"]["state_name"] == "Distrito Federal"


def test_content_hash(spark):
    import hashlib

    assert one(spark, "abc", "string", text.content_hash("x")) == hashlib.sha256(b"abc").hexdigest()
