"""Silver rules on hand-made rows."""
import datetime as dt
import math

from pyspark.sql import Row

from loanflow.functions.cleaning import blank_to_null, cast_numeric, parse_month_date, parse_percent
from loanflow.plans.silver import bronze_to_silver
from loanflow.schema import BRONZE_COLUMNS, LOAN_COLUMNS, SILVER_COLUMNS
from loanflow.sources.messages import with_backfill_metadata


def raw_rows(spark, rows):
    """Raw all-string frame: every loan column, given values set, the rest NULL."""
    full = [{c: r.get(c) for c in LOAN_COLUMNS} for r in rows]
    return spark.createDataFrame([Row(**r) for r in full], ", ".join(f"`{c}` string" for c in LOAN_COLUMNS))


def test_blank_to_null_spaces_only_not_tabs_and_no_trim(spark):
    df = spark.createDataFrame([("",), (" ",), ("   ",), ("\t",), (" 36 months",), (None,)], "x string")
    got = [r.x for r in blank_to_null(df).collect()]
    assert got == [None, None, None, "\t", " 36 months", None]


def test_blank_to_null_leaves_other_types(spark):
    df = spark.createDataFrame([(1, " ")], "n int, s string")
    r = blank_to_null(df).first()
    assert r.n == 1 and r.s is None
    assert dict(blank_to_null(df).dtypes) == {"n": "int", "s": "string"}


def test_parse_percent_and_malformed(spark):
    df = spark.createDataFrame([("13.99%",), ("5%%",), ("n/a",), (None,), ("7",)], "int_rate string")
    got = [r.int_rate for r in parse_percent(df).collect()]
    assert got == [13.99, 5.0, None, None, 7.0]


def test_cast_numeric_tolerant(spark):
    df = spark.createDataFrame([("1.5",), ("abc",), ("NaN",), (" 3 ",), (None,)], "loan_amnt string")
    got = [r.loan_amnt for r in cast_numeric(df).collect()]
    assert got[0] == 1.5 and got[1] is None and math.isnan(got[2]) and got[3] == 3.0 and got[4] is None


def test_parse_month_date(spark):
    df = spark.createDataFrame([("Dec-2015",), ("bad-date",), ("2015-12",), (None,)], "issue_d string")
    got = [r.issue_d for r in parse_month_date(df).collect()]
    assert got == [dt.date(2015, 12, 1), None, None, None]


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([("x",)], "other string")
    assert parse_percent(cast_numeric(parse_month_date(df))).columns == ["other"]


def test_derived_columns_rules(spark):
    rows = [
        {"loan_amnt": "1000", "annual_inc": "0", "grade": "D", "loan_status": "Does not meet the credit policy. Status:Charged Off",
         "fico_range_low": "700", "fico_range_high": "704"},
        {"loan_amnt": "1000", "annual_inc": "-5", "grade": None, "loan_status": "Default"},
        {"loan_amnt": "1000", "annual_inc": "4000", "grade": "A", "loan_status": None},
        {"loan_amnt": "1000", "annual_inc": " ", "grade": "G", "loan_status": "Charged Off"},
    ]
    out = bronze_to_silver(with_backfill_metadata(raw_rows(spark, rows))).collect()
    assert [r.loan_to_income_ratio for r in out] == [None, None, 0.25, None]
    assert [r.is_high_risk for r in out] == [True, False, False, True]
    assert [r.is_charged_off for r in out] == [True, False, False, True]
    assert out[0].fico_avg == 702.0 and out[1].fico_avg is None


def test_silver_layout(spark):
    df = bronze_to_silver(with_backfill_metadata(raw_rows(spark, [{"id": "1"}])))
    assert df.columns == SILVER_COLUMNS and len(df.columns) == 161
    types = dict(df.dtypes)
    assert types["int_rate"] == "double" and types["issue_d"] == "date" and types["term"] == "string"
    assert types["kafka_partition"] == "int" and types["kafka_offset"] == "bigint"
    assert len(BRONZE_COLUMNS) == 156


def test_unreadable_text_is_kept_from_the_casts(spark):
    """Blank text, commas and dates without a month's letter never reach a cast; all other text is read as the cast reads it."""
    from loanflow.functions import cleaning

    odd = ["", "  ", " 12 ", "\t12\n", "1,5", "+1", "--1", "1e5", "1F", "0x1p3", "NaN", " nan", "inf", "-INFINITY", "İnf", "n/a", "%%",
           "5 %", "１２", "\x0012", ".5", "5.", "1 2", None, "Unknown", "Dec-2015", "dec-2015", "13-2015", "Jan-15", " Jan-2015",
           "Jan-12015", "bad-date"]
    df = spark.createDataFrame([(x,) for x in odd], "x string")
    differ = df.selectExpr("x", "try_cast(x AS DOUBLE) n", f"{cleaning._number('x')} gn", "try_cast(replace(x, '%', '') AS DOUBLE) p",
                           f"{cleaning._percent('x')} gp", "try_to_date(x, 'MMM-yyyy') d", f"{cleaning._FORMS['issue_d']('x')} gd")
    assert differ.where("NOT (n <=> gn AND p <=> gp AND d <=> gd)").count() == 0
    broken = {"n": cleaning._number("x").replace("try_cast(x AS DOUBLE)", "raise_error('cast')"),
              "d": cleaning._FORMS["issue_d"]("x").replace("try_to_date(x, 'MMM-yyyy')", "raise_error('cast')")}
    assert all("raise_error" in e for e in broken.values())
    unread = spark.createDataFrame([("",), ("  ",), ("1,5",), ("13-2015",)], "x string")
    unread = unread.where("x <> '13-2015'").selectExpr(f"{broken['n']} AS y").unionByName(unread.where("x <> ''").selectExpr(f"{broken['d']} AS y"))
    assert [r.y for r in unread.collect()] == [None] * 6
