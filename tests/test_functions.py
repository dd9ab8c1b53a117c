import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhall.config import Classifier, FilterSpec
from tallyhall.functions import calendar as cal
from tallyhall.functions import text as tx
from tallyhall.functions.classify import classify
from tallyhall.operators.filters import spec_predicate


def one_col(spark, values, typ, expr):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_age_bands_coerce_text(spark):
    ages = ["abc", None, "11.9", "12", "15", "24", "25"]
    assert one_col(spark, ages, "string", tx.is_child) == [False, False, True, False, False, False, False]
    assert one_col(spark, ages, "string", tx.is_youth) == [False, False, False, False, True, True, False]


def test_json_array_test(spark):
    vals = ["[1]", "[]", "{}", "7", "null", "bad", None]
    assert one_col(spark, vals, "string", tx.is_json_array) == [True, True, False, False, False, False, False]
    assert one_col(spark, vals, "string", tx.json_type) == ["array", "array", "object", "scalar", "null",
                                                            "invalid", None]


def test_identity_mask(spark):
    vals = ["9012345", "1234567890123", None]
    assert one_col(spark, vals, "string", tx.mask_identity) == ["00000901****", "12345678****", None]


def test_week_key_collision_and_label(spark):
    days = [dt.date(1996, 1, 1), dt.date(1996, 12, 30), dt.date(2026, 1, 14)]
    keys = one_col(spark, days, "date", cal.week_key)
    starts = one_col(spark, days, "date", cal.week_start)
    assert keys[:2] == ["1996-W01", "1996-W01"] and starts[0] != starts[1]
    assert one_col(spark, days[2:], "date", cal.week_label) == ["12 Jan – 18 Jan 2026"]


def test_week_of_month_bins(spark):
    days = [dt.date(2026, 1, d) for d in (7, 8, 21, 22, 31)]
    assert one_col(spark, days, "date", cal.week_of_month) == ["W1", "W2", "W3", "W4", "W4"]


def test_month_and_quarter_labels(spark):
    d = [dt.date(2026, 2, 9)]
    assert one_col(spark, d, "date", cal.month_label) == ["Feb 2026"]
    assert one_col(spark, d, "date", cal.quarter_sheet) == ["Q1 2026"]
    assert one_col(spark, d, "date", cal.year_quarter) == ["2026-Q1"]
    assert one_col(spark, d, "date", cal.month_key) == ["2026-02"]


def test_control_chars_stripped(spark):
    assert one_col(spark, ["a\x01b\x0bc\td\n"], "string", tx.strip_control) == ["abc\td\n"]


def test_duration_half_up(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 0, 7, 30)),
                                (dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 1, 30, 18)),
                                (dt.datetime(2024, 1, 1, 1, 0, 0), dt.datetime(2024, 1, 1, 0, 52, 30))],
                               "s timestamp, e timestamp")
    got = [r[0] for r in df.select(cal.duration_hours("s", "e")).collect()]
    assert got == [Decimal("0.13"), Decimal("1.51"), Decimal("-0.13")]


def test_truthiness(spark):
    vals = ["true", "1", "t", "YES", "false", None, "0"]
    assert one_col(spark, vals, "string", tx.truthy) == [True, True, True, True, False, False, False]


def test_classifier_first_match_wins(spark):
    c = Classifier()
    vals = ["SkillForge Cyber", "E-Kelas tuition", "Mahir esport", "TinyTechies", None, "anything"]
    got = one_col(spark, vals, "string", lambda x: classify(x, c))
    assert got == ["ESPORT", "EKELAS", "MAHIR", "TINYTECHIES", "CYBERSECURITY", "CYBERSECURITY"]


def test_search_spans_fields_and_blank_dates_pass(spark):
    rows = [("Ali", "Kampung Baru", None, dt.date(2026, 1, 5)),
            ("Siti", "Baru Hilir", None, None),
            ("Abu", "Other", None, dt.date(2027, 1, 1))]
    df = spark.createDataFrame(rows, "participant_name string, site_name string, program_name string, "
                                     "event_startdate date")
    spec = FilterSpec(search="ali kampung", date_from="2026-01-01", date_to="2026-12-31",
                      search_fields=("participant_name", "site_name", "program_name"))
    assert df.where(spec_predicate(spec)).count() == 1
    spec2 = FilterSpec(date_from="2026-01-01", date_to="2026-12-31")
    assert sorted(r[0] for r in df.where(spec_predicate(spec2)).select("participant_name").collect()) == \
        ["Ali", "Siti"]


def test_address_safe_int_and_site_fallback(spark):
    df = spark.createDataFrame([(" Jalan 1", None, "7", None, 12), (None, "Lot 2", "x", "Kg Baru", 13)],
                               "a1 string, a2 string, n string, name string, sid bigint")
    got = df.select(tx.address_line("a1", "a2").alias("addr"), tx.safe_int("n").alias("n"),
                    tx.site_name_fallback(F.col("name"), F.col("sid")).alias("site")).collect()
    assert [tuple(r) for r in got] == [("Jalan 1", 7, "Site-12"), ("Lot 2", 0, "Kg Baru")]


def test_coercing_timestamp_parse(spark):
    got = one_col(spark, ["2026-01-05 10:30:00", "not a date", None], "string", cal.to_utc_timestamp_safe)
    assert got[0] == dt.datetime(2026, 1, 5, 10, 30) and got[1] is None and got[2] is None
