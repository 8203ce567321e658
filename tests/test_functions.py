"""Unit tables for the Column builders: one row per edge case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from replylens.functions import (canonical_id, classify_shift, date_in_text, fold_accents, hms_to_seconds,
                                 is_valid_title, norm_name, normalize_date, normalize_time, parse_meta, safe_name,
                                 score_code, score_label, segment_code, seconds_to_hms, strip, yes_flag)

AS_OF = dt.date(2026, 1, 22)
NBSP, NNBSP = "\u00a0", "\u202f"


def one(spark, col, values, schema="v string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [r[0] for r in df.select(col).collect()]


def test_meta_parse_styles_and_edges(spark):
    rows = [
        ("[9:05, 3/1/2024] Ana: hola", dt.datetime(2024, 1, 3, 9, 5), "Ana"),
        (f"[9:05{NNBSP}p.{NBSP}m., 3/1/2024] You:", dt.datetime(2024, 1, 3, 21, 5), "You"),
        ("[12:30 AM, 3/1/2024] x:", dt.datetime(2024, 1, 3, 0, 30), "x"),
        ("[12:30 PM, 3/1/2024] x:", dt.datetime(2024, 1, 3, 12, 30), "x"),
        ("[0:05 AM, 3/1/2024] x:", None, "x"),          # am/pm hour must be 1-12
        ("[13:05 PM, 3/1/2024] x:", None, "x"),
        ("[24:05, 3/1/2024] x:", None, "x"),            # hour > 23
        ("[10:00, 25/12/2023] x:", dt.datetime(2023, 12, 25, 10, 0), "x"),   # first > 12 -> d/m
        ("[10:00, 12/25/2023] x:", dt.datetime(2023, 12, 25, 10, 0), "x"),   # second > 12 -> m/d
        ("[10:00, 02/03/2024] x:", dt.datetime(2024, 3, 2, 10, 0), "x"),     # ambiguous -> d/m
        ("[10:00, 31/02/2024] x:", None, "x"),          # impossible date
        ("[10:00, 3/1/2024]", dt.datetime(2024, 1, 3, 10, 0), None),          # no author
        ("no meta here", None, None),
        ("  [10:00 a. m., 3/1/2024]  Bo : hi", dt.datetime(2024, 1, 3, 10, 0), "Bo"),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "m string")
    got = df.select(parse_meta(F.col("m")).alias("p")).select("p.dt", "p.author").collect()
    for (meta, want_dt, want_author), g in zip(rows, got):
        assert g["dt"] == want_dt, meta
        assert g["author"] == want_author, meta


def test_meta_strict_ampm(spark):
    df = spark.createDataFrame([("[9:05 a m., 3/1/2024] x:",)], "m string")
    lenient = df.select(parse_meta(F.col("m")).alias("p")).first()["p"]["dt"]
    strict = df.select(parse_meta(F.col("m"), strict_ampm=True).alias("p")).first()["p"]["dt"]
    assert lenient == dt.datetime(2024, 1, 3, 9, 5)
    assert strict == dt.datetime(2024, 1, 3, 9, 5)  # read as 24 h: same hour before noon
    df = spark.createDataFrame([("[9:05 p m., 3/1/2024] x:",)], "m string")
    assert df.select(parse_meta(F.col("m")).alias("p")).first()["p"]["dt"].hour == 21
    assert df.select(parse_meta(F.col("m"), strict_ampm=True).alias("p")).first()["p"]["dt"].hour == 9


@pytest.mark.parametrize("text,want", [
    ("hoy", AS_OF), (" Ayer ", AS_OF - dt.timedelta(days=1)), ("HOY", AS_OF),
    ("2024-01-05", dt.date(2024, 1, 5)), ("2024-01-05 10:11:12", dt.date(2024, 1, 5)),
    ("2024-01-05   10:11:12", dt.date(2024, 1, 5)), ("5/1/2024", dt.date(2024, 1, 5)),
    ("05/01/2024", dt.date(2024, 1, 5)), ("31/02/2024", None), ("nan", None), ("", None),
    ("NaT", None), (None, None), ("2024-1-5", None), ("01-05-2024", None),
])
def test_normalize_date_lenient(spark, text, want):
    assert one(spark, normalize_date(F.col("v"), AS_OF), [text])[0] == want


@pytest.mark.parametrize("text,want", [
    ("05/01/2024", dt.date(2024, 1, 5)), ("5/1/2024", None), ("hoy", None),
    ("2024-01-05", dt.date(2024, 1, 5)), ("2024-01-05 10:11:12", dt.date(2024, 1, 5)),
])
def test_normalize_date_strict(spark, text, want):
    assert one(spark, normalize_date(F.col("v"), strict=True), [text])[0] == want


@pytest.mark.parametrize("text,want", [
    ("09:30:00", "09:30:00"), ("9:5:3", "09:05:03"), ("09:30", "09:30:00"), ("9:30", "09:30:00"),
    ("09:30:00.123456", "09:30:00"), ("09:30:00.123456789", "09:30:00"), ("24:00:00", None),
    ("09:60", None), ("", None), ("nan", None), (None, None), (" 10:00:00 ", "10:00:00"),
])
def test_normalize_time(spark, text, want):
    assert one(spark, normalize_time(F.col("v")), [text])[0] == want


def test_hms_round_trip_property(spark):
    secs = [0, 59, 60, 3599, 3600, 86399, 86400, 359999, 360000, 1234567]
    df = spark.createDataFrame([(s,) for s in secs], "s bigint")
    out = df.select("s", seconds_to_hms(F.col("s")).alias("t")).select(
        "s", "t", hms_to_seconds(F.col("t")).alias("back")).collect()
    for r in out:
        assert r["back"] == r["s"]
    assert [r["t"] for r in out][-3:] == ["99:59:59", "100:00:00", "342:56:07"]


@pytest.mark.parametrize("secs,code", [
    (0, "automatic"), (59, "automatic"), (60, "excellent"), (300, "excellent"), (301, "good"),
    (900, "good"), (901, "regular"), (3600, "regular"), (3601, "slow"), (86400, "slow"),
    (86401, "very_slow"), (None, None),
])
def test_score_buckets(spark, secs, code):
    assert one(spark, score_code(F.col("v")), [secs], "v bigint")[0] == code


def test_score_labels(spark):
    assert one(spark, score_label(F.col("v")), ["excellent", "not_answered"]) == ["🟢 Excelente", "❌ No respondido"]


def test_segments_partition_the_day(spark):
    hours = [f"{h:02d}:00:00" for h in range(24)]
    codes = one(spark, segment_code(F.col("v")), hours)
    assert all(c is not None for c in codes)
    assert codes[5] == "early_morning" and codes[6] == "morning_off" and codes[9] == "morning_work"
    assert codes[13] == "afternoon" and codes[18] == "evening" and codes[23] == "late_evening"
    assert one(spark, segment_code(F.col("v")), ["25:00:00", None, "9:00"]) == [None, None, None]


def test_names_titles_and_text(spark):
    assert one(spark, norm_name(F.col("v")), [f"  Ana{NBSP}  María \t"]) == ["ana maría"]
    assert one(spark, strip(F.col("v")), [f"{NBSP} x \n"]) == ["x"]
    assert one(spark, is_valid_title(F.col("v")), ["Ana", "", "a\nb", "x" * 61, "Archivados", "x" * 60]) == \
        [True, False, False, False, False, True]
    assert one(spark, safe_name(F.col("v")), ["Ana María #1", "***", " a_b-c "]) == \
        ["Ana-María-1", "todos_los_chats", "a_b-c"]
    assert one(spark, yes_flag(F.col("v")), ["SI", "si ", "NO", "x", None]) == [True, True, False, None, None]
    assert one(spark, canonical_id(F.col("v")), ["4228.0", " 4228 ", "abc", "", None]) == \
        ["4228", "4228", "abc", None, None]
    assert one(spark, fold_accents(F.col("v")), ["MAÑANA Tardé"]) == ["manana tarde"]


@pytest.mark.parametrize("text,want", [
    ("Mañana", "mañana"), ("manana", "mañana"), ("TARDE", "tarde"), ("turno tarde", "tarde"),
    ("Tarde/Mañana", "tarde"), ("libre", None), ("", None), (None, None), ("  MAÑANA ", "mañana"),
])
def test_classify_shift(spark, text, want):
    assert one(spark, classify_shift(F.col("v")), [text])[0] == want


@pytest.mark.parametrize("text,want", [
    ("[9:05, 3/1/24] x", dt.date(2024, 1, 3)), ("on 31/12/2023 ok", dt.date(2023, 12, 31)),
    ("31/02/2024", None), ("none", None), ("12/05/20245", None),
])
def test_date_in_text(spark, text, want):
    assert one(spark, date_in_text(F.col("v")), [text])[0] == want
