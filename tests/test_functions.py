"""Trap tests: one small literal frame per dialect corner."""

import datetime as dt
from decimal import Decimal

import xxhash
from pyspark.sql import functions as F

from examlytics.functions import scalar as fx
from examlytics.functions.html import strip_html, with_question_label
from examlytics.operators.nested import parse_tags


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


def test_pct_dec1_half_up_exact(spark):
    rows = [(n, d) for d in range(1, 60) for n in range(0, d + 1)] + [(None, 3), (1, 0)]
    got = spark.createDataFrame(rows, "n long, d long").select("n", "d", fx.pct_dec1("n", "d").alias("p")).collect()
    for r in got:
        if r.n is None or r.d == 0:
            assert r.p is None
        else:
            exp = Decimal((2000 * r.n + r.d) // (2 * r.d)) / 10
            assert r.p == exp, (r.n, r.d, r.p, exp)


def test_div_dec1_seconds_to_days(spark):
    got = one(spark, fx.div_dec1("s", 86400), "s long", [(0,), (4320,), (4319,), (86400 * 3 + 43200,), (-4320,)])
    assert got == [Decimal("0.0"), Decimal("0.1"), Decimal("0.0"), Decimal("3.5"), Decimal("-0.1")]


def test_title_case_matches_python(spark):
    names = ["o'neil john-doe a1b", "mary.jane", "ÉLODIE straße", "", "x"]
    got = one(spark, fx.title_case("s"), "s string", [(n,) for n in names] + [(None,)])
    assert got == [n.title() for n in names] + [None]
    # Known difference: a run starting with a character whose title form differs
    # from its upper form (e.g. 'ß' -> Python 'Ss', JVM 'SS').
    assert one(spark, fx.title_case("s"), "s string", [("ßa",)]) == ["SSa"]


def test_candidate_names_two_rules(spark):
    emails = [("john.doe@x.com",), ("nodomain",), (None,)]
    gold = one(spark, fx.candidate_name("e"), "e string", emails)
    view = one(spark, fx.sql_candidate_name("e"), "e string", emails)
    dom = one(spark, fx.email_domain("e"), "e string", emails)
    assert gold == ["John Doe", "Nodomain", None]
    assert view == ["john doe", "", None]
    assert dom == ["x.com", "nodomain", None]


def test_trim_strips_tabs_and_key_norm(spark):
    got = one(spark, fx.key_norm("s"), "s string",
              [("\tBackend Engineering 1781523206632",), ("AWS_99887766 x",), ("Data_12345 x",), (None,)])
    assert got == ["backend engineering", "aws", "data_12345 x", None]


def test_quarter_and_proficiency(spark):
    q = one(spark, fx.quarter_label("s"), "s string", [("2025-02-01",), ("2025-13-40",), ("2025-09-30",)])
    assert q == ["2025-Q1", "2025-Q4", "2025-Q3"]
    p = one(spark, fx.proficiency_level("x"), "x double", [(49.99,), (50.0,), (79.99,), (80.0,), (None,)])
    assert p == ["Beginner", "Intermediate", "Intermediate", "Advanced", "Beginner"]
    v = one(spark, fx.violation_severity("x"), "x long", [(0,), (1,), (5,), (6,), (None,)])
    assert v == ["No Violations", "Low Violations", "Low Violations", "High Violations", "High Violations"]


def test_iso_timestamp_try_cast(spark):
    got = one(spark, fx.iso_to_timestamp("s"), "s string",
              [("2025-03-01T10:20:30.000Z",), ("2025-13-40T00:00:00",), ("",), (None,)])
    assert got == [dt.datetime(2025, 3, 1, 10, 20, 30), None, None, None]


def test_complete_day_and_hour_differences(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 1, 1, 23, 30), dt.datetime(2025, 1, 2, 1, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(fx.diff_days("a", "b").alias("d"), fx.diff_hours("a", "b").alias("h")).first()
    assert (r.d, r.h) == (0, 1)


def test_xxh64_seed_zero_matches_reference_vectors(spark):
    words = ["", "abc", "Aptitude", "user.12@corp.example", "x" * 100, "ünïcødé"]
    got = one(spark, fx.xxh64("s"), "s string", [(w,) for w in words] + [(None,)])
    for w, h in zip(words, got):
        exp = xxhash.xxh64_intdigest(w.encode(), 0)
        assert h == (exp - (1 << 64) if exp >= 1 << 63 else exp)
    assert got[-1] is None


def test_hash_bucket_null_and_range(spark):
    labels = ["a", "b", "c"]
    got = one(spark, fx.hash_bucket("s", labels), "s string", [(str(i),) for i in range(50)] + [(None,)])
    assert set(got[:-1]) <= set(labels) and got[-1] is None
    md5 = one(spark, fx.hash_bucket("s", labels, "md5"), "s string", [("abc",)])
    assert md5 == [labels[int("900150983cd24fb", 16) % 3]]


def test_parse_tags_strict_array_of_text(spark):
    rows = [('["a",1,null,true]',), ('[{"x":1}]',), ("not json",), (None,), ("[]",), ('{"a":1}',)]
    got = one(spark, parse_tags("t"), "t string", rows)
    assert got == [["a", "1", None, "true"], [], [], [], [], []]


def test_retake_direction_bins(spark):
    got = one(spark, fx.retake_direction("d"), "d double", [(-0.001,), (-0.0009,), (0.001,), (0.0011,), (None,)])
    assert got == ["Declined", "Same", "Same", "Improved", None]


def test_bool_text(spark):
    got = one(spark, fx.bool_text("s"), "s string", [("true",), ("FALSE",), ("yes",), (None,)])
    assert got == [True, False, False, False]


def test_strip_html_and_label(spark):
    html = "<p>What is <b>x</b>?<br/>A&nbsp;&amp;&nbsp;B</p><div>n&lt;m</div>"
    got = one(spark, strip_html("s"), "s string", [(html,), ("",), (None,)])
    assert got == ["What is x? A & B n<m", "", ""]
    df = spark.createDataFrame([("", "<i>T</i>"), ("", ""), ("<p>Q</p>", "T")], "question_text string, question_title string")
    assert [r.question for r in with_question_label(df).collect()] == ["T", "(no text)", "Q"]


def test_g5_conditional_sum_without_else_is_null(spark):
    from examlytics.plans import cohort
    rows = [("c", "NSP", "2025", "Training Center", "k1", 1, 1, "Beginner", 40.0, 1, 10.0, 1.0, 0.0, 0.0, 5.0)]
    ca = spark.createDataFrame(rows, "cohort string, program_type string, cohort_year string, center string, "
                               "assessment_taker_id string, is_pass int, attempt_number int, proficiency_level string, "
                               "score_pct double, total_attempts_before_pass long, duration_min double, "
                               "questions_total double, questions_failed double, violation_count double, "
                               "violation_duration_sec double")
    r = cohort.cohort_kpis(spark, ca).first()
    assert r.pct_advanced is None and str(r.pct_beginner) == "100.0"


def test_g9_bare_score_cast_fails_on_malformed_text(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("12.5",), ("abc",)], "s string")
    import pytest
    with pytest.raises(Exception):
        df.select(F.col("s").cast("double")).collect()          # score: bare CAST (fails the query)
    assert [r[0] for r in df.select(F.col("s").try_cast("double")).collect()] == [12.5, None]  # duration: TRY


def test_g13_two_medians(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")
    r = df.agg(F.percentile_approx("x", 0.5, 10000).alias("a"), F.median("x").alias("m")).first()
    assert (r.a, r.m) == (2.0, 2.5)
