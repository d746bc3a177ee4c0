"""Date, text and rule helpers at their edges."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fathomline.functions import dates, rules, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def d(*parts):
    return F.lit(dt.date(*parts))


@pytest.mark.parametrize(
    "born, at, age",
    [
        ((2000, 2, 29), (2001, 2, 27), 0),
        ((2000, 2, 29), (2001, 2, 28), 1),
        ((2000, 2, 29), (2004, 2, 28), 3),
        ((2000, 2, 29), (2004, 2, 29), 4),
        ((1990, 6, 15), (2020, 6, 14), 29),
        ((1990, 6, 15), (2020, 6, 15), 30),
    ],
)
def test_age(spark, born, at, age):
    assert one(spark, dates.age_years(d(*born), d(*at))) == age


def test_boundaries(spark):
    assert one(spark, dates.diff_boundary("month", d(2024, 1, 31), d(2024, 2, 1))) == 1
    assert one(spark, dates.diff_boundary("year", d(2023, 12, 31), d(2024, 1, 1))) == 1
    assert one(spark, dates.diff_boundary("minute", dates.at(2024, 1, 1, 0, 0, 59), dates.at(2024, 1, 1, 0, 1, 0))) == 1
    assert one(spark, dates.diff_boundary("minute", dates.at(1969, 12, 31, 23, 59, 59), dates.at(1970, 1, 1))) == 1
    assert one(spark, dates.whole_minutes(F.lit(-61))) == -1
    assert one(spark, dates.whole_minutes(F.lit(119))) == 1


@pytest.mark.parametrize("day, iso, moved", [((2024, 3, 2), (2024, 2, 26), (2024, 2, 26)), ((2024, 3, 3), (2024, 2, 26), (2024, 3, 4)), ((2024, 3, 4), (2024, 3, 4), (2024, 3, 4))])
def test_week_starts_around_a_sunday(spark, day, iso, moved):
    assert one(spark, dates.week_start(d(*day))) == dt.date(*iso)
    assert one(spark, dates.week_start(d(*day), sunday_moves_on=True)) == dt.date(*moved)


@pytest.mark.parametrize("day, start, label", [((2024, 3, 31), (2023, 4, 1), "2023/24"), ((2024, 4, 1), (2024, 4, 1), "2024/25"), ((1999, 12, 31), (1999, 4, 1), "1999/00")])
def test_fiscal_year(spark, day, start, label):
    assert one(spark, dates.fiscal_year_start(d(*day))) == dt.date(*start)
    assert one(spark, dates.fiscal_year_label(d(*day))) == label


def test_month_ends(spark):
    assert one(spark, dates.month_end(d(2024, 1, 31), 1)) == dt.date(2024, 2, 29)
    assert one(spark, dates.previous_month_end(d(2024, 3, 31))) == dt.date(2024, 2, 29)
    assert one(spark, dates.make_ts(d(2024, 1, 2), F.lit(None))) == dt.datetime(2024, 1, 2)
    assert one(spark, dates.make_ts(d(2024, 1, 2), F.lit("13:05:09"))) == dt.datetime(2024, 1, 2, 13, 5, 9)


def test_windows():
    today = dt.date(2024, 3, 31)
    assert dates.resolve_window("fytd", today) == (dt.date(2023, 4, 1), dt.date(2024, 4, 1))
    assert dates.resolve_window("fytd", dt.date(2024, 4, 1)) == (dt.date(2024, 4, 1), dt.date(2024, 4, 2))
    assert dates.resolve_window("last_8d", today) == (dt.date(2024, 3, 23), dt.date(2024, 4, 1))
    assert dates.resolve_window("prev_month", dt.date(2024, 1, 5)) == (dt.date(2023, 12, 1), dt.date(2024, 1, 1))
    with pytest.raises(ValueError):
        dates.resolve_window("explicit", today, today, today)
    with pytest.raises(ValueError):
        dates.resolve_window("soon", today)


def test_calendar_includes_the_month_only_on_its_last_day(spark):
    before = dates.period_calendar(spark, dt.date(2000, 3, 30)).orderBy("period_id").collect()
    on = dates.period_calendar(spark, dt.date(2000, 3, 31)).orderBy("period_id").collect()
    assert [r.period_id for r in before] == [1198, 1199] and [r.period_id for r in on] == [1198, 1199, 1200]
    assert before[0].fiscal_year == "1999/00"


@pytest.mark.parametrize("value, want", [("a,b,,d", ["a", "b", None, "d", None]), ("", [None] * 5), ("x", ["x", None, None, None, None]), ("a,", ["a", None, None, None, None])])
def test_nth_item(spark, value, want):
    assert [one(spark, text.nth_item(F.lit(value), ",", i)) for i in range(1, 6)] == want


def test_separators_are_literal(spark):
    assert one(spark, text.nth_item(F.lit("a||b||c"), "||", 2)) == "b"
    assert one(spark, text.first_item(F.lit("abc"))) == "abc"
    assert one(spark, text.after_last(F.lit("Patient||12"), "||")) == "12"


@pytest.mark.parametrize("value, want", [("hELLO wORLD", "hello world"), ("McDONALD o'NEIL", "Mcdonald o'neil"), ("A  B\tCD", "A  B\tCd"), ("", "")])
def test_proper_case(spark, value, want):
    assert one(spark, text.proper_case(F.lit(value))) == want


def test_text_keys(spark):
    assert one(spark, text.normalise_key(F.lit("ABC ")) == text.normalise_key(F.lit("abc")))
    assert one(spark, text.text_len(F.lit("ab  "))) == 2
    assert one(spark, text.empty_to_null(F.lit("  "))) is None
    assert one(spark, text.position_of("B", F.lit("abc"))) == 2
    assert one(spark, text.strip_markup(F.lit("<p class='x'>a<br/>b</p>"))) == "ab"


def test_names_and_messages(spark):
    assert one(spark, text.normalise_names(F.lit(" Acme CCG "), {"acme ccg": "Acme Group CCG"}, ["CCG"])) == "Acme Group"
    assert one(spark, text.message([("a ", F.lit("x")), ("b ", F.lit(None)), ("c ", F.lit(3))])) == "a x; c 3"
    assert one(spark, text.map_codes(F.lit(None).cast("string"), {"a": "A"}, "?")) == "?"
    assert one(spark, text.classify_contains(F.lit(None).cast("string"), [("a", "A")], "none")) == "none"


@pytest.mark.parametrize("value, want", [(0, "a"), (10, "b"), (19.9, "b"), (20, "z"), (-1, "z"), (None, "n")])
def test_half_open_band(spark, value, want):
    assert one(spark, rules.band(F.lit(value).cast("double"), [0, 10, 20], ["a", "b"], "z", null_label="n")) == want


def test_closed_band_first_match_wins(spark):
    assert one(spark, rules.band(F.lit(10), [0, 10, 20], ["a", "b"], "z", closed=True)) == "a"
    assert one(spark, rules.band(F.lit(None).cast("int"), [0, 10], ["a"], "z", closed=True)) == "z"
    with pytest.raises(ValueError):
        rules.band(F.lit(1), [0, 10], ["a", "b"])


def test_ratio_flags_and_status(spark):
    assert one(spark, rules.safe_ratio(1, F.lit(0))) is None
    assert one(spark, rules.safe_ratio(1, F.lit(None).cast("int"))) is None
    assert one(spark, rules.safe_ratio(1, F.lit(4))) == 25000.0
    assert one(spark, rules.flag_in(F.lit(None).cast("string"), ["a"])) == 0
    assert one(spark, rules.not_in_or_null(F.lit(None).cast("string"), ["a"])) is True
    assert one(spark, rules.record_status(F.lit(None), F.lit(3), F.lit(3))) == "Open"
    assert one(spark, rules.length_of_stay(d(2024, 1, 1), d(2024, 1, 1), inclusive=True)) == 1
    assert one(spark, rules.length_of_stay(d(2024, 1, 1), F.lit(None).cast("date"), dt.date(2024, 1, 5))) == 4


def test_claim_without_excess_is_not_capped(spark):
    row = spark.sql(
        "SELECT 1 AS status, 50.0D AS share_pct, 100.0D AS reserve_damages, 10.0D AS reserve_defence, CAST(NULL AS DOUBLE) AS reserve_claimant, "
        "CAST(NULL AS DOUBLE) AS paid_damages, 5.0D AS paid_defence, CAST(NULL AS DOUBLE) AS paid_claimant, CAST(NULL AS DOUBLE) AS excess"
    )
    r = rules.claim_measures(row).first()
    assert (r.total_reserve, r.total_paid, r.total_claim, r.outstanding, r.outstanding_damages) == (60.0, 5.0, 60.0, 55.0, 50.0)
    assert r.excess_applied == 60.0 and r.funded is None


def test_slots_and_lists(spark):
    df = spark.createDataFrame([(1, "a", None, "c"), (2, None, None, None)], "id int, s1 string, s2 string, s3 string")
    assert sorted(map(tuple, rules.unpivot_slots(df, ["id"], ["s1", "s2", "s3"]).collect())) == [(1, 1, "a"), (1, 3, "c")]
    lists = spark.createDataFrame([(1, "a,b"), (2, ""), (3, None)], "id int, l string")
    assert sorted(map(tuple, rules.explode_list(lists, ["id"], "l").collect())) == [(1, 1, "a"), (1, 2, "b"), (2, 1, "")]
