"""Jobs on hand-made rows, one per edge."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fathomline.functions import rules
from fathomline.operators import aggs, joins, keys
from fathomline.plans import attendance, audit, care, claims, organisation, records
from fathomline.session import shared_dir


def day(n, month=1):
    return dt.date(2024, month, 1) + dt.timedelta(days=n)


def months(a, b):
    return (b.year - a.year) * 12 + b.month - a.month


def test_known_to_service_against_brute_force(spark):
    rng = random.Random(9)
    start = dt.date(2020, 1, 1)
    refs = []
    for _ in range(150):
        got = start + dt.timedelta(days=rng.randrange(1500))
        refs.append(
            (
                rng.choice(["hot", "hot", "x", None]),
                got,
                None if rng.random() < 0.3 else got + dt.timedelta(days=rng.randrange(900)),
                got + dt.timedelta(days=3) if rng.random() < 0.2 else None,
                rng.choice(["ED", "GP", "GP"]),
            )
        )
    visits = [(i, rng.choice(["hot", "x", "y", None]), start + dt.timedelta(days=rng.randrange(1500))) for i in range(150)]
    visits += [(1000 + i, r[0], r[1]) for i, r in enumerate(refs)]  # visits on the day of a referral
    r = spark.createDataFrame(refs, "person string, received date, discharged date, rejected date, source string")
    v = spark.createDataFrame(visits, "id int, person string, arrival date")
    got = {x.id: (x.known_6_months, x.known_24_months, x.previously_known) for x in care.known_to_service(v, r, "person", "arrival", "ED").collect()}
    assert len(got) == len(visits)
    for i, person, at in visits:
        mine = [x for x in refs if person is not None and x[0] == person and x[1] <= at]
        today = any(x[4] == "ED" and x[1] == at for x in mine)

        def known(h):
            if any(x[4] == "ED" and x[1] < at and months(x[1], at) <= h for x in mine):
                return 1
            if today:
                return None
            is_open = any((x[2] is None or x[2] > at) and (x[3] is None or x[3] > at) for x in mine)
            return 1 if is_open or any(months(x[1], at) <= h for x in mine) else None

        if any(x[4] == "ED" and x[1] < at and months(x[1], at) > 24 for x in mine):
            before = 1
        elif today:
            before = None
        else:
            before = 1 if any(months(x[1], at) > 24 for x in mine) else None
        assert got[i] == (known(6), known(24), before), (i, person, at)


def test_return_within_days_ties_take_the_highest_id(spark):
    visits = spark.createDataFrame([(1, "p", day(10)), (2, "p", day(5)), (3, "q", day(5))], "id int, person string, arrival date")
    spells = spark.createDataFrame([("p", 7, day(5)), ("p", 8, day(5)), ("p", 9, None)], "person string, spell_id int, discharge date")
    got = {r.id: (r.spell_id, r.days_since_spell, r.return_flag) for r in attendance.returns_after_spell(visits, spells, "person", "arrival").collect()}
    assert got == {1: (8, 5, 1), 2: (None, None, None), 3: (None, None, None)}


def test_comorbidity_slots_keep_their_order_without_gaps(spark):
    df = spark.createDataFrame([("z", None, "a", "b")], "s1 string, s2 string, s3 string, s4 string")
    row = df.select(*[c.alias(n) for n, c in attendance.filled_slots(["s1", "s2", "s3", "s4"], 4, "c").items()]).first()
    assert tuple(row) == ("z", "a", "b", None)


@pytest.mark.parametrize("minutes, band", [(None, "0-4"), (0, "0-4"), (240, "0-4"), (241, "5-12"), (720, "5-12"), (721, "12-24"), (4320, "48-72"), (4321, ">72"), (-1, "Not recorded")])
def test_wait_bands(spark, minutes, band):
    assert spark.range(1).select(attendance.wait_band(F.lit(minutes).cast("int")).alias("b")).first().b == band


def test_periods_of_a_run(spark):
    table = aggs.period_table(spark, F.lit("2024-01-07").cast("date"), F.lit("2024-02-07").cast("date"))
    got = {(r.period, r.start_day, r.end_day, r.stamp) for r in table.collect() if r.period != "Daily"}
    assert ("Weekly", dt.date(2023, 12, 25), dt.date(2023, 12, 31), dt.date(2023, 12, 31)) in got
    assert ("Monthly", dt.date(2024, 1, 1), dt.date(2024, 1, 31), dt.date(2024, 1, 31)) in got
    assert ("Yearly", dt.date(2023, 2, 1), dt.date(2024, 1, 31), dt.date(2024, 1, 31)) in got
    assert len([g for g in got if g[0] == "Weekly"]) == 5


def test_carry_in_needs_a_valid_duration(spark):
    t = lambda n: dt.datetime(2024, 1, n)
    rows = spark.createDataFrame(
        [(t(5), t(6), 10), (t(4), t(6), 10), (t(4), t(6), -1), (t(4), None, 5), (t(4), t(9), 5)], "a timestamp_ntz, b timestamp_ntz, m int"
    ).withColumn("l", F.lit("x"))
    assert aggs.period_summary(rows, "a", "b", "m", dt.date(2024, 1, 5), dt.date(2024, 1, 7), ["l"]).first().n == 2
    periods = spark.createDataFrame([("P", dt.date(2024, 1, 5), dt.date(2024, 1, 7), dt.date(2024, 1, 7))], "period string, start_day date, end_day date, stamp date")
    assert aggs.multi_period_summary(rows, "a", "b", "m", ["l"], periods).first().n == 2


def test_cumulative_counts_start_before_the_first_day(spark):
    rows = spark.createDataFrame([(day(0),), (day(3),), (day(3),), (day(60),)], "t date")
    out = aggs.cumulative_as_at(rows, F.lit(day(2)), F.lit(day(5)), {"n": ("t", None)})
    assert [r.n for r in out.orderBy("day").collect()] == [1, 3, 3, 3]


def test_links_prefer_the_containing_session(spark):
    t = lambda d, h: dt.datetime(2024, 1, d, h)
    views = spark.createDataFrame([(1, "u", t(1, 9)), (2, "u", t(1, 23)), (3, "u", t(3, 9)), (4, None, t(1, 9))], "view_id int, user_id string, ts timestamp_ntz")
    held = spark.createDataFrame([(7, "u", t(1, 8), t(1, 10)), (8, "u", t(1, 8), t(1, 9)), (9, None, t(1, 8), t(1, 10))], "session_id int, user_id string, login timestamp_ntz, logout timestamp_ntz")
    got = {r.view_id: (r.session_id, r.link) for r in audit.link_views(views, held).collect()}
    assert got == {1: (7, "inside"), 2: (7, "same day"), 3: (None, None), 4: (None, None)}


def test_open_sessions_close_with_the_next_or_the_day(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    rows = spark.createDataFrame([(1, "u", t(8), None), (2, "u", t(9), t(10)), (3, "u", t(11), None), (4, None, t(8), None)], "id int, u string, a timestamp_ntz, b timestamp_ntz")
    got = {r.id: r.closed_logout for r in audit.close_sessions(rows, "u", "a", "b", "id").collect()}
    assert got == {1: t(10), 2: t(10), 3: dt.datetime(2024, 1, 1, 23, 59, 59), 4: None}


def test_device_classes(spark):
    rows = [(True, "x iPhone y", "iPhone"), (True, "Android Mobile Safari", "Android mobile"), (True, "Android", "Android Tablet"), (True, "Android Mobile", "Android Mobile"), (False, "windows nt 10", "PC"), (False, "bot", "bot"), (None, "Linux", "Linux"), (False, "Linux", "PC")]
    df = spark.createDataFrame(rows, "m boolean, a string, want string")
    assert all(r.d == r.want for r in df.withColumn("d", audit.device_class(F.col("m"), F.col("a"))).collect())


def test_waterfall_takes_the_first_pass_that_hits(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    one = spark.createDataFrame([(1, "a", 5)], "id int, hit string, score int")
    two = spark.createDataFrame([(1, "b", 0), (2, "c", 2), (2, "d", 1)], "id int, hit string, score int")
    got = {r.id: (r.hit, r.pass_no) for r in joins.waterfall_link(left, "id", [one, two], [F.col("score")]).collect()}
    assert got == {1: ("a", 1), 2: ("d", 2), 3: (None, None)}


def test_prefix_lookup_falls_back_and_never_fans_out(spark):
    ref = spark.createDataFrame([("SW1A 1AA", "x"), ("SW1A 2BB", "w"), ("E1 6AN", "y"), ("E1 6AN", "a")], "code string, area string")
    asked = spark.createDataFrame([(1, "SW1A 1AA"), (2, "SW1A1AA"), (3, "SW1A 9ZZ"), (4, "E1 6AN "), (5, "ZZ9"), (6, None)], "id int, pc string")
    got = {r.id: r.area for r in joins.prefix_lookup(asked, ref, "pc", "code", "area").collect()}
    assert got == {1: "x", 2: "x", 3: "w", 4: "a", 5: None, 6: None}


def test_hierarchy_ignores_edges_out_of_force(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "n string")
    edges = spark.createDataFrame([("a", "b", None, None), ("b", "c", day(0), day(5)), ("c", "a", day(10), None)], "child string, parent string, start date, end date")
    got = {r.level_1: (r.level_2, r.level_3, r.level_4) for r in organisation.hierarchy(nodes, edges, "n", F.lit(day(3)), depth=4).collect()}
    assert got == {"a": ("b", "c", None), "b": ("c", None, None), "c": (None, None, None)}


def test_staff_links_repair_unknown_starts(spark):
    rows = [(1, "s", "o", dt.date(1900, 1, 1), day(9), dt.datetime(2023, 5, 6)), (2, "s", "o", None, None, dt.datetime(2023, 7, 8))]
    out = organisation.staff_links(spark.createDataFrame(rows, "link_id int, staff_id string, org_id string, start date, end date, created timestamp_ntz")).collect()
    assert [(r.link_id, r.start) for r in out] == [(2, dt.date(2023, 7, 8))]


def test_exceptions_come_in_two_forms(spark):
    base = spark.createDataFrame([(1, None, True), (2, None, False), (3, 5, False)], "id int, v int, dead boolean")
    rules = records.two_forms(records.Rule("No value", F.col("v").isNull(), [("id ", "id"), ("v ", "v")]), F.col("dead"))
    got = sorted(map(tuple, records.exception_report(base, ["id"], rules).collect()))
    assert got == [(1, "No value - deceased", "id 1"), (2, "No value - living", "id 2")]


@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_ordered_texts_with_and_without_splits(spark, monkeypatch, hot_rows):
    monkeypatch.setattr("fathomline.operators.ordered.HOT_ROWS", hot_rows)
    df = spark.createDataFrame([("k", i, f"t{i}") for i in range(25)] + [("k", 30, None), ("e", 1, None)], "k string, i int, t string")
    want = ",".join(f"t{i}" for i in range(25))
    for split in (False, True):
        out = aggs.concat_ordered(df, ["k"], "t", ["i"], ",", "all", split).collect()
        assert [(r.k, r["all"]) for r in out] == [("k", want)]
    numbered = aggs.concat_numbered(df.filter("i < 3"), ["k"], "t", ["i"], " ", "n").collect()
    assert numbered[0].n == "1) t0 2) t1 3) t2"


def test_dynamic_pivot_takes_all_values(spark):
    df = spark.range(1500).select(F.lit("k").alias("k"), F.format_string("c%04d", "id").alias("c"), F.col("id").cast("int").alias("n"))
    out = aggs.dynamic_pivot(df, ["k"], "c", F.count(F.lit(1)))
    assert out.columns == ["k", *[f"c{i:04d}" for i in range(1500)]]
    assert len(claims.numbered_matrix(df.filter("n < 300"), ["k"], "n", ["c"]).columns) == 301
    assert aggs.pivot_rows(df, ["k"], "c", F.count(F.lit(1))).count() == 1500


def test_broadcast_only_when_proven_small(spark, capsys):
    small, big = spark.range(10).withColumnRenamed("id", "x"), spark.range(1000).withColumnRenamed("id", "x")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df, expected in ((small, True), (big, False)):
            big.join(joins.checked_broadcast(df, 1000), "x").explain()
            assert ("BroadcastHashJoin" in capsys.readouterr().out) is expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_money_stays_decimal(spark):
    df = spark.sql(
        "SELECT 1 AS status, cast(50 AS decimal(5,2)) AS share_pct, cast(0.1 AS decimal(19,4)) AS reserve_damages, cast(0.2 AS decimal(19,4)) AS reserve_defence,"
        " cast(NULL AS decimal(19,4)) AS reserve_claimant, cast(0.1 AS decimal(19,4)) AS paid_damages, cast(0.2 AS decimal(19,4)) AS paid_defence,"
        " cast(NULL AS decimal(19,4)) AS paid_claimant, cast(1 AS decimal(19,4)) AS excess"
    )
    out = rules.claim_measures(df)
    money = ["total_paid", "total_reserve", "total_claim", "outstanding", "outstanding_damages", "excess_applied", "funded"]
    assert all(dict(out.dtypes)[c].startswith("decimal") for c in money), out.dtypes
    assert float(out.first()["total_paid"]) == 0.3 and float(out.first()["outstanding"]) == -0.05


def test_shared_folder_is_needed_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master, applicationId = "spark://host:7077", "app"

    with pytest.raises(RuntimeError):
        shared_dir(Session)


def test_group_values_beside_rows_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 2)], "k string, v int")
    assert sorted((r.v, r.m) for r in keys.beside(df, ["k"], {"m": F.max("v")}).collect()) == [(1, 3), (2, 2), (3, 3)]
    assert sorted((r.v, r.last) for r in keys.flag_extreme(df, ["k"], "v", "last").collect()) == [(1, 0), (2, 1), (3, 1)]


def test_mode_ties_take_the_smaller_value(spark):
    df = spark.createDataFrame([("k", "b"), ("k", "a"), ("k", None), ("k", None), ("k", None)], "k string, v string")
    assert aggs.mode_per_key(df, ["k"], "v").first().v == "a"


def test_densify_counts_entities_times_months(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, 1), 5), ("b", dt.date(2024, 3, 1), 7)], "k string, m date, n int")
    out = joins.densify(df, ["k"], "m", F.lit(dt.date(2023, 12, 1)), F.lit(dt.date(2024, 4, 1)), ["n"]).collect()
    assert len(out) == 10 and sum(r.n for r in out) == 12


def test_one_lookup_decodes_all_columns(spark):
    rng = random.Random(4)
    codes = [None, "", "zz"] + [f"c{i}" for i in range(40)]
    rows = [(i, *[rng.choice(codes) if rng.random() < 0.6 else f" {rng.choice(codes)} " for _ in range(3)]) for i in range(900)]
    names = {f"c{i}": f"text {i}" for i in range(0, 40, 2)}
    df = spark.createDataFrame(rows, "id int, a string, b string, c string").repartition(3)
    known = spark.createDataFrame(list(names.items()), "code string, description string")
    got = {r.id: (r.ta, r.tb, r.tc) for r in attendance.decode(df, known, {"a": "ta", "b": "tb", "c": "tc"}).collect()}
    assert got == {r[0]: tuple(names.get(c.strip(" ")) if c is not None else None for c in r[1:]) for r in rows}
    assert attendance.decode(df.limit(0), known, {"a": "ta"}).count() == 0
    assert {r.ta for r in attendance.decode(df, known.limit(0), {"a": "ta"}).collect()} == {None}


@pytest.mark.parametrize("move_up", [False, True])
def test_slots_of_referrals_stay_together(spark, move_up):
    schema = "ident int, " + ", ".join(
        f"service_{i} string, request_date_{i} date, request_time_{i} string, assessment_date_{i} date, assessment_time_{i} string" for i in (1, 2)
    )
    a, b = ("S1", day(0), None, None, "10:00:00"), (" ", day(1), "09:00:00", day(1), "09:30:00")
    got = attendance.referred_services(spark.createDataFrame([(1, *b, *a), (2, *b, *b), (3, *a, *b)], schema), 2, move_up)
    first = ("S1", dt.datetime(2024, 1, 1), None)
    want = {1: (*first, None, None, None) if move_up else (None, None, None, *first), 2: (None,) * 6, 3: (*first, None, None, None)}
    assert {r.ident: tuple(r)[1:] for r in got.collect()} == want


def test_totals_carried_on_read_only_later_events(spark, tmp_path, capsys):
    rng = random.Random(8)
    events = [(dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(600)), rng.choice("ab")) for _ in range(300)]
    spark.createDataFrame(events, "ts timestamp_ntz, kind string").write.parquet(str(tmp_path / "e"))
    df = spark.read.parquet(str(tmp_path / "e"))
    sources = [(df, {"all": ("ts", None), "a": ("ts", F.col("kind") == "a")})]
    first, last = dt.date(2024, 1, 3), dt.date(2024, 1, 24)
    whole = [tuple(r) for r in aggs.cumulative_over(sources, F.lit(first), F.lit(last)).orderBy("day").collect()]
    for at in (first, dt.date(2024, 1, 11), last):
        stored = aggs.cumulative_over(sources, F.lit(first), F.lit(at))
        out = aggs.cumulative_from(stored, sources, last)
        assert [tuple(r) for r in out.orderBy("day").collect()] == whole
    late = df.filter(F.col("ts") >= F.lit(dt.datetime(2024, 1, 12)))
    stored = aggs.cumulative_over(sources, F.lit(first), F.lit(dt.date(2024, 1, 11)))
    assert [tuple(r) for r in aggs.cumulative_from(stored, [(late, sources[0][1])], last).orderBy("day").collect()] == whole
    aggs._events_from(*sources[0], dt.date(2024, 1, 12))[0].explain("formatted")
    assert "GreaterThanOrEqual(ts,2024-01-12" in capsys.readouterr().out


def test_grid_runs_over_the_span_of_each_entity(spark):
    rows = [(1, "a", day(0), 3), (1, "b", day(0, 3), 1), (None, "a", day(0, 5), 2), (2, "a", day(0, 2), 4), (2, "a", day(0, 6), 5)]
    df = spark.createDataFrame(rows, "who int, kind string, month date, n long")
    got = {tuple(r) for r in joins.densify_spans(df, ["who"], ["kind"], "month", ["n"]).collect()}
    held = {r[:3]: r[3] for r in rows}
    grid = [(w, k, day(0, m)) for w, k, lo, hi in ((1, "a", 1, 3), (1, "b", 1, 3), (None, "a", 5, 5), (2, "a", 2, 6)) for m in range(lo, hi + 1)]
    assert got == {(*g, held.get(g, 0)) for g in grid}


def test_staff_have_the_months_between_their_first_and_last_action(spark):
    log = spark.createDataFrame([("s", "t", "view", day(3)), ("s", "t", "view", day(3, 3)), ("old", "t", "edit", day(1))], "staff_id string, team_id string, action string, ts date")
    logins = spark.createDataFrame([("s", "t", day(9)), ("s", "t", day(2, 2))], "staff_id string, team_id string, ts date")
    teams = spark.createDataFrame([("t", "Team", "North")], "team_id string, team_name string, region string")
    got = audit.staff_activity(log, logins, teams, [("view", "viewed")])
    rows = {(r.staff_id, r.activity, r.month.month): (r.total, r.staff_start, r.staff_end) for r in got.collect()}
    ends = (day(9), day(2, 2))
    want = {("s", a, m): (n, *ends) for a, per in (("viewed", (1, 0, 1)), ("login", (1, 1, 0))) for m, n in zip((1, 2, 3), per)}
    assert rows == want | {("old", "other", 1): (1, None, None)}
    assert [tuple(r) for r in audit.team_reference(got).collect()] == [("North", "t", "Team", day(0), day(0, 3))]


def test_text_blocks_meet_in_one_grouping(spark, capsys):
    alerts = spark.createDataFrame([(1, "<b>a</b> & b"), (2, None), (None, "<i>lost</i>"), (1, "<a>smaller</a>")], "id long, html string")
    notes = spark.createDataFrame([(3, "no markup"), (1, "")], "id long, html string")
    wide = records.text_blocks({"alerts": alerts, "notes": notes}, "id")
    wide.explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert {r["id"]: (r["alerts"], r["alerts_html"], r["notes"]) for r in wide.collect()} == {
        1: ("a & b", "<b>a</b> & b", ""), 2: (None, None, None), 3: (None, None, "no markup")
    }


def test_practice_details_have_defaults_and_spell_out_marks(spark):
    people = spark.createDataFrame([(1, 10, 20), (2, 11, None), (3, 12, 99)], "id long, staff_id long, practice_id long")
    staff = spark.createDataFrame(
        [(10, "Dr", "Ann", "<Lee>", "c1"), (11, None, " ", None, None), (12, None, None, "Ray", "c3")],
        "staff_id long, staff_title string, forename string, surname string, staff_code string",
    )
    practices = spark.createDataFrame(
        [(20, "A & B", "p1", None, "tel", "1 Road", "N1")],
        "practice_id long, practice string, practice_code string, practice_email string, practice_phone string, practice_address string, practice_postcode string",
    )
    got = {r["id"]: r for r in records.practice_details(people, staff, practices).collect()}
    assert [got[i]["practitioner"] for i in (1, 2, 3)] == ["Ann <Lee>", None, "Ray"]
    assert got[1]["practice_text"] == "PractitionerAnn &lt;Lee&gt;TitleDrStaff codec1PracticeA &amp; BPractice codep1PostcodeN1Phonetel"
    assert got[3]["practice_html"].count("(N/A)") == 5 and got[2]["practice_text"].count("(N/A)") == 7
