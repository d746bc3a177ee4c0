"""Ordered operators against brute force on random rows with a hot key, NULL keys and ties in time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fathomline.functions.dates import diff_boundary
from fathomline.operators import joins, ordered, sessions
from fathomline.session import materialise

@pytest.fixture(autouse=True, params=[40, 1_000_000], ids=["hot keys split", "no hot key"])
def hot_rows(request, monkeypatch):
    """Every test runs with some keys cut into splits, and with none."""
    monkeypatch.setattr(ordered, "HOT_ROWS", request.param)


SCHEMA = "id long, k string, t timestamp_ntz, v int, stop timestamp_ntz"


def rows(seed, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "c", None])
        t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(0, 6 * 24 * 60))
        stop = None if rng.random() < 0.2 else t + dt.timedelta(minutes=rng.choice([0, 5, 30, 600, 3000]))
        out.append((i, key, t, None if rng.random() < 0.3 else rng.randrange(100), stop))
    return out


def by_key(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        groups.setdefault(r[1], []).append(r)
    return groups


ORDER = ["t", "id"]


@pytest.mark.parametrize("seed", range(3))
def test_sequence_previous_following_running(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, SCHEMA)
    out = ordered.scan(
        df,
        ["k"],
        ORDER,
        measures={"n": ("sum", F.lit(1).cast("long")), "top": ("max", F.col("v")), "low": ("min", F.col("v"))},
        before={"pv": F.col("v"), "pid": F.col("id")},
        after={"nid": F.col("id")},
    )
    got = {r.id: (r.n, r.top, r.low, r.pv, r.pid, r.nid) for r in out.collect()}
    want = {}
    for group in by_key(data).values():
        for i, r in enumerate(group):
            seen = [x[3] for x in group[: i + 1] if x[3] is not None]
            prev = group[i - 1] if i else None
            nxt = group[i + 1] if i + 1 < len(group) else None
            want[r[0]] = (
                i + 1, max(seen, default=None), min(seen, default=None), prev[3] if prev else None, prev[0] if prev else None, nxt[0] if nxt else None,
            )
    assert got == want


@pytest.mark.parametrize("seed", range(2))
def test_descending_sequence_and_flagged_sequence(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, SCHEMA)
    down = ordered.sequence(df, ["k"], ORDER, "n", descending=True)
    got = {r.id: r.n for r in down.collect()}
    want = {r[0]: len(g) - i for g in by_key(data).values() for i, r in enumerate(g)}
    assert got == want
    flagged = ordered.sequence(df, ["k"], ORDER, "n", where=F.col("v") > 50)
    got = {r.id: r.n for r in flagged.collect()}
    want = {}
    for g in by_key(data).values():
        n = 0
        for r in g:
            hit = r[3] is not None and r[3] > 50
            n += hit
            want[r[0]] = n if hit else None
    assert got == want


def test_global_sequence_and_ranks(spark):
    data = rows(7)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.id: r.n for r in ordered.global_sequence(df, ORDER, "n").collect()}
    assert got == {r[0]: i for i, r in enumerate(sorted(data, key=lambda r: (r[2], r[0])), 1)}
    valued = df.filter("v IS NOT NULL")
    dense = {r.id: r.n for r in ordered.dense_rank_per_key(valued, ["k"], "v", "n").collect()}
    rank = {r.id: r.n for r in ordered.rank_per_key(valued, ["k"], "v", "n").collect()}
    for g in by_key([r for r in data if r[3] is not None]).values():
        for r in g:
            assert dense[r[0]] == len({x[3] for x in g if x[3] < r[3]}) + 1
            assert rank[r[0]] == len([x for x in g if x[3] < r[3]]) + 1


def test_next_value(spark):
    data = rows(3)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.id: r.nv for r in ordered.next_value(df, ["k"], ORDER, "v", "nv").collect()}
    for g in by_key(data).values():
        for i, r in enumerate(g):
            assert got[r[0]] == next((x[3] for x in g[i:] if x[3] is not None), None)


@pytest.mark.parametrize("gap", [5, 90, 1500])
def test_islands_count_minute_boundaries(spark, gap):
    data = rows(11)
    df = spark.createDataFrame(data, SCHEMA)
    out = ordered.islands(df, ["k"], ORDER, lambda a, b: diff_boundary("minute", a, b) > gap, "t")
    got = sorted((r.k or "", r.start_time, r.end_time, r.events) for r in out.collect())
    want = []
    for key, g in by_key(data).items():
        island = []
        for r in g:
            if island and (r[2] - island[-1]).total_seconds() // 60 > gap:
                want.append((key or "", island[0], island[-1], len(island)))
                island = []
            island.append(r[2])
        want.append((key or "", island[0], island[-1], len(island)))
    assert got == sorted(want)


def test_gap_of_five_minutes_by_boundaries(spark):
    """Exactly 5 minutes joins; 5 min 1 s across six minute marks breaks."""
    base = dt.datetime(2024, 3, 1, 23, 58, 59)
    data = [(1, "a", base), (2, "a", base + dt.timedelta(minutes=5)), (3, "a", base + dt.timedelta(minutes=10, seconds=1))]
    df = spark.createDataFrame(data, "id long, k string, t timestamp_ntz")
    out = ordered.islands(df, ["k"], ORDER, lambda a, b: diff_boundary("minute", a, b) > 5, "t")
    assert sorted(r.events for r in out.collect()) == [1, 2]


@pytest.mark.parametrize("seed", range(3))
def test_full_merge_never_overlaps(spark, seed):
    data = rows(seed)
    df = spark.createDataFrame(data, SCHEMA)
    out = sessions.merge_sessions(df, ["k"], "t", "stop", ORDER)
    got = sorted((r.k or "", r.start_time, r.end_time, r.rows_merged) for r in out.collect())
    want = []
    for key, g in by_key(data).items():
        current = None
        for r in g:
            stop = r[4] or r[2]
            if current and r[2] <= current[1]:
                current = [current[0], max(current[1], stop), current[2] + 1]
            else:
                if current:
                    want.append((key or "", *current))
                current = [r[2], stop, 1]
        want.append((key or "", *current))
    assert got == sorted(want)
    for a, b in zip(got, got[1:]):
        assert a[0] != b[0] or a[2] < b[1]


def test_pairwise_merge_of_hand_made_rows(spark):
    t = lambda h, m=0: dt.datetime(2024, 1, 1, h, m)
    data = [(1, "u", t(8), 0, t(10)), (2, "u", t(9), 0, t(9, 30)), (3, "u", t(10), 0, None), (4, "u", t(12), 0, t(13)), (5, "u", t(13), 0, t(14))]
    df = spark.createDataFrame(data, SCHEMA)
    out = sessions.merge_sessions(df, ["k"], "t", "stop", ORDER, mode="pairwise")
    got = {r.id: (r.absorbed, r.final_end, r.minutes) for r in out.collect()}
    assert got == {
        1: (0, t(10), 120),  # contains the next one
        2: (1, t(9, 30), 30),
        3: (0, t(12), None),  # open: takes the next start, no duration
        4: (0, t(14), 120),  # touches the next one
        5: (1, t(14), 60),
    }


@pytest.mark.parametrize("strict", [True, False])
def test_asof_last(spark, strict):
    left, right = rows(1, 200), rows(2, 200)
    l = spark.createDataFrame(left, SCHEMA).select("id", "k", "t")
    r = spark.createDataFrame(right, SCHEMA).select(F.col("id").alias("rid"), "k", F.col("t").alias("rt"), "v")
    out = joins.asof_last(l, r, ["k"], "t", "rt", "rid", ["v"], strict=strict)
    got = {x.id: (x.rt, x.rid, x.v) for x in out.collect()}
    for a in left:
        found = [b for b in right if b[1] is not None and b[1] == a[1] and (b[2] < a[2] if strict else b[2] <= a[2])]
        best = max(found, key=lambda b: (b[2], b[0]), default=None)
        assert got[a[0]] == ((best[2], best[0], best[3]) if best else (None, None, None))


def test_nearest_containing(spark):
    rng = random.Random(5)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    left = [(i, rng.choice(["hot", "hot", "x"]), day(rng.randrange(80))) for i in range(300)]
    spans = [(i, rng.choice(["hot", "hot", "x"]), s := rng.randrange(80), s + rng.choice([-1, 0, 3, 40])) for i in range(120)]
    l = spark.createDataFrame(left, "id long, k string, d date")
    s = spark.createDataFrame([(i, k, day(a), day(b)) for i, k, a, b in spans], "sid long, k string, a date, b date")
    out = joins.nearest_containing(l, "id", s, ["k"], "d", "a", "b", "sid", "1 day")
    got = {r.id: (r.sid, r._off, r._stay) for r in out.collect()}
    want = {}
    for i, k, d in left:
        n = (d - dt.date(2024, 1, 1)).days
        found = [(abs(n - a), -(b - a), sid) for sid, kk, a, b in spans if kk == k and a - 1 <= n <= b]
        if found:
            off, stay, sid = min(found)
            want[i] = (sid, off, -stay * 86400)
    assert got == want


def test_join_interval_at_the_edges(spark):
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    events = spark.createDataFrame([(1, "a", t(1)), (2, "a", t(3, 5)), (3, "a", t(9)), (4, None, t(2))], "id long, k string, t timestamp_ntz")
    spans = spark.createDataFrame(
        [(10, "a", t(1), t(3, 5)), (11, "a", t(3, 5), t(3, 5)), (12, "a", t(5), t(4)), (13, None, t(1), t(9))], "sid long, k string, a timestamp_ntz, b timestamp_ntz"
    )
    out = joins.join_interval(events, spans, ["k"], "t", "a", "b", width_days=1, how="left")
    assert sorted((r.id, r.sid or 0) for r in out.collect()) == [(1, 10), (2, 10), (2, 11), (3, 0), (4, 0)]


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ordered.sequence(df, ["k"], ORDER, "n").count() == 0
    assert sessions.merge_sessions(df, ["k"], "t", "stop", ORDER).count() == 0


def test_open_spans_are_listed_for_the_time_of_the_events_only(spark):
    d = dt.date
    schema = "k string, a date, b date, sid int"
    spans = spark.createDataFrame([("x", d(1900, 1, 1), d(9999, 12, 31), 1), ("x", d(2025, 1, 1), d(9999, 12, 31), 2), ("y", d(2024, 1, 2), d(2024, 1, 3), 3)], schema)
    events = spark.createDataFrame([(1, "x", d(2024, 1, 1)), (2, "y", d(2024, 1, 5)), (3, "y", d(2024, 1, 3)), (4, "x", None)], "id int, k string, t date")
    out = joins.join_interval(events, spans, ["k"], "t", "a", "b", how="left")
    assert sorted((r.id, r.sid) for r in out.collect()) == [(1, 1), (2, None), (3, 3), (4, None)]
    none = joins.join_interval(events.filter("id = 4"), spans, ["k"], "t", "a", "b")
    assert none.collect() == []


def test_a_key_with_most_rows_on_one_day_is_split_evenly(spark, monkeypatch):
    """90 % of the rows on one key and one day: no task holds more than a few splits' rows, and the answers stay."""
    monkeypatch.setattr(ordered, "HOT_ROWS", 1000)
    monkeypatch.setattr(ordered, "SPLIT_ROWS", 1000)
    day = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    hot = F.col("id") % 10 != 0
    df = spark.range(0, 20_000, 1, 6).select(
        "id", F.when(hot, "h").otherwise((F.col("id") % 70).cast("string")).alias("k"), (day + F.expr("make_dt_interval(0, 0, 0, (id * 7919) % 86400)")).alias("t"), (F.col("id") % 13).alias("v")
    )
    for keys in (["k"], []):
        g = ordered.spans(df, keys, ORDER)
        sizes = [r.n for r in g.groupBy(ordered.HASH, ordered.SPAN).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 4 * 1000, max(sizes)
        got = {r.id: (r.n, r.s) for r in ordered.running(df, keys, ORDER, {"n": ("sum", F.lit(1).cast("long")), "s": ("sum", F.col("v"))}).collect()}
        n, total = {}, {}
        for r in sorted(df.collect(), key=lambda r: (r.t, r.id)):
            key = r.k if keys else None
            n[key], total[key] = n.get(key, 0) + 1, total.get(key, 0) + r.v
            assert got[r.id] == (n[key], total[key])


@pytest.mark.parametrize("kind", ["timestamp_ntz", "date"])
@pytest.mark.parametrize("nearest", [joins.nearest_containing, joins.nearest_in_crowd])
def test_nearest_containing_against_all_pairs(spark, kind, nearest):
    rng = random.Random(8)
    base = dt.datetime(1969, 12, 20)
    when = (lambda: base + dt.timedelta(minutes=rng.randrange(900 * 1440))) if kind != "date" else (lambda: (base + dt.timedelta(days=rng.randrange(900))).date())
    spans = []
    for i in range(500):  # one key holds most, with many long spans over each other; one never closes
        begin = when()
        long = dt.timedelta(days=rng.choice([0, 0, 1, 3, 20, 300, 2000]), minutes=0 if kind == "date" else rng.randrange(1440))
        spans.append((i, "hot" if i % 3 else rng.choice(["a", "b", None]), begin, begin + long))
    spans.append((900, "a", when(), dt.datetime(9999, 1, 1) if kind != "date" else dt.date(9999, 1, 1)))
    spans.append((901, "hot", spans[1][2], spans[1][3]))
    asks = [(i, rng.choice(["hot", "hot", "a", "b", None, "x"]), when()) for i in range(400)] + [(1000 + i, "hot", s[2]) for i, s in enumerate(spans[:50])]
    left = spark.createDataFrame(asks, f"ask long, k string, t {kind}")
    right = spark.createDataFrame(spans, f"span long, k string, s {kind}, e {kind}")
    got = {r.ask: (r["span"], r["_off"], r["_stay"]) for r in nearest(left, "ask", right, ["k"], "t", "s", "e", "span", "24 hours" if kind != "date" else "1 day").collect()}
    want, date = {}, lambda t: t.date() if isinstance(t, dt.datetime) else t
    for ask, k, t in asks:
        held = [(abs((date(t) - date(s)).days), -int((e - s).total_seconds()), i) for i, key, s, e in spans if k and key == k and s - dt.timedelta(hours=24) <= t <= e]
        if held:
            off, short, i = min(held)
            want[ask] = (i, off, -short)
    assert got == want and len(want) > 300


def test_covering_nodes(spark):
    for low, high in ((0, 0), (-5, 70), (3, 2), (1, 4**5), (-1000, 300_000), (17, 17)):
        nodes = spark.range(1).select(joins.covering_nodes(F.lit(low), F.lit(high)).alias("n")).first().n
        days = sorted(d for n in nodes if n.level < 7 or high < 300_000 for d in range(n.node * 4**n.level, (n.node + 1) * 4**n.level)) if high < 300_000 else None
        if days is not None:
            assert days == list(range(low, high + 1))
        assert sum(4**n.level for n in nodes) == max(0, high - low + 1) and len(nodes) <= 6 * joins.LEVELS + 20


def test_top_ancestors_of_deep_lines_and_cycles(spark):
    edges = [(i, i - 1) for i in range(1, 71)] + [(200, 201), (201, 202), (202, 200), (203, 200), (300, 300), (5, 9), (None, 1), (400, None)]
    got = {r.node: (r.top, r.depth, r.cyclic) for r in joins.top_ancestors(spark.createDataFrame(edges, "c long, p long"), "c", "p").collect()}
    want = {i: (0, i, False) for i in range(1, 71)} | {i: (None, None, True) for i in (200, 201, 202, 203, 300)}
    assert got == want
    assert joins.top_ancestors(spark.createDataFrame([], "c long, p long"), "c", "p").collect() == []


def test_only_rows_after_the_first_new_one_are_numbered_again(spark):
    rng = random.Random(17)
    rows = [(i, rng.choice(["hot"] * 4 + ["x", "y", None]), rng.choice(["p", "q", None]), rng.choice([None, *range(40)])) for i in range(400)]
    schema, order = "id int, k string, a string, t int", ["t", "id"]
    numbers = {"in_k": ["k"], "in_a": ["k", "a"]}

    def numbered(df):
        for out, keys in numbers.items():
            df = ordered.sequence(df, keys, order, out)
        return df

    want = {tuple(r) for r in numbered(spark.createDataFrame(rows, schema)).collect()}
    fresh = [r for r in rows if (r[1] == "hot" and r[3] is not None and r[3] > 25 and r[0] % 3 == 0) or (r[1] == "y" and r[2] == "p") or (r[1] is None and r[0] % 2)]
    stored = materialise(numbered(spark.createDataFrame([r for r in rows if r not in fresh], schema)))
    stay, write = ordered.extend_sequences(stored, spark.createDataFrame(fresh, schema), order, numbers)
    stay, write = [tuple(r) for r in stay.collect()], [tuple(r) for r in write.collect()]
    assert len(stay) + len(write) == len(rows) and {*stay, *write} == want
    assert {r[:4] for r in fresh} <= {r[:4] for r in write}
    assert {r for r in want if r[1] == "x"} <= {*stay}
    assert {r for r in want if r[1] == "hot" and (r[3] is None or r[3] < 25)} <= {*stay}
    kept, changed = ordered.extend_sequences(stored, spark.createDataFrame([], schema), order, numbers)
    assert kept.count() == stored.count() and changed.count() == 0
    kept, changed = ordered.extend_sequences(stored.limit(0), spark.createDataFrame(rows, schema), order, numbers)
    assert kept.count() == 0 and {tuple(r) for r in changed.collect()} == want


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_spans_of_keys_with_few_of_them_are_shuffled_once_each(spark):
    """Open spans would take a row for each bucket up to the last event."""
    day = lambda n: dt.date(2000, 1, 1) + dt.timedelta(days=n)
    spans = [(i, i % 40, day(i), dt.date(9999, 12, 31) if i % 2 else day(i + 5)) for i in range(200)]
    asks = [(i, i % 45 if i % 45 != 44 else None, day(i * 9 % 3000)) for i in range(300)]
    l = spark.createDataFrame(asks + asks[:20], "id long, k int, d date")
    s = spark.createDataFrame(spans, "sid long, k int, a date, b date")
    for how in ("left", "inner"):
        out = joins.join_interval(l, s, ["k"], "d", "a", "b", width_days=8, how=how)
        assert "Generate" not in plan_of(out)
        want = sorted((i, x[0] if x else -1) for i, k, d in asks + asks[:20] for x in [x for x in spans if x[1] == k and x[2] <= d <= x[3]] or ([None] if how == "left" else []))
        assert sorted((r.id, -1 if r.sid is None else r.sid) for r in out.collect()) == want
    near = joins.nearest_containing(l, "id", s, ["k"], "d", "a", "b", "sid", "1 day")
    assert "Generate" not in plan_of(near)
    want = []
    for i, k, d in asks + asks[:20]:
        held = [(abs((d - a).days), (a - b).days, sid) for sid, key, a, b in spans if key == k and a - dt.timedelta(days=1) <= d <= b]
        want += [(i, min(held)[2])] if held else []
    assert sorted((r.id, r.sid) for r in near.collect()) == sorted(want)


def test_keys_with_many_spans_are_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(joins, "CROWD", 5)
    d = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    spans = [(i, "many" if i % 4 else "few", d(i), d(i + 30)) for i in range(20)] + [(99, None, d(0), d(9))]
    asks = [(i, ("many", "few", "none", None)[i % 4], d(i)) for i in range(60)]
    l, s = spark.createDataFrame(asks, "id long, k string, d date"), spark.createDataFrame(spans, "sid long, k string, a date, b date")
    out = joins.join_interval(l, s, ["k"], "d", "a", "b", width_days=4, how="left")
    assert out.columns == ["id", "k", "d", "sid", "a", "b"] and "Generate" in plan_of(out)
    want = sorted((i, x) for i, k, day in asks for x in [sid for sid, key, a, b in spans if key and key == k and a <= day <= b] or [-1])
    assert sorted((r.id, -1 if r.sid is None else r.sid) for r in out.collect()) == want


def test_ancestors_are_joined_without_the_driver(spark):
    out = joins.top_ancestors(spark.createDataFrame([(i, i // 2) for i in range(1, 60)], "c long, p long"), "c", "p")
    assert {r.node: r.top for r in out.collect()} == {i: 0 for i in range(1, 60)}
    assert "BroadcastExchange" not in plan_of(out)  # as it ran
