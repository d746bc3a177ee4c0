"""Audit, login, access and adoption jobs over event logs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.rules import flag
from fathomline.functions.text import after_last, classify_contains, map_codes, nth_item
from fathomline.operators.aggs import concat_ordered, cumulative_from, cumulative_over, last_in_group
from fathomline.operators.joins import asof_max, densify, densify_spans, nearest_before, outer_align
from fathomline.operators.keys import latest_per_key, null_safe, shuffled_apart
from fathomline.operators.ordered import extend_sequences, next_value, rank_per_key, scan, sequence
from fathomline.operators.sessions import merge_sessions_pairwise, rollup_sessions
from fathomline.session import materialise
from fathomline.sources.loads import incremental_by_id, insert_new

def version_chain(versions: DataFrame, record: str, version: str) -> DataFrame:
    """Previous and next version of each record version, and first and last flags."""
    number = F.col(version)
    out = scan(versions, [record], [version], before={"previous_version": number}, after={"next_version": number})
    return out.withColumns(
        {"first_version": flag(F.col("previous_version").isNull()), "last_version": flag(F.col("next_version").isNull())}
    )


def parse_audit(raw: DataFrame, record_kind: str, skipped_actions: Sequence[str]) -> DataFrame:
    """Audit rows of one kind of record with the parts of their compound ids.

    raw: item_id, genus (kind||record), actor (staff|team|role), action, ts, record_name
    """
    kept = raw.filter((F.col("actor") != "System") & ~F.col("action").isin(list(skipped_actions)) & (F.col("record_name") == record_kind))
    return kept.select(
        "item_id",
        F.trim(after_last("genus", "||")).alias("record_id"),
        nth_item("actor", "|", 1).alias("staff_id"),
        nth_item("actor", "|", 2).alias("team_id"),
        nth_item("actor", "|", 3).alias("role"),
        "action",
        "ts",
    )


def load_audit(stored: DataFrame, raw: DataFrame, record_kind: str, skipped_actions: Sequence[str]) -> DataFrame:
    """The stored audit log with the new rows."""
    return insert_new(stored, parse_audit(raw, record_kind, skipped_actions), ["item_id"])


def order_actions(log: DataFrame) -> DataFrame:
    """Number of each action within its record, and within its record and type."""
    order = ["ts", "item_id"]
    out = sequence(log, ["record_id"], order, "overall_order")
    return sequence(out, ["record_id", "action"], order, "type_order")


def extend_log(stored: DataFrame, raw: DataFrame, record_kind: str, skipped_actions: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """New audit rows for a log that `order_actions` has numbered: (rows that stay as stored, rows to write). Late rows are
    put in their place; a record without new rows is not ordered again."""
    fresh = parse_audit(raw, record_kind, skipped_actions).alias("b")
    fresh = fresh.join(stored.select("item_id").alias("t"), null_safe("b", "t", ["item_id"]), "left_anti")
    return extend_sequences(stored, fresh, ["ts", "item_id"], {"overall_order": ["record_id"], "type_order": ["record_id", "action"]})


def team_audit(log: DataFrame, staff: DataFrame, teams: DataFrame, view_action: str) -> DataFrame:
    """Audit rows with staff and team names, without the views that the originator of a record makes on the
    day of its first action.

    staff: staff_id, staff_name; teams: team_id, team_name
    """
    first = log.groupBy("record_id").agg(F.min(F.struct("ts", "item_id", "staff_id")).alias("_first"))
    joined = log.join(shuffled_apart(first, ["record_id"]), "record_id")
    own = (F.col("action") == view_action) & (F.col("staff_id") == F.col("_first.staff_id")) & (F.to_date("ts") == F.to_date("_first.ts"))
    kept = joined.filter(~F.coalesce(own, F.lit(False))).drop("_first")
    return kept.join(staff, "staff_id", "left").join(teams, "team_id", "left")


def device_class(is_mobile: Column, agent: Column) -> Column:
    """Device class from the mobile flag and the browser text; any other text stands for itself."""
    text = F.lower(agent)
    android, phone_like = text.contains("android"), text.contains("mobile")
    # Marks in the browser text and their classes, first match wins
    mobile = (
        F.when(text.contains("iphone"), "iPhone")
        .when(text.contains("ipad"), "iPad")
        .when(android & text.contains("mobile safari"), "Android mobile")
        .when(android & ~phone_like, "Android Tablet")
    )
    desktop = (
        F.when(text.contains("linux") & ~phone_like, "PC")
        .when(text.contains("windows nt"), "PC")
        .when(text.contains("macintosh; intel mac os x"), "iPad")
    )
    return F.coalesce(F.when(is_mobile, mobile).when(~is_mobile, desktop), agent)


def login_sessions(activity: DataFrame, outcomes: DataFrame, teams: DataFrame, direct_domains: Sequence[str]) -> DataFrame:
    """Login rows with device, action type and team, merged one row back.

    activity: item_id, session_id, user_id, org_name, login, logout, agent, is_mobile, domain, success
    outcomes: session_id, outcome (direct, login, failed); teams: org_name, team, postcode
    """
    joined = activity.join(shuffled_apart(outcomes, ["session_id"]), "session_id", "left").join(shuffled_apart(teams, ["org_name"]), "org_name", "left")
    direct = F.col("domain").isin(list(direct_domains)) & (F.col("outcome") == "direct")
    kind = F.when(~F.col("success"), "failed").when(direct, "direct").otherwise("login")
    rows = materialise(joined.withColumns({"device": device_class(F.col("is_mobile"), F.col("agent")), "action_type": kind}), "logins")
    return merge_sessions_pairwise(rows, ["user_id"], "login", "logout", ["login", "item_id"])


def login_totals(sessions: DataFrame, keys: Sequence[str], grain: str) -> DataFrame:
    """Sessions and minutes per day (or day and hour); absorbed rows do not count."""
    return rollup_sessions(sessions.filter("absorbed = 0"), keys, "login", "minutes", grain)


def account_register(accounts: DataFrame, logins: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One login id per account and kind, the latest used.

    accounts: account_id; logins: account_id, kind, login_id, last_used
    """
    wanted = logins.filter(F.col("kind").isin(list(kinds)))
    newest = F.struct("last_used", "login_id")
    slots = [F.max(F.when(F.col("kind") == k, newest))["login_id"].alias(f"{k}_login") for k in kinds]
    return accounts.join(wanted.groupBy("account_id").agg(*slots), "account_id", "left")


def monthly_logins(logins: DataFrame, low: Column, high: Column) -> DataFrame:
    """Per team and month between two months: distinct users and logins, 0 where there were none. logins: team, user_id, ts"""
    per = logins.groupBy("team", F.trunc("ts", "month").alias("month")).agg(
        F.count_distinct("user_id").alias("users"), F.count(F.lit(1)).alias("logins")
    )
    return densify(per, ["team"], "month", low, high, ["users", "logins"])


def assemble_logins(activity: DataFrame, audit: DataFrame) -> DataFrame:
    """Authentication rows with their activity row: by the stored reference, else the nearest login of the same
    user and session that is not later than the activity; audit rows without either stay.

    activity: activity_id, user_id, session_id, login, logout, login_row; audit: audit_id, user_id, session_id, last_login
    """
    details = activity.select("activity_id", "login", "logout")
    referenced = activity.filter(F.col("login_row").isNotNull()).select(F.col("login_row").alias("audit_id"), "activity_id")
    open_rows = activity.filter(F.col("login_row").isNull())
    near = nearest_before(open_rows, audit, ["user_id", "session_id"], "login", "last_login", "audit_id")
    matched = near.filter(F.col("audit_id").isNotNull()).select("audit_id", "activity_id")
    taken = referenced.select("audit_id").distinct()
    links = referenced.unionByName(matched.join(taken, "audit_id", "left_anti"))
    return audit.join(links, "audit_id", "left").join(details, "activity_id", "left")


def close_sessions(rows: DataFrame, user: str, start: str, stop: str, row_id: str) -> DataFrame:
    """Missing logouts take the next one of the user on that day, else the end of the day."""
    dated = rows.withColumn("_day", F.to_date(start))
    filled = next_value(dated, [user, "_day"], [start, row_id], stop, "_next")
    last_second = F.col("_day").cast("timestamp_ntz") + F.expr("interval '23:59:59' hour to second")
    closed = F.when(F.col(user).isNull(), F.col(stop)).otherwise(F.coalesce("_next", last_second))
    return filled.withColumn("closed_logout", closed).drop("_next", "_day")


def link_views(views: DataFrame, sessions: DataFrame) -> DataFrame:
    """Views with a session of the user that holds them, else one that began before and ended on the same day or later.

    Of the sessions begun by the view time, the one that ends last answers both questions, so a running maximum is
    enough. views: view_id, user_id, ts; sessions: session_id, user_id, login, logout
    """
    reach = F.struct(F.col("logout"), F.col("session_id"))
    seen = asof_max(views, sessions.filter("user_id IS NOT NULL AND logout IS NOT NULL"), ["user_id"], "ts", "login", {"_reach": reach}, strict=False)
    inside = F.col("_reach.logout") >= F.col("ts")
    same_day = F.to_date("_reach.logout") >= F.to_date("ts")
    how = F.when(inside, "inside").when(same_day, "same day")
    return seen.withColumns({"session_id": F.when(inside | same_day, F.col("_reach.session_id")), "link": how}).drop("_reach")


def first_of_type(rows: DataFrame, keys: Sequence[str], kind: str, t: str, row_id: str) -> DataFrame:
    """Order of each action within its key and type, and a flag for the first."""
    out = sequence(rows, [*keys, kind], [t, row_id], "type_order")
    return out.withColumn("first_of_type", flag(F.col("type_order") == 1))


def team_activity(log: DataFrame, logins: DataFrame, rules: Sequence[tuple[str, str]], low: Column, high: Column) -> DataFrame:
    """Actions by class and logins, per team and month, dense between two months. log: team, action, ts; logins: team, ts"""
    actions = log.select("team", classify_contains("action", rules, "other").alias("activity"), F.trunc("ts", "month").alias("month"))
    both = actions.unionByName(logins.select("team", F.lit("login").alias("activity"), F.trunc("ts", "month").alias("month")))
    counts = both.groupBy("team", "activity", "month").agg(F.count(F.lit(1)).alias("n"))
    return densify(counts, ["team", "activity"], "month", low, high, ["n"])


def staff_activity(log: DataFrame, logins: DataFrame, teams: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Actions by class and logins, per member of staff, team and month, with 0 for the months in between.

    The months of a member of staff in a team run from the first to the last with any action or login there, so someone who
    left long ago gets no rows for today. staff_start and staff_end are the first and last day of a login there (NULL without one).
    log: staff_id, team_id, action, ts; logins: staff_id, team_id, ts; teams: team_id, team_name, region
    """
    who, month = ["staff_id", "team_id"], F.trunc("ts", "month").alias("month")
    actions = log.select(*who, classify_contains("action", rules, "other").alias("activity"), month)
    both = actions.unionByName(logins.select(*who, F.lit("login").alias("activity"), month))
    counts = materialise(both.groupBy(*who, "activity", "month").agg(F.count(F.lit(1)).alias("total")), "activity")
    dense = densify_spans(counts, who, ["activity"], "month", ["total"])
    held = logins.groupBy(*who).agg(F.to_date(F.min("ts")).alias("staff_start"), F.to_date(F.max("ts")).alias("staff_end"))
    dated = dense.alias("a").join(shuffled_apart(held, who).alias("h"), null_safe("a", "h", who), "left").select("a.*", "h.staff_start", "h.staff_end")
    return dated.join(teams.select("team_id", "team_name", "region"), "team_id", "left")


def team_reference(activity: DataFrame) -> DataFrame:
    """Each team with the first and last month in which anyone did anything. activity: what `staff_activity` gives"""
    acted = F.when(F.col("total") > 0, F.col("month"))
    return activity.groupBy("region", "team_id", "team_name").agg(F.min(acted).alias("team_start"), F.max(acted).alias("last_action"))


def created_and_published(log: DataFrame, create: str, publish: str) -> DataFrame:
    """Records created, and records first published, per team and month: two reports in one table."""

    def report(action: str, name: str) -> DataFrame:
        first = log.filter(F.col("action") == action).groupBy("record_id").agg(F.min(F.struct("ts", "item_id", "team_id")).alias("_f"))
        groups = [F.lit(name).alias("report"), F.col("_f.team_id").alias("team_id"), F.trunc("_f.ts", "month").alias("month")]
        return first.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"))

    return report(create, "created").union(report(publish, "published"))


def never_published(log: DataFrame, publish: str, delete: str) -> DataFrame:
    """Records without any publication, with their last action; deleted ones are told apart."""
    per = log.groupBy("record_id").agg(
        F.max(F.struct("ts", "item_id", "action", "team_id")).alias("_last"), F.max((F.col("action") == publish).cast("int")).alias("_pub")
    )
    last = per.filter("_pub = 0")
    status = F.when(F.col("_last.action") == delete, "deleted").otherwise("draft")
    return last.select("record_id", F.col("_last.action").alias("last_action"), F.col("_last.team_id").alias("team_id"), F.col("_last.ts").alias("last_time"), status.alias("status"))


def service_searches(stored: DataFrame, source: DataFrame, id_col: str) -> DataFrame:
    """Searches above the stored maximum id, with the parts of the actor and a match flag.

    source: <id_col>, actor (staff|team), found (text list), ts
    """
    fresh = incremental_by_id(source, stored, id_col)
    return fresh.withColumns(
        {"staff_id": nth_item("actor", "|", 1), "team_id": nth_item("actor", "|", 2), "matched": flag(F.coalesce(F.length(F.trim("found")), F.lit(0)) > 0)}
    )


def match_rates(searches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Searches, matches and the share of matches."""
    per = searches.groupBy(*keys).agg(F.count(F.lit(1)).alias("searches"), F.sum("matched").alias("matches"))
    return per.withColumn("match_pct", F.round(F.col("matches") * 100.0 / F.col("searches"), 2))


def portal_adoption(
    stored: DataFrame,
    sources: Sequence[tuple[DataFrame, Mapping[str, tuple[str, Column | None]]]],
    first: Column,
    last: Column,
    combined: tuple[str, str],
    run_day: Column,
) -> DataFrame:
    """Cumulative measures per day from several tables, with the sum of two of them; days already stored are not inserted
    again. The run day and the day before it are still filling: their totals are blank, also on stored rows."""
    daily = cumulative_over(sources, first, last)
    a, b = combined
    rows = insert_new(stored, daily.withColumn("combined", F.col(a) + F.col(b)), ["day"])
    settled = F.col("day") < F.date_sub(run_day, 1)
    return rows.withColumns({c: F.when(settled, F.col(c)) for c in rows.columns if c != "day"})


def extend_adoption(
    stored: DataFrame,
    sources: Sequence[tuple[DataFrame, Mapping[str, tuple[str, Column | None]]]],
    last: dt.date,
    combined: tuple[str, str],
    run_day: dt.date,
) -> DataFrame:
    """The adoption table of an earlier run, carried on to `last`: only events after its last settled day are read.

    A stored day counts as settled where its totals are not blank. Those stay as they are and the rest is made again; the run day
    and the day before are blank as in `portal_adoption`."""
    a, b = combined
    rows = cumulative_from(stored.filter(F.col("combined").isNotNull()).drop("combined"), sources, last)
    rows = rows.withColumn("combined", F.col(a) + F.col(b)).select(*stored.columns)
    settled = F.col("day") < F.lit(run_day - dt.timedelta(days=1))
    return rows.withColumns({c: F.when(settled, F.col(c)) for c in rows.columns if c != "day"})


def last_day_per_week(daily: DataFrame) -> DataFrame:
    """The last stored day of each week."""
    weekly = daily.withColumn("week", F.date_trunc("week", "day").cast("date"))
    return last_in_group(weekly, ["week"], ["day"])


def activity_by_month(counts: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Monthly counts of several sources side by side, 0 where a source has none."""
    aligned = outer_align(list(counts.values()), keys)
    return aligned.select(*keys, *[F.coalesce(F.col(name), F.lit(0)).alias(name) for name in counts])


def review_lists(log: DataFrame, owner: DataFrame, actions: Sequence[str]) -> DataFrame:
    """Per record, the days of reviews by its own and by other teams as text lists. owner: record_id, owner_team"""
    days = (
        log.filter(F.col("action").isin(list(actions)))
        .join(shuffled_apart(owner, ["record_id"]), "record_id")
        .select("record_id", "action", F.when(F.col("team_id") == F.col("owner_team"), "own").otherwise("other").alias("side"), F.to_date("ts").alias("day"))
        .distinct()
        .withColumn("text", F.date_format("day", "dd/MM/yyyy"))
    )
    lists = concat_ordered(days, ["record_id", "action", "side"], "text", ["day"], ", ", "days", split=True)
    wide = [
        F.max(F.when((F.col("action") == a) & (F.col("side") == s), F.col("days"))).alias(f"{s}_{a}_days") for s in ("own", "other") for a in actions
    ]
    return lists.groupBy("record_id").agg(*wide)


def extract_history(changes: DataFrame) -> DataFrame:
    """Order of the changes of a record within each day, with gaps for equal minutes. changes: record_id, ts"""
    dated = changes.withColumns({"day": F.to_date("ts"), "change_time": F.date_format("ts", "HH:mm")})
    return rank_per_key(dated, ["record_id", "day"], "change_time", "order_of_change")


def approvals(versions: DataFrame, log: DataFrame, publish: str, staff: DataFrame, teams: DataFrame) -> DataFrame:
    """Who published each version. versions: version_id, record_id; log: version_id, action, ts, item_id, staff_id, team_id"""
    last = latest_per_key(log.filter(F.col("action") == publish), ["version_id"], [F.col("ts").desc(), F.col("item_id").desc()])
    event = last.select("version_id", "staff_id", "team_id", F.col("ts").alias("published"))
    return versions.join(event, "version_id", "left").join(staff, "staff_id", "left").join(teams, "team_id", "left")


def access_log(stored: DataFrame, sources: Sequence[tuple[DataFrame, Mapping[str, str]]]) -> DataFrame:
    """Accesses from the day before the last stored day on, two action vocabularies mapped to one, known rows left out.

    stored and sources: access_id, record_id, user_id, action, ts
    """
    mark = F.date_sub(stored.agg(F.max(F.to_date("ts"))).scalar(), 1)
    parts = []
    for source, actions in sources:
        recent = source.filter(mark.isNull() | (F.col("ts") >= mark.cast("timestamp_ntz")))
        parts.append(recent.withColumn("action", map_codes("action", actions)).filter(F.col("action").isNotNull()).select(*stored.columns))
    return insert_new(stored, reduce(lambda a, b: a.unionByName(b), parts), ["access_id"])
