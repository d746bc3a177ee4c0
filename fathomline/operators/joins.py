"""Join composites: lookups, intervals, as-of, nearest, waterfalls, hierarchies."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.dates import diff_boundary
from fathomline.operators.keys import latest_per_key, null_safe, shuffled_apart
from fathomline.operators.ordered import scan
from fathomline.session import materialise


def checked_broadcast(df: DataFrame, max_bytes: int = 10 << 20) -> DataFrame:
    """df with a broadcast hint only if the optimiser puts its size at max_bytes or less. No job runs: the size is that of the
    plan's statistics, which take filters and joins at their widest. Beyond it the join is left to the optimiser and AQE."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return F.broadcast(df) if int(str(size)) <= max_bytes else df


def lookup(df: DataFrame, ref: DataFrame, on: Sequence[str], cols: Sequence[str], defaults: dict[str, object] | None = None) -> DataFrame:
    """Left join of reference columns, with default labels for missing ones. `ref` must be unique on `on`."""
    joined = df.join(ref.select(*on, *cols), list(on), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})


def outer_align(inputs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of several results by shared keys. Inputs grouped by the keys keep their partitioning."""
    return reduce(lambda a, b: a.join(b, list(keys), "full"), inputs)


def densify(df: DataFrame, keys: Sequence[str], period: str, low: Column, high: Column, values: Sequence[str], step: str = "1 month") -> DataFrame:
    """One row per key and period between two bounds, with 0 where there was none.

    The grid comes from a generated sequence per key, not from a product of two tables.
    """
    grid = df.select(*keys).distinct().withColumn(period, F.explode(F.sequence(low, high, F.expr(f"interval {step}"))))
    joined = grid.join(df, [*keys, period], "left")
    return joined.select(*keys, period, *[F.coalesce(F.col(v), F.lit(0)).alias(v) for v in values])


def densify_spans(df: DataFrame, entity: Sequence[str], detail: Sequence[str], period: str, values: Sequence[str], step: str = "1 month") -> DataFrame:
    """One row per entity, detail and period from the entity's own first to its own last period, with 0 where there was none.

    df: one row per entity, detail and period. The spans come from one aggregate, the periods from a generated sequence, so the grid
    grows with the time that each entity was active and not with entities times all periods. Keys may be NULL.
    """
    keys = [*entity, *detail]
    spans = df.groupBy(*entity).agg(F.min(period).alias("_lo"), F.max(period).alias("_hi"))
    kinds = df.select(*keys).distinct().alias("k")
    own = kinds.join(spans.alias("s"), null_safe("k", "s", entity)).select("k.*", F.explode(F.sequence("_lo", "_hi", F.expr(f"interval {step}"))).alias(period))
    joined = own.alias("g").join(df.alias("d"), null_safe("g", "d", [*keys, period]), "left")
    return joined.select(*[f"g.{c}" for c in (*keys, period)], *[F.coalesce(f"d.{v}", F.lit(0)).alias(v) for v in values])


CROWD = 256  # spans of one key with which each of its rows is compared


def crowded_keys(intervals: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The keys of more than CROWD intervals, written; None if there are none. The count is made when the frame is built and combines
    before its shuffle; keys are at most the intervals / CROWD."""
    counts = intervals.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CROWD)
    crowded = materialise(counts.select(*keys), "crowded-keys")
    return None if crowded.isEmpty() else crowded


def _joined(events: DataFrame, spans: DataFrame, keys: Sequence[str], also: Sequence[str], t: str, start: str, end: str, how: str) -> DataFrame:
    """Events with the spans that hold them, of equal keys and of equal `also`."""
    on = reduce(lambda a, b: a & b, [F.col(f"e.{k}") == F.col(f"s.{k}") for k in (*keys, *also)])
    inside = F.col(f"e.{t}").between(F.col(f"s.{start}"), F.col(f"s.{end}"))
    joined = events.alias("e").join(spans.filter(F.col(start) <= F.col(end)).alias("s"), on & inside, how)
    payload = [c for c in spans.columns if c not in (*keys, *also)]
    return joined.select(*[F.col(f"e.{c}") for c in events.columns], *[F.col(f"s.{c}") for c in payload])


def join_interval(
    events: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    t: str,
    start: str,
    end: str,
    width_days: int = 1,
    how: str = "inner",
    event_id: str | None = None,
) -> DataFrame:
    """Events with the spans of the same key that contain them: start <= t <= end.

    A key with up to CROWD spans is joined as it is, so each event and span is shuffled once, however long the span. Spans of a key
    that has more (`crowded_keys`) are listed under every bucket of `width_days` they touch, and each event of it under one, so
    that the equi-join runs on (key, bucket): a crowded key is spread over its buckets, and only neighbours are compared. Spans are
    listed from the first to the last event only, so one that never closes costs no more than the time the events cover.
    In a left join unmatched events come back with NULL spans.
    """
    crowded = crowded_keys(intervals, keys)
    if crowded is None:
        return _joined(events, intervals, keys, [], t, start, end, how)
    rest = (df.join(crowded, list(keys), "left_anti").select(*df.columns) for df in (events, intervals))
    few = _joined(*rest, keys, [], t, start, end, how)
    events, intervals = (df.join(crowded, list(keys), "left_semi").select(*df.columns) for df in (events, intervals))

    def bucket(d: Column) -> Column:
        return F.floor(F.datediff(d.cast("date"), F.lit("1970-01-01").cast("date")) / width_days)

    low, high = (events.agg(bucket(extreme(t))).scalar() for extreme in (F.min, F.max))
    bounded = intervals.filter(F.col(start) <= F.col(end)).withColumns(
        {"_low": F.greatest(bucket(F.col(start)), low), "_high": F.least(bucket(F.col(end)), high)}
    )
    touched = F.when(low.isNotNull() & (F.col("_low") <= F.col("_high")), F.sequence("_low", "_high"))
    listed = bounded.withColumn("_bucket", F.explode(touched)).drop("_low", "_high")
    placed = events.withColumn("_bucket", bucket(F.col(t)))
    many = _joined(placed, listed, keys, ["_bucket"], t, start, end, how).drop("_bucket")
    return few.unionByName(many)


def effective_at(df: DataFrame, start: str, end: str, at: Column) -> DataFrame:
    """Rows in force at a date; an open bound is unlimited."""
    begun = F.col(start).isNull() | (F.col(start) <= at)
    going = F.col(end).isNull() | (F.col(end) >= at)
    return df.filter(begun & going)


def asof_max(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_t: str,
    right_t: str,
    measures: dict[str, Column],
    strict: bool = True,
) -> DataFrame:
    """Left rows with maxima over all right rows of the key that came before.

    Both sides go through one union and one running maximum, so the cost is linear: no pair is ever formed. A maximum of structs that start with the time is the last event before.
    """
    cols = left.columns
    row = F.struct(*[F.col(c) for c in cols])
    l = left.select(*keys, F.col(left_t).alias("_t"), F.lit(0 if strict else 1).alias("_side"), row.alias("_row"))
    r = right.filter(F.col(right_t).isNotNull()).select(
        *keys, F.col(right_t).alias("_t"), F.lit(1 if strict else 0).alias("_side"), *[e.alias(m) for m, e in measures.items()]
    )
    both = l.unionByName(r, allowMissingColumns=True)
    seen = scan(both, keys, ["_t", "_side"], measures={m: ("max", F.col(m)) for m in measures})
    return seen.filter(F.col("_row").isNotNull()).select("_row.*", *measures)


def asof_last(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: str, right_t: str, right_id: str, cols: Sequence[str], strict: bool = True
) -> DataFrame:
    """Left rows with the last right row of the key before (or, not strict, at) their time.

    Of right rows at the same time the highest id counts. A NULL key has no history.
    """
    last = F.struct(F.col(right_t).alias("_when"), F.col(right_id).alias("_id"), *[F.col(c) for c in cols])
    known = right.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    out = asof_max(left, known, keys, left_t, right_t, {"_last": last}, strict)
    return out.select(*left.columns, F.col("_last._when").alias(right_t), F.col("_last._id").alias(right_id), *[F.col(f"_last.{c}").alias(c) for c in cols])


def nearest_before(left: DataFrame, right: DataFrame, keys: Sequence[str], left_t: str, right_t: str, right_id: str, cols: Sequence[str] = ()) -> DataFrame:
    """Nearest candidate not later than the event. Being not later, the nearest is the last one."""
    return asof_last(left, right, keys, left_t, right_t, right_id, cols, strict=False)


def nearest_containing(
    left: DataFrame, left_id: str, intervals: DataFrame, keys: Sequence[str], at: str, start: str, stop: str, interval_id: str, lead: str, width_days: int = 32
) -> DataFrame:
    """For each left row the interval of its keys that holds its time and starts on the nearest day; then the
    longest, then the smallest id. Gives left_id, interval_id, _off (days), _stay (seconds) for the rows that have one.

    An interval holds the times from `lead` (such as '24 hours') before its start to its stop; dates and timestamps
    both work. Of the intervals of a key with one start only the longest can win. Keys with up to CROWD of them hold these in one
    row, which meets each left row: a left row is shuffled once, and no pair is. For other keys (`crowded_keys`) all left rows of a key and time
    have the same answer: so both sides are first cut to one row per key and time. For dates what is compared is bounded
    by the calendar, however many rows a key has. Where very many intervals of a key overlap, use `nearest_in_crowd`.
    """
    spans = intervals.select(*keys, F.col(start).alias("_start"), F.col(stop).alias("_stop"), F.col(interval_id))
    spans = spans.withColumn("_from", F.col("_start") - F.expr(f"interval {lead}")).filter(F.col("_from") <= F.col("_stop"))
    rows = left.select(left_id, *keys, F.col(at).alias("_at"))
    off, stay = F.abs(F.datediff("_at", "_start")), diff_boundary("second", "_start", "_stop")
    longest = [F.col("_stop").desc(), F.col(interval_id).asc()]

    crowded = crowded_keys(spans, keys)
    few, rest = (df if crowded is None else df.join(crowded, list(keys), "left_anti") for df in (spans, rows))
    # dealt once by a hash of the key, for the choice and for the row of the key; the join deals that row by the key, as `shuffled_apart` would
    few = few.drop("_from").withColumn("_hash", F.xxhash64(*keys)).repartition("_hash")
    few = latest_per_key(few, ["_hash", *keys, "_start"], longest)
    held = F.collect_list(F.struct("_start", "_stop", F.col(interval_id).alias("_id")))
    of_key = few.groupBy("_hash", *keys).agg(held.alias("_held")).drop("_hash")
    holding = F.filter("_held", lambda s: F.col("_at").between(s["_start"] - F.expr(f"interval {lead}"), s["_stop"]))
    scored = F.transform(
        holding, lambda s: F.struct(F.abs(F.datediff("_at", s["_start"])).alias("off"), (-diff_boundary("second", s["_start"], s["_stop"])).alias("short"), s["_id"].alias("id"))
    )
    found = rest.join(of_key, list(keys)).select(left_id, F.array_min(scored).alias("_w")).filter(F.col("_w").isNotNull())
    found = found.select(left_id, F.col("_w.id").alias(interval_id), F.col("_w.off").alias("_off"), (-F.col("_w.short")).alias("_stay"))
    if crowded is None:
        return found

    spans, rows = (df.join(crowded, list(keys), "left_semi") for df in (spans, rows))
    best = latest_per_key(spans, [*keys, "_start"], longest)
    times = rows.select(*keys, "_at").distinct()
    pairs = join_interval(times, best, keys, "_at", "_from", "_stop", width_days)
    scored = pairs.select(*keys, "_at", interval_id, off.alias("_off"), stay.alias("_stay"))
    answer = latest_per_key(scored, [*keys, "_at"], [F.col("_off").asc(), F.col("_stay").desc(), F.col(interval_id).asc()])
    return found.unionByName(rows.join(answer, [*keys, "_at"]).select(left_id, interval_id, "_off", "_stay"))


LEVELS = 8  # of nodes of 4 ** level days; a span of any length is a few nodes of each, and a day lies in one of each


def day_number(t: Column) -> Column:
    return F.datediff(t.cast("date"), F.lit("1970-01-01").cast("date"))


def covering_nodes(low: Column, high: Column) -> Column:
    """The days low to high (inclusive; none if high < low) as the fewest nodes, an array of (level, node): at each level those blocks of 4 ** level days that lie
    inside while the block of the next level around them does not."""

    def blocks(level: int) -> tuple[Column, Column]:
        size = 4**level
        return F.ceil(low / size).cast("int"), (F.floor((high + 1) / size) - 1).cast("int")

    def listed(level: int, first: Column, last: Column) -> Column:
        nodes = F.transform(F.sequence(first, last), lambda n: F.struct(F.lit(level).alias("level"), n.alias("node")))
        return F.when(first <= last, nodes).otherwise(F.array().cast("array<struct<level:int,node:int>>"))

    parts = []
    for level in range(LEVELS):
        first, last = blocks(level)
        if level + 1 == LEVELS:
            parts.append(listed(level, first, last))
            continue
        up_first, up_last = blocks(level + 1)
        above = up_first <= up_last  # some block of the next level lies inside
        parts.append(listed(level, first, F.when(above, F.least(last, 4 * up_first - 1)).otherwise(last)))
        parts.append(listed(level, F.when(above, F.greatest(first, 4 * up_last + 4)).otherwise(last + 1), last))
    return F.concat(*parts)


def nearest_in_crowd(
    left: DataFrame, left_id: str, intervals: DataFrame, keys: Sequence[str], at: str, start: str, stop: str, interval_id: str, lead: str
) -> DataFrame:
    """`nearest_containing` for keys whose intervals overlap by the thousand, such as all spells of a provider: linear there, at
    the price of LEVELS rows for each time asked.

    Intervals are never paired with the times they hold. The days that an interval holds whole are cut into a few
    nodes of growing size, and each node of a key keeps one winner: the last to start, or before the starts the first. A
    time asks the nodes its day lies in, one of each size, and only intervals that begin or end on its day are compared with it. So the
    work grows with the rows, however many intervals of a key overlap. All left rows of a key and time have one answer, and of the intervals
    of a key with one start only the longest can win: both sides are first cut to these."""
    best = latest_per_key(
        intervals.select(*keys, F.col(start).alias("_start"), F.col(stop).alias("_stop"), F.col(interval_id)),
        [*keys, "_start"],
        [F.col("_stop").desc(), F.col(interval_id).asc()],
    ).withColumn("_from", F.col("_start") - F.expr(f"interval {lead}"))
    stay = diff_boundary("second", "_start", "_stop").alias("_stay")
    best = best.filter(F.col("_from") <= F.col("_stop")).select(
        *keys, interval_id, "_from", "_stop", day_number(F.col("_start")).alias("_begun"), day_number(F.col("_from")).alias("_low"), day_number(F.col("_stop")).alias("_high"), stay
    )
    # whole days: before the start day the first start is nearest, from it on the last
    ahead = covering_nodes(F.col("_low") + 1, F.least(F.col("_high") - 1, F.col("_begun") - 1))
    since = covering_nodes(F.greatest(F.col("_low") + 1, F.col("_begun")), F.col("_high") - 1)
    sided = F.array(F.struct(F.lit(1).alias("_side"), ahead.alias("_nodes")), F.struct(F.lit(-1).alias("_side"), since.alias("_nodes")))
    covered = best.select(*keys, interval_id, "_begun", "_stay", F.inline(sided)).select(*keys, interval_id, "_begun", "_stay", "_side", F.inline("_nodes"))
    place = [*keys, "level", "node"]
    winner = F.min(F.struct((F.col("_side") * F.col("_begun")).alias("_near"), (-F.col("_stay")).alias("_short"), F.col(interval_id))).alias("_w")
    winners = covered.groupBy(*place, "_side").agg(winner)
    winners = winners.select(*place, (F.col("_side") * F.col("_w._near")).alias("_begun"), F.col("_w._short").alias("_short"), F.col(f"_w.{interval_id}").alias(interval_id))

    times = left.select(*keys, F.col(at).alias("_at")).distinct().withColumn("_day", day_number(F.col("_at")))
    nodes = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright("_day", 2 * n).alias("node")) for n in range(LEVELS)])
    asked = times.select(*keys, "_at", "_day", F.inline(nodes))
    answer = [*keys, "_at", F.abs(F.col("_day") - F.col("_begun")).alias("_off"), "_short", interval_id]
    inside = asked.join(shuffled_apart(winners, place), place).select(*answer)
    # days held in part: those on which an interval begins or ends
    edges = best.withColumn("_day", F.explode(F.array_distinct(F.array("_low", "_high")))).withColumn("_short", -F.col("_stay"))
    partly = times.join(edges, [*keys, "_day"]).filter(F.col("_at").between(F.col("_from"), F.col("_stop"))).select(*answer)
    chosen = inside.unionByName(partly).groupBy(*keys, "_at").agg(F.min(F.struct("_off", "_short", interval_id)).alias("_w"))
    chosen = chosen.select(*keys, "_at", F.col(f"_w.{interval_id}").alias(interval_id), F.col("_w._off").alias("_off"), (-F.col("_w._short")).alias("_stay"))
    rows = left.select(left_id, *keys, F.col(at).alias("_at"))
    return rows.join(shuffled_apart(chosen, [*keys, "_at"]), [*keys, "_at"]).select(left_id, interval_id, "_off", "_stay")


def first_pass(left_id: str, passes: Sequence[DataFrame], order: Sequence[Column | str]) -> DataFrame:
    """The choice of `waterfall_link`: one candidate, with its `pass_no`, for each left_id that has any."""
    tagged = [rows.withColumn("pass_no", F.lit(number)) for number, rows in enumerate(passes, 1)]
    return latest_per_key(reduce(lambda a, b: a.unionByName(b), tagged), [left_id], [F.col("pass_no").asc(), *order])


def waterfall_link(left: DataFrame, left_id: str, passes: Sequence[DataFrame], order: Sequence[Column | str]) -> DataFrame:
    """Link in passes: the first pass with a candidate decides, and there the best one by `order`.

    Each pass gives candidate rows (left_id plus candidate columns). All passes go into one union and one choice per
    row, limited before the shuffle, so no pass is computed twice. The passes start from `left`: write it first
    (session.materialise) where it is expensive. Column `pass_no` tells which pass linked a row;
    rows that no pass linked stay, with NULLs.
    """
    return left.join(first_pass(left_id, passes, order), left_id, "left")


def prefix_lookup(df: DataFrame, ref: DataFrame, column: str, ref_column: str, value: str, lengths: Sequence[int] = (7, 6, 5, 4)) -> DataFrame:
    """Value of the full key, else of the key without blanks, else of its prefixes, longest first.

    The reference is folded to one row per form of the key (smallest value wins), so nothing fans out,
    and only the distinct keys of df are looked up.
    """
    text, bare = F.trim(ref_column), F.replace(F.trim(ref_column), F.lit(" "), F.lit(""))
    forms = [(0, text), (1, bare), *[(i, F.when(F.length(bare) >= n, F.left(bare, F.lit(n)))) for i, n in enumerate(lengths, 2)]]
    listed = ref.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_step"), f.alias("_form")) for i, f in forms])), F.col(value).alias("_v"))
    listed = listed.filter(F.col("_form").isNotNull()).groupBy("_step", "_form").agg(F.min("_v").alias("_v"))
    own, own_bare = F.trim(column), F.replace(F.trim(column), F.lit(" "), F.lit(""))
    tries = [(0, own), (1, own_bare), *[(i, F.when(F.length(own_bare) >= n, F.left(own_bare, F.lit(n)))) for i, n in enumerate(lengths, 2)]]
    wanted = df.select(F.col(column).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    asked = wanted.withColumn(column, F.col("_key")).select(
        "_key", F.inline(F.array(*[F.struct(F.lit(i).alias("_step"), f.alias("_form")) for i, f in tries]))
    )
    hits = asked.join(listed, ["_step", "_form"]).groupBy("_key").agg(F.min(F.struct("_step", "_v"))["_v"].alias(value))
    return df.join(shuffled_apart(hits, ["_key"]), F.col(column) == F.col("_key"), "left").drop("_key")


def flatten_hierarchy(nodes: DataFrame, edges: DataFrame, node: str, child: str, parent: str, depth: int) -> DataFrame:
    """Each node with its ancestors level_1 (itself) to level_<depth>, by left self-joins on the edges."""
    out = nodes.select(F.col(node).alias("level_1"))
    for level in range(2, depth + 1):
        step = edges.select(F.col(child).alias(f"level_{level - 1}"), F.col(parent).alias(f"level_{level}"))
        out = out.join(step, f"level_{level - 1}", "left")
    return out.select(*[f"level_{i}" for i in range(1, depth + 1)])


def top_ancestors(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """Every child with the top of its line, however deep: node, top, depth (steps to the top), cyclic.

    Each round joins the pointers to themselves, so they reach twice as far: the rounds are the logarithm of the depth. A line that has
    not ended after more steps than there are edges runs into a cycle: cyclic is true there, and top and depth are NULL. Of several parents
    of a child the lowest counts; rows without a child or parent are no edges. Each round is written, and one flag of it comes to the driver:
    the joins are sort-merge joins, since a broadcast would send all pointers through the driver once a round."""
    spark, turn, reach = edges.sparkSession, 0, 1
    known = edges.filter(F.col(child).isNotNull() & F.col(parent).isNotNull()).groupBy(F.col(child).alias("node")).agg(F.min(parent).alias("top"))
    far = materialise(known.withColumn("depth", F.lit(1).cast("long")), "ancestors-0")
    n, moved = far.count(), True
    while moved and reach <= n:
        turn, reach = turn + 1, 2 * reach
        further = far.select(F.col("node").alias("top"), F.col("top").alias("_next"), F.col("depth").alias("_more"))
        on = shuffled_apart(further, ["top"]).hint("merge")
        far = far.drop("moves").join(on, "top", "left").select(
            "node", F.coalesce("_next", "top").alias("top"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"), F.col("_next").isNotNull().alias("moves")
        )
        far = materialise(far, f"ancestors-{turn}")
        moved = not far.filter("moves").isEmpty()
    # what still points at a node with a parent has no end
    endless = far.join(shuffled_apart(known.select(F.col("node").alias("top"), F.lit(True).alias("_up")), ["top"]).hint("merge"), "top", "left")
    cyclic = F.col("_up").isNotNull()
    return endless.select("node", F.when(~cyclic, F.col("top")).alias("top"), F.when(~cyclic, F.col("depth")).alias("depth"), cyclic.alias("cyclic"))


def redirect_codes(df: DataFrame, column: str, changes: DataFrame, old: str, new: str, out: str) -> DataFrame:
    """The successor of a code where there is one, else the code itself."""
    step = changes.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    return df.join(step, F.col(column) == F.col("_old"), "left").withColumn(out, F.coalesce("_new", column)).drop("_old", "_new")


def enrich(df: DataFrame, ref: DataFrame, on: Sequence[str], cols: Sequence[str], order: Sequence[Column | str], only_null: bool = True) -> DataFrame:
    """Fill (or replace) columns of df from one reference row per key."""
    one = latest_per_key(ref, on, order).select(*on, *[F.col(c).alias(f"_r_{c}") for c in cols])
    joined = df.join(shuffled_apart(one, on), list(on), "left")
    pick = {c: F.coalesce(c, f"_r_{c}") if only_null else F.coalesce(f"_r_{c}", c) for c in cols}
    return joined.select(*[pick[c].alias(c) if c in pick else F.col(c) for c in df.columns])


def value_changes(current: DataFrame, historic: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Attributes whose current and historic values differ: keys, attribute, current_value, historic_value."""

    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias(name)) for c in columns])
        return df.select(*keys, F.inline(pairs))

    both = long(current, "current_value").join(long(historic, "historic_value"), [*keys, "attribute"])
    return both.filter(F.col("current_value") != F.col("historic_value"))


def union_by_domain(df: DataFrame, domain: str, branches: dict[object, tuple[DataFrame, str]], ref_key: str, cols: Sequence[str]) -> DataFrame:
    """Enrich each domain of df through its own reference and key column: one filtered join per branch, united."""
    parts = []
    for value, (ref, key) in branches.items():
        side = ref.select(F.col(ref_key).alias("_k"), *cols)
        parts.append(df.filter(F.col(domain) == value).join(side, F.col(key) == F.col("_k"), "left").drop("_k"))
    return reduce(lambda a, b: a.unionByName(b), parts)
