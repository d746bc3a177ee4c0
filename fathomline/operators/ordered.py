"""Ordered operators that never need the rows of a hot key in one task.

A plain window by key puts all rows of a key into one task. That is right for keys that fit, and wrong for a key that
holds a third of the table. So the rows of keys above HOT_ROWS rows are cut into splits by their own distribution: sorted
into ranges of (key, order) of about SPLIT_ROWS rows and written, each with the number of its split. However many rows share a day
or an hour, no split holds more than its range. Rows are windowed per (key, split); one small summary row per split is
carried across the splits of the key by prefix sums (or maxima, or edges) and joined back. A number over the whole table
works the same way with the table as one key.

Which bounds Spark's sample gives decides what a task holds and not the answer: a row is stored with its split, so summary and rows
agree whatever is run again. Whether a key is hot is found when the frame is built, by a count that combines before its
shuffle; without hot keys what is left is the plain window, and nothing is written.

Orders should end in a unique column; rows that tie stay in one split. Inputs are read for the count and for the
rows: write an expensive one first with `session.materialise`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.operators.keys import null_safe
from fathomline.session import materialise

HOT_ROWS = 1_000_000  # rows of one key that a task takes without being split
SPLIT_ROWS = 1_000_000  # rows of a split

SPAN = "_span"  # (key, split): never NULL itself, so equality on it is NULL-safe; the split is NULL for a key that fits
HASH = "_hash"  # of the span: sorts fast, where a struct alone sorts slowly
HOT = "_hot"
BEFORE = (Window.unboundedPreceding, -1)
AFTER = (1, Window.unboundedFollowing)

Exprs = dict[str, Column]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_splits(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], rows: int, out: str) -> DataFrame:
    """df, written in ranges of (key, order) of about SPLIT_ROWS rows each, with the number of its range in `out`; `rows` is how many df has."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(max(least, -(-rows // SPLIT_ROWS)), *keys, *order)
    return materialise(cut.withColumn(out, F.spark_partition_id()), "splits")


def spans(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """df with its (key, split) column and a mark on the rows of hot keys. With no keys the table is one hot key."""
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    if keys:
        counts = df.groupBy(key.alias("_hot_key")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_ROWS)
        rows = counts.agg(F.sum("_n")).first()[0]
        if rows:
            hot = materialise(counts.select("_hot_key"), "hot-keys")  # rows of the table / HOT_ROWS at most
            of_hot = key == F.col("_hot_key")
            cut = range_splits(df.join(hot, of_hot, "left_semi"), keys, order, rows, "_split").withColumn(HOT, F.lit(True))
            rest = df.join(hot, of_hot, "left_anti").withColumns({"_split": F.lit(None).cast("int"), HOT: F.lit(False)})
            marked = cut.unionByName(rest)
        else:
            marked = df.withColumns({"_split": F.lit(None).cast("int"), HOT: F.lit(False)})
    else:
        marked = range_splits(df, [], order, df.count(), "_split").withColumn(HOT, F.lit(True))
    spanned = marked.withColumn(SPAN, F.struct(key.alias("k"), F.col("_split").alias("c"))).drop("_split")
    return spanned.withColumn(HASH, F.xxhash64(SPAN))


def release(df: DataFrame) -> DataFrame:
    """df without the columns made by spans."""
    return df.drop(SPAN, HASH, HOT)


def _sorted(order: Sequence[Column | str], descending: bool) -> list[Column]:
    return [(F.col(o).desc() if descending else F.col(o).asc()) if isinstance(o, str) else o for o in order]


def _across(descending: bool = False):
    split = F.col(f"{SPAN}.c")
    return Window.partitionBy(F.col(f"{SPAN}.k")).orderBy(split.desc() if descending else split.asc())


AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(kind: str, local: Column, carry: Column) -> Column:
    if kind == "sum":
        return F.when(local.isNull(), carry).when(carry.isNull(), local).otherwise(local + carry)
    return F.greatest(local, carry) if kind == "max" else F.least(local, carry)


def scan_spans(
    df: DataFrame,
    order: Sequence[Column | str],
    measures: dict[str, tuple[str, Column]] | None = None,
    before: Exprs | None = None,
    after: Exprs | None = None,
    current: bool = True,
    descending: bool = False,
) -> DataFrame:
    """One ordered pass over a df that already has its spans.

    measures: running sum, max or min over the rows so far (`current` includes the row itself).
    before, after: values of the previous and of the next row of the key. Everything shares one window
    sort and one summary, however much is asked for.
    """
    measures, before, after = measures or {}, before or {}, after or {}
    line = Window.partitionBy(HASH, SPAN).orderBy(*_sorted(order, descending))
    frame = line.rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    across = _across(descending)
    local = {f"_l_{out}": AGG[kind](e).over(frame) for out, (kind, e) in measures.items()}
    totals = [AGG[kind](e).alias(out) for out, (kind, e) in measures.items()]
    carried = [AGG[kind](out).over(across.rowsBetween(*BEFORE)).alias(f"_c_{out}") for out, (kind, _) in measures.items()]
    results = [_combine(kind, F.col(f"_l_{out}"), F.col(f"_c_{out}")).alias(out) for out, (kind, _) in measures.items()]
    place = F.struct(*order)
    last_in_split, first_in_split = (F.min_by, F.max_by) if descending else (F.max_by, F.min_by)
    for values, name, step, edge in ((before, "_before", F.lag, last_in_split), (after, "_after", F.lead, first_in_split)):
        if values:
            row = F.struct(*[e.alias(v) for v, e in values.items()])
            local[f"_l{name}"] = step(row).over(line)
            totals.append(edge(row, place).alias(name))
            carried.append(step(name).over(across).alias(f"_c{name}"))
            near = F.coalesce(f"_l{name}", f"_c{name}")
            results += [near[v].alias(v) for v in values]
    summary = df.filter(HOT).groupBy(HASH, SPAN).agg(*totals).select(HASH, SPAN, *carried)
    made = {*measures, *before, *after}
    return df.withColumns(local).join(summary, [HASH, SPAN], "left").select(*[c for c in df.columns if c not in made], *results)


def scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], **asked) -> DataFrame:
    """One ordered pass per key; see scan_spans for what can be asked for."""
    return release(scan_spans(spans(df, keys, order), order, **asked))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    measures: dict[str, tuple[str, Column]],
    current: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Running sum, max or min per key, with or without the current row."""
    return scan(df, keys, order, measures=measures, current=current, descending=descending)


def sequence(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], out: str, where: Column | None = None, descending: bool = False
) -> DataFrame:
    """Sequence number per key (over the whole table with no keys). With `where` only the rows
    that meet it are numbered and the others get NULL."""
    counted = F.lit(1) if where is None else F.when(where, 1).otherwise(0)
    numbered = running(df, keys, order, {out: ("sum", counted.cast("long"))}, descending=descending)
    return numbered if where is None else numbered.withColumn(out, F.when(where, F.col(out)))


def extend_sequences(
    stored: DataFrame, fresh: DataFrame, order: Sequence[str], numbers: Mapping[str, Sequence[str]]
) -> tuple[DataFrame, DataFrame]:
    """New rows for a table that is numbered already: (rows that keep their numbers, rows with a new one).

    `numbers` gives, per stored number column, the keys that it counts in; fresh has the other columns of stored. In a key that
    gets new rows, those from its first new row on are numbered again, from the last number before; all other rows of the
    table are only compared with that place, not ordered. Together both parts are what numbering the whole table would give,
    and the second is what a load has to write. Keys and orders may be NULL (first in order); the order ends in a unique column.
    """
    place, marked = F.struct(*order), stored
    fresh = materialise(fresh.select(*[c for c in stored.columns if c not in numbers]), "fresh")
    for out, keys in numbers.items():
        cuts = fresh.groupBy(*keys).agg(F.min(place).alias(f"_cut_{out}"))
        marked = marked.alias("s").join(cuts.alias("c"), null_safe("s", "c", keys), "left").select("s.*", f"c._cut_{out}")
    before = {out: F.coalesce(place < F.col(f"_cut_{out}"), F.lit(True)) for out in numbers}
    same = reduce(lambda a, b: a & b, before.values())
    held = {out: F.when(before[out], F.col(out)).alias(f"_held_{out}") for out in numbers}
    moved = marked.filter(~same).select(*fresh.columns, *held.values())
    rows = materialise(moved.unionByName(fresh, allowMissingColumns=True), "moved")
    for out, keys in numbers.items():
        last = marked.filter(place < F.col(f"_cut_{out}")).groupBy(*keys).agg(F.max(out).alias("_last"))
        numbered = sequence(rows, keys, order, "_next", where=F.col(f"_held_{out}").isNull())
        joined = numbered.alias("n").join(last.alias("l"), null_safe("n", "l", keys), "left")
        number = F.coalesce(f"n._held_{out}", F.coalesce("l._last", F.lit(0)) + F.col("n._next"))
        rows = joined.select(*[f"n.{c}" for c in rows.columns], number.cast(stored.schema[out].dataType).alias(out))
    return marked.filter(same).select(*stored.columns), rows.select(*stored.columns)


def global_sequence(df: DataFrame, order: Sequence[Column | str], out: str) -> DataFrame:
    """Row number over the whole table without a single sorting task: only the counts of splits meet."""
    return sequence(df, [], order, out)


def previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Exprs) -> DataFrame:
    """Values of the previous row of the key."""
    return scan(df, keys, order, before=values)


def following(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Exprs) -> DataFrame:
    """Values of the next row of the key."""
    return scan(df, keys, order, after=values)


def gap_since_previous(df: DataFrame, keys: Sequence[str], order: Sequence[str], t: str, out: str) -> DataFrame:
    """Days since the previous row of the key."""
    with_prev = previous(df, keys, order, {"_prev_t": F.col(t)})
    return with_prev.withColumn(out, F.datediff(t, "_prev_t")).drop("_prev_t")


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """The value of the row itself if present, else the next non-NULL one of the key."""
    g = spans(df, keys, order)
    ahead = Window.partitionBy(HASH, SPAN).orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    local = g.withColumn("_near", F.first(value, ignorenulls=True).over(ahead))
    summary = g.filter(HOT).groupBy(HASH, SPAN).agg(F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_first"))
    carried = summary.select(HASH, SPAN, F.first("_first", ignorenulls=True).over(_across().rowsBetween(*AFTER)).alias("_far"))
    kept = [c for c in df.columns if c != out]
    return local.join(carried, [HASH, SPAN], "left").select(*kept, F.coalesce("_near", "_far").alias(out))


def dense_rank_per_key(df: DataFrame, keys: Sequence[str], value: str, out: str, descending: bool = False) -> DataFrame:
    """Dense rank of a value within its key: distinct values are numbered, then joined back."""
    values = df.select(*keys, value).distinct()
    ranks = sequence(values, keys, [value], out, descending=descending)
    return _join_rank(df, ranks, [*keys, value], out)


def rank_per_key(df: DataFrame, keys: Sequence[str], value: str, out: str, descending: bool = False) -> DataFrame:
    """Rank with gaps: one more than the number of rows with a smaller value."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    below = running(counts, keys, [value], {out: ("sum", F.col("_n"))}, current=False, descending=descending)
    return _join_rank(df, below.withColumn(out, F.coalesce(out, F.lit(0)) + 1), [*keys, value], out)


def _join_rank(df: DataFrame, ranks: DataFrame, on: Sequence[str], out: str) -> DataFrame:
    return df.alias("d").join(ranks.alias("r"), null_safe("d", "r", on)).select("d.*", F.col(f"r.{out}"))


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str], breaks_after: Callable[[Column, Column], Column], t: str) -> DataFrame:
    """Gaps and islands. `breaks_after(prev, this)` says whether a new island starts between two
    neighbouring times. Gives keys, island (numbered per key), start_time, end_time, events.

    Islands are built inside each span. Those of keys that fit are final; of a hot key the edges of its splits are
    compared and islands that go on are put together.
    """
    g = spans(df.select(*keys, *dict.fromkeys([*order, t])), keys, order)
    frame = Window.partitionBy(HASH, SPAN).orderBy(*order)
    prev = F.lag(t).over(frame)

    def local(rows: DataFrame) -> DataFrame:
        marked = rows.withColumn("_start", F.when(prev.isNull() | breaks_after(prev, F.col(t)), 1).otherwise(0))
        marked = marked.withColumn("_no", F.sum("_start").over(frame.rowsBetween(Window.unboundedPreceding, 0)))
        return marked.groupBy(HASH, SPAN, "_no").agg(F.min(t).alias("start_time"), F.max(t).alias("end_time"), F.count(F.lit(1)).alias("events"))

    pieces = local(g.filter(F.col(HOT)))
    summary = pieces.groupBy(HASH, SPAN).agg(F.count(F.lit(1)).alias("_n"), F.min("start_time").alias("_lo"), F.max("end_time").alias("_hi"))
    before = F.lag("_hi").over(_across())
    linked = summary.withColumn("_joins", F.when(before.isNull() | breaks_after(before, F.col("_lo")), 0).otherwise(1))
    offset = F.coalesce(F.sum("_n").over(_across().rowsBetween(*BEFORE)), F.lit(0)) - F.sum("_joins").over(
        _across().rowsBetween(Window.unboundedPreceding, 0)
    )
    numbered = pieces.join(linked.select(HASH, SPAN, offset.alias("_offset")), [HASH, SPAN]).withColumn("island", F.col("_no") + F.col("_offset"))
    joined = numbered.groupBy(F.col(f"{SPAN}.k").alias("_k"), "island").agg(
        F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.sum("events").alias("events")
    )
    final = local(g.filter(~F.col(HOT))).select(F.col(f"{SPAN}.k").alias("_k"), F.col("_no").alias("island"), "start_time", "end_time", "events")
    return final.unionByName(joined).select(*[F.col(f"_k.{k}").alias(k) for k in keys], "island", "start_time", "end_time", "events")
