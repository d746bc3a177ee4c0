"""Mixing sources to target weights, by blocks.

Texts of a source are laid end to end and cut into blocks of a fixed number of words. The mix is a row of slots, dealt into
shards. For each shard the number of slots per source is drawn: whole expected slots first, the rest multinomially (a draw of all
slots would stray from the targets by the root of a source's slots, an eighth where it has sixty). The j-th slot of a source then takes block `perm(j)`, where perm is a keyed permutation (a Feistel network) of the source's block numbers and of
the pass over them; slots and blocks meet in a join on (source, block). Every draw is a hash of seed, shard and source, so a
rerun gives the same mix.

No step holds a source in one task: places come from sums per (source, bucket of documents), blocks are keyed by number.

Defined edge cases: a null or empty text has size 0 and is taken 0 times; the null source is a source, last in order; a
source of size 0 has target 0; an empty table gives an empty mix; repeated rows are rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.session import Stages

WEIGHTS = (5, 2, 1)  # by the order of sources, repeating
MOST = 3  # a source gives at most so many times its size
WORD = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame) -> DataFrame:
    """Words to take per source, from (source, source_size).

    Shares follow the weights. A source whose share exceeds MOST times its size stops there, and the excess is shared by
    weight among the others, until none is above. That fixed point is found at once: sources stop in the order of
    size / weight, so the number that stop is settled by running sums along it."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    below, all_rows = ratio.rowsBetween(Window.unboundedPreceding, -1), ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    w = sizes.withColumn("weight", F.get(weights, ((F.row_number().over(order) - 1) % len(WEIGHTS)).cast("int")))
    # with all earlier ones stopped, what the rest share per unit of weight
    w = w.withColumn("total", F.sum("source_size").over(all_rows)).withColumn(
        "rate",
        (F.col("total") - MOST * F.coalesce(F.sum("source_size").over(below), F.lit(0)))
        / (F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))),
    )
    w = w.withColumn("stops", F.col("rate") * F.col("weight") > MOST * F.col("source_size"))
    # the rate of the first source that does not stop is the rate of all that don't
    final = F.min(F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), "rate"))).over(all_rows)["rate"]
    return w.withColumn("target", F.when(F.col("stops"), F.lit(float(MOST)) * F.col("source_size")).otherwise(final * F.col("weight"))).select(
        "source", "source_size", "target"
    )


def unit(*parts: object) -> Column:
    """A number in [0, 1) that depends on its parts alone."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Positions `index` under keyed permutations of 0 .. size - 1, elementwise: a Feistel network over the least even number of
    bits that holds size, walked on from places at or above size until one below is met. Each is a bijection for every key."""
    bits = np.maximum(np.ceil(np.log2(np.maximum(size, 2).astype(np.float64))).astype(np.uint64), np.uint64(1))
    half = (bits + np.uint64(1)) // np.uint64(2)
    half += (np.uint64(1) << (np.uint64(2) * half)) < size.astype(np.uint64)  # a logarithm just below a whole number
    mask, at, todo = (np.uint64(1) << half) - np.uint64(1), index.astype(np.uint64), np.arange(len(index))
    keys = key.astype(np.int64).view(np.uint64)
    while len(todo):
        h, m, k = half[todo], mask[todo], keys[todo]
        left, right = at[todo] >> h, at[todo] & m
        for r in range(rounds):
            left, right = right, left ^ (_mixed(right ^ _mixed(k + np.uint64(r))) & m)
        at[todo] = (left << h) | right
        todo = todo[at[todo] >= size[todo].astype(np.uint64)]
    return at.astype(np.int64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits, each depending on all of x (odd multipliers wrap around)."""
    for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
    return x ^ (x >> np.uint64(31))


def _permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, size, key = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("at", "blocks", "key"))
        block = pa.array(permuted(at, size, key), pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("source"), batch.column("slot"), batch.column("shard"), block], names=["source", "slot", "shard", "block"])


class Mix:
    """The steps of one mix, each a table."""

    def __init__(self, docs: DataFrame, stages: Stages, block: int = 64, shard: int = 4096, seed: int = 20, buckets: int = 1024):
        self.block, self.shard, self.seed, self.stages = block, shard, seed, stages
        rows = docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(buckets)).cast("int").alias("bucket"),
        )
        self.rows = stages.write(rows, "mix-rows")
        by_bucket = self.rows.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
        earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        self.starts = stages.write(by_bucket.withColumn("start", F.coalesce(F.sum("words").over(earlier), F.lit(0))), "mix-starts")
        sizes = self.starts.groupBy("source").agg(F.sum("words").alias("source_size"))
        blocks = F.ceil(F.col("source_size") / block).cast("long")
        self.sources = stages.write(targets(sizes).withColumn("blocks", blocks), "mix-sources")

    def slots(self) -> DataFrame:
        """(source, slot, shard, block): one row per slot of the mix. A source's slots number at most MOST per block."""
        plan = self.sources.filter(F.col("target") > 0)
        # a source's last block may be short: its slots are counted by the mean length of its blocks
        plan = plan.withColumn("expected", F.col("target") * F.col("blocks") / F.col("source_size"))
        total = F.sum("expected").over(Window.partitionBy())
        plan = plan.withColumn("slots", F.ceil(total)).withColumn("p", F.col("expected") / total)
        shards = F.sequence(F.lit(0), F.floor((F.col("slots") - 1) / self.shard).cast("int"))
        plan = plan.select("source", "blocks", "p", "slots", F.explode(shards).alias("shard"))
        length = F.least(F.lit(self.shard), F.col("slots") - F.col("shard") * self.shard)
        plan = plan.withColumn("n", length).withColumn("whole", F.floor(F.col("p") * F.col("n")).cast("long"))
        plan = plan.withColumn("part", F.col("p") * F.col("n") - F.col("whole"))
        by_shard = Window.partitionBy("shard").orderBy(F.col("source").isNull(), "source")
        every = Window.partitionBy("shard")
        plan = plan.withColumn("left", F.col("n") - F.sum("whole").over(every)).withColumn("parts", F.sum("part").over(every))
        to = F.sum("part").over(by_shard.rowsBetween(Window.unboundedPreceding, 0))
        plan = self.stages.write(plan.withColumn("from", to - F.col("part")), "mix-plan")
        # the rest of a shard, multinomially: each draw falls to the last source that begins at or before it
        begins = plan.select("shard", F.col("from").alias("at"), F.struct("source").alias("source"), F.lit(0).alias("draw"))
        left = plan.groupBy("shard").agg(F.first("left").cast("int").alias("left"), F.first("parts").alias("parts"))
        draws = left.filter("left > 0").select("shard", "parts", F.explode(F.sequence(F.lit(1), F.col("left"))).alias("draw"))
        at = unit(F.lit(self.seed), F.lit("draw"), F.col("shard"), F.col("draw")) * F.col("parts")
        draws = draws.select("shard", at.alias("at"), F.lit(None).cast(begins.schema["source"].dataType).alias("source"), "draw")
        along = Window.partitionBy("shard").orderBy("at", "draw", F.col("source.source").isNull(), "source.source")
        held = begins.union(draws).withColumn("holder", F.last("source", ignorenulls=True).over(along)).filter("draw > 0")
        won = held.groupBy(F.col("holder.source").alias("source"), "shard").agg(F.count(F.lit(1)).alias("won"))
        same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.shard") == F.col("b.shard"))
        count = F.col("whole") + F.coalesce("won", F.lit(0))
        counted = plan.alias("a").join(won.alias("b"), same, "left").select("a.source", "a.shard", "a.blocks", count.alias("count"))
        running = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
        counted = counted.withColumn("end", F.least(F.sum("count").over(running), F.col("blocks") * MOST)).withColumn(
            "begin", F.coalesce(F.lag("end").over(Window.partitionBy("source").orderBy("shard")), F.lit(0))
        )
        # the shards are dealt out before their slots are listed: one short row each until here
        tasks = int(self.rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = counted.filter(F.col("end") > F.col("begin")).repartition(tasks, "source", "shard")
        each = dealt.select("source", "shard", "blocks", F.explode(F.sequence(F.col("begin"), F.col("end") - 1)).alias("slot"))
        turn = F.floor(F.col("slot") / F.col("blocks")).cast("long")
        key = F.xxhash64(F.lit(self.seed), "source", turn)
        drawn = each.select("source", "slot", "shard", "blocks", (F.col("slot") % F.col("blocks")).alias("at"), key.alias("key"))
        return drawn.mapInArrow(_permute, "source string, slot long, shard int, block long")

    def pieces(self) -> DataFrame:
        """(source, block, row, doc_id, place, from_word, n_words): the stretches of documents that make up each block."""
        same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.bucket") == F.col("b.bucket"))
        placed = self.rows.filter("size > 0").alias("a").join(self.starts.alias("b"), same).select("a.*", "b.start")
        order = Window.partitionBy("source", "bucket").orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
        placed = placed.withColumn("first", F.col("start") + F.sum("size").over(order) - F.col("size"))
        blocks = F.sequence(F.expr(f"first div {self.block}"), F.expr(f"(first + size - 1) div {self.block}"))
        cut = placed.select("source", "row", "doc_id", "first", "size", F.explode(blocks).alias("block"))
        begin = F.greatest(F.col("first"), F.col("block") * self.block)
        end = F.least(F.col("first") + F.col("size"), (F.col("block") + 1) * self.block)
        from_word = (begin - F.col("first")).alias("from_word")
        return cut.select("source", "block", "row", "doc_id", begin.alias("place"), from_word, (end - begin).alias("n_words"))

    def taken(self) -> DataFrame:
        """(row, taken): words of each document in the mix, repeats counted. Slots of a block are counted before the join."""
        times = self.slots().groupBy("source", "block").agg(F.count(F.lit(1)).alias("times"))
        same = F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.block") == F.col("b.block"))
        # size guesses do not see how many rows an exploded range makes, so neither side may be sent whole to every task
        met = self.pieces().alias("a").hint("merge").join(times.alias("b"), same)
        return met.groupBy("row").agg(F.sum(F.col("n_words") * F.col("times")).alias("taken"))


def mix_sizes(docs: DataFrame, block: int = 64, seed: int = 20) -> DataFrame:
    """One row per document: doc_id, size, source_size, target (of its source) and taken."""
    stages = Stages(docs.sparkSession)
    mix = Mix(docs, stages, block=block, seed=seed)
    taken = mix.taken()
    rows = mix.rows.hint("merge").join(taken, "row", "left")
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    return rows.alias("a").join(mix.sources.alias("b"), same).select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )
