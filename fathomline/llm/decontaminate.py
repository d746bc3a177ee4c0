"""Benchmark decontamination by SimHash windows.

Words are lower-cased runs of letters and digits. A document is compared with each benchmark item in windows of the item's
size, counted in five-word shingles. A shingle weighs by its rarity among the items (those of no item weigh most). The
SimHash of a window has 64 bits, the signs of weighted sums. Fingerprints are cut into 4 blocks of 16 bits: two that differ in
at most 15 bits differ in at most 3 bits of some block, so looking up each item's blocks with all changes of up to 3 bits
finds every window within the radius. What is found is verified by the exact weighted Jaccard similarity of its shingles.

Which windows are made: those where the item could lie. A window that reaches the threshold shares shingles with its item
worth at least that part of the item's weight, so documents are first searched for shingles of the benchmark, through a
bitmap of fixed size and then an exact join, and windows are laid where the shared shingles align with the item, and one
place to either side. Everything is DataFrame functions; the bitmap (64 KB whatever the benchmark's size) is the only value that
all tasks get. A benchmark too large for the bitmap lets more documents through to the exact join, and loses none.

Defined edge cases: null and empty texts have no words and match nothing; texts of one to four words are one shingle, so they
match equal texts alone; a document shorter than an item is one window; windows are cut at the ends of a document; repeated
rows each give their matches; null ids are kept as ids; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.session import Stages

SHINGLE = 5
THRESHOLD, RADIUS = 0.8, 15
BLOCKS, WIDTH = 4, 16
HEAVIEST = 8
BITMAP_BITS, SLOTS = 19, 3  # 2^19 bits, of which a shingle sets three


def words(text: Column) -> Column:
    """Hashes of the words of a text."""
    return F.transform(F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), ""), lambda w: F.xxhash64(w))


def shingles(hashes: Column) -> Column:
    """Shingle hashes in order. `get` beyond the end is null, which the hash passes over: a short text is one shingle."""
    # the array is bound to a name, so that it is not computed again for each element
    bound = F.transform(
        F.array(hashes),
        lambda h: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(h) - SHINGLE, F.lit(0))), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(SHINGLE)])
        ),
    )
    return F.when(F.size(hashes) > 0, F.get(bound, F.lit(0))).otherwise(F.array().cast("array<bigint>"))


def slot(h: Column, which: int) -> Column:
    return F.shiftrightunsigned(h, BITMAP_BITS * which).bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))


def bitmap(benchmark_shingles: DataFrame) -> Column:
    """The bits set by all shingles, as one constant array of longs."""
    slots = benchmark_shingles.select(F.explode(F.array(*[slot(F.col("h"), k) for k in range(SLOTS)])).alias("s"))
    set_bits = slots.groupBy(F.shiftright("s", 6).alias("id")).agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("b"))
    longs = [0] * (1 << (BITMAP_BITS - 6))
    for at, value in set_bits.collect():  # at most one row per long of the bitmap
        longs[at] = value
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>")


def bit_set(bits: Column, s: Column) -> Column:
    return F.getbit(F.get(bits, F.shiftright(s, 6).cast("int")), s.bitwiseAND(F.lit(63)).cast("int")) == 1


def fingerprints(weighted: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, fingerprint, weight) from rows (keys, h, c, w): hash, count and weight of each shingle."""
    mass = F.col("c") * F.col("w")
    signs = [F.sum(F.when(F.getbit(F.col("h"), F.lit(k)) == 1, mass).otherwise(-mass)).alias(f"s{k}") for k in range(64)]
    summed = weighted.groupBy(*keys).agg(F.sum(mass).alias("weight"), *signs)
    fingerprint = F.lit(0).cast("long")
    for k in range(64):
        fingerprint = fingerprint.bitwiseOR(F.when(F.col(f"s{k}") > 0, F.lit(1 << k if k < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, "weight", fingerprint.alias("fingerprint"))


def block_rows(prints: DataFrame, changes: int) -> DataFrame:
    """prints with one row per block (its number and value) and per change of up to `changes` bits of it."""
    masks = [m for m in range(1 << WIDTH) if m.bit_count() <= changes]
    each = prints.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))))
    value = F.expr(f"shiftrightunsigned(fingerprint, block * {WIDTH}) & {(1 << WIDTH) - 1}")
    mask = F.explode(F.array(*[F.lit(m).cast("long") for m in masks])) if changes else F.lit(0).cast("long")
    return each.withColumn("value", value).withColumn("mask", mask).withColumn("value", F.col("value").bitwiseXOR(F.col("mask"))).drop("mask")


def find_contamination(docs: DataFrame, benchmark: DataFrame, stages: Stages, threshold: float = THRESHOLD) -> DataFrame:
    """(row, doc_id, item_id, first_word, last_word, similarity): per document and item, the best window at or above the
    threshold. `row` numbers the rows of docs; words are numbered from 0."""
    # items: shingles with places, counts and weights
    placed = benchmark.select(F.col("item_id").cast("long").alias("item_id"), shingles(words(F.col("text"))).alias("s"))
    placed = placed.withColumn("item", F.monotonically_increasing_id()).filter(F.size("s") > 0)
    placed = stages.write(placed.select("item", "item_id", F.size("s").alias("n"), F.posexplode("s").alias("at", "h")), "bench-placed")
    counted = placed.groupBy("item", "item_id", "n", "h").agg(F.count(F.lit(1)).alias("c"))
    total = placed.agg(F.countDistinct("item").cast("double")).scalar()
    rarity = F.log((total + 1) / F.count(F.lit(1))) / F.log(total + 1)
    weights = counted.groupBy("h").agg(F.greatest(F.lit(1), F.round(HEAVIEST * rarity)).cast("long").alias("w"))
    weights = stages.write(weights, "bench-weights")
    items = stages.write(counted.join(weights, "h"), "bench-items")
    item_prints = stages.write(fingerprints(items, ["item", "item_id", "n"]), "bench-prints")

    # documents that share a shingle with the benchmark; the row number also keeps the filter from being moved below the arrays
    bits = bitmap(weights)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), words(F.col("text")).alias("words"))
    rows = rows.select("row", "doc_id", F.coalesce(shingles(F.col("words")), F.array().cast("array<bigint>")).alias("s"), F.monotonically_increasing_id().alias("_held"))
    hit = F.exists(F.col("s"), lambda h: bit_set(bits, slot(h, 0)) & bit_set(bits, slot(h, 1)) & bit_set(bits, slot(h, 2)))
    rows = rows.select("row", "doc_id", "s", hit.alias("hit"), F.monotonically_increasing_id().alias("_held"))
    rows = stages.write(rows.filter("hit").select("row", "doc_id", "s"), "bench-documents")

    shared = rows.select("row", F.size("s").alias("length"), F.posexplode("s").alias("pos", "h")).join(placed, "h")
    shared = stages.write(shared.select("row", "length", "item", "n", "at", "h", (F.col("pos") - F.col("at")).alias("start")), "bench-shared")
    # enough weight in common, wherever it stands
    heavy = shared.select("row", "item", "at", "h").distinct().join(weights, "h").groupBy("row", "item").agg(F.sum("w").alias("common"))
    heavy = heavy.join(item_prints.select("item", F.col("weight").alias("whole")), "item").filter(F.col("common") >= threshold * F.col("whole"))
    starts = shared.join(heavy.select("row", "item"), ["row", "item"]).select("row", "length", "n", F.explode(F.array(*[F.col("start") + d for d in (-1, 0, 1)])).alias("start"))
    begin = F.greatest(F.lit(0), F.least(F.col("start"), F.col("length") - 1))
    windows = starts.withColumn("begin", begin).withColumn("size", F.least(F.col("length"), F.col("start") + F.col("n")) - F.col("begin"))
    windows = stages.write(windows.filter("size > 0").select("row", "n", "begin", "size").distinct(), "bench-windows")

    key = ["row", "n", "begin", "size"]
    inside = windows.join(rows, "row").select(*key, F.explode(F.expr("slice(s, begin + 1, size)")).alias("h"))
    inside = inside.groupBy(*key, "h").agg(F.count(F.lit(1)).alias("c")).join(weights, "h", "left").withColumn("w", F.coalesce("w", F.lit(HEAVIEST)))
    inside = stages.write(inside, "bench-inside")
    prints = fingerprints(inside, key)

    # multi-index: every pair within the radius agrees on a block after at most RADIUS div BLOCKS changes
    probes = block_rows(prints.withColumnRenamed("weight", "window_weight"), 0)
    index = block_rows(item_prints, RADIUS // BLOCKS).withColumnRenamed("fingerprint", "item_fingerprint")
    # a size guess does not see how far the changes multiply the index, so it must not be sent whole to every task
    near = probes.hint("merge").join(index, ["n", "block", "value"]).filter(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_fingerprint"))) <= RADIUS)
    near = stages.write(near.select(*key, "item", "item_id", "window_weight", "weight").distinct(), "bench-near")
    both = near.join(inside, key).join(items.select("item", "h", F.col("c").alias("item_c")), ["item", "h"])
    both = both.groupBy(*key, "item", "item_id", "window_weight", "weight").agg(F.sum(F.least("c", "item_c") * F.col("w")).alias("common"))
    similarity = F.col("common") / (F.col("window_weight") + F.col("weight") - F.col("common"))
    sure = both.withColumn("similarity", similarity).filter(F.col("similarity") >= threshold - 1e-9)
    best = sure.groupBy("row", "item", "item_id").agg(F.max(F.struct("similarity", (-F.col("begin")).alias("b"), "size")).alias("best"))
    first = -F.col("best.b")
    return best.join(rows.select("row", "doc_id"), "row").select(
        "row", "doc_id", "item_id", first.cast("long").alias("first_word"), (first + F.col("best.size") + SHINGLE - 2).cast("long").alias("last_word"), F.col("best.similarity").alias("similarity")
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, first_word, last_word, similarity."""
    return find_contamination(docs, benchmark, Stages(docs.sparkSession), threshold).drop("row")
