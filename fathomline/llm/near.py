"""What the near-duplicate operators share: hashes of words and shingles, bitmaps of ids, and exact
verification of candidates in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.components import connected
from fathomline.session import Stages

GOLD, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
PIECE = 2_000_000  # characters handled at once (or one longer text)


def scramble(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    y = x >> np.uint64(30)
    y ^= x
    y *= MIX1
    z = y >> np.uint64(27)
    z ^= y
    z *= MIX2
    y = z >> np.uint64(31)
    y ^= z
    return y


def runs(sizes: list[int], most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to `most`, or of one that is larger."""
    begin = 0
    while begin < len(sizes):
        end, n = begin + 1, sizes[begin]
        while end < len(sizes) and n + sizes[end] <= most:
            n += sizes[end]
            end += 1
        yield begin, end
        begin = end


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (stretches without U+0020 and U+0009 to U+000D) laid end to end, and words per text."""
    codes = np.frombuffer("".join([t + "\n" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    blank = (codes == 32) | ((codes >= 9) & (codes <= 13))
    begins = ~blank
    begins[1:] &= blank[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    place = np.arange(len(codes), dtype=np.uint64) - np.repeat(
        np.concatenate(([0], starts)).astype(np.uint64), np.diff(np.concatenate(([0], starts, [len(codes)])))
    )
    h = scramble(codes.astype(np.uint64) * GOLD + place * MIX2)
    h[blank] = 0
    words = scramble(np.add.reduceat(h, starts))
    return words, np.diff(np.concatenate(([0], np.searchsorted(starts, ends))))


def word_shingles(words: np.ndarray, sizes: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-word shingles laid end to end, and how many each text has: a text of fewer than n words (but one at least)
    is one shingle."""
    first = np.cumsum(sizes) - sizes
    count = np.where(sizes >= n, sizes - n + 1, np.minimum(sizes, 1))
    at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
    left = np.repeat(np.minimum(sizes, n), count)
    out = np.zeros(len(at), np.uint64)
    for j in range(n):
        here = np.minimum(at + j, max(0, len(words) - 1))
        out = out * GOLD + np.where(j < left, words[here], np.uint64(j)) if len(words) else out
    return scramble(out), count


def splits(values: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    return np.split(values, np.cumsum(sizes)[:-1]) if len(sizes) else []


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct five-word shingles of each text."""
    return [distinct(s) for s in splits(*word_shingles(*word_hashes(texts)))]


# --- rows that share a key ---

# how many keys of a sample are salted, in how many parts; the share of rows looked at, and how often a key is seen there at least
HOTTEST, SALTS, LOOKED_AT, OFTEN = 1000, 64, 0.01, 20


class Seen:
    """A bitmap of a set of longs: `bits` bits whatever the size of the set, so it may be sent to all tasks. It holds every
    member; others pass with a probability that grows with the set, so an exact join must follow."""

    def __init__(self, ids: DataFrame, bits: int = 1 << 25):
        self.bits = bits
        slots = ids.select(F.pmod(F.col("id"), F.lit(bits)).alias("s"))
        words = slots.groupBy(F.shiftright("s", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(s % 64 as int)))").alias("b"))
        got = words.toArrow()
        self.words = np.zeros(bits // 64, np.uint64)
        self.words[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)

    def may_hold(self, low: np.ndarray) -> np.ndarray:
        """Whether ids (as int64) may be members."""
        s = low.astype(np.int64) % self.bits
        return (self.words[s >> 6] >> (s & 63).astype(np.uint64)) & np.uint64(1) > 0


# --- exact verification ---

BLOCK = 256
VERIFIED = "id binary, root binary, links long"


def blocks(members: DataFrame) -> DataFrame:
    """members (comp, ...) with `pair`, the pair of blocks in which a row is compared. A component of up to BLOCK rows is one
    block. A larger one is dealt into blocks by a hash, and each of its rows goes to every pair its block belongs to, so
    a group holds two blocks of about BLOCK rows, as the hash deals them."""
    sizes = members.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n"))
    mine = F.pmod(F.xxhash64("digest"), F.col("n")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda other: F.struct(F.least(mine, other).alias("i"), F.greatest(mine, other).alias("j")))
    # null-safe equality deals the sizes anew, so that Spark can split the rows of a large component
    rows = members.join(sizes.withColumnRenamed("comp", "_comp"), F.col("comp").eqNullSafe(F.col("_comp"))).drop("_comp")
    return rows.select("*", mine.alias("block"), F.explode(pairs).alias("pair")).drop("n")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, as a matrix product over columns of members in slices of bounded width."""
    flat = np.concatenate(sets)
    _, column = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    # members that one set alone holds add nothing to an intersection
    n = np.bincount(column)
    several = n[column] > 1
    row, column = row[several], np.cumsum(np.concatenate(([0], np.diff(column[several]) != 0)))[: several.sum()] if several.any() else column[:0]
    out = np.zeros((len(sets), len(sets)), np.float64)
    columns = int(column.max()) + 1 if len(column) else 0
    width = max(1, min(columns, 8_000_000 // len(sets)))  # as wide as the columns there are
    for begin in range(0, columns, width):
        lo, hi = np.searchsorted(column, (begin, begin + width))
        part = np.zeros((len(sets), width), np.float32)
        part[row[lo:hi], column[lo:hi] - begin] = 1
        out += part @ part.T
    return out


def verified_groups(rows: list[tuple], sets: list[np.ndarray], threshold: float, apart: np.ndarray | None = None) -> list[tuple[bytes, bytes, int]]:
    """(id, root, links) of the rows of one pair of blocks: rows are (digest, block, i, j). Each pair of rows is compared in one
    pair of blocks alone: rows of one block where i = j, rows of two where i < j. Two rows that are `apart` aren't linked. `root` joins the rows that are linked here."""
    n = len(rows)
    sizes = np.array([len(s) for s in sets], np.float64)
    if n <= 12:
        common = np.zeros((n, n))
        known: list[set[int] | None] = [None] * n  # made for those that have a pair of like size
        size = [len(s) for s in sets]
        for a in range(n):
            for b in range(a + 1, n):
                if min(size[a], size[b]) >= threshold * max(size[a], size[b]):
                    for k in (a, b):
                        if known[k] is None:
                            known[k] = set(sets[k].tolist())
                    common[a, b] = common[b, a] = len(known[a] & known[b])
        if not common.any():
            return []
    else:
        common = overlaps(sets)
    union = sizes[:, None] + sizes[None, :] - common
    linked = (common >= threshold * union - 1e-9) & (common > 0)
    np.fill_diagonal(linked, False)
    if apart is not None:
        linked &= ~(apart[:, None] & apart[None, :])
    block = np.array([r[1] for r in rows])
    if rows[0][2] != rows[0][3]:
        linked &= block[:, None] != block[None, :]
    links = linked.sum(1)
    root = np.arange(n)
    while True:  # smallest label among neighbours until none changes
        low = np.minimum(root, np.where(linked, root[None, :], n).min(1))
        low = low[low]
        if (low == root).all():
            break
        root = low
    return [(rows[a][0], rows[root[a]][0], int(links[a])) for a in range(n) if links[a]]


def _verifier(to_sets: Callable[[list[str]], list[np.ndarray]], threshold: float, apart: Callable[[list[str]], np.ndarray] | None = None):
    def flush(group: list[tuple], out: list[tuple]) -> None:
        rows = list({r[1]: r for r in group}.values())  # equal texts were sent by several tasks
        if len(rows) > 1:
            texts = [r[3] for r in rows]
            out += verified_groups([(r[1], r[2], r[0][1], r[0][2]) for r in rows], to_sets(texts), threshold, apart(texts) if apart else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, out = [], []
        for batch in batches:
            names = ("comp", "i", "j", "digest", "block", "text")
            for comp, i, j, digest, block, text in zip(*(batch.column(n).to_pylist() for n in names)):
                if group and group[0][0] != (comp, i, j):
                    flush(group, out)
                    group = []
                group.append(((comp, i, j), digest, block, text))
            if len(out) > 10_000:
                yield packed(out)
                out = []
        if group:
            flush(group, out)
        yield packed(out)

    return run


def packed(out: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*out)) if out else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64())], names=["id", "root", "links"]
    )


def verify(
    texts: DataFrame, to_sets: Callable[[list[str]], list[np.ndarray]], threshold: float, apart: Callable[[list[str]], np.ndarray] | None = None
) -> DataFrame:
    """(id, root, links) from texts (comp, digest, text): every pair of different texts of a component is compared exactly,
    but those of which `apart` holds for both. A row tells how many links of `id` were found in one pair of blocks, and a row that it is connected with there."""
    dealt = blocks(texts).select("comp", "pair.i", "pair.j", "digest", "block", "text")
    dealt = dealt.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    return dealt.mapInArrow(_verifier(to_sets, threshold, apart), VERIFIED)


def settle(found: DataFrame, stages: Stages, name: str) -> tuple[DataFrame, DataFrame]:
    """(id, links) and (id, root) of all texts that have a link, from what verify found (written first)."""
    found = stages.write(found, f"{name}-verified")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    return links, connected(found.select(F.col("id").alias("a"), F.col("root").alias("b")), stages, f"{name}-classes")
