"""Line deduplication that sees through small edits.

Two lines are linked if the Jaccard similarity of their character shingles is 0.8 or more. The shorter of the two sets the length of
the shingles: eight characters from 79 characters on, and (length + 1) // 10 (two at least) below, the longest at which one
changed character leaves 0.8. So a line has keys for its own length and for those of shorter lines that it could match, down to 0.8 of its
length. Short shingles come again within a line, so below eight characters the second is another than the first, and so on.

Min-hashes of the shingles are cut into bands (`BANDING`: the shorter the shingles, the more alike unrelated lines are, so
the more min-hashes make a band, and the more bands there are to keep the recall). Lines that share a band are candidates, and candidates
are verified before anything is closed over them: first every line against the smallest of its band, in rows that grow with the lines.
Bands whose lines beside the first are then one component are settled. Of the others (each set of lines once) all lines but the first are compared with each other,
in pairs of blocks of bounded size. Verified links form components by distributed union-find, and of each component (and of
equal lines) the first line is kept: that of the smallest doc_id, then line number.

Defined edge cases: a null text has no lines and stays null; blank lines are always kept; below 19
characters one changed inner character leaves less than 0.8, and a line of one character matches equal lines alone; a line of any length is
hashed whole; repeated rows share a doc_id, so the first copy of the row keeps the line; null doc_ids come first; of equal doc_ids the first row keeps it; an empty table gives
no rows; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.components import connected
from fathomline.llm.files import give_back
from fathomline.llm.lsh_forest import digest_of
from fathomline.llm.near import BLOCK, GOLD, HOTTEST, LOOKED_AT, MIX1, MIX2, OFTEN, SALTS, VERIFIED, Seen, blocks, distinct, packed, runs, scramble, verified_groups
from fathomline.session import Stages

CHARS, LEAST = 8, 2
#: Bands and min-hashes of a band, by the length of the shingles; at 0.8 a pair shares a band with a probability of 0.995 or more.
BANDING = {2: (30, 8), 3: (20, 6), 4: (12, 4)} | {chars: (8, 3) for chars in range(5, CHARS + 1)}
THRESHOLD = 0.8
AT_ONCE = 50_000  # characters hashed at once, so that the arrays stay in the processor's cache
LINES = "row long, doc_id long, line int, digest binary, node long, keys array<struct<chars:int,keys:array<long>>>, n_lines long"
KEYS = pa.list_(pa.struct([("chars", pa.int32()), ("keys", pa.list_(pa.int64()))]))
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
MEMBER = np.uint64((1 << 44) - 1)  # of a set: the bits of a hash beside the number of the set
FEW = 12  # lines of a group that is compared pair by pair, together with others


def own_chars(size: int) -> int:
    """The length of the shingles of a line of `size` characters."""
    return max(LEAST, min(CHARS, (size + 1) // 10))


@lru_cache(10_000)
def all_chars(size: int, threshold: float = THRESHOLD) -> range:
    """Lengths of the shingles at which a line of `size` characters meets others: its own and those of shorter lines."""
    return range(own_chars(int(threshold * size)), own_chars(size) + 1)


def char_shingles(lines: list[str], chars: int = CHARS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles laid end to end, and how many each line has (one for a shorter line)."""
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    # each line is followed by chars - 1 zeros, so a window never reaches the next line's characters
    gap = "\x00" * (chars - 1)
    codes = np.frombuffer("".join([line + gap for line in lines]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if chars == CHARS:
        h, width = codes + np.uint64(1), 1
        for odd in (GOLD, MIX1, MIX2):
            later, h = h[width:], h * odd
            h[:-width] += later
            width *= 2
    else:
        h = np.full(len(codes), chars, np.uint64)
        for k in range(chars):
            h = h * GOLD + np.uint64(1)
            h[: len(codes) - k] += codes[k:]
    count = np.maximum(1, sizes - chars + 1)
    first = np.cumsum(sizes + chars - 1) - (sizes + chars - 1)
    keep = np.zeros(len(h) + 1, np.int8)
    keep[first] += 1  # no place comes twice, in either
    keep[first + count] -= 1
    h = scramble(h[np.cumsum(keep[:-1], dtype=np.int8) > 0])
    if chars < CHARS and len(h):
        h = scramble(h + times_before(h, count) * MIX1)
    return h, count


def times_before(h: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How often each value came earlier in its line; `count` values of each line are laid end to end."""
    owner, order, at = np.repeat(np.arange(len(count)), count), None, np.arange(len(h))
    if len(count) <= 1 << 16 and count.max() <= 1 << 7:
        # one sort of numbers: the line, 41 bits of the value, the place in the line
        place = at - np.repeat(np.cumsum(count) - count, count)
        mixed = np.sort(owner.astype(np.uint64) << np.uint64(48) | h >> np.uint64(23) << np.uint64(7) | place.astype(np.uint64))
        new = np.concatenate(([True], mixed[1:] >> np.uint64(7) != mixed[:-1] >> np.uint64(7)))
        order = at - place + (mixed & np.uint64(127)).astype(np.int64)
        again = np.flatnonzero(~new)
        if (h[order[again]] != h[order[again - 1]]).any():  # two values alike in 41 bits
            order = None
    if order is None:
        order = np.lexsort((h, owner))
        new = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])))
    before = np.empty(len(h), np.uint64)
    before[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return before


def line_sets(lines: list[str], chars: int = CHARS) -> list[np.ndarray]:
    values, sizes = char_shingles(lines, chars)
    return [distinct(s) for s in np.split(values, np.cumsum(sizes)[:-1])] if lines else []


def guests(marked: list[str]) -> np.ndarray:
    """Which lines (the length of their shingles is in front of them) have longer shingles of their own: two of these are compared at those."""
    return np.array([own_chars(len(m) - 1) > int(m[0]) for m in marked])


def least_by_bin(values: np.ndarray, sizes: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation min-hashes: the least value of each bin; an empty bin takes its right neighbour's, marked by one more step."""
    high = (values >> np.uint64(40)).astype(np.uint32)
    slot = np.repeat(np.arange(len(sizes), dtype=np.int64) * bins, sizes) + (high - high // np.uint32(bins) * np.uint32(bins))
    least = np.full(len(sizes) * bins, EMPTY)
    np.minimum.at(least, slot, values & np.uint64((1 << 40) - 1))
    least = least.reshape(len(sizes), bins)
    for _ in range(bins):
        empty = least == EMPTY
        if not empty.any():
            break
        right = np.roll(least, -1, 1)
        least = np.where(empty & (right != EMPTY), right + np.uint64(1 << 41), least)
    return least


def least_by_hash(values: np.ndarray, sizes: np.ndarray, hashes: int) -> np.ndarray:
    """Min-hashes by as many functions, for lines with fewer shingles than a bin each would take."""
    high, low = (values >> np.uint64(32)).astype(np.uint32), values.astype(np.uint32) | np.uint32(1)
    starts, out = np.cumsum(sizes) - sizes, np.empty((len(sizes), hashes), np.uint64)
    for k in range(hashes):
        v = high + low * np.uint32((k * 2654435761 + 1) & 0xFFFFFFFF)
        v ^= v >> np.uint32(15)
        v *= np.uint32(2246822519)
        v ^= v >> np.uint32(13)
        out[:, k] = np.minimum.reduceat(v, starts)
    return out


def band_keys(lines: list[str], chars: int = CHARS) -> np.ndarray:
    """lines x bands keys."""
    bands, rows = BANDING[chars]
    least = (least_by_hash if chars <= 4 else least_by_bin)(*char_shingles(lines, chars), bands * rows)
    keys = np.full((len(lines), bands), chars, np.uint64) * MIX1 + np.arange(1, bands + 1, dtype=np.uint64) * GOLD
    for r in range(rows):
        keys = scramble(keys * GOLD + least[:, r::rows])
    return keys.view(np.int64)


def laid_out(place: np.ndarray, chars: np.ndarray, made: list[np.ndarray], size: int) -> pa.Array:
    """The keys of lines as one array: each row of `made` belongs to the line at `place`; lines without any have null."""
    order = np.argsort(place, kind="stable")
    bands = np.array([BANDING[c][0] for c in chars.tolist()], np.int64)
    starts, bands = (np.cumsum(bands) - bands)[order], bands[order]
    ends = np.concatenate(([0], np.cumsum(bands)))
    flat = np.concatenate([m.ravel() for m in made])[np.repeat(starts - ends[:-1], bands) + np.arange(ends[-1])]
    keys = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))
    entries = pa.StructArray.from_arrays([pa.array(chars[order]), keys], fields=list(KEYS.value_type))
    offsets = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=size)))).astype(np.int32)
    none = np.append(offsets[1:] == offsets[:-1], False)
    return pa.ListArray.from_arrays(pa.array(offsets, mask=none), entries, type=KEYS)


def nodes_of(digests: list[bytes]) -> np.ndarray:
    """node_of for many digests."""
    return np.frombuffer(b"".join(digests), "<i8")[::2].copy()


def without_any(batch: pa.RecordBatch, at: tuple[int, ...], n_lines: tuple[int, ...]) -> pa.RecordBatch:
    """Rows of texts without a line that is not blank: these have nothing but how many lines they have."""
    row, doc_id = (batch.column(c).take(pa.array(at, pa.int64())) for c in ("row", "doc_id"))
    none = [pa.nulls(len(at), t) for t in (pa.int32(), pa.binary(), pa.int64(), KEYS)]
    return pa.RecordBatch.from_arrays([row, doc_id, *none, pa.array(n_lines, pa.int64())], names=["row", "doc_id", "line", "digest", "node", "keys", "n_lines"])


def _reader(threshold: float):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for begin, end in runs([len(t or "") for t in texts]):
                at, number, lines, blank = [], [], [], []
                n_lines: dict[int, int] = {}  # of a text, at its first row
                for i in range(begin, end):
                    parts = [] if texts[i] is None else texts[i].split("\n")
                    here = [n for n, line in enumerate(parts) if line and not line.isspace()]
                    if not here:
                        blank.append((i, len(parts)))
                        continue
                    n_lines[len(at)] = len(parts)
                    at += [i] * len(here)
                    number += here
                    lines += [parts[n] for n in here]
                if blank:
                    yield without_any(batch, *zip(*blank))
                if not lines:
                    continue
                # keys are made once for each line of this piece; further copies have none
                first: dict[str, int] = {}
                for k, line in enumerate(lines):
                    first.setdefault(line, k)
                place, chars_of, made = [], [], []
                of_chars: dict[int, list[str]] = {chars: [] for chars in range(LEAST, CHARS + 1)}
                for line in first:
                    for chars in all_chars(len(line), threshold):
                        of_chars[chars].append(line)
                for chars, meet in of_chars.items():
                    for b, e in runs(list(map(len, meet)), AT_ONCE):
                        made.append(band_keys(meet[b:e], chars))
                        place += [first[line] for line in meet[b:e]]
                        chars_of += [chars] * (e - b)
                digests = {line: digest_of(line) for line in first}
                digest = [digests[line] for line in lines]
                node = nodes_of(digest)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").take(pa.array(at, pa.int64())),
                        batch.column("doc_id").take(pa.array(at, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(digest, pa.binary()),
                        pa.array(node),
                        laid_out(np.array(place, np.int64), np.array(chars_of, np.int32), made, len(lines)),
                        pa.array(list(map(n_lines.get, range(len(lines)))), pa.int64()),
                    ],
                    names=["row", "doc_id", "line", "digest", "node", "keys", "n_lines"],
                )
        give_back()

    return read


def _fetcher(seen: Seen):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()  # 16 bytes a line that this task has sent
        for batch in batches:
            lines = {line for t in batch.column("text").to_pylist() if t for line in t.split("\n") if line and not line.isspace()}
            lines = list(lines)
            digests = [digest_of(line) for line in lines]
            node = nodes_of(digests) >> 3
            out = []
            for k in np.flatnonzero(seen.may_hold(node)).tolist():
                if digests[k] not in sent:
                    sent.add(digests[k])
                    out.append((digests[k], int(node[k]), lines[k]))
            columns = list(zip(*out)) if out else [[], [], []]
            types = (pa.binary(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["digest", "node", "text"])
        sent.clear()
        give_back()

    return fetch


def meetings(keyed: DataFrame, stages: Stages) -> DataFrame:
    """(key, id, first, pair, hot) of keys that several ids share, from rows (id, keys): every id but the first with the smallest id of its
    key; `pair` where no third row has the key. The HOTTEST most frequent keys of a sample are salted: there `first` is the smallest of
    (key, salt), and these smallest ones meet the smallest of the key. The sample decides which keys are salted, not what meets."""
    seen = keyed.sample(LOOKED_AT, 7).select(F.explode("keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= OFTEN)
    hot = stages.write(seen.orderBy(F.col("n").desc(), "key").limit(HOTTEST).select("key", F.lit(True).alias("hot")), "lines-hot")
    rows, by, is_hot = keyed.select("id", F.explode("keys").alias("key")), ["key"], F.lit(False)
    if not hot.isEmpty():
        rows = rows.join(F.broadcast(hot), "key", "left")  # HOTTEST rows at most
        # a salt by task, so that copies of one id are dealt too
        rows = rows.withColumn("salt", F.when(F.col("hot"), F.spark_partition_id() % SALTS).otherwise(0))
        by, is_hot = ["key", "salt"], F.coalesce("hot", F.lit(False))
    of_key = Window.partitionBy(*by)
    met = rows.select(*by, "id", F.min("id").over(of_key).alias("first"), F.count(F.lit(1)).over(of_key).alias("n"), is_hot.alias("hot"))
    met = met.filter("id != first OR hot").select(*by, "id", "first", (~F.col("hot") & (F.col("n") == 2)).alias("pair"), "hot").distinct()
    met = stages.write(met.select("key", "id", "first", "pair", "hot"), "lines-met")
    if len(by) == 1:
        return met
    heads = met.filter("hot AND id = first").select("key", "id").distinct()
    least = heads.withColumn("first", F.min("id").over(Window.partitionBy("key")))  # SALTS rows of a key at most
    least = least.filter("id != first").select("key", "id", "first", F.lit(False).alias("pair"), F.lit(True).alias("hot"))
    return met.filter("id != first").union(least)


def similar_to_heads(heads: list[tuple], rows: list[tuple], threshold: float) -> list[tuple[bytes, bytes, int]]:
    """Links of rows (number of a head, digest, marked text) to heads (digest, marked text), for many heads at once."""
    out = []
    head_chars, row_chars = np.array([h[1][0] for h in heads]), np.array([heads[r[0]][1][0] for r in rows])
    for chars in np.unique(row_chars).tolist():
        of, mine = np.flatnonzero(head_chars == chars), np.flatnonzero(row_chars == chars)
        number = np.zeros(len(heads), np.int64)
        number[of] = np.arange(len(of))
        marked = [heads[k][1] for k in of], [rows[k][2] for k in mine]
        to = number[[rows[k][0] for k in mine]]
        values, sizes = char_shingles([m[1:] for part in marked for m in part], int(chars))
        owner = np.repeat(np.arange(len(sizes), dtype=np.uint64), sizes)
        # members of each set, sorted: the set's number above 44 bits of the shingle's hash
        members = distinct(owner << np.uint64(44) | values >> np.uint64(20))
        owner = (members >> np.uint64(44)).astype(np.int64)
        size = np.bincount(owner, minlength=len(sizes))
        split = np.searchsorted(owner, len(of))
        asked = to[owner[split:] - len(of)].astype(np.uint64) << np.uint64(44) | members[split:] & np.uint64((1 << 44) - 1)
        at = np.minimum(np.searchsorted(members[:split], asked), max(0, split - 1))
        common = np.bincount((owner[split:] - len(of))[members[at] == asked], minlength=len(mine))
        union = size[to] + size[len(of) :] - common
        linked = (common >= threshold * union - 1e-9) & (common > 0) & ~(guests(marked[0])[to] & guests(marked[1]))
        out += [(rows[mine[k]][1], heads[of[to[k]]][0], 1) for k in np.flatnonzero(linked).tolist()]
    return out


def _heads_verifier(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, heads, rows, size = None, 0, [], [], 0
        for batch in batches:
            out = []
            for first, part, is_head, digest, text in zip(*(batch.column(c).to_pylist() for c in ("first", "part", "is_head", "digest", "text"))):
                if size > AT_ONCE:
                    out += similar_to_heads(heads, rows, threshold) if rows else []
                    heads, rows = heads[-held:], []
                    size = sum(len(h[1]) for h in heads)
                if group != (first, part):
                    group, held = (first, part), 0
                size += len(text)
                # lines of one node are heads together
                rows += [(len(heads) - k, digest, text) for k in range(1, held + 1)]
                if is_head:
                    heads.append((digest, text))
                    held += 1
            yield packed(out)
        yield packed(similar_to_heads(heads, rows, threshold) if rows else [])

    return run


def near_heads(met: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Verified links of lines to the first lines of their keys. A first line of many goes to several parts of them, as their number is."""
    pairs = met.select("first", "id").distinct()
    parts = pairs.groupBy("first").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts")).withColumnRenamed("first", "_first")
    # null-safe equality deals the counts anew, so that Spark can split the lines of one head
    pairs = pairs.join(parts, F.col("first").eqNullSafe(F.col("_first"))).select("first", "id", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    heads = parts.select(F.col("_first").alias("first"), F.col("_first").alias("id"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    wanted = pairs.withColumn("is_head", F.lit(False)).unionByName(heads.withColumn("is_head", F.lit(True)))
    rows = wanted.join(texts, "id").select("first", "part", "is_head", "digest", "text")
    dealt = rows.repartition("first", "part").sortWithinPartitions("first", "part", F.col("is_head").desc())
    return dealt.mapInArrow(_heads_verifier(threshold), VERIFIED)


def unsettled(met: DataFrame, texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(comp, digest, text) of keys whose lines beside the first are not one class yet (all were compared with the first); of keys with
    the same lines, one. Lines of a salted key were compared with the first of their salt alone, so there the first ones are among them."""
    rows = met.filter("NOT pair")
    salted = rows.filter("hot")
    salted = salted.select("key", "id").union(salted.select("key", F.col("first"))).distinct()
    members = rows.filter("NOT hot").select("key", "id").union(salted)
    root = texts.select("id", "digest").join(classes.withColumnRenamed("id", "digest"), "digest", "left").select("id", F.coalesce("root", "digest").alias("root"))
    mark = F.xxhash64("id")
    keys = members.join(root, "id").groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"), F.bit_xor(mark).alias("x"), F.sum(mark % 1_000_003).alias("s")
    )
    keys = keys.filter(F.col("low") != F.col("high")).groupBy("n", "x", "s").agg(F.min("key").alias("key"))
    return members.join(keys.select(F.col("key").alias("comp")), F.col("key") == F.col("comp")).join(texts, "id").select("comp", "digest", "text")


def in_small_groups(
    groups: list[list[tuple]], begins: list[int], members: np.ndarray, size: np.ndarray, apart: np.ndarray, threshold: float
) -> list[tuple[bytes, bytes, int]]:
    """What verified_groups returns, for many groups of few rows (digest, block, text, (i, j)) at once. `members` are those of all sets as
    `numbered_members` lays them out; the rows of a group are at `begins` in size and apart."""
    start = np.cumsum(size) - size
    a, b = (np.concatenate([two_of(len(g))[side] + at for g, at in zip(groups, begins)]) for side in (0, 1))
    block = np.zeros(len(size), np.int64)
    for g, at in zip(groups, begins):
        if g[0][3][0] != g[0][3][1]:
            block[at : at + len(g)] = [r[1] + 1 for r in g]  # 0 where all rows are compared
    a, b = np.where(size[a] <= size[b], a, b), np.where(size[a] <= size[b], b, a)
    wanted = (size[a] >= threshold * size[b] - 1e-9) & ~(apart[a] & apart[b]) & ((block[a] == 0) | (block[a] != block[b]))
    a, b = a[wanted], b[wanted]
    linked = np.zeros(len(a), bool)
    for x, y in runs(size[a].tolist(), 2 * AT_ONCE):
        n = size[a[x:y]]
        first = np.cumsum(n) - n
        asked = members[np.repeat(start[a[x:y]] - first, n) + np.arange(n.sum())] & MEMBER | np.repeat(b[x:y].astype(np.uint64) << np.uint64(44), n)
        found = members[np.minimum(np.searchsorted(members, asked), len(members) - 1)] == asked
        common = np.add.reduceat(found, first, dtype=np.int64)
        linked[x:y] = (common >= threshold * (n + size[b[x:y]] - common) - 1e-9) & (common > 0)
    a, b = a[linked], b[linked]
    links, root = np.bincount(np.concatenate((a, b)), minlength=len(size)), {}

    def top(k: int) -> int:
        while (up := root.get(k, k)) != k:
            root[k] = root.get(up, up)
            k = up
        return k

    for k, j in zip(a.tolist(), b.tolist()):
        k, j = top(k), top(j)
        root[max(k, j)] = min(k, j)
    digest = {at + k: r[0] for g, at in zip(groups, begins) for k, r in enumerate(g)}
    return [(digest[k], digest[top(k)], int(links[k])) for k in np.flatnonzero(links).tolist()]


@lru_cache
def two_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(n, 1)


def numbered_members(marked: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Members of the sets of marked lines, sorted: the set's number above 44 bits of the shingle's hash; and the sets' sizes."""
    chars, parts = np.array([int(m[0]) for m in marked]), []
    for c in np.unique(chars).tolist():
        at = np.flatnonzero(chars == c)
        values, count = char_shingles([marked[k][1:] for k in at.tolist()], c)
        parts.append(np.repeat(at.astype(np.uint64) << np.uint64(44), count) | values >> np.uint64(20))
    members = distinct(np.concatenate(parts))
    return members, np.bincount((members >> np.uint64(44)).astype(np.int64), minlength=len(marked))


def _groups_verifier(threshold: float):
    def closed(groups: list[list[tuple]]) -> list[tuple[bytes, bytes, int]]:
        groups = [g for g in groups if len(g) > 1]
        if not groups:
            return []
        marked = [r[2] for g in groups for r in g]
        members, size = numbered_members(marked)
        start, apart = np.cumsum(size) - size, guests(marked)
        begins = [0, *accumulate(map(len, groups))]
        out, small = [], []
        for g, at in zip(groups, begins):
            if len(g) <= FEW:
                small.append((g, at))
                continue
            sets = [members[start[k] : start[k] + size[k]] & MEMBER for k in range(at, at + len(g))]
            out += verified_groups([(r[0], r[1], *r[3]) for r in g], sets, threshold, apart[at : at + len(g)])
        return out + in_small_groups([g for g, _ in small], [at for _, at in small], members, size, apart, threshold) if small else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, groups, size = None, [], 0
        for batch in batches:
            out = []
            for comp, i, j, digest, block, text in zip(*(batch.column(c).to_pylist() for c in ("comp", "i", "j", "digest", "block", "text"))):
                if last != (comp, i, j):
                    if size > AT_ONCE:
                        out += closed(groups)
                        groups, size = [], 0
                    last = (comp, i, j)
                    groups.append([])
                groups[-1].append((digest, block, text, (i, j)))
                size += len(text)
            yield packed(out)
        yield packed(closed(groups))
        give_back()

    return run


def verified_lines(texts: DataFrame, threshold: float) -> DataFrame:
    """(id, root, links) from texts (comp, digest, text): all lines of a comp are compared, in pairs of blocks; sets are made for many at once."""
    dealt = blocks(texts).select("comp", "pair.i", "pair.j", "digest", "block", "text")
    dealt = dealt.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j")
    return dealt.mapInArrow(_groups_verifier(threshold), VERIFIED)


def line_classes(keyed: DataFrame, rows: DataFrame, stages: Stages, threshold: float) -> DataFrame:
    """(id, root) of lines (by digest) that are linked to other lines, from keys (id, keys) and texts of rows (text). An id is a line's node
    with the length of its shingles in the low three bits."""
    met = meetings(keyed, stages)
    stages.remove("lines-hot")
    ids = stages.write(met.select("id").union(met.select("first")).distinct(), "lines-ids")
    ids = ids.select("id", F.shiftright("id", 3).alias("node"), (F.col("id").bitwiseAND(F.lit(7)) + 1).cast("string").alias("chars"))
    texts = rows.select("text").mapInArrow(_fetcher(Seen(ids.select(F.col("node").alias("id")))), "digest binary, node long, text string")
    # dealt by node before copies are dropped, so that copies and ids meet in one shuffle; a task sends a line once
    texts = texts.repartition("node").dropDuplicates(["node", "digest"]).join(ids, "node").select("id", "digest", F.concat("chars", "text").alias("text"))
    texts = stages.write(texts, "lines-texts")
    stages.remove("lines-ids")
    first = stages.write(near_heads(met, texts, threshold), "lines-near-heads")
    links = first.select(F.col("id").alias("a"), F.col("root").alias("b"))
    classes = stages.write(connected(links, stages, "lines-first"), "lines-first-classes")
    stages.remove("lines-near-heads")
    rest = stages.write(unsettled(met, texts, classes), "lines-unsettled")
    stages.remove("lines-met", "lines-texts")
    second = verified_lines(rest, threshold).select(F.col("id").alias("a"), F.col("root").alias("b"))
    # classes stand for the links that made them
    return connected(classes.select(F.col("id").alias("a"), F.col("root").alias("b")).union(second), stages, "lines-classes")


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array(nodes_of(batch.column("id").to_pylist()))], names=["id"])


def _passer(seen: Seen):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(seen.may_hold(batch.column("node").to_numpy())))

    return run


def lost_lines(lines: DataFrame, classes: DataFrame, stages: Stages) -> DataFrame:
    """(row, doc_id, lines) of rows that lose lines, from all lines (row, doc_id, line, digest, node) and classes (id, root) of those with links."""
    # lines of one place and no class have nothing to lose: all others, and few of these, pass the bitmap
    again = lines.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("node").alias("id"))
    asked = Seen(again.union(classes.select("id").mapInArrow(_nodes, "id long")))
    lines = lines.select("row", "doc_id", "line", "digest", "node").mapInArrow(_passer(asked), "row long, doc_id long, line int, digest binary, node long")
    lines = stages.write(lines.drop("node"), "lines-asked")
    # the first place of each different line, then of each class
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "row", "line")
    different = lines.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    of_class = different.join(classes.withColumnRenamed("id", "digest"), "digest", "left").filter((F.col("n") > 1) | F.col("root").isNotNull())
    of_class = stages.write(of_class.withColumn("root", F.coalesce("root", "digest")), "lines-of-class")
    kept = of_class.groupBy("root").agg(F.min("first").alias("kept"))
    kept = stages.write(of_class.join(kept, "root").select("digest", "kept"), "lines-kept")
    lost = lines.join(kept, "digest").filter(~((F.col("row") == F.col("kept.row")) & (F.col("line") == F.col("kept.line"))))
    return lost.groupBy("row", "doc_id").agg(F.sort_array(F.collect_list("line")).alias("lines"))


def read_lines(docs: DataFrame, stages: Stages, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(row, doc_id, n_lines) of all rows of docs (row, doc_id, text), and what repeated_lines returns."""
    rows = docs.select("row", "doc_id", F.col("text").cast("string").alias("text"))
    read = stages.write(rows.mapInArrow(_reader(threshold), LINES), "lines")
    # a line is one node for each length of its shingles, told apart by the low three bits
    each = read.filter(F.col("keys").isNotNull()).select("node", F.inline("keys"))
    keyed = each.select((F.shiftleft(F.shiftright("node", 3), 3) + F.col("chars") - 1).alias("id"), "keys")
    classes = line_classes(keyed, rows, stages, threshold)
    counted = read.filter(F.col("n_lines").isNotNull()).select("row", "doc_id", "n_lines")
    return counted, lost_lines(read.filter(F.col("digest").isNotNull()), classes, stages)


def repeated_lines(docs: DataFrame, stages: Stages, threshold: float = THRESHOLD) -> DataFrame:
    """(row, doc_id, lines): per row of docs (row, doc_id, text) that loses lines, their sorted numbers (from 0)."""
    return read_lines(docs, stages, threshold)[1]


def line_dedup(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, dropped (numbers of the lines that go, from 0)."""
    stages = Stages(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    counted, lost = read_lines(rows, stages, threshold)
    lost = stages.write(lost, "lines-lost")
    out = counted.join(lost.select("row", "lines"), "row", "left").withColumn("dropped", F.coalesce("lines", F.array().cast("array<int>")))
    return out.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), "dropped")


def without_lines(text: Column, lost: Column) -> Column:
    """text without the lines of the given numbers."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(lost, i)), "\n")
