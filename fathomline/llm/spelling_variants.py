"""Groups of spelling variants: each word of a corpus with its near words, found by Bloom-guided neighbourhoods.

Words are counted by tasks and summed. Two words are near if one inserted, deleted or replaced code point makes one of the
other. For every word the results of all deletions and of all replacements by a later letter are hashed (insertions are deletions of the
longer word, replacements by an earlier letter are found from the other side) and probed against blocked Bloom filters, one for
each word length, in which a word sets four bits of one 64-bit block. The filters are sent to all tasks; their bits grow with the
vocabulary up to `FILTER_BYTES` in all, and beyond that they only let more through. Hashes of edits that pass are shuffled and
joined to the hashes of the vocabulary, and what meets is compared as text, so false positives and hash collisions go and
nothing is lost. An edit's hash is made from the word's by a few operations (a polynomial over code points), so a long word's edits
are never spelled out.

A word's form is its near word of most occurrences (ties: smallest in code-point order) if it has `RATIO` times the word's; its root is where
forms lead. Counts rise at each step, so there is no cycle and forms are followed by doubling in a few rounds.

Defined edge cases: a null text has no words; a null doc_id is empty text in the hash that spoils runs; a run of any
length is taken whole; repeated rows count again (and are spoiled alike); a run left with too few code points is no word; an empty
table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.near import GOLD, MIX1, scramble
from fathomline.session import Stages

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
LETTERS = np.array([*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)], np.uint64)  # code points of a word, in order
SPOIL, LEAST_CHARS, LEAST_COUNT, RATIO = 199, 6, 5, 5
HELD = 200_000  # different words that a task counts before it passes them on
FILTER_BYTES, BITS_PER_WORD = 32 << 20, 16
AT_ONCE = 1 << 20  # edits hashed at once
BASE = np.uint64(0xD6E8FEB86659FD93)  # odd, so that it has an inverse
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


# --- words and their counts ---


def words_of(doc_id: object, text: str, spoil: int = SPOIL) -> Counter:
    """Occurrences of each word of a text: runs of letters, A to Z in lower case, one code point less where the run's hash says so."""
    lowered: Counter = Counter()
    for run, n in Counter(RUN.findall(text)).items():
        lowered[run.translate(LOWER)] += n
    start, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in lowered.items():
        h = zlib.crc32(run.encode(), start)
        if h % spoil == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += n
    return out


def _counter(spoil: int, least_chars: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def given() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, n in words_of(doc_id, text or "", spoil).items():
                    if len(word) >= least_chars:
                        held[word] += n
                if len(held) > HELD:
                    yield given()
        yield given()

    return count


def vocabulary(docs: DataFrame, spoil: int = SPOIL, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of all words with enough code points and occurrences."""
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_counter(spoil, least_chars), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= least_count)


# --- hashes of words and of their edits ---


def powers(n: int) -> np.ndarray:
    """BASE to the power of 0 to n - 1."""
    out = np.full(n, BASE)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def code_values(codes: np.ndarray) -> np.ndarray:
    return scramble((codes.astype(np.uint64) + np.uint64(1)) * GOLD)


def word_codes(words: list[str]) -> np.ndarray:
    """words of one length x code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def sums(codes: np.ndarray) -> np.ndarray:
    """The polynomials whose scrambled values are the words' hashes."""
    return (code_values(codes) * powers(codes.shape[1])).sum(1, dtype=np.uint64)


def edits(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(word's row, hash, length) of all deletions and all replacements by a later letter, in pieces of bounded size."""
    n, length = codes.shape
    for begin, end in ((b, min(n, b + max(1, AT_ONCE // length))) for b in range(0, n, max(1, AT_ONCE // length))):
        part = codes[begin:end]
        power = powers(length)
        terms = code_values(part) * power
        total = terms.sum(1, dtype=np.uint64)
        upto = np.cumsum(terms, 1, dtype=np.uint64)
        rows = np.repeat(np.arange(begin, end), length)
        # without code point i: what stands before it, and what follows one place further down
        shorter = upto - terms + (total[:, None] - upto) * INVERSE
        yield rows, scramble(shorter.ravel()), length - 1
        for letter, value in zip(LETTERS, code_values(LETTERS)):
            later = part < letter
            changed = total[:, None] + (value * power)[None, :] - terms
            at = np.nonzero(later)
            yield at[0] + begin, scramble(changed[at]), length


# --- blocked Bloom filters by length ---


def bloom_mask(h: np.ndarray) -> np.ndarray:
    """Four bits of a 64-bit block."""
    one, out = np.uint64(1), np.zeros(len(h), np.uint64)
    for shift in (0, 6, 12, 18):
        out |= one << ((h >> np.uint64(shift)) & np.uint64(63))
    return out


def bloom_block(h: np.ndarray, blocks: int) -> np.ndarray:
    """The block of a hash; blocks is a power of two."""
    return (h >> np.uint64(24)) & np.uint64(blocks - 1)


def filter_sizes(words: dict[int, int], most_bytes: int = FILTER_BYTES) -> dict[int, int]:
    """Blocks of 64 bits for each length: powers of two with BITS_PER_WORD bits a word, halved until all fit into most_bytes
    (lengths of one block each beyond that share it)."""
    sizes = {length: 1 << max(0, (n * BITS_PER_WORD // 64 - 1).bit_length()) for length, n in words.items()}
    while 8 * sum(sizes.values()) > most_bytes and max(sizes.values()) > 1:
        sizes = {length: max(1, n // 2) for length, n in sizes.items()}
    return sizes


def _hasher(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = batch.column("word").to_pylist()
        h = np.zeros(len(words), np.uint64)
        for length, at in by_length(words):
            h[at] = scramble(sums(word_codes([words[k] for k in at])))
        lengths = pa.array([len(w) for w in words], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("word"), batch.column("n"), lengths, pa.array(h.view(np.int64))], names=["word", "n", "size", "h"])


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.array([len(w) for w in words], np.int64)
    for length in np.unique(sizes).tolist():
        yield length, np.flatnonzero(sizes == length)


class LengthFilters:
    """A blocked Bloom filter for each word length, of bounded size in all, built by Spark.

    The lengths come to the driver with their counts; those beyond MOST_LENGTHS (long runs, rare) share one filter."""

    MOST_LENGTHS = 256

    def __init__(self, hashed: DataFrame, most_bytes: int = FILTER_BYTES):
        place = F.least("size", F.lit(self.MOST_LENGTHS))
        counts = {r["size"]: r["count"] for r in hashed.groupBy(place.alias("size")).count().collect()}
        self.sizes = filter_sizes(counts, most_bytes) if counts else {}
        self.starts = dict(zip(self.sizes, np.cumsum([0, *self.sizes.values()]).tolist()))
        self.words = np.zeros(sum(self.sizes.values()), np.uint64)
        if not counts:
            return
        starts, sizes = (F.create_map(*[F.lit(x) for kv in m.items() for x in kv])[place] for m in (self.starts, self.sizes))
        block = starts + F.shiftrightunsigned("h", 24).bitwiseAND((sizes - 1).cast("long"))
        bits = F.lit(0).cast("long")
        for shift in (0, 6, 12, 18):
            bits = bits.bitwiseOR(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {shift}) & 63 as int))"))
        got = hashed.select(block.alias("at"), bits.alias("b")).groupBy("at").agg(F.expr("bit_or(b)").alias("b")).toArrow()
        self.words[got["at"].to_numpy()] = got["b"].to_numpy().view(np.uint64)

    def may_hold(self, h: np.ndarray, length: int) -> np.ndarray:
        length = min(length, self.MOST_LENGTHS)
        if length not in self.sizes:
            return np.zeros(len(h), bool)
        mask = bloom_mask(h)
        block = bloom_block(h, self.sizes[length]).astype(np.int64) + self.starts[length]
        return self.words[block] & mask == mask


def _prober(filters: LengthFilters):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, own = batch.column("word").to_pylist(), batch.column("h").to_numpy()
            for length, at in by_length(words):
                codes = word_codes([words[k] for k in at])
                for rows, h, size in edits(codes):
                    yes = filters.may_hold(h, size)
                    if yes.any():
                        columns = [pa.array(own[at[rows[yes]]]), pa.array(h[yes].view(np.int64)), pa.array(np.full(yes.sum(), size, np.int32))]
                        yield pa.RecordBatch.from_arrays(columns, names=["h", "other", "other_size"])

    return probe


def near_words(words: DataFrame, stages: Stages, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """(word, n, near, near_n): every pair of near words of (word, n), from both sides."""
    hashed = stages.write(words.mapInArrow(_hasher, "word string, n long, size int, h long"), "variants-words")
    filters = LengthFilters(hashed, most_bytes)
    passed = hashed.repartition("word").mapInArrow(_prober(filters), "h long, other long, other_size int").distinct()
    mine = hashed.select("h", "word", "n")
    theirs = hashed.select(F.col("h").alias("other"), F.col("size").alias("other_size"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = passed.join(theirs, ["other", "other_size"]).join(mine, "h")
    # one edit: a distance of one between different words; hashes only brought them together
    pairs = met.filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n").distinct()
    pairs = stages.write(pairs, "variants-pairs")
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


# --- forms and roots ---


def roots(forms: DataFrame, stages: Stages) -> DataFrame:
    """(word, root) of words that have a form, from (word, form): forms followed to the last, twice as far in each round."""
    far, turn = stages.write(forms.select("word", F.col("form").alias("root")), "variants-roots-0"), 0
    while True:
        further = far.select(F.col("word").alias("root"), F.col("root").alias("next"))
        turn += 1
        after = far.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = stages.write(after, f"variants-roots-{turn}")
        stages.remove(f"variants-roots-{turn - 1}")
        far = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return far


def spelling_variants(docs: DataFrame, ratio: int = RATIO, most_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    stages = Stages(docs.sparkSession)
    words = stages.write(vocabulary(docs), "variants-vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    around = near_words(words, stages, most_bytes).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    far = (-F.col("best.less") >= ratio * F.col("n")) & F.col("best").isNotNull()
    out = words.join(around, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, F.col("best.near")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n")
    )
    out = stages.write(out, "variants-forms")
    found = roots(out.filter(F.col("form").isNotNull()), stages)
    return out.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The checksum of each run is made byte by byte from a table that the query derives; near words share a word with one code point left out or masked.
SQL = r"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END FROM bits WHERE k < 8
),
steps AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
found AS (
  SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM found GROUP BY ALL
),
bytes AS (
  SELECT run, n, list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM runs
),
summed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) AS h FROM bytes, steps
),
spoiled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM summed
),
words AS (SELECT word, sum(n)::BIGINT AS n FROM spoiled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, n, unnest(range(length(word)))::INT AS i FROM words),
cut AS (SELECT word, n, substr(word, 1, i) || substr(word, i + 2) AS rest, substr(word, 1, i) || '*' || substr(word, i + 2) AS masked FROM places),
pairs AS (
  SELECT DISTINCT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.masked = b.masked AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON w.word = c.rest
),
ranked AS (SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS k FROM pairs),
forms AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.near_n >= 5 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 5 * w.n THEN r.near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.k = 1
),
follow(word, root, steps) AS (
  SELECT word, word, 0 FROM forms
  UNION ALL
  SELECT follow.word, forms.form, follow.steps + 1 FROM follow JOIN forms ON forms.word = follow.root WHERE forms.form IS NOT NULL
),
last AS (SELECT word, arg_max(root, steps) AS root FROM follow GROUP BY word)
SELECT f.word, f.form, l.root, f.n, f.n_near::BIGINT AS n_near, f.form_n FROM forms f JOIN last l USING (word)
"""
