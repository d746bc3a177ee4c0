"""Quality rules with an n-gram perplexity band per language.

The model is a modified Kneser-Ney model of code-point 4-grams, without a bound on alphabet or entries. Tasks count the n-grams
of pieces of PIECE_CHARS characters; Spark adds the counts up, derives the lower orders, and estimates each order by joins, in
rows dealt by the hash of the n-gram, so the model grows with the corpus and lies nowhere whole. Scores go back the same way:
the n-grams of each piece are joined with the model, and the task that scores a piece reads the values of that piece alone.
Since the model is counted over the texts that it judges, each n-gram is judged by the model without one of its occurrences;
otherwise text that stands nowhere else would teach the model itself. No n-gram counts as less likely than a code point drawn
evenly from the language's, so that a key or a name in a good text doesn't outweigh the rest.

A text's perplexity is compared with the band of its language: the quartiles over all texts that pass the base rules,
widened by a multiple of their distance on either side, more for short texts. Texts outside the band are rejected.

Defined edge cases: a null text is empty; a text without characters has no perplexity and fails the base rules; a null
language is a language of its own; repeated rows are rows of their own; a corpus of equal texts has a band of its one
perplexity (all pass); columns other than those named are not read. docs must give the same rows in the same order
when read again (a stored table); a task that finds other n-grams than were counted fails.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.files import give_back, open_folder
from fathomline.session import Stages

ORDER = 4
WIDE = 21  # bits of a code point; a 4-gram is two numbers of two code points (plus one; 0 is the place before a text)
PIECE_CHARS = 8_000_000  # characters whose n-grams are counted together (or one longer text)
TABLE = 1 << 22  # up to so many keys are numbered by a table, more by sorting
# `grams`, `estimate` and `look_up` are the same model in arrays, for alphabets of 62 characters; tests hold the rows to it.
BITS = 6
SYMBOLS = 1 << BITS  # 0 is the place before a text, OTHER any character that is not in the alphabet
OTHER = SYMBOLS - 1
WORD = re.compile(r"[^\x20\x09-\x0D]+")
BLANK = " \t\n\x0b\x0c\r"
MARKS = "#*$%&|<>"
PIECE = 1_000_000  # bytes of text handled at once (or one longer text); two tasks share an executor's memory with its JVM


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


def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(texts: list[str], symbol: np.ndarray) -> np.ndarray:
    """The ORDER-gram that ends at each character, as a number; places before a text are 0."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = symbol[code_points(texts)].astype(np.uint32)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = codes.copy()
    for back in range(1, ORDER):
        earlier = np.zeros_like(codes)
        earlier[back:] = codes[:-back]
        earlier[place < back] = 0
        out |= earlier << np.uint32(BITS * back)
    return out


def dense(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys (below size), and the place of each key among them."""
    if size > TABLE:
        return np.unique(key, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[key] = True
    values = np.flatnonzero(seen)
    rank = np.empty(size, np.int64)
    rank[values] = np.arange(len(values))
    return values, rank[key]


def code_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ORDER-grams, and which of them ends at each character. An n-gram is a complex number of its two halves, which
    are below 2 ** 42, so it is exact and sorts."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = (np.cumsum(sizes) - sizes)[sizes > 0]
    symbols, at = dense(code_points(texts), 0x110000)
    at = at + 1
    base, ids = len(symbols) + 1, at
    single = np.concatenate(([0], symbols.astype(np.int64) + 1))
    table = single[:, None]  # the code points of each number; number 0 is the place before a text
    for _ in range(ORDER - 1):
        before = np.concatenate(([0], ids[:-1]))[: len(ids)]
        before[first] = 0
        keys, ids = dense(before * base + at, len(table) * base)
        ids = ids + 1
        grown = np.column_stack((table[keys // base], single[keys % base]))
        table = np.concatenate((np.zeros((1, grown.shape[1]), np.int64), grown))
    left, right = ((table[1:, k] << WIDE) | table[1:, k + 1] for k in (0, 2))
    return left + 1j * right, ids - 1


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of batches in slices of PIECE bytes of text: Spark's batches have a number of rows, however long these are."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        for begin, end in runs(sizes):
            yield batch.slice(begin, end - begin)


def piece_rows(batch: pa.RecordBatch, before: int) -> Iterator[tuple[int, dict[str | None, list[int]]]]:
    """The batch's rows by piece and language; `before` characters of the task's rows precede it."""
    sizes = np.array([len(t or "") for t in batch.column("text").to_pylist()], np.int64)
    number = (before + np.cumsum(sizes) - sizes) // PIECE_CHARS
    langs = batch.column("lang").to_pylist()
    for piece in np.unique(number):
        rows: dict[str | None, list[int]] = {}
        for i in np.flatnonzero(number == piece):
            rows.setdefault(langs[i], []).append(i)
        yield int(piece), rows


def piece_name(piece: int) -> str:
    return f"p{TaskContext.get().partitionId()}x{piece}"


def lang_key(lang: str | None) -> str:
    return "" if lang is None else f"x{lang}"


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str | None, list[tuple[np.ndarray, np.ndarray]]] = {}

    def flush(piece: int) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            keys, n = merged(parts)
            for at in range(0, len(keys), 100_000):
                k = keys[at : at + 100_000]
                names = [pa.array([x] * len(k), pa.string()) for x in (piece_name(piece), lang_key(lang))]
                columns = [pa.array(x.astype(np.int64)) for x in (k.real, k.imag, n[at : at + 100_000])]
                yield pa.RecordBatch.from_arrays(names + columns, names=["piece", "lang", "a", "b", "n"])
        held.clear()

    now, before = 0, 0
    for batch in slices(batches):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        for piece, by_lang in piece_rows(batch, before):
            if piece != now:
                yield from flush(now)
                now = piece
            for lang, rows in by_lang.items():
                mine = [texts[i] for i in rows]
                for begin, end in runs(list(map(len, mine))):
                    keys, ids = code_grams(mine[begin:end])
                    parts = held.setdefault(lang, [])
                    parts.append((keys, np.bincount(ids, minlength=len(keys))))
                    if len(parts) > 16:
                        held[lang] = [merged(parts)]
        before += sum(map(len, texts))
    yield from flush(now)
    give_back()


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def _discounted(c: Column) -> Column:
    """The discount of a count, from the numbers n1 to n4 of n-grams seen one to four times (see discounts)."""
    n = [F.greatest(F.lit(1), F.col(f"n{i}")).cast("double") for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    d = [F.least(F.greatest(i - (i + 1) * y * n[i] / n[i - 1], F.lit(0.05)), F.lit(i - 0.05)) for i in (1, 2, 3)]
    return F.when(c >= 3, d[2]).when(c == 2, d[1]).when(c == 1, d[0]).otherwise(0.0)


def model(counts: DataFrame, stages: Stages) -> DataFrame:
    """(lang, a, b, p, alone, even) from the ORDER-gram counts (lang, a, b, c): the probability of the last code point after the others,
    what it is without one occurrence of the n-gram, and one over the language's code points and one unknown. An n-gram of a lower order has zeros in front."""
    last = F.lit((1 << WIDE) - 1)
    levels = [counts]
    for shorter in ((F.col("a").bitwiseAND(last), F.col("b")), (F.lit(0).cast("long"), F.col("b")), (F.lit(0).cast("long"), F.col("b").bitwiseAND(last))):
        lower = levels[-1].groupBy("lang", shorter[0].alias("a"), shorter[1].alias("b")).agg(F.count(F.lit(1)).alias("c"))
        levels.append(stages.write(lower, f"perplexity-order-{ORDER - len(levels)}"))
    levels.reverse()
    seen = [F.count_if(F.col("c") == i).alias(f"n{i}") for i in range(1, 5)]
    below = None
    for n, level in enumerate(levels, 1):
        of_lang = stages.write(level.groupBy("lang").agg(*seen, F.count(F.lit(1)).alias("types")), f"perplexity-seen-{n}")
        rows = level.join(of_lang, "lang").select(
            "lang", "a", "b", "c", "types", F.shiftright("b", WIDE).alias("head"), _discounted(F.col("c")).alias("d"), _discounted(F.col("c") - 1).alias("less")
        )
        context = ["lang", "a", "head"]
        rows = rows.join(rows.groupBy(context).agg(F.sum("c").alias("total"), F.sum("d").alias("given")), context)
        if n == 1:  # the lowest order gives to all code points of the language and one unknown alike
            rows = rows.withColumn("even", 1 / (F.col("types") + 1)).withColumn("p_low", F.col("even")).withColumn("alone_low", F.col("even"))
        else:
            a = F.col("a").bitwiseAND(last) if n == 4 else F.lit(0).cast("long")
            b = F.col("b").bitwiseAND(last) if n == 2 else F.col("b")
            low = below.select("lang", F.col("a").alias("a_low"), F.col("b").alias("b_low"), F.col("p").alias("p_low"), F.col("alone").alias("alone_low"), "even")
            rows = rows.withColumn("a_low", a).withColumn("b_low", b).join(low, ["lang", "a_low", "b_low"])
        p = (F.col("c") - F.col("d") + F.col("given") * F.col("p_low")) / F.col("total")
        # an n-gram that was seen once is also one less among the continuations of the lower order
        lower = F.when(F.col("c") == 1, F.col("alone_low")).otherwise(F.col("p_low"))
        less = F.col("c") - 1 - F.col("less") + (F.col("given") - F.col("d") + F.col("less")) * lower
        alone = F.when(F.col("total") == 1, F.col("alone_low")).otherwise(less / (F.col("total") - 1))
        below = stages.write(rows.select("lang", "a", "b", p.alias("p"), alone.alias("alone"), "even"), f"perplexity-model-{n}")
    return below


def hashed(gram: np.ndarray, n: int) -> np.ndarray:
    """The place of an n-gram in the sorted arrays: a one-to-one scramble of its number and order."""
    h = gram.astype(np.uint32) | np.uint32((n - 1) << (BITS * ORDER))
    h = (h ^ (h >> np.uint32(16))) * np.uint32(2246822519)
    return h ^ (h >> np.uint32(13))


def discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts of counts 0, 1, 2, and 3 or more, from the numbers of n-grams seen one to four times."""
    n = [max(1, int((counts == i).sum())) for i in range(1, 5)]
    y = n[0] / (n[0] + 2 * n[1])
    return np.array([0.0] + [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)])


def estimate(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes, log probabilities and log back-off weights (of contexts) from the ORDER-gram counts of a language."""
    levels = [(keys.astype(np.int64), counts.astype(np.int64))]
    for n in range(ORDER - 1, 0, -1):  # a lower order counts in how many ways its n-grams are continued to the left
        levels.append(np.unique(levels[-1][0] & ((1 << (BITS * n)) - 1), return_counts=True))
    levels.reverse()
    probability, root = None, 0.0
    grams_at, contexts_at = [], []  # (hashes, logs) of each order; a context that begins a text is no n-gram itself
    for n, (k, c) in enumerate(levels, 1):
        d = discounts(c)[np.minimum(c, 3)]
        context, inverse = np.unique(k >> BITS, return_inverse=True)
        total = np.bincount(inverse, c)
        left = np.bincount(inverse, d) / total  # the mass that this context gives to the lower order
        lower = 1.0 / SYMBOLS if n == 1 else probability[np.searchsorted(levels[n - 2][0], k & ((1 << (BITS * (n - 1))) - 1))]
        probability = (c - d) / total[inverse] + left[inverse] * lower
        grams_at.append((hashed(k, n), np.log(probability)))
        if n == 1:
            root = np.log(left[0])
        else:
            contexts_at.append((hashed(context, n - 1), np.log(left)))
    h, p = (np.concatenate(x) for x in zip(*grams_at))
    ch, cw = (np.concatenate(x) for x in zip(*contexts_at))
    every = np.unique(np.concatenate((h, ch)))
    logp, back = np.full(len(every), np.nan, np.float32), np.zeros(len(every), np.float32)
    logp[np.searchsorted(every, h)] = p
    back[np.searchsorted(every, ch)] = cw
    logp[np.isnan(logp)] = -np.inf
    return every, logp, np.append(back, np.float32(root))


def look_up(gram: np.ndarray, n: int, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Log probability of the last symbol of distinct n-grams, backing off where an n-gram is not in the arrays."""
    hashes, logp, back = model
    if n == 0:
        return np.full(len(gram), back[-1] - np.log(SYMBOLS), np.float32)
    h = hashed(gram, n)
    at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
    out = np.where(hashes[at] == h, logp[at], -np.inf).astype(np.float32)
    missing = np.flatnonzero(np.isneginf(out))
    if len(missing):
        rest = gram[missing]
        weight = np.zeros(len(missing), np.float32)
        if n > 1:
            c = hashed(rest >> np.uint32(BITS), n - 1)
            where = np.minimum(np.searchsorted(hashes, c), len(hashes) - 1)
            weight = np.where(hashes[where] == c, back[where], 0)
        out[missing] = weight + look_up(rest & np.uint32((1 << (BITS * (n - 1))) - 1), n - 1, model)
    return out


def load(folder: str, piece: str) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Per language of a piece, its sorted n-grams and their log probabilities, from the shared folder."""
    place, path = open_folder(folder)
    columns = ["lang", "a", "b", "logp"]
    rows = pq.read_table(f"{path}/piece={piece}", filesystem=place, columns=columns, partitioning=None)
    lang_of = rows.column("lang").combine_chunks().dictionary_encode()
    number = lang_of.indices.to_numpy()
    a, b, logp = (rows.column(n).to_numpy() for n in columns[1:])
    out = {}
    for k, lang in enumerate(lang_of.dictionary.to_pylist()):
        mine = np.flatnonzero(number == k)
        keys = np.empty(len(mine), np.complex128)
        keys.real, keys.imag = a[mine], b[mine]
        order = np.argsort(keys)
        out[lang] = keys[order], logp[mine][order]
    return out


def values_of(keys: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    at = np.minimum(np.searchsorted(known[0], keys), len(known[0]) - 1)
    if (known[0][at] != keys).any():
        raise RuntimeError("the documents changed between counting and scoring")
    return known[1][at]


def repeated_words(found: list[list[str]]) -> np.ndarray:
    """Per text, its words that lie in a 3-word window which the text holds twice or more."""
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    flat = pa.array([w for f in found for w in f], pa.string()).dictionary_encode()
    ids = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.repeat(np.arange(len(found)), sizes)
    if len(ids) < 3:
        return np.zeros(len(found), np.int64)
    whole = np.flatnonzero(text[2:] == text[:-2])
    _, pair = np.unique(ids[whole] * (ids.max() + 1) + ids[whole + 1], return_inverse=True)
    _, window = np.unique(pair * (ids.max() + 1) + ids[whole + 2], return_inverse=True)
    _, inverse, times = np.unique(window * np.int64(len(found)) + text[whole], return_inverse=True, return_counts=True)
    again = whole[times[inverse] > 1]
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[again + k] = True
    return np.bincount(text[hit], minlength=len(found))


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line of the text."""
    lines = [line for line in text.split("\n") if line.strip(BLANK)] if "\n" in text else []
    return len(lines) - len(set(lines))


COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, chars long, nats double"


def _scorer(folder: str, keep: list[str]):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank, mark = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
        blank[[ord(c) for c in BLANK]] = True
        mark[[ord(c) for c in MARKS]] = True
        loaded, known, before = None, {}, 0
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            columns = np.zeros((6, len(texts)), np.int64)
            nats = np.zeros(len(texts))
            for piece, lang, rows in ((p, *x) for p, by_lang in piece_rows(batch, before) for x in by_lang.items()):
                for begin, end in runs([len(texts[i]) for i in rows]):
                    at = np.array(rows[begin:end])
                    part = [texts[i] for i in at]
                    sizes = np.fromiter(map(len, part), np.int64, len(part))
                    codes = code_points(part)
                    owner = np.repeat(np.arange(len(part)), sizes)
                    found = [WORD.findall(t) for t in part]
                    columns[0, at] = np.fromiter(map(len, found), np.int64, len(found))
                    columns[1, at] = np.bincount(owner, ~blank[codes], len(part))
                    columns[2, at] = np.bincount(owner, mark[codes], len(part))
                    columns[3, at] = [repeated_lines(t) for t in part]
                    columns[4, at] = repeated_words(found)
                    columns[5, at] = sizes
                    if len(codes):
                        if piece != loaded:
                            known = {}  # the piece before goes first
                            loaded, known = piece, load(folder, piece_name(piece))
                        keys, ids = code_grams(part)
                        nats[at] = -np.bincount(owner, values_of(keys, known[lang_key(lang)])[ids], len(part))
            before += sum(map(len, texts))
            names = [c.split()[0] for c in COUNTS.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), *map(pa.array, columns), pa.array(nats)], names=[*keep, *names]
            )
        known = {}
        give_back()

    return score


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measure(docs: DataFrame, keep: list[str], stages: Stages) -> DataFrame:
    """`keep` columns of docs (lang among them) with base counts, characters and nats under the language's model, written to
    the shared folder. The model is counted over all of docs."""
    rows = docs.select(*keep, F.col("text").cast("string").alias("text"))
    found = stages.write(rows.mapInArrow(_counter, "piece string, lang string, a long, b long, n long"), "perplexity-grams")
    counts = stages.write(found.groupBy("lang", "a", "b").agg(F.sum("n").alias("c")), "perplexity-counts")
    judged = model(counts, stages).select("lang", "a", "b", F.log(F.greatest("alone", "even")).cast("float").alias("logp"))
    values = found.drop("n").join(judged, ["lang", "a", "b"]).repartition("piece")
    folder = stages.put(values, "perplexity-values", "piece")
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep) + ", " + COUNTS
    return stages.write(rows.mapInArrow(_scorer(folder, keep), schema), "perplexity-scores")


def verdicts(measured: DataFrame, width: float = 2.5, short: float = 300.0) -> DataFrame:
    """measured with perplexity, base_failed and kept. A band reaches `width` quartile distances beyond the quartiles of its
    language (over texts that pass the base rules), times 1 + sqrt(short / characters) for short texts."""
    x = F.col("nats") / F.col("chars")
    rows = measured.withColumn("x", F.when(F.col("chars") > 0, x)).withColumn("base_failed", base_failed())
    bands = rows.filter(~F.col("base_failed")).groupBy("lang").agg(F.percentile_approx("x", [0.25, 0.75], 10_000).alias("q"))
    rows = rows.alias("a").join(bands.alias("b"), F.col("a.lang").eqNullSafe(F.col("b.lang")), "left").select("a.*", "b.q")
    low, high = F.get("q", F.lit(0)), F.get("q", F.lit(1))
    # Spark takes the reach of a row before it looks at x, so a text without characters must have one (null) and not an error
    reach = width * (high - low) * (1 + F.sqrt(F.try_divide(F.lit(short), F.col("chars")))) + 1e-6
    inside = (F.col("x") >= low - reach) & (F.col("x") <= high + reach)
    return rows.withColumn("perplexity", F.exp("x")).withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))).drop("q", "x")


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, base counts, base_failed, kept, and the perplexity per character."""
    stages = Stages(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text")
    judged = verdicts(measure(rows, ["doc_id", "lang"], stages))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "perplexity")
