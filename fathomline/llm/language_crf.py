"""Language labels for words by a linear-chain conditional random field.

A word is described by its character n-grams of one to four letters, bounded by marks so that those at its ends are its
affixes, and by a lexicon of words that several training texts share. Weights of these features and of the transitions
between labels are learned together, by gradient steps on the likelihood that forward-backward gives. Training sequences
join stretches of texts in different languages, so transitions are learned from code-switched text. Words of a text get
the label with the highest posterior; a text is given the language that holds most letters.

The fit is made on the driver from a bounded sample: about `sample` stretches of `stretch` words, each from a text whose key
hash falls below a threshold, drawn evenly over languages. Everything is applied to whole texts, in batches of words.

Defined edge cases: a null text, or one without a letter, is `und` with score 0; without any training text all are; null
languages are never learned; repeated rows are rows of their own; columns other than those named are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W\d_]+")
GRAMS = (1, 2, 3, 4)
SPACE = 1 << 16  # hashed n-gram features
UNKNOWN = "und"


def mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint32(2654435761)
    h ^= h >> np.uint32(15)
    h *= np.uint32(2246822519)
    return h ^ (h >> np.uint32(13))


def features(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each word's characters start, and for each length of n-gram the feature of the n-gram at each character (SPACE
    where the word ends before it does)."""
    sized = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    codes = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum(sized)[:-1]))
    left = np.repeat(starts + sized, sized) - np.arange(len(codes))  # characters left in the word
    out, h = [], np.zeros(len(codes), np.uint32)
    for n in GRAMS:
        shifted = np.zeros_like(codes)
        shifted[: len(codes) - n + 1] = codes[n - 1 :]
        h = h * np.uint32(0x01000193) ^ shifted
        index = (mixed(h + np.uint32(n * 7919)) & np.uint32(SPACE - 1)).astype(np.int32)
        index[left < n] = SPACE
        out.append(index)
    return starts, out


@dataclass
class Model:
    """labels; weights of hashed features (the last row is 0), of lexicon words (the last row is 0), and of transitions."""

    labels: list[str]
    grams: np.ndarray
    lexicon: dict[str, int]
    lexical: np.ndarray
    moves: np.ndarray

    def scores(self, words: list[str]) -> np.ndarray:
        """Label scores of distinct words."""
        if not words:
            return np.zeros((0, len(self.labels)), np.float32)
        words = [w.lower() for w in words]
        total = self.lexical[np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))].copy()
        starts, grams = features(words)
        for index in grams:
            total += np.add.reduceat(self.grams[index], starts)
        return total


def posteriors(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward-backward over many sequences at once, laid end to end in `scores` (words x labels).

    Returns word posteriors, expected transitions (labels x labels, summed) and the log of all normalisers. Sequences advance
    together, longest first, so one step costs one small matrix product for all that still have a word."""
    k = scores.shape[1]
    peak = scores.max(1, keepdims=True) if len(scores) else np.zeros((0, 1))
    local = np.exp(scores - peak)
    step = np.exp(moves)
    order = np.argsort(-lengths, kind="stable")
    first = (np.cumsum(lengths) - lengths)[order]
    sized = lengths[order]
    most = int(sized[0]) if len(sized) else 0
    live = np.searchsorted(-sized, -np.arange(most), side="left")  # sequences longer than t
    forward = np.empty_like(local)
    norms = np.empty(len(local))
    previous = None
    for t in range(most):
        at = first[: live[t]] + t
        a = local[at] if previous is None else local[at] * (previous[: live[t]] @ step)
        z = a.sum(1)
        a /= z[:, None]
        forward[at], norms[at] = a, z
        previous = a
    gamma = np.empty_like(local)
    pairs = np.zeros((k, k))
    beta = np.ones((0, k))
    for t in range(most - 1, -1, -1):
        at = first[: live[t]] + t
        new = np.ones((live[t], k))
        m = len(beta)
        if m:
            after = first[:m] + t + 1
            right = beta * local[after] / norms[after][:, None]
            new[:m] = right @ step.T
            pairs += forward[at[:m]].T @ right
        gamma[at] = forward[at] * new
        beta = new
    return gamma, pairs * step, float(np.log(norms).sum() + peak.sum())


def fit(stretches: list[tuple[str, list[str]]], rounds: int = 45, rate: float = 0.15, decay: float = 2e-6, shared_by: int = 3) -> Model:
    """Learn a model from (label, words) stretches. Neighbours in a fixed shuffled order are joined in fours, which makes
    code-switched sequences."""
    labels = sorted({label for label, _ in stretches})
    number = {label: i for i, label in enumerate(labels)}
    k, turn = len(labels), np.random.RandomState(7).permutation(len(stretches))
    rows = [stretches[i] for i in turn]
    flat = [w.lower() for _, words in rows for w in words]
    vocabulary, ids = np.unique(np.array(flat, object), return_inverse=True)
    truth = np.repeat([number[label] for label, _ in rows], [len(w) for _, w in rows])
    sizes = np.array([len(w) for _, w in rows])
    lengths = np.add.reduceat(sizes, np.arange(0, len(sizes), 4))
    spread: dict[str, int] = {}
    for _, words in rows:
        for w in {w.lower() for w in words}:
            spread[w] = spread.get(w, 0) + 1
    lexicon = {w: i for i, w in enumerate(sorted(w for w, n in spread.items() if n >= shared_by))}
    known = np.fromiter((lexicon.get(w, len(lexicon)) for w in vocabulary), np.int64, len(vocabulary))
    starts, grams = features(list(vocabulary))
    owner = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(starts, len(grams[0]))))
    w = [np.zeros((SPACE + 1, k)), np.zeros((len(lexicon) + 1, k)), np.zeros((k, k))]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    inner = np.ones(len(flat) - 1, bool)
    inner[np.cumsum(lengths)[:-1] - 1] = False
    moved = np.zeros((k, k))
    np.add.at(moved, (truth[:-1][inner], truth[1:][inner]), 1)
    observed = np.stack([np.bincount(ids[truth == j], minlength=len(vocabulary)) for j in range(k)], 1)
    for r in range(1, rounds + 1):
        total = w[1][known].copy()
        for index in grams:
            total += np.add.reduceat(w[0][index], starts)
        gamma, pairs, _ = posteriors(total[ids], lengths, w[2])
        miss = np.stack([np.bincount(ids, gamma[:, j], len(vocabulary)) for j in range(k)], 1) - observed
        spread_out = miss[owner]
        g = [sum(np.stack([np.bincount(i, spread_out[:, j], SPACE + 1) for j in range(k)], 1) for i in grams)]
        g += [np.stack([np.bincount(known, miss[:, j], len(lexicon) + 1) for j in range(k)], 1), pairs - moved]
        for x, d, first, second in zip(w, g, m, v):
            d = d / len(flat) + decay * x
            first += 0.1 * (d - first)
            second += 0.02 * (d * d - second)
            x -= rate * (first / (1 - 0.9**r)) / (np.sqrt(second / (1 - 0.98**r)) + 1e-6)
        w[0][-1] = w[1][-1] = 0
    return Model(labels, w[0].astype(np.float32), lexicon, w[1].astype(np.float32), w[2])


def _stretches(stretch: int):
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, out = [], []
            for lang, text, h in zip(*(batch.column(n).to_pylist() for n in ("lang", "text", "h"))):
                words = WORD.findall(text or "")
                at = h % max(1, len(words) - stretch + 1)
                if words:
                    langs.append(lang)
                    out.append(words[at : at + stretch])
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(out, pa.list_(pa.string()))], names=["lang", "words"])

    return take


def sample_stretches(docs: DataFrame, sample: int = 3000, stretch: int = 60) -> list[tuple[str, list[str]]]:
    """About `sample` stretches in all, evenly over languages; docs has lang (not null), text and a long key."""
    counts = {r[0]: r[1] for r in docs.groupBy("lang").agg(F.count(F.lit(1))).collect()}
    if not counts:
        return []
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, sample / len(counts) / n)))])
    h = F.xxhash64(F.lit("stretch"), "key")
    chosen = docs.withColumn("h", F.shiftrightunsigned(h, 1)).filter(F.col("h") / float(1 << 63) < F.get(F.array(F.element_at(share, F.col("lang"))), F.lit(0)))
    rows = chosen.select("lang", "text", "h").mapInArrow(_stretches(stretch), "lang string, words array<string>").collect()
    return sorted((r[0], list(r[1])) for r in rows)


def _labeller(model: Model, keep: list[str], spans: bool, most_words: int = 1_000_000):
    """Per text: language, score and, where asked for, stretches of words of one language."""

    def label(texts: list[str | None]) -> tuple[list, list, list]:
        langs, scores, stretches = [], [], []
        found = [WORD.findall(t) if t else [] for t in texts]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        # runs of texts of up to most_words words (or one longer text) are labelled together
        begin = 0
        while begin < len(found):
            end, n = begin + 1, sizes[begin]
            while end < len(found) and n + sizes[end] <= most_words:
                n += sizes[end]
                end += 1
            flat = pa.array([w for words in found[begin:end] for w in words], pa.string()).dictionary_encode()
            vocabulary = flat.dictionary.to_pylist()
            ids = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            letters = np.fromiter((sum(map(str.isalpha, w)) for w in vocabulary), np.int64, len(vocabulary))
            gamma, _, _ = posteriors(model.scores(vocabulary)[ids].astype(np.float64), sizes[begin:end], model.moves)
            weight = letters[ids] if len(ids) else np.zeros(0)
            edges = np.concatenate(([0], np.cumsum(sizes[begin:end])))
            sums = np.concatenate((np.zeros((1, gamma.shape[1])), np.cumsum(gamma * weight[:, None], 0)))
            held = sums[edges[1:]] - sums[edges[:-1]]
            for i, row in enumerate(held):
                total = row.sum()
                langs.append(model.labels[int(row.argmax())] if total > 0.5 else UNKNOWN)
                scores.append(float(min(1.0, max(0.0, row.max() / total))) if total > 0.5 else 0.0)
                if spans:
                    stretches.append(_spans(texts[begin + i] or "", gamma[edges[i] : edges[i + 1]].argmax(1), model.labels))
            begin = end
        return langs, scores, stretches

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, stretches = label(batch.column("text").to_pylist())
            columns = [batch.column(n) for n in keep] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            names = [*keep, "lang_pred", "score"]
            if spans:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))
                columns, names = [*columns, pa.array(stretches, kind)], [*names, "stretches"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _spans(text: str, best: np.ndarray, labels: list[str]) -> list[dict]:
    out: list[dict] = []
    for m, j in zip(WORD.finditer(text), best):
        if out and out[-1]["lang"] == labels[j]:
            out[-1]["end"] = m.end()
        else:
            out.append({"start": m.start(), "end": m.end(), "lang": labels[j]})
    return out


def label_texts(docs: DataFrame, model: Model | None, keep: list[str], spans: bool = False) -> DataFrame:
    """`keep` columns of docs with lang_pred and score of text and, where asked for, the stretches in one language each
    (start and end in code points)."""
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep) + ", lang_pred string, score double"
    schema += ", stretches array<struct<start:int,end:int,lang:string>>" if spans else ""
    model = model or Model([UNKNOWN], np.zeros((SPACE + 1, 1), np.float32), {}, np.zeros((1, 1), np.float32), np.zeros((1, 1)))
    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(_labeller(model, keep, spans), schema)


def predict_languages(docs: DataFrame, held_out: Column, sample: int = 3000) -> DataFrame:
    """Learn from the rows that are not held out and label all: doc_id, held_out, lang_pred, score."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text", F.col("lang").cast("string").alias("lang"))
    train = rows.filter(~F.col("held_out") & F.col("lang").isNotNull() & F.col("text").isNotNull())
    stretches = sample_stretches(train.select("lang", "text", F.col("doc_id").alias("key")), sample)
    return label_texts(rows, fit(stretches) if stretches else None, ["doc_id", "held_out"])
