"""Toxic sentences from labels of whole documents: multiple-instance learning with a noisy-or.

A sentence's score is the sigmoid of the sum of its words' weights (a word's is the sum over itself and its longer
beginnings, so that inflected forms share what is learned); a document is toxic if any of its sentences is, so its
score is 1 - product of (1 - sentence score). Weights are learned from document labels through that product, and the same
weights then point at the sentences that offend.

The fit is made on the driver from a bounded sample: about `sample` labelled documents of each class, of up to `most_words`
words each (a longer document's label says little of a sentence), as its words. Classes are weighted back to
their shares. Scores are of whole texts.

Defined edge cases: a null or empty text is one sentence without words; null labels are not learned, and of several labels
of one document the highest counts; with no toxic or no other label all scores are 0; repeated rows are rows of their
own; columns other than those named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"\w+|[.!?\n]")
BREAKS = frozenset(".!?\n")
SPACE = 1 << 18
THRESHOLD = 0.3
PREFIXES = (4, 5, 6, 7)


@dataclass
class Model:
    weights: np.ndarray  # SPACE + 1, the last is 0
    bias: float


def number(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) & (SPACE - 1)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of distinct words laid end to end (the word, and `beginning` + mark for each of PREFIXES that leaves
    letters over), and where each word's begin. A break has the feature SPACE alone, whose weight is 0."""
    out, starts = [], []
    for w in words:
        starts.append(len(out))
        if w in BREAKS:
            out.append(SPACE)
        else:
            out.append(number(w))
            out += [number(w[:n] + "~") for n in PREFIXES if n < len(w)]
    return np.array(out, np.int64), np.array(starts, np.int64)


def tokenise(text: str | None) -> list[str]:
    """Words and breaks in lower case. Every text ends in a break, so each has a sentence."""
    return [*TOKEN.findall(text.lower()), "."] if text else ["."]


def encoded(found: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct tokens, token numbers of all texts laid end to end, and how many each text has."""
    flat = pa.array([w for f in found for w in f], pa.string()).dictionary_encode()
    return flat.dictionary.to_pylist(), flat.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.fromiter(map(len, found), np.int64, len(found))


def document_scores(found: list[list[str]], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Noisy-or per tokenised document, sentence logits, and each sentence's document."""
    vocabulary, ids, sizes = encoded(found)
    features, starts = word_features(vocabulary)
    weights = np.add.reduceat(model.weights[features], starts)
    ends = np.flatnonzero(np.fromiter((w in BREAKS for w in vocabulary), bool, len(vocabulary))[ids])
    logits = np.add.reduceat(weights[ids], np.concatenate(([0], ends[:-1] + 1))) + model.bias
    owner = np.searchsorted(np.cumsum(sizes), ends, side="right")
    return -np.expm1(-np.bincount(owner, np.logaddexp(0, logits), len(sizes))), logits, owner


def fit(docs: list[tuple[int, float, list[str]]], rounds: int = 120, rate: float = 0.1, sparse: float = 1e-4, seen_in: int = 4) -> Model:
    """Learn from (label, weight, tokens) by proximal Adam steps; features of fewer than `seen_in` documents stay at 0."""
    vocabulary, ids, sizes = encoded([d[2] for d in docs])
    label, weight = np.array([d[0] for d in docs]), np.array([d[1] for d in docs])
    weight = weight / weight.sum()
    features, starts = word_features(vocabulary)
    of_word = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(starts, len(features))))
    held = np.unique(ids * np.int64(len(docs)) + np.repeat(np.arange(len(docs)), sizes)) // len(docs)
    spread = np.bincount(features, np.bincount(held, minlength=len(vocabulary))[of_word], SPACE + 1)
    usable = spread >= seen_in
    usable[SPACE] = False
    ends = np.flatnonzero(np.fromiter((w in BREAKS for w in vocabulary), bool, len(vocabulary))[ids])
    sentence = np.searchsorted(ends, np.arange(len(ids)), side="left")
    owner = np.searchsorted(np.cumsum(sizes), ends, side="right")
    w, b = np.zeros(SPACE + 1), -5.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for r in range(1, rounds + 1):
        by_word = np.add.reduceat(w[features], starts)
        logits = np.bincount(sentence, by_word[ids], len(ends)) + b
        s = np.bincount(owner, np.logaddexp(0, logits), len(docs))
        slope = np.where(label == 1, -1 / np.maximum(np.expm1(np.minimum(s, 50)), 1e-6), 1.0) * weight
        each = slope[owner] / (1 + np.exp(-np.maximum(logits, -50)))
        g = np.bincount(features, np.bincount(ids, each[sentence], len(vocabulary))[of_word], SPACE + 1) * usable
        gb = each.sum()
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        mb += 0.1 * (gb - mb)
        vb += 0.01 * (gb * gb - vb)
        scale = rate / (np.sqrt(v / (1 - 0.99**r)) + 1e-5)
        w -= scale * m / (1 - 0.9**r)
        w = np.sign(w) * np.maximum(np.abs(w) - scale * sparse, 0)
        b -= rate * (mb / (1 - 0.9**r)) / (np.sqrt(vb / (1 - 0.99**r)) + 1e-5)
    return Model(w.astype(np.float32), b)


def _short(most_words: int):
    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [tokenise(t) for t in batch.column("text").to_pylist()]
            keep = [i for i, f in enumerate(found) if len(f) <= most_words]
            columns = [batch.column(n).take(pa.array(keep, pa.int64())) for n in ("label", "weight")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([" ".join(found[i]) for i in keep], pa.string())], names=["label", "weight", "words"])

    return take


def sample_documents(docs: DataFrame, labels: DataFrame, sample: int = 2500, most_words: int = 4000) -> list[tuple[int, float, list[str]]]:
    """About `sample` labelled documents per class. labels has doc_id and label (0 or 1); only the chosen ids, whose number
    `sample` bounds, are sent to the tasks that read texts."""
    known = labels.groupBy("doc_id").agg(F.max("label").alias("label"))
    counts = {r[0]: r[1] for r in known.groupBy("label").agg(F.count(F.lit(1))).collect()}
    if set(counts) != {0, 1}:
        return []
    share = F.when(F.col("label") == 1, min(1.0, sample / counts[1])).otherwise(min(1.0, sample / counts[0]))
    chosen = known.withColumn("share", share).filter(F.shiftrightunsigned(F.xxhash64(F.lit("mil"), "doc_id"), 11) / float(1 << 53) < F.col("share"))
    chosen = chosen.select("doc_id", F.col("label").cast("int").alias("label"), (1 / F.col("share")).alias("weight"))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "weight", "text")
    got = rows.mapInArrow(_short(most_words), "label int, weight double, words string").collect()
    # a line break stands between two spaces, so only these part the tokens
    return [(r[0], r[1], r[2].split(" ")) for r in sorted(got, key=lambda r: (r[0], r[2]))]


def _scorer(model: Model, keep: list[str], spans: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            scores, offending = np.zeros(len(texts)), []
            for begin in range(0, len(texts), 2000):
                part = texts[begin : begin + 2000]
                scores[begin : begin + 2000], logits, owner = document_scores([tokenise(t) for t in part], model)
                if spans:
                    hot = np.flatnonzero(logits > 0)
                    first = np.searchsorted(owner, np.arange(len(part)))
                    by_text: dict[int, list[int]] = {}
                    for j in hot:
                        by_text.setdefault(int(owner[j]), []).append(int(j - first[owner[j]]))
                    offending += [_places(t, by_text.get(i, []), logits[first[i] :]) for i, t in enumerate(part)]
            columns = [*(batch.column(n) for n in keep), pa.array(np.clip(scores, 0, 1))]
            if spans:
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
                columns.append(pa.array(offending, kind))
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "score", *(["offending"] if spans else [])])

    return run


def _places(text: str | None, wanted: list[int], logits: np.ndarray) -> list[dict]:
    """Code-point spans of the wanted sentences of a text."""
    if not wanted or not text:
        return []
    out, begin, i, wanted_set = [], 0, 0, set(wanted)
    for m in re.finditer(r"[.!?\n]|\Z", text):
        if i in wanted_set:
            out.append({"start": begin, "end": m.end(), "score": float(1 / (1 + np.exp(-logits[i])))})
        begin, i = m.end(), i + 1
    return out


def score_texts(docs: DataFrame, model: Model | None, keep: list[str], spans: bool = False) -> DataFrame:
    """`keep` columns of docs with the score of text and, where asked for, its offending sentences (those above one half)."""
    schema = ", ".join(f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in keep) + ", score double"
    schema += ", offending array<struct<start:int,end:int,score:double>>" if spans else ""
    model = model or Model(np.zeros(SPACE + 1, np.float32), -np.inf)
    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(_scorer(model, keep, spans), schema)


def predict_toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, sample: int = 2500) -> DataFrame:
    """Learn from labels (doc_id, toxic) of rows that are not held out; score all: doc_id, held_out, score, predicted, n_offending."""
    train = labels.filter(~held_out & F.col("toxic").isin(0, 1)).select("doc_id", F.col("toxic").alias("label"))
    model = (lambda s: fit(s) if s else None)(sample_documents(docs, train, sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    scored = score_texts(rows, model, ["doc_id", "held_out"], spans=True)
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select("doc_id", "held_out", "score", predicted.alias("predicted"), F.col("offending").alias("offending"))
