"""Similarity join of texts by a MinHash LSH forest.

A text's five-word shingles give it a label in each of `TREES` trees: a sequence of min-hashes. All labels, sorted, are the
prefix tries: texts whose labels share a prefix stand together, and neighbours share the deepest. Labels are sorted by
range, so a prefix that a third of all texts share lies in several tasks, and what meets at the borders of tasks is joined
by the two ends of each. One walk over the sorted labels says for each depth which text leads the node that a text is in.

How far matched prefixes are shortened is measured (`measured_depth`): all pairs of a text and the leader of its shortest prefix
are compared by their min-hashes, and the longest prefix is taken at which similar pairs still meet with the
target probability, in each band of similarity. The shortest allowed is where pairs at the threshold meet with that probability
(`matched_depth`). Texts that meet, directly or through others, are compared exactly, pair by pair, in blocks of bounded
size. Equal texts are one text throughout and join their copies at the end.

Defined edge cases: a null text is an empty one; equal texts are one class whatever their length; a text without words has
no other link; texts of one to four words are one shingle; a text of any length is hashed whole; repeated rows are rows of
their own; a null doc_id is kept and never a class id unless all ids of its class are null; pairs at exactly the threshold
are links; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathomline.llm.components import connected
from fathomline.llm.near import Seen, runs, scramble, settle, shingle_sets, verify, word_hashes, word_shingles
from fathomline.session import Stages

TREES, LABEL = 16, 7
WIDTH = 2 * (LABEL + 1)  # bytes of a label: its tree, then its min-hashes, two bytes each
THRESHOLD, TARGET = 0.8, 0.995
BAND = 0.05  # the width of the audit's bands of similarity
SIGNED = "doc_id long, digest binary, node long, labels binary"


def met_at(depth: int, similarity: float, trees: int = TREES) -> float:
    """Probability that two texts share a node of some tree at a depth."""
    return 1 - (1 - similarity**depth) ** trees


def matched_depth(threshold: float = THRESHOLD, target: float = TARGET, trees: int = TREES, label: int = LABEL) -> int:
    """The longest prefix at which two texts of the threshold's similarity share a node of some tree with the target probability."""
    depth = label
    while depth > 1 and met_at(depth, threshold, trees) < target:
        depth -= 1
    return depth


def labels(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Labels of each text (texts x TREES x (1 + LABEL)): the tree's number, then min-hashes cut to 16 bits."""
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    low = shingles.astype(np.uint32) | np.uint32(1)
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sizes), TREES, LABEL + 1), ">u2")
    for tree in range(TREES):
        out[:, tree, 0] = tree
        for level in range(LABEL):
            k = tree * LABEL + level + 1
            v = h + low * np.uint32((k * 2654435761 + 1) & 0xFFFFFFFF)
            v ^= v >> np.uint32(15)
            v *= np.uint32(2246822519)
            v ^= v >> np.uint32(13)
            out[:, tree, level + 1] = (scramble(np.minimum.reduceat(v, starts).astype(np.uint64)) >> np.uint64(48)).astype(np.uint16)
    return out


def digest_of(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def node_of(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        digests = [digest_of(t) for t in texts]
        made: list[bytes | None] = []
        for begin, end in runs(list(map(len, texts))):
            shingles, sizes = word_shingles(*word_hashes(texts[begin:end]))
            some = np.flatnonzero(sizes)
            part: list[bytes | None] = [None] * (end - begin)
            if len(some):
                for i, row in zip(some, labels(shingles, sizes[some])):
                    part[i] = row.tobytes()
            made += part
        columns = [pa.array(digests, pa.binary()), pa.array([node_of(d) for d in digests], pa.int64()), pa.array(made, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "digest", "node", "labels"])


def _walker(floor: int):
    depths = range(floor, LABEL + 1)
    names = ["id", *[f"head_{d}" for d in depths], "label"]

    def rows(ids: np.ndarray, heads: np.ndarray, label: list[bytes] | None) -> pa.RecordBatch:
        marks = pa.nulls(len(ids), pa.binary()) if label is None else pa.array(label, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(ids), *[pa.array(heads[:, k]) for k in range(len(depths))], marks], names=names)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, heads = None, np.zeros(len(depths), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, raw = batch.column("id").to_numpy(), batch.column("label").to_pylist()
            codes = np.frombuffer(b"".join(raw), ">u2").reshape(len(ids), LABEL + 1)
            before = np.concatenate((codes[:1] if last is None else last[1], codes[:-1]))
            shared = (codes == before).cumprod(1).sum(1) - 1
            if last is None:
                shared[0] = -1
                yield rows(ids[:1], np.repeat(ids[:1], len(depths))[None], raw[:1])
            at, lead = np.arange(len(ids)), np.empty((len(ids), len(depths)), np.int64)
            for k, depth in enumerate(depths):
                begin = np.maximum.accumulate(np.where(shared < depth, at, -1))
                lead[:, k] = np.where(begin >= 0, ids[begin], heads[k])
            heads, last = lead[-1], (raw[-1], codes[-1:], ids[-1:])
            led = lead[:, 0] != ids
            yield rows(ids[led], lead[led], None)
        if last is not None:
            yield rows(last[2], np.repeat(last[2], len(depths))[None], [last[0]])

    return walk


def walked(nodes: DataFrame, floor: int) -> DataFrame:
    """(id, head_d for each depth d from floor on, label) from nodes (id, labels): for each label that shares a prefix of `floor`
    min-hashes with one before it, the first text of each of its prefixes within the task. Rows with a label are a task's ends."""
    trees = F.sequence(F.lit(0), F.lit(TREES - 1))
    rows = nodes.select("id", F.explode(F.transform(trees, lambda t: F.substring("labels", t * WIDTH + 1, F.lit(WIDTH)))).alias("label"))
    schema = ", ".join(["id long", *[f"head_{d} long" for d in range(floor, LABEL + 1)], "label binary"])
    return rows.repartitionByRange("label", "id").sortWithinPartitions("label", "id").mapInArrow(_walker(floor), schema)


def links_at(walks: DataFrame, depth: int) -> DataFrame:
    """Links (a, b) that connect the texts of every node at a depth, whichever tasks they are in."""
    inside = walks.filter("label IS NULL").select(F.col("id").alias("a"), F.col(f"head_{depth}").alias("b")).filter("a != b")
    order = Window.orderBy("label", "id")  # two rows of each task
    ends = walks.filter("label IS NOT NULL").select("id", F.substring("label", 1, 2 * (depth + 1)).alias("prefix"), "label")
    ends = ends.select(F.col("id").alias("a"), F.lag("id").over(order).alias("b"), "prefix", F.lag("prefix").over(order).alias("other"))
    return inside.union(ends.filter("prefix = other AND a != b").select("a", "b"))


def _auditor(threshold: float):
    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = [np.frombuffer(b"".join(batch.column(c).to_pylist()), ">u2").reshape(-1, TREES, LABEL + 1)[:, :, 1:] for c in ("labels", "other")]
            equal = pair[0] == pair[1]
            like = equal.mean((1, 2))
            deepest = equal.cumprod(2).sum(2).max(1, initial=0)
            near = like >= threshold
            bands = ((like[near] - threshold) / BAND + 1e-9).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bands), pa.array(deepest[near].astype(np.int32))], names=["band", "deepest"])

    return audit


def measured_depth(walks: DataFrame, nodes: DataFrame, floor: int, threshold: float = THRESHOLD, target: float = TARGET) -> int:
    """The longest prefix at which measured pairs meet with the target probability in each band of similarity, `floor` at least.

    Every pair is compared, none is left out or chosen. A band with fewer pairs than would show one miss is judged by its lower edge, and
    a corpus with so few has `floor`. The pairs only decide how deep the tries are cut; a row per band and depth reaches the driver."""
    pairs = walks.filter("label IS NULL").select("id", F.col(f"head_{floor}").alias("head")).distinct()
    both = pairs.join(nodes, "id").join(nodes.select(F.col("id").alias("head"), F.col("labels").alias("other")), "head")
    seen = both.select("labels", "other").mapInArrow(_auditor(threshold), "band int, deepest int").groupBy("band", "deepest").count().collect()
    enough = 1 / (1 - target) if target < 1 else float("inf")
    if sum(r["count"] for r in seen) < enough:
        return floor
    for depth in range(LABEL, floor, -1):
        reached = []
        for band in {r["band"] for r in seen}:
            whole = sum(r["count"] for r in seen if r["band"] == band)
            met = sum(r["count"] for r in seen if r["band"] == band and r["deepest"] >= depth)
            reached.append(met / whole if whole >= enough else met_at(depth, threshold + band * BAND))
        if min(reached) >= target:
            return depth
    return floor


def _fetcher(seen: Seen):
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()  # 16 bytes a text that this task has sent
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            digests = [digest_of(t) for t in texts]
            may = seen.may_hold(np.array([node_of(d) for d in digests], np.int64)) if texts else []
            out = []
            for digest, text, yes in zip(digests, texts, may):
                if yes and digest not in sent:
                    sent.add(digest)
                    out.append((digest, node_of(digest), text))
            columns = list(zip(*out)) if out else [[], [], []]
            types = (pa.binary(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["digest", "node", "text"])

    return fetch


def similarity_classes(docs: DataFrame, stages: Stages, threshold: float = THRESHOLD, target: float = TARGET) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of all rows, and (digest, root, links) of texts that are linked to other texts: the class of a text is
    that of `root`, and `links` says to how many other texts it is similar."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stages.write(rows.mapInArrow(_sign, SIGNED), "forest-signed")
    different = signed.filter(F.col("labels").isNotNull()).dropDuplicates(["digest"]).select(F.col("node").alias("id"), "labels")
    nodes = stages.write(different, "forest-different")
    floor = matched_depth(threshold, target)
    walks = stages.write(walked(nodes, floor), "forest-walks")
    links = links_at(walks, measured_depth(walks, nodes, floor, threshold, target))
    comps = stages.write(connected(links, stages, "forest-met"), "forest-candidates")
    stages.remove("forest-different", "forest-walks")
    texts = rows.select("text").mapInArrow(_fetcher(Seen(comps.select("id"))), "digest binary, node long, text string")
    # each task sends its own copy of a text; one goes on
    met = texts.join(comps.withColumnRenamed("id", "node"), "node").dropDuplicates(["node", "digest"]).select(F.col("root").alias("comp"), "digest", "text")
    met = stages.write(met, "forest-texts")
    stages.remove("forest-candidates")
    links, classes = settle(verify(met, shingle_sets, threshold), stages, "forest")
    stages.remove("forest-texts")
    return signed.select("doc_id", "digest"), classes.join(links, "id").withColumnRenamed("id", "digest")


def similarity_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class: texts connected by links, and their copies),
    text_id (smallest doc_id with its text), n_links (other texts that are similar to it), n_copies (rows with its text)."""
    stages = Stages(docs.sparkSession)
    rows, linked = similarity_classes(docs, stages, threshold)
    texts = rows.groupBy("digest").agg(F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("n_copies"))
    texts = texts.join(linked, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    texts = stages.write(texts, "forest-by-text")
    classes = texts.groupBy("root").agg(F.min("text_id").alias("class_id"))
    texts = stages.write(texts.join(classes, "root"), "forest-by-class")
    return rows.join(texts, "digest").select("doc_id", "class_id", "text_id", F.coalesce("links", F.lit(0)).alias("n_links"), "n_copies")
