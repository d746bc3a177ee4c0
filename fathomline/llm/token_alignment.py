"""Which tokens of two tokenizers stand for the same bytes, counted over a corpus with inverted bitmaps.

A text, with a space in front, is encoded by both. Places where tokens of both end cut it into groups, and two tokens are linked
where their bytes overlap. Texts are cut where a plain character, one space and a plain character meet: neither tokenizer has
a token across such a place, so every stretch between is encoded once per task and looked up afterwards.

Each task inverts its links: for a pair of ids and a block of 65,536 rows, a compressed bitmap of the rows that hold the
pair (sorted 16-bit numbers, or 8 KB of bits from 4,096 rows on), and one more bitmap per binary digit of what a row holds beyond its first link of
the pair (multiplicity planes). Bitmaps of one pair and block are OR-merged; their popcounts, summed by pair, say how
many documents and how many links a pair has. The counts are joined to the postings, and the postings, dealt by
block, give every row its scores.

A pair as frequent as a space is not gathered: its postings are dealt by (pair, block), its counts are sums that combine before
their shuffle, and a task that scores holds two arrays of 65,536 sums.

Defined edge cases: null and empty texts, and texts that a tokenizer does not give back byte for byte (such as those with U+2581), have
zeros and an empty digest; a text of any length is handled stretch by stretch and whole, a stretch without such a place is encoded in one piece;
repeated rows are documents of their own, as are rows of a null doc_id; pairs that tie for the highest count of an id are
all its best; an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.llm.near import runs
from fathomline.session import Stages

FOLDER, FILE_A, FILE_B = "/opt/tokenizers", "byte_bpe_50k.json", "piece_bpe_32k.model"
BLOCK_BITS = 16
DENSE = 1 << (BLOCK_BITS - 4)  # rows of a block from which bits are shorter than numbers
POSTED = 3_000_000  # postings that a task gathers before it writes them
KNOWN_UNITS, KNOWN_CHARS = 400_000, 8_000_000  # stretches that a task remembers, and their characters
#: Between characters that no definition calls blank, a single space begins a token in both tokenizers.
PLAIN = r"[!-~¡-ᙿ]"
CUT = re.compile(rf" (?<={PLAIN} )(?={PLAIN})")

ALIGNED = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
    "pair long, block long, docs binary, planes array<binary>"
)
MERGED = "pair long, block long, docs binary, planes array<binary>, n_docs long, n_links long"
SCORED = "row long, n_best long, count_sum long"


# --- the two tokenizers ---


def byte_symbols() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable bytes for themselves, others from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in printable}
    out.update({chr(0x100 + k): b for k, b in enumerate(sorted(set(range(256)) - set(printable)))})
    return out


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, folder: str, file_a: str, file_b: str):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(os.path.join(folder, file_a))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, file_b))
        symbols = byte_symbols()
        self.bytes_a = [b""] * self.a.get_vocab_size()
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(symbols[c] for c in token) if all(c in symbols for c in token) else token.encode()
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)

    def encode(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both for each stretch; the second tokenizer adds the space in front by itself."""
        a = [e.ids for e in self.a.encode_batch([" " + u for u in units], add_special_tokens=False)]
        return a, self.b.encode(units, num_threads=1)


@functools.lru_cache(maxsize=1)
def tokenizers_of(folder: str, file_a: str, file_b: str) -> Tokenizers:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Tokenizers(folder, file_a, file_b)


def offsets(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions start, start + 1, ... of each range, laid end to end."""
    return np.repeat(starts - offsets(sizes), sizes) + np.arange(int(sizes.sum()))


class Units:
    """Stretches met so far: how many tokens, groups and links each has, its pairs, and its groups as text."""

    def __init__(self, models: Tokenizers):
        self.models, self.width = models, len(models.bytes_b)
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.text: list[str | None] = []  # None: not given back byte for byte
        self.n = np.zeros((0, 4), np.int64)  # tokens of a, of b, groups, links
        self.first = np.zeros(0, np.int64)
        self.pairs = np.zeros(0, np.int64)

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of each stretch; new ones are encoded."""
        index = self.index
        new = list({u: None for u in units if u not in index})
        for begin, end in runs(list(map(len, new)), 200_000):
            self.learn(new[begin:end])
        return np.fromiter(map(index.__getitem__, units), np.int64, len(units))

    def learn(self, units: list[str]) -> None:
        models = self.models
        ids_a, ids_b = models.encode(units)
        for k, unit in enumerate(units):
            raw = b" " + unit.encode()
            if b"".join([models.bytes_a[i] for i in ids_a[k]]) != raw or b"".join([models.bytes_b[i] for i in ids_b[k]]) != raw:
                ids_a[k] = ids_b[k] = None
        good = np.array([x is not None for x in ids_a])
        n = np.zeros((len(units), 4), np.int64)
        pairs = np.zeros(0, np.int64)
        text: list[str | None] = [None] * len(units)
        if good.any():
            some = np.flatnonzero(good)
            n[some, 0], n[some, 1] = [len(ids_a[k]) for k in some], [len(ids_b[k]) for k in some]
            a, b = (np.array([i for k in some for i in ids[k]], np.int64) for ids in (ids_a, ids_b))
            unit_a = np.repeat(some, n[some, 0])
            # both spell out the same bytes, so ends are counted from the start of the first stretch
            end_a, end_b = np.cumsum(models.size_a[a]), np.cumsum(models.size_b[b])
            both = np.intersect1d(end_a, end_b, assume_unique=True)
            every = np.union1d(end_a, end_b)
            # between neighbouring ends one token of each holds the bytes, and these two are linked nowhere else
            at_a, at_b = np.searchsorted(end_a, every), np.searchsorted(end_b, every)
            pairs = a[at_a] * self.width + b[at_b]
            n[:, 3] = np.bincount(unit_a[at_a], minlength=len(units))
            n[:, 2] = np.bincount(unit_a[np.searchsorted(end_a, both)], minlength=len(units))
            group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
            size_a, size_b = np.bincount(group_a, minlength=len(both)), np.bincount(group_b, minlength=len(both))
            names_a, names_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
            groups, i, j = [], 0, 0
            for x, y in zip(size_a.tolist(), size_b.tolist()):
                groups.append(",".join(names_a[i : i + x]) + "|" + ",".join(names_b[j : j + y]))
                i, j = i + x, j + y
            at = 0
            for k in some.tolist():
                text[k] = ";".join(groups[at : at + int(n[k, 2])])
                at += int(n[k, 2])
        for unit in units:
            self.index[unit] = len(self.index)
        self.chars += sum(map(len, units))
        self.text += text
        self.first = np.concatenate((self.first, len(self.pairs) + offsets(n[:, 3])))
        self.n = np.concatenate((self.n, n))
        self.pairs = np.concatenate((self.pairs, pairs))


# --- compressed bitmaps of a block's rows ---


def packed(rows: np.ndarray) -> bytes:
    """Sorted row numbers (16 bits) as bytes: the numbers themselves, or the block's bits if there are many."""
    if len(rows) < DENSE:
        return rows.astype("<u2").tobytes()
    bits = np.zeros(1 << BLOCK_BITS, np.uint8)
    bits[rows] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) < 2 * DENSE:
        return np.frombuffer(data, "<u2")
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")).astype("<u2")


def popcount(data: bytes) -> int:
    return len(data) // 2 if len(data) < 2 * DENSE else int.from_bytes(data, "little").bit_count()


def merged_or(several: list[bytes]) -> bytes:
    return several[0] if len(several) == 1 else packed(np.unique(np.concatenate([unpacked(x) for x in several])))


def planes_of(rows: np.ndarray, times: np.ndarray) -> list[bytes]:
    """A bitmap for each binary digit of times - 1."""
    more, out = times - 1, []
    while more.any():
        out.append(packed(rows[more & 1 == 1]))
        more = more >> 1
    return out


class Postings:
    """Links of a task's rows, inverted: gathered as (pair, row) with their number, given out as bitmaps of pairs and blocks."""

    def __init__(self, width: int):
        self.width, self.keys, self.times, self.held = width, [], [], 0

    def add(self, pairs: np.ndarray, rows: np.ndarray) -> None:
        """rows count from the task's first row."""
        keys, times = np.unique(pairs << 32 | rows, return_counts=True)
        self.keys.append(keys)
        self.times.append(times)
        self.held += len(keys)

    def give(self, first_row: int) -> pa.RecordBatch | None:
        if not self.held:
            return None
        keys, times = np.concatenate(self.keys), np.concatenate(self.times)
        self.keys, self.times, self.held = [], [], 0
        order = np.argsort(keys, kind="stable")
        keys, times = keys[order], times[order]
        group = keys >> BLOCK_BITS  # the task's first row starts a block
        starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        ends = np.append(starts[1:], len(keys))
        low = (keys & ((1 << BLOCK_BITS) - 1)).astype("<u2")
        raw, most = low.tobytes(), np.maximum.reduceat(times, starts)
        docs = [raw[2 * s : 2 * e] if e - s < DENSE else packed(low[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
        planes: list[list[bytes]] = [[]] * len(starts)
        for k in np.flatnonzero(most > 1).tolist():
            planes[k] = planes_of(low[starts[k] : ends[k]], times[starts[k] : ends[k]])
        code = keys[starts] >> 32
        block = ((keys[starts] & 0xFFFFFFFF) + first_row) >> BLOCK_BITS
        pair = (code // self.width) << 32 | code % self.width
        return union_rows(len(starts), pair=pa.array(pair), block=pa.array(block), docs=pa.array(docs, pa.binary()), planes=pa.array(planes, pa.list_(pa.binary())))


FIELDS = {
    **{c: pa.int64() for c in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links")},
    "groups_sha256": pa.string(), "groups": pa.string(), "pair": pa.int64(), "block": pa.int64(), "docs": pa.binary(), "planes": pa.list_(pa.binary()),
}


def union_rows(size: int, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of documents or of postings; the columns of the others are null."""
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(size, t)) for c, t in FIELDS.items()], names=list(FIELDS))


def _aligner(paths: tuple[str, str, str], with_groups: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = tokenizers_of(*paths)
        units, postings, first_row = Units(models), Postings(len(models.bytes_b)), None
        for batch in batches:
            rows = batch.column("row").to_numpy()
            if first_row is None and len(rows):
                first_row = int(rows[0])
            texts = batch.column("text").to_pylist()
            for begin, end in runs([len(t or "") for t in texts], 1_000_000):
                if len(units.index) > KNOWN_UNITS or units.chars > KNOWN_CHARS:
                    units.clear()
                cut = [CUT.split(t) if t else [] for t in texts[begin:end]]
                sizes = np.array([len(c) for c in cut], np.int64)
                at = units.numbers([u for c in cut for u in c])
                n = np.zeros((end - begin, 4), np.int64)
                owner = np.repeat(np.arange(end - begin), sizes)
                groups: list[str] = []
                for k, here in enumerate(np.split(at, np.cumsum(sizes)[:-1])):
                    text = [units.text[u] for u in here.tolist()]
                    groups.append("" if None in text else ";".join(text))
                if len(at):
                    good = np.array([bool(g) for g in groups])[owner]
                    at, owner = at[good], owner[good]
                    for c in range(4):
                        n[:, c] = np.bincount(owner, units.n[at, c], end - begin).astype(np.int64)
                    links = units.n[at, 3]
                    postings.add(units.pairs[spread(units.first[at], links)], np.repeat(rows[begin:end][owner] - first_row, links))
                digest = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                yield union_rows(
                    end - begin,
                    **{c: batch.column(c).slice(begin, end - begin) for c in ("row", "doc_id")},
                    **{c: pa.array(n[:, k]) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))},
                    groups_sha256=pa.array(digest, pa.string()),
                    **({"groups": pa.array(groups, pa.string())} if with_groups else {}),
                )
                if postings.held > POSTED and (out := postings.give(first_row)) is not None:
                    yield out
        if first_row is not None and (out := postings.give(first_row)) is not None:
            yield out

    return align


def _merger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """OR of the bitmaps of each pair and block (neighbours in order), with their popcounts."""
    key, held = None, []

    def closed(out: list[tuple]) -> None:
        if key is not None:
            docs = merged_or([d for d, _ in held])
            depth = max(len(p) for _, p in held)
            planes = [merged_or([p[k] for _, p in held if len(p) > k]) for k in range(depth)]
            n = popcount(docs)
            out.append((*key, docs, planes, n, n + sum(popcount(p) << k for k, p in enumerate(planes))))

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.int64(), pa.int64())
        names = ["pair", "block", "docs", "planes", "n_docs", "n_links"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 6, types)], names=names)

    for batch in batches:
        out: list[tuple] = []
        for pair, block, docs, planes in zip(*(batch.column(c).to_pylist() for c in ("pair", "block", "docs", "planes"))):
            if key != (pair, block):
                closed(out)
                key, held = (pair, block), []
            held.append((docs, planes))
        yield batch_of(out)
    out = []
    closed(out)
    yield batch_of(out)


def _scorer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row of each block (neighbours in order): links whose pair is its id's best, and the sum of their pairs' counts."""
    size = 1 << BLOCK_BITS
    block, best, total = None, np.zeros(size, np.int64), np.zeros(size, np.int64)

    def closed() -> pa.RecordBatch:
        rows = np.flatnonzero(total)
        out = pa.RecordBatch.from_arrays([pa.array((block << BLOCK_BITS) + rows), pa.array(best[rows]), pa.array(total[rows])], names=["row", "n_best", "count_sum"])
        best[:], total[:] = 0, 0
        return out

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        starts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1]))) if len(blocks) else []
        for s, e in zip(starts, [*starts[1:], len(blocks)]):
            if block is not None and blocks[s] != block:
                yield closed()
            block = int(blocks[s])
            part = batch.slice(s, e - s)
            count, is_best = part.column("n_docs").to_numpy(), part.column("best").to_numpy(zero_copy_only=False)
            bitmaps, owner, weight = [], [], []
            for k, (docs, planes) in enumerate(zip(part.column("docs").to_pylist(), part.column("planes").to_pylist())):
                for w, data in enumerate((docs, *planes)):
                    bitmaps.append(unpacked(data))
                    owner.append(k)
                    weight.append(1 << max(0, w - 1))  # the first link, then digit w - 1 of the others
            owner, weight, rows = np.array(owner), np.array(weight), np.concatenate(bitmaps)
            lengths = np.array([len(x) for x in bitmaps])
            np.add.at(total, rows, np.repeat(weight * count[owner], lengths))
            np.add.at(best, rows, np.repeat(weight * is_best[owner], lengths))
    if block is not None:
        yield closed()


def align(docs: DataFrame, stages: Stages, paths: tuple[str, str, str] = (FOLDER, FILE_A, FILE_B), with_groups: bool = False) -> tuple[DataFrame, DataFrame]:
    """Documents (row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, groups) and postings (pair, block, docs, planes,
    n_docs, n_links). A pair is the first tokenizer's id in the upper and the second's in the lower 32 bits."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = stages.write(rows.mapInArrow(_aligner(paths, with_groups), ALIGNED), "aligned")
    documents = made.filter(F.col("row").isNotNull()).select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
    pieces = made.filter(F.col("pair").isNotNull()).select("pair", "block", "docs", "planes")
    pieces = pieces.repartition("pair", "block").sortWithinPartitions("pair", "block")
    return documents, stages.write(pieces.mapInArrow(_merger, MERGED), "aligned-postings")


def pair_counts(postings: DataFrame, stages: Stages) -> DataFrame:
    """(pair, id_a, id_b, n_docs, n_links, best): documents that hold a pair linked, its links, and whether no pair of id_a has more documents."""
    a, b = F.shiftright("pair", 32), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    counts = postings.groupBy("pair").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    counts = stages.write(counts.select("pair", a.alias("id_a"), b.alias("id_b"), "n_docs", "n_links"), "aligned-pairs")
    most = counts.groupBy("id_a").agg(F.max("n_docs").alias("most"))
    return counts.join(most, "id_a").select("pair", "id_a", "id_b", "n_docs", "n_links", (F.col("n_docs") == F.col("most")).alias("best"))


def scores(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """(row, n_best, count_sum) of rows with links, from postings and the counts of their pairs."""
    counted = postings.select("pair", "block", "docs", "planes").join(counts.select("pair", "n_docs", "best"), "pair")
    dealt = counted.select("block", "docs", "planes", "n_docs", "best").repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(_scorer, SCORED)


def align_tokens(docs: DataFrame, paths: tuple[str, str, str] = (FOLDER, FILE_A, FILE_B), with_groups: bool = False) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 (and groups, the ids)."""
    stages = Stages(docs.sparkSession)
    documents, postings = align(docs, stages, paths, with_groups)
    found = scores(postings, stages.write(pair_counts(postings, stages), "aligned-counts"))
    out = documents.join(found, "row", "left")
    sums = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")]
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *sums, "groups_sha256", *(["groups"] if with_groups else []))
