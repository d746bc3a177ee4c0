"""Near-duplicate vectors by hierarchical navigable small-world graphs, one per shard.

Only vectors of one label (and dimension) are compared. Equal vectors are one node with a number of copies. The nodes of a label are
dealt by a hash into shards of about `SHARD` nodes, and each shard becomes a graph of layers: layer l holds the nodes whose drawn level is l or more, each
linked to near nodes chosen so that none is nearer to a chosen one than to the node itself. Every node queries every shard of its label: a pair of shards is one
task, which asks each graph for the other's nodes. A query walks down the layers and keeps a beam of the best nodes; while
the worst of a beam still reaches the threshold, that beam is widened, up to the whole shard. Of each shard every 20th query is
audited against all nodes of the other shard; while recall is below the target, all beams of the pair are widened. What a beam
holds is verified by the cosine in double precision. Links are counted in the task that finds them, as bits of a matrix
of two shards, and what leaves it is a count and a tree of links per node; components are joined by distributed union-find.

Memory of a task is two shards and their matrix of bits whatever the size of a label or of a group of near vectors. n nodes of a label
are sent n / SHARD times, as each has to query every shard; SHARD may be raised with the memory of a task.

Defined edge cases: a null label, a vector that is null, empty, zero or has a null or non-finite component links with nothing and is a
component of its own; vectors of different lengths have no cosine; repeated rows and equal vectors are linked and counted each;
a null vec_id is never the smallest (a component of such rows alone has a null id, and all are kept); an empty table gives no rows; columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.llm.near import packed, settle
from fathomline.session import Stages

THRESHOLD, RECALL = 0.93, 0.99
SHARD = 4096
LINKS = 16  # links of a node in a layer; twice as many in the lowest
BEAM_BUILD, BEAM = 64, 48
AUDITED = 20  # one query of so many
SLACK = 1e-4  # of single precision, before verification
AT_ONCE = 256  # queries walked at once

BUILT = "label string, dims int, shard int, node int, id binary, copies long, vector array<double>, level int, links binary"


# --- a graph of one shard ---


class Beams:
    """The best nodes found so far for several queries: ids (-1: none) and similarities, and which were expanded."""

    def __init__(self, queries: int, width: int):
        self.ids = np.full((queries, width), -1, np.int32)
        self.sims = np.full((queries, width), -np.inf, np.float32)
        self.done = np.zeros((queries, width), bool)

    def take(self, rows: np.ndarray, ids: np.ndarray, sims: np.ndarray) -> None:
        """Offer rows of ids (-inf: not a candidate) to the beams of these queries."""
        width = self.ids.shape[1]
        every = np.concatenate((self.sims[rows], sims), 1)
        best = np.argpartition(-every, width - 1, 1)[:, :width] if every.shape[1] > width else np.arange(every.shape[1])[None, :]
        self.sims[rows] = np.take_along_axis(every, best, 1)
        self.ids[rows] = np.take_along_axis(np.concatenate((self.ids[rows], ids), 1), best, 1)
        self.done[rows] = np.take_along_axis(np.concatenate((self.done[rows], np.zeros(ids.shape, bool)), 1), best, 1)

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(-self.sims, 1, kind="stable")
        return np.take_along_axis(self.ids, order, 1), np.take_along_axis(self.sims, order, 1)


class Graph:
    """Nodes stand in order of falling level, so layer l is the first `counts[l]` of them; the first node is where walks begin."""

    def __init__(self, vectors: np.ndarray, levels: np.ndarray, layers: list[np.ndarray] | None = None, links: int = LINKS):
        self.x, self.levels, self.links = vectors, levels, links
        self.counts = [int((levels >= level).sum()) for level in range(int(levels[0]) + 1)] if len(levels) else []
        self.layers = layers or [np.full((n, self.width(level)), -1, np.int32) for level, n in enumerate(self.counts)]

    def width(self, level: int) -> int:
        return self.links * (1 if level else 2)

    def walk(self, queries: np.ndarray, level: int, beams: Beams) -> None:
        """Expand the best nodes of each beam until all in it are expanded."""
        near, width = self.layers[level], beams.ids.shape[1]
        seen = np.zeros((len(queries), self.counts[level]), bool)
        row, col = np.nonzero(beams.ids >= 0)
        seen[row, beams.ids[row, col]] = True
        step = min(width, max(4, width // 16))
        active = np.arange(len(queries))
        while len(active):
            sims = np.where(beams.done[active], -np.inf, beams.sims[active])
            best = np.argpartition(-sims, step - 1, 1)[:, :step] if step < width else np.broadcast_to(np.arange(width), sims.shape)
            open_ = np.take_along_axis(sims, best, 1) > -np.inf
            going = open_.any(1)
            active, best, open_ = active[going], best[going], open_[going]
            if not len(active):
                return
            beams.done[active[:, None], best] = True
            found = near[np.where(open_, beams.ids[active[:, None], best], 0)]
            found[~open_] = -1
            found = np.sort(found.reshape(len(active), -1), 1)
            new = found >= 0
            new[:, 1:] &= found[:, 1:] != found[:, :-1]
            new &= ~seen[active[:, None], np.maximum(found, 0)]
            r, c = np.nonzero(new)
            ids = found[r, c]
            seen[active[r], ids] = True
            got = np.full(found.shape, -np.inf, np.float32)
            got[r, c] = np.einsum("ij,ij->i", queries[active[r]], self.x[ids])
            beams.take(active, found, got)

    def search(self, queries: np.ndarray, width: int, down_to: int = 0) -> Beams:
        """Beams in layer `down_to`, reached through the layers above with a narrow beam."""
        beams = Beams(len(queries), 1)
        start = np.zeros((len(queries), 1), np.int32)
        beams.take(np.arange(len(queries)), start, (queries @ self.x[:1].T).astype(np.float32))
        for level in range(len(self.counts) - 1, down_to, -1):
            beams.done[:] = False
            self.walk(queries, level, beams)
        wide = Beams(len(queries), width)
        wide.take(np.arange(len(queries)), beams.ids, beams.sims)
        self.walk(queries, down_to, wide)
        return wide

    def chosen(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of candidates in falling similarity (-1: none), those that are not nearer to one chosen before; the rest fills up."""
        rows, n = ids.shape
        vectors = self.x[np.maximum(ids, 0)]
        between = vectors @ vectors.transpose(0, 2, 1)
        keep = np.zeros(ids.shape, bool)
        for c in range(n):
            blocked = (keep[:, :c] & (between[:, c, :c] > sims[:, c : c + 1])).any(1) if c else np.zeros(rows, bool)
            keep[:, c] = (ids[:, c] >= 0) & ~blocked & (keep.sum(1) < most)
        # chosen ones first, then the others in order
        order = np.argsort(np.where(keep, 0, np.where(ids >= 0, 1, 2)), 1, kind="stable")[:, :most]
        out = np.take_along_axis(ids, order, 1)
        return out if out.shape[1] == most else np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)

    def link(self, begin: int, end: int, level: int, ids: np.ndarray, sims: np.ndarray) -> None:
        """Give the nodes begin to end their links in a layer, from candidates, and link back."""
        near, most = self.layers[level], self.width(level)
        near[begin:end] = self.chosen(ids, sims, most)
        source = np.repeat(np.arange(begin, end), most)
        target = near[begin:end].ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        back, first, n = np.unique(target, return_index=True, return_counts=True)
        for b, e in ((k, min(len(back), k + AT_ONCE)) for k in range(0, len(back), AT_ONCE)):
            widest = int(n[b:e].max())
            offered = np.full((e - b, most + widest), -1, np.int32)
            offered[:, :most] = near[back[b:e]]
            at = np.arange(int(n[b:e].sum())) - np.repeat(np.cumsum(n[b:e]) - n[b:e], n[b:e])
            offered[np.repeat(np.arange(e - b), n[b:e]), most + at] = source[first[b] : first[b] + int(n[b:e].sum())]
            # a node of the same batch may already be linked
            offered = -np.sort(-offered, 1)
            offered[:, 1:][offered[:, 1:] == offered[:, :-1]] = -1
            sims_ = np.einsum("ij,ikj->ik", self.x[back[b:e]], self.x[np.maximum(offered, 0)])
            sims_[offered < 0] = -np.inf
            order = np.argsort(-sims_, 1, kind="stable")
            near[back[b:e]] = self.chosen(np.take_along_axis(offered, order, 1), np.take_along_axis(sims_, order, 1), most)

    def build(self, beam: int = BEAM_BUILD) -> Graph:
        """Insert all nodes, in batches of one level that grow with the graph."""
        begin, n = 0, len(self.x)
        while begin < n:
            end = min(n, begin + min(AT_ONCE, max(32, begin // 2)), self.counts[int(self.levels[begin])])
            batch = self.x[begin:end]
            own = (batch @ batch.T).astype(np.float32)
            np.fill_diagonal(own, -np.inf)
            ids = np.broadcast_to(np.arange(begin, end, dtype=np.int32), own.shape)
            for level in range(int(self.levels[begin]), -1, -1):
                beams = Beams(end - begin, beam) if not begin else self.search(batch, beam, level)
                beams.take(np.arange(end - begin), ids, own)
                found, sims = beams.sorted()
                found = np.where(sims > -np.inf, found, -1)
                self.link(begin, end, level, found, sims)
            begin = end
        return self


def asked(graph: Graph, queries: np.ndarray, threshold: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, node) pairs that may reach the threshold. A beam whose worst node does is widened."""
    n = len(graph.x)
    rows = np.arange(len(queries))
    while len(rows):
        if 4 * width > n:  # as wide as the shard
            for b in range(0, len(rows), AT_ONCE):
                r, c = np.nonzero(queries[rows[b : b + AT_ONCE]] @ graph.x.T >= threshold)
                yield rows[b + r], c
            return
        again = []
        at_once = max(16, AT_ONCE * BEAM // max(BEAM, width))
        for b in range(0, len(rows), at_once):
            part = rows[b : b + at_once]
            beams = graph.search(queries[part], width)
            full = beams.sims.min(1) >= threshold
            r, c = np.nonzero((beams.sims >= threshold) & ~full[:, None])
            yield part[r], beams.ids[r, c]
            again.append(part[full])
        rows, width = np.concatenate(again), 4 * width


def ask_audited(graph: Graph, queries: np.ndarray, threshold: float, target: float = RECALL, width: int = BEAM) -> np.ndarray:
    """Which nodes of the graph each query may be linked to (queries x nodes), found by beams that are widened until the
    audited queries have found their links and, where these are few, their nearest node."""
    audit = np.arange(0, len(queries), AUDITED)
    exact = queries[audit] @ graph.x.T
    top = np.take_along_axis(exact, np.argsort(-exact, 1)[:, :2], 1)[:, -1:]  # the second: the first may be the query itself
    while True:
        out = np.zeros((len(queries), len(graph.x)), bool)
        for r, c in asked(graph, queries, threshold, width):
            out[r, c] = True
        true = exact >= threshold
        missed, total = int((true & ~out[audit]).sum()), int(true.sum())
        if not total and 4 * width <= len(graph.x):  # no link to measure by: the nearest nodes tell whether walks arrive
            beams = graph.search(queries[audit], width)
            missed, total = int((beams.sims.max(1) < top[:, 0] - SLACK).sum()), len(audit)
        if missed <= (1 - target) * total or 4 * width > len(graph.x):
            return out
        width *= 2


# --- tasks ---


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one, in double precision. Scaled first, so that no square overflows."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def columns(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in names))


def grouped(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[pa.Table]:
    """Rows of one key after another; they are neighbours."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        keys = list(columns(batch, *key))
        cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for b, e in zip(cuts, cuts[1:]):
            if b == e:
                continue
            if held and keys[b] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[b]
            held.append(batch.slice(b, e - b))
    if held:
        yield pa.Table.from_batches(held)


def matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def drawn_levels(ids: list[bytes], links: int = LINKS) -> np.ndarray:
    """Level l or more with a probability of links to the power of -l, drawn from the id."""
    u = (np.array([int.from_bytes(i[:6], "little") for i in ids], np.float64) + 1) / 2**48
    return np.floor(-np.log(u) / np.log(links)).astype(np.int32)


def _builder(links: int, beam: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ("label", "dims", "shard")):
            levels = drawn_levels(table["id"].to_pylist(), links)
            order = np.argsort(-levels, kind="stable")
            table, levels = table.take(pa.array(order)), levels[order]
            graph = Graph(units(matrix(table["vector"], table["dims"][0].as_py())).astype(np.float32), levels, links=links).build(beam)
            packed_links = [b"".join(graph.layers[level][k].tobytes() for level in range(n + 1)) for k, n in enumerate(levels.tolist())]
            table = table.append_column("node", pa.array(np.arange(len(levels), dtype=np.int32)))
            table = table.append_column("level", pa.array(levels)).append_column("links", pa.array(packed_links, pa.binary()))
            names = ["label", "dims", "shard", "node", "id", "copies", "vector", "level", "links"]
            yield from table.select(names).to_batches(max_chunksize=2000)

    return build


def rebuilt(table: pa.Table, vectors: np.ndarray, links: int) -> Graph:
    """The graph of a shard from its rows in order of node."""
    levels = table["level"].to_numpy()
    raw = [np.frombuffer(x, np.int32) for x in table["links"].to_pylist()]
    layers = []
    for level in range(int(levels[0]) + 1):
        begin, width = (0, 2 * links) if not level else (links * (level + 1), links)
        layers.append(np.stack([x[begin : begin + width] for x in raw[: int((levels >= level).sum())]]))
    return Graph(vectors.astype(np.float32), levels, layers, links)


def verified(maybe: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """The pairs that reach the threshold in double precision."""
    for begin in range(0, len(a), AT_ONCE):
        rows, cols = np.nonzero(maybe[begin : begin + AT_ONCE])
        for k in range(0, len(rows), 1 << 16):
            r, c = rows[k : k + (1 << 16)] + begin, cols[k : k + (1 << 16)]
            maybe[r, c] = np.einsum("ij,ij->i", a[r], b[c]) >= threshold
    return maybe


def joined(linked: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Labels of rows and columns: equal within what is connected, each the smallest number of a row there."""
    n, m = linked.shape
    low, high = np.arange(n), np.full(m, n)
    while True:
        before = low.copy()
        for b in range(0, n, AT_ONCE):
            part = linked[b : b + AT_ONCE]
            np.minimum(high, np.where(part, low[b : b + AT_ONCE, None], n).min(0), out=high)
        if same:
            high = np.minimum(high, low)
        for b in range(0, n, AT_ONCE):
            part = linked[b : b + AT_ONCE]
            np.minimum(low[b : b + AT_ONCE], np.where(part, high[None, :], n).min(1), out=low[b : b + AT_ONCE])
        low = low[low]
        if (low == before).all():
            return low, high


def _asker(threshold: float, target: float, links: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ("label", "dims", "i", "j")):
            i, j, dims = (table[c][0].as_py() for c in ("i", "j", "dims"))
            shards = table["shard"].to_numpy()
            sides = [table.filter(pa.array(shards == s)) for s in dict.fromkeys((i, j))]
            if len(sides) < (1 if i == j else 2) or not all(len(s) for s in sides):
                continue
            exact = [units(matrix(s["vector"], dims)) for s in sides]
            graphs = [rebuilt(s, x, links) for s, x in zip(sides, exact)]
            low = threshold - SLACK
            a, b = exact[0], exact[-1]
            maybe = ask_audited(graphs[-1], graphs[0].x, low, target)
            maybe |= (maybe if i == j else ask_audited(graphs[0], graphs[1].x, low, target)).T
            if i == j:
                np.fill_diagonal(maybe, False)
            linked = verified(maybe, a, b, threshold)
            row, col = joined(linked, i == j)
            ids, copies = [s["id"].to_pylist() for s in sides], [s["copies"].to_numpy() for s in sides]
            root = ids[0]
            count = linked @ copies[-1]
            out = [(ids[0][k], root[row[k]], int(count[k])) for k in np.flatnonzero(count).tolist()]
            if i != j:
                count = linked.T @ copies[0]
                out += [(ids[1][k], root[col[k]], int(count[k])) for k in np.flatnonzero(count).tolist()]
            yield packed(out)

    return ask


# --- the join ---


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_links(nodes: DataFrame, stages: Stages, threshold: float = THRESHOLD, target: float = RECALL, shard: int = SHARD, links: int = LINKS) -> DataFrame:
    """(id, root, links) as near.settle takes it, from nodes (label, dims, id, vector, copies)."""
    sizes = nodes.groupBy("label", "dims").agg(F.ceil(F.count(F.lit(1)) / shard).cast("int").alias("shards"))
    sizes = sizes.select(F.struct("label", "dims").alias("_of"), "shards")
    # null-safe equality deals the sizes anew, so that Spark can split the rows of a large label
    dealt = nodes.join(sizes, F.struct("label", "dims").eqNullSafe(F.col("_of"))).withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))
    dealt = dealt.select("label", "dims", "shard", "shards", "id", "copies", "vector")
    built = dealt.repartition("label", "dims", "shard").sortWithinPartitions("label", "dims", "shard", "id").drop("shards")
    built = stages.write(built.mapInArrow(_builder(links, BEAM_BUILD), BUILT), "vectors-graphs")
    other = F.transform(F.sequence(F.lit(0), F.col("shards") - 1), lambda o: F.struct(F.least("shard", o).alias("i"), F.greatest("shard", o).alias("j")))
    pairs = built.join(sizes, F.struct("label", "dims").eqNullSafe(F.col("_of"))).select(*built.columns, F.explode(other).alias("pair"))
    pairs = pairs.select("*", "pair.i", "pair.j").drop("pair")
    pairs = pairs.repartition("label", "dims", "i", "j").sortWithinPartitions("label", "dims", "i", "j", "shard", "node")
    return pairs.mapInArrow(_asker(threshold, target, links), "id binary, root binary, links long")


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, target: float = RECALL, shard: int = SHARD) -> DataFrame:
    """One row per row of vectors (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    stages = Stages(vectors.sparkSession)
    vector = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.when(usable(vector), F.transform(vector, lambda x: x + 0.0)).alias("vector"))
    some = F.col("label").isNotNull() & F.col("vector").isNotNull()
    parts = [F.lpad(F.hex(F.xxhash64(F.lit(k), "label", "vector")), 16, "0") for k in (1, 2)]
    rows = rows.withColumn("id", F.when(some, F.unhex(F.concat(*parts))))
    nodes = rows.filter(some).groupBy("label", "id", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    nodes = stages.write(nodes.withColumn("dims", F.size("vector")), "vectors-nodes")
    counted, classes = settle(vector_links(nodes.drop("least"), stages, threshold, target, shard), stages, "vectors")
    known = nodes.select("id", "least", "copies").join(counted, "id", "left").join(classes, "id", "left")
    known = stages.write(known.withColumn("root", F.coalesce("root", "id")), "vectors-known")
    least = known.groupBy("root").agg(F.min("least").alias("component"))
    known = stages.write(known.join(least, "root").select("id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), "component"), "vectors-components")
    out = rows.select("vec_id", "id").join(known, "id", "left")
    component = F.when(F.col("id").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
