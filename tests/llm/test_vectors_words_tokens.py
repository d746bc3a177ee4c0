"""op11 to op13 against brute force, on given tables, random data and awkward rows."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.catalog.compare import connect
from fathomline.llm import queries, spelling_variants, token_alignment, vector_graphs
from fathomline.session import Stages

FOLDER = "/root/testdata/sf0.01"
TOKENIZERS = "/opt/tokenizers"


# --- vectors ---


def brute_vectors(rows, threshold=0.93):
    """{place of a row: (links, component)} by all cosines of a label."""
    good = [k for k, (_, v, label) in enumerate(rows) if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, root = Counter(), {k: k for k in range(len(rows))}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    of = defaultdict(list)
    for k in good:
        of[rows[k][2], len(rows[k][1])].append(k)
    for members in of.values():
        x = np.array([rows[k][1] for k in members], float)
        x /= np.abs(x).max(1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T >= threshold
        for a, b in zip(*np.nonzero(np.triu(near, 1))):
            links[members[a]] += 1
            links[members[b]] += 1
            root[find(members[a])] = find(members[b])
    least = defaultdict(list)
    for k, row in enumerate(rows):
        least[find(k)].append(row[0])
    return {k: (links[k], min((i for i in least[find(k)] if i is not None), default=None)) for k in root}


def test_vectors_of_the_given_table(spark):
    rows = connect(FOLDER).execute("SELECT vec_id, embedding, label FROM embeddings").fetchall()
    want = {rows[k][0]: v for k, v in brute_vectors(rows).items()}
    got = {r.vec_id: (r.n_links, r.component_id) for r in queries.op11_vector_graphs(spark, FOLDER).collect()}
    assert got == want


def grouped_vectors(seed=5, groups=(400, 90, 30, 2, 1), dims=24):
    r = np.random.default_rng(seed)
    out = []
    for size in groups:
        centre = r.normal(size=dims)
        for _ in range(size):
            out.append(centre + r.normal(size=dims) * r.choice([0.02, 0.25]) * np.linalg.norm(centre) / np.sqrt(dims))
    return out + list(r.normal(size=(300, dims)))


def test_vectors_over_several_shards(spark):
    vectors = grouped_vectors()
    rows = [(k, v.tolist(), 1 if k % 7 else 2) for k, v in enumerate(vectors)]
    rows += [(1000 + k, vectors[0].tolist(), 1) for k in range(40)] + [(2000 + k, (3 * vectors[401]).tolist(), 1) for k in range(3)]
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    got = {r.vec_id: r for r in vector_graphs.near_vectors(made, shard=150).collect()}
    want = {rows[k][0]: v for k, v in brute_vectors(rows).items()}
    found, all_ = sum(min(got[i].n_links, n) for i, (n, _) in want.items()), sum(n for n, _ in want.values())
    assert found >= 0.99 * all_ and all(got[i].n_links <= n for i, (n, _) in want.items())
    same = sum(got[i].component_id == c for i, (_, c) in want.items())
    assert same >= 0.99 * len(want) and all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_graph_finds_what_brute_force_finds():
    x = vector_graphs.units(np.array(grouped_vectors(groups=(1200, 300, 5), dims=32)))
    order = np.random.default_rng(1).permutation(len(x))
    levels = vector_graphs.drawn_levels([hashlib.md5(str(k).encode()).digest() for k in range(len(x))])
    falling = np.argsort(-levels, kind="stable")
    graph = vector_graphs.Graph(x[order].astype(np.float32), levels[falling]).build()
    assert len(graph.counts) > 1 and all(layer.max() < n for layer, n in zip(graph.layers, graph.counts))
    found = vector_graphs.ask_audited(graph, graph.x, 0.93)
    exact = graph.x @ graph.x.T >= 0.93
    assert (found & exact).sum() >= 0.99 * exact.sum() and not (found & ~exact).any()
    # without widening the same beams miss most of a group larger than they are
    narrow = graph.search(graph.x, vector_graphs.BEAM)
    assert (narrow.sims >= 0.93).sum() < 0.5 * exact.sum()


AWKWARD = [
    (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None), (5, None, 0), (6, [], 0), (7, [0.0, 0.0], 0), (8, [1.0, None], 0),
    (9, [float("nan"), 1.0], 0), (10, [float("inf"), 1.0], 0), (None, [1.0, 0.001], 0), (11, [1.0, 0.0, 0.0], 0), (12, [1e200, 1.0], 0), (13, [-0.0, 1.0], 0), (14, [0.0, 1.0], 0), (None, None, None),
]


def test_awkward_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int, id string, dims int, shard string, copies int"
    made = spark.createDataFrame([(*r, "x", 1, "s", 2) for r in AWKWARD], schema)
    got = sorted(tuple(r) for r in vector_graphs.near_vectors(made).select(F.coalesce("vec_id", F.lit(-1)), "n_links", F.coalesce("component_id", F.lit(-1)), "kept").collect())
    want = brute_vectors(AWKWARD)
    assert got == sorted((-1 if r[0] is None else r[0], want[k][0], -1 if want[k][1] is None else want[k][1], r[0] == want[k][1]) for k, r in enumerate(AWKWARD))
    assert vector_graphs.near_vectors(made.limit(0)).collect() == []


# --- words ---


def brute_near(words):
    """{word: its near words} by trying every edit."""
    out = {w: set() for w in words}
    letters = [chr(c) for c in spelling_variants.LETTERS.tolist()]
    for w in words:
        for i in range(len(w) + 1):
            for v in [w[:i] + w[i + 1 :]] * (i < len(w)) + [w[:i] + c + w[i + 1 :] for c in letters] * (i < len(w)) + [w[:i] + c + w[i:] for c in letters]:
                if v in out and v != w:
                    out[w].add(v)
    return out


def brute_variants(docs):
    counts = Counter()
    for i, text in docs:
        for run in spelling_variants.RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    near = brute_near(n)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), c, len(near[w]), n.get(form[w], 0)) for w, c in n.items())


def variant_rows(df):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def test_variants_of_random_words(spark):
    r = random.Random(3)
    words = ["".join(r.choices("abé", k=r.randint(5, 8))) for _ in range(300)] + ["straße", "STRAßE", "x" * 700, "x" * 699, "x" * 699 + "y"]
    texts = [" ".join(r.choices(words, weights=[r.choice([1, 8, 60]) for _ in words], k=4000)) for _ in range(3)] + [f"{'x' * 700} {'x' * 699} {'x' * 699}Y "] * 6
    docs = [(None if k == 1 else k, t) for k, t in enumerate(texts)] + [(None, None), (9, ""), (2, texts[2]), (12, "chainaa " * 400 + "chainab " * 60 + "chaincb " * 8)]
    made = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, n int").repartition(3)
    want = brute_variants(docs)
    assert any(w[1] for w in want) and any(w[2] not in (w[0], w[1]) for w in want)
    assert variant_rows(spelling_variants.spelling_variants(made)) == want
    # filters of a few blocks let more through, and the join removes it
    assert variant_rows(spelling_variants.spelling_variants(made, most_bytes=64)) == want
    assert spelling_variants.spelling_variants(made.limit(0)).collect() == []


def test_edit_hashes_and_filters(spark):
    word = "zébra"
    codes = spelling_variants.word_codes([word])
    hashes = {int(h) for _, hs, _ in spelling_variants.edits(codes) for h in hs}
    one = lambda w: int(spelling_variants.scramble(spelling_variants.sums(spelling_variants.word_codes([w])))[0])
    assert {one("zébr"), one("ébra"), one("zérra"), one("zéÿra")} <= hashes and one("zébra") not in hashes
    words = spark.createDataFrame([(f"wort{k:06d}", 5) for k in range(3000)] + [("l" * 900, 5)], "word string, n long")
    hashed = words.mapInArrow(spelling_variants._hasher, "word string, n long, size int, h long")
    filters = spelling_variants.LengthFilters(hashed)
    for r in hashed.collect():
        assert filters.may_hold(np.array([r.h]).view(np.uint64), r["size"]).all()
    other = np.random.default_rng(1).integers(0, 1 << 63, 20_000).astype(np.uint64)
    assert filters.may_hold(other, 10).mean() < 0.05 and not filters.may_hold(other, 11).any()
    assert sum(spelling_variants.filter_sizes({k: 10**9 for k in range(6, 40)}).values()) * 8 <= spelling_variants.FILTER_BYTES


# --- tokens ---


def brute_alignment(docs, a, b, symbols):
    vocabulary = {i: w for w, i in a.get_vocab().items()}
    out = []
    for _, text in docs:
        ids_a, ids_b = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        of_a = [bytes(symbols[c] for c in vocabulary[i]) for i in ids_a]
        of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(of_a) != raw or b"".join(of_b) != raw:
            out.append(None)
            continue
        owner_a = [k for k, x in enumerate(of_a) for _ in x]
        owner_b = [k for k, x in enumerate(of_b) for _ in x]
        links = sorted(set(zip(owner_a, owner_b)))
        ends = [p for p in range(len(raw)) if p + 1 == len(raw) or owner_a[p] != owner_a[p + 1] and owner_b[p] != owner_b[p + 1]]
        groups, begin = [], 0
        for end in ends:
            part = [",".join(str(ids[k]) for k in dict.fromkeys(owner[begin : end + 1])) for ids, owner in ((ids_a, owner_a), (ids_b, owner_b))]
            groups.append("|".join(part))
            begin = end + 1
        out.append((len(ids_a), len(ids_b), groups, [(ids_a[x], ids_b[y]) for x, y in links]))
    held = Counter(p for v in out if v for p in set(v[3]))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    rows = []
    for (i, _), v in zip(docs, out):
        i = -1 if i is None else i
        if v is None:
            rows.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            digest = hashlib.sha256(";".join(v[2]).encode()).hexdigest()
            rows.append((i, v[0], v[1], len(v[2]), len(v[3]), sum(held[p] == best[p[0]] for p in v[3]), sum(held[p] for p in v[3]), digest))
    links = Counter(p for v in out if v for p in v[3])
    return sorted(rows), {p: (held[p], links[p]) for p in held}


@pytest.fixture(scope="module")
def models():
    import sentencepiece
    import tokenizers

    a = tokenizers.Tokenizer.from_file(os.path.join(TOKENIZERS, "byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=os.path.join(TOKENIZERS, "piece_bpe_32k.model")), token_alignment.byte_symbols()


TOKEN_COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def aligned_rows(df):
    return sorted(tuple(r) for r in df.select(F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), *TOKEN_COLUMNS).collect())


def test_alignment_of_the_given_table(spark, models):
    docs = connect("/root/testdata/sf0.001").execute("SELECT doc_id, text FROM documents").fetchall()
    assert aligned_rows(queries.op13_token_alignment(spark, "/root/testdata/sf0.001")) == brute_alignment(docs, *models)[0]


ODD = [
    "", None, " ", "  two  spaces ", "tab\tand\nline\r\n end ", "x▁y", "<|endoftext|> <s> </s> <unk> <0x41>", "é ü ñ ß", "日本語 の テキスト です", "emoji 😀😀 👩‍👩‍👧 ok", "a b c d e​f",
    "\x00 \x01a \x1c b", "don't we'll I'm it's", "1234567 89,000.50", "ab " * 3000, "word " + "z" * 5000 + " end", "-" * 300 + " " + "=" * 300, "the cat the cat the", "＜wide＞ ﬁ ﬂ ①", "trailing space ", "a  b   c    d",
]


def test_alignment_of_odd_texts(spark, models):
    r = random.Random(11)
    symbols = ["a", "the", " ", "  ", "\n", "\t", "é", "▁", "😀", ".", ",", "'s", "1", " ", "日本", "ing", "Straße", "​", "\x85", "　"]
    texts = ODD + ["".join(r.choices(symbols, k=r.randint(1, 60))) for _ in range(300)]
    docs = [(None if k % 50 == 3 else k % 200, t) for k, t in enumerate(texts)]
    made = spark.createDataFrame([(*d, 1, 2, "p") for d in docs], "doc_id long, text string, row int, n_a int, pair string").repartition(4)
    want, pairs = brute_alignment(docs, *models)
    assert aligned_rows(token_alignment.align_tokens(made)) == want
    stages = Stages(spark)
    _, postings = token_alignment.align(made, stages)
    got = {(r.id_a, r.id_b): (r.n_docs, r.n_links) for r in token_alignment.pair_counts(postings, stages).collect()}
    assert got == pairs
    assert token_alignment.align_tokens(made.limit(0)).collect() == []


def test_alignment_with_dense_bitmaps_and_many_pieces(spark, models, monkeypatch):
    texts = ["of the day", "of the the day of", "night"]
    docs = [(k, texts[0] if k % 3 else texts[1 + (k % 2)]) for k in range(9000)]
    made = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert aligned_rows(token_alignment.align_tokens(made)) == brute_alignment(docs, *models)[0]


def test_bitmaps():
    r = np.random.default_rng(2)
    for n in (0, 1, 5, 4095, 4096, 30_000, 65_536):
        rows = np.sort(r.choice(1 << 16, n, replace=False)).astype("<u2")
        data = token_alignment.packed(rows)
        assert (token_alignment.unpacked(data) == rows).all() and token_alignment.popcount(data) == n and len(data) <= 8192
        more = np.sort(r.choice(1 << 16, 700, replace=False)).astype("<u2")
        both = token_alignment.merged_or([data, token_alignment.packed(more)])
        assert set(token_alignment.unpacked(both).tolist()) == set(rows.tolist()) | set(more.tolist())
    times = r.integers(1, 40, 500)
    rows = np.sort(r.choice(1 << 16, 500, replace=False)).astype("<u2")
    planes = token_alignment.planes_of(rows, times)
    assert len(rows) + sum(token_alignment.popcount(p) << k for k, p in enumerate(planes)) == times.sum()


def test_pieces_of_one_block_are_merged():
    import pyarrow as pa

    rows = [(7, 0, [1, 5], [[5]]), (7, 0, [2], []), (7, 0, [9, 11], [[9], [9, 11]]), (8, 0, [1], [])]
    pack = lambda x: token_alignment.packed(np.array(x, "<u2"))
    columns = [[r[0] for r in rows], [r[1] for r in rows], [pack(r[2]) for r in rows], [[pack(p) for p in r[3]] for r in rows]]
    types = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.binary()))
    whole = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["pair", "block", "docs", "planes"])
    out = [x for b in token_alignment._merger(iter([whole.slice(0, 2), whole.slice(2, 2)])) for x in b.to_pylist()]
    assert [(x["pair"], x["n_docs"], x["n_links"]) for x in out] == [(7, 5, 5 + 2 + 2 * 2), (8, 1, 1)]
    assert token_alignment.unpacked(out[0]["docs"]).tolist() == [1, 2, 5, 9, 11] and token_alignment.unpacked(out[0]["planes"][0]).tolist() == [5, 9]


# --- lines of all lengths ---


def test_short_and_long_lines_against_brute_force(spark):
    from fathomline.llm import fuzzy_lines

    r = random.Random(21)
    lines = []
    for n in range(260):
        line = "".join(r.choices("abcdefghijklmnop    ", k=r.choice([12, 20, 24, 33, 45, 58, 70, 85, 130])))
        lines.append("x" + line + "y")
        for _ in range(n % 4):
            copy = lines[-1]
            for _ in range(r.randint(1, 2)):
                at = r.randrange(1, len(copy) - 1)
                copy = copy[:at] + r.choice(["", "#", copy[at] + "+"]) + copy[at + 1 :]
            lines.append(copy)
    lines += [f"Page {n} of 400 in this volume" for n in range(400)]  # one family, not all of it linked
    distinct = list(dict.fromkeys(lines))
    root = {line: line for line in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    sets = {(line, c): set(s.tolist()) for c in range(2, 9) for line, s in zip(distinct, fuzzy_lines.line_sets(distinct, c))}
    for k, a in enumerate(distinct):
        for b in distinct[:k]:
            c = fuzzy_lines.own_chars(min(len(a), len(b)))
            x, y = sets[a, c], sets[b, c]
            if min(len(x), len(y)) >= 0.8 * max(len(x), len(y)) and len(x & y) >= 0.8 * len(x | y) - 1e-9:
                root[find(a)] = find(b)
    seen, lost = set(), set()
    for d, line in enumerate(lines):
        if find(line) in seen:
            lost.add(d)
        seen.add(find(line))
    made = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    got = {x["doc_id"] for x in fuzzy_lines.line_dedup(made).filter("n_dropped = 1").collect()}
    assert len(got - lost) <= 0.01 * len(lost) and len(got & lost) >= 0.98 * len(lost)
