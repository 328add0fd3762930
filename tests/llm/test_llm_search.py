"""Vector search, token alignment and lexical search against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow.parquet as pq
import pytest

from recoflow.llm import alignment, catalog, maxscore, treap_search

SF = "/root/testdata/sf0.001"


# --- op11 --------------------------------------------------------------------

def best_products(rows, k, every=50):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {(i, tuple(v)) for i, v in good if i is not None and i % every == 0}
    out = []
    for i, q in queries:
        scored = sorted(((sum(a * b for a, b in zip(q, v)), j) for j, v in good if j is None or j != i),
                        key=lambda x: (-x[0], x[1] is None, x[1]))
        out += [(i, n + 1, j, max(-(1 << 63), min((1 << 63) - 1, s))) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, kind string, query string")


def found_products(spark, rows, k=5, every=50, **settings):
    table = vectors(spark, rows)
    got = maxscore.search(maxscore.build(table), table.where(table.vec_id % every == 0), k, **settings)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_products_equal_brute_force(spark, monkeypatch):
    """Several shards, a hot vector, sparse and short vectors, ties, odd values."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(8)]) for i in range(300)]
    rows += [(1000 + i, list(rows[0][1])) for i in range(150)]
    rows += [(2000 + i, [rng.choice([0.0, 0.0, 0.0, 0.5, -0.25]) for _ in range(8)]) for i in range(100)]
    rows += [(3000, []), (3001, [0.5]), (3050, [0.25, -0.5]), (None, [0.5] * 8), (50, [-1.0] * 8), (4000, [0.0] * 8),
             (4050, None), (4100, [1.0, None]), (4150, [float("nan")] * 8), (4200, [float("inf")] * 8), (100, list(rows[100][1]))]
    monkeypatch.setattr(maxscore, "SHARD", 64)
    assert found_products(spark, rows, block=4) == best_products(rows, 5)


def test_products_outside_64_bits_and_fewer_than_k(spark):
    rows = [(0, [1e30, 1.0]), (1, [1e30, 2.0]), (2, [-1e30, 3.0]), (3, [1e29, 0.0]), (4, [0.0, 1e-3])]
    assert found_products(spark, rows, k=9) == best_products(rows, 9)
    assert found_products(spark, []) == [] and found_products(spark, [(0, [1.0])]) == []


def test_lists_below_the_bound_are_only_probed():
    """With a k-th best score at hand, a list that cannot reach it is never traversed."""
    rng = np.random.default_rng(3)
    values = rng.integers(-20, 20, (4, 500))
    values[0] = rng.integers(0, 2000, 500)
    shard = maxscore.Shard(500, np.arange(5) * 500, np.tile(np.arange(500), 4), values.ravel())
    query, whole = np.array([10.0, 1.0, -2.0, 1.0]), []
    add = shard.add
    shard.add = lambda score, at, d, factor: (whole.append((d, at is None)), add(score, at, d, factor))
    exact = query.astype(int) @ values
    least = int(np.sort(exact)[-5])
    found, score = shard.search(query, least)
    assert sorted(zip(found.tolist(), score.tolist())) == sorted((i, int(s)) for i, s in enumerate(exact) if s >= least)
    assert [d for d, traversed in whole if traversed] == [0]


# --- op12 --------------------------------------------------------------------

TEXTS = ["", None, " ", "a", "a ", " a", "\n", "\na b", "x \n y", "tab\t\tx  \n\n  y", "▁odd", "<0x41> <s> <unk> <|endoftext|>",
         "日本語 テキスト　です", "emoji 😀😀 👩‍👩‍👧", "don't we'll 's", "\x00\x1c a", "a" * 300, "é" * 200, "…—’ “q” ",
         "nb  sp   x", "0123 456  789", "a.b,c!?d", "\r\n\r\n x", "ﬁ ligature Å", "the cat sat", "the cat sat", "word " * 4000]


@pytest.fixture(scope="module")
def paths():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain_alignment(paths, text):
    """(a ids, b ids, groups, links (kind -> {(i, j): weight})) by loops over bytes."""
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(paths[0]), sentencepiece.SentencePieceProcessor(model_file=paths[1])
    a.encode_special_tokens = True
    none = [], [], [], {"end": {}, "overlap": {}, "group": {}}
    if not text:
        return none
    got = a.encode(" " + text, add_special_tokens=False)
    xs, ys = got.ids, b.encode(text)
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    back = {chr(c): c for c in shown} | {chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in shown)}
    left = [bytes(back[c] for c in a.id_to_token(i)) for i in xs]
    right = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b.id_to_piece, ys)]
    if not b"".join(left) == b"".join(right) == (" " + text).encode():
        return none
    ae, be = list(accumulate(map(len, left))), list(accumulate(map(len, right)))
    cuts = sorted(set(ae) & set(be))
    group = lambda stop: sum(c < stop for c in cuts)
    groups = [([i for i, e in zip(xs, ae) if group(e) == g], [i for i, e in zip(ys, be) if group(e) == g]) for g in range(len(cuts))] \
        if len(xs) < 1000 else None
    kinds = {"end": {}, "overlap": {}, "group": {}}
    at = {e: j for j, e in enumerate(be)}
    for i, e in enumerate(ae):
        if e in at:
            kinds["end"][i, at[e]] = 1
    if len(xs) < 1000:
        for i in range(len(xs)):
            for j in range(len(ys)):
                shared = min(ae[i], be[j]) - max(ae[i] - len(left[i]), be[j] - len(right[j]))
                if shared > 0:
                    kinds["overlap"][i, j] = shared
                if group(ae[i]) == group(be[j]):
                    kinds["group"][i, j] = 1
    return xs, ys, groups, kinds


def documents(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, row int, pairs int")


@pytest.mark.parametrize("hottest", [1 << 19, 3])
def test_alignment_equals_loops(spark, paths, hottest):
    rows = [*enumerate(TEXTS), (None, "the cat"), (24, "the cat sat")]
    plain = [(i, *plain_alignment(paths, t)) for i, t in rows]
    counts = Counter((xs[i], ys[j]) for _, xs, ys, _, kinds in plain for i, j in kinds["end"])
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(highest.get(b, 0), n)
    made = alignment.materialize(alignment.align(documents(spark, rows), *paths))
    rated = alignment.rate(made, alignment.pair_counts(made), hottest)
    got = {}
    for r in made.join(rated, "row", "left").collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    for i, xs, ys, groups, kinds in plain:
        for r in got[i]:
            links = [(xs[a], ys[b]) for a, b in kinds["end"]]
            assert (r.n_a, r.n_b, r.n_groups, r.n_links) == (len(xs), len(ys), len(links), len(links))
            assert (r.n_best or 0, r.count_sum or 0) == (sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links))
            if groups is not None:
                text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
                assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if xs else "")
                assert (r.n_overlaps, r.n_shared) == (len(kinds["overlap"]), len(kinds["group"]))
    assert alignment.align(documents(spark, []), *paths).count() == 0


@pytest.mark.parametrize("kind", ["end", "overlap", "group"])
def test_links_equal_loops(spark, paths, kind):
    rows = list(enumerate(t for t in TEXTS if not t or len(t) < 1000))
    got = Counter(tuple(r) for r in alignment.links(documents(spark, rows), *paths, kind=kind).collect())
    want = Counter()
    for i, t in rows:
        xs, ys, _, kinds = plain_alignment(paths, t)
        want.update((i, a, b, xs[a], ys[b], w) for (a, b), w in kinds[kind].items())
    assert got == want


def test_sparse_products():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 3, (13, 9)), rng.integers(0, 3, (9, 11))
    csr = lambda m: alignment._from_rows(*np.nonzero(m), m[np.nonzero(m)], m.shape)
    for entries in (1, 10, 1000):
        out = np.zeros((13, 11), int)
        for i, j, v in alignment.product_blocks(csr(x), csr(y), entries):
            out[i, j] += v
        assert (out == x @ y).all()
    back = alignment.transpose(csr(x))
    assert (back.indptr == alignment._from_rows(*np.nonzero(x.T), x.T[np.nonzero(x.T)], x.T.shape).indptr).all()


# --- op13 --------------------------------------------------------------------

def lexical(docs, items, k=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, Counter(split(t))) for i, t in docs if split(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(split(t))
    out = []
    for i, terms in wanted.items():
        scored = []
        weights = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                   for t in terms if (df := sum(t in c for _, c in held))}
        for d, c in held:
            m = 10 + 90 * sum(c.values()) * n_docs // total
            scored.append((sum(w * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in weights.items() if t in c), d))
        scored = sorted((x for x in scored if x[0] > 0), key=lambda x: (-x[0], x[1] is None, x[1]))
        out += [(i, n + 1, d, s) for n, (s, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard,step,block", [(4096, 96, 1 << 20), (7, 2, 60), (1, 1, 1)])
def test_lexical_search_equals_brute_force(spark, monkeypatch, shard, step, block):
    monkeypatch.setattr(treap_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(treap_search, "STEP", step)
    rng = random.Random(shard)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ß2"]
    text = lambda n: " ".join(rng.choices(vocabulary, k=n, weights=[1 / (i + 1) for i in range(42)]))
    docs = [(i, text(rng.randint(1, 30))) for i in range(60)] + [(100 + i, "W1 w2, w3") for i in range(30)]
    docs += [(200, None), (201, ""), (202, "-- !"), (None, "w39 w39 w1"), (5, "w5 w5"), (203, "w7 " * 5000)]
    items = [(i, text(rng.randint(1, 12))) for i in range(8)] + [(None, "w1 W2"), (20, None), (21, "..."), (22, "none here"), (3, "w30 É")]
    frame = spark.createDataFrame([(i, t, 1, 1) for i, t in docs], "doc_id long, text string, ids int, tree int")
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = treap_search.search(*treap_search.build(frame), asked, block_bytes=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == lexical(docs, items)


def test_lexical_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "a")], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    assert treap_search.search(*treap_search.build(none), asked).count() == 0
    assert treap_search.search(*treap_search.build(some), asked.limit(0)).count() == 0
    assert [tuple(r) for r in treap_search.search(*treap_search.build(some), asked).collect()] == lexical([(1, "a b"), (2, "c")], [(1, "a")])


def test_a_row_group_of_the_index_is_a_shard(spark, monkeypatch):
    """No reader or writer holds several shards, nor keeps their bytes as statistics."""
    monkeypatch.setattr(treap_search, "SHARD_DOCS", 4)
    frame = spark.createDataFrame([(i, f"word{i} word{i % 3}") for i in range(40)], "doc_id long, text string").coalesce(1)
    index, docs, _ = treap_search.build(frame)
    footers = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in index.inputFiles()]
    groups = [m.row_group(i) for m in footers for i in range(m.num_row_groups)]
    assert docs == 40 and [g.num_rows for g in groups] == [1] * 10
    assert not any(g.column(c).is_stats_set for g in groups for c in range(g.num_columns))


def test_tree_bounds_and_leaves():
    """Each node's maximum bounds its leaves, and leaves hold the exact impacts."""
    rng = np.random.default_rng(1)
    points = np.unique(rng.integers(0, [40, 16], (200, 2)), axis=0)
    points = np.concatenate([points, [[r, 0] for r in range(0, 40, 16) if not (points[:, 0] // 16 == r // 16).any()]]).astype(int) \
        if len({r // 16 for r in points[:, 0]}) < 3 else points
    tf, m = rng.integers(1, 300, len(points)), rng.integers(10, 400, 16)
    tree = treap_search.Tree(treap_search.build_tree(points[:, 0], points[:, 1], tf, m, 4), 3, 4, m)
    want = {(r, c): int(treap_search.impacts(t, m[c])) for (r, c), t in zip(map(tuple, points.tolist()), tf)}
    for row in range(40):
        scores, columns = tree.search(np.array([row]), np.array([1]), 0, 99)
        assert dict(zip(columns.tolist(), scores.tolist())) == {c: v for (r, c), v in want.items() if r == row}


def test_alignment_query_keeps_all_rows(spark):
    got = catalog.QUERIES["op12_token_alignment"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
