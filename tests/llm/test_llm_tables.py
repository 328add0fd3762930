"""Sharding, archives, preference pairs, helpers, and the queries against their SQL."""

import random

import pytest

from recoflow.llm import catalog, common, preferences, sharding, warc

SF = "/root/testdata/sf0.001"


def test_shards_are_even_and_keep_groups(spark):
    texts = [f"text {i}" for i in range(100)] + ["same"] * 15 + ["twin"] * 4 + [None, None, "", ""]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(5, "text 5", 1)], "doc_id long, text string, shard int")
    got = sharding.shard(docs, 8).collect()
    assert len(got) == len(texts) + 1
    sizes = [[r.slot for r in got if r.shard == s] for s in range(8)]
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1 and all(sorted(s) == list(range(len(s))) for s in sizes)
    at = lambda t: {r.shard for r in got if r.doc_id is not None and r.doc_id < len(texts) and texts[r.doc_id] == t}
    assert len(at("same")) == len(at("twin")) == 1
    assert {r.size for r in got if texts[r.doc_id] is None} == {1} and {r.text_crc32 for r in got if texts[r.doc_id] is None} == {None}
    assert sharding.shard(docs.limit(0), 8).count() == 0


def test_a_group_larger_than_a_shard_is_split(spark):
    docs = spark.createDataFrame([(i, "hot" if i < 40 else f"t{i}") for i in range(80)], "doc_id long, text string")
    got = sharding.shard(docs, 4).collect()
    assert sorted(sum(r.shard == s for r in got) for s in range(4)) == [20] * 4
    assert max(sum(r.shard == s for r in got if r.doc_id < 40) for s in range(4)) == 20


@pytest.mark.parametrize("min_bytes", [0, 10])
def test_archives(spark, min_bytes):
    rows = [(1, "a", "x" * 50), (2, "b\r\nc", "x" * 50), (3, None, None), (4, "", ""), (5, "u", "é" * 9), (None, "n", "x" * 50),
            (None, "n", "solo payload"), (7, "q", "x" * 50), (7, "q", "x" * 50), (8, "l", "<p>" + "long " * 40000), (9, "w", "WARC/1.1\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    got = warc.read_back(warc.write(pages, min_bytes=min_bytes)).collect()
    body = lambda h: (h or "").encode()
    want = []
    for i, _, h in rows:
        same = [j for j, _, g in rows if body(g) == body(h) and j is not None]
        original = max(same, default=None) if len(body(h)) >= min_bytes else None
        again = original is not None and i != original
        want.append((i, "revisit" if again else "response", len(body(h)), warc.digest(body(h)), original if again else None))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert warc.read_back(warc.write(pages.limit(0))).count() == 0


def test_archive_starts_with_its_dictionary(spark):
    pages = common.read(spark, SF, "pages")
    manifest = warc.write(pages).collect()
    fs, place = warc._filesystem(manifest[0].path)
    with fs.open_input_stream(place, compression=None) as f:
        assert f.read(4) == warc.MAGIC.to_bytes(4, "little") and int.from_bytes(f.read(4), "little") > 1000
    assert sum(r.records for r in manifest) == pages.count()


def test_preference_pairs(spark):
    turns = [("system", "s"), ("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", "end")]
    chosen = [(1, i, r, t) for i, (r, t) in enumerate(turns)] + [(2, 0, "user", "same"), (None, 0, "user", "x"), (3, 0, None, None), (1, 0, "system", "s")]
    rejected = [(1, i, r, "no" if i == 2 else t) for i, (r, t) in enumerate(turns[:4])] + [(2, 0, "user", "same"), (3, 0, None, None), (3, 1, "assistant", "z")]
    schema = "pair_id long, turn long, role string, text string"
    rows = preferences.format_pairs(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema))
    one = {r.pair_id: r for r in preferences.assemble(rows).collect()}
    assert set(one) == {1, 2, 3}
    assert one[1].prompt == "<|system|>\ns<|end|>\n<|user|>\nhi<|end|>\n"
    assert one[1].chosen == "<|assistant|>\nyes<|end|>\n<|user|>\nmore<|end|>\n<|assistant|>\nend<|end|>\n"
    assert one[1].rejected == "<|assistant|>\nno<|end|>\n<|user|>\nmore<|end|>\n"
    assert [m.masked for m in one[1].chosen_mask] == [False, True, False] and sum(m.length for m in one[1].chosen_mask) == len(one[1].chosen)
    assert one[2].chosen == one[2].rejected == "" and one[3].chosen == "" and one[3].prompt == "<||>\n<|end|>\n"
    assert preferences.format_pairs(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    at = {n: n for e in edges for n in e}
    for _ in at:
        for a, b in edges:
            at[a] = at[b] = min(at[a], at[b])
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: c for n, c in at.items() if any(a != b and n in (a, b) for a, b in edges)}


def test_rank_and_filter(spark):
    df = spark.createDataFrame([(i % 3 or None, i, "x") for i in range(50)], "g int, v long, _at string")
    got = common.rank_within(df.drop("_at"), ["g"], [common.F.col("v").desc()], "r").collect()
    for g in (None, 1, 2):
        assert [r.v for r in sorted((r for r in got if r.g == g), key=lambda r: r.r)] == sorted((r.v for r in got if r.g == g), reverse=True)
        assert sorted(r.r for r in got if r.g == g) == list(range(sum(r.g == g for r in got)))
    some, rest = common.split_by_ids(df, "v", spark.createDataFrame([(3,), (9,)], "i long"))
    assert {3, 9} <= {r.v for r in some.collect()} and some.count() + rest.count() == 50


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, name):
    import check
    diff = check.compare(catalog.QUERIES[name](spark, SF), check.connect(SF), catalog.SQL[name])
    assert diff is None, f"{name}: {diff}"


def test_pipeline_stages(spark):
    """Each stage's decisions take effect, and all but the last return the columns of documents."""
    import corpus_pipeline
    docs = common.read(spark, SF, "documents")
    columns, before = docs.columns, docs.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "n-gram jaccard join", "benchmark decontamination", "best-fit packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "stage")
        assert docs.columns == columns and docs.count() <= before
        before = docs.count()
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.select("doc_id").distinct().count() == before


def _first_of_groups(sets):
    """Positions that are not the first of their group, groups joined at a Jaccard similarity of 0.75 or more."""
    at = list(range(len(sets)))
    def root(i):
        while at[i] != i:
            i = at[i]
        return i
    for j in range(len(sets)):
        for i in range(j):
            if sets[i] and sets[j] and 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                at[b] = a
    return {i for i in range(len(sets)) if root(i) != i}


def test_pipeline_stages_equal_brute_force(spark, tmp_path):
    """Planted copies, shared lines, benchmark passages and toxic texts: the rows of each stage but packing in plain Python."""
    import corpus_pipeline
    rng = random.Random(8)
    new = lambda n, mark="": [mark + "".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n)]
    cut = lambda w, n: "\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n))
    bad = new(12, "zz")
    passage = new(30)
    texts = [cut(new(60), 12) for _ in range(60)]
    line, near = new(20), new(60)
    for i in (3, 9, 27):
        texts[i] += "\n" + " ".join(line)
    texts[40] += "\n" + " ".join([*line[:-1], "other"])
    texts += [cut(near, 7), cut(near, 9), cut([*near[:-2], "end"], 11)]
    texts += [cut(new(20) + passage + new(10), 10), cut(new(400) + passage[:13], 15), " ".join(line)]
    toxic = [cut(rng.choices(bad, k=40) + new(5), 12) for _ in range(60)]
    rows = [(2 * i, t, "en", "s", len(t)) for i, t in enumerate(texts)] + [(2 * i + 1, t, "en", "s", len(t)) for i, t in enumerate(toxic)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(r[0], 1, r[0] % 2) for r in rows if r[0] % 10 < 8]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(passage))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    grams = lambda t: {tuple(w[i:i + 5]) for w in [t.split()] for i in range(max(1, len(w) - 4))} if t.split() else set()
    expected = {r[0]: r[1] for r in rows}
    removed = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), "stage")
        before, ids = dict(expected), sorted(expected)
        if name == "toxicity":
            expected = {i: t for i, t in before.items() if i % 2 == 0}
        elif name == "line dedup":
            lines = [(i, x) for i in ids for x in before[i].split("\n")]
            gone = _first_of_groups([grams(x) for _, x in lines])
            kept = {i: [x for k, (j, x) in enumerate(lines) if j == i and k not in gone] for i in ids}
            expected = {i: "\n".join(x) for i, x in kept.items() if x}
        elif name == "n-gram jaccard join":
            gone = _first_of_groups([grams(before[i]) for i in ids])
            expected = {i: before[i] for k, i in enumerate(ids) if k not in gone}
        else:
            windows = {tuple(passage[k:k + 13]) for k in range(len(passage) - 12)}
            for i in ids:
                w = before[i].split()
                hit = {p for k in range(len(w)) if tuple(w[k:k + 13]) in windows for p in range(k, k + 13)}
                if hit and 20 * len(hit) >= len(w):
                    del expected[i]
        removed.append(len(before) - len(expected))
        assert {r.doc_id: r.text for r in docs.collect()} == expected, name
    assert removed == [60, 1, 2, 1]
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).select("doc_id").collect()} == set(expected)
