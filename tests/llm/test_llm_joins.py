"""Document join (op8) and line dedup (op9) against brute force over all pairs."""

import re

import pytest
from pyspark.sql import types as T

from recoflow.llm import jaccard_join, line_dedup

SCHEMA = "doc_id long, text string, token string, n int, row long, text_hash string, n_removed int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def passage(seed, n=40):
    return [f"{WORDS[(seed * 7 + i * i) % len(WORDS)]}{(seed * i) % 11}" for i in range(n)]


def changed(words, *places):
    return [f"new{i}" if i in places else w for i, w in enumerate(words)]


def texts():
    base, common = passage(1), passage(5, 60)
    out = [" ".join(base), " ".join(changed(base, 3)), " ".join(changed(base, 3, 20)), "  ".join(base).upper(), None, "", " \n\t ", "one two", "One TWO",
           "one two three four five", " ".join(passage(2)), " ".join(passage(2) + common), " ".join(passage(3) + common), " ".join(common), "x"]
    out += [" ".join(changed(passage(9, 80), i, 79 - i)) for i in range(12)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [rows[0], rows[7], (None, " ".join(passage(2)).title()), (None, "alone here is a text without any id")]
    return spark.createDataFrame([(*r, "t", 1, 2, "h", 3) for r in rows], SCHEMA), rows


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def groups(sets):
    """Smallest index reachable by links of 0.75."""
    at = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    at[i] = at[j] = min(at[i], at[j])
    return at


def test_documents_equal_brute_force(spark, docs):
    df, rows = docs
    sets = [shingles(t) for _, t in rows]
    at = groups(sets)
    ids = lambda i: min((rows[j][0] for j in range(len(rows)) if at[j] == at[i] and rows[j][0] is not None), default=None)
    want = sorted(((r[0], len(s), ids(i)) for i, (r, s) in enumerate(zip(rows, sets))), key=repr)
    got = sorted((tuple(r) for r in jaccard_join.near_duplicates(df.select("doc_id", "text")).collect()), key=repr)
    assert got == want


def test_one_document_of_each_group_stays(spark, docs):
    df, rows = docs
    out = jaccard_join.deduplicate(df.filter("doc_id IS NOT NULL"))
    assert out.columns == df.columns
    at = groups([shingles(t) for _, t in rows])
    firsts = {rows[i][0] for i in range(len(rows)) if rows[i][0] is not None and (not shingles(rows[i][1]) or rows[at[i]][0] == rows[i][0])}
    assert {r.doc_id for r in out.collect()} == firsts


def test_probe_counts_exactly():
    import numpy as np
    order = jaccard_join.Order(np.arange(0, 50, 2), np.arange(25) + 1)
    rng = np.random.default_rng(3)
    for _ in range(500):
        a, b = (np.unique(rng.integers(0, 60, rng.integers(1, 60))) for _ in range(2))
        both = len(np.intersect1d(a, b))
        assert jaccard_join._reaches(order, a, b) == (100 * both >= 75 * (len(a) + len(b) - both))


def test_lines_equal_brute_force(spark):
    base = passage(1)
    rows = [(3, "\n".join([" ".join(base), "short line", "", "own words of three"])),
            (1, "\n".join(["Short  LINE", " ".join(changed(base, 5)), "own words of one"])),
            (2, "\n".join([" ".join(changed(base, 5)), "short line"])), (4, None), (5, ""), (6, "short line"),
            (7, "  \n" + " ".join(passage(4))), (1, "\n".join(["Short  LINE", " ".join(changed(base, 5)), "own words of one"])), (None, "own words of one\nkept")]
    df = spark.createDataFrame([(*r, "t", 1, 2, "h", 3) for r in rows], SCHEMA)
    lines = sorted({(-1 if d is None else d, i, line) for d, t in rows if t is not None for i, line in enumerate(t.split("\n")) if shingles(line)})
    at = groups([shingles(line) for *_, line in lines])
    stay = {(d, i) for k, (d, i, _) in enumerate(lines) if at[k] == k}
    want = []
    for d, t in rows:
        kept = None if t is None else [x for i, x in enumerate(t.split("\n")) if not shingles(x) or (-1 if d is None else d, i) in stay]
        want.append((d, None if t is None else "\n".join(kept), 0 if t is None else t.count("\n") + 1 - len(kept)))
    got = line_dedup.remove_lines(df)
    assert got.columns[:-1] == df.columns and got.columns[-1] == "n_removed_"
    assert sorted(((r.doc_id, r.text, r.n_removed_) for r in got.collect()), key=repr) == sorted(want, key=repr)
    left = {r.doc_id for r in line_dedup.dedup_lines(df).collect()}
    assert left == {None, 1, 3, 4, 5, 7}, "documents without words of their own go, empty ones stay"


def test_empty_tables(spark):
    empty = spark.createDataFrame([], T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]))
    assert jaccard_join.near_duplicates(empty).count() == 0
    assert line_dedup.remove_lines(empty).count() == 0


def test_line_sets_are_built_in_small_parts(monkeypatch):
    """However much text a batch has, sets of at most about a megabyte are built at once; parts change no row."""
    import pyarrow as pa

    from recoflow.llm import line_dedup
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(40)), pa.array(range(40)), pa.array([f"one two three four five {i % 7}\nsix {i}" for i in range(40)])],
        names=["doc_id", "text_hash", "text"])
    sizes, sets = [], line_dedup._sets
    monkeypatch.setattr(line_dedup, "_sets", lambda hashed, first: sizes.append(len(hashed)) or sets(hashed, first))
    rows = lambda: [r for part in line_dedup._profile(iter([batch])) for r in part.to_pylist()]
    whole = rows()
    monkeypatch.setattr(line_dedup, "SET_BYTES", 100)
    sizes.clear()
    assert rows() == whole
    assert max(sizes) <= 40 and line_dedup.SET_BYTES < line_dedup.SLICE_BYTES


def test_lines_without_python(spark, monkeypatch):
    """Line dedup runs as DataFrame operations only, and long lists end in the same lines as short ones."""
    base = passage(1)
    rows = [(i, "\n".join([" ".join(changed(base, i)), f"own {i}", " ".join(changed(passage(6, 30), i % 30, (i * 7) % 30))])) for i in range(24)]
    rows += [(30, " ".join(base) + "\t\n  " + " ".join(base).title()), (31, "Ä  B c d É f\nä b c d é f\nÄ B\fC\rD É\vF")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("mapInArrow", "mapInPandas"):
        monkeypatch.setattr(type(df), name, lambda *_: pytest.fail("runs Python on the executors"))
    lines = [(d, i, line) for d, t in rows for i, line in enumerate(t.split("\n"))]
    at = groups([shingles(line) for *_, line in lines])
    want = {d: "\n".join(line for k, (e, _, line) in enumerate(lines) if e == d and (at[k] == k or not shingles(line))) for d, _ in rows}
    fates = lambda: {r.doc_id: r.text for r in line_dedup.remove_lines(df).collect()}
    assert fates() == want
    monkeypatch.setattr(line_dedup, "CROWD", 2)
    assert fates() == want
    monkeypatch.setattr(line_dedup, "MANY", 0)
    assert fates() == want
