"""Extra columns named like the operators' own helpers come back unchanged."""

import pytest

from recoflow.llm import common, jaccard_join, line_dedup, surrogates

HELPERS = ["_slot", "_word", "_bits", "_s", "_lost_id", "_lost_hash", "_lost_n", "_lost_kept", "_id", "_hash", "_new", "_known",
           "_at", "_part", "_low", "_before", "n", "g0"]
LINE = "one line of nine words that comes up twice"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, f"{LINE}\nfirst"), (2, f"{LINE}\nsecond"), (3, "write to a.person@mail.example.com about Mrs. Anna Miller"), (4, None),
            (5, " ".join(f"word{i}" for i in range(40))), (6, " ".join(f"word{i}" for i in range(40)))]
    values = [f"v{k}" for k in range(len(HELPERS))]
    schema = "doc_id long, text string, " + ", ".join(f"{h} string" for h in HELPERS)
    return spark.createDataFrame([(*r, *values) for r in rows], schema)


def extras(df):
    out = df.collect()
    assert all([r[h] for h in HELPERS] == [f"v{k}" for k in range(len(HELPERS))] for r in out)
    return sorted(r.doc_id for r in out)


def test_near_duplicates(docs):
    assert extras(jaccard_join.deduplicate(docs)) == [1, 2, 3, 4, 5]


def test_lines(docs):
    out = line_dedup.remove_lines(docs)
    assert extras(out) == [1, 2, 3, 4, 5, 6]
    assert {r.doc_id: r.n_removed for r in out.collect()} == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, 6: 1}


def test_surrogates(docs):
    out = surrogates.replace(docs)
    assert extras(out) == [1, 2, 3, 4, 5, 6]
    assert out.filter("doc_id = 3").first().n_entities == 2


def test_ranks(docs):
    out = common.rank_within(docs, ["_part"], ["doc_id"], "rank")
    assert extras(out) == [1, 2, 3, 4, 5, 6]
    assert sorted((r.doc_id, r["rank"]) for r in out.collect()) == [(i + 1, i) for i in range(6)]
