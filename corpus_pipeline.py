"""The corpus pipeline: toxicity, line dedup, near-duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as
Parquet and read again before the next one. All but the last return the columns
of ``documents``. What a stage drops or changes:

1. documents that score 0.5 or more as toxic go;
2. lines that match an earlier line go; documents that lose their last words go;
3. of documents linked by shingle similarity the one with the smallest id stays;
4. documents that benchmark passages make up a twentieth of or more go;
5. what is left is cut into token pieces and packed into sequences.
"""

from __future__ import annotations

from recoflow.llm import decontaminate, jaccard_join, line_dedup, packing, toxicity
from recoflow.llm.common import read
from recoflow.session import materialize


def _toxicity(spark, docs, sf_dir):
    return toxicity.mild(docs, read(spark, sf_dir, "labels"))


def _lines(spark, docs, sf_dir):
    return line_dedup.dedup_lines(docs)


def _near_duplicates(spark, docs, sf_dir):
    return jaccard_join.deduplicate(docs)


def _decontaminate(spark, docs, sf_dir):
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def _pack(spark, docs, sf_dir):
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", _toxicity),
    ("line dedup", _lines),
    ("n-gram jaccard join", _near_duplicates),
    ("benchmark decontamination", _decontaminate),
    ("best-fit packing", _pack),
]
#: The trained model and the tokenizer are not expressible in SQL; tests/llm checks each stage.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
