"""Toxicity scores from FTRL-proximal logistic regression over hashed word features.

Features of a text: its distinct words, word pairs, and pairs with one word
left out between, each as a 62-bit hash of lower-cased words; the beginnings of
longer words stand beside them, so inflected forms share weight. Training rows are a
sample of at most ``MAX_ROWS`` labelled rows (those with the smallest hash of
their id), dealt to ``SHARDS`` groups; each group runs FTRL with per-coordinate
rates over its rows ``EPOCHS`` times and returns its non-zero weights, and the
groups' weights are averaged. A group only considers features that ``MIN_DOCS`` of its texts have. L1 leaves few
weights; they are kept as two sorted arrays of at most ``MAX_WEIGHTS`` entries,
which is what scoring broadcasts.

Defined results: null and empty texts score the model's bias; repeated labels of
a document count once, as toxic if any says so; labels without id or value are
ignored; without usable labels every score is 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow.llm import words
from recoflow.llm.common import free_name, read, split_by_ids
from recoflow.session import materialize

MAX_ROWS = 16_384      # labelled rows the model is fitted on
SHARDS = 8
EPOCHS = 4
MIN_DOCS = 4
MAX_WEIGHTS = 1 << 20
ALPHA, BETA, L1, L2 = 2.0, 1.0, 4.0, 0.0
SLICE_BYTES = 1 << 20
STEMS = (4, 6)         # bytes of a longer word that count as a word of their own
_PAIR, _SKIP, _STEM = (np.uint64(f) for f in (0xD6E8FEB86659FD93, 0xCA5A826395121157, 0x9FB21C651E98DF25))


def features(data, at) -> tuple[np.ndarray, np.ndarray]:
    """Every feature of every text with repeats, and the text each belongs to."""
    begins, ends, first = words.spans(data, at, words.LETTERS)
    h = words.hashes(data, begins, ends)
    row = np.repeat(np.arange(len(at) - 1), np.diff(first))
    pair = row[1:] == row[:-1]
    skip = row[2:] == row[:-2]
    one = h
    two = (h[:-1] * _PAIR + (h[1:] ^ (h[1:] >> np.uint64(29))))[pair]
    gap = (h[:-2] * _SKIP + (h[2:] ^ (h[2:] >> np.uint64(31))))[skip]
    stems, owners = [], []
    for n in STEMS:
        some = ends - begins > n
        stems.append(words.hashes(data, begins[some], begins[some] + n) * _STEM)
        owners.append(row[some])
    ids = np.concatenate([one, two, gap, *stems]) & np.uint64((1 << 62) - 1)
    return ids.astype(np.int64), np.concatenate([row, row[:-1][pair], row[:-2][skip], *owners])


def _feature_rows(batches):
    for batch in batches:
        data, at = words.buffers(batch.column("text"))
        for first, last in words.slices(at, SLICE_BYTES):
            ids, row = features(data, at[first:last + 1])
            order = np.lexsort((ids, row))
            ids, row = ids[order], row[order]
            new = np.ones(len(ids), bool)
            new[1:] = (ids[1:] != ids[:-1]) | (row[1:] != row[:-1])
            ids, row = ids[new], row[new]
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(row, np.arange(last - first + 1)), pa.int32()), pa.array(ids))
            part = batch.slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("toxic"), part.column("shard"), lists],
                names=["doc_id", "toxic", "shard", "features"])


def ftrl(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Features with non-zero weight, their weights, and the bias."""
    every, count = np.unique(np.concatenate(rows), return_counts=True)
    every = every[count >= MIN_DOCS]
    known = []
    for ids in rows:
        inside = np.isin(ids, every, assume_unique=True)
        known.append(np.append(np.searchsorted(every, ids[inside]), len(every)))
    z, n, w = (np.zeros(len(every) + 1) for _ in range(3))
    limit = np.full(len(every) + 1, L1)
    limit[-1] = 0.0                                   # the bias is not shrunk
    for _ in range(EPOCHS):
        for at, y in zip(known, labels):
            zi, ni = z[at], n[at]
            wi = np.where(np.abs(zi) <= limit[at], 0.0,
                          -(zi - np.sign(zi) * limit[at]) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            g = 1.0 / (1.0 + np.exp(-np.clip(wi.sum(), -35, 35))) - y
            z[at] += g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[at] += g * g
    w = np.where(np.abs(z) <= limit, 0.0, -(z - np.sign(z) * limit) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    some = np.flatnonzero(w[:-1])
    return every[some], w[:-1][some], float(w[-1])


def _train_group(frame):
    import pandas as pd
    frame = frame.sort_values("order")
    ids, w, bias = ftrl(list(frame["features"]), frame["toxic"].to_numpy(float))
    return pd.DataFrame({"feature": np.append(ids, -1), "weight": np.append(w, bias)})


class Model:
    """Sorted feature ids and weights, and the bias; None: no labels to learn from."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, bias: float | None):
        order = np.argsort(ids)
        self.ids, self.weights, self.bias = ids[order], weights[order].astype(np.float64), bias

    def scores(self, data, at) -> np.ndarray:
        if self.bias is None:
            return np.zeros(len(at) - 1)
        maybe = np.zeros(1 << 20, bool)                 # most features have no weight
        maybe[self.ids & ((1 << 20) - 1)] = True
        total = np.full(len(at) - 1, self.bias)
        for first, last in words.slices(at, SLICE_BYTES):
            ids, row = features(data, at[first:last + 1])
            some = maybe[ids & ((1 << 20) - 1)]
            ids, row = ids[some], row[some]
            place = np.minimum(np.searchsorted(self.ids, ids), max(0, len(self.ids) - 1))
            hit = self.ids[place] == ids if len(self.ids) else np.zeros(len(ids), bool)
            once = np.unique(row[hit] * len(self.ids) + place[hit])
            total[first:last] += np.bincount(once // max(1, len(self.ids)), minlength=last - first,
                                             weights=self.weights[once % max(1, len(self.ids))])[:last - first]
        return 1.0 / (1.0 + np.exp(-np.clip(total, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model from ``labels`` (doc_id, toxic) and the texts of ``docs`` (doc_id, text)."""
    known = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
             .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    known = materialize(known.withColumn("order", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))), "labels")
    # only rows that can be among the smallest leave their tasks
    share = min(1.0, 2 * max_rows / max(1, known.count()))
    sample = materialize(known.filter(F.col("order") < int(share * (1 << 40))).orderBy("order", "doc_id")
                         .limit(max_rows), "labelled")
    some, _ = split_by_ids(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id",
                           sample.select("doc_id"))
    schema = "doc_id long, toxic int, shard int, features array<long>"
    rows = (some.join(sample, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"), F.max("toxic").alias("toxic"))
            .select("doc_id", "text", "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(SHARDS)).cast("int").alias("shard"))
            .mapInArrow(_feature_rows, schema)
            .withColumn("order", F.xxhash64("doc_id", F.lit(2))))
    parts = rows.select("shard", "order", "toxic", "features").groupBy("shard").applyInPandas(
        _train_group, "feature long, weight double")
    parts = materialize(parts, "weights")
    groups = parts.filter("feature = -1").count()
    mean = (parts.groupBy("feature").agg((F.sum("weight") / F.lit(max(groups, 1))).alias("weight"))
            .filter("weight <> 0").orderBy(F.abs("weight").desc(), "feature").limit(MAX_WEIGHTS + 1).toPandas())
    if not groups:
        return Model(np.zeros(0, np.int64), np.zeros(0), None)
    ids, weights = mean["feature"].to_numpy(np.int64), mean["weight"].to_numpy(float)
    bias = ids == -1
    return Model(ids[~bias], weights[~bias], float(weights[bias].sum()))


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> tuple[DataFrame, str]:
    """``docs`` with the score of each whole text as a double column, and that column's name."""
    keep = docs.columns if keep is None else keep
    out = free_name(docs, "toxicity")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            data, at = words.buffers(batch.column(batch.schema.get_field_index(text)))
            columns = [batch.column(batch.schema.get_field_index(n)) for n in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(shipped.value.scores(data, at))], names=[*keep, out])

    docs = docs.select(*dict.fromkeys([*keep, text]))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField(out, T.DoubleType())])
    return docs.mapInArrow(run, schema), out


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    return labels.filter(~held_out())


def mild(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, unchanged."""
    scored, name = score(docs, fit(docs, training_labels(labels)))
    return scored.filter(F.col(name) < 0.5).select(*docs.columns)


def op4_ftrl_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored, name = score(docs, fit(docs, training_labels(read(spark, sf_dir, "labels"))), keep=["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), F.col(name).alias("score"),
                         (F.col(name) >= 0.5).cast("int").alias("predicted"))
