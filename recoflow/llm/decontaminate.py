"""Benchmark decontamination by suffix arrays of the training text.

Documents are cut into shards of about ``SHARD_BYTES``. Each shard gets a suffix
array over its words, and every suffix of every benchmark item is searched in it
by bisection: the deepest non-empty range is the longest verbatim match of that
suffix in the shard, its entries are the places. Words outside the benchmark's
vocabulary end every match, so suffixes that start with one are left out, and
suffixes are ordered to the depth of the longest item, beyond which no search
looks. The benchmark is taken in blocks whose size is checked; each block is one
broadcast and one pass, so neither side has to fit anywhere whole.

Defined results: null and empty texts have no words and no hits; an item without
words has no window; repeated rows get equal results; items that share an id
count once, an item without id hits but is not listed; an empty benchmark hits
nothing. Words are compared by 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow.llm import words
from recoflow.llm.common import free_name, read

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20      # of benchmark text for one pass
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.LongType())),
    T.StructField("runs", T.ArrayType(T.LongType())),          # begin, end, begin, end, ... of hit words
    T.StructField("longest", T.LongType()), T.StructField("longest_at", T.LongType()),
    T.StructField("longest_item", T.LongType())])
_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
                    ("runs", pa.list_(pa.int64())), ("longest", pa.int64()), ("longest_at", pa.int64()),
                    ("longest_item", pa.int64())])


class Benchmark:
    """One block of items as word numbers: 0 ends a match, 1.. is the block's vocabulary."""

    def __init__(self, ids: list, texts: list, window: int = WINDOW):
        data, at = words.buffers(pa.array(texts, pa.large_string()))
        begins, ends, first = words.spans(data, at, words.LETTERS)
        self.vocabulary, numbers = np.unique(words.hashes(data, begins, ends), return_inverse=True)
        self.bits = max(1, int(len(self.vocabulary)).bit_length())
        self.text = np.concatenate([numbers.astype(np.int64) + 1, np.zeros(64, np.int64)])
        size = np.diff(first)
        self.item = np.repeat(np.arange(len(ids)), size)
        self.left = np.repeat(first[1:], size) - np.arange(len(numbers))
        length = np.repeat(size, size)
        self.window = np.where(length >= window, window, length)   # of the item a suffix starts in
        self.depth = int(size.max()) if len(size) else 0
        self.ids = ids

    def number(self, hashed: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashed), np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, hashed), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashed, at + 1, 0)


def packed(text: np.ndarray, at: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The n words from each place as one integer, first word highest."""
    key = np.zeros(len(at), np.int64)
    for k in range(n):
        key = (key << bits) | text[at + k]
    return key


def suffix_array(text: np.ndarray, bits: int, depth: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of ``text`` whose word is not 0, ordered by their next ``depth`` words.

    Also each one's first words as an integer, and how many those are. ``text``
    ends with at least 64 zeros. Only places whose words so far are equal and
    without a 0 are looked at again for the following words.
    """
    n = max(1, 62 // bits)
    places = np.flatnonzero(text)
    key = packed(text, places, bits, n)
    order = np.argsort(key)
    places, key = places[order], key[order]
    done, same = n, _ties(key, bits, n)
    while len(same) and done < depth:
        at = places[same]
        group = np.cumsum(np.concatenate([[True], (np.diff(same) > 1) | ~_equal(text, places, same, done)]))
        nxt = packed(text, np.minimum(at + done, len(text) - n), bits, n)
        inner = np.lexsort((nxt, group))
        places[same] = at[inner]
        nxt, group = nxt[inner], group[inner]
        done += n
        twin = (np.diff(nxt) == 0) & (np.diff(group) == 0) & _whole(nxt[1:], bits, n)
        keep = np.zeros(len(same), bool)
        keep[1:] |= twin
        keep[:-1] |= twin
        same = same[keep]
    return places, key, n


def _whole(key: np.ndarray, bits: int, n: int) -> np.ndarray:
    out = np.ones(len(key), bool)
    for k in range(n):
        out &= (key >> (bits * k)) & ((1 << bits) - 1) != 0
    return out


def _ties(key: np.ndarray, bits: int, n: int) -> np.ndarray:
    twin = (np.diff(key) == 0) & _whole(key[1:], bits, n)
    keep = np.zeros(len(key), bool)
    keep[1:] |= twin
    keep[:-1] |= twin
    return np.flatnonzero(keep)


def _equal(text: np.ndarray, places: np.ndarray, same: np.ndarray, depth: int) -> np.ndarray:
    """Whether each entry but the first has the same next ``depth`` words as the one before."""
    out = np.ones(len(same) - 1, bool)
    live = np.arange(len(same) - 1)
    for k in range(depth):
        a = np.minimum(places[same[live]] + k, len(text) - 1)
        b = np.minimum(places[same[live + 1]] + k, len(text) - 1)
        ok = text[a] == text[b]
        out[live[~ok]] = False
        live = live[ok]
    return out


def _bisect(text, places, lo, hi, depth, word, right: bool) -> np.ndarray:
    """In each range [lo, hi), ordered by the word ``depth`` further on, where ``word`` goes."""
    lo, hi = lo.copy(), hi.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        there = text[places[mid] + depth]
        up = there <= word[live] if right else there < word[live]
        lo[live[up]] = mid[up] + 1
        hi[live[~up]] = mid[~up]
        live = live[lo[live] < hi[live]]
    return lo


def search(bench: Benchmark, text: np.ndarray):
    """Yield (depth, suffixes, lo, hi) for each depth while suffixes match, after the suffix array itself."""
    places, key, n = suffix_array(text, bench.bits, bench.depth)
    yield places
    suffixes = np.arange(len(bench.item))
    lo, hi = np.zeros(len(suffixes), np.int64), np.full(len(suffixes), len(places))
    for depth in range(1, bench.depth + 1):
        live = bench.left[suffixes] >= depth
        suffixes, lo, hi = suffixes[live], lo[live], hi[live]
        if depth <= n:
            low = packed(bench.text, suffixes, bench.bits, depth) << (bench.bits * (n - depth))
            lo = np.searchsorted(key, low)
            hi = np.searchsorted(key, low + (1 << (bench.bits * (n - depth))))
        else:
            word = bench.text[suffixes + depth - 1]
            left = _bisect(text, places, lo, hi, depth - 1, word, False)
            hi = _bisect(text, places, lo, hi, depth - 1, word, True)
            lo = left
        live = lo < hi
        suffixes, lo, hi = suffixes[live], lo[live], hi[live]
        if not len(suffixes):
            return
        yield depth, suffixes, lo, hi


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """lo..hi-1 of each pair, one after the other."""
    n = hi - lo
    return np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)


def scan_shard(bench: Benchmark, data, at, before: list) -> list[dict]:
    """What ``FOUND`` says about each text of a shard; ``before``: what earlier blocks found."""
    begins, ends, first = words.spans(data, at, words.LETTERS)
    rows = len(at) - 1
    size = np.diff(first)
    text = np.zeros(len(begins) + rows + max(64, bench.depth + 1), np.int64)
    row = np.repeat(np.arange(rows), size)
    start = first[:-1] + np.arange(rows)          # a 0 after each text
    text[np.arange(len(begins)) + row] = bench.number(words.hashes(data, begins, ends))
    edge = np.zeros(len(text) + 1, np.int64)
    longest, where, which = (np.zeros(rows, np.int64), np.full(rows, -1), np.full(rows, -1))
    pairs = []
    steps = search(bench, text)
    places = next(steps)
    for depth, suffixes, lo, hi in steps:
        full = bench.window[suffixes] <= depth
        if not full.any():
            continue
        suffixes, lo, hi = suffixes[full], lo[full], hi[full]
        found = places[ranges(lo, hi)]
        owner = np.searchsorted(start, found, "right") - 1
        longest[owner], where[owner] = depth, found - start[owner]
        which[owner] = np.repeat(bench.item[suffixes], hi - lo)
        new = bench.window[suffixes] == depth
        if new.any():
            lo, hi, item = lo[new], hi[new], bench.item[suffixes[new]]
            found = places[ranges(lo, hi)]
            edge += np.bincount(found, minlength=len(edge)) - np.bincount(found + depth, minlength=len(edge))
            owner = np.searchsorted(start, found, "right") - 1
            pairs.append(np.unique(owner * len(bench.ids) + np.repeat(item, hi - lo)))
    hit = np.cumsum(edge)[:-1] > 0
    pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
    items = np.split(pairs % max(1, len(bench.ids)),
                     np.searchsorted(pairs // max(1, len(bench.ids)), np.arange(1, rows))) if rows else []
    touched = np.zeros(rows, bool)
    touched[pairs // max(1, len(bench.ids))] = True
    out = []
    for r in range(rows):
        old = before[r] if before else None
        if not touched[r]:
            out.append(old or {"n_words": int(size[r]), "n_hit": 0, "items": [], "runs": [], "longest": 0})
            continue
        got = hit[start[r]:start[r] + size[r]].copy()
        ids = {bench.ids[i] for i in items[r]}
        best = {"longest": int(longest[r]), "longest_at": int(where[r]), "longest_item": bench.ids[which[r]]}
        if old:
            for b, e in zip(old["runs"][::2], old["runs"][1::2]):
                got[b:e] = True
            ids |= set(old["items"])
            if old["longest"] >= best["longest"]:
                best = {k: old[k] for k in best}
        ids.discard(None)
        runs = np.flatnonzero(np.diff(np.concatenate([[0], got.astype(np.int8), [0]])))
        out.append({"n_words": int(size[r]), "n_hit": int(got.sum()), "items": sorted(ids),
                    "runs": runs.tolist(), **best})
    return out


def blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int):
    """Lists of (id, text) with about ``block_bytes`` of text each, one after the other."""
    rows = benchmark.select(F.col(item).cast("long").alias("i"), F.col(text).alias("t")).filter("t is not null")
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for k in range(n):
        got = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).distinct().collect() if total else []
        yield [r.i for r in got], [r.t for r in got]


def scan(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
         item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None,
         block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of what was found, and that column's name.

    ``keep`` names the columns to return (all by default). Rows stay in their
    partitions: nothing is shuffled, and a lost task is simply run again.
    """
    keep = docs.columns if keep is None else keep
    out = free_name(docs, "found")
    docs = docs.select(*dict.fromkeys([*keep, text]))
    todo = list(blocks(benchmark, item, item_text, block_bytes))
    for k, (ids, texts) in enumerate(todo):
        last = k == len(todo) - 1
        names = keep if last else docs.columns[:len(dict.fromkeys([*keep, text]))]
        shipped = docs.sparkSession.sparkContext.broadcast(Benchmark(ids, texts, window))
        schema = T.StructType([*docs.select(*names).schema.fields, T.StructField(out, FOUND)])
        docs = docs.mapInArrow(_pass(shipped, text, names, out), schema)
    return docs, out


def _pass(shipped, text: str, names: list[str], out: str):
    def run(batches):
        bench = shipped.value
        for batch in batches:
            data, at = words.buffers(batch.column(batch.schema.get_field_index(text)))
            old = batch.column(out).to_pylist() if out in batch.schema.names else None
            found = []
            for first, last in words.slices(at, SHARD_BYTES):
                found += scan_shard(bench, data, at[first:last + 1], old and old[first:last])
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _ARROW)], names=[*names, out])
    return run


def contaminated(found: str):
    """A document is contaminated if hit words make up a twentieth of it or more."""
    return (F.col(f"{found}.n_hit") > 0) & (20 * F.col(f"{found}.n_hit") >= F.col(f"{found}.n_words"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    found, name = scan(docs, benchmark)
    return found.filter(~contaminated(name)).select(*docs.columns)


def op3_suffix_decontamination(spark, sf_dir: str) -> DataFrame:
    found, name = scan(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), keep=["doc_id"])
    ids = F.array_join(F.sort_array(F.transform(F.array_distinct(f"{name}.items"), lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id", f"{name}.n_words", f"{name}.n_hit",
        F.size(f"{name}.items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), contaminated(name).alias("contaminated"))


OP3_SQL = r"""
WITH item AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
 win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS k
         FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM item WHERE len(w) > 0)),
 doc AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
 place AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM win))),
 hit AS (SELECT doc_id, item_id, i, n FROM place JOIN win USING (n, k)),
 covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
 named AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
           FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
