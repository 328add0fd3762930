"""Best-fit packing planned on a histogram of lengths.

Texts become token ids and are cut into pieces of at most ``capacity`` tokens.
Only the histogram of piece lengths (``capacity`` rows at most) goes to the
driver. There best-fit decreasing runs over counts: all pieces of a length go at
once to the fullest sequences they fit into, so the plan has some rows per
length, not per document. Pieces then take planned slots by their rank among the
pieces of equal length, which is counted with ranges of rows in parallel.

Defined results: a null text is an empty one and gives the end token alone;
repeated rows are separate pieces; an empty table gives no pieces.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow.llm import words
from recoflow.llm.common import rank_within, read
from recoflow.session import materialize

CAPACITY = 2048
END = 0
SLICE_BYTES = 4 << 20
CACHE = 1_000_000          # words a task keeps token ids of
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")


class WordTokens:
    """Token ids of words between white space, from a tokenizer that drops white space.

    Such a tokenizer gives a text the ids of its words one after the other, so a
    word is encoded once and looked up by hash after that.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.stops = {c: self._encode([c])[0] for c in ".,"}
        self._clear()

    def _clear(self):
        self.known: dict[int, int] = {}
        self.bases: dict[str, list[int]] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.ids[0] = END
        self.begin, self.size = np.zeros(1 << 16, np.int64), np.ones(1 << 16, np.int64)
        self.entries, self.used = 1, 1                 # entry 0 is the end token

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _word(self, text: str) -> list[int]:
        """Letters with at most one stop after them skip the tokenizer's own splitting."""
        plain = _PLAIN.fullmatch(text)
        if not plain or not unicodedata.is_normalized("NFC", text):
            return self._encode([text])[0]
        base = plain[1].lower()
        got = self.bases.get(base)
        if got is None:
            got = self.bases[base] = [t.id for t in self.tokenizer.model.tokenize(_byte_chars(base))]
        return got + self.stops[plain[2]] if plain[2] else got

    def numbers(self, data, begins, ends) -> np.ndarray:
        """The entry of each word."""
        hashed = words.hashes(data, begins, ends, lower=False)
        distinct, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHE:
            self._clear()
        known = self.known
        entry = np.array([known.get(h, -1) for h in distinct.tolist()], np.int64)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            got = [self._word(bytes(data[b:e]).decode("utf-8", "replace"))
                   for b, e in zip(begins[first[missing]], ends[first[missing]])]
            size = np.fromiter(map(len, got), np.int64, len(got))
            flat = np.array([i for ids in got for i in ids], np.uint32)
            self.ids = _room(self.ids, self.used + len(flat))
            self.begin, self.size = _room(self.begin, self.entries + len(got)), _room(self.size, self.entries + len(got))
            self.ids[self.used:self.used + len(flat)] = flat
            new = np.arange(self.entries, self.entries + len(got))
            self.begin[new], self.size[new] = self.used + np.cumsum(size) - size, size
            entry[missing] = new
            known.update(zip(distinct[missing].tolist(), new.tolist()))
            self.used, self.entries = self.used + len(flat), self.entries + len(got)
        return entry[inverse]

    def texts(self, data, at) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end token, and where each text's begin."""
        begins, ends, first = words.spans(data, at, words.SPACED)
        entry = self.numbers(data, begins, ends)
        entry = np.insert(entry, first[1:], 0)
        size = self.size[entry]
        stop = np.cumsum(size)
        ids = self.ids[np.arange(int(stop[-1])) + np.repeat(self.begin[entry] - (stop - size), size)]
        return ids, np.concatenate([[0], stop[first[1:] + np.arange(len(at) - 1)]])


def _room(array: np.ndarray, need: int) -> np.ndarray:
    return array if need <= len(array) else np.concatenate([array, np.zeros(max(need, 2 * len(array)) - len(array), array.dtype)])


def _byte_chars(text: str) -> str:
    """The printable stand-ins of byte-level vocabularies: visible Latin-1 bytes are themselves, the rest follow 255."""
    return text.encode().decode("latin1").translate(_STAND_INS)


_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_STAND_INS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_VISIBLE))}

_tokenizers: dict[str, WordTokens] = {}


def _tokens(path: str) -> WordTokens:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokens(path)
    return _tokenizers[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every text.

    ``tokenizer`` is the file of a tokenizer that drops white space, at the same
    place on every machine.
    """
    def run(batches):
        for batch in batches:
            data, at = words.buffers(batch.column("text"))
            tokens = _tokens(tokenizer)
            for low, high in words.slices(at, SLICE_BYTES):
                flat, begin = tokens.texts(data, at[low:high + 1])
                size = np.diff(begin)
                count = -(-size // capacity)
                row = np.repeat(np.arange(high - low), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * capacity
                length = np.minimum(capacity, size[row] - start)
                low_id = begin[row] + start
                raw = memoryview(flat.astype("<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(low_id.tolist(), length.tolist())]
                columns = [batch.column("doc_id").slice(low, high - low).take(pa.array(row)), pa.array(piece),
                           pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if ids:
                    columns.append(pa.ListArray.from_arrays(
                        pa.array(np.append(low_id, low_id[-1:] + length[-1:]), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    fields = [docs.select("doc_id").schema[0], *[T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] if ids else []
    names = [f.name for f in fields]
    return docs.select("doc_id", "text").mapInArrow(run, T.StructType(fields))


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns (length, first rank, times, first sequence, offset): pieces of that
    length from that rank on fill ``times`` places in a row, from ``offset`` on,
    of each sequence from the first one on. Of equally full sequences the ones
    opened first are taken. At most two groups of sequences change per step.
    """
    rows, rank, sequences = [], defaultdict(int), 0
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)     # space left -> (first sequence, how many)

    def put(length, first, many, times, room):
        rows.append((length, rank[length], times, first, capacity - room))
        rank[length] += many * times
        if room - length * times:
            free[room - length * times].append((first, many))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in sorted(r for r in free if r >= length):
            fits = room // length
            for first, many in free.pop(room):
                take = min(many, left // fits)
                if take:
                    put(length, first, take, fits, room)
                    left -= take * fits
                if take < many and left:
                    # fewer than ``fits`` remain: they go together into the next one
                    put(length, first + take, 1, left, room)
                    left, take = 0, take + 1
                if take < many:
                    free[room].append((first + take, many - take))
        fits = capacity // length
        if left >= fits:
            put(length, sequences, left // fits, fits, capacity)
            sequences += left // fits
            left %= fits
        if left:
            put(length, sequences, 1, left, capacity)
            sequences += 1
    return rows


def place(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``lengths`` (a column ``length``, anything else) with ``sequence_id`` and ``offset``.

    The broadcast plan has a few rows for each length up to ``capacity``.
    """
    histogram = {r.length: r.n for r in lengths.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = sorted(plan(histogram, capacity))
    table = [np.array(c, np.int64) for c in zip(*rows)] if rows else [np.zeros(1, np.int64)] * 5
    shipped = lengths.sparkSession.sparkContext.broadcast(table)
    order = [F.col(c) for c in lengths.columns if c != "length"]
    ranked = rank_within(lengths, ["length"], order, "_rank", "pieces")
    names = lengths.columns

    def run(batches):
        length, first, times, sequence, offset = shipped.value
        key = (length << 44) + first
        for batch in batches:
            size = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(batch.schema.get_field_index("_rank")).to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, (size << 44) + rank, "right") - 1
            rest = rank - first[at]
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence[at] + rest // times[at]), pa.array(offset[at] + rest % times[at] * size)],
                names=[*names, "sequence_id", "offset"])

    schema = T.StructType([*lengths.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Every piece with its sequence and its place there; ``ids``: with its token ids.

    Ids stay out of the ranking; they are joined back by document and piece.
    """
    cut = materialize(pieces(docs, tokenizer, capacity, ids), "pieces")
    if not ids:
        return place(cut, capacity)
    keys = ["doc_id", "piece", "ids_crc32"]
    placed = place(cut.drop("ids"), capacity)
    return placed.join(cut.select(*keys, "ids").dropDuplicates(keys), keys)


def op5_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
