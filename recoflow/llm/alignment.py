"""Alignment of two tokenizers by products of sparse token-byte incidence matrices.

A text's tokens under tokenizer A and under tokenizer B are rows of incidence
matrices over its bytes, kept in hand-built CSR. Gustavson's row product A . B^T
gives every pair of tokens that share bytes, with the number of bytes shared.
The same product over last bytes only gives the pairs that end together; these
places cut both token sequences into groups, and group incidence matrices give
the pairs that share a group.

Scale: a text falls into chunks at places where neither tokenizer ever joins
what stands before and after, so a chunk's tokens do not depend on its
surroundings; a chunk is encoded and multiplied once per worker and looked up
by hash after that. Texts for which that is not sure are encoded whole. Link
counts are summed per document before they are exploded; the hottest id pairs,
a bounded number, are joined by broadcast and the rest by shuffle.

Defined results: a null or empty text, and one whose joined token bytes differ
from space + text, has no tokens and zeros everywhere; repeated rows and null
ids are documents of their own, each counted; an empty table gives no rows.
Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recoflow.llm import words
from recoflow.llm.common import read
from recoflow.llm.packing import _STAND_INS
from recoflow.session import materialize

SLICE_BYTES = 4 << 20
PRODUCT_BYTES = 1 << 20     # bytes of chunks, or entries of a product, handled at once
CACHE = 400_000             # chunks a worker keeps, 150 MB
CACHE_BYTES = 64            # longer chunks are not kept
BROADCAST = 1 << 19         # id pairs joined by broadcast: about 24 MB


# --- sparse matrices ---------------------------------------------------------

class Csr(NamedTuple):
    """A sparse matrix: row i holds columns indices[indptr[i]:indptr[i + 1]] with these values."""
    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int


def _from_rows(row: np.ndarray, column: np.ndarray, data: np.ndarray, shape: tuple[int, int]) -> Csr:
    """A matrix of entries that are sorted by row."""
    return Csr(np.searchsorted(row, np.arange(shape[0] + 1)), column, data, shape[1])


def _ones(n: int) -> np.ndarray:
    return np.ones(n, np.int64)


def incidence(lengths: np.ndarray) -> Csr:
    """Token x byte: tokens of these byte lengths, one after the other."""
    stops = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return Csr(stops, np.arange(stops[-1]), _ones(stops[-1]), int(stops[-1]))


def ends(lengths: np.ndarray) -> Csr:
    """Token x byte with the last byte of each token only; a token without bytes has none."""
    stops = np.cumsum(lengths).astype(np.int64)
    row = np.flatnonzero(np.asarray(lengths) > 0)
    return _from_rows(row, stops[row] - 1, _ones(len(row)), (len(lengths), int(stops[-1]) if len(stops) else 0))


def groups(lengths: np.ndarray, cuts: np.ndarray) -> Csr:
    """Token x group: the group of a token is the number of ``cuts`` (byte places) up to its first byte."""
    starts = np.cumsum(lengths) - lengths
    return Csr(np.arange(len(lengths) + 1), np.searchsorted(cuts, starts, "right"), _ones(len(lengths)), len(cuts))


def transpose(m: Csr) -> Csr:
    row = np.repeat(np.arange(len(m.indptr) - 1), np.diff(m.indptr))
    order = np.argsort(m.indices, kind="stable")
    return _from_rows(m.indices[order], row[order], m.data[order], (m.columns, len(m.indptr) - 1))


def product(a: Csr, b: Csr, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows first..last of A . B, row by row: (row, column, value) of the entries that are not zero.

    Each entry (i, k) of A adds its multiple of B's row k to the accumulator of row i.
    """
    last = len(a.indptr) - 1 if last is None else last
    low, high = int(a.indptr[first]), int(a.indptr[last])
    middle, scale = a.indices[low:high], a.data[low:high]
    row = np.repeat(np.arange(first, last), np.diff(a.indptr[first:last + 1]))
    size = b.indptr[middle + 1] - b.indptr[middle]
    stop = np.cumsum(size)
    at = np.arange(stop[-1] if len(stop) else 0) + np.repeat(b.indptr[middle] - (stop - size), size)
    key = np.repeat(row, size) * b.columns + b.indices[at]
    value = np.repeat(scale, size) * b.data[at]
    order = np.argsort(key, kind="stable")
    key, value = key[order], value[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    total = np.add.reduceat(value, head) if len(head) else value
    return key[head] // max(b.columns, 1), key[head] % max(b.columns, 1), total


def product_blocks(a: Csr, b: Csr, entries: int = PRODUCT_BYTES):
    """A . B in runs of rows that expand to about ``entries`` entries each; a wider row is a run of its own."""
    width = np.concatenate([[0], np.cumsum(b.indptr[a.indices + 1] - b.indptr[a.indices])])[a.indptr]
    first = 0
    while first < len(a.indptr) - 1:
        last = max(first + 1, int(np.searchsorted(width, width[first] + entries, "right")) - 1)
        yield product(a, b, first, last)
        first = last


def common_cuts(a_lengths: np.ndarray, b_lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token of A, token of B, byte place) of the pairs that end together."""
    left, right, _ = product(ends(a_lengths), transpose(ends(b_lengths)))
    return left, right, np.cumsum(a_lengths)[left]


# --- tokenizers --------------------------------------------------------------

# Fixed value: how byte-level vocabularies of this family split a text into words.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class _Tokens:
    """What both tokenizers share: the bytes of each id, their number, and ids as text with what follows them."""

    def _tables(self, bytes_of: dict[int, bytes]):
        many = max(bytes_of) + 1
        self.bytes_of = [bytes_of.get(i, b"") for i in range(many)]
        self.spelled = np.array(self.bytes_of, object)
        self.lengths = np.array([len(x) for x in self.bytes_of], np.int64)
        self.digits = np.array([len(str(i)) for i in range(many)], np.int64)
        self.shown = {end: np.array([b"%d%c" % (i, end) for i in range(many)], object) for end in b",|;"}


class ByteTokens(_Tokens):
    """A byte-level tokenizer of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        spec = json.loads(self.tokenizer.to_str())
        back = {chr(c): b for b, c in _STAND_INS.items()}
        own = {s: i for s, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        bytes_of = {i: bytes(back.get(c, ord(c) & 255) for c in s) for s, i in own.items()}
        before = spec["pre_tokenizer"] or {}
        # Nothing is changed before splitting, so visible characters and the white space after them part words.
        self.splits = (before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
                       and spec["normalizer"] is None and not spec["model"].get("dropout")
                       and all(t["special"] for t in spec["added_tokens"]))
        self.quick = self._ranked(spec["model"], own, bytes_of) if self.splits else None
        self._tables(bytes_of | {t["id"]: t["content"].encode() for t in spec["added_tokens"]})

    def _ranked(self, model: dict, own: dict[str, int], bytes_of: dict[int, bytes]):
        """The same vocabulary as ranks, which encodes words faster, if ids are in the order of merges and
        every token is what its own bytes merge to."""
        import tiktoken
        order = [own["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if order != list(range(order[0], order[0] + len(order))) or not all(len(self.tokenizer.model.tokenize(s)) == 1 for s in own):
            return None
        return tiktoken.Encoding("words", pat_str=SPLIT, mergeable_ranks={v: k for k, v in bytes_of.items()}, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_chunks(self, texts: list[str]) -> list[list[int]]:
        if self.quick is None:
            return self.encode(texts)
        # Beyond Latin letters the two libraries may class new characters differently.
        out = [self.quick.encode_ordinary(t) if t.isascii() or max(t) < "ɐ" else None for t in texts]
        others = iter(self.encode([t for t, ids in zip(texts, out) if ids is None]))
        return [next(others) if ids is None else ids for ids in out]


class PieceTokens(_Tokens):
    """A sentencepiece model. It puts a space before a text, so texts come with it and lose it here."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        as_byte = re.compile("<0x([0-9A-F]{2})>")
        self._tables({i: bytes([int(m[1], 16)]) if (m := as_byte.fullmatch(p)) else p.replace("▁", " ").encode()
                      for i, p in enumerate(pieces)})
        # A line end before a chunk takes the added space and merges with nothing: the chunk keeps its own.
        self.anchor = self.model.encode("\n")
        joined = b"".join(self.bytes_of[i] for i in self.model.encode(" a  b "))
        self.splits = (not any("\n" in p or re.search("[^▁]▁", p) for p in pieces) and joined == b"  a  b "
                       and [self.bytes_of[i] for i in self.anchor] == [b" ", b"\n"])
        self.stops = not any(re.search("[A-Za-zÀ-ÖØ-öø-ÿ][.,]", p) for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode([t[1:] for t in texts], num_threads=1)

    def encode_chunks(self, texts: list[str]) -> list[list[int]]:
        skip = len(self.anchor)
        return [ids[skip:] for ids in self.model.encode(["\n" + t for t in texts], num_threads=1)]


_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_ASCII = np.zeros(256, bool)
_ASCII[[*range(65, 91), *range(97, 123)]] = True
_STOP = np.zeros(256, bool)
_STOP[[44, 46]] = True
# UTF-8 bytes of white space outside ASCII and of U+2581. (lead, second, third or -1 if two bytes)
_RARE = [(0xC2, 0x85, -1), (0xC2, 0xA0, -1), (0xE1, 0x9A, 0x80), (0xE2, 0x80, 0xA8), (0xE2, 0x80, 0xA9),
         (0xE2, 0x80, 0xAF), (0xE2, 0x81, 0x9F), (0xE2, 0x96, 0x81), (0xE3, 0x80, 0x80),
         *[(0xE2, 0x80, c) for c in range(0x80, 0x8B)]]
_RARE_LEADS = np.zeros(256, bool)
_RARE_LEADS[[0xC2, 0xE1, 0xE2, 0xE3, *range(0x1C, 0x20)]] = True


def _unsure(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which rows hold white space that the chunk rule does not know."""
    found = []
    for place in np.flatnonzero(_RARE_LEADS[data]):
        one, two, three = [int(x) for x in data[place:place + 3]] + [-1] * max(0, place + 3 - len(data))
        if one < 0x20 or (one, two, -1) in _RARE or (one, two, three) in _RARE:
            found.append(place)
    marked = np.zeros(len(at) - 1, bool)
    marked[np.searchsorted(at, np.array(found, np.int64), "right") - 1] = True
    return marked


def _chunk_begins(data: np.ndarray, stops: bool) -> np.ndarray:
    """Where a chunk may begin: at a space or line end after a visible character, at a letter after a single
    line end, and (``stops``) at a full stop or comma after a letter."""
    begin = np.zeros(len(data), bool)
    blank = _BLANK[data]
    begin[1:] = ((data[1:] == 32) | (data[1:] == 10)) & ~blank[:-1]
    begin[2:] |= _ASCII[data[2:]] & (data[1:-1] == 10) & ~blank[:-2]
    if stops:
        letter = _ASCII[data]
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begin[1:] |= _STOP[data[1:]] & letter[:-1]
    return begin


class Alignments(NamedTuple):
    """Alignments of texts or chunks; pairs are a << 32 | b of tokens that end together."""
    counts: np.ndarray         # a row each: tokens of A, of B, pairs that end together, that overlap, that share a group
    pairs: np.ndarray          # of all texts, one after the other
    texts: list[bytes]         # the ids of all groups


def aligned(a_ids: list[list[int]], b_ids: list[list[int]], a: _Tokens, b: _Tokens) -> Alignments:
    """One block-diagonal product for all texts. Both sides must spell the same bytes."""
    x, y = (np.fromiter(itertools.chain.from_iterable(ids), np.int64) for ids in (a_ids, b_ids))
    x_at, y_at = (np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int64) for ids in (a_ids, b_ids))
    la, lb = a.lengths[x], b.lengths[y]
    overlap = product(incidence(la), transpose(incidence(lb)))[0]
    left, right, cuts = common_cuts(la, lb)
    x_of, y_of = groups(la, cuts).indices, groups(lb, cuts).indices
    per_group = np.bincount(x_of, minlength=len(cuts)) * np.bincount(y_of, minlength=len(cuts))
    low = np.searchsorted(left, x_at)
    counts = np.stack([np.diff(x_at), np.diff(y_at), np.diff(low), np.diff(np.searchsorted(overlap, x_at)),
                       np.diff(np.concatenate([[0], np.cumsum(per_group)])[low])], 1)
    # Ids in the order of groups, those of A first, each with the sign that follows it.
    parts = np.concatenate([a.shown[ord(",")][x], b.shown[ord(",")][y]])
    parts[left], parts[len(x) + right] = a.shown[ord("|")][x[left]], b.shown[ord(";")][y[right]]
    order = np.lexsort((np.repeat([0, 1], [len(x), len(y)]), np.concatenate([x_of, y_of])))
    size = np.concatenate([a.digits[x], b.digits[y]])[order] + 1
    stop = np.concatenate([[0], np.cumsum(size)])[x_at + y_at].tolist()
    text = b"".join(parts[order].tolist())
    return Alignments(counts, x[left] << 32 | y[right], [text[p:max(p, q - 1)] for p, q in zip(stop[:-1], stop[1:])])


class Aligner:
    """Alignments of texts under two tokenizers, with a store of chunks."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteTokens(a_path), PieceTokens(b_path)
        self.splits = bool(self.a.splits and self.b.splits)
        self._clear()

    def _clear(self):
        """Entry 0 of the store stands for a chunk that is not spelled by its tokens."""
        self.known: dict[int, int] = {}
        self.texts: list[bytes] = [b""]
        self.counts, self.begin = np.zeros((1 << 12, 5), np.int32), np.zeros(1 << 12, np.int64)
        self.pairs, self.used = np.zeros(1 << 12, np.int64), 0

    def _put(self, texts: list[str], whole: bool) -> np.ndarray:
        """Entries of texts that begin with their space; 0 if token bytes do not spell the text."""
        if whole:
            a_ids, b_ids = self.a.encode(texts), self.b.encode(texts)
        else:
            a_ids, b_ids = self.a.encode_chunks(texts), self.b.encode_chunks(texts)
        spell = lambda side, ids: b"".join([side.bytes_of[i] for i in ids])
        good = np.array([spell(self.a, x) == t.encode() == spell(self.b, y) for t, x, y in zip(texts, a_ids, b_ids)])
        made = aligned([x for x, g in zip(a_ids, good) if g], [y for y, g in zip(b_ids, good) if g], self.a, self.b)
        first, many = len(self.texts), len(made.texts)
        self.counts, self.begin = _room(self.counts, first + many), _room(self.begin, first + many)
        self.pairs = _room(self.pairs, self.used + len(made.pairs))
        self.counts[first:first + many] = made.counts
        self.begin[first:first + many] = self.used + np.cumsum(made.counts[:, 2]) - made.counts[:, 2]
        self.pairs[self.used:self.used + len(made.pairs)] = made.pairs
        self.used += len(made.pairs)
        self.texts += made.texts
        return np.where(good, first + np.cumsum(good) - 1, 0)

    def tokens(self, text: str | None) -> tuple[list[int], list[int]]:
        """Ids of one whole text under A and B; none if either does not spell it."""
        if not text:
            return [], []
        a, b = self.a.encode([" " + text])[0], self.b.encode([" " + text])[0]
        spelled = [b"".join(side.bytes_of[i] for i in ids) for side, ids in ((self.a, a), (self.b, b))]
        return (a, b) if spelled == [(" " + text).encode()] * 2 else ([], [])

    def rows(self, data: np.ndarray, at: np.ndarray) -> Alignments:
        """The rows' alignments. A row without tokens has zeros; ``pairs`` of a row are in text order."""
        if len(self.texts) > CACHE:
            self._clear()
        sizes = np.diff(at)
        spaced = np.insert(data[at[0]:at[-1]], at[:-1] - at[0], 32)
        rows = at - at[0] + np.arange(len(at))
        whole = (sizes > 0) & (_unsure(spaced, rows) if self.splits else True)
        entry, row = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if self.splits:
            begin = _chunk_begins(spaced, self.b.stops)
            begin[rows[:-1]] = True
            every = np.flatnonzero(begin)
            stops = np.append(every[1:], len(spaced))
            row = np.searchsorted(rows, every, "right") - 1
            kept = (sizes[row] > 0) & ~whole[row]
            row = row[kept]
            entry = self._chunks(spaced, every[kept], stops[kept])
            whole[row[entry == 0]] = True
            entry, row = entry[~whole[row]], row[~whole[row]]
        other = np.flatnonzero(whole)
        one = [int(self._put([bytes(spaced[rows[r]:rows[r + 1]]).decode()], True)[0]) for r in other]
        entry, row = np.concatenate([entry, np.array(one, np.int64)]), np.concatenate([row, other])
        order = np.argsort(row, kind="stable")
        entry, row = entry[order], row[order]
        low = np.searchsorted(row, np.arange(len(sizes) + 1))
        counts = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.counts[entry], 0, dtype=np.int64)])
        size = self.counts[entry, 2].astype(np.int64)
        stop = np.cumsum(size)
        pairs = self.pairs[np.arange(stop[-1] if len(stop) else 0) + np.repeat(self.begin[entry] - (stop - size), size)]
        texts, numbers, places = self.texts, entry.tolist(), low.tolist()
        return Alignments(np.diff(counts[low], axis=0), pairs,
                          [b";".join([texts[n] for n in numbers[p:q]]) for p, q in zip(places[:-1], places[1:])])

    def _chunks(self, data: np.ndarray, begins: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The entries of chunks; long ones are not found again."""
        hashed = words.hashes(data, begins, stops, lower=False)
        distinct, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
        keys, known = distinct.tolist(), self.known
        entry = np.array([known.get(k, -1) for k in keys], np.int64)
        missing = np.flatnonzero(entry < 0)
        size = (stops - begins)[first[missing]]
        for low, high in words.slices(np.concatenate([[0], np.cumsum(size)]), PRODUCT_BYTES):
            part = missing[low:high]
            texts = [bytes(data[b:e]).decode() for b, e in zip(begins[first[part]].tolist(), stops[first[part]].tolist())]
            entry[part] = self._put(texts, False)
        short = missing[size <= CACHE_BYTES]
        known.update(zip(distinct[short].tolist(), entry[short].tolist()))
        return entry[inverse]


def _room(array: np.ndarray, need: int) -> np.ndarray:
    if need <= len(array):
        return array
    return np.concatenate([array, np.zeros((max(need, 2 * len(array)) - len(array), *array.shape[1:]), array.dtype)])


_aligners: dict[tuple[str, str], Aligner] = {}


def _aligner(a: str, b: str) -> Aligner:
    if (a, b) not in _aligners:
        _aligners[a, b] = Aligner(a, b)
    return _aligners[a, b]


def _summed(pairs: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs of each row, how often, where rows begin) of rows that hold ``sizes`` pairs each."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((pairs, row))
    row, pairs = row[order], pairs[order]
    head = np.flatnonzero(np.concatenate([[True], (pairs[1:] != pairs[:-1]) | (row[1:] != row[:-1])])) if len(row) else row
    return pairs[head], np.diff(np.append(head, len(row))), np.searchsorted(row[head], np.arange(len(sizes) + 1))


# --- Spark -------------------------------------------------------------------

_COUNTS = ["n_a", "n_b", "n_groups", "n_links", "n_overlaps", "n_shared"]


def align(docs: DataFrame, a: str, b: str) -> DataFrame:
    """One row per document, with its links summed by id pair.

    (row, doc_id, n_a, n_b, n_groups, n_links, n_overlaps, n_shared,
    groups_sha256, pairs, times): ``n_overlaps`` counts pairs that share bytes,
    ``n_shared`` those that share a group, ``pairs`` are the distinct
    ``a_id << 32 | b_id`` that end together and ``times`` how often they do.
    ``a``, ``b``: tokenizer files, at the same place on every machine.
    """
    def run(batches):
        aligner = _aligner(a, b)
        for batch in batches:
            data, at = words.buffers(batch.column("text"))
            for low, high in words.slices(at, SLICE_BYTES):
                made = aligner.rows(data, at[low:high + 1])
                tokens, others, ends_, overlaps, shared = made.counts.T
                shas = [hashlib.sha256(t).hexdigest() if t else "" for t in made.texts]
                pairs, times, begin = _summed(made.pairs, ends_)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(low, high - low) for c in ("row", "doc_id")]
                    + [pa.array(c) for c in (tokens, others, ends_, ends_, overlaps, shared)] + [pa.array(shas, pa.string())]
                    + [pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(c)) for c in (pairs, times)], names=names)

    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    fields = [*source.schema.fields[:2], *[T.StructField(n, T.LongType()) for n in _COUNTS],
              T.StructField("groups_sha256", T.StringType()),
              *[T.StructField(n, T.ArrayType(T.LongType())) for n in ("pairs", "times")]]
    names = [f.name for f in fields]
    return source.mapInArrow(run, T.StructType(fields))


def links(docs: DataFrame, a: str, b: str, kind: str = "overlap") -> DataFrame:
    """(doc_id, a_index, b_index, a_id, b_id, weight): the links of every document.

    ``kind``: ``overlap`` (weight: bytes shared), ``group`` (tokens of one
    group) or ``end`` (tokens that end together). A product is emitted in blocks
    of rows, so a large group is never held whole.
    """
    def run(batches):
        aligner = _aligner(a, b)
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                x, y = (np.array(ids, np.int64) for ids in aligner.tokens(text))
                if not len(x):
                    continue
                la, lb = aligner.a.lengths[x], aligner.b.lengths[y]
                cuts = common_cuts(la, lb)[2]
                left, right = {"overlap": lambda: (incidence(la), incidence(lb)), "end": lambda: (ends(la), ends(lb)),
                               "group": lambda: (groups(la, cuts), groups(lb, cuts))}[kind]()
                for i, j, weight in product_blocks(left, transpose(right)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc] * len(i), batch.schema.field("doc_id").type),
                         *[pa.array(c) for c in (i, j, x[i], y[j], weight)]], names=names)

    source = docs.select("doc_id", "text")
    names = ["doc_id", "a_index", "b_index", "a_id", "b_id", "weight"]
    schema = T.StructType([source.schema[0], *[T.StructField(n, T.LongType()) for n in names[1:]]])
    return source.mapInArrow(run, schema)


def pair_counts(made: DataFrame) -> DataFrame:
    """(pair, count, docs, best): links of each id pair over all documents; ``best`` marks a B id's highest count."""
    each = made.select(F.inline(F.arrays_zip("pairs", "times")))
    counts = materialize(each.groupBy(F.col("pairs").alias("pair")).agg(
        F.sum("times").alias("count"), F.count("*").alias("docs")), "pair-counts")
    b = F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))
    top = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    return materialize(counts.join(top, b == top["b"]).select(
        "pair", "count", "docs", (F.col("count") == F.col("highest")).alias("best")), "pairs")


def rate(made: DataFrame, pairs: DataFrame, hottest: int = BROADCAST) -> DataFrame:
    """(row, n_best, count_sum) of each document with links.

    The ``hottest`` pairs, those of most documents, are broadcast, so no pair of
    many documents is shuffled; the rest, if any, are joined by shuffle.
    """
    each = made.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    known = pairs.select("pair", "count", "best")
    if pairs.count() <= hottest:
        found = each.join(F.broadcast(known), "pair")
    else:
        hot = materialize(pairs.orderBy(F.desc("docs"), "pair").limit(hottest).select("pair", "count", "best"), "hot-pairs")
        marked = each.join(F.broadcast(hot), "pair", "left")
        cold = known.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
        found = marked.filter("count is not null").unionByName(
            marked.filter("count is null").drop("count", "best").join(cold, "pair"))
    return found.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                    F.sum(F.col("times") * F.col("count")).alias("count_sum"))


def op12_token_alignment(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read(spark, sf_dir, "documents")
    made = materialize(align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")), "aligned")
    rated = rate(made, pair_counts(made))
    return made.drop("pairs", "times").join(rated, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).cast("long").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("long").alias("count_sum"), "groups_sha256", "n_overlaps", "n_shared")
