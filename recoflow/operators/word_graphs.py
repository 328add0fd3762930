"""Word graphs of many articles as arrays: a batch of rows is numbered, linked and ranked at once.

The words of a slice of rows lie in one array. A node is a term of a row, an edge
an entry of a node's neighbour list: two candidates of a row that are close, once
per occurrence and in text order. All sums run in that order, so they are the
same for any split into batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_WORDS = 1 << 18       # words linked at once; a longer article is a slice of its own


class Graph:
    """Rows ``low`` to ``high`` of a batch: nodes in order of row and term, edges ``source`` -> ``near`` in text order."""

    def __init__(self, low: int, high: int, words: pa.Array, at: np.ndarray, window: int):
        self.low, self.high, rows = low, high, high - low
        coded = words.dictionary_encode()
        by_term = pc.sort_indices(coded.dictionary).to_numpy()
        place = np.empty(len(by_term), np.int64)
        place[by_term] = np.arange(len(by_term))
        self._terms = coded.dictionary.take(pa.array(by_term))
        code = place[coded.indices.to_numpy()]
        row = np.repeat(np.arange(rows), np.diff(at))
        spots = np.flatnonzero(pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[coded.indices.to_numpy()])
        base = max(len(by_term), 1)
        nodes, number = np.unique(row[spots] * base + code[spots], return_inverse=True)
        self._code, self.size = nodes % base, len(nodes)
        self.first = np.searchsorted(nodes // base, np.arange(rows + 1))
        around = np.array([d for d in range(1 - window, window) if d])
        node = np.full(len(row) + 2 * window, -1)       # room at both ends for places outside
        node[window + spots] = number
        owner = np.full(len(node), -1)
        owner[window:window + len(row)] = row
        place = window + spots[:, None] + around
        from_, which = np.nonzero((node[place] >= 0) & (owner[place] == row[spots][:, None]))
        self.source, self.near = number[from_], node[place[from_, which]]
        self.degree = np.bincount(self.source, minlength=self.size)

    def terms(self, nodes: np.ndarray) -> pa.Array:
        return self._terms.take(pa.array(self._code[nodes]))

    def ranks(self, iters: int, damping: float) -> np.ndarray:
        """The damped rank of each node; one without neighbours has none (nan)."""
        some = np.concatenate([[0], np.cumsum(self.degree > 0)])[self.first]
        linked = np.repeat(np.diff(some), np.diff(self.first))
        weight = np.where(self.degree > 0, self.degree, np.nan)
        state = 1.0 / (linked * weight)                 # rank / weight, which is what neighbours read
        for _ in range(iters):
            pull = np.bincount(self.source, state[self.near], self.size)
            state = ((1 - damping) + damping * pull) / weight
        return weight * state


def graphs(column: pa.Array, window: int) -> Iterator[Graph]:
    """Graphs of slices of a column of word lists, in which the empty word is no candidate; null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    words = column.flatten()
    at = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(at, at[low] + SLICE_WORDS, "right")) - 1)
        yield Graph(low, high, words.slice(at[low], at[high] - at[low]), at[low:high + 1] - at[low], window)
        low = high


def _lists(first: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)


def node_lists(window: int):
    """Rows with ``nodes`` (i, term, nbrs) in place of ``words``; nodes are numbered from 1 in their row."""
    def run(batches):
        for batch in batches:
            for g in graphs(batch.column("words"), window):
                start = np.repeat(g.first[:-1], np.diff(g.first))
                order = np.argsort(g.source, kind="stable")
                near = (g.near - start[g.source] + 1)[order]
                every = np.arange(g.size)
                nodes = pa.StructArray.from_arrays(
                    [pa.array(every - start + 1, pa.int32()), g.terms(every),
                     _lists(np.concatenate([[0], np.cumsum(g.degree)]), pa.array(near, pa.int32()))], ["i", "term", "nbrs"])
                part = batch.slice(g.low, g.high - g.low)
                yield pa.RecordBatch.from_arrays(
                    [part.column("article_id"), part.column("channel_id"), _lists(g.first, nodes)],
                    names=["article_id", "channel_id", "nodes"])
    return run


def best_ranked(window: int, k: int, iters: int, damping: float, places: int):
    """Rows with the lowest and highest rank, and ``found`` (term, r): the terms that may be among the k best
    once scaled ranks are rounded to ``places``."""
    def run(batches):
        for batch in batches:
            for g in graphs(batch.column("words"), window):
                r = g.ranks(iters, damping)
                nodes = np.flatnonzero(~np.isnan(r))
                r, first = r[nodes], np.searchsorted(nodes, g.first)
                low, high = np.full(len(first) - 1, np.nan), np.full(len(first) - 1, np.nan)
                full = np.flatnonzero(np.diff(first))
                if len(full):
                    low[full], high[full] = np.minimum.reduceat(r, first[full]), np.maximum.reduceat(r, first[full])
                row = np.repeat(np.arange(len(low)), np.diff(first))
                with np.errstate(divide="ignore", invalid="ignore"):
                    scaled = (r - low[row] / 10) / (high[row] - low[row] / 10)
                order = np.lexsort((-scaled, row))
                least = np.full(len(low), -np.inf)
                more = np.flatnonzero(np.diff(first) > k)
                least[more] = scaled[order[first[more] + k - 1]] - 2 * 10.0 ** -places
                keep = np.flatnonzero(~(scaled < least[row]))
                found = pa.StructArray.from_arrays([g.terms(nodes[keep]), pa.array(r[keep])], ["term", "r"])
                part = batch.slice(g.low, g.high - g.low)
                yield pa.RecordBatch.from_arrays(
                    [part.column("article_id"), part.column("channel_id"), pa.array(low), pa.array(high),
                     _lists(np.searchsorted(keep, first), found)],
                    names=["article_id", "channel_id", "low", "high", "found"])
    return run
