"""Document and word counts of many articles as arrays: a batch of word lists is counted at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_WORDS = 1 << 20       # words counted at once; a longer article is a slice of its own
COUNTS = "keyword string, df long, n long"


def counts(batches):
    """(keyword, df, n) of slices of rows with a list of ``words``: rows that hold a word, and how often they do.

    A null list is empty, a null word no word.
    """
    for batch in batches:
        column = batch.column("words")
        words = column.flatten()
        sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        low = 0
        while low < len(column):
            high = max(low + 1, int(np.searchsorted(at, at[low] + SLICE_WORDS, "right")) - 1)
            part = words.slice(at[low], at[high] - at[low])
            row = np.repeat(np.arange(high - low), sizes[low:high])
            low = high
            if part.null_count:
                row, part = row[part.is_valid().to_numpy(zero_copy_only=False)], part.drop_null()
            if not len(part):
                continue
            coded = part.dictionary_encode()
            code, base = coded.indices.to_numpy(), len(coded.dictionary)
            held = np.unique(row * base + code) % base
            yield pa.RecordBatch.from_arrays(
                [coded.dictionary, pa.array(np.bincount(held, minlength=base)), pa.array(np.bincount(code, minlength=base))],
                names=["keyword", "df", "n"])
