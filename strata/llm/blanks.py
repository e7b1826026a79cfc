"""Words between ASCII white space, as they are (case and signs kept), over Arrow text, and exact codes for them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Blank and the controls from tab to carriage return separate words.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of documents offsets[d]:offsets[d + 1], and ``first``: document d
    has words first[d]:first[d + 1]. Words never span two documents."""
    n = len(data)
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    is_word = ~_BLANK[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    starts, ends = is_word.copy(), is_word.copy()
    starts[1:] &= ~is_word[:-1] | edge[1:-1]
    ends[:-1] &= ~is_word[1:] | edge[1:-1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets).astype(np.int64)


def codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """An integer per word, equal for equal words only, and the words by that integer."""
    letters = data[~_BLANK[data]] if len(starts) else data[:0]
    bounds = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(letters)))
    known = words.dictionary_encode()
    return known.indices.to_numpy(zero_copy_only=False).astype(np.int64), known.dictionary
