"""Words of whole texts as Arrow arrays: maximal runs of anything but ASCII white space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text and rows that one group of rows holds (a longer text is a group of its own).
GROUP_BYTES, GROUP_ROWS = 1 << 21, 1 << 10


def row_groups(texts: pa.Array, size: int = GROUP_BYTES) -> Iterator[slice]:
    """Ranges of rows whose texts come to about ``size`` bytes, not too many rows in one."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(lengths) // size
    cuts = np.flatnonzero((np.diff(group) > 0) | (np.arange(1, len(group)) % GROUP_ROWS == 0)) + 1
    for start, stop in zip([0, *cuts.tolist()], [*cuts.tolist(), len(lengths)]):
        if stop > start:
            yield slice(start, stop)


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of ``texts`` (a null text has none) and the offsets of each text's words."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    real = pc.not_equal(pc.binary_length(words), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return words.filter(real), before[offsets]
