"""Texts as the parts between their separators, each distinct part of a batch looked at once.

Splitting, finding the distinct parts and putting their token ids side by side are Arrow
kernels; Python sees only the distinct parts of a batch, and of those the tokenizer only the
ones that a bounded table doesn't hold.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked at together.
TOGETHER = 4 << 20
def pieces_of(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have up to TOGETHER bytes, one row at least."""
    ends = np.asarray(batch.column(column).offsets) if hasattr(batch.column(column), "offsets") else np.frombuffer(batch.column(column).buffers()[1], np.int32)[batch.column(column).offset :][: batch.num_rows + 1]
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + TOGETHER, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


class Table:
    """What ``learn`` gives for each distinct part (None becomes null), with what it gave lately kept.

    Beyond ``limit`` bytes only the parts of the last batch stay.
    """

    def __init__(self, learn: Callable[[list[str]], list[bytes | None]], limit: int = 16 << 20):
        self.learn, self.limit = learn, limit
        self.parts, self.ids = pa.array([], pa.string()), pa.array([], pa.large_binary())

    def look_up(self, parts: pa.StringArray) -> pa.LargeBinaryArray:
        """The entries of distinct parts."""
        at = pc.index_in(parts, value_set=self.parts)
        new = parts.filter(at.is_null())
        found = pa.concat_arrays([self.ids, pa.array(self.learn(new.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())])
        rows = at.to_numpy(zero_copy_only=False)
        unknown = np.isnan(rows) if rows.dtype.kind == "f" else np.zeros(len(rows), bool)
        rows = np.where(unknown, len(self.ids) + np.cumsum(unknown) - 1, rows).astype(np.int64)
        ids = found.take(pa.array(rows))
        if self.parts.nbytes + found.nbytes + new.nbytes > self.limit:
            self.parts, self.ids = parts, ids
        else:
            self.parts, self.ids = pa.concat_arrays([self.parts, new]), found
        return ids


def side_by_side(ids: pa.LargeBinaryArray, codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of ``ids`` that ``codes`` name, one after another as 32-bit integers, and where each text ends.

    ``ends`` counts codes: text i has those from ends[i] to ends[i + 1].
    """
    found = ids.take(pa.array(codes))
    offsets = np.frombuffer(found.buffers()[1], np.int64)[: len(codes) + 1]
    data = found.buffers()[2]
    flat = np.frombuffer(data, "<u4", int(offsets[-1]) // 4) if data else np.zeros(0, "<u4")
    return flat, offsets[ends] // 4
