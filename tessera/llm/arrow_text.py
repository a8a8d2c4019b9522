"""Words and n-grams of Arrow text columns as numpy arrays.

Tasks that need Python read their text column as Arrow batches and work on the
UTF-8 buffer itself: no Python object per word.  ``slices`` bounds the memory:
a slice holds about ``max_bytes`` of text (one longer text makes a slice of its
own), so a task's memory does not depend on the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
#: Fixed odd multipliers of the hashes (golden ratio; splitmix64 finaliser).
_P = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P_INV = pow(_P, -1, 1 << 64)


def bounded_batches(spark, rows: int = 1024) -> None:
    """Let the session's Arrow batches hold at most ``rows`` rows: a batch of
    whole texts lies in the memory of the executor and of its Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


class TextSlice:
    """Some rows of a batch: ``rows`` (start, stop), the texts' bytes back to
    back, and where each text starts (one more entry than texts)."""

    def __init__(self, batch: pa.RecordBatch, start: int, stop: int, data: np.ndarray, offsets: np.ndarray):
        self.batch, self.start, self.stop = batch, start, stop
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return self.stop - self.start

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name)).slice(self.start, len(self))

    def texts(self) -> list[str]:
        raw = self.data.tobytes()
        ends = self.offsets.tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


def slices(batches: Iterable[pa.RecordBatch], text_col: str = "text",
           max_bytes: int = SLICE_BYTES) -> Iterator[TextSlice]:
    """The batches' rows in order; null texts are empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(text_col))
        col = pc.fill_null(col.cast(pa.large_string()), "")
        offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
        data = np.frombuffer(col.buffers()[2] or b"", np.uint8)
        start = 0
        while start < len(col):
            stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
            stop = min(max(stop, start + 1), len(col))
            a, b = int(offsets[start]), int(offsets[stop])
            yield TextSlice(batch, start, stop, data[a:b], offsets[start:stop + 1] - a)
            start = stop


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Spans:
    """Runs of bytes of the same class in a slice.

    ``classes`` maps a byte to its class; class 0 separates.  A run ends where
    the class changes or the text ends.  ``first`` has the index of each text's
    first run (one more entry than texts)."""

    _cache: dict = {}

    def __init__(self, part: TextSlice, classes: np.ndarray):
        data, offsets = part.data, part.offsets
        kind = classes[data]
        edge = np.empty(len(data) + 1, bool)
        edge[0] = edge[-1] = True
        np.not_equal(kind[1:], kind[:-1], out=edge[1:-1])
        edge[offsets] = True
        at = np.flatnonzero(edge)
        starts, ends = at[:-1], at[1:]
        full = kind[starts] != 0 if len(starts) else np.zeros(0, bool)
        self.starts, self.ends = starts[full], ends[full]
        self.first = np.searchsorted(self.starts, offsets)
        self.data = data

    def __len__(self) -> int:
        return len(self.starts)

    def per_text(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, table: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of each run's bytes (taken through ``table`` if given):
        a polynomial from prefix sums, moved to the run's start, then mixed
        with the run's length."""
        data = self.data if table is None else table[self.data]
        n = len(data) + 1
        if Spans._cache.get("n", 0) < n:
            Spans._cache.update(n=n, up=_powers(_P, n), down=_powers(_P_INV, n))
        up, down = Spans._cache["up"], Spans._cache["down"]
        sums = np.zeros(n, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n - 1], out=sums[1:])
        own = (sums[self.ends] - sums[self.starts]) * down[self.starts]
        if n > 1 << 23:  # a very long text: do not hold its powers
            Spans._cache.clear()
        return mix64(own + (self.ends - self.starts).astype(np.uint64) * np.uint64(_P))


def byte_classes(**groups: str) -> np.ndarray:
    """A class table: every byte 1, those listed under ``c<k>`` k."""
    out = np.ones(256, np.uint8)
    for name, members in groups.items():
        out[list(members.encode("ascii"))] = int(name[1:])
    return out


#: Words: everything but ASCII white space.
WORDS = byte_classes(c0=" \t\n\x0b\f\r")
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
