"""Shared kernels over Arrow text columns, and plumbing between kernels and DataFrames.

Words are split at ASCII white space (space and bytes 9 to 13) and hashed from
the UTF-8 bytes in place, without building Python strings. Kernels take slices
of a record batch that hold at most ``SLICE`` bytes of text (or one document),
so memory follows the longest document and not the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

SLICE = 1 << 20

#: Bytes that separate words.
SPACES = (9, 10, 11, 12, 13, 32)

WORD = "[^\\x20\\x09-\\x0D]+"


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Hasher:
    """64-bit polynomial hashes of byte ranges; ``lane`` picks one of several independent functions.

    ``table`` maps each byte to the byte that is hashed (for lower-casing).
    """

    def __init__(self, lane: int = 0, table: np.ndarray | None = None):
        rng = np.random.default_rng(7919 + lane)
        values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.values = values if table is None else values[table]
        self.base = int(rng.integers(1, 1 << 61)) * 4 + 3
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            size = max(n, 2 * len(self.powers), 1024)
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                table = np.full(size, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):  # in blocks of about a megabyte, cut between words
            first = int(starts[at])
            to = max(at + 1, int(np.searchsorted(ends, first + SLICE, "right")))
            block = data[first : int(ends[to - 1])]
            self._grow(len(block) + 1)
            sums = np.zeros(len(block) + 1, np.uint64)
            np.cumsum(self.values[block] * self.powers[: len(block)], out=sums[1:])
            s, e = starts[at:to] - first, ends[at:to] - first
            out[at:to] = mix((sums[e] - sums[s]) * self.inverses[s] + (e - s).astype(np.uint64))
            at = to
        return out


def separator_table(separators=SPACES) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(separators)] = True
    return table


def find_words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the index of the first word of every document (one more at the end)."""
    inside = ~separators[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[firsts] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    after[firsts] = False
    ends = np.flatnonzero(inside & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def text_of(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return pc.fill_null(column, "") if column.null_count else column


def slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with the bytes of their texts and the offset of each text (one more at the end)."""
    if batch.num_rows == 0:
        return
    column = text_of(batch, name)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield batch.slice(at, to - at), whole[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def rolling(words: np.ndarray, size: int, factor: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes; windows are not kept apart by document."""
    n = max(0, len(words) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total *= np.uint64(factor)
        total += words[k : k + n]
    return mix(total)


def window_starts(firsts: np.ndarray, size: int) -> np.ndarray:
    """Indices of the words that start a window lying in one document."""
    counts = np.maximum(np.diff(firsts) - size + 1, 0)
    total = int(counts.sum())
    before = np.concatenate(([0], np.cumsum(counts)[:-1]))
    return np.arange(total) + np.repeat(firsts[:-1] - before, counts)


def cover(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Mask of the ``n`` words that windows of ``size`` words beginning at ``starts`` cover."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, np.minimum(starts + size, n), -1)
    return np.cumsum(steps[:-1]) > 0


def append(docs: DataFrame, fields: str, kernel: Callable[[], Callable]) -> DataFrame:
    """``docs`` with further columns that a kernel computes from ``text``.

    ``fields`` is a DDL list of the new columns; an input column of the same name
    is replaced. ``kernel()`` is called once a task and returns a function
    ``(bytes, offsets) -> tuple of Arrow arrays``. Map-only.
    """
    added = _parse_datatype_string(fields)
    kept = [f for f in docs.schema.fields if f.name not in added.names]
    names = [f.name for f in kept]
    schema = StructType([*kept, *(StructField(f.name, f.dataType, True) for f in added)])
    columns = schema.names
    source = docs.select(*[F.col(f"`{c}`") for c in names], *([] if "text" in names else [F.col("text").alias("_text")]))
    text = "text" if "text" in names else "_text"

    def run(batches):
        compute = kernel()
        for batch in batches:
            for part, data, offsets in slices(batch, text):
                own = [part.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*own, *compute(data, offsets)], names=columns)

    return source.mapInArrow(run, schema)


def column_or_null(df: DataFrame, name: str, kind: str) -> Column:
    """The column cast to ``kind``, or null where the table has none."""
    return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)


def held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from: CRC-32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
