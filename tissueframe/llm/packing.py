"""Packing of tokenized documents into sequences by the harmonic rule.

A piece of length ``x`` belongs to class ``j`` where ``capacity/(j+1) < x <=
capacity/j``, and a bin of class ``j`` takes ``j`` pieces and is full. Classes
fill their bins without knowing of each other, and every task fills its own, so
packing needs no shuffle and no state but one open bin a class.

Documents are cut so that bins waste little: whole sequences first, then parts
of half, a quarter ... of the capacity while the rest is at least ``tail``
tokens, then the rest as it is. Power-of-two pieces fill their bins exactly; a
bin of rests of about one length wastes less than one rest. At the end of a
task the pieces in its open bins (less than one bin a class, a fixed bound) are
laid end to end, cut into full sequences, and what is left into sequences whose
lengths are powers of two, which need no padding.

Token ids come from a ``tokenizers`` file. Chunks of a text that single spaces part
are tokenized apart and remembered: byte-level pieces never reach over the
space in front of a word, so ids are those of the whole text; a text with white space
side by side is tokenized as it is.

Defined cases: a null or empty text is the single end id; equal rows are packed
separately; a null ``doc_id`` stays null; ids in order of ``start`` give back the
document. Sequence ids are unique and stable for the same input partitions.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.llm.textops import slices

CAPACITY = 1024
TAIL = 64
END_ID = 0
#: Remembered chunks of a worker; beyond it memory is freed and filled anew.
REMEMBERED = 400_000

#: New chunks that are tokenized in one go.
JOINED = 2000

_BESIDE = re.compile(r"\s\s")


def _plain(text: str) -> bool:
    """No white space side by side, so that single spaces part the text into chunks that tokenize alone."""
    if text.isascii() and not any(c in text for c in "\t\r\v\f\x1c\x1d\x1e\x1f"):
        return not ("  " in text or "\n\n" in text or " \n" in text or "\n " in text)
    return not _BESIDE.search(text)


class ChunkEncoder:
    """Little-endian unsigned 32-bit ids of texts, with remembered chunks."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Tokens that are found in a text before it is cut anywhere; texts that hold one are taken whole.
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        # Ids of a space with a word behind it, by word.
        self.remembered, self.known = remembered, {}
        # Tokens that begin with a space, which byte-level files write as the letter below.
        self.spaced = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.spaced[[i for token, i in self.tokenizer.get_vocab().items() if token.startswith("\u0120")]] = True

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _behind_space(self, words: list[str]) -> list[bytes]:
        """Ids of words with a space before each: tokenized in one go and cut where a token begins with a space."""
        raw = self._whole([" " + " ".join(words)])[0]
        heads = np.flatnonzero(self.spaced[np.frombuffer(raw, "<u4")])
        if len(heads) != len(words):
            return self._whole([" " + w for w in words])
        edges = [*(4 * heads).tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(edges, edges[1:])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > self.remembered:
            known.clear()
        cut = [text.split(" ") if _plain(text) and not any(a in text for a in self.added) else None for text in texts]
        fresh: set[str] = set()
        for chunks in cut:
            if chunks:
                fresh.update(chunks)
        fresh -= known.keys()
        if "" in fresh:  # a text that ends with a space
            fresh.remove("")
            known[""] = self._whole([" "])[0]
        missing = list(fresh)
        for at in range(0, len(missing), JOINED):
            part = missing[at : at + JOINED]
            known.update(zip(part, self._behind_space(part)))
        # The first chunk has no space before it, and texts with white space side by side are taken whole.
        heads = iter(self._whole([text if chunks is None else chunks[0] for text, chunks in zip(texts, cut)]))
        return [next(heads) + (b"".join(map(known.__getitem__, chunks[1:])) if chunks else b"") for chunks in cut]


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this worker process; later tasks of the process find its memory filled."""
    store = sys.modules.setdefault("_tissueframe_encoders", types.ModuleType("_tissueframe_encoders")).__dict__
    if path not in store:
        store[path] = ChunkEncoder(path)
    return store[path]


def cut_lengths(n: int, capacity: int = CAPACITY, tail: int = TAIL) -> list[int]:
    """Lengths into which ``n`` ids are cut, in order."""
    out = [capacity] * (n // capacity)
    rest, part = n % capacity, capacity // 2
    while rest >= tail and part:
        if part <= rest:
            out.append(part)
            rest -= part
        part //= 2
    return out + [rest] if rest else out


class Packer:
    """Bins of one task. A piece is ``(document, start, ids as bytes, ids of the document)``.

    ``add`` and ``close`` return whole sequences as ``(sequence, pieces)``. Open bins hold
    less than ``capacity`` ids a class, whatever the documents.
    """

    def __init__(self, first_sequence: int, capacity: int = CAPACITY):
        self.capacity, self.next, self.open = capacity, first_sequence, {}

    def _full(self, pieces: list[tuple]) -> list[tuple[int, list[tuple]]]:
        self.next += 1
        return [(self.next - 1, pieces)]

    def add(self, piece: tuple) -> list[tuple[int, list[tuple]]]:
        kind = self.capacity // (len(piece[2]) // 4)
        pieces = self.open.setdefault(kind, [])
        pieces.append(piece)
        return self._full(self.open.pop(kind)) if len(pieces) == kind else []

    def close(self) -> list[tuple[int, list[tuple]]]:
        rest = [piece for _, pieces in sorted(self.open.items()) for piece in pieces]
        self.open = {}
        total, out, bin_, room = sum(len(p[2]) // 4 for p in rest), [], [], 0
        for doc, start, raw, count in rest:
            while raw:
                if not room:
                    if bin_:
                        out += self._full(bin_)
                    # Full sequences, then falling powers of two.
                    bin_, room = [], self.capacity if total >= self.capacity else 1 << (total.bit_length() - 1)
                    total -= room
                used = min(room, len(raw) // 4)
                bin_.append((doc, start, raw[: 4 * used], count))
                room, start, raw = room - used, start + used, raw[4 * used :]
        return out + self._full(bin_) if bin_ else out


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, tail: int = TAIL, ids: bool = False) -> DataFrame:
    """One row per piece; with ``ids`` also the piece's token ids as ``array<int>``.

    ``start`` counts the document's ids before the piece and ``offset`` the ids of the
    sequence before it; ``sequence_tokens`` is the padded length of the sequence.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    schema = PIECE + (", ids array<int>" if ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def rows(sequences):
        columns = [[] for _ in range(9)]
        for sequence, pieces in sequences:
            total = sum(len(p[2]) for p in pieces) // 4
            padded, offset = total if total & (total - 1) == 0 else capacity, 0
            for doc, start, raw, count in pieces:
                length = len(raw) // 4
                values = (doc, start, length, zlib.crc32(raw), count, sequence, offset, padded, np.frombuffer(raw, "<i4") if ids else None)
                for column, value in zip(columns, values):
                    column.append(value)
                offset += length
        arrays = [pa.array(c, pa.int64()) for c in columns[:8]]
        if ids:
            arrays.append(pa.array(columns[8], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def run(batches):
        encode = encoder(tokenizer)
        packer = Packer(TaskContext.get().partitionId() << 40, capacity)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for part, _, _ in slices(batch):
                done = []
                for doc, raw in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()])):
                    raw += end
                    at, count = 0, len(raw) // 4
                    for length in cut_lengths(count, capacity, tail):
                        done += packer.add((doc, at, raw[4 * at : 4 * (at + length)], count))
                        at += length
                if done:
                    yield rows(done)
        done = packer.close()
        if done:
            yield rows(done)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
