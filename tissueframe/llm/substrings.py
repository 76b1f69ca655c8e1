"""Removal of repeated passages by fixed-block anchors.

A window of ``WINDOW`` words (13) holds, wherever it begins, one whole block of
``BLOCK`` words (7) of a grid of blocks laid side by side over its document. So
the blocks of the grid are the index, and every rolling ``BLOCK``-word window of
every document probes it: a repeat of ``WINDOW`` words always has a hit. Hits are
extended to exact repeats by the names that equal ``BLOCK``-word windows share: a
``WINDOW`` is its first and its last ``BLOCK`` words, so two of them are equal
where both names are. Windows that hold a hit are grouped by that pair and the
smallest document of the group keeps its copy; overlapping windows grow
together to the maximal repeat.

The data go through four shuffles as packed rows: documents are read in batches
of about ``BATCH`` words, a batch sends each bucket of hashes one row, and a
bucket answers each batch with one row. Inside a batch equal windows collapse
before they are sent, so a passage that a third of all documents share is one entry
a batch. The number of buckets follows the size of the corpus. Hashes have 32 bits beyond
the bits of their bucket for names, of which two must agree at once, and 64
for pairs.

Defined cases: a null text has no word; words are kept unchanged and joined by
one space; rows of one ``doc_id`` never remove from each other; a null ``doc_id``
comes after every other id; texts shorter than a window lose nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.llm.textops import Hasher, cover, find_words, mix, rolling, separator_table, slices, text_of, window_starts

WINDOW, BLOCK = 13, 7
#: Words of a batch and bytes of text a bucket stands for.
BATCH = 1 << 20
BUCKET_BYTES = 32 << 20
LEAST_BUCKETS = 1024

_LAST = (1 << 63) - 1
_ROWS = "key long, kind int, ref long, payload binary"
_SIGN = np.uint64(1 << 63)

HEAD, ENTRIES, ANSWER = 0, 1, 2


def encode(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays by byte planes, so that small numbers leave planes of zeros to compression."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a, "<u8")
        width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
        out += [np.array([len(a), width], "<u4").tobytes(), np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8).T[:width]).tobytes()]
    return b"".join(out)


def decode(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        n, width = (int(x) for x in np.frombuffer(raw, "<u4", 2, at))
        a = np.zeros((8, n), np.uint8)
        a[:width] = np.frombuffer(raw, np.uint8, n * width, at + 8).reshape(width, n)
        out.append(np.ascontiguousarray(a.T).view("<u8").reshape(n))
        at += 8 + n * width
    return out


def _gaps(a: np.ndarray) -> np.ndarray:
    return np.diff(a, prepend=0)


def _bits(mask: np.ndarray) -> np.ndarray:
    return np.packbits(mask)


def _mask(packed: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(packed.astype(np.uint8), count=n).astype(bool)


def _ordered(ids: np.ndarray) -> np.ndarray:
    """Signed ids as unsigned numbers in the same order."""
    return ids.astype(np.int64).view(np.uint64) ^ _SIGN


def _keyed(batches):
    """Rows of sorted input by key: ``(key, [(kind, ref, payload)])``."""
    key, rows = None, []
    for batch in batches:
        keys, kinds, refs, payloads = (batch.column(i) for i in range(4))
        for k, kind, ref, payload in zip(keys.to_pylist(), kinds.to_pylist(), refs.to_pylist(), payloads):
            if k != key and rows:
                yield key, rows
                rows = []
            key = k
            rows.append((kind, ref, payload.as_py()))
    if rows:
        yield key, rows


def _out(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["key", "kind", "ref", "payload"])


def _probes(batches, bits: int):
    """Documents to batches: what each bucket has to know, and a head with the documents."""
    hasher, separators = Hasher(), separator_table()
    words, sizes, docs, hashes, count = [], [], [], [], 0
    number = TaskContext.get().partitionId() << 33

    def flush():
        nonlocal words, sizes, docs, hashes, count, number
        line, firsts = np.concatenate(words), np.concatenate(([0], np.cumsum(sizes)))
        at = window_starts(firsts, BLOCK)
        owner = np.searchsorted(firsts, at, "right") - 1
        found, first, back, times = np.unique(rolling(line, BLOCK)[at], return_index=True, return_inverse=True, return_counts=True)
        grid = np.bincount(back, (at - firsts[owner]) % BLOCK == 0, len(found)) > 0
        again = np.flatnonzero(first[back] != np.arange(len(at)))
        place = at[first]
        bucket = (found >> np.uint64(64 - bits)).astype(np.int64)
        order = np.lexsort((place, bucket))
        low = (found << np.uint64(bits)) >> np.uint64(32)
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        rows = []
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
            own = order[a:b]
            rows.append((int(bucket[own[0]]), ENTRIES, number, encode(low[own], _gaps(place[own]), _bits(grid[own]), _bits(times[own] > 1))))
        head = encode(np.array(sizes), _ordered(np.array(docs)), _ordered(np.array(hashes)), _gaps(at[again]), at[first[back[again]]])
        rows.append((number % (1 << bits), HEAD, number, head))
        number += 1
        words, sizes, docs, hashes, count = [], [], [], [], 0
        return _out(rows)

    for batch in batches:
        for part, data, offsets in slices(batch):
            starts, ends, firsts = find_words(data, offsets, separators)
            words.append(hasher(data, starts, ends))
            sizes += np.diff(firsts).tolist()
            docs += part.column(0).to_pylist()
            hashes += part.column(1).to_pylist()
            count += len(starts) + part.num_rows
            if count >= BATCH:
                yield flush()
    if docs:
        yield flush()


def _names(batches):
    """A bucket names the windows that occur again and marks those with a block of the index among them."""
    for bucket, rows in _keyed(batches):
        out = [(ref, HEAD, ref, payload) for kind, ref, payload in rows if kind == HEAD]
        entries = [(ref, *decode(payload)) for kind, ref, payload in rows if kind == ENTRIES]
        if entries:
            low = np.concatenate([e[1] for e in entries])
            grid, several = (np.concatenate([_mask(e[i], len(e[1])) for e in entries]) for i in (3, 4))
            order = np.argsort(low, kind="stable")
            run = np.empty(len(low), np.int64)
            run[order] = np.cumsum(np.diff(low[order], prepend=low[order[0]]) != 0)
            n = int(run.max()) + 1
            shared = (np.bincount(run, minlength=n) > 1) | (np.bincount(run, several, n) > 0)
            hit = np.bincount(run, grid, n) > 0
            name = np.cumsum(shared)
            bounds = np.concatenate(([0], np.cumsum([len(e[1]) for e in entries])))
            for (ref, _, gaps, *_), a, b in zip(entries, bounds[:-1], bounds[1:]):
                own = run[a:b]
                kept = shared[own]
                if kept.any():
                    place = np.cumsum(gaps.astype(np.int64))[kept]
                    out.append((ref, ANSWER, bucket, encode(_gaps(place), name[own[kept]], _bits(hit[own[kept]]))))
        if out:
            yield _out(out)


def _pairs(batches, bits: int):
    """A batch puts names together to windows around hits and asks each bucket for their smallest document."""
    for number, rows in _keyed(batches):
        sizes, docs, hashes, gaps, source = decode(next(p for kind, _, p in rows if kind == HEAD))
        firsts = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))
        name, hit = np.zeros(firsts[-1] + WINDOW, np.uint64), np.zeros(firsts[-1] + WINDOW, bool)
        for kind, bucket, payload in rows:
            if kind == ANSWER:
                steps, own, marked = decode(payload)
                place = np.cumsum(steps.astype(np.int64))
                name[place], hit[place] = (np.uint64(bucket) << np.uint64(40)) + own, _mask(marked, len(own))
        again = np.cumsum(gaps.astype(np.int64))
        name[again], hit[again] = name[source.astype(np.int64)], hit[source.astype(np.int64)]
        hits = np.concatenate(([0], np.cumsum(hit)))
        reach = WINDOW - BLOCK
        at = window_starts(firsts, WINDOW)
        at = at[(name[at] > 0) & (name[at + reach] > 0) & (hits[at + reach + 1] > hits[at])]
        owner = docs[np.searchsorted(firsts, at, "right") - 1]
        keys = mix(mix(name[at]) * np.uint64(0x9E3779B97F4A7C15) + name[at + reach])
        # Windows are numbered as they first appear, so that mostly the next number follows.
        found, first, back = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(first)
        rank = np.empty(len(found), np.int64)
        rank[order] = np.arange(len(found))
        found, back = found[order], rank[back]
        least = np.full(len(found), np.uint64((1 << 64) - 1))
        np.minimum.at(least, back, owner)
        fresh = np.zeros(len(at), bool)
        fresh[first] = True
        head = encode(sizes, docs, hashes, _gaps(at), _bits(fresh), back[~fresh], least)
        out = [(int(number % (1 << bits)), HEAD, number, head)]
        bucket = (found >> np.uint64(64 - bits)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(order)]):
            own = order[a:b]
            base = least[own].min()
            out.append((int(bucket[own[0]]), ENTRIES, number, encode(_gaps(own), base.reshape(1), found[own], least[own] - base)))
        yield _out(out)


def _firsts(batches):
    """A bucket answers with the smallest document of a window where another batch has a smaller one."""
    for bucket, rows in _keyed(batches):
        out = [(ref, HEAD, ref, payload) for kind, ref, payload in rows if kind == HEAD]
        entries = [(ref, *decode(payload)) for kind, ref, payload in rows if kind == ENTRIES]
        if entries:
            keys = np.concatenate([e[3] for e in entries])
            least = np.concatenate([e[4] + e[2][0] for e in entries])
            order = np.argsort(keys, kind="stable")
            heads = np.flatnonzero(np.concatenate(([True], np.diff(keys[order]) != 0)))
            run = np.empty(len(keys), np.int64)
            run[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(keys))))
            first = np.minimum.reduceat(least[order], heads)[run]
            bounds = np.concatenate(([0], np.cumsum([len(e[3]) for e in entries])))
            for (ref, steps, *_), a, b in zip(entries, bounds[:-1], bounds[1:]):
                less = np.flatnonzero(first[a:b] < least[a:b])
                if len(less):
                    base = first[a:b][less].min()
                    number = np.cumsum(steps.astype(np.int64))[less]
                    out.append((ref, ANSWER, bucket, encode(base.reshape(1), _gaps(number), first[a:b][less] - base)))
        if out:
            yield _out(out)


def _removals(batches):
    """A batch's documents with the words to remove, as alternating begins and ends."""
    for _, rows in _keyed(batches):
        sizes, docs, hashes, gaps, packed, others, least = decode(next(p for kind, _, p in rows if kind == HEAD))
        for kind, _, payload in rows:
            if kind == ANSWER:
                base, steps, first = decode(payload)
                least[np.cumsum(steps.astype(np.int64))] = first + base[0]
        firsts = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))
        at = np.cumsum(gaps.astype(np.int64))
        owner = docs[np.searchsorted(firsts, at, "right") - 1]
        fresh = _mask(packed, len(at))
        back = np.cumsum(fresh) - 1
        back[~fresh] = others
        gone = cover(int(firsts[-1]), at[least[back] < owner], WINDOW)
        sums = np.concatenate(([0], np.cumsum(gone)))
        some = np.flatnonzero(sums[firsts[1:]] > sums[firsts[:-1]])
        spans = [np.flatnonzero(np.diff(gone[firsts[d] : firsts[d + 1]].astype(np.int8), prepend=0, append=0)).astype(np.int32) for d in some]
        if len(some):
            ids = [(a[some] ^ _SIGN).view(np.int64) for a in (docs, hashes)]
            yield pa.RecordBatch.from_arrays([pa.array(ids[0]), pa.array(ids[1]), pa.array(spans, pa.list_(pa.int32()))], names=["_doc", "_hash", "_spans"])


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("key").sortWithinPartitions("key", "kind", "ref")


def _buckets(docs: DataFrame) -> int:
    """Bits of the number of buckets, from the size of the corpus."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, size // BUCKET_BYTES).bit_length() - 1


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Word ranges to remove by document key: ``(_doc, _hash, _spans)``, begin and end in turn."""
    bits = _buckets(docs)
    rows = docs.select("_doc", "_hash", "text").mapInArrow(lambda b: _probes(b, bits), _ROWS)
    rows = _dealt(rows).mapInArrow(_names, _ROWS)
    rows = _dealt(rows).mapInArrow(lambda b: _pairs(b, bits), _ROWS)
    rows = _dealt(rows).mapInArrow(_firsts, _ROWS)
    return _dealt(rows).mapInArrow(_removals, "_doc long, _hash long, _spans array<int>")


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text`` of every document row.

    ``kept_text`` has the words no repeated window covers, joined by one space.
    """
    own = docs.select("doc_id", "text").withColumns({
        "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "_hash": F.xxhash64("text"),
    })
    # Rows equal in id and text get equal ranges.
    found = repeated_passages(own).groupBy("_doc", "_hash").agg(F.first("_spans").alias("_spans"))
    rows = own.join(found, ["_doc", "_hash"], "left").select("doc_id", "text", "_spans")

    def run(batches):
        for batch in batches:
            spans = batch.column(2)
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                kept, n_words, n_removed = [], [], []
                for text, gone in zip(text_of(part).to_pylist(), spans.slice(start, 256).to_pylist()):
                    words = text.encode().split()
                    n_words.append(len(words))
                    removed = 0
                    for a, b in reversed(list(zip(gone[::2], gone[1::2])) if gone else []):
                        del words[a:b]
                        removed += b - a
                    n_removed.append(removed)
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept_text"],
                )

    schema = rows.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept_text")).schema
    return rows.mapInArrow(run, schema)
