"""Benchmark passages in documents by random-walk embedding and bit sampling.

Edit distance is taken over words (letters and digits, ASCII lower-cased). A
window of words is embedded by a random walk: in step ``j`` it emits the word
under the walker, and a random bit of that word and ``j`` says whether the walker moves
on. Windows at a small edit distance then agree on most emitted words, so edit
distance becomes Hamming distance. Several walks are taken, and of each several
samples of emitted places are keys; an item and a document meet where they share a
key. Document windows start at every ``stride``-th word and item windows at every
word, so a passage needs no alignment. Items fall into length classes, and each
class has its own windows. Every candidate is then verified by the exact edit
distance of the whole item to the best matching stretch around.

Windows and strides of a class follow from the edits the tolerance allows: a fifth
of the words may differ, so a window as long as its items would hold five edits
or more, and few places agree behind that many. ``WINDOWS`` are about half of the shortest item
of their class, hold one to three edits, and start often enough for a stretch at the
tolerance to hold several. The number of keys follows from the target recall: a window holding one edit
agrees on a key of ``k`` places with a chance of about ``(1 - disagree)^k``;
``keys_needed`` repeats until the chance of no agreement at all is below
``1 - recall``. The recall of the walks is tested for each item length and kind of
edit, all at the whole tolerance, against the edit distance of all items to all documents.

``exact=True`` adds a search that misses nothing: ``e`` edits leave an item of
``n`` words at most ``e + 1`` pieces of ``n - e`` words together, so one of
``(n - e) / (e + 1)`` words, rounded up, is whole. Every run of an item of that
length is then looked up at every word of the documents. It is off by default.

Items are a query set: they go to the tasks in blocks of at most ``BLOCK`` items,
whatever their number, and documents are scanned once a block. Map-only.

Defined cases: null or empty documents and items without a word match nothing;
items of fewer than ``SHORTEST`` words are too short to tell and match only an
equal run of words; equal items are found separately; an item whose id is null or
no integer is searched like any other and reported with a null id; rows of one ``doc_id`` are
searched separately and give one row each per item found.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.llm.textops import Hasher, append, find_words, mix, rolling, window_starts

#: Items that one scan of the documents looks for.
BLOCK = 20_000
#: Items with fewer words must match exactly.
SHORTEST = 8
#: Words an item may differ by, as a share of its words.
TOLERANCE = 0.2
#: Chance that a window with one edit is found; an item has several windows.
RECALL = 0.99
#: Emitted places that form one key.
PLACES = 4
#: Chance that two windows one edit apart differ at an emitted place, measured over walks (see tests).
DISAGREE = 0.16
#: Independent walks; keys of one walk are alike, so several are needed.
WALKS = 4

#: Longest runs of words looked up by the exact search.
LONGEST_RUN = 8
#: Upper word counts of the length classes; beyond the last one windows stay that long.
CLASSES = (12, 18, 27, 40)
#: Words of a window and words between the starts of two, by length class.
WINDOWS = ((6, 2), (9, 3), (12, 4), (16, 4))


def letter_table() -> np.ndarray:
    """Byte to byte: ASCII letters in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def word_separators() -> np.ndarray:
    """All ASCII bytes but letters and digits part words."""
    table = np.zeros(256, bool)
    table[:128] = True
    for a, b in ((48, 58), (65, 91), (97, 123)):
        table[a:b] = False
    return table


def keys_needed(recall: float, places: int = PLACES, disagree: float = DISAGREE) -> int:
    """Independent keys after which two windows one edit apart share one with this chance."""
    return math.ceil(math.log(1 - recall) / math.log(1 - (1 - disagree) ** places))


def class_of(words: int) -> int:
    return sum(words > c for c in CLASSES[:-1])


def whole_run(words: int, tolerance: float) -> int:
    """Words of an item that stay together whatever the edits within the tolerance, ``LONGEST_RUN`` at most."""
    edits = int(tolerance * words)
    return min(LONGEST_RUN, max(1, -(-(words - edits) // (edits + 1))))


def lookup_map(keys: np.ndarray) -> tuple[np.uint64, np.ndarray]:
    """A bit map over the leading bits answers most lookups without a search."""
    bits = np.uint64(64 - max(16, min(24, int(keys.size).bit_length() + 5)))
    seen = np.zeros(1 << (64 - int(bits)), bool)
    seen[keys >> bits] = True
    return bits, seen


def walk_keys(words: np.ndarray, starts: np.ndarray, size: int, walk: int, samples: int, places: int = PLACES) -> np.ndarray:
    """Keys ``(samples, windows)`` of one random walk over the windows of ``size`` words; 0 where the walk leaves the window."""
    rng = np.random.default_rng(1000 * size + walk)
    steps = min(size + size // 2, 64)
    taken = np.sort(np.stack([rng.choice(steps, places, replace=False) for _ in range(samples)]), 1)
    moves = mix(words ^ np.uint64(rng.integers(1, 1 << 62)))
    keys = np.zeros((samples, len(starts)), np.uint64)
    left = np.zeros((samples, len(starts)), bool)
    at, end = starts.copy(), starts + size
    for j in range(int(taken.max()) + 1):
        here = np.minimum(at, end - 1)
        for s in np.flatnonzero((taken == j).any(1)):
            keys[s] = keys[s] * np.uint64(0x9E3779B97F4A7C15) + words[here]
            left[s] = at >= end
        at += ((moves[here] >> np.uint64(j)) & np.uint64(1)).astype(np.int64)
    for s in range(samples):  # walk, class and sample are part of the key
        keys[s] = mix(keys[s] + np.uint64(walk * 64 + s + 4096 * size))
    keys[left] = 0
    return keys


def stretch_distance(item: np.ndarray, words: np.ndarray, limit: int) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to any run of ``words``, and that run; distance ``limit + 1`` if above."""
    n = len(words)
    costs, begins = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    for x in item:
        skip = costs + 1
        swap = costs[:-1] + (words != x)
        fresh, origin = skip.copy(), begins.copy()
        better = swap < fresh[1:]
        fresh[1:][better], origin[1:][better] = swap[better], begins[:-1][better]
        # Words put in: least of fresh[i] + (j - i) over i <= j.
        level = fresh - steps
        low = np.minimum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == low, steps, 0))
        costs, begins = low + steps, origin[source]
        if costs.min() > limit:
            return limit + 1, 0, 0
    end = int(costs.argmin())
    return int(costs[end]), int(begins[end]), end


class ItemIndex:
    """Keys of a block of items, sorted for lookup, and the items' words."""

    def __init__(self, items: list[tuple[int, str]], recall: float = RECALL, tolerance: float = TOLERANCE, exact: bool = False):
        self.tolerance = tolerance
        self.samples = math.ceil(keys_needed(recall) / WALKS)
        raw = [t.encode() for _, t in items]
        data, offsets = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw])))
        starts, ends, firsts = find_words(data, offsets, word_separators())
        words = Hasher(0, letter_table())(data, starts, ends)
        own = [words[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
        kept = [i for i, w in enumerate(own) if len(w)]
        self.items, self.words = [items[i][0] for i in kept], [own[i] for i in kept]
        self.kinds, self.exact = {}, {}
        for kind in sorted({class_of(len(w)) for w in self.words if len(w) >= SHORTEST}):
            size, stride = WINDOWS[kind]
            members = [i for i, w in enumerate(self.words) if len(w) >= SHORTEST and class_of(len(w)) == kind]
            line = np.concatenate([self.words[i] for i in members])
            lengths = np.array([len(self.words[i]) for i in members])
            firsts = np.concatenate(([0], np.cumsum(lengths)))
            counts = lengths - size + 1
            at = np.arange(counts.sum()) + np.repeat(firsts[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
            item, place = np.repeat(members, counts), at - np.repeat(firsts[:-1], counts)
            keys = np.concatenate([walk_keys(line, at, size, w, self.samples) for w in range(WALKS)]).ravel()
            item, place = np.tile(item, WALKS * self.samples), np.tile(place, WALKS * self.samples)
            order = np.argsort(keys, kind="stable")
            order = order[keys[order] != 0]
            self.kinds[kind] = (size, stride, lookup_map(keys), keys[order], item[order], place[order])
        self.runs, by_run = {}, {}
        for i, w in enumerate(self.words):
            if exact and len(w) >= SHORTEST:
                by_run.setdefault(whole_run(len(w), tolerance), []).append(i)
        for size, members in by_run.items():
            keys = np.concatenate([rolling(self.words[i], size) for i in members])
            counts = [len(self.words[i]) - size + 1 for i in members]
            order = np.argsort(keys, kind="stable")
            item, place = np.repeat(members, counts), np.concatenate([np.arange(n) for n in counts])
            self.runs[size] = (lookup_map(keys), keys[order], item[order], place[order])
        for i, w in enumerate(self.words):
            if len(w) < SHORTEST:
                self.exact.setdefault(len(w), []).append(i)

    def search(self, words: np.ndarray, firsts: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
        """(document, item, distance, start, end, item words) of the best stretch of each item in each document."""
        spots: set[tuple[int, int, int]] = set()

        def meet(values, at, lookup, keys, item, place):
            """Takes down where an item would begin in a document; near places are one candidate."""
            bits, seen = lookup
            maybe = seen[values >> bits] & (values != 0)
            values, at = values[maybe], at[maybe]
            low, high = np.searchsorted(keys, values, "left"), np.searchsorted(keys, values, "right")
            counts = high - low
            k = np.arange(counts.sum()) + np.repeat(low - np.cumsum(counts) + counts, counts)
            at = np.repeat(at, counts)
            docs = np.searchsorted(firsts, at, "right") - 1
            rows = np.stack([docs, item[k], (at - place[k]) // 8], 1)
            spots.update(map(tuple, np.unique(rows, axis=0).tolist()))

        counts = np.diff(firsts)
        for size, stride, *index in self.kinds.values():
            n = np.maximum((counts - size) // stride + 1, 0) * (counts >= size)
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = np.repeat(firsts[:-1], n) + inner * stride
            for walk in range(WALKS if len(at) else 0):
                for row in walk_keys(words, at, size, walk, self.samples):
                    meet(row, at, *index)
        for size, index in self.runs.items():
            at, values = window_starts(firsts, size), rolling(words, size)
            meet(values[at], at, *index)
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for d, i, spot in sorted(spots):
            own, slack = self.words[i], int(self.tolerance * len(self.words[i]))
            low = max(firsts[d], spot * 8 - slack - 8)
            high = min(firsts[d + 1], spot * 8 + 8 + len(own) + slack + 8)
            line = words[low:high]
            # A word of the item that is nowhere around costs an edit, so most chance candidates end here.
            if len(own) - int((own[:, None] == line).any(1).sum()) > slack:
                continue
            distance, a, b = stretch_distance(own, line, slack)
            if distance <= slack:
                found = (distance, int(low - firsts[d]) + a, int(low - firsts[d]) + b)
                best[d, i] = min(best.get((d, i), found), found)
        for size, short in self.exact.items():
            at = np.arange(len(words) - size + 1)
            at = at[np.searchsorted(firsts, at, "right") == np.searchsorted(firsts, at + size - 1, "right")]
            for i in short:
                own = self.words[i]
                hit = at[words[at] == own[0]]
                for p in hit[[bool((words[q : q + size] == own).all()) for q in hit]] if len(hit) else []:
                    d = int(np.searchsorted(firsts, p, "right")) - 1
                    found = (0, int(p - firsts[d]), int(p - firsts[d]) + size)
                    best[d, i] = min(best.get((d, i), found), found)
        return [(d, self.items[i], *found, len(self.words[i])) for (d, i), found in sorted(best.items())]


_FOUND = "array<struct<item_id:long,distance:int,start_word:int,end_word:int,item_words:int>>"
_FOUND_ARROW = pa.list_(pa.struct([
    ("item_id", pa.int64()), ("distance", pa.int32()), ("start_word", pa.int32()), ("end_word", pa.int32()), ("item_words", pa.int32())
]))


def _blocks(benchmark: DataFrame, block: int):
    """Blocks of items as lists; one block at a time is in memory."""
    rows = benchmark.select(F.col("item_id").try_cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    rows = rows.distinct().orderBy("item_id", "text").toLocalIterator()
    part = []
    for r in rows:
        part.append((r[0], r[1]))
        if len(part) == block:
            yield part
            part = []
    if part:
        yield part


def _scan(docs: DataFrame, items: list, recall: float, tolerance: float, exact: bool, name: str) -> DataFrame:
    given = docs.sparkSession.sparkContext.broadcast(items)

    def kernel():
        index, separators, hasher = ItemIndex(given.value, recall, tolerance, exact), word_separators(), Hasher(0, letter_table())

        def compute(data, offsets):
            starts, ends, firsts = find_words(data, offsets, separators)
            out = [[] for _ in range(len(offsets) - 1)]
            for d, *found in index.search(hasher(data, starts, ends), firsts):
                out[d].append(dict(zip(("item_id", "distance", "start_word", "end_word", "item_words"), found)))
            return (pa.array(out, _FOUND_ARROW),)

        return compute

    return append(docs, f"`{name}` {_FOUND}", kernel)


def contaminated(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL, tolerance: float = TOLERANCE, block: int = BLOCK, exact: bool = False) -> DataFrame:
    """Benchmark items found in documents, one row per document row and item.

    ``doc_id, item_id, distance, start_word, end_word, item_words``: the edit
    distance in words is at most ``tolerance`` of the item's words; the stretch
    counts words from 0, end exclusive.
    """
    own = docs.select("doc_id", "text")
    parts = [
        _scan(own, items, recall, tolerance, exact, "_found").select("doc_id", F.inline("_found"))
        for items in _blocks(benchmark, block)
    ]
    if not parts:
        parts = [own.limit(0).select("doc_id", F.inline(F.lit(None).cast(_FOUND)))]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, recall: float = RECALL, tolerance: float = TOLERANCE, block: int = BLOCK, exact: bool = False) -> DataFrame:
    """The documents in which no benchmark item is found, with their columns."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    name = "_found"
    while name in docs.columns:
        name += "_"
    for items in _blocks(benchmark, block):
        docs = _scan(docs, items, recall, tolerance, exact, name).where(F.size(name) == 0).select(*kept)
    return docs
