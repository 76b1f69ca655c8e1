"""Periodic stretches of texts by string synchronising sets.

A run is a stretch of words with smallest period ``q`` and a length of at least
``least`` words and three periods that neither neighbour extends. Runs are found
scale by scale, with ``t`` doubling from ``BASE_SCALE`` on; scale ``t`` finds the
periods from ``2t`` to ``4t``:

* Every ``t`` consecutive words have a fingerprint. A place is selected where the
  least fingerprint of the ``t + 1`` places from it on stands at its first or last
  place. So the choice depends on the next ``2t`` words alone, and equal words
  select equal places.
* Places whose ``t`` words have a period of at most ``t / 3`` give no fingerprint.
  They are known from the runs of smaller periods. Any ``t`` neighbouring places hold
  a selected one, unless the ``3t - 1`` words there are that periodic as a whole.
* Two following selected places with equal words around them propose their distance
  as a period. The surroundings have ``3t`` words for periods up to ``3t`` and ``4t``
  beyond, and begin 0, ``t`` or ``2t`` words before the place. A run of period ``q``
  has a selected place ``x`` with ``x + q + 2t`` inside, one of the surroundings of
  both lies inside, and as it has at least ``q`` words it does not return earlier.
* A proposal grows to both sides as far as words agree at its distance (halving
  steps over prefix fingerprints), and is compared word by word at the end. So no false
  run is told. One could be missed only where two unlike stretches of 62-bit fingerprints
  fall together within one period of it.

Periods below ``2 * BASE_SCALE`` are not proposed; their highly periodic regions
come from comparing the words with themselves at each such distance. A stretch found
with several periods keeps the smallest. Work is within a logarithm of the words, at
any content. All texts of a slice go through each step together.

Defined cases: a null or empty text has no words and no runs; rows of one ``doc_id``
are judged each on its own; a text of any length is one slice, so memory follows the
longest text; of input columns only ``doc_id`` and ``text`` are read, others of any name
do not matter; an empty table gives an empty table. The result has one row per input row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tissueframe.llm.textops import mix, slices

LEAST = 24
REPEATS = 3
BASE_SCALE = 4

RUN = "struct<start:long,length:long,period:long>"

_NONE = np.uint64((1 << 64) - 1)
#: Primes below 2^31 and bases of the two fingerprints.
_FIELDS = ((2147483647, 1103515245), (2147483629, 1664525013))


class Prints:
    """Fingerprints of any stretch of a sequence of small integers."""

    def __init__(self, values: np.ndarray):
        self.n, self.sums, self.powers = len(values), [], []
        for prime, base in _FIELDS:
            p = np.uint64(prime)
            powers = np.ones(self.n + 1, np.uint64)
            size = 1
            while size <= self.n:
                step = np.uint64(pow(base, size, prime))
                powers[size : 2 * size] = powers[: min(size, self.n + 1 - size)] * step % p
                size *= 2
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers[: self.n] % p, out=sums[1:])
            self.sums.append(sums % p)
            self.powers.append(powers)

    def __call__(self, starts: np.ndarray, size) -> np.ndarray:
        out = np.zeros(len(starts), np.uint64)
        for (prime, _), sums, powers in zip(_FIELDS, self.sums, self.powers):
            p = np.uint64(prime)
            part = (sums[starts + size] + p - sums[starts]) % p * powers[self.n - starts] % p
            out = out << np.uint64(31) | part
        return out

    def agree(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How many items from ``a`` and ``b`` on are equal, ``most`` at most; ``back``: that many before them."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            shift = middle if back else 0
            same = self(a - shift, middle) == self(b - shift, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """Least of every ``size`` consecutive values."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _small(words: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Stretches ``(start, end, period)`` of three periods or more, for the periods below the first scale."""
    found = []
    for d in range(1, min(2 * BASE_SCALE, len(words))):
        same = np.zeros(len(words) - d + 2, bool)
        same[1:-1] = (words[d:] == words[:-d]) & (left[:-d] > d)
        edges = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2)
        edges = edges[edges[:, 1] - edges[:, 0] >= (REPEATS - 1) * d]
        found.append(np.column_stack([edges[:, 0], edges[:, 1] + d, np.full(len(edges), d)]))
    return np.concatenate(found) if found else np.empty((0, 3), np.int64)


def _periodic(runs: np.ndarray, n: int, scale: int) -> np.ndarray:
    """Places whose next ``scale`` words have a period of at most a third of it."""
    own = runs[(3 * runs[:, 2] <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, own[:, 0], 1)
    np.add.at(steps, own[:, 1] - scale + 1, -1)
    return np.cumsum(steps[:-1]) > 0


def selected(prints: Prints, left: np.ndarray, periodic: np.ndarray, scale: int) -> np.ndarray:
    """The synchronising set of a scale; ``left`` counts the words of the text from each place on."""
    places = np.flatnonzero(left >= scale)
    marks = np.full(len(left) + scale, _NONE)
    marks[places] = np.minimum(mix(prints(places, scale)), _NONE - np.uint64(1))
    marks[: len(left)][periodic] = _NONE
    least = _least(marks, scale + 1)[: len(left)]
    at = (least != _NONE) & ((least == marks[: len(left)]) | (least == marks[scale : scale + len(left)]))
    return np.flatnonzero(at & (left >= 2 * scale))


def _proposals(prints: Prints, places: np.ndarray, before: np.ndarray, left: np.ndarray, scale: int) -> np.ndarray:
    """Pairs ``(place, distance)`` of following places with equal surroundings."""
    found = []
    for size, nearest in ((3 * scale, 2 * scale), (4 * scale, 3 * scale + 1)):
        for lead in range(0, size - 2 * scale + 1, scale):
            own = places[(before[places] >= lead) & (left[places] >= size - lead)]
            around = prints(own - lead, size)
            order = np.argsort(around, kind="stable")
            around, own = around[order], own[order]
            gaps = own[1:] - own[:-1]
            hit = (around[1:] == around[:-1]) & (gaps >= nearest) & (gaps <= size)
            found.append(np.column_stack([own[:-1][hit], gaps[hit]]))
    return np.concatenate(found)


def _grown(words, prints: Prints, pairs: np.ndarray, before: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Stretches ``(start, end, period)`` of three periods or more around proposed pairs."""
    at, gap = pairs[:, 0], pairs[:, 1]
    starts = at - prints.agree(at, at + gap, before[at], back=True)
    ends = at + gap + prints.agree(at, at + gap, left[at] - gap)
    own = np.column_stack([starts, ends, gap])
    own = np.unique(own[own[:, 1] - own[:, 0] >= REPEATS * gap], axis=0)
    exact = []
    for s, e, d in own.tolist():
        same = words[s : e - d] == words[s + d : e]
        if same.all():
            exact.append((s, e, d))
        else:  # unlike words had equal fingerprints; what lies between them stays
            cuts = np.concatenate(([-1], np.flatnonzero(~same), [len(same)]))
            exact += [(s + a + 1, s + b + d, d) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if b - a - 1 >= (REPEATS - 1) * d]
    return np.array(exact, np.int64).reshape(-1, 3)


def find_runs(words: np.ndarray, firsts: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Runs ``(start, length, period)`` of texts, ordered by start and period.

    ``words`` numbers the words of all texts so that equal words have equal numbers;
    ``firsts`` is the index of each text's first word, one more at the end.
    """
    counts = np.diff(firsts)
    before = np.arange(len(words)) - np.repeat(firsts[:-1], counts)
    left = np.repeat(counts, counts) - before
    runs = _small(words, left)
    longest, scale, prints = int(counts.max(initial=0)), BASE_SCALE, None
    while 2 * REPEATS * scale <= longest:
        if prints is None:
            prints = Prints(words)
        periodic = _periodic(runs, len(words), scale)
        long = np.repeat(counts >= 2 * REPEATS * scale, counts)  # shorter texts have no run of this scale
        places = selected(prints, np.where(long, left, 0), periodic, scale)
        pairs = np.unique(_proposals(prints, places, before, left, scale), axis=0)
        if len(pairs):
            runs = np.concatenate([runs, _grown(words, prints, pairs, before, left)])
        scale *= 2
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)  # of one stretch the smallest period
    runs = runs[first & (runs[:, 1] - runs[:, 0] >= least)]
    found = np.column_stack([runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 2]])
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run of the greatest length by period; of equals the first, then the one of the smaller period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row per document: ``doc_id, n_words, runs, strongest, kept_text``.

    ``runs`` lists ``(start, length, period)`` in words by start and period,
    ``strongest`` is the run of the most periods (null without runs), and
    ``kept_text`` joins the words that no run holds behind its first period. Map-only.
    """
    source = docs.select("doc_id", "text")
    id_type = source.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n_words long, runs array<{RUN}>, strongest {RUN}, kept_text string"
    run_type = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])

    def judge(data, offsets):
        raw, numbers = data.tobytes(), {}
        texts = [raw[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        firsts = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        words = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t), np.int64, int(firsts[-1]))
        runs = find_runs(words, firsts, least)
        bounds = np.searchsorted(runs[:, 0], firsts).tolist()
        listed, best, kept = [], [], []
        for i, text in enumerate(texts):
            own = [(s - int(firsts[i]), n, q) for s, n, q in runs[bounds[i] : bounds[i + 1]].tolist()]
            if own:
                keep = np.ones(len(text), bool)
                for s, n, q in own:
                    keep[s + q : s + n] = False
                text = [text[k] for k in np.flatnonzero(keep).tolist()]
            listed.append([dict(zip(("start", "length", "period"), r)) for r in own])
            top = strongest(own)
            best.append(top and dict(zip(("start", "length", "period"), top)))
            kept.append(b" ".join(text).decode())
        return pa.array(np.diff(firsts)), pa.array(listed, pa.list_(run_type)), pa.array(best, run_type), pa.array(kept, pa.string())

    def run(batches):
        for batch in batches:
            for part, data, offsets in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), *judge(data, offsets)], names=["doc_id", "n_words", "runs", "strongest", "kept_text"])

    return source.mapInArrow(run, schema)
