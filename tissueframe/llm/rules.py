"""Quality rules by distribution divergence.

Two histograms of a document, its character classes and its most common words,
are compared with those of a language by the Jensen-Shannon distance (square
root of the divergence in bits, 0 to 1). A document passes if there is one
language to which both are near. Short documents have noisy histograms, so each
comparison has a least number of words below which it does not reject.

The references are counted over all documents with enough words that pass the
base rule, by language; the common words of a language are those with the
largest counts (of equal counts the smaller hashes as signed numbers). Every word counts: a task adds up
what it meets and hands on its table whole whenever it holds ``HELD`` words, so no verdict depends on
how documents are dealt.

Defined cases: a null or empty text has no word and fails the base rule; rows
with a null ``lang`` do not enter the references but are judged; without any
reference the method rejects nothing; repeated rows are judged alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.llm.textops import Hasher, append, cover, find_words, mix, rolling, separator_table, slices, window_starts
from tissueframe.plans.lineage import store

#: Words that the comparison of character classes and of common words needs.
CLASS_WORDS = 50
COMMON_WORDS = 60
#: Distances above which a document is unlike a language.
CLASS_LIMIT = 0.25
COMMON_LIMIT = 0.5
#: Common words of a language's histogram; all other words share one more bin.
COMMON = 64
#: Words a task adds up before it hands them on.
HELD = 1 << 20

#: The base rule: least words, words of a repeated window, and their largest share in percent.
LEAST_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20
SYMBOLS = "#*$%&|<>"

_NAMES = ("upper", "lower", "digit", "symbol", "mark", "stop", "other", "space")


def _classes() -> np.ndarray:
    table = np.full(256, _NAMES.index("mark"), np.int64)
    table[128:] = 6
    table[65:91], table[97:123], table[48:58] = 0, 1, 2
    table[[ord(c) for c in SYMBOLS]] = 3
    table[[ord(c) for c in ".,;:'\"()-"]] = 5
    table[[9, 10, 11, 12, 13, 32]] = 7
    return table


def _word_table() -> np.ndarray:
    """Lower case; punctuation hashes as nothing, so ``Word,`` is ``word``."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the rows of ``p`` to ``q``; both sum to one."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        right = np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.clip((left + right) / 2, 0, 1))


class Measure:
    """Counts of a slice of documents: the base columns, character classes and word hashes."""

    def __init__(self):
        self.separators, self.classes = separator_table(), _classes()
        self.exact, self.folded = Hasher(), Hasher(0, _word_table())
        self.symbols = separator_table([ord(c) for c in SYMBOLS])

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> dict:
        n = len(offsets) - 1
        starts, ends, firsts = find_words(data, offsets, self.separators)
        counts = np.diff(firsts)

        def per_document(mask):
            sums = np.concatenate(([0], np.cumsum(mask)))
            return sums[offsets[1:]] - sums[offsets[:-1]]

        chars = (data & 0xC0) != 0x80
        out = {"n_words": counts, "word_chars": per_document(chars & ~self.separators[data]), "n_symbols": per_document(self.symbols[data])}
        words = self.exact(data, starts, ends)
        # Lines with a word: all of them less the distinct ones.
        breaks = np.flatnonzero(data == 10)
        begin = np.unique(np.concatenate((offsets[:-1], breaks + 1)))
        begin = begin[begin < len(data)]
        finish = np.minimum(np.append(begin[1:], len(data)), offsets[np.searchsorted(offsets, begin, "right")])
        finish = finish - (data[finish - 1] == 10)
        full = np.searchsorted(starts, begin) < np.searchsorted(starts, finish)
        begin, finish = begin[full], finish[full]
        owner = np.searchsorted(offsets, begin, "right") - 1
        lines = mix(self.exact(data, begin, finish) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, once = np.unique(lines, return_index=True)
        out["n_dup_lines"] = np.bincount(owner, minlength=n) - np.bincount(owner[once], minlength=n)
        # Words in windows that occur again in the same document.
        at = window_starts(firsts, REPEAT_WINDOW)
        repeated = np.zeros(len(words), bool)
        if len(at):
            doc = (np.searchsorted(firsts, at, "right") - 1).astype(np.uint64)
            keys = mix(rolling(words, REPEAT_WINDOW)[at] + doc * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(keys, kind="stable")
            same = keys[order[1:]] == keys[order[:-1]]
            again = np.zeros(len(at), bool)
            again[order[1:][same]] = again[order[:-1][same]] = True
            repeated = cover(len(words), at[again], REPEAT_WINDOW)
        sums = np.concatenate(([0], np.cumsum(repeated)))
        out["n_repeat_words"] = sums[firsts[1:]] - sums[firsts[:-1]]
        out["base_failed"] = (counts < LEAST_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * counts)
        kinds = self.classes[data]
        out["classes"] = np.stack([per_document((kinds == k) & chars) for k in range(len(_NAMES))], 1)
        # Words without punctuation at their ends, in lower case.
        inner_starts, inner_ends = starts.copy(), ends.copy()
        for _ in range(3):
            some = inner_ends - inner_starts > 1
            inner_ends -= some & np.isin(kinds[inner_ends - 1], (4, 5))
            some = inner_ends - inner_starts > 1
            inner_starts += some & np.isin(kinds[inner_starts], (4, 5))
        return out | {"words": self.folded(data, inner_starts, inner_ends), "firsts": firsts}


class References:
    """Histograms by language: shares of character classes, common words (hashes) and their shares."""

    def __init__(self, classes: dict[str, np.ndarray], words: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(classes)
        self.classes = {k: classes[k] / classes[k].sum() for k in self.langs}
        self.words = {}
        for lang in self.langs:
            keys, shares = words.get(lang, (np.empty(0, np.uint64), np.empty(0)))
            order = np.argsort(keys)
            self.words[lang] = keys[order], np.append(shares[order], max(0.0, 1 - shares.sum()))

    def distances(self, found: dict) -> tuple[np.ndarray, np.ndarray]:
        """Distances ``(languages, documents)`` of character classes and of common words."""
        n, firsts, words = len(found["n_words"]), found["firsts"], found["words"]
        total = np.maximum(found["n_words"], 1)[:, None]
        shares = found["classes"] / np.maximum(found["classes"].sum(1, keepdims=True), 1)
        owner = np.repeat(np.arange(n), np.diff(firsts))
        near, common = np.empty((len(self.langs), n)), np.empty((len(self.langs), n))
        for i, lang in enumerate(self.langs):
            near[i] = distance(shares, self.classes[lang])
            keys, reference = self.words[lang]
            at = np.minimum(np.searchsorted(keys, words), max(len(keys) - 1, 0))
            known = keys[at] == words if len(keys) else np.zeros(len(words), bool)
            bins = np.where(known, at, len(keys))
            counts = np.bincount(owner * (len(keys) + 1) + bins, minlength=n * (len(keys) + 1)).reshape(n, -1)
            common[i] = distance(counts / total, reference)
        return near, common

    def keeps(self, found: dict) -> np.ndarray:
        n_words = found["n_words"]
        if not self.langs:
            return np.ones(len(n_words), bool)
        near, common = self.distances(found)
        good = ((near <= CLASS_LIMIT) | (n_words < CLASS_WORDS)) & ((common <= COMMON_LIMIT) | (n_words < COMMON_WORDS))
        return good.any(0)


def references(docs: DataFrame) -> References:
    """Reference histograms counted over all documents that have a language."""

    def run(batches):
        measure = Measure()
        classes: dict[str, np.ndarray] = {}
        words: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def batch_of(lang, kind, keys, n):
            size = len(keys)
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), pa.array(np.full(size, kind, np.int32)), pa.array(keys), pa.array(n.astype(np.int64))],
                names=["lang", "kind", "key", "n"],
            )

        def tables():
            for lang, parts in words.items():
                keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.zeros(len(keys), np.int64)
                np.add.at(n, at, np.concatenate([c for _, c in parts]))
                yield lang, keys, n

        for batch in batches:
            for part, data, offsets in slices(batch):
                found = measure(data, offsets)
                langs = np.array(part.column(0).to_pylist(), object)
                good = ~found["base_failed"] & (found["n_words"] >= COMMON_WORDS)
                owner = np.repeat(np.arange(len(langs)), np.diff(found["firsts"]))
                for lang in set(langs[good]):
                    own = good & (langs == lang)
                    classes[lang] = classes.get(lang, 0) + found["classes"][own].sum(0)
                    keys, n = np.unique(found["words"][own[owner]], return_counts=True)
                    words.setdefault(lang, []).append((keys, n))
                    held += len(keys)
                if held > HELD:
                    words = {lang: [(keys, n)] for lang, keys, n in tables()}
                    held = sum(len(parts[0][0]) for parts in words.values())
                    if 2 * held > HELD:
                        for lang, keys, n in tables():
                            yield batch_of(lang, 1, keys.view(np.int64), n)
                        words, held = {}, 0
        for lang, keys, n in tables():
            yield batch_of(lang, 1, keys.view(np.int64), n)
        for lang, n in classes.items():
            yield batch_of(lang, 0, -1 - np.arange(len(n)), n)

    labelled = docs.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), "text")
    found = labelled.mapInArrow(run, "lang string, kind int, key long, n long").groupBy("lang", "kind", "key").agg(F.sum("n").alias("n"))
    found = store(found, "rule-counts")
    # Per language the class counts, the sum of all words and the common words: a bounded number of rows comes to the driver.
    words = found.where("kind = 1")
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    classes: dict[str, np.ndarray] = {}
    for r in found.where("kind = 0").collect():
        classes.setdefault(r["lang"], np.zeros(len(_NAMES)))[-1 - r["key"]] = r["n"]
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    top: dict[str, list] = {}
    for r in words.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= COMMON).collect():
        top.setdefault(r["lang"], []).append(r)
    common = {
        lang: (np.array([r["key"] for r in rows], np.int64).astype(np.uint64), np.array([r["n"] for r in rows]) / totals[lang])
        for lang, rows in top.items()
    }
    return References(classes, common)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def apply_rules(docs: DataFrame, known: References | None = None) -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and ``kept``. Whole texts, map-only besides the references."""
    known = known or references(docs)

    def kernel():
        measure = Measure()

        def compute(data, offsets):
            found = measure(data, offsets)
            kept = ~found["base_failed"] & known.keeps(found)
            return (*(pa.array(found[c].astype(np.int64)) for c in COUNTS), pa.array(found["base_failed"]), pa.array(kept))

        return compute

    return append(docs, ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean", kernel)
