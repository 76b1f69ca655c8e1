"""Language of a text by word-first backoff.

Every word is looked up first: a word known to the model adds its log frequency
in each language. An unseen word falls back to its character ``ORDER``-grams; if
none of them is known, to shorter ones, down to single letters. The language of
the highest mean wins.

The model is fitted on a bounded sample of the documents learning may use: of every
language those with the smallest hash of the id, ``PER_LANGUAGE`` at most, and of all
languages ``SAMPLE``, dealt in rounds, so each language gives one document before any
gives two. No language is left out for being rare. Word and gram tables keep the most
frequent entries, ``ENTRIES`` of a language and ``ALL_ENTRIES`` of all; entries hold only
the languages they were seen in, so the model's size has a bound whatever the number of languages.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
rows with a null ``lang`` teach nothing; without any labelled row all texts are ``und``;
ties go to the language first in order of its name; rows of one ``doc_id`` and language teach
together and count as one document of the sample; columns ``lang_pred`` and ``score`` of the input are replaced.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tissueframe.llm.textops import append, held_out, slices
from tissueframe.plans.lineage import drop_stored, store

#: Documents of a language the model is fitted on at most; up to 1000 Spark cuts each task to them before the shuffle.
PER_LANGUAGE = 1000
#: Documents of all languages the model is fitted on at most.
SAMPLE = 50_000
#: Times ``PER_LANGUAGE`` rows expected below the hash limit of a large language, of which the least are taken.
MARGIN = 4
ORDER = 4
#: Entries of a language's word table and of each of its gram tables.
ENTRIES = 30_000
#: Entries of all tables of all languages; each table gets the same share where it is less than ``ENTRIES``.
ALL_ENTRIES = 1_000_000
#: Words whose log frequencies count at most towards the score's sharpness.
SHARPNESS = 12
#: Words a task remembers before it starts anew, and figures (words times languages) they may take.
REMEMBERED = 300_000
REMEMBERED_FIGURES = 8_000_000

UNKNOWN = "und"

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    return _WORDS.findall(text.lower()) if text else []


def grams_of(word: str, order: int) -> list[str]:
    padded = f"_{word}_" if order > 1 else word
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def count_grams(docs: DataFrame, entries: int = ENTRIES) -> DataFrame:
    """``(lang, size, gram, n)``: counts of words (size 0) and of grams, the most frequent of each language and size."""

    def run(batches):
        for batch in batches:
            for part, _, _ in slices(batch):
                counts: dict[str, Counter] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    counts.setdefault(lang, Counter()).update(words_of(text))
                rows: Counter = Counter()
                for lang, words in counts.items():
                    for word, n in words.items():
                        rows[lang, 0, word] += n
                        for size in range(1, ORDER + 1):
                            for gram in grams_of(word, size):
                                rows[lang, size, gram] += n
                if rows:
                    keys = list(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys]), pa.array(list(rows.values()), pa.int64())],
                        names=["lang", "size", "gram", "n"],
                    )

    found = docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(run, "lang string, size int, gram string, n long")
    found = found.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))
    # Spark keeps each task's first entries before the shuffle.
    first = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
    return found.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= entries).drop("_at")


def share_of(languages: int, entries: int = ENTRIES, all_entries: int = ALL_ENTRIES) -> int:
    """Entries of one table of one language."""
    return max(1, min(entries, all_entries // ((ORDER + 1) * max(1, languages))))


class BackoffModel:
    """Log frequencies of words and grams: one table a size. An entry holds the languages it was seen in and
    what its log frequency there exceeds that of an unseen entry by; ``floors`` are the unseen ones."""

    def __init__(self, rows: list[tuple[str, int, str, int]]):
        self.langs = sorted({r[0] for r in rows})
        at = {lang: i for i, lang in enumerate(self.langs)}
        seen: list[dict[str, list[tuple[int, int]]]] = [{} for _ in range(ORDER + 1)]
        total = np.zeros((ORDER + 1, len(self.langs)))
        for lang, size, gram, n in rows:
            seen[size].setdefault(gram, []).append((at[lang], n))
            total[size, at[lang]] += n
        below = total + 0.5 * np.array([max(1, len(table)) for table in seen])[:, None]
        self.floors = np.log(0.5 / below).astype(np.float32)
        entries = [own for table in seen for own in table.values()]
        self.bounds = np.concatenate(([0], np.cumsum([len(own) for own in entries]))).astype(np.int64)
        self.at = np.array([i for own in entries for i, _ in own], np.int32)
        self.above = np.log([2 * n + 1 for own in entries for _, n in own]).astype(np.float32)
        self.tables: list[dict[str, int]] = []
        count = 0
        for table in seen:
            self.tables.append({gram: count + k for k, gram in enumerate(table)})
            count += len(table)

    def vectors(self, words: list[str]) -> np.ndarray:
        """Log frequencies of words in all languages, a row a word; zeros where not even a letter is known."""
        entries, counts, orders = [], [], []
        known, (letters, *longer) = self.tables[0], self.tables[1:]
        for word in words:
            entry = known.get(word)
            if entry is not None:
                entries.append(entry)
                counts.append(1)
                orders.append(0)
                continue
            found = []
            for order in range(ORDER, 0, -1):
                table = longer[order - 2] if order > 1 else letters
                found = [table[g] for g in grams_of(word, order) if g in table]
                if found:
                    break
            entries += found
            counts.append(len(found))
            orders.append(order if found else ORDER + 1)
        width, rows = len(self.langs), np.repeat(np.arange(len(words)), counts)
        share = 1 / np.maximum(counts, 1)
        first = self.bounds[np.array(entries, np.int64)]
        held = self.bounds[np.array(entries, np.int64) + 1] - first
        own = np.arange(held.sum()) + np.repeat(first - np.cumsum(held) + held, held)
        rows = np.repeat(rows, held)
        above = np.bincount(rows * width + self.at[own], self.above[own] * share[rows], len(words) * width)
        unseen = np.concatenate([self.floors, np.zeros((1, width), np.float32)])[orders]
        return unseen + above.reshape(len(words), width).astype(np.float32)

    def vector(self, word: str) -> np.ndarray:
        return self.vectors([word])[0]


def sampled_ids(own: DataFrame, per_language: int, sample: int) -> DataFrame:
    """``(_id, lang)`` of at most ``sample`` documents, the least hashes of each language in rounds.

    Ids only. Of a large language just the ids below a limit of the hash, a few times as many as are wanted, leave
    their task; the limit follows from the language's count of ids, so what one task reads does not grow with the input.
    """
    # Written down, its size is known: Spark then joins without moving the ids, and cuts them before the shuffle.
    sizes = store(own.groupBy("lang").agg(F.approx_count_distinct("_id").alias("_size")), "language-sizes")
    share = F.xxhash64("_id") / F.lit(float(2**64)) + 0.5  # of the hashes, those that are smaller
    few = own.select("_id", "lang").join(sizes, "lang").where(share * F.col("_size") <= MARGIN * per_language)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("_id"), "_id")
    few = few.select("_id", "lang").distinct().withColumn("_at", F.row_number().over(order)).where(F.col("_at") <= per_language)
    return few.orderBy("_at", F.xxhash64("_id", "lang"), "_id", "lang").limit(sample).select("_id", "lang")


def train(
    docs: DataFrame, per_language: int = PER_LANGUAGE, entries: int = ENTRIES, sample: int = SAMPLE, all_entries: int = ALL_ENTRIES
) -> BackoffModel | None:
    """A model of the labelled documents outside the held-out third; None if there are none.

    The sample's ids, ``sample`` at most, are broadcast, so no text is shuffled.
    """
    own = docs.select(F.col("doc_id").alias("_id"), F.col("lang").cast("string").alias("lang"), "text")
    own = own.where("lang IS NOT NULL AND text IS NOT NULL")
    own = own.where(F.col("_id").isNotNull() & ~held_out(F.col("_id")))
    chosen = store(sampled_ids(own, per_language, sample), "language-sample")
    languages = chosen.select("lang").distinct().count()
    taught = own.join(F.broadcast(chosen), ["_id", "lang"])
    table = count_grams(taught.select("lang", "text"), share_of(languages, entries, all_entries)).toArrow()
    drop_stored(chosen)
    if not table.num_rows:
        return None
    return BackoffModel(list(zip(*(table.column(c).to_pylist() for c in ("lang", "size", "gram", "n")))))


def predict(docs: DataFrame, model: BackoffModel | None, remembered: int = REMEMBERED) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the share of the winner among all languages. Whole texts, map-only."""
    given = docs.sparkSession.sparkContext.broadcast(model)  # bounded by its tables

    def kernel():
        model = given.value
        width = len(model.langs) if model else 1
        most = max(1, min(remembered, REMEMBERED_FIGURES // width))
        known: dict[str, int] = {}
        vectors = np.zeros((min(1024, most), width), np.float32)

        def remember(words: set[str]):
            """Rows of ``vectors`` for at most ``most`` words; ``vectors`` may be replaced."""
            nonlocal vectors
            fresh = list(words.difference(known))
            if len(known) + len(fresh) > most:
                known.clear()
                fresh = list(words)
            end = len(known) + len(fresh)
            if end > len(vectors):
                vectors = np.concatenate([vectors, np.zeros((min(most, 2 * end) - len(vectors), width), np.float32)])
            if fresh:
                vectors[len(known) : end] = model.vectors(fresh)
                known.update(zip(fresh, range(len(known), end)))

        def compute(data, offsets):
            raw = data.tobytes()
            found = [words_of(raw[a:b].decode()) if model else [] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            distinct = set().union(*found)
            at_once = len(distinct) <= most
            if at_once and distinct:
                remember(distinct)
            names, scores = [], []
            for words in found:
                if not words:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                mean = np.zeros(width)
                for at in range(0, len(words), most):
                    part = words[at : at + most]
                    if not at_once:
                        remember(set(part))
                    rows = np.fromiter(map(known.__getitem__, part), np.int64, len(part))
                    mean += vectors[rows].sum(0, dtype=np.float64)
                mean /= len(words)
                best = int(mean.argmax())
                share = 1 / np.exp((mean - mean[best]) * min(len(words), SHARPNESS)).sum()
                names.append(model.langs[best])
                scores.append(float(share))
            return pa.array(names, pa.string()), pa.array(scores, pa.float64())

        return compute

    return append(docs, "lang_pred string, score double", kernel)
