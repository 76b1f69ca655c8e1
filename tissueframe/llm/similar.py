"""Pairs of texts whose sets of word shingles have a Jaccard similarity of at least a bound.

Candidates share a band: ``BANDS`` keys of a text are made of ``ROWS`` least
hashes of its shingles each, so a pair of similarity ``s`` shares a key with a
chance of ``1 - (1 - s^ROWS)^BANDS`` (0.9999 at 0.8 and more above). Every candidate that
decides anything is then compared by its whole set of shingles. A set is made once
for each text that shares a key, and travels alone: never both sets on one row.

The texts of a key are not all paired. Keys of equal members become one. Each text is
compared with one text of the key, then, where it is outside the key's largest
component, with one of that, another for every key. Then few texts are left outside, and
each of these is compared with all others of its keys that lie in another component, inside tasks: the members of
a key come to one task in cells of about ``CELL`` shingles, a larger key is cut into
blocks and every block of texts left outside meets every block of members. A task returns a
spanning forest. What is not compared lies in one component already, so components are those
of all pairs. A text is left out only where the shingles no other text of its cell has rule
the bound out.

Words end at ASCII white space and ASCII letters count as lower case. A text of
fewer words than a shingle has one shingle, the whole sequence; a text without
words is similar to none.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tissueframe.llm.decontaminate import letter_table
from tissueframe.llm.textops import Hasher, find_words, mix, rolling, separator_table, slices, window_starts
from tissueframe.plans.lineage import drop_stored, store
from tissueframe.plans.skew import attach

WIDTH = 5
SIMILAR = 0.8
BANDS = 24
ROWS = 5
#: Members of a head that one task compares.
DEALT = 512
#: Shingles of the texts that are compared with each other in one task.
CELL = 1 << 20


def shingler(width: int = WIDTH) -> Callable:
    """Function ``(bytes, offsets) -> (shingle hashes, index of each text's first, one more at the end)``."""
    separators, hasher = separator_table(), Hasher(0, letter_table())

    def shingles(data, offsets):
        starts, ends, firsts = find_words(data, offsets, separators)
        words = hasher(data, starts, ends)
        at, values, counts = window_starts(firsts, width), rolling(words, width), np.diff(firsts)
        found = np.maximum(counts - width + 1, 0)
        short = np.flatnonzero((counts > 0) & (counts < width))
        if not len(short):
            return values[at], np.concatenate(([0], np.cumsum(found)))
        whole = np.array([rolling(words[firsts[i] : firsts[i + 1]], int(counts[i]))[0] for i in short], np.uint64)
        places = np.concatenate(([0], np.cumsum(found)))[short]
        found[short] = 1
        return np.insert(values[at], places, whole), np.concatenate(([0], np.cumsum(found)))

    return shingles


def band_keys(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Keys ``(texts with a shingle, BANDS)``."""
    rng = np.random.default_rng(BANDS)
    heads = firsts[:-1][np.diff(firsts) > 0]
    keys = np.zeros((len(heads), BANDS), np.uint64)
    for band in range(BANDS if len(heads) else 0):
        for _ in range(ROWS):
            least = np.minimum.reduceat(values * np.uint64(rng.integers(1, 1 << 62) * 2 + 1), heads)
            keys[:, band] = mix(keys[:, band] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(band))
    return keys


def band_lists(values: np.ndarray, firsts: np.ndarray) -> pa.Array:
    """Keys of each text as a list, null without a shingle."""
    some = np.diff(firsts) > 0
    ends = np.concatenate(([0], np.cumsum(some * BANDS))).astype(np.int32)
    flat = pa.array(band_keys(values, firsts).ravel().view(np.int64))
    return pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(~some))


def jaccard(a: np.ndarray, b: np.ndarray, bound: float = 0.0) -> float:
    """Similarity of two sets of distinct sorted values; 0 where their sizes rule the bound out."""
    if not len(a) or not len(b) or min(len(a), len(b)) < bound * max(len(a), len(b)):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def members(light: DataFrame) -> DataFrame:
    """``(key, _text, fingerprint, head)`` of the keys that several texts share; ``head`` is one of them. Stored.

    Of keys with equal members one stays; members are told by their number and two 64-bit sums.
    """
    rows = light.where("_bands IS NOT NULL").dropDuplicates(["_text"]).select("_text", "fingerprint", F.explode("_bands").alias("key"))
    rows = store(rows, "bands")
    keys = rows.groupBy("key").agg(
        F.min(F.struct("_text", "fingerprint")).alias("head"), F.count("*").alias("_n"),
        F.bit_xor("_text").alias("_x"), F.bit_xor(F.xxhash64("_text")).alias("_y"),
    ).where("_n > 1")
    heads = keys.groupBy("_n", "_x", "_y").agg(F.min("key").alias("key"), F.first("head").alias("head")).drop("_n", "_x", "_y")
    found = store(attach(rows, heads, ["key"], "inner", spread=["_text"], salts=4), "band-members")
    drop_stored(rows)
    return found


def shingle_sets(texts: DataFrame, shared: DataFrame, width: int = WIDTH) -> DataFrame:
    """``(_text, shingles)`` of the texts (``_text, text``) that share a key, distinct hashes in order. Stored."""
    needed = texts.join(shared.select("_text").distinct(), "_text", "left_semi").dropDuplicates(["_text"])

    def run(batches):
        shingles = shingler(width)
        for batch in batches:
            for part, data, offsets in slices(batch):
                values, firsts = shingles(data, offsets)
                sets = [np.unique(values[a:b]).view(np.int64) for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist())]
                ends = np.concatenate(([0], np.cumsum([len(v) for v in sets]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["_text", "shingles"])

    return store(needed.select("_text", "text").mapInArrow(run, "_text long, shingles array<long>"), "shingle-sets")


def _set(lists: pa.Array, i: int) -> np.ndarray:
    return lists[i].values.to_numpy(zero_copy_only=False).view(np.uint64)


def confirm(sets: DataFrame, pairs: DataFrame, bound: float) -> DataFrame:
    """Of ``pairs`` (``a, b, fa, fb``; texts ``a``, the heads, and ``b``) those ``(fa, fb)`` that are similar; stored.

    The set of a head is sent once for every ``DEALT`` of its members.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / DEALT).cast("int").alias("_parts"))
    rows = attach(pairs, parts, ["a"], "inner", spread=["b"], salts=4)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("int"))
    heads = parts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    heads = heads.join(sets.withColumnRenamed("_text", "a"), "a")
    null = F.lit(None).cast("long")
    heads = heads.select("a", "part", F.lit(0).alias("_member"), null.alias("fa"), null.alias("fb"), "shingles")
    rows = rows.join(sets.withColumnRenamed("_text", "b"), "b")
    rows = heads.unionByName(rows.select("a", "part", F.lit(1).alias("_member"), "fa", "fb", "shingles"))

    def run(batches):
        own = np.empty(0, np.uint64)
        for batch in batches:
            near, lists = np.zeros(batch.num_rows, bool), batch.column(5)
            for i, member in enumerate(batch.column(2).to_numpy().tolist()):
                if member:
                    near[i] = jaccard(own, _set(lists, i), bound) >= bound
                else:  # the head comes first
                    own = _set(lists, i)
            kept = batch.filter(pa.array(near))
            yield pa.RecordBatch.from_arrays([kept.column(3), kept.column(4)], names=["a", "b"])

    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", "_member")
    return store(ordered.mapInArrow(run, "a long, b long").distinct(), "similar")


def _apart(budget: int, a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) > budget


def head_pairs(shared: DataFrame, budget: int) -> DataFrame:
    """Each text with the head of its keys, but for pairs whose fingerprints link them anyway."""
    rows = shared.where((F.col("_text") != F.col("head._text")) & _apart(budget, F.col("fingerprint"), F.col("head.fingerprint")))
    return rows.select(
        F.col("head._text").alias("a"), F.col("_text").alias("b"), F.col("head.fingerprint").alias("fa"), F.col("fingerprint").alias("fb")
    ).distinct()


def open_keys(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """``(key, _text, fingerprint, class, odd, main)`` of the keys of three texts or more in several components; stored.

    ``labels`` is ``(fingerprint, class)``. ``odd`` texts are outside the key's largest component, ``main`` is one text
    inside it, another for every key.
    """
    rows = attach(shared.select("key", "_text", "fingerprint"), labels, ["fingerprint"], spread=["_text"], salts=4)
    rows = store(rows.withColumn("class", F.coalesce("class", "fingerprint")), "band-classes")
    classes = rows.groupBy("key", "class").agg(
        F.count("*").alias("_n"), F.min(F.struct(F.xxhash64("key", "_text").alias("_h"), "_text", "fingerprint")).alias("_one")
    )
    keys = classes.groupBy("key").agg(F.max(F.struct("_n", "class", "_one")).alias("_m"), F.count("*").alias("_k"), F.sum("_n").alias("_all"))
    keys = keys.where("_k > 1 AND _all > 2").select("key", F.col("_m.class").alias("_main"), F.struct("_m._one._text", "_m._one.fingerprint").alias("main"))
    rows = attach(rows, keys, ["key"], "inner", spread=["_text"], salts=4)
    return store(rows.select("key", "_text", "fingerprint", "class", (F.col("class") != F.col("_main")).alias("odd"), "main"), "open-keys")


def main_pairs(opened: DataFrame, done: DataFrame) -> DataFrame:
    """Each odd text with a text of its key's largest component, but for pairs in ``done``."""
    rows = opened.where("odd").select(
        F.col("main._text").alias("a"), F.col("_text").alias("b"), F.col("main.fingerprint").alias("fa"), F.col("fingerprint").alias("fb")
    ).distinct()
    for a, b in (("a", "b"), ("b", "a")):
        rows = rows.join(done.select(F.col(a).alias("a"), F.col(b).alias("b")), ["a", "b"], "left_anti")
    return rows


def cell_links(sets: list[np.ndarray], classes: np.ndarray, odd: np.ndarray, bound: float) -> list[tuple[int, int]]:
    """Links that connect the components of a cell's texts; every similar pair of an odd text and another counts."""
    sizes = np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owners = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    heads = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    ends = np.append(heads[1:], len(values))
    shared = np.bincount(owners, np.repeat(ends - heads > 1, ends - heads), len(sets))
    place = np.empty(len(order), np.int64)  # of each shingle of each text the group of its equals
    place[order] = np.repeat(np.arange(len(heads)), ends - heads)
    firsts = np.concatenate(([0], np.cumsum(sizes)))
    # A partner has at least the fewest shingles of its own that any text has.
    able = shared / (sizes + (sizes - shared).min()) >= bound
    _, label = np.unique(classes, return_inverse=True)
    links = []
    for x in np.flatnonzero(odd & able).tolist():
        if (label == label[x]).all():
            continue
        groups = place[firsts[x] : firsts[x + 1]]
        groups = groups[ends[groups] - heads[groups] > 1]
        counts = ends[groups] - heads[groups]
        at = np.repeat(heads[groups] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        both = np.bincount(owners[at], minlength=len(sets))
        near = (both / (sizes + sizes[x] - both) >= bound) & (label != label[x])
        for y in np.flatnonzero(near).tolist():
            if label[y] != label[x]:
                links.append((x, y))
                label[label == label[y]] = label[x]
    return links


_CELL = ["key", "_i", "_j"]


def _cells(opened: DataFrame, sets: DataFrame, cell: int) -> DataFrame:
    """``(key, _i, _j, odd, class, fingerprint, shingles)``: a key's texts in cells; odd texts meet all others of the key."""
    rows = opened.drop("main").join(sets.select("_text", F.size("shingles").alias("_size")), "_text")
    sizes = rows.groupBy("key").agg(
        F.ceil(F.sum("_size") / cell).cast("int").alias("_all"), F.ceil(F.sum(F.when(F.col("odd"), F.col("_size"))) / cell).cast("int").alias("_odd"),
    )
    rows = attach(rows.drop("_size"), sizes, ["key"], "inner", spread=["_text"], salts=4)
    at = F.xxhash64("_text")
    rows = rows.withColumns({"_own": F.pmod(at, F.col("_all")).cast("int"), "_out": F.when(F.col("odd"), F.pmod(at, F.col("_odd")).cast("int"))})
    cells = F.expr(
        "concat(transform(filter(sequence(0, _odd - 1), i -> NOT (odd AND i = _out)), i -> struct(i AS _i, _own AS _j, false AS odd)),"
        " transform(if(odd, sequence(0, _all - 1), array()), j -> struct(_out AS _i, j AS _j, true AS odd)))"
    )
    rows = rows.select("key", "_text", "class", "fingerprint", F.explode(cells).alias("_c")).select("key", "_text", "class", "fingerprint", "_c.*")
    return rows.join(sets, "_text").drop("_text")


def cell_pairs(opened: DataFrame, sets: DataFrame, bound: float, cell: int = CELL) -> DataFrame:
    """Links ``(a, b)`` of fingerprints that connect components across the open keys. Stored."""
    rows = _cells(opened, sets, cell).repartition(*_CELL).sortWithinPartitions(*_CELL)

    def emit(table):
        cols = [table.column(c).to_numpy() for c in _CELL]
        bounds = np.flatnonzero(np.concatenate(([True], np.any([np.diff(c) != 0 for c in cols], axis=0), [True])))
        lists = table.column("shingles").combine_chunks()
        odd, classes, names = (table.column(c).to_numpy() for c in ("odd", "class", "fingerprint"))
        found = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            own = [_set(lists, i) for i in range(a, b)]
            found += [(names[a + x], names[a + y]) for x, y in cell_links(own, classes[a:b], odd[a:b], bound)]
        left, right = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    def run(batches):
        rest = []
        for batch in batches:
            cols = [np.concatenate([rest[-1].column(c).to_numpy()[-1:] if rest else [], batch.column(c).to_numpy()]) for c in _CELL]
            change = np.flatnonzero(np.any([np.diff(c) != 0 for c in cols], axis=0))
            if len(change):  # a new cell begins in this batch
                last = int(change[-1]) + (0 if rest else 1)
                yield from emit(pa.Table.from_batches([*rest, batch.slice(0, last)]))
                rest, batch = [], batch.slice(last)
            if batch.num_rows:
                rest.append(batch)
        if rest:
            yield from emit(pa.Table.from_batches(rest))

    return store(rows.select(*_CELL, "odd", "class", "fingerprint", "shingles").mapInArrow(run, "a long, b long").distinct(), "cell-links")
