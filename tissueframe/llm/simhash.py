"""Near-duplicate documents by SimHash and a binary trie self-join.

A fingerprint has a bit set where more than half of the 64-bit hashes of a
document's shingles have it. Equal fingerprints collapse to one first. The
trie of fingerprints is then joined with itself: pairs of nodes go down
together, differing bits add up, and a pair ends when they exceed the budget.

To deal the traversal over a cluster, ``budget + 1`` tries are built, each over
the fingerprint rotated by one block of bits; a pair within the budget agrees
on at least one block, so each trie starts at its nodes one block deep and
these subtrees are independent. A subtree of more than ``UNIT`` fingerprints is
split further into pairs of child nodes within the budget, again and again, so
no task meets a large cluster of near copies whole. What a task finds it
returns as a spanning forest: as many links as fingerprints at most, and no
connection is lost.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; texts of fewer words than a shingle have one shingle, the whole
sequence; rows of one ``doc_id`` are linked by their texts only; a null
``doc_id`` comes after every other id, and a group of nulls has a null
component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.llm.similar import WIDTH as SHINGLE
from tissueframe.llm.similar import band_lists, cell_pairs, confirm, head_pairs, main_pairs, members, open_keys, shingle_sets, shingler
from tissueframe.llm.textops import append
from tissueframe.plans.components import connected_components
from tissueframe.plans.lineage import store
from tissueframe.plans.skew import attach

WIDTH = 3
BUDGET = 2
SEED = 42
#: Fingerprints of a subtree that one call joins; larger subtrees are split.
UNIT = 1024
#: Bits by which a large subtree is split at once.
STEP = 4

_LAST = (1 << 63) - 1
_BLOCK = 1 << 15


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """SimHash of one text; only ASCII letters are lower-cased."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    width = min(width, len(words))
    firsts, lasts = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(firsts), _BLOCK):
        spans = zip(firsts[at : at + _BLOCK], lasts[at : at + _BLOCK])
        values = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
        ones += np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(firsts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH, seed: int = SEED, name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit column. Map-only."""

    def kernel():
        def compute(data, offsets):
            raw = data.tobytes()
            values = [fingerprint(raw[a:b], width, seed) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            return (pa.array(np.array(values, np.uint64).view(np.int64)),)

        return compute

    return append(docs, f"`{name}` long", kernel)


def trie_links(values: np.ndarray, units: list[tuple[int, int, int]], budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indices within ``budget`` differing bits.

    ``values`` are distinct and ascending inside each unit's ranges. A unit
    ``(l, m, h)`` joins ``[l, m)`` with ``[m, h)``, or ``[l, h)`` with itself
    where ``m == h``. All units go down the trie together, one bit a round.
    """
    bounds = np.array(units, np.int64).reshape(-1, 3)
    own = bounds[:, 1] == bounds[:, 2]
    loops = bounds[own][:, [0, 2]]
    pairs = np.column_stack([bounds[~own][:, [0, 1, 1, 2]], np.zeros((~own).sum(), np.int64)])
    found = []
    for bit in range(63, -1, -1):
        lone = (pairs[:, 1] - pairs[:, 0] == 1) & (pairs[:, 3] - pairs[:, 2] == 1)
        if lone.any():
            left, right = pairs[lone, 0], pairs[lone, 2]
            near = np.bitwise_count(values[left] ^ values[right]) <= budget
            found.append(np.stack([left[near], right[near]]))
            pairs = pairs[~lone]
        loops = loops[loops[:, 1] - loops[:, 0] > 1]
        if not len(loops) and not len(pairs):
            break
        ones = np.concatenate(([0], np.cumsum((values >> np.uint64(bit)) & np.uint64(1), dtype=np.int64)))

        def middle(low, high):
            return high - (ones[high] - ones[low])

        a, b = loops[:, 0], loops[:, 1]
        m = middle(a, b)
        grown = [np.column_stack([a, m, m, b, np.ones(len(a), np.int64)])]
        loops = np.concatenate([np.column_stack([a, m]), np.column_stack([m, b])])
        ul, uh, vl, vh, spent = pairs.T
        um, vm = middle(ul, uh), middle(vl, vh)
        for x, y, z, w, more in ((ul, um, vl, vm, 0), (um, uh, vm, vh, 0), (ul, um, vm, vh, 1), (um, uh, vl, vm, 1)):
            grown.append(np.column_stack([x, y, z, w, spent + more]))
        pairs = np.concatenate(grown)
        pairs = pairs[(pairs[:, 4] <= budget) & (pairs[:, 0] < pairs[:, 1]) & (pairs[:, 2] < pairs[:, 3])]
    if len(pairs):  # down at the leaves
        found.append(np.stack([pairs[:, 0], pairs[:, 2]]))
    links = np.concatenate(found, 1) if found else np.empty((2, 0), np.int64)
    return links[0], links[1]


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest index of the component of each of ``n`` points."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        fresh = label.copy()
        np.minimum.at(fresh, left, low)
        np.minimum.at(fresh, right, low)
        np.minimum.at(fresh, label[left], low)
        np.minimum.at(fresh, label[right], low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


_UNIT = ["trie", "depth", "u", "v"]


def _blocks(budget: int) -> list[tuple[int, int]]:
    """Shift and width of the leading block of each rotation."""
    edges = [round(64 * i / (budget + 1)) for i in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _subtrees(nodes: DataFrame, budget: int) -> DataFrame:
    """Every fingerprint in the subtree one block deep of each rotated trie."""
    places = []
    for trie, (shift, width) in enumerate(_blocks(budget)):
        value = F.shiftleft("fingerprint", shift).bitwiseOR(F.shiftrightunsigned("fingerprint", 64 - shift)) if shift else F.col("fingerprint")
        node = F.shiftrightunsigned(value, 64 - width)
        places.append(F.struct(
            F.lit(trie).alias("trie"), F.lit(width).alias("depth"), node.alias("u"), node.alias("v"),
            F.lit(0).alias("spent"), F.lit(0).alias("side"), value.alias("value"),
        ))
    return nodes.select(F.explode(F.array(*places)).alias("_p")).select("_p.*")


def _split(rows: DataFrame, budget: int) -> DataFrame:
    """Rows of large subtree pairs, moved to the pairs of child nodes within the budget."""
    step = F.least(F.lit(STEP), 64 - F.col("depth"))
    own = F.shiftrightunsigned(F.expr("shiftleft(value, depth)"), 64 - STEP)  # the bits below the node
    rows = rows.withColumns({"_own": own.cast("int"), "_step": step})
    rows = rows.withColumn("_own", F.expr(f"shiftright(_own, {STEP} - _step)"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.expr("shiftleft(1, _step) - 1"))))
    rows = rows.withColumn("spent", F.col("spent") + F.bit_count(F.col("_own").bitwiseXOR(F.col("_other")))).where(F.col("spent") <= budget)
    same = F.col("u") == F.col("v")
    first = F.when(same, F.least("_own", "_other")).when(F.col("side") == 0, F.col("_own")).otherwise(F.col("_other"))
    second = F.when(same, F.greatest("_own", "_other")).when(F.col("side") == 0, F.col("_other")).otherwise(F.col("_own"))
    side = F.when(same, (F.col("_own") > F.col("_other")).cast("int")).otherwise(F.col("side"))
    rows = rows.withColumns({"side": side, "_u": F.expr("shiftleft(u, _step)") + first, "_v": F.expr("shiftleft(v, _step)") + second})
    return rows.select("trie", (F.col("depth") + F.col("_step")).alias("depth"), F.col("_u").alias("u"), F.col("_v").alias("v"), "spent", "side", "value")


def _units(nodes: DataFrame, budget: int, unit: int) -> DataFrame:
    """Subtree pairs of at most ``unit`` fingerprints (or single ones) that cover the traversal."""
    rows, done, split = _subtrees(nodes, budget), [], False
    while True:
        sizes = rows.groupBy(*_UNIT).agg(F.count("*").alias("_n"), (F.max("side") - F.min("side")).alias("_s"))
        sizes = sizes.where("_n > 1 AND (u = v OR _s = 1)").select(*_UNIT, (F.col("_n") > unit).alias("_large"))
        # After a split most pairs of child nodes have an empty side and end here.
        sizes = store(sizes if split else sizes.where("_large"), "subtrees")
        if sizes.where("_large").isEmpty() and not split:
            done.append(rows)
            break
        # One row per subtree on the right; the rows of a subtree are dealt over salted partitions.
        marked = store(attach(rows, sizes, _UNIT, "inner" if split else "left", spread=["value"]), "subtree-rows")
        done.append(marked.where("_large IS NOT TRUE").drop("_large"))
        rows, split = _split(marked.where("_large").drop("_large"), budget), True
        if marked.where("_large").isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def near_links(nodes: DataFrame, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """A spanning forest ``(a, b)`` of the pairs of distinct ``fingerprint`` within ``budget`` bits."""
    rows = _units(nodes, budget, unit).repartition(*_UNIT).sortWithinPartitions(*_UNIT, "side")
    shifts = [shift for shift, _ in _blocks(budget)]

    def join(key, side, value):
        order = np.lexsort((value, side, key))
        key, side, value = key[order], side[order], value[order]
        heads = np.flatnonzero(np.diff(key, prepend=-1))
        ends = np.append(heads[1:], len(key))
        right = np.add.reduceat(side, heads)
        units = [(a, b - r, b) for a, b, r in zip(heads.tolist(), ends.tolist(), right.tolist()) if b - a > 1]
        if not units:
            return value[:0], value[:0]
        left, right = trie_links(value, units, budget)
        root = forest(len(value), left, right)
        inner = np.flatnonzero(root != np.arange(len(value)))
        return value[root[inner]], value[inner]

    def run(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            cols = [rest.column(c).to_numpy() for c in _UNIT]
            change = np.any([np.diff(c) != 0 for c in cols], axis=0)
            last = int(np.flatnonzero(change)[-1]) + 1 if change.any() else 0
            if last:
                yield from emit(rest.slice(0, last))
                rest = rest.slice(last)
        if rest is not None and rest.num_rows:
            yield from emit(rest)

    def emit(table):
        cols = [table.column(c).to_numpy() for c in _UNIT]
        key = np.concatenate(([0], np.cumsum(np.any([np.diff(c) != 0 for c in cols], axis=0))))
        tries = table.column("trie").to_numpy()
        value = np.ascontiguousarray(table.column("value").to_numpy()).view(np.uint64)
        side = table.column("side").to_numpy().astype(np.int64)
        for trie in np.unique(tries):
            own = tries == trie
            pair = join(key[own], side[own], value[own])
            shift = np.uint64(shifts[trie])
            back = [(x >> shift) | (x << (np.uint64(64) - shift)) if shift else x for x in pair]
            yield pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in back], names=["a", "b"])

    return rows.select(*_UNIT, "side", "value").mapInArrow(run, "a long, b long")


def _labels(links: DataFrame) -> DataFrame:
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return connected_components(ends, links).withColumnsRenamed({"id": "fingerprint", "component": "class"})


def _similar_labels(links: DataFrame, light: DataFrame, texts: DataFrame, budget: int, bound: float) -> DataFrame:
    """Components of ``links`` and of all pairs of texts at least ``bound`` similar."""
    shared = members(light)
    sets = shingle_sets(texts, shared, SHINGLE)
    done = store(head_pairs(shared, budget), "head-pairs")
    links = links.unionByName(confirm(sets, done, bound))
    opened = open_keys(shared, _labels(links))
    if not opened.isEmpty():
        links = links.unionByName(confirm(sets, store(main_pairs(opened, done), "main-pairs"), bound))
        opened = open_keys(shared, _labels(links))
    return _labels(links.unionByName(cell_pairs(opened, sets, bound)))


def classes(light: DataFrame, budget: int = BUDGET, unit: int = UNIT, texts: DataFrame | None = None, bound: float = 1.0) -> DataFrame:
    """Class of every distinct fingerprint: ``(fingerprint, class, smallest)``.

    With ``texts`` (``_text, text``) given, fingerprints of texts at least ``bound`` similar are linked as well.

    ``light`` has ``_doc`` (never null) and ``fingerprint``; ``smallest`` is the
    smallest ``_doc`` of the class, which is named by its smallest fingerprint.
    """
    nodes = store(light.groupBy("fingerprint").agg(F.min("_doc").alias("_doc")), "fingerprints")
    links = store(near_links(nodes.select("fingerprint"), budget, unit).distinct(), "near-links")
    labels = _labels(links) if texts is None else _similar_labels(links, light, texts, budget, bound)
    named = store(nodes.join(labels, "fingerprint", "left").withColumn("class", F.coalesce("class", "fingerprint")), "classes")
    least = named.groupBy("class").agg(F.min("_doc").alias("smallest"))
    return store(attach(named, least, ["class"], spread=["fingerprint"]).select("fingerprint", "class", "smallest"), "classes")


def _light(docs: DataFrame, width: int, named: bool = False) -> DataFrame:
    """Fingerprints by ``_doc``; ``named``: with a hash that names the text."""
    rows = fingerprints(docs.select("doc_id", "text"), width)
    least = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("_doc")
    return store(rows.select("doc_id", least, "fingerprint", *([F.xxhash64("text").alias("_text")] if named else [])), "simhash")


def _light_bands(docs: DataFrame, width: int) -> DataFrame:
    """As :func:`_light`, with a hash that names the text and its similarity bands."""

    def kernel():
        shingles = shingler()

        def compute(data, offsets):
            raw = data.tobytes()
            values = [fingerprint(raw[a:b], width) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            return pa.array(np.array(values, np.uint64).view(np.int64)), band_lists(*shingles(data, offsets))

        return compute

    rows = append(docs.select("doc_id", "text"), "fingerprint long, _bands array<long>", kernel)
    least = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("_doc")
    return store(rows.select("doc_id", least, "fingerprint", F.xxhash64("text").alias("_text"), "_bands"), "simhash")


def near_duplicates(docs: DataFrame, width: int = WIDTH, budget: int = BUDGET, unit: int = UNIT) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex) and ``component_id``, the smallest id reachable."""
    light = _light(docs, width)
    rows = attach(light, classes(light, budget, unit), ["fingerprint"], spread=["_doc"])
    return rows.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.when(F.col("smallest") != _LAST, F.col("smallest")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, width: int = WIDTH, budget: int = BUDGET, unit: int = UNIT, bound: float | None = None) -> DataFrame:
    """The document of smallest id of every class, with the columns of ``docs``; repeated rows become one.

    With ``bound`` given, documents whose 5-word shingles have a Jaccard similarity of at least ``bound`` are linked as well.
    """
    inner = {c: f"_own{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    own = docs.select(*[F.col(f"`{c}`").alias(inner.get(c, c)) for c in docs.columns])
    if bound is None:
        light = _light(own, width, named=True)
        named = classes(light, budget, unit)
    else:
        light = _light_bands(own, width)
        named = classes(light, budget, unit, own.select(F.xxhash64("text").alias("_text"), "text").where("text IS NOT NULL"), bound)
    found = attach(light.drop("_bands"), named, ["fingerprint"], spread=["_doc"])
    # Of a class only rows with its smallest id come here; of these the text of the smallest fingerprint and hash stays.
    stay = found.where(F.col("_doc") == F.col("smallest")).groupBy("class", "_doc").agg(F.min(F.struct("fingerprint", "_text")).alias("_one"))
    rows = own.withColumns({"_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)), "_text": F.xxhash64("text")})
    rows = rows.join(stay.select("_doc", "_one._text"), ["_doc", "_text"]).dropDuplicates(["_doc", "_text"])
    return rows.select(*[F.col(inner.get(c, c)).alias(c) for c in docs.columns])
