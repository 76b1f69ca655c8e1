"""Near copies of the pipeline against brute-force Jaccard similarity."""

import random
from functools import partial

import numpy as np
import pytest
from corpus_fixture import SCHEMA, prose

import corpus_pipeline
from tissueframe.llm import similar, simhash


def shingle_set(text):
    own = (text or "").encode().lower().split()
    size = min(5, len(own))
    return {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a and b else 0.0


def changed(rng, text, n):
    own = text.split(" ")
    for _ in range(n):
        own[rng.randrange(len(own))] = f"new{rng.randrange(999)}"
    return " ".join(own)


def make(seed=8):
    rng = random.Random(seed)
    texts = []
    for _ in range(60):
        base = prose(rng, rng.randrange(60, 400)) + f" {rng.random()}"
        texts.append(base)
        for _ in range(rng.randrange(1, 6)):  # drifting chains and stars
            source = rng.choice([base, texts[-1]])
            texts.append(changed(rng, source, rng.randrange(1, 2 + len(source.split()) // 50)))
    texts += ["one two", "one two", "One  two", "three", "", None, " \n", "a b c d", "a b c d e"]
    return [(i, t, "en", "s", None) for i, t in enumerate(texts)]


def components(rows):
    """Component of each row by all pairs, and how many pairs lie in each band of similarity."""
    sets = [shingle_set(r[1]) for r in rows]
    values = [simhash.fingerprint((r[1] or "").encode()) for r in rows]
    label, bands = list(range(len(rows))), {b: 0 for b in (0, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)}

    def find(v):
        while label[v] != v:
            v = label[v]
        return v

    for i in range(len(rows)):
        for j in range(i):
            s = similarity(sets[i], sets[j])
            bands[max((b for b in bands if s >= b), default=0)] += 1
            if s >= corpus_pipeline.COPY_SIMILAR or (values[i] ^ values[j]).bit_count() <= corpus_pipeline.COPY_BITS:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(rows))], bands


def kept_ids(spark, rows):
    return sorted(r.doc_id for r in corpus_pipeline.drop_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect())


def test_copies_equal_brute_force(spark):
    rows = make()
    label, bands = components(rows)
    assert min(n for b, n in bands.items() if b >= 0.8) >= 20
    assert kept_ids(spark, rows) == sorted(set(label))


def hot(n, seed=4, words=120, most=7):
    """Copies of one text, each with a few words changed, so that pairs are similar in all degrees."""
    rng = random.Random(seed)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(words))
    return [(i, changed(rng, base, rng.randrange(1, most)) if i else base + " end", "en", "s", None) for i in range(n)]


@pytest.mark.parametrize("cell, dealt", [(similar.CELL, similar.DEALT), (3000, 7)])
def test_hot_group_equals_brute_force(spark, monkeypatch, cell, dealt):
    monkeypatch.setattr(simhash, "cell_pairs", partial(similar.cell_pairs, cell=cell))
    monkeypatch.setattr(similar, "DEALT", dealt)
    rows = hot(300)
    rows += [(300 + i, t, *r) for i, (_, t, *r) in enumerate(hot(60, 5, 90, 12))] + make(9)[:40]
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    label, bands = components(rows)
    assert min(bands[b] for b in (0.7, 0.75, 0.8, 0.85, 0.9)) >= 100 and len(set(label)) > 40
    assert kept_ids(spark, rows) == sorted(set(label))


def test_rows_grow_with_a_group_and_not_its_square(spark):
    """Of a group whose texts lie just outside the bound no row is made for a pair."""
    made = {}
    for n in (100, 200, 400):
        rng = random.Random(1)
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(120))
        rows = [(i, changed(rng, base, 4), "en", "s", None) for i in range(n)]
        docs = spark.createDataFrame(rows, SCHEMA)
        light = simhash._light_bands(docs, simhash.WIDTH)
        shared = similar.members(light)
        sets = similar.shingle_sets(docs.select(similar.F.xxhash64("text").alias("_text"), "text"), shared)
        opened = similar.open_keys(shared, spark.createDataFrame([], "fingerprint long, class long"))
        heads, cells = similar.head_pairs(shared, 3).count(), similar._cells(opened, sets, similar.CELL).count()
        made[n] = (heads, cells)
        assert heads <= similar.BANDS * n and cells <= similar.BANDS * n
    assert made[400][0] < 6 * made[100][0] and made[400][1] < 6 * made[100][1]


def test_cell_links():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = int(rng.integers(2, 12))
        sets = [np.unique(rng.integers(0, 40, int(rng.integers(1, 40))).astype(np.uint64)) for _ in range(n)]
        odd = rng.random(n) < 0.6
        links = similar.cell_links(sets, np.arange(n), odd, 0.6)
        left, right = np.array(links, np.int64).reshape(-1, 2).T
        got = simhash.forest(n, left, right)
        pairs = [(i, j) for i in range(n) for j in range(i) if (odd[i] or odd[j]) and similar.jaccard(sets[i], sets[j]) >= 0.6]
        left, right = np.array(pairs, np.int64).reshape(-1, 2).T
        assert got.tolist() == simhash.forest(n, left, right).tolist() and len(links) == n - len(set(got.tolist()))


def test_bands_of_pairs():
    """Pairs at the bound share a band about as often as the docstring says."""
    rng = np.random.default_rng(6)
    found = 0
    for _ in range(300):
        both = rng.integers(1, 1 << 63, 160).astype(np.uint64)
        a, b = (np.concatenate([both, rng.integers(1, 1 << 63, 20).astype(np.uint64)]) for _ in range(2))
        keys = similar.band_keys(np.concatenate([a, b]), np.array([0, 180, 360]))
        found += bool((keys[0] == keys[1]).any())
    assert found >= 299
