"""Periodic runs against brute force over all periods."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from corpus_fixture import SCHEMA, corpus, empty  # noqa: F401

from tissueframe.llm import periods, queries


def brute(words, least=24):
    """Runs ``(start, length, period)``: every stretch of every period, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= 2 * q:
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items() if e - s >= least)


def sequence(rng):
    n, letters = rng.randrange(160), rng.choice([1, 2, 2, 3, 5, 50])
    own = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(4) if n > 3 else 0):
        start, size = rng.randrange(n), rng.randrange(1, max(2, n // 3))
        block = own[start : start + size]
        kind = rng.random()
        if kind < 0.3:  # a highly periodic period
            block = [0] * (len(block) - 1) + [1]
        elif kind < 0.5 and len(block) > 4:
            block = (block[: len(block) // 5 + 1] * 6)[: len(block) - 1] + [9]
        times = rng.randrange(1, 8)
        own[start : start + len(block) * times] = block * times
    if rng.random() < 0.2:  # a Fibonacci sequence has many runs
        a, b = [0], [0, 1]
        while len(b) < 200:
            a, b = b, b + a
        own += b
    return own


@pytest.mark.parametrize("least", [0, 24])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    for _ in range(150):
        texts = [sequence(rng) for _ in range(rng.randrange(1, 6))]
        firsts = np.cumsum([0] + [len(t) for t in texts])
        words = np.array([w for t in texts for w in t], np.int64)
        expected = sorted((int(firsts[i]) + s, n, q) for i, t in enumerate(texts) for s, n, q in brute(t, least))
        assert sorted(map(tuple, periods.find_runs(words, firsts, least).tolist())) == expected


def test_synchronising_sets_are_consistent_and_dense():
    rng = np.random.default_rng(4)
    words = rng.integers(0, 3, 4000)
    words[2000:3000] = words[:1000]
    left = len(words) - np.arange(len(words))
    for scale in (4, 16, 64):
        places = periods.selected(periods.Prints(words), left, np.zeros(len(words), bool), scale)
        first, again = places[places < 1000 - 2 * scale], places[(places >= 2000) & (places < 3000 - 2 * scale)] - 2000
        assert first.tolist() == again.tolist()
        assert np.diff(places).max() <= scale and len(places) < 4 * len(words) / scale


def test_equal_fingerprints_of_unlike_words_are_found_out():
    words = np.array([0, 1] * 40 + [2] + [0, 1] * 40)
    firsts = np.array([0, len(words)])
    prints = periods.Prints(np.zeros(len(words), np.int64))  # agree everywhere
    before = np.arange(len(words))
    got = periods._grown(words, prints, np.array([[10, 2]]), before, len(words) - before)
    assert got.tolist() == [[0, 80, 2], [81, 161, 2]] and periods.find_runs(words, firsts).tolist() == [[0, 80, 2], [81, 80, 2]]


def rebuilt(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected_row(doc_id, text):
    words = rebuilt(doc_id, (text or "").encode().split())
    runs, gone = brute(words), set()
    for s, n, q in runs:
        gone.update(range(s + q, s + n))
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(None, None), (0, ""), (1, " \n"), (2, None), (3, "a " * 23), (4, "a " * 24), (4, "a " * 24), (5, "Ünï\x0bcode\x1fx " * 30)]
    rows += [(i, " ".join(f"w{x}" for x in sequence(rng))) for i in range(10, 140)]
    docs = spark.createDataFrame([(i, t, "en", "s", i) for i, t in rows], SCHEMA)
    docs.withColumnsRenamed({"lang": "runs", "source": "h", "n_chars": "words"}).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_synchronised_periods(spark, str(tmp_path)).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(expected_row(*r)) for r in rows)
    assert sum(r.n_runs > 0 for r in got) > 30


def test_long_text(spark):
    text = "x y z " * 400_000 + " ".join(map(str, range(300_000)))
    (row,) = periods.collapse_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [tuple(r) for r in row.runs] == [(0, 1_200_000, 3)] and row.kept_text.startswith("x y z 0 1 2") and row.n_words == 1_500_000


def test_empty_table(spark, empty):
    assert periods.collapse_runs(empty).columns == ["doc_id", "n_words", "runs", "strongest", "kept_text"]
    assert periods.collapse_runs(empty).count() == 0
