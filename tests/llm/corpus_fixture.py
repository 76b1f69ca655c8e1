import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "en": "the of and that with from river stone winter letter garden answer window market bridge simple number".split(),
    "de": "der die und nicht fluss stein garten antwort fenster markt einfach zahl über straße möglich".split(),
    "fr": "le la et que rivière pierre jardin réponse fenêtre marché simple nombre toujours étoile".split(),
}


def prose(rng, n, lang="en"):
    return " ".join(rng.choice(WORDS[lang]) + ("x" * (rng.random() < 0.1)) + str(rng.randrange(50)) * (rng.random() < 0.05) for _ in range(n))


def make_corpus(n=120, seed=5):
    """Documents with copies, near copies, repeated lines and passages, nulls, empty and long texts."""
    rng = random.Random(seed)
    shared = [prose(rng, 30) for _ in range(3)]
    lines = [prose(rng, k) for k in (2, 4, 6, 9)]
    rows = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        kind = rng.random()
        if kind < 0.12 and rows:
            text = rng.choice(rows)[1]
        elif kind < 0.25 and rows and rng.choice(rows)[1]:
            base = (rng.choice([r[1] for r in rows if r[1]])).split(" ")
            base[rng.randrange(len(base))] = "changed"
            text = " ".join(base)
        else:
            parts = [prose(rng, rng.randrange(1, 60), lang) for _ in range(rng.randrange(1, 6))]
            if rng.random() < 0.3:
                parts.insert(rng.randrange(len(parts) + 1), rng.choice(shared))
            for _ in range(rng.randrange(4)):
                parts.insert(rng.randrange(len(parts) + 1), rng.choice(lines))
            text = "\n".join(parts)
        rows.append((i, text, lang, f"s{rng.randrange(4) if rng.random() < 0.7 else 0}", len(text or "")))
    rows += [
        (n, None, "en", "s1", None), (n + 1, "", None, None, 0), (n + 2, " \t\n ", "en", "s1", 4), (n + 3, "word", "fr", "s2", 4),
        (n + 4, prose(rng, 6000), "en", "s0", None), (None, prose(rng, 40), "en", "s0", None), (None, None, None, None, None),
        (n + 5, "Ünï\x0bcode\x1fword   x", "de", "s3", None), rows[3], rows[3],
    ]
    return rows


@pytest.fixture(scope="session")
def corpus(spark):
    rows = make_corpus()
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
