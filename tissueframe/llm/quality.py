"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words. Every passage is encoded
(character classes, word shapes, repetition and a random projection of its
words, followed by a learned layer), a gated attention learned from document
labels alone weighs the passages, and the weighted representation is scored.

Defined cases: a null or empty text, or one of separators only, is a bag with
one all-zero passage and so has a score; equal texts have equal scores; rows
with a null ``doc_id`` are scored, never learned from; labels that are null or
belong to no document are ignored; several labels of one document count as
several documents. Without any label to learn from every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tissueframe.llm.textops import Hasher, append, find_words, held_out, separator_table, slices

#: Words of a passage.
PASSAGE = 64
#: Dimensions of the random projection of a passage's words.
PROJECTED = 24
#: Labelled documents a model is fitted on at most (the first by a hash of the id).
SAMPLE = 4096
#: Passages of one document that training looks at; scoring reads all of them.
TRAIN_PASSAGES = 48

_CLASSES = ("upper", "lower", "digit", "symbol", "mark", "stop", "other", "space")


def _class_table() -> np.ndarray:
    table = np.full(256, _CLASSES.index("other"), np.int64)
    table[ord("A") : ord("Z") + 1] = 0
    table[ord("a") : ord("z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[ord(c) for c in "#*$%&|<>=_~^@{}[]\\/+"]] = 3
    table[[ord(c) for c in "!?"]] = 4
    table[[ord(c) for c in ".,;:'\"()-"]] = 5
    table[[9, 10, 11, 12, 13, 32]] = 7
    return table


WIDTH = len(_CLASSES) + 8 + PROJECTED


class Encoder:
    """Passage features of a slice of documents."""

    def __init__(self, passage: int = PASSAGE):
        self.passage = passage
        self.classes, self.separators, self.hasher = _class_table(), separator_table(), Hasher()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features ``(passages, WIDTH)`` and the first passage of every document (one more at the end)."""
        starts, ends, firsts = find_words(data, offsets, self.separators)
        counts = np.diff(firsts)
        bags = np.maximum(1, -(-counts // self.passage))
        bounds = np.concatenate(([0], np.cumsum(bags)))
        out = np.zeros((bounds[-1], WIDTH), np.float32)
        if len(starts) == 0:
            return out, bounds
        local = np.arange(len(starts)) - np.repeat(firsts[:-1], counts)
        owner = np.repeat(bounds[:-1], counts) + local // self.passage
        heads = np.flatnonzero(np.diff(owner, prepend=-1))
        rows = owner[heads]
        n = np.diff(np.append(heads, len(starts))).astype(np.float32)
        # Bytes of a passage: from its first word to the next passage or its last word's end.
        begin = starts[heads]
        finish = ends[np.append(heads[1:], len(starts)) - 1]
        kinds = self.classes[data]
        size = np.maximum(finish - begin, 1).astype(np.float32)
        for k in range(len(_CLASSES)):
            sums = np.concatenate(([0], np.cumsum(kinds == k)))
            out[rows, k] = (sums[finish] - sums[begin]) / size
        words = self.hasher(data, starts, ends)
        lengths = (ends - starts).astype(np.float32)
        same = np.append(False, (words[1:] == words[:-1]) & (owner[1:] == owner[:-1]))
        order = np.lexsort((words, owner))
        repeated = np.zeros(len(words), bool)
        repeated[order[1:]] = (words[order[1:]] == words[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        tail = kinds[ends - 1]
        at = len(_CLASSES)
        shapes = (
            np.minimum(lengths, 40) / 10, np.minimum(lengths, 40) ** 2 / 400, same, repeated, lengths == 1,
            (tail == 3) | (tail == 4), kinds[starts] == 0,
        )
        for k, values in enumerate(shapes):
            out[rows, at + k] = np.add.reduceat(np.asarray(values, np.float32), heads) / n
        out[rows, at + len(shapes)] = np.log1p(n) / 4
        at += len(shapes) + 1
        for k in range(PROJECTED):
            sign = ((words >> np.uint64(k)) & np.uint64(1)).astype(np.float32) * 2 - 1
            out[rows, at + k] = np.add.reduceat(sign, heads) / n
        return out, bounds


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class AttentionModel:
    """Learned layer, gated attention and score, as plain arrays."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = weights

    def forward(self, x: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
        w, heads, bags = self.w, bounds[:-1], np.diff(bounds)
        x = np.clip((x - w["mean"]) / w["scale"], -8, 8)
        h = np.tanh(x @ w["W"] + w["b"])
        t, g = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
        a = (t * g) @ w["a"]
        a = np.exp(a - np.repeat(np.maximum.reduceat(a, heads), bags))
        a /= np.repeat(np.add.reduceat(a, heads), bags)
        z = np.add.reduceat(a[:, None] * h, heads)
        return {"x": x, "h": h, "t": t, "g": g, "a": a, "z": z, "p": _sigmoid(z @ w["c"] + w["d"])}

    def backward(self, f: dict, bounds: np.ndarray, error: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the log loss; ``error`` is score minus label by document."""
        w, bags = self.w, np.diff(bounds)
        out = {"c": f["z"].T @ error, "d": error.sum(keepdims=True)}
        dz = np.repeat(error[:, None] * w["c"], bags, 0)
        da = (dz * f["h"]).sum(1)
        centre = np.repeat(np.add.reduceat(da * f["a"], bounds[:-1]), bags)
        ds = f["a"] * (da - centre)
        out["a"] = (f["t"] * f["g"]).T @ ds
        dt = ds[:, None] * w["a"] * f["g"] * (1 - f["t"] ** 2)
        dg = ds[:, None] * w["a"] * f["t"] * f["g"] * (1 - f["g"])
        out["V"], out["U"] = f["h"].T @ dt, f["h"].T @ dg
        dh = (f["a"][:, None] * dz + dt @ w["V"].T + dg @ w["U"].T) * (1 - f["h"] ** 2)
        out["W"], out["b"] = f["x"].T @ dh, dh.sum(0)
        return out


def fit(x: np.ndarray, bounds: np.ndarray, labels: np.ndarray, epochs: int = 40, hidden: int = 16, seed: int = 11) -> AttentionModel:
    """Fit by Adam on minibatches of documents; deterministic for equal input."""
    rng = np.random.default_rng(seed)
    start = {
        "mean": x.mean(0), "scale": x.std(0) + 0.02,
        "W": rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, hidden)), "b": np.zeros(hidden),
        "V": rng.normal(0, 0.3, (hidden, hidden)), "U": rng.normal(0, 0.3, (hidden, hidden)),
        "a": rng.normal(0, 0.3, hidden), "c": rng.normal(0, 0.3, hidden), "d": np.zeros(1),
    }
    model = AttentionModel({k: v.astype(np.float32) for k, v in start.items()})
    learned = [k for k in start if k not in ("mean", "scale")]
    first = {k: np.zeros_like(model.w[k]) for k in learned}
    second = {k: np.zeros_like(model.w[k]) for k in learned}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), 64):
            own = order[at : at + 64]
            sizes = bounds[own + 1] - bounds[own]
            part = np.concatenate(([0], np.cumsum(sizes)))
            rows = np.arange(part[-1]) + np.repeat(bounds[own] - part[:-1], sizes)
            f = model.forward(x[rows], part)
            grads = model.backward(f, part, (f["p"] - labels[own]) / len(own))
            step += 1
            rate = 0.01 * (1 - epoch / epochs) + 0.0005
            for k in learned:
                g = grads[k] + (1e-4 * model.w[k] if k not in ("b", "d") else 0)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                model.w[k] = (model.w[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionModel | None:
    """A model from at most ``sample`` labelled documents outside the held-out third; None without labels.

    The sample is the labels whose ids have the smallest hashes, so it does not
    depend on file order. Its ids are at most ``sample`` rows and are broadcast;
    what comes back is bounded by ``sample * TRAIN_PASSAGES`` passages.
    """
    own = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("double").alias("_label"))
    own = own.where(~held_out(F.col("_id")) & F.col("_id").isNotNull() & F.col("_label").isin(0.0, 1.0))
    chosen = own.orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample).collect()
    if not chosen:
        return None
    spark = docs.sparkSession
    chosen = spark.createDataFrame([(r[0], r[1]) for r in chosen], own.schema)
    bags = docs.select(F.col("doc_id").alias("_id"), "text").join(F.broadcast(chosen), "_id")

    def run(batches):
        encode = Encoder()
        for batch in batches:
            for part, data, offsets in slices(batch):
                x, bounds = encode(data, offsets)
                bytes_of = []
                for i in range(part.num_rows):
                    bag = x[bounds[i] : bounds[i + 1]]
                    if len(bag) > TRAIN_PASSAGES:  # evenly over the document
                        bag = bag[np.linspace(0, len(bag) - 1, TRAIN_PASSAGES).astype(int)]
                    bytes_of.append(bag.astype(np.float32).tobytes())
                ids, given = (part.column(part.schema.get_field_index(c)) for c in ("_id", "_label"))
                yield pa.RecordBatch.from_arrays([ids, given, pa.array(bytes_of, pa.binary())], names=["_id", "_label", "bag"])

    schema = bags.select("_id", "_label").withColumn("bag", F.lit(b"").cast("binary")).schema
    # Several rows may share an id; of those the smallest bag stands for the label.
    rows = bags.mapInArrow(run, schema).groupBy("_id", "_label").agg(F.min("bag").alias("bag")).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["_id"], r["_label"]))
    parts = [np.frombuffer(r["bag"], np.float32).reshape(-1, WIDTH) for r in rows]
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return fit(np.concatenate(parts), bounds, np.array([r["_label"] for r in rows], np.float32))


def score(docs: DataFrame, model: AttentionModel | None, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the probability of label 1. Whole texts, map-only."""

    def kernel():
        encode = Encoder()

        def compute(data, offsets):
            if model is None:
                return (pa.array(np.full(len(offsets) - 1, 0.5)),)
            x, bounds = encode(data, offsets)
            return (pa.array(model.forward(x, bounds)["p"].astype(np.float64)),)

        return compute

    return append(docs, f"`{name}` double", kernel)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents that a model fitted on ``labels`` scores at ``threshold`` or more, with their columns."""
    kept = [F.col(f"`{c}`") for c in docs.columns]
    name = "_quality"
    while name in docs.columns:
        name += "_"
    return score(docs, train(docs, labels), name).where(F.col(name) >= threshold).select(*kept)
