"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader (FTRL-proximal) updates.

Features of a text: its words (punctuation runs apart from letters; a word
that repeats one of the two before it counts as one common "repeated" word),
word pairs and two shape marks (size of the text, share of repeated words),
hashed into ``2**bits`` places. An n-gram counts
``1 / sqrt(number of n-grams)`` per occurrence, so a score is a sparse dot
product: weights gathered by place and summed per text.

Training runs on at most ``max_train`` labelled rows (those of the smallest
hash of their id; a documented bound, so that the rows of a shard fit one
task). They are dealt over ``shards``; each shard makes ``epochs`` FTRL passes
over its rows and the shards' weights are averaged. The model has ``2**bits``
weights however large the corpus is. Scoring is one pass over the documents
without a shuffle.

Defined results: null and empty texts are scored by their shape marks alone;
an id labelled more than once takes the majority (a tie counts as 1); labels
that are null, and documents without an id, are not learned from; without any
label every score is 0.5. Repeated rows are scored once per row. Columns
other than the named ones are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridsense.llm.tables import map_rows
from gridsense.llm.words import mix, ngrams, word_hashes

BITS = 18
MAX_TRAIN = 20_000
SHARDS = 8
EPOCHS = 4
# FTRL-proximal: learning rate, its smoothing, and L1 / L2 strength.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.05

REPEATED = np.uint64(0x5A5A5A5A5A5A5A5A)  # stands for a word that repeats one of the two before

# Letters, digits and non-ASCII bytes form one kind of word; the other
# visible bytes form words of their own, told apart by a space put between.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def _spaced(text: str | None) -> str:
    """The text with a space wherever letters meet punctuation."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    if len(data) < 2:
        return text or ""
    letter = _LETTER[data]
    meets = np.flatnonzero((letter[1:] != letter[:-1]) & (data[1:] > 32) & (data[:-1] > 32)) + 1
    return np.insert(data, meets, 32).tobytes().decode()


def features(texts, bits: int = BITS):
    """``(places, values, offsets)`` of the sparse vectors of ``texts``."""
    flat, off = word_hashes(map(_spaced, texts))
    n = np.diff(off)
    docs = np.repeat(np.arange(len(n)), n)
    last = np.zeros(len(flat), bool)
    last[off[1:][n > 0] - 1] = True
    same = np.zeros(len(flat), bool)
    for k in (1, 2):
        same[k:] |= (flat[k:] == flat[:-k]) & (docs[k:] == docs[:-k])
    flat = np.where(same, REPEATED, flat)
    pairs = np.zeros(len(flat), np.uint64)
    if len(flat) > 1:
        pairs[:-1] = ngrams(flat, 2)
    repeats = np.bincount(docs, same, len(n)) / np.maximum(n, 1)
    shape = np.stack([np.floor(2 * np.log2(n + 1)).astype(np.uint64) + np.uint64(1 << 20),
                      np.ceil(10 * repeats).astype(np.uint64) + np.uint64(1 << 21)], 1)
    mask = np.uint64((1 << bits) - 1)
    per = np.maximum(2 * n - 1, 0) + 2
    out = np.concatenate([[0], np.cumsum(per)])
    places = np.empty(out[-1], np.int64)
    values = np.empty(out[-1])
    # Words first, then pairs, then the two marks of each text.
    at = np.arange(len(flat)) - off[docs] if len(flat) else np.empty(0, np.int64)
    value = 1 / np.sqrt(np.maximum(2 * n - 1, 1))
    pos = out[docs] + at if len(flat) else at
    places[pos] = (mix(flat) & mask).astype(np.int64)
    values[pos] = value[docs]
    two = ~last
    pos2 = out[docs[two]] + n[docs[two]] + at[two]
    places[pos2] = (pairs[two] & mask).astype(np.int64)
    values[pos2] = value[docs[two]]
    ends = out[1:]
    for k in (0, 1):
        places[ends - 2 + k] = (mix(shape[:, k]) & mask).astype(np.int64)
        values[ends - 2 + k] = 0.5
    return places, values, out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def ftrl(rows, size: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` FTRL-proximal passes over ``rows``, a list of
    (places, values, label)."""
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    rows = [(*_summed(i, x), y) for i, x, y in rows]
    for _ in range(epochs):
        for i, x, y in rows:
            w = weights(i)
            g = (_sigmoid(w @ x) - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
    return weights(np.arange(size))


def _summed(places, values):
    """One entry per place."""
    i, back = np.unique(places, return_inverse=True)
    return i, np.bincount(back, values)


def train(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "quality",
          bits: int = BITS, max_train: int = MAX_TRAIN, shards: int = SHARDS) -> np.ndarray:
    """The weights learned from the rows of ``docs`` that ``labels`` names."""
    marked = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
              .groupBy(F.col(key).alias("k")).agg((F.avg(label) >= 0.5).cast("double").alias("y"))
              .orderBy(F.xxhash64("k"), "k").limit(max_train))

    def vectors():
        def run(texts):
            places, values, off = features(texts, bits)
            return ([places[s:e] for s, e in zip(off, off[1:])], [values[s:e] for s, e in zip(off, off[1:])])
        return run

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("h")
        w = ftrl(list(zip(pdf["i"], pdf["x"], pdf["y"])), 1 << bits)
        i = np.flatnonzero(w)
        return pd.DataFrame({"i": i, "w": w[i]})

    rows = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(marked), "k")
    rows = (map_rows(rows, [F.col("t")], ["k", "y"], vectors, {"i": "array<long>", "x": "array<double>"})
            .dropDuplicates(["k"]).withColumn("h", F.xxhash64("k")).withColumn("shard", F.pmod("h", F.lit(shards))))
    parts = rows.groupBy("shard").applyInPandas(shard, "i long, w double")
    mean = parts.groupBy("i").agg((F.sum("w") / shards).alias("w")).toPandas()  # at most 2**bits rows
    weights = np.zeros(1 << bits)
    weights[mean["i"].to_numpy(np.int64)] = mean["w"].to_numpy()
    return weights


def score(docs: DataFrame, weights: np.ndarray, *, text: str = "text", carry=("doc_id",)) -> DataFrame:
    """``carry`` columns, ``score`` (0 to 1) and ``predicted`` of every row."""
    bits = int(len(weights)).bit_length() - 1

    def make():
        def run(texts):
            places, values, off = features(texts, bits)
            p = _sigmoid(np.add.reduceat(weights[places] * values, off[:-1]))
            return p, (p >= 0.5).astype(np.int32)
        return run

    return map_rows(docs, [F.col(text)], list(carry), make, {"score": "double", "predicted": "int"})
