"""Hashed text features, bounded training samples and linear scoring, shared by the two classifiers."""

from __future__ import annotations

import re
import warnings
from collections import Counter
from copy import copy
from operator import eq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 18
SIZE = 1 << BITS
#: Words a worker keeps; a full table starts anew.
CACHE = 400_000
EDGE = " .,;:!?#*$%&|\"'()[]{}<>-_=+~/\\"
_RUNS = re.compile(r"(.)\1+")
_CLASSES = ((re.compile(r"[^\W\d_A-Z]+"), "a"), (re.compile(r"[A-Z]+"), "A"), (re.compile(r"\d+"), "9"))


def bucket(feature: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(feature.encode()) >> (32 - BITS)


def word_feature(word: str) -> int:
    return bucket("w:" + (word.strip(EDGE).lower() or word))


def shape_feature(word: str) -> int:
    """Letter case, digits and punctuation of a whole word, without its letters; runs of one sign count once."""
    for pattern, sign in _CLASSES:
        word = pattern.sub(sign, word)
    return bucket("s:" + _RUNS.sub(r"\1", word))


REPEAT, FEW = bucket("f:repeat"), bucket("f:few")


def features(text: str | None, shapes: bool) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and values of a whole text: each distinct word once; with ``shapes`` also ten times the share of words of each shape, of words that repeat the one before, and of words that are not new."""
    words = (text or "").split()
    sums = Counter(map(word_feature, set(words)))
    if shapes and words:
        n = len(words)
        for w, c in Counter(words).items():
            sums[shape_feature(w)] += 10 * c / n
        sums[REPEAT] += 10 * sum(map(eq, words, words[1:])) / n
        sums[FEW] += 10 * (1 - len(set(words)) / n)
    return np.fromiter(sums, np.int64, len(sums)), np.fromiter(sums.values(), np.float64, len(sums))


class Scorer:
    """w . features(text) for several weight vectors at once, by tables of words and shapes."""

    def __init__(self, weights: np.ndarray, shapes: bool):
        self.w, self.shapes, self.zero = weights, shapes, np.zeros(weights.shape[1])
        self.words: dict[str, int] = {}
        self.forms: dict[str, int] = {}
        self.live = np.flatnonzero(np.abs(weights).max(axis=1) > 0)
        self.is_live = np.zeros(len(weights), bool)
        self.is_live[self.live] = True

    def _look(self, table: dict, words, make) -> np.ndarray:
        if len(table) > CACHE:
            table.clear()
        get = table.get
        ids = [get(w) for w in words]
        if None in ids:
            for k, (w, i) in enumerate(zip(words, ids, strict=True)):
                if i is None:
                    ids[k] = i = make(w)
                    if len(w) <= 12:
                        table[w] = i
        return np.array(ids, np.int64)

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        if not words:
            return self.zero
        distinct = list(set(words))
        ids = self._look(self.words, distinct, word_feature)
        z = self.w[ids[self.is_live[ids]]].sum(axis=0)
        if self.shapes:
            n, counts = len(words), Counter(words)
            forms = self._look(self.forms, distinct, shape_feature)
            share = np.fromiter(map(counts.__getitem__, distinct), np.float64, len(distinct)) * (10 / n)
            z = z + share @ self.w[forms] + self.w[REPEAT] * (10 * sum(map(eq, words, words[1:])) / n) + self.w[FEW] * (10 * (1 - len(distinct) / n))
        return z


class Sample:
    """Rows of a bounded training sample as one sparse matrix."""

    def __init__(self, rows: list[tuple[bytes, bytes]], least: int):
        self.n = len(rows)
        idx = [np.frombuffer(a, np.int32) for a, _ in rows]
        self.row = np.repeat(np.arange(self.n), [len(x) for x in idx])
        self.col = np.concatenate(idx).astype(np.int64) if idx else np.empty(0, np.int64)
        self.val = np.concatenate([np.frombuffer(b, np.float32) for _, b in rows]).astype(np.float64) if rows else np.empty(0)
        # Features of fewer than ``least`` rows can't be told from chance.
        keep = np.bincount(self.col, minlength=SIZE)[self.col] >= least
        self.row, self.col, self.val = self.row[keep], self.col[keep], self.val[keep]
        self.used, self.col = np.unique(self.col, return_inverse=True)

    def only(self, keep: np.ndarray) -> Sample:
        """The same rows with the features ``keep`` alone."""
        out = copy(self)
        on = keep[self.col]
        out.row, out.val, out.used = self.row[on], self.val[on], self.used[keep]
        out.col = (np.cumsum(keep) - 1)[self.col[on]]
        return out

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.val * w[self.col], minlength=self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.val * g[self.row], minlength=len(self.used))

    def full(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(SIZE)
        out[self.used] = w
        return out


def training_sample(docs: DataFrame, labels: DataFrame, targets: list, rows: int, shapes: bool, id_col: str = "doc_id", text_col: str = "text") -> list:
    """At most ``rows`` labelled documents: those with the smallest id hashes, so the same ones on every run.

    The sample is the documented bound of the classifiers; labels without a document take no place in it. Its ids (at
    most ``rows``) are broadcast to one scan of the documents, features are made in the tasks, and only they come to the
    driver, one row an id, with the text's hash ``h``. Label rows of one id that disagree count as the smallest of them,
    documents of one id as the smallest text, a null text as empty. Rows without a label or an id, and documents
    without a label, take no part; without any the sample is empty, which warns.
    """
    names = [f"t{i}" for i in range(len(targets))]
    marks = labels.select(F.col(id_col).cast("long").alias("id"), F.struct(*(t.cast("int").alias(n) for t, n in zip(targets, names, strict=True))).alias("t"))
    whole = F.col("id").isNotNull()
    for n in names:
        whole &= F.col(f"t.{n}").isNotNull()
    there = docs.select(F.col(id_col).cast("long").alias("id"))
    marks = marks.where(whole).groupBy("id").agg(F.min("t").alias("t")).join(there, "id", "left_semi")
    chosen = marks.orderBy(F.xxhash64("id"), "id").limit(rows).select("id", "t.*")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    texts = texts.groupBy("id", *names).agg(F.min("text").alias("text")).withColumn("h", F.xxhash64("text"))

    def run(batches):
        import pandas as pd

        for b in batches:
            made = [features(t, shapes) for t in b["text"]]
            yield pd.DataFrame({"id": b["id"], "h": b["h"], "i": [i.astype(np.int32).tobytes() for i, _ in made], "v": [v.astype(np.float32).tobytes() for _, v in made]} | {n: b[n] for n in names})

    out = texts.mapInPandas(run, "id long, h long, i binary, v binary, " + ", ".join(f"{n} int" for n in names))
    found = sorted(out.collect(), key=lambda r: r.id)
    if not found:
        warnings.warn("no labelled documents: the model knows nothing", stacklevel=3)
    return found


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def adam(grad, x: np.ndarray, steps: int, rate: float, positive: int = 0) -> np.ndarray:
    """Full-batch Adam with a falling rate; the first ``positive`` parameters stay at 0 or above."""
    m, v = np.zeros_like(x), np.zeros_like(x)
    for t in range(1, steps + 1):
        g = grad(x)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = x - rate * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        np.maximum(x[:positive], 0, out=x[:positive])
    return x
