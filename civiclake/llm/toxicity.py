"""Toxicity: a classifier chain over categories, later links fed with out-of-fold probabilities of earlier ones."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashed_text import Sample, Scorer, adam, sigmoid, training_sample

#: At most so many labelled documents train the chain.
SAMPLE = 12_000
FOLDS = 3
#: A word of fewer labelled documents takes no part, and the fit stops early: both keep chance words of toxic documents
#: from explaining them in place of the words that matter.
LEAST, STEPS = 3, 40
#: Rows at the base rate that a word's share of a category is mixed with: a rare word counts by its evidence.
PRIOR_ROWS = 50
#: The chain in its order. The label says only whether a document is toxic; how much so follows from words that the
#: labels of the other folds tell to be toxic, in whatever language: at least so many different ones in a toxic document.
CATEGORIES = ("toxic", "strong", "severe")
WORDS_OF = (2, 4)


@dataclass
class ChainModel:
    """weights[:, c] over hashed text, links[c, e] on the probability of earlier category e, bias[c]."""

    weights: np.ndarray
    links: np.ndarray
    bias: np.ndarray

    def predict(self, z: np.ndarray) -> np.ndarray:
        p = np.zeros_like(z)
        for c in range(z.shape[1]):
            p[:, c] = sigmoid(z[:, c] + p[:, :c] @ self.links[c, :c] + self.bias[c])
        return p


def _fit(sample: Sample, on: np.ndarray, extra: np.ndarray, y: np.ndarray, steps: int, ridge: float, rate: float) -> np.ndarray:
    """Logistic regression of the rows ``on``: feature weights, then those of ``extra``, then the bias.

    A word can speak for a category, never against it: else the many words of a long text outweigh the few that matter.
    Its value is its lift in these rows, so words of small languages take part, each as far as its rows bear it out.
    """
    worth = _lift(sample, on, y)
    some = sample.only(worth > 0)
    d, e, n, s = len(some.used), extra.shape[1], max(1, int(on.sum())), worth[worth > 0]

    def grad(x):
        g = np.where(on, sigmoid(some.dot(s * x[:d]) + extra @ x[d : d + e] + x[-1]) - y, 0) / n
        return np.concatenate([s * some.back(g) + ridge * x[:d], extra.T @ g + ridge * x[d : d + e], [g.sum()]])

    x = adam(grad, np.zeros(d + e + 1), steps, rate, positive=d)
    worth[worth > 0] *= x[:d]
    return np.concatenate([worth, x[d:]])


def _lift(sample: Sample, on: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Log of the category's shrunk share among the rows of each word over its share of all rows ``on``; 0 where it isn't higher."""
    base, seen, d = float(y[on].mean()) if on.any() else 0.0, on[sample.row], len(sample.used)
    if not base:
        return np.zeros(d)
    rows = np.bincount(sample.col[seen], minlength=d)
    yes = np.bincount(sample.col[seen], y[sample.row[seen]], minlength=d)
    return np.maximum(0, np.log((yes + PRIOR_ROWS * base) / (rows + PRIOR_ROWS) / base))


def fit_chain(sample: Sample, labels: np.ndarray, fold: np.ndarray, folds: int = FOLDS, steps: int = STEPS, ridge: float = 1e-5, rate: float = 0.3) -> ChainModel:
    """One link per category. Link c learns from the probabilities that models of the other folds gave to the earlier categories, so it sees them as noisy as at prediction.

    ``fold`` numbers each row's fold; copies of a text belong into one, or the other folds would know it.
    """
    n, k = labels.shape
    d = len(sample.used)
    weights, links, bias = np.zeros((len(sample.full(np.zeros(d))), k)), np.zeros((k, k)), np.zeros(k)
    if not n:
        return ChainModel(weights, links, bias - 9)
    earlier = np.zeros((n, 0))
    for c in range(k):
        known, y = labels[:, c] >= 0, labels[:, c].astype(float)
        x = _fit(sample, known, earlier, y, steps, ridge, rate)
        weights[:, c], links[c, :c], bias[c] = sample.full(x[:d]), x[d : d + c], x[-1]
        if c < k - 1:
            out = np.zeros(n)
            for f in range(folds):
                x = _fit(sample, known & (fold != f), earlier, y, steps, ridge, rate)
                held = fold == f
                out[held] = sigmoid(sample.dot(x[:d]) + earlier @ x[d : d + c] + x[-1])[held]
            earlier = np.column_stack([earlier, out])
    return ChainModel(weights, links, bias)


def graded_targets(sample: Sample, toxic: np.ndarray, fold: np.ndarray, folds: int = FOLDS) -> np.ndarray:
    """0/1 rows of CATEGORIES. A word is told to be toxic where its share of toxic rows, shrunk by five rows of the base rate, is a half or more."""
    d = len(sample.used)
    words = np.zeros(len(toxic), np.int64)
    for f in range(folds):
        on = (fold != f)[sample.row]
        base = toxic[fold != f].mean() if (fold != f).any() else 0.0
        rows = np.bincount(sample.col[on], minlength=d)
        yes = np.bincount(sample.col[on], toxic[sample.row[on]], minlength=d)
        told = (yes + 5 * base) / (rows + 5) >= 0.5
        here = np.bincount(sample.row, told[sample.col], minlength=len(toxic))
        words[fold == f] = here[fold == f]
    return np.column_stack([toxic, *(toxic * (words >= n) for n in WORDS_OF)]).astype(np.int64)


def train_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> ChainModel:
    """The chain of at most ``rows`` labelled documents, the same ones on every run (see ``training_sample``).

    Nulls, empty texts, repeated and disagreeing label rows are settled by the sample; without any labelled document
    nothing is toxic. Other columns are ignored.
    """
    found = training_sample(docs, labels, [F.col("toxic")], rows, shapes=False)
    sample = Sample([(r.i, r.v) for r in found], least=LEAST)
    # Copies of a text share its hash and so its fold.
    fold = np.array([r.h % FOLDS for r in found], np.int64)
    return fit_chain(sample, graded_targets(sample, np.array([r.t0 for r in found], np.int64), fold), fold)


def score_toxicity(docs: DataFrame, model: ChainModel, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, p_toxic, p_strong, p_severe, toxic (p_toxic at ``threshold``).

    Narrow: one scan, whole texts, no shuffle; only the model (a fixed size) goes to the tasks. An empty or null text
    has no features. Repeated rows score alike; an empty table gives no rows.
    """
    names = [f"p_{c}" for c in CATEGORIES]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(sent.value.weights, shapes=False)
        for b in batches:
            z = np.array([scorer(t) for t in b.column("text").to_pylist()], float).reshape(b.num_rows, len(names))
            p = sent.value.predict(z)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(p[:, c]) for c in range(len(names))), pa.array(p[:, 0] >= threshold)], ["doc_id", *names, "toxic"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", toxic boolean")
