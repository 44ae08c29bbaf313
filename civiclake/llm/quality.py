"""Quality classifier: ordinal cumulative-link regression on graded ratings, with hashed-text weights."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashed_text import Sample, Scorer, adam, sigmoid, training_sample

#: At most so many labelled documents train the model.
SAMPLE = 6000


@dataclass
class OrdinalModel:
    """P(grade >= j) = sigmoid(weights . features - cuts[j - 1]): one weight vector, ordered cuts."""

    weights: np.ndarray
    cuts: np.ndarray

    def tails(self, z: np.ndarray) -> np.ndarray:
        return sigmoid(z[:, None] - self.cuts[None, :])


def fit_ordinal(sample: Sample, grade: np.ndarray, grades: int, steps: int = 150, ridge: float = 1e-4, rate: float = 0.05) -> OrdinalModel:
    """Maximum likelihood of P(grade = j) = tail_j - tail_(j+1); the gaps between cuts are exponentials, so ordered."""
    d, n, k = len(sample.used), max(1, sample.n), grades - 1
    if not sample.n:
        return OrdinalModel(np.zeros_like(sample.full(np.zeros(d))), np.arange(k, dtype=float))

    def cuts_of(x):
        return np.concatenate([x[d : d + 1], x[d] + np.cumsum(np.exp(x[d + 1 :]))])

    def grad(x):
        cuts, z = cuts_of(x), sample.dot(x[:d])
        tail = np.concatenate([np.ones((n, 1)), sigmoid(z[:, None] - cuts), np.zeros((n, 1))], axis=1)
        slope = tail * (1 - tail)
        rows = np.arange(n)
        p = np.maximum(tail[rows, grade] - tail[rows, grade + 1], 1e-12)
        dz = -(slope[rows, grade] - slope[rows, grade + 1]) / p / n
        # Cut j is the lower edge of grade j + 1 and the upper edge of grade j.
        dc = np.array([(slope[:, j + 1] / p * ((grade == j + 1).astype(float) - (grade == j))).sum() / n for j in range(k)])
        back = np.concatenate([[dc.sum()], [dc[j:].sum() * np.exp(x[d + j]) for j in range(1, k)]])
        return np.concatenate([sample.back(dz) + ridge * x[:d], back])

    x = adam(grad, np.zeros(d + k), steps, rate)
    return OrdinalModel(sample.full(x[:d]), cuts_of(x))


def train_quality(docs: DataFrame, labels: DataFrame, grade: Column, grades: int, rows: int = SAMPLE) -> OrdinalModel:
    """The model of at most ``rows`` labelled documents, the same ones on every run (see ``training_sample``).

    ``grade`` is 0 .. grades - 1 over the label table, null where there is none. Nulls, empty texts, repeated and
    disagreeing label rows are settled by the sample; without any labelled document all weights are 0 and the cuts
    stand at 0, 1 and so on. Other columns are ignored.
    """
    found = training_sample(docs, labels, [grade], rows, shapes=True)
    return fit_ordinal(Sample([(r.i, r.v) for r in found], least=5), np.array([r.t0 for r in found], np.int64), grades)


def score_quality(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", least: int = 1, threshold: float = 0.5) -> DataFrame:
    """Per document: doc_id, expected_grade, p_ge_1 .. p_ge_k, kept (tail probability of ``least`` at ``threshold``).

    Narrow: one scan, whole texts, no shuffle; only the model (a fixed size) goes to the tasks. An empty or null text
    has no features and is scored by the cuts alone. Repeated rows score alike; an empty table gives no rows.
    """
    k = len(model.cuts)
    names = [f"p_ge_{j + 1}" for j in range(k)]
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(sent.value.weights[:, None], shapes=True)
        for b in batches:
            z = np.array([scorer(t)[0] for t in b.column("text").to_pylist()], float)
            tails = sent.value.tails(z)
            cols = [b.column("doc_id"), pa.array(tails.sum(axis=1)), *(pa.array(tails[:, j]) for j in range(k)), pa.array(tails[:, least - 1] >= threshold)]
            yield pa.RecordBatch.from_arrays(cols, ["doc_id", "expected_grade", *names, "kept"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, expected_grade double, " + ", ".join(f"{n} double" for n in names) + ", kept boolean")


def keep_quality(docs: DataFrame, model: OrdinalModel, text_col: str = "text", least: int = 1, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose tail probability of grade ``least`` reaches ``threshold``, with all their columns.

    Null and empty texts have no features and are judged by the cuts alone; repeated rows share their fate; an empty
    table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(sent.value.weights[:, None], shapes=True)
        for b in batches:
            z = np.array([scorer(t)[0] for t in b.column(text_col).to_pylist()], float)
            yield b.filter(pa.array(sent.value.tails(z)[:, least - 1] >= threshold))

    return docs.mapInArrow(run, docs.schema)


GRADES = 3


def label_grade() -> Column:
    """Grades of the ``labels`` table: 0 poor, 1 well written but toxic, 2 well written and clean."""
    return F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 2)
