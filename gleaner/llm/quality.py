"""Quality by ordinal cumulative-link regression on hashed text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gleaner.llm.hashing import texts_of, tokens

WIDTH = 1 << 18        # hashed words
SHAPES, STEPS = 6, 12  # shape features of a text and the steps of each
MAX_ROWS = 12_000      # labelled rows that are fitted
LEAST_DOCS = 5         # fitted rows that must hold a feature
LEAST_Z = 4.0          # standard errors by which the grades of those rows must differ from all
ROUNDS, RATE, DECAY = 300, 0.2, 1e-4


def features(text: bytes, hashes: np.ndarray) -> np.ndarray:
    """Distinct hashed words of a text and the steps of its shape, as indices."""
    words = np.unique(hashes & np.uint64(WIDTH - 1)).astype(np.int64)
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    b = np.frombuffer(text, dtype=np.uint8)
    upper, lower = ((b >= 65) & (b <= 90)).sum(), ((b >= 97) & (b <= 122)).sum()
    digit, blank = ((b >= 48) & (b <= 57)).sum(), ((b == 32) | ((b >= 9) & (b <= 13))).sum()
    odd = len(b) - upper - lower - digit - blank - (b >= 128).sum()
    shares = (upper / max(upper + lower, 1), odd / len(b), digit / len(b), len(np.unique(hashes)) / len(hashes),
              min(len(hashes) / max(len(b), 1) * 3, 1), min(np.log2(len(hashes) + 1) / 20, 1))
    steps = [WIDTH + k * STEPS + min(int(x * STEPS), STEPS - 1) for k, x in enumerate(shares)]
    return np.concatenate((words, np.array(steps, dtype=np.int64)))


def _featurise(batches):
    for batch in batches:
        texts = texts_of(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([features(t, h).astype(np.int32).tobytes()
                                        for t, h in zip(texts, tokens(texts))], pa.binary())], ["grade", "idx"])


@dataclass
class Ordinal:
    """``P(grade > k) = sigmoid(weights . x - thresholds[k])``, thresholds ascending."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -40, 40)))


def fit(grades: np.ndarray, rows: list[np.ndarray], grade_count: int) -> Ordinal:
    """Maximum likelihood with weight decay, by full-batch Adam.

    Features that are rare, or whose rows have the grades of all rows but for
    chance, keep weight 0: nearly all words are such, and fitting them would
    only learn the fitted texts by heart.
    """
    size = WIDTH + SHAPES * STEPS
    idx = np.concatenate([np.empty(0, np.int32), *rows])
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    held = np.bincount(idx, minlength=size)
    centred = (grades - grades.mean()) / max(grades.std(), 1e-9)
    z = np.bincount(idx, weights=centred[row], minlength=size) / np.sqrt(np.maximum(held * (1 - held / len(rows)), 1e-9))
    common = ((held >= LEAST_DOCS) & (np.abs(z) >= LEAST_Z))[idx]
    idx, row = idx[common], row[common]
    names, idx = np.unique(idx, return_inverse=True)
    above = np.array([(grades > k).mean() for k in range(grade_count - 1)])
    cuts = -np.log((above + 1e-3) / (1 - above + 1e-3))
    # thresholds = first + running sum of exp(gap), which keeps them in order
    par = np.concatenate((np.zeros(len(names)), cuts[:1], np.log(np.maximum(np.diff(cuts), 1e-2))))
    m, v, n = np.zeros_like(par), np.zeros_like(par), len(names)
    target = np.arange(grade_count + 1)
    for t in range(1, ROUNDS + 1):
        theta = np.cumsum(np.concatenate((par[n:n + 1], np.exp(par[n + 1:]))))
        score = np.bincount(row, weights=par[idx], minlength=len(rows))
        tail = 1 / (1 + np.exp(-np.clip(score[:, None] - theta, -40, 40)))
        full = np.concatenate((np.ones((len(rows), 1)), tail, np.zeros((len(rows), 1))), axis=1)
        at = np.arange(len(rows))
        p = np.maximum(full[at, grades] - full[at, grades + 1], 1e-9)
        slope = full * (1 - full)
        d_score = (slope[at, grades] - slope[at, grades + 1]) / p / len(rows)
        d_theta = np.array([-(slope[:, k] * ((grades == k) * 1.0 - (grades == k - 1)) / p).mean()
                            for k in target[1:-1]])
        tail_sums = np.cumsum(d_theta[::-1])[::-1]
        grad = np.concatenate((np.bincount(idx, weights=d_score[row], minlength=n) - DECAY * par[:n],
                               tail_sums[:1], tail_sums[1:] * np.exp(par[n + 1:])))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        par += RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    weights = np.zeros(size)
    weights[names] = par[:n]
    return Ordinal(weights, np.cumsum(np.concatenate((par[n:n + 1], np.exp(par[n + 1:])))))


def train(docs: DataFrame, grades: DataFrame, grade_count: int, max_rows: int = MAX_ROWS) -> Ordinal | None:
    """Fit on the ``max_rows`` rows of ``grades(doc_id, grade)`` with the smallest hash of the id; None without any.

    The bound holds at every size of the corpus: what reaches the driver are
    the feature lists of that many documents. They are fitted in an order of
    their own, so the model does not depend on how rows are partitioned.
    """
    grades = grades.where("doc_id IS NOT NULL AND grade IS NOT NULL")
    share = min(1.0, 2 * max_rows / max(grades.count(), 1))
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    # The sort sees no more than about twice the rows it keeps.
    chosen = grades.where(lot < int(share * (1 << 40))).orderBy(lot, "doc_id", "grade").limit(max_rows)
    found = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
             .join(F.broadcast(chosen.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                             F.col("grade").cast("int").alias("grade"))), "doc_id")
             .select("grade", "text").mapInArrow(_featurise, "grade int, idx binary").toArrow())
    if not found.num_rows:
        return None
    rows = sorted(zip(found["grade"].to_pylist(), found["idx"].to_pylist()))
    return fit(np.array([g for g, _ in rows], np.int64), [np.frombuffer(x, dtype=np.int32) for _, x in rows], grade_count)


def _scores(model: Ordinal, texts: list[bytes]) -> np.ndarray:
    return model.tails(np.array([model.weights[features(t, h)].sum() for t, h in zip(texts, tokens(texts))]).reshape(-1))


def _judge(model: Ordinal | None, least: float):
    def run(batches):
        for batch in batches:
            texts = texts_of(batch.column(1))
            if model is None:
                none = pa.nulls(len(texts), pa.float64())
                tail, grade, selected = none, none, pa.array([True] * len(texts))
            else:
                tails = _scores(model, texts)
                tail, grade = pa.array(tails[:, -1]), pa.array(tails.sum(axis=1))
                selected = pa.array(tails[:, -1] >= least)
            yield pa.RecordBatch.from_arrays([batch.column(0), grade, tail, selected],
                                             ["doc_id", "expected_grade", "tail", "selected"])
    return run


def _keep(model: Ordinal, least: float):
    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(_scores(model, texts_of(batch.column("text")))[:, -1] >= least))
    return run


def judge(docs: DataFrame, grades: DataFrame, grade_count: int = 3, least: float = 0.5,
          max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, expected_grade, tail, selected``: one row per row of ``docs(doc_id, text, ...)``.

    ``grades(doc_id, grade)`` holds grades from 0 to ``grade_count - 1``; null
    ids and grades are left out, repeated rows count as often as they occur.
    ``tail`` is the probability of the highest grade; a text is selected when
    it is at least ``least``. A null or empty text has no feature and gets the
    probabilities of the thresholds alone. Without any graded document nothing
    is judged: both figures are null and every row is selected. Other columns
    are ignored.
    """
    model = train(docs, grades, grade_count, max_rows)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
            .mapInArrow(_judge(model, least), "doc_id bigint, expected_grade double, tail double, selected boolean"))


def select(docs: DataFrame, grades: DataFrame, grade_count: int = 3, least: float = 0.5,
           max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``judge`` selects, with all their columns; text stays in its task."""
    model = train(docs, grades, grade_count, max_rows)
    return docs if model is None else docs.mapInArrow(_keep(model, least), docs.schema)


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades of ``labels(doc_id, quality, toxic)``: 0 toxic, 1 of low quality, 2 good; null if not known."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(
        (F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))
