"""Toxicity grades by cumulative-link ordinal regression on sparse word features.

The model says ``P(grade > k) = sigmoid(x . w - t_k)``: one weight vector shared by all thresholds ``t_0 < t_1 < ..``. Its
expected severity is the sum of these probabilities, and a document is toxic if ``P(grade > 0) >= 0.5``.

Features are the distinct words of the whole text and their beginnings (``PREFIXES`` bytes, which joins the inflected
forms of a stem), as hashes, as far as they occur in a vocabulary: those whose presence depends on the label most
(likelihood ratio above ``MIN_RATIO``, at most ``VOCABULARY``), counted in the sample. The labels hold only 0 and 1, so
the sample's grades come from both: a clean document has grade 0; a toxic one has grade 1, 2 or 3 by how many features
that speak for toxicity it holds (up to 3, up to 9, more).

Fitting uses a bounded sample of labelled documents, at most ``SAMPLE_ROWS``, taken in hash order of their ids, so it is
the same in every run. Feature counts are a Spark aggregate; the driver gets the vocabulary and one short row per sample
document. Scoring reads every text whole, with no shuffle.

Defined cases: a null text or one without words has only the thresholds' severity and is never toxic; without toxic or
without clean labels the vocabulary is empty and nothing is toxic; repeated rows each give a row; a document labelled
twice is toxic if any label says so; null labels are left out; an empty table gives no rows; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import cut
from riskloom.llm.words import Words, letters_and_digits, prefix_hashes, word_batches

SAMPLE_ROWS = 10_000
PREFIXES = (4, 5, 6)
VOCABULARY = 2_000
MIN_RATIO = 20.0
MIN_ROWS = 3
TOP_GRADE = 3
PENALTY = 1e-3
STEPS = 400


@dataclass
class OrdinalModel:
    """Feature hashes in order, their weights, and the thresholds."""

    hashes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(TOP_GRADE, 20.0))

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each score and threshold."""
        return sigmoid(score[:, None] - self.thresholds[None])

    def scores(self, hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Sum of weights of the distinct known features of each row."""
        if not len(self.hashes):
            return np.zeros(n)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes
        pairs = np.unique(rows[hit] * len(self.hashes) + at[hit])
        return np.bincount(pairs // len(self.hashes), weights=self.weights[pairs % len(self.hashes)], minlength=n)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_ordinal(rows: np.ndarray, cols: np.ndarray, grades: np.ndarray, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the cumulative-link model with a squared penalty on the weights, by Adam on the
    whole sample. Row ``rows[i]`` has feature ``cols[i]``. Thresholds are the first one plus positive steps."""
    n = len(grades)
    levels = np.arange(TOP_GRADE)
    share = np.clip([(grades > k).mean() for k in levels], 1e-4, 1 - 1e-4)
    start = -np.log(share / (1 - share))
    steps = np.log(np.maximum(np.diff(start), 1e-2))
    params = np.concatenate([np.zeros(n_features), start[:1], steps])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, first, gaps = params[:n_features], params[n_features], np.exp(params[n_features + 1:])
        t = first + np.append(0, np.cumsum(gaps))
        score = np.bincount(rows, weights=w[cols], minlength=n)
        edge = np.concatenate([np.full((n, 1), 1.0), sigmoid(score[:, None] - t[None]), np.zeros((n, 1))], axis=1)
        at = np.arange(n)
        upper, lower = edge[at, grades], edge[at, grades + 1]
        p = np.maximum(upper - lower, 1e-12)
        d_upper, d_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_score = -(d_upper - d_lower) / n
        g_t = np.bincount(np.append(grades, grades + 1), weights=np.append(d_upper, -d_lower), minlength=TOP_GRADE + 2)[1:-1] / n
        g_steps = np.array([g_t[k + 1:].sum() * gaps[k] for k in range(TOP_GRADE - 1)])
        grad = np.concatenate([np.bincount(cols, weights=g_score[rows], minlength=n_features) + PENALTY * w / max(1, n_features), [g_t.sum()], g_steps])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return params[:n_features], params[n_features] + np.append(0, np.cumsum(np.exp(params[n_features + 1:])))


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all words and the rows they are in, with repeats."""
    parts = [(w.hash, w.row), *(prefix_hashes(w, n) for n in PREFIXES)]
    return np.concatenate([h for h, _ in parts]), np.concatenate([r for _, r in parts])


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    inside = letters_and_digits()
    for batch in batches:
        if not batch.num_rows:
            continue
        for a, b, w in word_batches(batch.column(1), True, inside):
            hashes, rows = features(w)
            order = np.lexsort((hashes, rows))
            hashes, rows = hashes[order], rows[order]
            new = np.append(True, (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1]))[:len(hashes)]
            hashes, rows = hashes[new], rows[new]
            bounds = pa.array(np.searchsorted(rows, np.arange(b - a + 1)), pa.int32())
            yield pa.record_batch([batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(bounds, pa.array(hashes.view(np.int64)))],
                                  names=["toxic", "features"])


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample_rows: int) -> DataFrame:
    """``toxic`` and the distinct ``features`` of at most ``sample_rows`` labelled documents. The chosen ids are few, so
    they are broadcast and no text moves."""
    chosen = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id")
              .agg((F.max("toxic") > 0).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    text = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    j = text.join(F.broadcast(chosen), "doc_id").select("toxic", "_text")
    return j.mapInArrow(_sample_features, "toxic boolean, features array<long>")


def _ratio(a: np.ndarray, b: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Likelihood-ratio statistic of each word's presence against the label; ``a``, ``b``: toxic and clean documents with it."""
    total = np.zeros(len(a))
    for seen, rest, n in ((a, a + b, toxic), (b, a + b, clean)):
        expected = rest * n / (toxic + clean)
        for x, e in ((seen, expected), (n - seen, n - expected)):
            total += 2 * np.where(x > 0, x * np.log(np.maximum(x, 1e-12) / np.maximum(e, 1e-12)), 0)
    return total


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          sample_rows: int = SAMPLE_ROWS) -> OrdinalModel:
    sample = cut(labelled_sample(docs, labels, id_col, text_col, sample_rows))
    size = sample.agg(F.count_if("toxic"), F.count_if(~F.col("toxic"))).head()
    toxic, clean = size[0], size[1]
    if not toxic or not clean:
        return OrdinalModel()
    seen = (sample.select("toxic", F.explode("features").alias("f")).groupBy("f")
            .agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b")).where(F.col("a") + F.col("b") >= MIN_ROWS))
    e = F.col("a") * F.lit(clean) - F.col("b") * F.lit(toxic)
    chi = e * e / ((F.col("a") + F.col("b")) * (toxic + clean - F.col("a") - F.col("b")) + 1)
    top = seen.orderBy(F.desc(chi), "f").limit(VOCABULARY).collect()  # at most VOCABULARY features
    a, b = np.array([r["a"] for r in top], float), np.array([r["b"] for r in top], float)
    keep = _ratio(a, b, toxic, clean) >= MIN_RATIO if top else np.zeros(0, bool)
    known = [r["f"] for r, k in zip(top, keep, strict=True) if k]
    if not known:
        return OrdinalModel()
    speaks = (a / toxic > b / clean)[keep]
    shared = F.filter("features", lambda f: f.isin(known))
    found = sample.select("toxic", shared.alias("features")).collect()  # at most sample_rows short rows
    place = {f: i for i, f in enumerate(known)}
    rows = np.array([i for i, r in enumerate(found) for _ in r["features"]], np.int64)
    cols = np.array([place[f] for r in found for f in r["features"]], np.int64)
    strong = np.bincount(rows, weights=speaks[cols], minlength=len(found))
    severity = np.where(strong <= 3, 1, np.where(strong <= 9, 2, 3))
    grades = np.where([r["toxic"] for r in found], severity, 0)
    weights, thresholds = fit_ordinal(rows, cols, grades, len(known))
    hashes = np.array(known, np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return OrdinalModel(hashes[order], weights[order], thresholds)


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, expected_severity, grade (the likeliest) and toxic. The model's size is bounded, so it is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, inside = shared.value, letters_and_digits()
        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b, w in word_batches(batch.column(1), True, inside):
                above = model.above(model.scores(*features(w), b - a))
                bounds = np.concatenate([np.ones((b - a, 1)), above, np.zeros((b - a, 1))], axis=1)
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(above.sum(1)),
                                       pa.array((-np.diff(bounds, axis=1)).argmax(1).astype(np.int32)),
                                       pa.array((above[:, 0] >= 0.5) & (w.count() > 0))],
                                      names=["doc", "expected_severity", "grade", "toxic"])

    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, expected_severity double, grade int, toxic boolean").withColumnRenamed("doc", id_col)


def drop_toxic(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that the model finds toxic, filtered in place; all columns stay."""
    shared, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, inside = shared.value, letters_and_digits()
        for batch in batches:
            if not batch.num_rows:
                continue
            for a, b, w in word_batches(batch.column(at), True, inside):
                toxic = (model.above(model.scores(*features(w), b - a))[:, 0] >= 0.5) & (w.count() > 0)
                yield batch.slice(a, b - a).filter(pa.array(~toxic))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
