"""Quality classifier trained from trusted positives and unlabelled text (positive-unlabelled learning).

The model is a logistic scorer over the shape of a text (word, symbol, case, repetition and line
ratios, as piecewise steps). It is fitted by minimising the non-negative unbiased risk

    pi * E_P[l(g, +1)] + max(0, E_U[l(g, -1)] - pi * E_P[l(g, -1)])

over trusted positives P (label 1), unlabelled documents U and the class prior ``pi``; when the
bracket turns negative, steps go against it, as the method prescribes. No row labelled 0 is a
training example: labels of the training fold only give P and the estimate of ``pi`` (their share
of ones), unless ``prior`` is passed.

P and U are fitted on bounded samples (``max_positives``, ``max_unlabelled``: rows whose hashed id
falls under a rate), of which only the short feature vectors reach the driver; every row is scored.

Defined cases: null and empty texts have all-zero counts and are scored like any other; very long
texts are read whole; labels that repeat a document count once, and it is trusted only if all of
its labels are 1; rows that repeat are scored alike; without positives or documents to learn from
the score is the prior (0.5 when that is unknown too); empty tables give an empty result; other
columns are ignored.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ._util import bound_batches, fold, give_back

FEATURES = ("log_words", "symbols", "bangs", "upper_words", "distinct_words", "repeats", "word_length", "digits", "single_chars", "stops", "line_length", "dup_lines")
_DIGITS = b"0123456789"


def text_features(t: str) -> tuple[float, ...]:
    """Shape of one whole text (order of FEATURES)."""
    w = t.split()
    n = len(w)
    if not n:
        return (0.0,) * len(FEATURES)
    raw = t.encode("utf-8", "surrogatepass")
    lines = [x for x in t.split("\n") if x and not x.isspace()]
    return (
        float(np.log1p(n)),
        (len(raw) - len(raw.translate(None, b"#*$%&|<>{}[]^~"))) / n,
        t.count("!") / n,
        sum(map(str.isupper, w)) / n,
        len(set(w)) / n,
        sum(map(operator.eq, w, w[1:])) / n,
        len(t) / n,
        (len(raw) - len(raw.translate(None, _DIGITS))) / len(raw),
        list(map(len, w)).count(1) / n,
        (t.count(".") + t.count(",")) / n,
        float(np.log1p(n / max(1, len(lines)))),
        1 - len(set(lines)) / max(1, len(lines)),
    )


def features_of(texts) -> np.ndarray:
    return np.array([text_features(t or "") for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))


@dataclass
class PuModel:
    """Step positions of each feature, weights and bias."""

    knots: np.ndarray  # (features, k)
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Soft steps at the knots of each feature."""
        z = (x[:, :, None] - self.knots[None]) / self.scale[None, :, None]
        return np.tanh(z).reshape(len(x), -1)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights.size:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.expand(x) @ self.weights + self.bias, -30, 30)))


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 800, rate: float = 0.05, l2: float = 1e-4) -> PuModel:
    """Minimise the non-negative unbiased risk by Adam on all of ``p`` and ``u``."""
    if not len(p) or not len(u):
        return PuModel(np.zeros((len(FEATURES), 0)), np.ones(len(FEATURES)), np.zeros(0), 0.0, prior)
    quantiles = [0.01, 0.03, 0.05, 0.1, 0.2, 0.5, 0.8, 0.9, 0.95, 0.97, 0.99]
    knots = np.quantile(u, quantiles, axis=0).T
    model = PuModel(knots, np.maximum(u.std(axis=0) / 4, 1e-3), np.zeros(knots.size), float(np.log(prior / (1 - prior))), prior)
    a, b = model.expand(p), model.expand(u)
    w, c = model.weights.copy(), model.bias
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for k in range(1, steps + 1):
        gp, gu = a @ w + c, b @ w + c
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        # derivatives of the logistic losses l(g,+1) = log(1+e^-g) and l(g,-1) = log(1+e^g)
        dp_pos, dp_neg, du_neg = (sig(gp) - 1) / len(p), sig(gp) / len(p), sig(gu) / len(u)
        if negative >= 0:
            ep, eu = prior * dp_pos - prior * dp_neg, du_neg
        else:
            ep, eu = prior * dp_neg, -du_neg
        grad = np.append(a.T @ ep + b.T @ eu + l2 * w, ep.sum() + eu.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
        w, c = w - step[:-1], c - step[-1]
    model.weights, model.bias = w, float(c)
    return model


def train(docs: DataFrame, labels: DataFrame, max_positives: int = 10_000, max_unlabelled: int = 20_000,
          prior: float | None = None) -> PuModel:
    """Fit on the training fold (``crc32(doc_id) mod 5 <> 0``) of ``docs`` and ``labels``."""
    bound_batches(docs.sparkSession)
    lab = labels.select("doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL").where(fold(F.col("doc_id")) != 0)
    lab = lab.groupBy("doc_id").agg(F.min("quality").alias("q"))
    d = docs.select("doc_id", "text").where("doc_id IS NOT NULL").where(fold(F.col("doc_id")) != 0)
    n_docs = d.select("doc_id").count()
    n_lab, n_pos = lab.agg(F.count(F.lit(1)), F.sum((F.col("q") == 1).cast("long"))).first()
    n_pos = n_pos or 0
    if prior is None:
        prior = min(0.99, max(0.01, n_pos / n_lab)) if n_lab else 0.5
    rate_u, rate_p = min(1.0, max_unlabelled / max(1, n_docs)), min(1.0, max_positives / max(1, n_pos))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1_000_000)) / 1_000_000
    # vectors only of rows that either sample draws; labels join vectors, not texts
    some = d.where(draw < max(rate_u, rate_p))
    if rate_p > rate_u:
        positive = lab.where("q = 1").where(draw < rate_p).select("doc_id")
        some = some.where(draw < rate_u).union(some.where(draw >= rate_u).join(positive, "doc_id", "left_semi"))
    rows = some.mapInPandas(_vectors, "doc_id long, x array<double>").join(lab.where("q = 1").select("doc_id", F.lit(1).alias("p")), "doc_id", "left")
    got = rows.orderBy("doc_id").select("x", F.coalesce("p", F.lit(0)).alias("p"), (draw < rate_u).alias("u"), (draw < rate_p).alias("s")).toPandas() if n_docs else None
    if got is None or not len(got):
        return fit_nnpu(np.zeros((0, len(FEATURES))), np.zeros((0, len(FEATURES))), prior)
    x = np.array(got["x"].tolist(), dtype=np.float64)
    return fit_nnpu(x[((got["p"] == 1) & got["s"]).to_numpy()], x[got["u"].to_numpy()], prior)


def _vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"doc_id": b["doc_id"], "x": list(features_of(b["text"]))})


def score_quality(docs: DataFrame, model: PuModel, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = model.score(features_of(b["text"])) if len(b) else np.zeros(0)
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "score": s, "predicted": (s >= threshold).astype("int32")})

    out = docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double, predicted int")
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def quality_filter(docs: DataFrame, model: PuModel, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` (all columns as they are) that the classifier keeps."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(at).to_pylist()
            if texts:
                yield b.filter(pa.array(model.score(features_of(texts)) >= threshold))
        give_back()

    return docs.mapInArrow(run, docs.schema)
