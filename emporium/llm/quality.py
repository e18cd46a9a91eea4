"""Quality classifier learnt from trusted positives and unlabelled text (non-negative risk).

Trusted positives are the texts marked good; the unlabelled sample is drawn from all texts of the
learning folds, whatever their marks. The class prior is estimated from the two samples alone (best bin:
the least ratio of unlabelled to positive mass above a score, with a confidence margin), and a
small network minimises the non-negative unbiased risk: positive risk plus the larger of zero and
the negative risk of unlabelled text less that of positives weighted by the prior. When that part
turns negative in a batch, the step goes up its gradient instead. Both samples are bounded by the
documented ``sample`` (rows chosen by a hash of their ids); scoring covers every whole text.

Defined cases: null and empty texts are scored like any other (all features zero but the emptiness
mark); a null doc_id is never in a held-out fold and learns nothing; labels that are null or repeated
count once as their greatest value; without positives nothing can be told apart and every score is 1;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, text_bytes, to_batch

# Byte values of ASCII signs other than the ones of plain sentences.
SYMBOLS = [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,;:?'()-"]
N_HASHED = 256
N_STYLE = 24
N_FEATURES = 129 + N_STYLE + N_HASHED


def features(text: bytes) -> np.ndarray:
    """Byte histogram, measures of repetition and shape, and hashed byte triples, of a whole text."""
    out = np.zeros(N_FEATURES, np.float32)
    size = len(text)
    if not size:
        out[129] = 1
        return out
    buf = np.frombuffer(text, np.uint8)
    bins = np.bincount(buf, minlength=256)
    out[:128] = bins[:128]
    out[128] = bins[128:].sum()
    out[:129] = np.sqrt(out[:129] / size)

    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    common = [c for _, c in counts.most_common(3)] + [0, 0, 0]
    pairs = set(zip(words, words[1:]))
    lines = [x for x in text.split(b"\n") if x.strip()]
    m = max(1, len(lines))
    upper = sum(map(bytes.isupper, words))
    out[130:129 + N_STYLE] = (
        np.log1p(size) / 12, np.log1p(len(words)) / 10, np.log1p(len(lines)) / 8,
        len(counts) / n, len(pairs) / n, common[0] / n, common[1] / n, common[2] / n,
        sum(map(eq, words, words[1:])) / n, sum(map(eq, words, words[2:])) / n,
        len(set(lines)) / m, np.log1p(size / m) / 8, min(1.0, size / n / 20),
        upper / n, sum(map(bytes.istitle, words)) / n, sum(map(bytes.isalpha, words)) / n,
        sum(map(bytes.isdigit, words)) / n, max(bins) / size,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n, int(bins[SYMBOLS].sum()) / size,
        sum(w[-1] in b"!#$%&*|" for w in words) / n,
        len(zlib.compress(text, 1)) / size, sum(x[-1:] in b".!?:;" for x in lines) / m)
    if size >= 3:
        wide = buf.astype(np.uint32)
        triples = (wide[:-2] * 65599 + wide[1:-1] * 257 + wide[2:]) * np.uint32(2654435761) >> np.uint32(24)
        out[129 + N_STYLE:] = np.sqrt(np.bincount(triples, minlength=N_HASHED) / size)
    return out


@dataclass
class Network:
    """One hidden layer over standardised features; the output is the log odds of a good text."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.hidden((x - self.mean) / self.scale) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self(x), -30, 30)))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 60, batch: int = 512,
        width: int = 24, rate: float = 3e-3, decay: float = 1e-4, seed: int = 1) -> Network:
    """Minimise the non-negative unbiased risk with the logistic loss by Adam.

    ``prior`` 0 asks for the plain separation of the two samples (used to estimate the prior)."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    weights = [rng.normal(0, (2 / p.shape[1]) ** 0.5, (p.shape[1], width)), np.zeros(width),
               rng.normal(0, (1 / width) ** 0.5, width), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    steps = max(1, len(u) // batch)
    for step in range(1, epochs * steps + 1):
        xp = p[rng.integers(0, len(p), min(batch, len(p)))]
        xu = u[rng.integers(0, len(u), min(batch, len(u)))]
        w1, b1, w2, b2 = weights
        hp, hu = np.maximum(xp @ w1 + b1, 0), np.maximum(xu @ w1 + b1, 0)
        zp, zu = hp @ w2 + b2, hu @ w2 + b2
        # Logistic loss: of a positive log(1 + exp(-z)) with slope s - 1; as a negative slope s.
        sp, su = sigmoid(zp), sigmoid(zu)
        if prior:
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            if negative >= 0:
                gp, gu = prior * (sp - 1) / len(sp) - prior * sp / len(sp), su / len(su)
            else:
                gp, gu = prior * sp / len(sp), -su / len(su)
        else:
            gp, gu = (sp - 1) / len(sp), su / len(su)
        dp, du = np.outer(gp, w2) * (hp > 0), np.outer(gu, w2) * (hu > 0)
        grads = [xp.T @ dp + xu.T @ du + decay * w1, dp.sum(0) + du.sum(0), hp.T @ gp + hu.T @ gu + decay * w2,
                 np.array([gp.sum() + gu.sum()])]
        pace = rate * min(1.0, 2 * (1 - step / (epochs * steps + 1)))
        for w, g, a, b in zip(weights, grads, first, second):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            w -= pace * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return Network(mean, scale, *weights[:3], float(weights[3][0]))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, seed: int = 1) -> float:
    """Share of good texts among the unlabelled: the least ratio of the unlabelled to the positive mass
    above a score, with a margin for small counts. Scores are of rows that were not learnt from."""
    tops_p, tops_u = [], []
    for fold in (0, 1):
        separate = fit(positive[fold::2], unlabelled[fold::2], 0, epochs=15, seed=seed)
        tops_p.append(separate(positive[1 - fold::2]))
        tops_u.append(separate(unlabelled[1 - fold::2]))
    best, at = np.inf, 1.0
    for sp, su in zip(tops_p, tops_u):
        cuts = np.quantile(sp, np.linspace(0.02, 0.98, 97))
        qp, qu = ((s[None, :] >= cuts[:, None]).mean(1) for s in (sp, su))
        margin = (np.log(400) / (2 * len(su))) ** 0.5 + (np.log(400) / (2 * len(sp))) ** 0.5
        bound = (qu + margin) / np.maximum(qp, 1e-9)
        k = int(np.argmin(bound))
        if bound[k] < best:
            best, at = bound[k], qu[k] / qp[k]
    return float(np.clip(at, 0.01, 0.999))


def fold(doc_id: Column, folds: int = 4) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def feature_rows(rows: DataFrame) -> np.ndarray:
    """The features of a bounded table of texts, on the driver."""
    schema = rows.sparkSession.createDataFrame([], "f binary").schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield to_batch(schema, {"f": [features(t).tobytes() for t in text_bytes(batch.column(0))]})

    found = rows.select("text").mapInArrow(run, schema).toLocalIterator()
    return np.array([np.frombuffer(r["f"], np.float32) for r in found], np.float32).reshape(-1, N_FEATURES)


def sampled(rows: DataFrame, limit: int, salt: int) -> DataFrame:
    """About ``limit`` rows chosen by a hash of doc_id and text (all if there are no more)."""
    n = rows.count()
    share = min(1.0, limit / max(1, n))
    return rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(salt)), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, sample: int = 16_000) -> Network | None:
    """A network learnt from the learning folds; None if they hold no positive text."""
    learning = id_and_text(docs).filter(fold(F.col("doc_id"), folds) != held_out)
    good = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
            .filter(fold(F.col("doc_id"), folds) != held_out)
            .groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1").select("doc_id"))
    ids = learning.select("doc_id")
    chosen = sampled(ids.join(good, "doc_id", "left_semi"), sample, 1).distinct()
    positive = feature_rows(learning.join(chosen, "doc_id", "left_semi"))
    if not len(positive):
        return None
    unlabelled = feature_rows(learning.join(sampled(ids, sample, 2).distinct(), "doc_id", "left_semi"))
    prior = estimate_prior(positive, unlabelled)
    return fit(positive, unlabelled, prior)


def scorer(spark, network: Network | None):
    """A column function from text to score."""
    sent = spark.sparkContext.broadcast(network)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        if sent.value is None:
            return pd.Series(np.ones(len(text)))
        found = np.array([features((t or "").encode()) for t in text]).reshape(-1, N_FEATURES)
        return pd.Series(sent.value.score(found).astype(np.float64))

    return score


def scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.7,
           sample: int = 16_000) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    rows = id_and_text(docs)
    score = scorer(rows.sparkSession, train(docs, labels, folds, held_out, sample))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id"), folds) == held_out, F.lit(False)).alias("held_out"),
                       score("text").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents that score ``threshold`` or more, with all their columns."""
    score = scorer(docs.sparkSession, train(docs, labels))
    return docs.filter(score(F.col("text").cast("string")) >= threshold)
