"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees are grown on a bounded sample of labelled documents; every path from a
root to a node is a conjunctive rule over the statistics. A lasso logistic regression gives
most rules no weight; the others become one Spark column expression, so scoring is a
projection over the scan, without Python and without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lipika.llm._common import bound, table

#: At most so many labelled documents are fitted to (those with the least hash of doc_id).
SAMPLE_ROWS = 12_000
TREES, DEPTH, BINS, RATE, PART = 40, 3, 32, 0.3, 0.5
LASSO = 5e-4
SEED = 11
THRESHOLD = 0.7

_STATISTICS = ("n_words", "word_length", "upper", "symbols", "digits", "distinct", "repeated", "symbol_words", "stops", "longest")


def statistics(text: Column) -> Column:
    """The statistics of a whole text, as a struct; a null text counts as empty, of which all are 0."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    words = lambda t: F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return bound(F.struct(text.alias("t"), words(text).alias("w")), lambda x: _statistics(x["t"], x["w"]))


def _statistics(text: Column, words: Column) -> Column:
    size, length = F.size(words), F.length(text)
    n, chars = F.greatest(size, F.lit(1)), F.greatest(length, F.lit(1))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))
    again = F.size(F.filter(F.sequence(F.lit(2), F.greatest(size, F.lit(2))), lambda i: F.coalesce(F.try_element_at(words, i) == F.try_element_at(words, i - 1), F.lit(False))))
    values = {
        "n_words": F.log1p(size),
        "word_length": (length - size) / n,
        "upper": count(r"\p{Lu}") / chars,
        "symbols": count(r"[#*%$&|!~^<>{}\[\]=@_/\\]") / chars,
        "digits": count(r"[0-9]") / chars,
        "distinct": F.size(F.array_distinct(words)) / n,
        "repeated": again / n,
        "symbol_words": count(r"[^\p{L}\p{N}\x20\x09-\x0D]{2}(?![^\x20\x09-\x0D])") / n,
        "stops": count(r"[.!?](?![^\x20\x09-\x0D])") / n,
        "longest": F.log1p(F.coalesce(F.array_max(F.transform(words, lambda w: F.length(w))), F.lit(0))),
    }
    return F.struct(*[values[k].cast("double").alias(k) for k in _STATISTICS])


@dataclass(frozen=True)
class Rules:
    """Weighted conjunctions; a condition is ``(statistic, above, threshold)``."""

    bias: float
    weighted: tuple[tuple[float, tuple[tuple[int, bool, float], ...]], ...]

    def score(self, text: Column) -> Column:
        """Probability of label 1 of a whole text."""

        def weigh(s: Column) -> Column:
            total = F.lit(self.bias)
            for weight, conditions in self.weighted:
                holds = F.lit(True)
                for k, above, at in conditions:
                    c = s[_STATISTICS[k]]
                    holds = holds & ((c > at) if above else (c <= at))
                total = total + F.when(holds, weight).otherwise(0.0)
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

        return bound(statistics(text), weigh)


def _grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, cuts: list[np.ndarray], rows: np.ndarray, path: tuple, depth: int, out: list, step: np.ndarray) -> None:
    """One regression tree on binned statistics; adds each node's path, sets the leaves' steps."""
    g, h = grad[rows].sum(), hess[rows].sum()
    best = (1e-6, -1, 0)
    if depth:
        for k, cut in enumerate(cuts):
            if not len(cut):
                continue
            gs = np.bincount(x[rows, k], grad[rows], len(cut) + 1).cumsum()[:-1]
            hs = np.bincount(x[rows, k], hess[rows], len(cut) + 1).cumsum()[:-1]
            gain = gs**2 / (hs + 1) + (g - gs) ** 2 / (h - hs + 1) - g**2 / (h + 1)
            gain[(hs < 1e-3) | (h - hs < 1e-3)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), k, int(gain.argmax()))
    if best[1] < 0:
        step[rows] = g / (h + 1)
        return
    _, k, b = best
    low = x[rows, k] <= b
    for above, part in ((False, rows[low]), (True, rows[~low])):
        longer = (*path, (k, above, float(cuts[k][b])))
        out.append(longer)
        _grow(x, grad, hess, cuts, part, longer, depth - 1, out, step)


def _merged(path: tuple) -> tuple:
    """The same conjunction with one bound for each statistic and direction."""
    bounds: dict = {}
    for k, above, at in path:
        old = bounds.get((k, above), at)
        bounds[k, above] = max(old, at) if above else min(old, at)
    return tuple((k, above, at) for (k, above), at in sorted(bounds.items()))


def fit(x: np.ndarray, y: np.ndarray) -> Rules:
    """Rules from a sample. With one class only, or none, the score is the smoothed share of label 1."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2)
    bias = float(np.log(share / (1 - share)))
    if n == 0 or y.min() == y.max():
        return Rules(bias, ())
    rng = np.random.default_rng(SEED)
    cuts = [np.unique((np.unique(q)[1:] + np.unique(q)[:-1]) / 2) for q in (np.quantile(c, np.linspace(0, 1, BINS + 1)) for c in x.T)]
    binned = np.stack([np.searchsorted(cut, c, side="left") for cut, c in zip(cuts, x.T, strict=True)], axis=1)
    margin, paths = np.full(n, bias), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(n) < PART)
        found: list = []
        step = np.zeros(n)
        _grow(binned, y - p, p * (1 - p), cuts, rows, (), DEPTH, found, step)
        paths += found
        margin += RATE * step
    rules = sorted({_merged(p) for p in paths})
    holds = np.ones((n, len(rules)), dtype=np.float32)
    for r, rule in enumerate(rules):
        for k, above, at in rule:
            holds[:, r] *= (x[:, k] > at) if above else (x[:, k] <= at)
    keep = np.flatnonzero((holds.mean(0) > 0.002) & (holds.mean(0) < 0.998))
    keep = keep[np.unique(holds[:, keep], axis=1, return_index=True)[1]]
    weights, bias = lasso_logistic(holds[:, keep], y, LASSO)
    return Rules(bias, tuple((float(w), rules[k]) for w, k in zip(weights, keep, strict=True) if w))


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty on the weights, by accelerated proximal gradient."""
    n = len(y)
    spread = np.maximum(x.std(0), 0.05)
    z = ((x - x.mean(0)) / spread).astype(np.float32)
    v = np.ones(z.shape[1], np.float32)
    for _ in range(15):
        v = z.T @ (z @ v)
        v /= np.linalg.norm(v) + 1e-12
    rate = 1 / (0.25 * (float(v @ (z.T @ (z @ v))) / n + 1) * 1.05)
    w = u = np.zeros(z.shape[1])
    b = c = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    t = 1.0
    for _ in range(rounds):
        r = 1 / (1 + np.exp(-(z @ u.astype(np.float32) + c))) - y
        w2 = u - rate * (z.T @ r.astype(np.float32)) / n
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - rate * penalty, 0)
        b2 = c - rate * r.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u, c = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    w = w / spread
    return w, float(b - w @ x.mean(0))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id is not held out and has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Rules:
    """Fits rules to ``labels.quality`` of documents that are not held out.

    Repeated labels of a document are averaged; labels that are null, or of no document, are
    not used; of several texts of one doc_id the one with the least statistics is taken. The
    statistics of at most ``sample_rows`` documents, by the hash of doc_id, come to the driver.
    """
    ids = (
        labels.where("quality is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("label_id")).agg((F.avg("quality") >= 0.5).cast("double").alias("label_y"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows)
    )
    sample = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("label_id"))
    sample = sample.groupBy("label_id", "label_y").agg(F.min(statistics(F.col("text"))).alias("s"))
    rows = sample.select("label_id", "label_y", "s.*").toPandas().sort_values("label_id")
    return fit(rows[list(_STATISTICS)].to_numpy(float).reshape(-1, len(_STATISTICS)), rows["label_y"].to_numpy(float))


def scored(docs: DataFrame, rules: Rules) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row, one for one; nothing but the text is scored."""
    score = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), rules.score(F.col("text")).alias("score"))
    return score.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good_documents(docs: DataFrame, rules: Rules) -> DataFrame:
    """The rows of ``docs`` that score ``THRESHOLD`` or more; columns unchanged."""
    return docs.where(rules.score(F.col("text")) >= THRESHOLD)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text of the documents."""
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op2_quality": op2_quality}
ORACLES: dict[str, str] = {}
