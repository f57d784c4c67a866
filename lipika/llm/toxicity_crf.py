"""Toxicity: a linear-chain conditional random field tags toxic tokens.

Token labels come from labelled documents: a set cover picks the fewest words and word
beginnings that occur in toxic documents and (almost) never in others; their tokens are the
toxic ones. The field has features of a word's form and transitions between two states, and
is trained on windows of those tokens by exact forward-backward gradients. Documents are
tagged as one whole chain each; the marginals of a chain give a document's score (the noisy-or
of their squares, in which the many faint ones of a long text weigh next to nothing, however
many they are) and the offsets of what offends.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lipika.llm._common import small_batches, table

#: At most so many labelled documents of either class are learned from, and so many characters of them (least hashes of doc_id).
SAMPLE_ROWS, SAMPLE_CHARS = 2500, 16_000_000
WINDOW, NEGATIVES = 16, 3
ROUNDS, STEP, RIDGE = 50, 0.25, 1e-4
#: A cue without a counter-example is believed if chance would make one with less than this probability.
CHANCE = 1e-5
#: Tokens with at least this marginal make a span.
SPAN = 0.5
THRESHOLD = 0.5
SEED = 5

_EDGE = re.compile(r"^[^\w]+|[^\w]+$")
_TOKEN = re.compile(r"\S+")


def form(token: str) -> str:
    """A token in lower case without what is no letter or digit at its ends."""
    return _EDGE.sub("", token.lower())


def features(word: str) -> list[str]:
    """Names of a word form's features; the empty form has one."""
    return ["w:" + word, *[f"p{k}:{word[:k]}" for k in (3, 4, 5, 6) if len(word) >= k]]


@dataclass(frozen=True)
class Field:
    """State 1 is toxic. ``trans[a][b]`` and the emissions of state 1 are log potentials."""

    weights: dict[str, float]
    bias: float
    trans: tuple[tuple[float, float], tuple[float, float]]

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


def cues(texts: list[str], toxic: np.ndarray) -> set[str]:
    """Words (``=word``) and beginnings that mark toxic documents.

    A set cover picks the most telling ones; then come those that no other document has and
    that toxic ones have in so many different surroundings that chance can't explain it
    (copies of one document repeat its surroundings, and so count once).
    """
    where: dict[str, list[int]] = defaultdict(list)
    around: dict[str, set[int]] = defaultdict(set)
    clean: Counter = Counter()
    for k, text in enumerate(texts):
        found = set()
        words = [form(t) for t in text.split()]
        if toxic[k]:
            for before, word, after in zip(["", *words], words, [*words[1:], ""], strict=False):
                for c in _candidates(word):
                    around[c].add(hash((before, after)))
                    found.add(c)
            for c in found:
                where[c].append(k)
        else:
            for word in set(words):
                found.update(_candidates(word))
            clean.update(found)
    left = {k for k in range(len(texts)) if toxic[k]}
    support = 2 if len(left) < 200 else 3
    picked: set[str] = set()
    pool = {c: set(ks) for c, ks in where.items() if len(ks) >= support and clean[c] * 50 <= len(ks)}
    while left and pool:
        best = max(pool, key=lambda c: (len(pool[c]) - 20 * clean[c], -len(c), c))
        got = pool.pop(best)
        if len(got) < support:
            break
        picked.add(best)
        left -= got
        pool = {c: rest for c, ks in pool.items() if len(rest := ks - got) >= support}
    share = max(0.1, min(0.9, float(np.mean(toxic))))
    enough = int(np.ceil(np.log(CHANCE) / np.log(share)))
    return picked | {c for c, seen in around.items() if not clean[c] and len(seen) >= enough and len(where[c]) >= enough // 2}


def _candidates(word: str) -> list[str]:
    return ["=" + word, *[word[:n] for n in (4, 5, 6) if len(word) > n]] if len(word) > 2 else []


def _is_cue(word: str, picked: set[str]) -> bool:
    return "=" + word in picked or any(len(word) > n and word[:n] in picked for n in (4, 5, 6))


def _windows(texts: list[str], toxic: np.ndarray, picked: set[str]) -> tuple[list[list[str]], list[list[int]]]:
    """Windows of word forms with their states: all that hold a toxic token, and some at random."""
    rng = np.random.default_rng(SEED)
    words, states = [], []
    for text, t in zip(texts, toxic, strict=True):
        w = [form(x) for x in text.split()]
        if not w:
            continue
        y = [int(bool(t) and _is_cue(x, picked)) for x in w]
        phase = int(rng.integers(0, WINDOW))
        starts = sorted({max(0, (k + phase) // WINDOW * WINDOW - phase) for k in np.flatnonzero(y).tolist()})
        starts += [int(x) for x in rng.integers(0, max(1, len(w) - WINDOW + 1), NEGATIVES)]
        for s in starts:
            words.append(w[s : s + WINDOW])
            states.append(y[s : s + WINDOW])
    return words, states


def fit(texts: list[str], toxic: np.ndarray) -> Field:
    """Trains the field. Without toxic documents every token is found harmless."""
    picked = cues(texts, toxic) if len(texts) and toxic.any() else set()
    if not picked:
        return Field({}, -12.0, ((0.0, 0.0), (0.0, 0.0)))
    words, states = _windows(texts, toxic, picked)
    counts = Counter(f for w in words for x in w for f in features(x))
    toxic_counts = Counter(f for w, y in zip(words, states, strict=True) for x, s in zip(w, y, strict=True) if s for f in features(x))
    names = sorted(counts, key=lambda f: (-toxic_counts[f], -counts[f], f))
    at = {f: k + 1 for k, f in enumerate(names)}
    n = len(words)
    longest = max(map(len, words))
    x = np.zeros((longest, n, 5), np.int32)
    y, live = np.zeros((longest, n), np.int8), np.zeros((longest, n), bool)
    for k, (w, s) in enumerate(zip(words, states, strict=True)):
        for t, word in enumerate(w):
            for j, f in enumerate(features(word)):
                x[t, k, j] = at.get(f, 0)
        y[: len(w), k], live[: len(w), k] = s, True
    weight, bias, trans = np.zeros(len(names) + 1), -2.0, np.zeros((2, 2))
    moments = [np.zeros_like(weight), np.zeros_like(weight), np.zeros(5), np.zeros(5)]
    for r in range(1, ROUNDS + 1):
        p, pairs, seen = _marginals(weight[x].sum(2) + bias, live, trans, y)
        err = np.where(live, y - p, 0.0)
        grad = np.bincount(x.ravel(), np.repeat(err.ravel(), x.shape[2]), len(weight)) / n - RIDGE * weight
        grad[0] = 0
        small = np.concatenate([[err.sum() / n], ((seen - pairs) / n).ravel()])
        small[1:] -= RIDGE * trans.ravel()
        for g, m, v, target in ((grad, 0, 1, "weight"), (small, 2, 3, "rest")):
            moments[m] = 0.9 * moments[m] + 0.1 * g
            moments[v] = 0.99 * moments[v] + 0.01 * g * g
            step = STEP * (moments[m] / (1 - 0.9**r)) / (np.sqrt(moments[v] / (1 - 0.99**r)) + 1e-6)
            if target == "weight":
                weight += step
            else:
                bias += step[0]
                trans += step[1:].reshape(2, 2)
    return Field({f: float(weight[k]) for f, k in at.items() if abs(weight[k]) > 0.02}, float(bias), tuple(map(tuple, trans.tolist())))


def _marginals(e: np.ndarray, live: np.ndarray, trans: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of windows, time first: marginals of state 1, expected and labelled transition counts."""
    steps, n = e.shape
    pot = np.exp(trans - trans.max())
    emit = np.stack([np.ones_like(e), np.exp(np.clip(e, -30, 30))], axis=2)
    alpha = np.zeros((steps, n, 2))
    beta = np.ones((steps, n, 2))
    alpha[0] = emit[0] / emit[0].sum(1, keepdims=True)
    for t in range(1, steps):
        a = (alpha[t - 1] @ pot) * emit[t]
        alpha[t] = np.where(live[t][:, None], a / a.sum(1, keepdims=True), alpha[t - 1])
    expected, seen = np.zeros((2, 2)), np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        after = emit[t] * beta[t]
        b = after @ pot.T
        beta[t - 1] = np.where(live[t][:, None], b / b.sum(1, keepdims=True), beta[t])
        joint = alpha[t - 1][:, :, None] * pot[None] * after[:, None, :]
        joint /= joint.sum((1, 2), keepdims=True)
        expected += joint[live[t]].sum(0)
        np.add.at(seen, (y[t - 1][live[t]], y[t][live[t]]), 1)
    both = alpha * beta
    return both[:, :, 1] / both.sum(2), expected, seen


def chain_marginals(e: np.ndarray, lengths: np.ndarray, trans: tuple) -> np.ndarray:
    """Exact marginals of state 1 for whole chains of any length, one after another in ``e``.

    The ratio of the two states' forward values follows a fractional-linear recursion, as do
    the backward ones; all chains of a batch step together, the longest first.
    """
    a = np.exp(np.array(trans) - np.max(trans))
    start = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begins, sizes = start[order], lengths[order]
    live = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    emit = np.exp(np.clip(e, -30, 30))
    forward, backward = np.empty_like(emit), np.ones_like(emit)
    for t, m in enumerate(live):
        at = begins[:m] + t
        if t == 0:
            r = emit[at]
        else:
            r = emit[at] * (a[0, 1] + a[1, 1] * r[:m]) / (a[0, 0] + a[1, 0] * r[:m])
        forward[at] = r
    ends = begins + sizes - 1
    for t, m in enumerate(live):
        at = ends[:m] - t
        if t == 0:
            s = np.ones(m)
        else:
            q = emit[at + 1] * s[:m]
            s = (a[1, 0] + a[1, 1] * q) / (a[0, 0] + a[0, 1] * q)
        backward[at] = s
    odds = forward * backward
    return odds / (1 + odds)


class _Emissions(dict):
    """Emission by raw token; emptied when it is large."""

    def __init__(self, field: Field) -> None:
        super().__init__()
        self.field = field

    def __missing__(self, token: str) -> float:
        if len(self) > 300_000:
            self.clear()
        v = self[token] = self.field.emission(form(token))
        return v


def _tagger(field: Field):
    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Emissions(field)
        for batch in batches:
            texts = [x or "" for x in batch.column("text").to_pylist()]
            rows = [np.fromiter(map(known.__getitem__, x.split()), float) for x in texts]
            lengths = np.array([len(r) for r in rows], dtype=np.int64)
            p = chain_marginals(np.concatenate(rows) if rows else np.zeros(0), lengths, field.trans)
            ends = np.cumsum(lengths)
            scores, spans = [], []
            for text, m, end in zip(texts, lengths, ends, strict=True):
                own = p[end - m : end]
                scores.append(float(-np.expm1(np.log1p(-np.minimum(own, 1 - 1e-12) ** 2).sum())))
                spans.append(_offsets(text, own) if m and own.max() >= SPAN else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())])))],
                names=["doc_id", "score", "spans"],
            )

    return tag


def _offsets(text: str, p: np.ndarray) -> list[dict]:
    """Spans of toxic tokens in code points, without punctuation at the ends; neighbours are one span."""
    spans, last = [], -2
    for k, m in enumerate(_TOKEN.finditer(text)):
        if p[k] < SPAN:
            continue
        token = m.group()
        core = form(token)
        lead = len(token) - len(re.sub(r"^[^\w]+", "", token)) if core else 0
        tail = len(token) - len(re.sub(r"[^\w]+$", "", token)) if core else 0
        one = {"start": m.start() + lead, "end": m.end() - tail, "p": float(p[k])}
        if last == k - 1:
            spans[-1] = {"start": spans[-1]["start"], "end": one["end"], "p": max(spans[-1]["p"], one["p"])}
        else:
            spans.append(one)
        last = k
    return spans


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id is not held out and has no label."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_chars: int = SAMPLE_CHARS) -> Field:
    """Learns from ``labels.toxic`` of documents that are not held out.

    Repeated labels of a document are averaged; null labels, and labels of no document, are
    not used; null and empty texts teach nothing; of several texts of one doc_id the first in
    order is taken. At most ``sample_rows`` documents of either class, by the hash of doc_id,
    come to the driver, and of these as many whole ones as ``sample_chars`` characters hold.
    """
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").alias("label_id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("label_y"))
    pick = lambda y: known.where(F.col("label_y") == y).orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows)
    ids = pick(1).unionByName(pick(0))
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    sample = texts.join(F.broadcast(ids), F.col("doc_id") == F.col("label_id")).groupBy("label_id", "label_y").agg(F.min("text").alias("text"))
    so_far = F.sum(F.length("text")).over(W.partitionBy("label_y").orderBy(F.xxhash64("label_id"), "label_id").rowsBetween(W.unboundedPreceding, W.currentRow))
    rows = sample.withColumn("so_far", so_far).where(F.col("so_far") <= sample_chars).select("label_id", "label_y", "text").toPandas().sort_values("label_id")
    return fit(rows["text"].tolist(), rows["label_y"].to_numpy(int))


def tagged(docs: DataFrame, field: Field) -> DataFrame:
    """``doc_id, score, spans`` of every row, one for one; doc_id of any type comes back as it is; a null or empty text scores 0 and has no span."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_tagger(field), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, spans array<struct<start:long,end:long,p:double>>")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of the documents, with the offending offsets."""
    docs = table(spark, sf_dir, "documents")
    rows = tagged(docs, train(docs, table(spark, sf_dir, "labels")))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), spans.alias("spans"))


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLES: dict[str, str] = {}
