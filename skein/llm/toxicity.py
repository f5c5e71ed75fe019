"""Toxicity by weak supervision.

1. A bounded sample of labelled rows (``SampleBounds``; the training folds only)
   gives voters: lexicon entries (words) and patterns (beginnings of words) that
   occur almost only in toxic rows, and two voters for the other side (no
   lexicon entry, no pattern).
2. A generative label model is fitted to the votes by expectation-maximisation,
   without the labels: each voter's rates of voting in either class, and the
   correlations of voters within a class; a voter's vote counts the less the
   more of it others repeat.
3. A linear classifier (logistic regression) over words and beginnings of words
   is trained on the model's posterior labels, weighted back to the classes'
   shares in all labelled rows, so 0.3 means 0.3.

Scoring is one pass over all whole texts, without a shuffle; what is sent to the
executors is the classifier: at most ``SampleBounds.features`` weights.

Defined cases: null and empty texts get the score of no evidence; labels that
are null, or whose document is missing, are not used; a document labelled twice
counts by its highest label; without labels of both classes the score is the
share of class 1 (0 without labels); a null id is in no held-out fold and is never
trained on; rows of equal id, and texts of any length, are scored one by one, whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skein.llm.textarrays import NOT_TERM, Texts, mix, owners, slices
from skein.llm.workers import map_batches, tidy

THRESHOLD = 0.3
#: Lengths in bytes of the beginnings of words that count as patterns.
PREFIXES = (3, 4, 5, 6, 7)
_U = np.uint64


@dataclass(frozen=True)
class SampleBounds:
    """The training sample: so many labelled rows of each class, in the order of a hash of the id."""

    positives: int = 2_000
    negatives: int = 4_000
    #: Longer texts are not sampled (they are scored, whole, like all others).
    characters: int = 40_000
    #: Features of the classifier, and voters of the label model.
    features: int = 1_500
    voters: int = 150


def evidence(array: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """(text, feature) of every word and every beginning of a longer word, with repeats; and the number of texts.

    Bit 0 of a feature tells words (0) from beginnings (1).
    """
    lowered = Texts(pc.utf8_lower(array.cast(pa.large_string())))
    starts, ends, bounds = lowered.spans(NOT_TERM)
    owner = owners(bounds)
    who, what = [owner], [lowered.span_hash(starts, ends) & ~_U(1)]
    for k in PREFIXES:
        longer = np.flatnonzero(ends - starts > k)
        a = starts[longer]
        who.append(owner[longer])
        what.append(mix(lowered.span_hash(a, a + k) + _U(k)) | _U(1))
    return np.concatenate(who), np.concatenate(what), lowered.n


class LabelModel:
    """Voters' rates and correlations by expectation-maximisation; ``posterior`` labels."""

    def __init__(self, fires: np.ndarray, votes: np.ndarray, prior: float, rounds: int = 20):
        """``fires``: (rows, voters) 0/1; ``votes``: the class that each voter votes for when it fires."""
        x = fires.astype(np.float64)
        n = len(x)
        q = np.clip(prior + 0.45 * np.sign(x @ np.where(votes == 1, 1.0, -0.5)), 0.02, 0.98)
        for _ in range(rounds):
            q = np.clip(q, 1e-6, 1 - 1e-6)
            self.prior = float(q.mean())
            self.rate = [(np.clip((w @ x + 0.5) / (w.sum() + 1.0), 1e-4, 1 - 1e-4)) for w in (1 - q, q)]
            self.correlation = sum(self._correlation(x, w) * (w.sum() / n) for w in (1 - q, q))
            excess = np.clip(self.correlation, 0, 1)
            np.fill_diagonal(excess, 0)
            self.share = 1.0 / (1.0 + excess.sum(axis=1))
            q = self.posterior(fires)
        self.votes = votes

    @staticmethod
    def _correlation(x: np.ndarray, w: np.ndarray) -> np.ndarray:
        total = max(w.sum(), 1e-9)
        mean = w @ x / total
        c = x - mean
        cov = (c * w[:, None]).T @ c / total
        sd = np.sqrt(np.clip(np.diag(cov), 1e-9, None))
        return cov / sd[:, None] / sd[None, :]

    def posterior(self, fires: np.ndarray) -> np.ndarray:
        x = fires.astype(np.float64)
        b, a = self.rate
        on, off = np.log(a / b) * self.share, np.log((1 - a) / (1 - b)) * self.share
        z = np.log(self.prior / (1 - self.prior)) + x @ on + (1 - x) @ off
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Classifier:
    """``features`` ascending, their weights, and the intercept."""

    features: np.ndarray
    weights: np.ndarray
    intercept: float

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.features >> _U(1) & _U((1 << 20) - 1)).astype(np.int64)] = True

    def score(self, array: pa.Array) -> np.ndarray:
        who, what, n = evidence(array)
        total = np.zeros(n)
        if len(self.features):
            some = np.flatnonzero(self.maybe[(what >> _U(1) & _U((1 << 20) - 1)).astype(np.int64)])
            k = np.minimum(np.searchsorted(self.features, what[some]), len(self.features) - 1)
            ok = self.features[k] == what[some]
            pairs = np.unique(who[some[ok]] * len(self.features) + k[ok])
            total = np.bincount(pairs // len(self.features), weights=self.weights[pairs % len(self.features)], minlength=n)
        return 1 / (1 + np.exp(-np.clip(total + self.intercept, -40, 40)))


def train(texts: pa.Array, toxic: np.ndarray, share: float, bounds: SampleBounds = SampleBounds()) -> tuple[Classifier, LabelModel | None]:
    """Fit to a sample; ``share``: the share of class 1 among all labelled rows."""
    n1, n0 = int(toxic.sum()), int((1 - toxic).sum())
    if not n1 or not n0:
        s = min(max(share, 1e-9), 1 - 1e-9)
        return Classifier(np.zeros(0, _U), np.zeros(0), float(np.log(s / (1 - s)))), None
    seen = []
    for part in slices(pa.RecordBatch.from_arrays([texts], names=["text"])):
        who, what, n = evidence(part.column(0))
        base = sum(s[2] for s in seen)
        order = np.lexsort((what, who))
        who, what = who[order], what[order]
        new = np.append(True, (who[1:] != who[:-1]) | (what[1:] != what[:-1])) if len(who) else np.zeros(0, bool)
        seen.append((who[new] + base, what[new], n))
    who, what = np.concatenate([s[0] for s in seen]), np.concatenate([s[1] for s in seen])
    features, code = np.unique(what, return_inverse=True)
    pos = np.bincount(code, weights=toxic[who], minlength=len(features))
    neg = np.bincount(code, minlength=len(features)) - pos
    rate1, rate0 = (pos + 0.1) / (n1 + 0.2), (neg + 0.1) / (n0 + 0.2)
    least = max(2, n1 // 250)
    # features that tell the classes apart by more than chance among so many (a G test),
    # the most informative first, as many as the bound allows
    gain = np.abs(rate1 - rate0) * np.abs(np.log(rate1 / rate0))
    enough = np.flatnonzero(pos + neg >= max(3, least))
    expected1 = (pos + neg) * n1 / (n1 + n0)
    expected0 = (pos + neg) - expected1
    g = 2 * (pos * np.log(np.maximum(pos, 1e-9) / expected1) + neg * np.log(np.maximum(neg, 1e-9) / expected0))
    enough = enough[g[enough] >= 2 * np.log(max(2, len(enough))) + 2]
    picked = np.sort(enough[np.argsort(-gain[enough], kind="stable")[: bounds.features]])
    # voters: almost only in toxic rows
    sharp = picked[(pos[picked] >= least) & (rate1[picked] > 30 * rate0[picked])]
    voters = np.sort(sharp[np.argsort(-gain[sharp], kind="stable")[: bounds.voters]])
    to = np.full(len(features), -1)
    to[picked] = np.arange(len(picked))
    x = np.zeros((len(toxic), len(picked)), np.float32)
    hit = to[code] >= 0
    x[who[hit], to[code[hit]]] = 1
    pattern = (features[voters] & _U(1)).astype(bool)
    fires = x[:, to[voters]]
    none = [(fires[:, kind].sum(axis=1) == 0).astype(np.float32) for kind in (~pattern, pattern)]
    fires = np.column_stack([fires, *none])
    model = LabelModel(fires, np.append(np.ones(len(voters)), [0, 0]), n1 / len(toxic))
    q = model.posterior(fires)
    # rows weighted back to the classes' shares
    weight = q * share / (n1 / len(toxic)) + (1 - q) * (1 - share) / (n0 / len(toxic))
    w, b = _logistic(x, q, weight)
    keep = np.abs(w) > 1e-3
    return Classifier(features[picked][keep], w[keep].astype(np.float64), b), model


def _logistic(x: np.ndarray, q: np.ndarray, weight: np.ndarray, l2: float = 2e-6, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels: Adam on the whole sample, so reruns agree."""
    n, d = x.shape
    w, m, v = np.zeros(d + 1), np.zeros(d + 1), np.zeros(d + 1)
    w[d] = np.log(np.clip(np.average(q, weights=weight), 1e-6, 1 - 1e-6) / (1 - np.clip(np.average(q, weights=weight), 1e-6, 1 - 1e-6)))
    weight = weight / weight.sum()
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:d].astype(np.float32) + w[d], -40, 40)))
        e = weight * (p - q)
        g = np.append(x.T @ e.astype(np.float32) + l2 * w[:d], e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-9)
    return w[:d], float(w[d])


def fold(doc_id) -> F.Column:
    """crc32(doc_id as text) mod 4; -1 for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)), F.lit(-1))


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 2, bounds: SampleBounds = SampleBounds()) -> Classifier:
    """The classifier, from labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .where(fold(F.col("doc_id")) != held_out)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    counts = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    by_hash = known.withColumn("h", F.xxhash64("doc_id"))
    chosen = [by_hash.where(f"toxic = {k}").orderBy("h", "doc_id").limit(n) for k, n in ((1, bounds.positives), (0, bounds.negatives))]
    ids = chosen[0].unionByName(chosen[1]).select("doc_id", "toxic")  # no more rows than the bounds
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.length("text") <= bounds.characters).join(F.broadcast(ids), "doc_id")
    sample = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.max("text").alias("text")).orderBy("doc_id").toArrow()
    return train(sample.column("text").combine_chunks(), sample.column("toxic").to_numpy().astype(np.float64), share, bounds)[0]


def scored(docs: DataFrame, classifier: Classifier, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted`` for every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                s = shared.value.score(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(map_batches, run, "doc_id long, score double, predicted int")
