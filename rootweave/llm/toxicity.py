"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Training uses a bounded sample of labelled documents (``TRAIN_DOCS`` of each label):

1. Evidence of words and word starts: log-odds of standing in a toxic against another document.
   Words of toxic documents that carry evidence are the labelled tokens of class toxic, all other
   tokens are ordinary.
2. A chain with two states. Its parameters are a weight for each level of evidence and for the
   transitions; they maximise the likelihood of the labelled tokens in windows of the sample.
3. A logistic function of the marginals of a document, fitted to the documents' labels.

Scoring reads each document once, without a shuffle: forward-backward over the whole text. Runs of
words without evidence are skipped by powers of their common transition matrix, which is exact.

Only text goes into a score. Defined cases: null or empty text has no tokens and gets the score of
a text without evidence; without labelled documents of both classes every score is 0; several labels
of a document count as their maximum, null labels as none; other columns pass through.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootweave.llm.common import begin, small_batches
from rootweave.workspace import Workspace

TRAIN_DOCS = 6_000
WINDOWS = 6_000
WINDOW = 64
MAX_FEATURES = 50_000
PAD = 255  # no level: behind the end of a text
LEVELS = 12  # of evidence, each half a nat wide; 0 is none
MEMO = 150_000

RESULT = "struct<score: double, spans: array<struct<start: int, end: int, marginal: double>>>"

_OUTSIDE = re.compile(r"[\W\d_]+")


def features(word: str) -> list[str]:
    """The word and its starts of three to seven letters."""
    word = _OUTSIDE.sub("", word.lower())
    return ["=" + word, *(word[:n] for n in range(3, min(len(word), 8)))] if len(word) > 1 else []


@dataclass
class Model:
    """Everything that scoring needs; a few megabytes at most."""

    level: dict[str, int] = field(default_factory=dict)
    weight: np.ndarray = field(default_factory=lambda: np.zeros(LEVELS))
    into: float = 0.0  # transition weights; ordinary to ordinary is 0
    stay: float = 0.0
    leave: float = 0.0
    logit: tuple[float, ...] = (-math.inf, 0.0, 0.0)


class _Levels(dict):
    """Level of evidence by word as written."""

    def __init__(self, level: dict[str, int]):
        super().__init__()
        self.level = level

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = max((self.level.get(f, 0) for f in features(word)), default=0)
        return found


class Tagger:
    """Marginals of single documents."""

    def __init__(self, model: Model):
        self.model = model
        self.levels = _Levels(model.level)
        w, into, stay, leave = model.weight, model.into, model.stay, model.leave
        # step[l][from][to]: factor of a token with evidence level l.
        self.step = [np.array([[1.0, math.exp(into + x)], [math.exp(leave), math.exp(stay + x)]]) for x in w]
        self.runs = [np.eye(2), self.step[0]]

    def run(self, length: int) -> np.ndarray:
        """Product of ``length`` steps without evidence, up to a factor."""
        if length >= 4_096:
            half = self.run(length // 2)
            product = half @ half @ self.run(length % 2)
            return product / product.max()
        while len(self.runs) <= length:
            product = self.runs[-1] @ self.step[0]
            self.runs.append(product / product.max())
        return self.runs[length]

    def marginals(self, levels: list[int]) -> list[tuple[int, float]]:
        """(token, probability of being toxic) of the tokens with evidence."""
        places = [i for i, level in enumerate(levels) if level]
        if not places:
            return []
        forward, before, state = [], -1, np.array([1.0, 0.0])
        for i in places:
            state = state @ self.run(i - before - 1) @ self.step[levels[i]]
            state = state / state.sum()
            forward.append(state)
            before = i
        found, after, state = [], len(levels), np.array([1.0, 1.0])
        for i, ahead in zip(reversed(places), reversed(forward)):
            state = self.run(after - i - 1) @ state
            both = ahead * state
            found.append((i, float(both[1] / both.sum())))
            state = self.step[levels[i]] @ state
            state = state / state.sum()
            after = i
        return found[::-1]

    def aggregate(self, text: str) -> tuple[float, float, list[tuple[int, float]]]:
        """Largest marginal, log of one plus their sum, and the marginals themselves."""
        found = self.marginals(list(map(self.levels.__getitem__, text.split())))
        values = [p for _, p in found]
        return max(values, default=0.0), math.log1p(sum(values)), found

    def score(self, text: str, threshold: float = 0.5) -> dict:
        most, total, found = self.aggregate(text)
        bias, a, b = self.model.logit
        spans = []
        if most >= threshold:
            starts, at = [], 0
            words = text.split()
            for word in words:
                starts.append(text.index(word, at))
                at = starts[-1] + len(word)
            spans = [{"start": starts[i], "end": starts[i] + len(words[i]), "marginal": p} for i, p in found if p >= threshold]
        x = bias + a * most + b * total
        return {"score": 1.0 / (1.0 + math.exp(-x)) if x > -700 else 0.0, "spans": spans}


def is_held_out(id_col: str) -> Column:
    """Rows that are never learnt from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", per_label: int = TRAIN_DOCS
) -> tuple[DataFrame, dict[int, float]]:
    """(text, label) of about ``per_label`` documents of each label, and the share taken of each."""
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(id_col))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) > 0).cast("int").alias("_label"))
    counts = {row["_label"]: row["count"] for row in known.groupBy("_label").count().collect()}
    share = {label: min(1.0, per_label / n) for label, n in counts.items()}
    limit = F.when(F.col("_label") == 1, F.lit(int(share.get(1, 0) * (1 << 30)))).otherwise(F.lit(int(share.get(0, 0) * (1 << 30))))
    chosen = known.filter(F.pmod(F.xxhash64("_id"), F.lit(1 << 30)) < limit)
    # At most some 2 * per_label ids, hence the broadcast.
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    return texts.select("_text", "_label"), share


def _count_documents(sample: DataFrame, among: set[str] | None = None) -> DataFrame:
    """(feature, toxic, other): documents with each feature, or with those ``among``, by label."""
    shared = sample.sparkSession.sparkContext.broadcast(among)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        among = shared.value
        for batch in batches:
            toxic, other = Counter(), Counter()
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if among is None and not label:
                    continue  # what never stands in a toxic document is no evidence
                found = {f for word in set((text or "").split()) for f in features(word) if among is None or f in among}
                (toxic if label else other).update(found)
            names = list(toxic | other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *(pa.array([n[f] for f in names], pa.int64()) for n in (toxic, other))],
                names=["feature", "toxic", "other"],
            )

    rows = sample.mapInArrow(counted, "feature string, toxic long, other long")
    return rows.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def evidence(sample: DataFrame, toxic_docs: int, other_docs: int, least: int = 5) -> dict[str, int]:
    """Level of evidence by feature, for the ``MAX_FEATURES`` features in most toxic documents, but in at least ``least``."""
    frequent = _count_documents(sample).filter(F.col("toxic") >= least).orderBy(F.desc("toxic"), "feature").limit(MAX_FEATURES)
    level = {}
    for feature, toxic, other in _count_documents(sample, {row[0] for row in frequent.collect()}).collect():
        odds = math.log((toxic + 0.5) / (toxic_docs + 1)) - math.log((other + 0.5) / (other_docs + 1))
        if odds > 1:
            level[feature] = max(1, min(LEVELS - 1, int(odds * 2) - 1))
    return level


def _window_rows(sample: DataFrame, level: dict[str, int]) -> tuple[list, float]:
    """Windows with evidence, at most ``WINDOWS``, and the number of those without.

    Every token is in one window; the last one of a text is filled up with ``PAD``, so that short texts count too.
    """
    shared = sample.sparkSession.sparkContext.broadcast(level)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        levels = _Levels(shared.value)
        for batch in batches:
            kept, labels, empty = [], [], 0
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = list(map(levels.__getitem__, (text or "").split()))
                for at in range(0, len(found), WINDOW):
                    part = found[at : at + WINDOW]
                    if any(part):
                        kept.append(bytes(part).ljust(WINDOW, bytes([PAD])))
                        labels.append(label)
                    else:
                        empty += len(part)  # tokens
            n = len(kept)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*kept, None], pa.binary()), pa.array([*labels, 0], pa.int32()), pa.array([0] * n + [empty], pa.int64())],
                names=["part", "label", "empty"],
            )

    rows = sample.mapInArrow(windows, "part binary, label int, empty long")
    empty = rows.filter("part IS NULL").agg(F.coalesce(F.sum("empty"), F.lit(0))).first()[0]
    chosen = rows.filter("part IS NOT NULL").orderBy(F.xxhash64("part"), "part", "label").limit(WINDOWS)
    return [(row[0], row[1]) for row in chosen.select("part", "label").collect()], empty / WINDOW


def fit_chain(parts: np.ndarray, toxic: np.ndarray, empty: float, rounds: int = 80, rate: float = 0.25, decay: float = 0.01):
    """Weights of the levels and (into, stay, leave) by gradient ascent on the likelihood of the labelled tokens.

    ``parts`` holds levels (window x token), ``PAD`` behind the end of a text, and ``toxic`` whether the window's
    document is toxic; one more window stands for the ``empty`` ones.
    """
    parts = np.vstack([parts, np.zeros((1, parts.shape[1]), parts.dtype)])
    live = parts != PAD
    parts = np.where(live, parts, 0)
    labels = (parts > 0) & np.append(toxic, False)[:, None]
    mass = np.append(np.ones(len(parts) - 1), max(empty, 1))
    mass /= mass.sum()
    steps = parts.shape[1]
    before = np.hstack([np.zeros((len(parts), 1), bool), labels[:, :-1]])
    seen = np.array([(mass[:, None] * hit).sum() for hit in (~before & labels, before & labels, before & ~labels & live)])
    seen_level = np.bincount(parts.ravel(), (mass[:, None] * labels).ravel(), LEVELS)
    theta = np.concatenate([np.full(LEVELS, -2.0), [-1.0, 0.0, 0.0]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, rounds + 1):
        x = np.exp(np.clip(theta[:LEVELS], -30, 30))[parts]
        into, stay, leave = np.exp(theta[LEVELS:])
        a = np.zeros((steps + 1, 2, len(parts)))
        a[0, 0] = 1.0
        scale = np.ones((steps + 1, len(parts)))
        for t in range(steps):
            zero, one = a[t, 0] + a[t, 1] * leave, (a[t, 0] * into + a[t, 1] * stay) * x[:, t]
            scale[t + 1] = zero + one
            # Behind the end nothing changes any more.
            a[t + 1] = np.where(live[:, t], [zero / scale[t + 1], one / scale[t + 1]], a[t])
        b0 = b1 = np.ones(len(parts))
        expected, expected_level = np.zeros(3), np.zeros(LEVELS)
        for t in range(steps - 1, -1, -1):
            f = x[:, t] / scale[t + 1]
            p01, p11, p10 = live[:, t] * [a[t, 0] * into * f * b1, a[t, 1] * stay * f * b1, a[t, 1] * leave / scale[t + 1] * b0]
            expected += [(mass * p).sum() for p in (p01, p11, p10)]
            expected_level += np.bincount(parts[:, t], mass * (p01 + p11), LEVELS)
            earlier = [b0 / scale[t + 1] + into * f * b1, leave / scale[t + 1] * b0 + stay * f * b1]
            b0, b1 = np.where(live[:, t], earlier, [b0, b1])
        gradient = np.concatenate([seen_level - expected_level, seen - expected]) - decay * 1e-3 * theta
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        theta = theta + rate * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-9)
    return theta[:LEVELS], theta[LEVELS:]


def fit_logit(x: np.ndarray, y: np.ndarray, mass: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Weighted logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    theta = np.zeros(x.shape[1])
    mass = mass / mass.sum() * len(mass)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        curve = (x * (mass * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(theta))
        theta = theta + np.clip(np.linalg.solve(curve, x.T @ (mass * (y - p)) - ridge * theta), -5, 5)
    return tuple(map(float, theta))


def train(docs: DataFrame, labels: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model from the labelled documents that are not held out; see the module for its steps."""
    small_batches(docs.sparkSession)
    sample, share = labelled_sample(docs, labels, id_col, text_col, label_col)
    sample = ws.stage(sample, "sample")
    counts = {row["_label"]: row["count"] for row in sample.groupBy("_label").count().collect()}
    if not (counts.get(0) and counts.get(1)):
        return Model()
    level = evidence(sample, counts[1], counts[0])
    rows, empty = _window_rows(sample, level)
    model = Model(level)
    if rows:
        parts = np.frombuffer(b"".join(bytes(part) for part, _ in rows), np.uint8).reshape(len(rows), WINDOW)
        model.weight, (model.into, model.stay, model.leave) = fit_chain(parts, np.array([label == 1 for _, label in rows]), empty)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def aggregates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("toxicity")
        tagger = Tagger(shared.value)
        for batch in batches:
            found = [tagger.aggregate(text or "")[:2] for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.float64()), pa.array([b for _, b in found], pa.float64()), batch.column(1)],
                names=["most", "total", "label"],
            )

    table = sample.mapInArrow(aggregates, "most double, total double, label int").toArrow()
    y = table["label"].to_numpy()
    x = np.column_stack([table["most"].to_numpy(), table["total"].to_numpy()])
    mass = np.where(y == 1, 1 / share[1], 1 / share[0])
    model.logit = fit_logit(x, y, mass)
    return model


def score(docs: DataFrame, model: Model, text_col: str = "text", result_col: str = "toxicity") -> DataFrame:
    """``docs`` with ``result_col``: the document's score and its offending spans (code points, end exclusive)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        begin("toxicity")
        tagger = Tagger(shared.value)
        kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([
            ("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.float64())])))])
        for batch in batches:
            yield pa.array([tagger.score(text or "") for text in batch.to_pylist()], kind)

    return docs.withColumn(result_col, scored.asNondeterministic()(F.col(text_col)))
