"""Toxicity by multiple-instance learning: a document is toxic if any of its sentences is.

Each sentence has a logistic score from the words it holds; the noisy-or of the sentence scores is
the document's. Only documents are labelled, so the sentence weights are trained through the
noisy-or, and afterwards name the sentences at fault.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levyflow.llm.shared import ship_package, stored

# Labelled documents of each class that training reads at most, chosen by the hash of their keys.
SAMPLE = 4000
# Word features with weights, the most telling ones of the sample.
FEATURES = 4096
# Standard deviations by which a feature must be more or less frequent in toxic documents than in others,
# and documents of the sample that it must be in.
TELLING, LEAST_DOCS = 4.0, 3
THRESHOLD = 0.7
SENTENCE_THRESHOLD = 0.5
# Few steps: held-out documents are caught best before the weights have settled.
STEPS, RATE, RIDGE = 100, 0.1, 1e-3
KNOWN_WORDS = 500_000
_HASH = (1 << 22) - 1
_SENTENCE = re.compile(r"[^.!?\n]+")
_EDGE = re.compile(r"^\W+|\W+$")
# A word counts as a whole and by its beginnings: words grow endings, insults keep their stems.
_STEMS = (4, 5, 6)


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself and its beginnings."""
    word = _EDGE.sub("", word)
    if not word:
        return ()
    names = [f"={word}", *[f"^{word[:n]}" for n in _STEMS if len(word) >= n]]
    return tuple(zlib.crc32(n.encode("utf-8", "surrogatepass")) & _HASH for n in names)


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """``start, end, words`` of every stretch without a full stop, question mark or line end."""
    for m in _SENTENCE.finditer(text):
        words = m[0].lower().split()
        if words:
            yield m.start(), m.end(), words


@dataclass(frozen=True)
class ToxicityModel:
    """Weights by hashed feature, of either sign, and the weight of a sentence without any of them."""

    weights: dict[int, float]
    bias: float

    def scorer(self) -> _Scorer:
        return _Scorer(self)


class _Scorer:
    def __init__(self, model: ToxicityModel):
        self.model, self.known = model, {}
        # What a sentence without a telling word adds to the document.
        self.plain = float(np.logaddexp(0, model.bias))

    def __call__(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and ``start, end, score`` of the sentences that are toxic by themselves."""
        total, faults, known = 0.0, [], self.known
        if len(known) > KNOWN_WORDS:
            known.clear()
        for start, end, words in sentences(text):
            # A feature counts once a sentence, as in training.
            found: set[int] = set()
            for w in words:
                got = known.get(w)
                if got is None:
                    got = known[w] = tuple(f for f in word_features(w) if f in self.model.weights)
                if got:
                    found.update(got)
            if not found:
                total += self.plain
                continue
            z = self.model.bias + math.fsum(self.model.weights[f] for f in found)
            total += float(np.logaddexp(0, z))
            if z >= 0:  # SENTENCE_THRESHOLD
                faults.append((start, end, 1 / (1 + float(np.exp(-z)))))
        return float(-np.expm1(-total)), faults


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE,
    features: int = FEATURES, least_docs: int = LEAST_DOCS,
) -> ToxicityModel:
    """Fit on at most ``sample`` documents of each class; classes keep their weight in ``labels``.

    The model has weights for the ``features`` most telling features that ``least_docs`` or more documents of the
    sample hold. Null and empty texts are documents without a sentence.

    Labels other than 0 and 1, null labels and keys without a document teach nothing. A document with
    several labels has the largest. With no labelled documents the model scores everything 0.
    """
    ship_package(docs.sparkSession)
    named = (
        labels.select(F.col(key).cast("long").alias("key"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("key").isNotNull())
        .groupBy("key").agg(F.max("y").alias("y"))
    )
    sizes = {r["y"]: r["n"] for r in named.groupBy("y").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for y in (0, 1):
        part = named.where(F.col("y") == y).orderBy(F.xxhash64("key"), "key").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    # The sample is bounded: at most two classes of ``sample`` keys.
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    schema = "key long, y int, feature array<int>, sentence array<int>"
    held = stored(texts.join(F.broadcast(chosen), "key").mapInArrow(_instances, schema), "toxicity_sample")
    telling = _telling(held, features, least_docs)
    if not len(telling):
        return ToxicityModel({}, -30.0)
    return _fit(held.mapInArrow(lambda batches: _only(batches, telling), schema).toArrow().sort_by("key"), telling, sizes)


def _telling(held: DataFrame, features: int, least_docs: int) -> np.ndarray:
    """The features that are clearly more or less frequent in toxic documents, the most telling ones."""
    share = held.agg(F.avg("y")).first()[0] or 0.0
    spread = F.sqrt(F.col("n") * F.lit(share * (1 - share)))
    counts = (
        held.select("y", F.explode(F.array_distinct("feature")).alias("feature")).where("feature >= 0")
        .groupBy("feature").agg(F.count("*").alias("n"), F.sum("y").alias("toxic"))
        .where(F.col("n") >= least_docs)
        .withColumn("telling", (F.col("toxic") - F.col("n") * share) / F.greatest(spread, F.lit(1e-9)))
        .where(F.abs("telling") >= TELLING)
    )
    top = counts.orderBy(F.desc(F.abs("telling")), "feature").limit(features)
    return np.array(sorted(r["feature"] for r in top.collect()), dtype=np.int32)


def _only(batches: Iterator[pa.RecordBatch], telling: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Keeps the telling features, by their position, and the last sentence's number."""
    for batch in batches:
        features, numbers = [], []
        for own, at in zip(*[batch.column(c).to_numpy(zero_copy_only=False) for c in (2, 3)]):
            place = np.searchsorted(telling, own)
            place[place == len(telling)] = 0
            keep = telling[place] == own
            features.append(np.append(place[keep], -1).astype(np.int32))
            numbers.append(np.append(at[keep], at[-1]).astype(np.int32))
        kind = pa.list_(pa.int32())
        columns = [batch.column(0), batch.column(1), pa.array(features, kind), pa.array(numbers, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["key", "y", "feature", "sentence"])


def _instances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The features of each document with the number of their sentence, once for each sentence."""
    known: dict[str, tuple[int, ...]] = {}
    for batch in batches:
        features, numbers = [], []
        for body in batch.column(1).to_pylist():
            own, at, n = [], [], 0
            for n, (_, _, words) in enumerate(sentences(body or ""), 1):
                found = set()
                for w in words:
                    if w not in known:
                        known[w] = word_features(w)
                    found.update(known[w])
                own.extend(sorted(found))
                at.extend([n] * len(found))
            # The last number is kept even if the last sentence has no feature.
            features.append([*own, -1])
            numbers.append([*at, n])
        columns = [batch.column(0), batch.column(2).cast(pa.int32()),
                   pa.array(features, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, ["key", "y", "feature", "sentence"])


class _Loss:
    """Weighted cross-entropy of the noisy-or, over the sample's features by sentence."""

    def __init__(self, table: pa.Table, width: int, sizes: dict[int, int]):
        self.y, self.width = table.column("y").to_numpy(), width
        lists = table.column("feature").combine_chunks()
        doc = np.repeat(np.arange(len(self.y)), np.diff(lists.offsets.to_numpy()))
        column = lists.values.to_numpy()
        sentence = table.column("sentence").combine_chunks().values.to_numpy()
        last = column < 0
        count = np.zeros(len(self.y))
        count[doc[last]] = sentence[last]
        doc, self.column, sentence = doc[~last], column[~last], sentence[~last]
        instance, self.inverse = np.unique(doc * (1 << 32) + sentence, return_inverse=True)
        self.owner = instance >> 32
        self.plain = count - np.bincount(self.owner, minlength=len(self.y))
        per_class = np.array([max(1, (self.y == c).sum()) for c in (0, 1)])
        weight = np.array([sizes.get(c, 0) for c in (0, 1)]) / per_class
        self.weight = (weight / weight[self.y].sum())[self.y]

    def totals(self, theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The logit of each sentence with a feature, and minus the logarithm of each document's chance to be clean."""
        w, bias = theta[:-1], theta[-1]
        z = bias + np.bincount(self.inverse, weights=w[self.column], minlength=len(self.owner))
        total = np.bincount(self.owner, weights=np.logaddexp(0, z), minlength=len(self.y)) + self.plain * np.logaddexp(0, bias)
        return z, total

    def value(self, theta: np.ndarray) -> float:
        _, total = self.totals(theta)
        miss = np.where(self.y == 1, -np.log(-np.expm1(-np.clip(total, 1e-9, 700))), total)
        return float((self.weight * miss).sum() + RIDGE / 2 * (theta[:-1] ** 2).sum() / self.width)

    def gradient(self, theta: np.ndarray) -> np.ndarray:
        w, bias = theta[:-1], theta[-1]
        z, total = self.totals(theta)
        # d loss / d total: 1 for a clean document, -(1-p)/p for a toxic one.
        pull = self.weight * np.where(self.y == 1, -1 / np.expm1(np.clip(total, 1e-9, 700)), 1.0)
        slope = pull[self.owner] / (1 + np.exp(-z))
        grad = np.bincount(self.column, weights=slope[self.inverse], minlength=len(w)) + RIDGE * w / len(w)
        return np.append(grad, slope.sum() + (pull * self.plain).sum() / (1 + np.exp(-bias)))


def _fit(table: pa.Table, telling: np.ndarray, sizes: dict[int, int]) -> ToxicityModel:
    loss = _Loss(table, len(telling), sizes)
    theta = np.append(np.zeros(len(telling)), -6.0)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):  # Adam with its usual constants
        g = loss.gradient(theta)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return ToxicityModel({int(f): float(w) for f, w in zip(telling, theta)}, float(theta[-1]))


def score(docs: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``key, score, predicted, sentences`` for every row; ``sentences`` lists ``start, stop, score`` of
    those that are toxic by themselves, in code points.

    Null and empty texts have no sentence and score 0; texts of any length are read whole. Rows with a null key
    or a repeated one are scored each on its own; an empty table gives no rows. Other columns are not read.
    """
    ship_package(docs.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            done = [scorer(t or "") for t in batch.column(1).to_pylist()]
            faults = [[dict(zip(("start", "stop", "score"), f)) for f in own] for _, own in done]
            columns = [batch.column(0), pa.array([p for p, _ in done], pa.float64()),
                       pa.array([int(p >= threshold) for p, _ in done], pa.int32()), pa.array(faults, kind)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "score", "predicted", "sentences"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    schema = "key long, score double, predicted int, sentences array<struct<start:long,stop:long,score:double>>"
    return rows.mapInArrow(work, schema).withColumnRenamed("key", key)


def drop_toxic(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more. Nothing is shuffled.

    Columns and their order stay. Rows are judged by their text alone: repeated rows and null keys go or stay each on
    its own, null and empty texts stay, texts of any length are read whole, and an empty table stays empty.
    """
    ship_package(docs.sparkSession)
    at = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            keep = [scorer(t or "")[0] < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
