"""Toxicity by non-negative positive-unlabelled learning.

Positives are documents labelled toxic; the unlabelled are a sample of all documents, their
labels unseen. With the class prior p of the labelled training rows, the risk of a score g is
``p * R_pos(g) + max(0, R_unl_neg(g) - p * R_pos_neg(g))``; where the bracket falls below zero
the step goes the other way (Kiryo et al., 2017). Features are hashed words and word beginnings,
present or not; kept are those clearly more frequent among positives than among the unlabelled.

Training uses hash samples of about MAX_POSITIVE and MAX_UNLABELLED rows, which bounds what
reaches the driver. Scoring covers every whole text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repsmith.llm._common import persisted, released
from repsmith.llm._text import NON_WORD, Words, slices

MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 6000, 20_000, 20_000
#: A feature must be in so many positives, and in this share of them, and so much more frequent there.
LEAST_DOCS, LEAST_SHARE, LEAST_LIFT = 4, 0.004, 4.0
PREFIXES = (4, 5, 6, 8)
STEPS, RATE, DECAY = 400, 0.05, 1e-4


def held_out(id_col: str) -> Column:
    """The fold that training never reads the labels of: crc32 of the id's text modulo 5 is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature hash) of every word and of its beginnings of PREFIXES bytes (0: shorter word)."""
    row = words.rows()
    kinds = [words.hash ^ np.uint64(1), *words.prefixes]
    return np.tile(row, len(kinds)), np.concatenate(kinds)


def _sampled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("positive", pa.bool_()), ("features", pa.list_(pa.int64()))])
    for batch in batches:
        for lo, hi, data, offsets in slices(batch, "text"):
            row, feature = _features(Words(data, offsets, NON_WORD, PREFIXES))
            row, feature = row[feature != 0], feature[feature != 0]
            order = np.argsort(row, kind="stable")
            cuts = np.searchsorted(row[order], np.arange(1, hi - lo))
            sets = [np.unique(x).view(np.int64) for x in np.split(feature[order], cuts)]
            yield pa.RecordBatch.from_arrays([batch.column("positive").slice(lo, hi - lo), pa.array(sets, pa.list_(pa.int64()))], schema=schema)


class Model:
    """``hashes`` (sorted) with ``weights``, and ``bias``: score = sigmoid(bias + weights of the features present)."""

    def __init__(self, hashes: np.ndarray, weights: np.ndarray, bias: float):
        self.hashes, self.weights, self.bias = hashes, weights, bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_pu(positive: list[np.ndarray], unlabelled: list[np.ndarray], features: int, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias by descent on the corrected risk (logistic loss, Adam steps over the whole
    sample: in small batches the noise of the bracket alone would keep turning the step around).
    Each example is an array of feature numbers."""

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(x) for x in rows]), np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)

    def scores(at: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
        return _sigmoid(np.bincount(at, weights=w[index], minlength=n) + w[-1])

    def gradient(at: np.ndarray, index: np.ndarray, slope: np.ndarray) -> np.ndarray:
        g = np.bincount(index, weights=slope[at], minlength=features + 1) / len(slope)
        g[-1] += slope.mean()
        return g

    w, mean, square = (np.zeros(features + 1) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    p_rows, u_rows = flat(positive), flat(unlabelled)
    for step in range(1, STEPS + 1):
        p, u = scores(*p_rows, len(positive)), scores(*u_rows, len(unlabelled))
        negative = -np.log(1 - u + 1e-12).mean() + prior * np.log(1 - p + 1e-12).mean()
        correction = gradient(*u_rows, u) - prior * gradient(*p_rows, p)
        g = prior * gradient(*p_rows, p - 1) + correction if negative >= 0 else -correction
        g[:-1] += DECAY * w[:-1]
        mean, square = 0.9 * mean + 0.1 * g, 0.999 * square + 0.001 * g * g
        w -= RATE * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Without a positive training row the model scores everything near 0."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).where(~held_out("doc_id"))
    labels = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where(~held_out("doc_id") & F.col("toxic").isNotNull())
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seen = labels.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("positive")).first()
    positives = seen["positive"] or 0
    if not positives:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -20.0)
    prior = min(0.99, positives / seen["n"])
    total = docs.select("doc_id").count()

    def share(limit: int, of: int, seed: int) -> Column:
        """A hash sample of about ``limit`` of ``of`` rows."""
        return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, limit / max(1, of)))

    toxic = labels.where((F.col("toxic") == 1) & share(MAX_POSITIVE, positives, 1)).select("doc_id")
    # About MAX_POSITIVE ids, whatever the number of labels: a bounded broadcast, and no text is shuffled for them.
    sample = docs.join(F.broadcast(toxic), "doc_id").select(F.lit(True).alias("positive"), "text").unionByName(
        docs.where(share(MAX_UNLABELLED, total, 2)).select(F.lit(False).alias("positive"), "text"))
    sample = sample.dropDuplicates()  # copies of one text are one example
    sample = persisted(sample.repartition(F.xxhash64("text")).mapInArrow(released(_sampled_features), "positive boolean, features array<long>").withColumn("id", F.monotonically_increasing_id()), "sample")
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if not sizes.get(True) or not sizes.get(False):
        return Model(np.zeros(0, np.uint64), np.zeros(0), -20.0)
    in_positive, in_unlabelled = (F.sum(F.when(F.col("positive") == x, 1).otherwise(0)) for x in (True, False))
    chosen = (sample.select("positive", F.explode("features").alias("feature")).groupBy("feature").agg(in_positive.alias("p"), in_unlabelled.alias("u"))
              .where((F.col("p") >= max(LEAST_DOCS, LEAST_SHARE * sizes[True])) & (F.col("p") / sizes[True] >= LEAST_LIFT * (F.col("u") + 1) / (sizes[False] + 1)))
              .orderBy(F.desc("p"), "feature").limit(MAX_FEATURES))
    hashes = np.sort(np.array([r["feature"] for r in chosen.select("feature").collect()], np.int64).view(np.uint64))
    model = Model(hashes, np.zeros(len(hashes)), 0.0)
    if not len(hashes):
        return Model(hashes, model.weights, float(np.log(prior / (1 - prior))))
    small = sample.mapInArrow(_kept(hashes), "positive boolean, features array<int>").collect()  # the bounded sample, chosen features only
    model.weights, model.bias = fit_pu([np.array(r["features"], np.int64) for r in small if r["positive"]], [np.array(r["features"], np.int64) for r in small if not r["positive"]], len(hashes), prior)
    return model


def _find(hashes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where a value is one of the sorted ``hashes``, which)."""
    i = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
    where = np.flatnonzero(hashes[i] == values)
    return where, i[where]


def _kept(hashes: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [_find(hashes, np.array(x, np.int64).view(np.uint64))[1].tolist() for x in batch.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("positive"), pa.array(kept, pa.list_(pa.int32()))], names=["positive", "features"])
    return run


def _score(model: Model, text_col: str, score_col: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = np.full(batch.num_rows, model.bias)
            for lo, hi, data, offsets in slices(batch, text_col) if len(model.hashes) else ():
                words = Words(data, offsets, NON_WORD, PREFIXES)
                row = words.rows()
                hits = []
                for kind in (words.hash ^ np.uint64(1), *words.prefixes):
                    where, which = _find(model.hashes, kind)
                    hits.append(row[where] * len(model.hashes) + which)
                once = np.unique(np.concatenate(hits))
                z[lo:hi] += np.bincount(once // len(model.hashes), weights=model.weights[once % len(model.hashes)], minlength=hi - lo)
            yield pa.RecordBatch.from_arrays([*[c for c, n in zip(batch.columns, batch.schema.names) if n != text_col], pa.array(_sigmoid(z))],
                                             names=[*[n for n in batch.schema.names if n != text_col], score_col])
    return run


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.5), text_hash (xxhash64), one row per row of
    ``docs``; null and empty texts get the score of no feature. Only the text is an input of a score."""
    text = F.col(text_col).cast("string")
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    out = plain.mapInArrow(released(_score(model, "text", "score")), "doc_id long, held_out boolean, text_hash long, score double")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "text_hash")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score below 0.5; all columns kept."""
    names = [f"_c{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names).withColumn("_t", F.col(names[docs.columns.index(text_col)]).cast("string"))
    schema = ", ".join([*[f"{n} {plain.schema[n].dataType.simpleString()}" for n in names], "_score double"])
    out = plain.mapInArrow(released(_score(model, "_t", "_score")), schema).where("_score < 0.5")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
