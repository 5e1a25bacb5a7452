"""Quality classifier on learned subword embeddings.

A document is the average of the vectors of its features: words, character n-grams of
words (marked at word edges), and pairs of neighbouring words, where a word that follows
itself is one feature of its own. Features share hashed buckets. A softmax layer on the
average gives the classes. Vectors and layer are trained together by stochastic gradient
descent in numpy on a bounded sample; scoring goes through all texts on Spark. With two
classes, a document's logit is the average of one number per bucket, which is all that
scoring needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import bounded_sample, cut, held_out
from gatewatch.llm.words import Words, mix, sequence, slices, span_hashes, window_hashes

#: Most labelled rows to learn from; their texts are taken whole.
SAMPLE_ROWS = 5_000
BUCKET_BITS, DIMENSIONS, EPOCHS, RATE, GRAMS = 16, 8, 6, 0.5, (3, 4)

_SALTS = sequence(8, 71)
_SAME = np.uint64(12345)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bucket numbers of all features of a slice's texts, kind by kind, with the bounds of each text."""
    words = Words(data, offsets)
    hashes = words.hashes()
    shift = np.uint64(64 - BUCKET_BITS)
    yield (mix(hashes ^ _SALTS[0]) >> shift).astype(np.int64), words.first
    if len(words) > 1:
        pairs = window_hashes(hashes, 2)
        pairs[hashes[1:] == hashes[:-1]] = _SAME
        inside = np.ones(len(pairs), bool)
        inner = words.first[1:-1]
        inside[inner[(inner > 0) & (inner < len(words))] - 1] = False
        at = np.flatnonzero(inside)
        yield (mix(pairs[at] ^ _SALTS[1]) >> shift).astype(np.int64), np.searchsorted(at, words.first)
    lengths = words.ends - words.starts
    for size, salt in zip(GRAMS, _SALTS[2:], strict=False):
        # Starts of all n-grams within words: every byte of a word but its last size - 1.
        counts = np.maximum(lengths - size + 1, 0)
        some = np.flatnonzero(counts)
        begins = np.repeat(words.starts[some] - (np.cumsum(counts[some]) - counts[some]), counts[some]) + np.arange(int(counts.sum()))
        ends = np.repeat(words.ends[some], counts[some])
        starts = np.repeat(words.starts[some], counts[some])
        edge = (begins == starts).astype(np.uint64) + 2 * (begins + size == ends).astype(np.uint64)
        grams = span_hashes(data, begins, begins + size) ^ (salt + edge * _SALTS[7])
        yield (mix(grams) >> shift).astype(np.int64), np.searchsorted(begins, offsets)


def sparse(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Different buckets and their shares for each text of a slice."""
    kinds = list(features(data, offsets))
    out = []
    for d in range(len(offsets) - 1):
        own = np.concatenate([ids[bounds[d] : bounds[d + 1]] for ids, bounds in kinds])
        ids, counts = np.unique(own, return_counts=True)
        out.append((ids, (counts / max(len(own), 1)).astype(np.float32)))
    return out


@dataclass
class QualityModel:
    weights: np.ndarray  # of each bucket, to the logit of the label
    bias: float
    bare: float  # score of a text without words


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, importance: np.ndarray, seed: int = 7) -> QualityModel:
    """Stochastic gradient descent on embeddings and softmax layer, one document at a time, rate falling to 0.

    Documents are drawn as often as others; ``importance`` (rows each stands for) shifts
    the layer's bias at the end, so that scores fit the classes' real shares.
    """
    if not len(rows):
        return QualityModel(np.zeros(1 << BUCKET_BITS, np.float32), 0.0, 0.5)
    share = float((importance * labels).sum() / importance.sum())
    if not 0 < labels.mean() < 1:
        return QualityModel(np.zeros(1 << BUCKET_BITS, np.float32), 30.0 if labels[0] else -30.0, share)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (1 << BUCKET_BITS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps = EPOCHS * len(rows)
    step = 0
    for _ in range(EPOCHS):
        for d in rng.permutation(len(rows)):
            rate = RATE * (1 - step / steps)
            step += 1
            ids, shares = rows[d]
            if not len(ids):
                continue
            mean = shares @ vectors[ids]
            scores = mean @ layer + bias
            probability = np.exp(scores - scores.max())
            probability /= probability.sum()
            probability[int(labels[d])] -= 1
            back = layer @ probability
            layer -= rate * mean[:, None] * probability[None, :]
            bias -= rate * probability
            # Shares are small; a step of the vectors counts per document, not per feature.
            vectors[ids] -= (rate * len(ids) ** 0.5 * shares)[:, None] * back[None, :]
    drawn = labels.mean()
    shift = np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
    return QualityModel((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0] + shift), share)


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """A model from at most about ``sample_rows`` rows of ``labels`` that are not held out, as many of either label if there are."""
    marked = labels.where(F.col(label).isNotNull() & ~held_out("doc_id")).groupBy(F.col("doc_id").alias("label_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    marked = cut(marked)
    totals = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    sample = F.broadcast(cut(bounded_sample(marked, "label_id", sample_rows, "label")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, F.col("doc_id") == F.col("label_id"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = rows.select("doc_id", "label", "text").mapInArrow(_sparse_rows, f"doc_id {kind}, label int, ids array<int>, shares array<float>")
    # The sample is bounded by a parameter, and a text has at most as many features as there are buckets.
    frame = made.toArrow().sort_by("doc_id")
    taken = {value: frame.column("label").to_pylist().count(value) for value in totals}
    marks = frame.column("label").to_numpy().astype(int) if frame.num_rows else np.zeros(0, int)
    importance = np.array([totals[m] / max(taken[m], 1) for m in marks.tolist()])
    examples = [(np.asarray(i.values), np.asarray(s.values)) for i, s in zip(frame.column("ids"), frame.column("shares"), strict=True)]
    return train(examples, marks, importance)


def _sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            rows = sparse(data, offsets)
            bounds = pa.array(np.concatenate([[0], np.cumsum([len(i) for i, _ in rows])]).astype(np.int32))
            ids, shares = (np.concatenate([r[k] for r in rows]) for k in (0, 1))
            rest = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [rest.column("doc_id"), rest.column("label"), pa.ListArray.from_arrays(bounds, pa.array(ids.astype(np.int32))),
                 pa.ListArray.from_arrays(bounds, pa.array(shares.astype(np.float32)))],
                names=["doc_id", "label", "ids", "shares"],
            )


def _scores(batches: Iterator[pa.RecordBatch], model: QualityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            total, count = np.zeros(hi - lo), np.zeros(hi - lo)
            for ids, bounds in features(data, offsets):
                sums = np.concatenate([[0.0], np.cumsum(model.weights[ids], dtype=np.float64)])
                total += sums[bounds[1:]] - sums[bounds[:-1]]
                count += np.diff(bounds)
            logit = total / np.maximum(count, 1) + model.bias
            score = np.where(count > 0, 1 / (1 + np.exp(-np.clip(logit, -50, 50))), model.bare)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(score)], names=["doc_id", "score"])


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with the chance of the label, from 0 to 1.

    * A text without words, empty or NULL, scores the label's share among labelled rows.
    * Repeated rows score alike. Other columns are ignored. An empty table gives an empty result.
    * Without labelled rows every text with words scores 0.5.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _scores(batches, held.value), f"doc_id {kind}, score double")
