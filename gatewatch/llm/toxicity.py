"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Terms are lower-cased words and their first few bytes, which stand for word families. Of
all terms of the labelled sample those are kept that speak for the label (log-likelihood
ratio and lift); their document frequencies are counted over all documents. The
examples' weighted terms form an inverted index in blocks of examples with the largest
weight of each term in each block. A text's bound on a block's cosines is one product;
blocks are gone through from the highest bound down until no later one can reach the
``k`` best, so the neighbours are exact. Votes weighted by distance are calibrated by
isotonic regression on the examples themselves, each left out of its own vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import bounded_sample, cut, held_out
from gatewatch.llm.words import Tokens, sequence, signed, slices, span_hashes

#: Most labelled rows to learn from, most terms kept, neighbours that vote.
SAMPLE_ROWS, MOST_TERMS, NEIGHBOURS = 8_000, 4_000, 15
#: Least log-likelihood ratio of a term, and how many times more often it must occur under the label.
LEAST_RATIO, LEAST_LIFT = 15.0, 4.0
PREFIX_BYTES = (4, 5, 6)
#: Examples of a block of the index.
BLOCK = 512

_KINDS = sequence(1 + len(PREFIX_BYTES), 61)


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All terms of a slice's texts and the text of each."""
    tokens = Tokens(data, offsets)
    texts = np.repeat(np.arange(len(offsets) - 1), np.diff(tokens.first))
    hashes, owners = [tokens.hashes ^ _KINDS[0]], [texts]
    for kind, size in zip(_KINDS[1:], PREFIX_BYTES, strict=True):
        long = tokens.ends - tokens.starts >= size
        starts = tokens.starts[long]
        hashes.append(span_hashes(data, starts, starts + size, lower=True) ^ kind)
        owners.append(texts[long])
    return np.concatenate(hashes), np.concatenate(owners)


def _count_by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts of each label that have a term, summed per slice."""
    for batch in batches:
        labels = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
        for lo, hi, data, offsets in slices(batch.column("text")):
            hashes, texts = term_hashes(data, offsets)
            order = np.lexsort((texts, hashes))
            hashes, texts = hashes[order], texts[order]
            new = np.ones(len(hashes), bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (texts[1:] != texts[:-1])
            hashes, marks = hashes[new], labels[lo:hi][texts[new]]
            if len(hashes):
                starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
                positive = np.add.reduceat(marks, starts)
                total = np.diff(np.append(starts, len(hashes)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(hashes[starts])), pa.array(positive), pa.array(total - positive)], names=["term", "positive", "negative"]
                )


class Vocabulary:
    """The kept terms; finds them in texts."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.sort(terms.astype(np.int64).view(np.uint64))
        self.marks = np.zeros(1 << 20, bool)
        self.marks[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def __len__(self) -> int:
        return len(self.terms)

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, term number and count of each kept term in each text, in this order."""
        empty = np.zeros(0, np.int64)
        if not len(self.terms):
            return empty, empty, empty
        hashes, texts = term_hashes(data, offsets)
        may = np.flatnonzero(self.marks[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.terms, hashes[may]), len(self.terms) - 1)
        is_kept = self.terms[at] == hashes[may]
        codes, counts = np.unique(texts[may][is_kept] * len(self.terms) + at[is_kept], return_counts=True)
        return codes // len(self.terms), codes % len(self.terms), counts


def _document_frequencies(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.zeros(len(vocabulary), np.int64)
        for _, _, data, offsets in slices(batch.column("text")):
            found += np.bincount(vocabulary.counts(data, offsets)[1], minlength=len(vocabulary))
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some])], names=["term", "n"])


def _vectors(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            texts, terms, counts = vocabulary.counts(data, offsets)
            bounds = pa.array(np.searchsorted(texts, np.arange(hi - lo + 1)).astype(np.int32))
            rest = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays(
                [rest.column("doc_id"), rest.column("label"), pa.ListArray.from_arrays(bounds, pa.array(terms, pa.int64())),
                 pa.ListArray.from_arrays(bounds, pa.array(counts, pa.int64()))],
                names=["doc_id", "label", "terms", "counts"],
            )


@dataclass
class Index:
    """Weighted examples in blocks; bounds per term and block."""

    weights: np.ndarray  # of terms (inverse document frequency)
    examples: list[tuple[np.ndarray, np.ndarray]]  # terms and unit vectors of the examples with terms
    labels: np.ndarray
    importance: np.ndarray  # rows that an example stands for
    ids: list
    bare: float  # share of positive rows among examples without any term
    postings: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    edges: list[list[int]] = field(default_factory=list)  # of each term's postings: where each block begins
    bounds: np.ndarray | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None  # calibration: votes and scores

    def build(self) -> Index:
        n = len(self.examples)
        by_term: list[list[tuple[int, float]]] = [[] for _ in self.weights]
        for e, (terms, values) in enumerate(self.examples):
            for t, v in zip(terms.tolist(), values.tolist(), strict=True):
                by_term[t].append((e, v))
        self.postings = [(np.array([e for e, _ in p], np.int64), np.array([v for _, v in p])) for p in by_term]
        blocks = -(-n // BLOCK)
        self.edges = [np.searchsorted(at, np.arange(blocks + 1) * BLOCK).tolist() for at, _ in self.postings]
        self.bounds = np.zeros((len(self.weights), blocks))
        for t, (at, values) in enumerate(self.postings):
            np.maximum.at(self.bounds[t], at // BLOCK, values)
        return self

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = (1 + np.log(counts)) * self.weights[terms]
        return values / np.sqrt((values**2).sum())

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` examples of highest cosine above 0, ties by place; and their cosines."""
        bound = values @ self.bounds[terms]
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        for block in np.argsort(-bound, kind="stable"):
            # The margin keeps rounding of a bound from hiding a tie.
            if bound[block] <= 0 or (len(best) == k and bound[block] < best[-1] - 1e-9):
                break
            lo = block * BLOCK
            cosines = np.zeros(min(BLOCK, len(self.examples) - lo))
            for t, v in zip(terms, values, strict=True):
                a, b = self.edges[t][block], self.edges[t][block + 1]
                if a < b:
                    at, own = self.postings[t]
                    cosines[at[a:b] - lo] += v * own[a:b]
            if lo <= without < lo + BLOCK:
                cosines[without - lo] = 0
            some = np.flatnonzero(cosines > 0)
            best_at, best = np.concatenate([best_at, some + lo]), np.concatenate([best, cosines[some]])
            order = np.lexsort((best_at, -np.round(best, 12)))[:k]
            best_at, best = best_at[order], best[order]
        return best_at, best

    def vote(self, at: np.ndarray, cosines: np.ndarray) -> float:
        weight = self.importance[at] / (1.05 - np.minimum(cosines, 1))
        return float((weight * self.labels[at]).sum() / weight.sum()) if len(at) else self.bare

    def calibrate(self, k: int) -> Index:
        """Isotonic regression of labels on left-out votes, pooling neighbours that are out of order."""
        votes = np.array([self.vote(*self.nearest(t, v, k, without=e)) for e, (t, v) in enumerate(self.examples)])
        order = np.argsort(votes, kind="stable")
        pools: list[list[float]] = []  # sum of weights, weighted labels, weighted votes
        for e in order:
            w = self.importance[e]
            pools.append([w, w * self.labels[e], w * votes[e]])
            while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        if pools:
            # One row more of either label keeps scores inside (0, 1).
            self.steps = (np.array([p[2] / p[0] for p in pools]), np.array([(p[1] + 0.5) / (p[0] + 1) for p in pools]))
        return self

    def score(self, vote: float) -> float:
        return vote if self.steps is None else float(np.interp(vote, *self.steps))


@dataclass
class ToxicityModel:
    vocabulary: Vocabulary
    index: Index
    neighbours: int


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS, most_terms: int = MOST_TERMS, neighbours: int = NEIGHBOURS
) -> ToxicityModel:
    """A model from rows of ``labels`` (``doc_id``, ``label``) that are not held out.

    At most about ``sample_rows`` rows are learned from, as many of either label if there
    are; texts that repeat in it with one label count once, under their least id. Without usable labels all texts score 0.
    """
    marked = labels.where(F.col(label).isNotNull() & ~held_out("doc_id")).groupBy(F.col("doc_id").alias("label_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    marked = cut(marked)
    totals = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    sample = F.broadcast(cut(bounded_sample(marked, "label_id", sample_rows, "label")))
    rows = cut(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, F.col("doc_id") == F.col("label_id")).groupBy("text", "label").agg(F.min("doc_id").alias("doc_id")))
    taken = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    counted = rows.select("text", "label").mapInArrow(_count_by_label, "term long, positive long, negative long")
    counted = counted.groupBy("term").agg(F.sum("positive").alias("a"), F.sum("negative").alias("b")).where("a + b > 1")
    kept = counted.withColumn("ratio", _log_likelihood(taken.get(1, 0), taken.get(0, 0))).where(F.col("ratio") >= LEAST_RATIO)
    kept = kept.where(F.col("a") * max(taken.get(0, 0), 1) >= F.col("b") * (LEAST_LIFT * max(taken.get(1, 0), 1)))
    terms = kept.orderBy(F.desc("ratio"), "term").limit(most_terms).select("term").toPandas()["term"].to_numpy(np.int64)
    vocabulary = Vocabulary(terms)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(vocabulary)
    frequencies = docs.select("text").mapInArrow(lambda batches: _document_frequencies(batches, held.value), "term long, n long")
    frequency = np.zeros(len(vocabulary))
    if len(vocabulary):
        for r in frequencies.groupBy("term").agg(F.sum("n").alias("n")).collect():
            frequency[r["term"]] = r["n"]
    weights = np.log((1 + docs.count()) / (1 + frequency)) + 1
    kind = docs.schema["doc_id"].dataType.simpleString()
    vectors = rows.mapInArrow(lambda batches: _vectors(batches, held.value), f"doc_id {kind}, label int, terms array<long>, counts array<long>")
    stands_for = {value: totals.get(value, 0) / n for value, n in taken.items()}
    return ToxicityModel(vocabulary, _index(vectors.toPandas(), weights, stands_for, neighbours), neighbours)


def _log_likelihood(positives: int, negatives: int):
    """Dunning's ratio of a term's counts ``a`` and ``b`` against the sizes of both classes."""
    n = positives + negatives
    a, b = F.col("a"), F.col("b")

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(F.lit(0.0))

    share_a, share_b = F.lit(positives / max(n, 1)), F.lit(negatives / max(n, 1))
    missing = F.lit(n) - a - b
    return 2 * (
        part(a, (a + b) * share_a) + part(b, (a + b) * share_b)
        + part(F.lit(positives) - a, missing * share_a) + part(F.lit(negatives) - b, missing * share_b)
    )


def _index(frame, weights: np.ndarray, stands_for: dict[int, float], k: int) -> Index:
    frame = frame.sort_values("doc_id", kind="stable")
    importance = frame.label.map(stands_for).to_numpy(float) if len(frame) else np.zeros(0)
    labels = frame.label.to_numpy(float) if len(frame) else np.zeros(0)
    some = frame.terms.map(len).to_numpy() > 0 if len(frame) else np.zeros(0, bool)
    bare_weight = importance[~some].sum()
    index = Index(weights, [], labels[some], importance[some], frame.doc_id[some].tolist() if len(frame) else [], 0.0)
    # A bare text is as likely positive as bare examples are; without any, as examples are.
    share, among = (labels[~some] * importance[~some]).sum(), bare_weight
    if not among:
        share, among = (labels * importance).sum(), importance.sum()
    index.bare = float(share / among) if among else 0.0
    vectors = [(np.asarray(t, np.int64), index.unit(np.asarray(t, np.int64), np.asarray(c, float))) for t, c in zip(frame.terms[some], frame.counts[some], strict=True)] if len(frame) else []
    # Examples of like terms next to one another make block bounds tight.
    order = sorted(range(len(vectors)), key=lambda e: (int(vectors[e][0][vectors[e][1].argmax()]), e))
    index.examples = [vectors[e] for e in order]
    index.labels, index.importance, index.ids = index.labels[order], index.importance[order], [index.ids[e] for e in order]
    return index.build().calibrate(k)


def _scores(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, tuple[float, list, list]] = {}
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            texts, terms, counts = model.vocabulary.counts(data, offsets)
            bounds = np.searchsorted(texts, np.arange(hi - lo + 1))
            out: list[tuple[float, list, list]] = []
            for d in range(hi - lo):
                own, times = terms[bounds[d] : bounds[d + 1]], counts[bounds[d] : bounds[d + 1]]
                key = own.tobytes() + times.tobytes()
                if key not in known:
                    if len(known) > 50_000:
                        known.clear()
                    if len(own):
                        at, cosines = model.index.nearest(own, model.index.unit(own, times.astype(float)), model.neighbours)
                        known[key] = (model.index.score(model.index.vote(at, cosines)), [model.index.ids[e] for e in at], cosines.round(6).tolist())
                    else:
                        known[key] = (model.index.bare, [], [])
                out.append(known[key])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array([o[0] for o in out], pa.float64()),
                 pa.array([o[1] for o in out], pa.list_(batch.column("doc_id").type)), pa.array([o[2] for o in out], pa.list_(pa.float64()))],
                names=["doc_id", "score", "neighbours", "cosines"],
            )


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``score`` from 0 to 1 and the evidence for it.

    ``neighbours`` are the ids of the nearest examples, nearest first, with their ``cosines``.

    * A text without any kept term, empty and NULL texts among them, has no neighbours;
      its score is the share of the label among examples without any.
    * Examples at equal cosine count in order of their place in the index.
    * Other columns are ignored. An empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        lambda batches: _scores(batches, held.value), f"doc_id {kind}, score double, neighbours array<{kind}>, cosines array<double>"
    )


def keep_harmless(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs``, with all their columns, that score below ``threshold``; nothing is joined or shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [x.column("score") for x in _scores(iter([batch]), held.value)]
            if scores:
                yield batch.filter(pc.less(pa.chunked_array(scores).combine_chunks(), threshold))

    return docs.mapInArrow(keep, docs.schema)
