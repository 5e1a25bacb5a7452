"""Language of texts by a bidirectional gated recurrent network over bytes.

Two recurrent layers run over the bytes of a segment, one from either end; at each
position a softmax layer on both states gives a chance for every language. A document's
chances are the averages over all its positions. The network is trained in numpy by
backpropagation through time on segments of a bounded sample; labelling runs over whole
texts, thousands of segments at a time.

Gates are clipped lines and candidates ``x / (1 + |x|)``, which cost a third of
exponentials and train as well here.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import bounded_sample, cut, held_out
from gatewatch.llm.words import slices

#: Most labelled rows to learn from and segments of each; bytes of a segment; states per direction.
SAMPLE_ROWS, SEGMENTS, SEGMENT_BYTES, STATES = 4_000, 3, 64, 6
STEPS, BATCH, RATE = 500, 64, 0.02
UNKNOWN = "und"
#: Byte that fills the last segment of a text; the 257th symbol.
PAD = 256
#: Segments labelled at once.
WIDTH = 4096


class Layer:
    """One direction: weights of bytes (3 parts: update, reset, candidate) and of the state."""

    def __init__(self, states: int, rng: np.random.Generator):
        self.byte = rng.normal(0, 0.3, (3 * states, PAD + 1)).astype(np.float32)
        self.byte[: 2 * states] += 0.5
        self.state = rng.normal(0, 0.5 / states**0.5, (3 * states, states)).astype(np.float32)

    def run(self, symbols: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States after each position, ``(time, states, segments)``; ``keep`` gets what the way back needs."""
        n = self.state.shape[1]
        times, width = symbols.shape
        out = np.empty((times, n, width), np.float32)
        h = np.zeros((n, width), np.float32)
        g, u = np.empty((3 * n, width), np.float32), np.empty((3 * n, width), np.float32)
        scale = np.empty((n, width), np.float32)
        for t in range(times):
            np.take(self.byte, symbols[t], axis=1, out=g, mode="clip")
            np.matmul(self.state, h, out=u)
            gates, candidate = u[: 2 * n], u[2 * n :]
            gates += g[: 2 * n]
            np.clip(gates, 0, 1, out=gates)
            if keep is not None:
                from_state = candidate.copy()
            candidate *= gates[n:]
            candidate += g[2 * n :]
            np.abs(candidate, out=scale)
            scale += 1
            candidate /= scale
            if keep is not None:
                keep.append((h.copy(), gates.copy(), from_state, candidate.copy()))
            candidate -= h
            candidate *= gates[:n]
            np.add(h, candidate, out=out[t])
            h = out[t]
        return out

    def back(self, symbols: np.ndarray, kept: list, grown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of both weights from those of all states."""
        n = self.state.shape[1]
        of_byte, of_state = np.zeros_like(self.byte.T), np.zeros_like(self.state)
        carried = np.zeros_like(kept[0][0])
        for t in reversed(range(len(symbols))):
            h, gates, from_state, candidate = kept[t]
            z, r = gates[:n], gates[n:]
            dh = grown[t] + carried
            dc = dh * z * (1 - np.abs(candidate)) ** 2
            open_gates = (gates > 0) & (gates < 1)
            dg = np.concatenate([np.concatenate([dh * (candidate - h), dc * from_state]) * open_gates, dc])
            du = dg.copy()
            du[2 * n :] *= r
            of_state += du @ h.T
            np.add.at(of_byte, symbols[t], dg.T)
            carried = dh * (1 - z) + self.state.T @ du
        return of_byte.T, of_state


@dataclass
class LanguageModel:
    languages: list[str]
    forward: Layer | None = None
    backward: Layer | None = None
    layer: np.ndarray | None = None  # languages x 2 states
    bias: np.ndarray | None = None

    def chances(self, symbols: np.ndarray) -> np.ndarray:
        """Chances at each position, ``(time, languages, segments)``."""
        n = self.layer.shape[1] // 2
        ahead, behind = self.forward.run(symbols), self.backward.run(symbols[::-1])[::-1]
        out = np.matmul(self.layer[:, :n], ahead)
        out += np.matmul(self.layer[:, n:], behind)
        out += self.bias[:, None]
        out -= out.max(axis=1, keepdims=True)
        np.exp(out, out=out)
        out /= out.sum(axis=1, keepdims=True)
        return out


def segments(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All segments of a slice's texts, ``(segments, size)`` with padding, and the text of each."""
    lengths = np.diff(offsets)
    counts = -(-lengths // size)
    texts = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(len(texts)) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = offsets[texts] + nth * size
    at = begins[:, None] + np.arange(size)
    inside = at < offsets[texts + 1][:, None]
    symbols = np.full(at.shape, PAD, np.int64)
    symbols[inside] = data[at[inside]]
    return symbols, texts


def train(symbols: np.ndarray, marks: np.ndarray, languages: list[str], seed: int = 5) -> LanguageModel:
    """Adam on the cross-entropy of every position; languages are drawn alike."""
    rng = np.random.default_rng(seed)
    model = LanguageModel(languages, Layer(STATES, rng), Layer(STATES, rng))
    model.layer = rng.normal(0, 0.3, (len(languages), 2 * STATES)).astype(np.float32)
    model.bias = np.zeros(len(languages), np.float32)
    of_language = [np.flatnonzero(marks == k) for k in range(len(languages))]
    weights = [model.forward.byte, model.forward.state, model.backward.byte, model.backward.state, model.layer, model.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        wanted = rng.integers(0, len(languages), BATCH)
        pick = np.array([of_language[k][rng.integers(len(of_language[k]))] for k in wanted])
        x = np.ascontiguousarray(symbols[pick].T)
        kept_ahead: list = []
        kept_behind: list = []
        ahead = model.forward.run(x, kept_ahead)
        behind = model.backward.run(x[::-1], kept_behind)[::-1]
        both = np.concatenate([ahead, behind], axis=1)
        scores = np.matmul(model.layer, both) + model.bias[:, None]
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        scores /= scores.sum(axis=1, keepdims=True)
        scores[:, wanted, np.arange(BATCH)] -= 1
        scores *= (x != PAD)[:, None, :] / max((x != PAD).sum(), 1)
        scores = scores.astype(np.float32)
        of_layer = np.einsum("tlb,tsb->ls", scores, both)
        of_both = np.matmul(model.layer.T, scores)
        grads = [
            *model.forward.back(x, kept_ahead, of_both[:, :STATES]),
            *model.backward.back(x[::-1], kept_behind, of_both[::-1, STATES:]),
            of_layer, scores.sum(axis=(0, 2)),
        ]
        rate = RATE * (1 - step / (STEPS + 1))
        for w, g, a, b in zip(weights, grads, first, second, strict=True):
            g = np.clip(g, -1, 1)
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            w -= rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    return model


def _sampled_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A few segments from the length of each text, its first among them."""
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            symbols, texts = segments(data, offsets, SEGMENT_BYTES)
            first = np.searchsorted(texts, np.arange(hi - lo))
            counts = np.bincount(texts, minlength=hi - lo)
            at = np.concatenate([first[d] + np.unique(np.arange(SEGMENTS) * counts[d] // SEGMENTS) for d in range(hi - lo) if counts[d]] or [np.zeros(0, int)])
            rows = pa.array(texts[at] + lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("lang").take(rows), pa.array(list(symbols[at].astype(np.int16)), pa.list_(pa.int16()))],
                names=["doc_id", "lang", "symbols"],
            )


def learn(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> LanguageModel:
    """A network from at most about ``sample_rows`` documents with a language that are not held out, as many of each language if there are."""
    marked = cut(docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")).select("doc_id", "lang"))
    sample = cut(bounded_sample(marked, "doc_id", sample_rows, "lang"))
    chosen = sample.select(F.col("doc_id").alias("chosen_id")).distinct()
    rows = docs.where(F.col("lang").isNotNull()).join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"), "left_semi")
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = rows.select("doc_id", "lang", "text").mapInArrow(_sampled_segments, f"doc_id {kind}, lang string, symbols array<smallint>")
    frame = made.orderBy("doc_id", "symbols").toArrow()
    languages = sorted(set(frame.column("lang").to_pylist()))
    if not languages:
        return LanguageModel([])
    marks = np.array([languages.index(x) for x in frame.column("lang").to_pylist()])
    symbols = frame.column("symbols").combine_chunks().values.to_numpy(zero_copy_only=False).reshape(-1, SEGMENT_BYTES).astype(np.int64)
    return train(symbols, marks, languages)


def _labelled(batches: Iterator[pa.RecordBatch], model: LanguageModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            total = np.zeros((hi - lo, max(len(model.languages), 1)))
            if model.languages:
                symbols, texts = segments(data, offsets, SEGMENT_BYTES)
                for at in range(0, len(texts), WIDTH):
                    part = np.ascontiguousarray(symbols[at : at + WIDTH].T)
                    chances = model.chances(part)
                    chances *= (part != PAD)[:, None, :]
                    sums = chances.sum(axis=0, dtype=np.float64)
                    own = texts[at : at + WIDTH]
                    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                    total[own[starts]] += np.add.reduceat(sums, starts, axis=1).T
            best = total.argmax(axis=1)
            score = total[np.arange(hi - lo), best] / np.maximum(total.sum(axis=1), 1e-12)
            names = [model.languages[k] for k in best] if model.languages else [UNKNOWN] * (hi - lo)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), batch.column("lettered").slice(lo, hi - lo), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "lettered", "lang_pred", "score"],
            )


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with its likeliest language and that one's chance.

    * A NULL text, or one without a letter, is ``und`` with score 0; so is every text if
      nothing was learned.
    * Of languages with equal chances the first by code point is taken. Other columns are
      ignored; an empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select("doc_id", lettered.alias("lettered"), F.when(lettered, F.col("text")).alias("text"))
    made = rows.mapInArrow(lambda batches: _labelled(batches, held.value), f"doc_id {kind}, lettered boolean, lang_pred string, score double")
    known = F.col("lettered") & (F.col("lang_pred") != UNKNOWN)
    return made.select("doc_id", F.when(known, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"), F.when(known, F.col("score")).otherwise(0.0).alias("score"))
