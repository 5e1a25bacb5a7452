"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item that share a seed (a few consecutive words) are tiled:
again and again the longest matches of unmarked words are marked in both, longest first,
found by Karp-Rabin hashes at falling lengths. The share of an item's words under tiles
is its coverage, whatever the order of its passages in the document.

The benchmark is cut into blocks of bounded size; each block's seeds go to all tasks, and
the documents are gone through once a block. Nothing about documents is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import cut
from gatewatch.llm.words import Tokens, ranges, slices, window_hashes

SEED_WORDS = 5
COVERAGE = 0.8
#: Most bytes of benchmark text held in every task at once; what is beyond goes in further blocks.
BLOCK_BYTES = 8 << 20

@dataclass
class Seeds:
    """Seeds of a block of items: sorted hashes with the item of each, and the items' words."""

    items: np.ndarray
    words: list[np.ndarray]
    hashes: np.ndarray
    owners: np.ndarray
    least: int

    @classmethod
    def of(cls, items: pa.Array, texts: pa.Array, seed_words: int) -> Seeds:
        words, hashes, owners = [], [], []
        for lo, _, data, offsets in slices(texts):
            tokens = Tokens(data, offsets)
            for k in range(len(offsets) - 1):
                own = tokens.hashes[tokens.first[k] : tokens.first[k + 1]]
                words.append(own)
                # An item shorter than a seed is one seed of its own length.
                found = np.unique(window_hashes(own, min(seed_words, max(len(own), 1))))
                hashes.append(found)
                owners.append(np.full(len(found), lo + k))
        every, owner = np.concatenate([*hashes, np.zeros(0, np.uint64)]), np.concatenate([*owners, np.zeros(0, np.int64)])
        order = np.argsort(every, kind="stable")
        return cls(np.array(items.to_pylist(), dtype=object), words, every[order], owner[order].astype(np.int64), seed_words)


def tile(document: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Tiles ``(position in document, position in item, length)`` of two lists of word hashes.

    At each length, from the longest match down to ``least``, hashes of all unmarked
    windows of the item are looked up among those of the document; matches of that length
    are marked in order of their place in the item, then in the document, unless an
    earlier one has marked part of them.
    """
    marked_d, marked_i = np.zeros(len(document), bool), np.zeros(len(item), bool)
    tiles: list[tuple[int, int, int]] = []

    def free(marks: np.ndarray, size: int) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks)])
        return np.flatnonzero(sums[size:] == sums[:-size])

    def matches(size: int) -> tuple[np.ndarray, np.ndarray]:
        here, there = free(marked_d, size), free(marked_i, size)
        if not len(here) or not len(there):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hash_d, hash_i = window_hashes(document, size)[here], window_hashes(item, size)[there]
        order = np.argsort(hash_d, kind="stable")
        left, right = np.searchsorted(hash_d[order], hash_i, "left"), np.searchsorted(hash_d[order], hash_i, "right")
        return here[order[ranges(left, right - left)]], np.repeat(there, right - left)

    def longest(top: int) -> int:
        """Greatest length up to ``top`` with a match; matches of a length have parts of every lesser one."""
        low, high = 0, top
        while low < high:
            middle = (low + high + 1) // 2
            if len(matches(middle)[0]) if middle >= least else True:
                low = middle
            else:
                high = middle - 1
        return low

    size = min(len(document), len(item))
    while (size := longest(size)) >= max(least, 1):
        at_d, at_i = matches(size)
        for d, i in zip(at_d.tolist(), at_i.tolist(), strict=True):
            if not marked_d[d : d + size].any() and not marked_i[i : i + size].any():
                marked_d[d : d + size] = marked_i[i : i + size] = True
                tiles.append((d, i, size))
    return tiles


def _scan(batches: Iterator[pa.RecordBatch], seeds: Seeds, coverage: float) -> Iterator[pa.RecordBatch]:
    sizes = sorted({min(seeds.least, len(w)) for w in seeds.words if len(w)})
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            tokens = Tokens(data, offsets)
            pairs = set()
            for size in sizes:
                hashes = window_hashes(tokens.hashes, size)
                left = np.searchsorted(seeds.hashes, hashes, "left")
                hit = np.flatnonzero((left < len(seeds.hashes)) & (seeds.hashes[np.minimum(left, len(seeds.hashes) - 1)] == hashes))
                doc = np.searchsorted(tokens.first, hit, "right") - 1
                inside = hit + size <= tokens.first[doc + 1]
                hit, doc = hit[inside], doc[inside]
                right = np.searchsorted(seeds.hashes, hashes[hit], "right")
                begin = left[hit]
                pairs.update(zip(np.repeat(doc, right - begin).tolist(), seeds.owners[ranges(begin, right - begin)].tolist(), strict=True))
            rows, items, shares, spans = [], [], [], []
            for doc, k in sorted(pairs):
                begin, end = int(tokens.first[doc]), int(tokens.first[doc + 1])
                item = seeds.words[k]
                tiles = tile(tokens.hashes[begin:end], item, min(seeds.least, len(item)))
                share = sum(t[2] for t in tiles) / len(item)
                if share >= coverage:
                    rows.append(doc + lo)
                    items.append(seeds.items[k])
                    shares.append(share)
                    spans.append([[int(tokens.starts[begin + d] - offsets[doc]), int(tokens.ends[begin + d + n - 1] - offsets[doc])] for d, _, n in sorted(tiles)])
            if rows:
                rest = batch.column("doc_id").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [rest, pa.array(items, pa.string()), pa.array(shares, pa.float64()), pa.array(spans, pa.list_(pa.list_(pa.int64())))],
                    names=["doc_id", "item_id", "coverage", "byte_spans"],
                )


def contaminations(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed_words: int = SEED_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Pairs of ``docs`` (``doc_id``, ``text``) and ``benchmark`` (``item_id``, ``text``) with the item covered.

    Returns ``doc_id``, ``item_id`` (as text), ``coverage`` (share of the item's words in
    tiles, at least the asked one) and ``byte_spans`` (begin and end in the document's
    UTF-8 bytes, per tile).

    * Words are runs of letters and digits, A-Z lower-cased; punctuation is not compared.
    * An item of fewer words than a seed must occur whole. Items and documents without
      words, or NULL, match nothing.
    * Among matches of equal length the one first in the item, then in the document, is
      marked first. Repeated rows on either side give a pair each.
    * Other columns are ignored. Empty tables give an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id string, coverage double, byte_spans array<array<bigint>>"
    found = docs.sparkSession.createDataFrame([], schema)
    for n, held in enumerate(_blocks(benchmark, seed_words, block_bytes)):
        hits = docs.select("doc_id", "text").mapInArrow(lambda batches, held=held: _scan(batches, held.value, coverage), schema)
        found = found.unionByName(hits) if n else hits
    return found


def _blocks(benchmark: DataFrame, seed_words: int, block_bytes: int) -> Iterator[Broadcast[Seeds]]:
    """The benchmark's seeds, so much of it at a time that a block stays below about ``block_bytes``."""
    items = benchmark.where("text is not null").select(F.col("item_id").cast("string").alias("item_id"), "text")
    blocks = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    if blocks > 1:
        items = cut(items)
    for block in range(blocks):
        part = items.where(F.col("block") == block).select("item_id", "text").toArrow()
        if part.num_rows:
            seeds = Seeds.of(part.column("item_id").combine_chunks(), part.column("text").combine_chunks(), seed_words)
            if len(seeds.hashes):
                yield benchmark.sparkSession.sparkContext.broadcast(seeds)


def keep_clean(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed_words: int = SEED_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Rows of ``docs``, with all their columns, that cover no benchmark item; nothing is joined or shuffled."""

    def keep(batches: Iterator[pa.RecordBatch], seeds: Seeds) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbered = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column("text")], names=["doc_id", "text"])
            hit = {r for x in _scan(iter([numbered]), seeds, coverage) for r in x.column("doc_id").to_pylist()}
            yield batch.filter(pa.array([r not in hit for r in range(batch.num_rows)], pa.bool_()))

    for held in _blocks(benchmark, seed_words, block_bytes):
        docs = docs.mapInArrow(lambda batches, held=held: keep(batches, held.value), docs.schema)
    return docs


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per different ``doc_id`` of ``docs``: ``contaminated``, its ``items`` in order, the largest ``coverage``.

    Clean documents have no items and coverage 0; a NULL id is an id of its own. See ``contaminations`` for the rest.
    """
    hits = contaminations(docs, benchmark, **options)
    per_doc = hits.groupBy("doc_id").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("coverage").alias("coverage"))
    per_doc = per_doc.select(F.col("doc_id").alias("hit_id"), "items", "coverage")
    ids = docs.select("doc_id").distinct()
    return ids.join(per_doc, F.col("doc_id").eqNullSafe(F.col("hit_id")), "left").select(
        "doc_id",
        F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )
