"""Near-duplicate documents by HyperMinHash sketches, confirmed on full shingle sets.

A document's set holds hashes of its different word shingles. Each of its registers is
the smallest value of one hash function over the set, kept as count of leading zeros and
a few mantissa bits, two bytes in all. Four registers make a band; documents that agree
in a band are candidates. The register agreement of two sketches, corrected for registers
that agree by chance, estimates their Jaccard similarity; pairs far below the threshold
go, the rest is confirmed on full sets.

Equal sets are one node from the start. In a bucket every node is first compared with one
centre; only buckets whose nodes are not connected by that are gone through in full, in
blocks of nodes, and only for nodes of different components. Tasks hand on no more links
than join their nodes, so no group gives rows by the square of its size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import cut, small_side
from gatewatch.llm.graph import components
from gatewatch.llm.words import Words, mix, sequence, signed, slices, window_hashes

BANDS, ROWS = 16, 4
REGISTERS = BANDS * ROWS
MANTISSA_BITS = 10
#: Nodes of a bucket, and their shingles, that are compared with one another in one task.
BLOCK, BLOCK_SHINGLES = 256, 200_000
#: Estimates may fall this many standard errors below the threshold before a pair goes unconfirmed.
SLACK = 5

_FACTORS = (sequence(REGISTERS, 51) | np.uint64(1))[:, None]
_SHIFTS = sequence(REGISTERS, 52)[:, None]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text; lower-cases A-Z."""
    words = Words(data, offsets)
    hashes = words.hashes(lower=True)
    windows = window_hashes(hashes, size)
    for d in range(len(offsets) - 1):
        begin, end = int(words.first[d]), int(words.first[d + 1])
        if end - begin >= size:
            yield np.unique(windows[begin : end - size + 1])
        elif end > begin:
            yield window_hashes(hashes[begin:end], end - begin)
        else:
            yield np.zeros(0, np.uint64)


def registers(shingles: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of the least value of each hash function, 16 bits each."""
    least = np.full(REGISTERS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 2048):
        np.minimum(least, (shingles[None, at : at + 2048] * _FACTORS + _SHIFTS).min(axis=1), out=least)
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63).astype(np.uint64)
    mantissa = np.minimum((np.maximum(fraction - 0.5, 0) * 2 * (1 << MANTISSA_BITS)).astype(np.uint64), (1 << MANTISSA_BITS) - 1)
    return (zeros << np.uint64(MANTISSA_BITS)) | mantissa


def _sketches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    lanes = np.arange(ROWS, dtype=np.uint64) * np.uint64(16)
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            n, one, two, bands = [], [], [], []
            for shingles in shingle_sets(data, offsets, size):
                n.append(len(shingles))
                one.append(shingles.sum(dtype=np.uint64))
                two.append(mix(shingles).sum(dtype=np.uint64))
                bands.append((registers(shingles).reshape(BANDS, ROWS) << lanes).sum(axis=1, dtype=np.uint64))
            flat = signed(np.concatenate(bands)) if bands else np.zeros(0, np.int64)
            starts = np.arange(hi - lo + 1, dtype=np.int32) * BANDS
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(n, pa.int64()),
                 pa.array(signed(np.array(one, np.uint64))), pa.array(signed(np.array(two, np.uint64))),
                 pa.ListArray.from_arrays(pa.array(starts), pa.array(flat))],
                names=["doc_id", "n_shingles", "set_a", "set_b", "sketch"],
            )


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            found = list(shingle_sets(data, offsets, size))
            starts = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
            flat = signed(np.concatenate(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(starts), pa.array(flat))],
                names=["doc_id", "shingles"],
            )


@lru_cache(maxsize=4096)
def _chance(log_a: int, log_b: int) -> float:
    """Chance that a register agrees for two sets without common members, by quarter log2 sizes."""
    a, b = 2 ** (log_a / 4), 2 ** (log_b / 4)
    zeros = np.arange(63)[:, None]
    steps = np.arange((1 << MANTISSA_BITS) + 1)[None, :] / (1 << MANTISSA_BITS)
    edges = 2.0 ** -(zeros + 1.0) * (1 + steps)
    x, y = (np.exp(n * np.log1p(-np.minimum(edges, 1 - 1e-15))) for n in (a, b))
    return float(((x[:, :-1] - x[:, 1:]) * (y[:, :-1] - y[:, 1:])).sum())


def estimate(agreeing: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the share of agreeing registers, less what agrees by chance."""
    logs = [np.round(4 * np.log2(np.maximum(n, 1))).astype(int) for n in (sizes_a, sizes_b)]
    chance = np.array([_chance(int(a), int(b)) for a, b in zip(*logs, strict=True)])
    return np.maximum(agreeing / REGISTERS - chance, 0) / (1 - chance)


def least_estimate(percent: int) -> float:
    t = percent / 100
    return t - SLACK * math.sqrt(t * (1 - t) / REGISTERS)


def _agreeing(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Agreeing registers of sketches, row by row or each with each, as they broadcast."""
    return (one.view(np.uint16) == other.view(np.uint16)).sum(axis=-1)


def _likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (``a``, ``b``) whose sizes and sketches leave the threshold possible."""
    sides = [nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}")) for x in "ab"]
    both = pairs.join(sides[0], "a").join(sides[1], "b").where(_sizes_allow(F.col("n_a"), F.col("n_b"), percent))

    def keep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                one, other = (np.stack(frame[c].to_numpy()) for c in ("s_a", "s_b"))
                close = estimate(_agreeing(one, other), frame.n_a.to_numpy(), frame.n_b.to_numpy()) >= least_estimate(percent)
                yield frame.loc[close, ["a", "b", "n_a", "n_b"]]

    kind = nodes.schema["node"].dataType.simpleString()
    return both.mapInPandas(keep, f"a {kind}, b {kind}, n_a long, n_b long")


def _sizes_allow(n_a: Column, n_b: Column, percent: int) -> Column:
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent


def _node_sets(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """Full sets of the wanted documents, from their texts."""
    texts = docs.join(small_side(wanted, 16), F.col("doc_id") == F.col("wanted"), "left_semi")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(lambda batches: _sets(batches, size), f"doc_id {kind}, shingles array<bigint>")


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Pairs whose full sets reach the threshold; only documents in a pair are read for that."""
    pairs = cut(pairs)
    sets = _node_sets(docs, cut(pairs.select(F.explode(F.array("a", "b")).alias("wanted")).distinct()), size)
    first = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    second = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(first, "a").join(second, "b")
    shared = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - shared
    return both.where(shared * 100 >= union * percent).select("a", "b").distinct()


def _blocked(members: DataFrame) -> DataFrame:
    """Members dealt into blocks of their bucket, once for each pair of blocks (``low``, ``high``) they are in.

    Blocks have about ``BLOCK`` nodes and ``BLOCK_SHINGLES`` shingles; a node goes to as
    many tasks as its bucket has blocks.
    """
    most = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    sizes = members.groupBy("band", "key").agg(F.ceil(most).cast("int").alias("blocks"))
    dealt = members.join(sizes, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))


def _likely_partners(frame: pd.DataFrame, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each row of the lower block, rows of the higher one that may reach the threshold, with estimates.

    Only of other components, and only in the first band in which two nodes agree, so each pair is met once.
    """
    low, high, band = frame.low.iloc[0], frame.high.iloc[0], frame.band.iloc[0]
    ones, others = np.flatnonzero(frame.block == low), np.flatnonzero(frame.block == high)
    sketches, n = np.stack(frame.sketch.to_numpy()), frame.n_shingles.to_numpy()
    component = frame.component.to_numpy()
    for k, i in enumerate(ones.tolist()):
        at = others[k + 1 :] if low == high else others
        may = (component[at] != component[i]) & (np.minimum(n[at], n[i]) * 100 >= np.maximum(n[at], n[i]) * percent)
        at = at[may]
        at = at[(sketches[at] == sketches[i]).argmax(axis=1) == band]
        if len(at):
            close = estimate(_agreeing(sketches[i : i + 1], sketches[at]), np.full(len(at), n[i]), n[at])
            fits = close >= least_estimate(percent)
            if fits.any():
                yield i, at[fits], close[fits]


def _across(members: DataFrame, docs: DataFrame, percent: int, size: int) -> DataFrame:
    """Links between different components that share a bucket: enough of them to connect what is linked.

    Sketches of the blocks of each bucket are held against one another first. Nodes with a
    likely partner then meet with their full sets; each task keeps only links that join
    what its earlier links have not, so neither step gives more rows than it has nodes.
    ``members`` should be cut. Returns ``a`` and ``b``, components whose nodes are linked.
    """
    kind = members.schema["node"].dataType.simpleString()

    def flag(frame: pd.DataFrame) -> pd.DataFrame:
        found = {x for i, at, _ in _likely_partners(frame, percent) for x in (i, *at.tolist())}
        return frame.iloc[sorted(found)][list(columns)]

    places = ["band", "key", "low", "high"]
    columns = {"band": "int", "key": "long", "node": kind, "component": kind, "n_shingles": "long", "sketch": "array<bigint>"}
    schema = ", ".join(f"{c} {of}" for c, of in columns.items())
    flagged = cut(_blocked(members).groupBy(*places).applyInPandas(flag, schema).dropDuplicates(["band", "key", "node"]))
    wanted = cut(flagged.select(F.col("node").alias("wanted")).distinct())
    sets = _node_sets(docs, wanted, size).select(F.col("doc_id").alias("node"), "shingles")
    likely = _blocked(flagged).join(sets, "node")

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        joined = {c: c for c in frame.component}

        def root(c):
            while joined[c] != c:
                c = joined[c]
            return c

        sets, component = frame.shingles.to_list(), frame.component.to_list()
        out = []
        for i, at, _ in _likely_partners(frame, percent):
            at = [j for j in at.tolist() if root(component[j]) != root(component[i])]
            if not at:
                continue
            flat, sizes = np.concatenate([sets[j] for j in at]), np.array([len(sets[j]) for j in at])
            own = np.sort(sets[i])
            hit = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
            shared = np.add.reduceat(hit, np.cumsum(sizes) - sizes, dtype=np.int64)
            for j, close in zip(at, shared * 100 >= (len(own) + sizes - shared) * percent, strict=True):
                if close and root(component[j]) != root(component[i]):
                    joined[root(component[j])] = root(component[i])
                    out.append((component[i], component[j]))
        return pd.DataFrame(out, columns=["a", "b"])

    return likely.groupBy(*places).applyInPandas(link, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, percent: int = 80, shingle_words: int = 5) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) with the component of near copies it is in.

    Documents are linked if 100 * common shingles >= ``percent`` * all shingles of both.
    Returns ``doc_id``, ``n_shingles``, ``component_id`` (smallest reachable id, its own
    included) and ``kept`` (``doc_id = component_id``).

    * Words are runs of other than the six ASCII separators, A-Z lower-cased. A text with
      fewer words than a shingle has one shingle, all its words. Without words, or for a
      NULL text, the set is empty and linked with nothing.
    * Rows that repeat an id are one node: links of each hold for the id.
    * A row without id links with nothing; its component is NULL and it is kept.
    * Other columns are ignored. An empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    made = docs.mapInArrow(
        lambda batches: _sketches(batches, shingle_words),
        f"doc_id {kind}, n_shingles long, set_a long, set_b long, sketch array<bigint>",
    )
    sketched = cut(made)
    linked = sketched.where("n_shingles > 0 and doc_id is not null")
    same = ["n_shingles", "set_a", "set_b"]
    nodes = cut(linked.groupBy(*same).agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch")))
    repeats = linked.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    repeated = linked.join(repeats, "doc_id", "left_semi").join(nodes.drop("sketch"), same)
    ties = repeated.select(F.col("node").alias("a"), F.col("doc_id").alias("b"))

    banded = nodes.select("node", F.posexplode("sketch").alias("band", "key"))
    buckets = banded.groupBy("band", "key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    members = cut(banded.join(buckets, ["band", "key"]))
    stars = members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    links = cut(_confirmed(_likely(stars, nodes, percent), docs, percent, shingle_words).unionByName(ties))
    found = small_side(components(links), 24)

    placed = members.join(found, F.col("node") == F.col("id"), "left")
    placed = placed.select("band", "key", "node", F.coalesce("component", "node").alias("component"))
    spread = placed.groupBy("band", "key").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count(F.lit(1)).alias("n"))
    # Two nodes, a star of one arm: already compared.
    open_buckets = spread.where("x <> y and n > 2").select("band", "key")
    rest = placed.join(open_buckets, ["band", "key"], "left_semi").join(nodes.select("node", "n_shingles", "sketch"), "node")
    more = cut(_across(cut(rest), docs, percent, shingle_words))
    of_row = sketched.join(nodes.drop("sketch"), same, "left").join(found, F.col("node") == F.col("id"), "left").drop("id")
    of_row = of_row.withColumn("component", F.coalesce("component", "node"))
    if not more.isEmpty():
        merged = small_side(components(more).withColumnRenamed("component", "whole"), 24)
        of_row = of_row.join(merged, F.col("component") == F.col("id"), "left").withColumn("component", F.coalesce("whole", "component"))
    own = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return of_row.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"))


def keep_representatives(docs: DataFrame, percent: int = 80, shingle_words: int = 5) -> DataFrame:
    """Rows of ``docs``, with all their columns, without those that ``near_duplicates`` doesn't keep."""
    gone = near_duplicates(docs, percent, shingle_words).where("not kept").select(F.col("doc_id").alias("gone_id")).distinct()
    rows = docs.select(F.struct("*").alias("row"), "doc_id")
    return rows.join(small_side(cut(gone), 16), F.col("doc_id") == F.col("gone_id"), "left_anti").select("row.*")
