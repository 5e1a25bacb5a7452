"""A Merkle manifest of a dataset: trees of hashes over the rows, with a proof for each row.

Nodes carry nested intervals: the node at level ``l`` covers the leaf ranks from ``lo`` to
``hi``, its parent the interval of width ``2 ** (l + 1)`` that contains it. So ancestors are
found by containment, bucketed by level, and the sibling is what remains of the parent's
interval without one's own; no pointers are kept.

Levels are taken in bands of 12. The nodes of a band that stand over the same bucket of
4,096 nodes form a block, a row with the hashes of its lowest level. A block makes its own
levels, and its top node is a leaf of the next band, so a tree over n rows takes
log(n) / 12 rounds and every row moves once, instead of one row per leaf and level. For
proofs, blocks join the ancestors' part of the next band on tree and bucket from the top
down; what a block doesn't contain is the same for all its leaves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gatewatch.llm.common import cut, scratch_table

#: Levels of a band; a block has up to ``2 ** BAND`` leaves.
BAND = 12
#: Fields of a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def join_hash(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


@dataclass
class Block:
    """Levels of a block: nodes ``lo`` to ``hi`` of its lowest level below each node."""

    hashes: list[list[str]]  # level by level, the lowest first
    starts: list[np.ndarray]  # first lowest node of each node; the next one's start is its end

    @classmethod
    def over(cls, lowest: list[str], levels: int) -> Block:
        hashes, starts = [lowest], [np.arange(len(lowest) + 1)]
        for _ in range(levels):
            below, edges = hashes[-1], starts[-1]
            hashes.append([join_hash(below[i : i + 2]) for i in range(0, len(below), 2)])
            starts.append(np.append(edges[:-1:2], edges[-1]))
        return cls(hashes, starts)

    def siblings(self, leaf: int) -> list[tuple[str, bool]]:
        """For each level: the hash beside the ancestor of ``leaf`` ('' if none), and whether it stands left of it."""
        found = []
        for level in range(len(self.hashes) - 1):
            own = int(np.searchsorted(self.starts[level], leaf, side="right")) - 1  # contains the leaf
            lo, hi = self.starts[level][own], self.starts[level][own + 1]
            parent = int(np.searchsorted(self.starts[level + 1], leaf, side="right")) - 1
            over_lo, over_hi = self.starts[level + 1][parent], self.starts[level + 1][parent + 1]
            if over_lo < lo:  # the parent's interval without one's own
                found.append((self.hashes[level][own - 1], True))
            elif hi < over_hi:
                found.append((self.hashes[level][own + 1], False))
            else:
                found.append(("", False))
        return found


def fold(leaf: str, path: list[tuple[str, bool]]) -> str:
    """The root that ``leaf`` gives with its siblings."""
    for sibling, is_left in path:
        leaf = join_hash([sibling, leaf] if is_left else [leaf, sibling])
    return leaf


def _path_text(path: list[tuple[str, bool]]) -> str:
    return "".join(("<" if is_left else ">") + sibling + ";" for sibling, is_left in path)


def _path(text: str) -> list[tuple[str, bool]]:
    return [(part[1:], part[0] == "<") for part in text.split(";")[:-1]]


def leaf_hash(docs: DataFrame, changed: dict[str, Column] | None = None) -> Column:
    """SHA-256 of a row's fields, each as byte count, colon and value, or a hyphen where NULL."""
    parts = []
    for name in FIELDS:
        value = (changed or {}).get(name, docs[name]).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def ranked(leaves: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``leaves`` with ``rank``, from 0 within each value of ``tree``, and ``size``, the number of its leaves.

    A window over a tree would put a hot tree into one task. Rows are laid out by range of
    (tree, order) and stored, counted per stored part, and numbered within their part behind
    the counts of earlier parts of the tree. Rows that tie in all of ``order`` are numbered
    as they are stored.
    """
    spark = leaves.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    laid = leaves.repartitionByRange(parts, F.col(tree).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])
    laid = scratch_table(laid.withColumn("part", F.spark_partition_id()), "leaves")
    counts = laid.groupBy(tree, "part").agg(F.count("*").alias("rows"))
    # One row per tree and part; a tree in many parts has as many rows here, not its leaves.
    counts = counts.select(F.col(tree).alias("of"), F.col("part").alias("of_part"), "rows")
    before = counts.withColumn("before", F.sum("rows").over(_by("of").orderBy("of_part")) - F.col("rows")).withColumn("size", F.sum("rows").over(_by("of"))).drop("rows")
    numbered = laid.withColumn("own", F.row_number().over(_by(tree, "part").orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    joined = numbered.join(before, numbered[tree].eqNullSafe(before["of"]) & (numbered["part"] == before["of_part"]))
    return joined.select(*leaves.columns, (F.col("before") + F.col("own") - 1).alias("rank"), "size")


def _by(*names: str) -> WindowSpec:
    return Window.partitionBy(*names)


def height(size: Column) -> Column:
    """Levels above the leaves of a tree of ``size`` leaves; a lone leaf is its own root."""
    # Exact where a logarithm would round: the binary digits of size - 1.
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(F.lit(0))


def blocks(leaves: DataFrame) -> DataFrame:
    """Rows (``tree``, ``rank``, ``size``, ``hash``, other columns) gathered into blocks.

    Per block: ``tree``, ``bucket``, its ``levels`` in this band, the ``size`` the next band has
    (1 at a root), ``top`` and its ``leaves`` in order, at most ``2 ** BAND`` structs of the other columns and ``hash``.
    """
    rest = [c for c in leaves.columns if c not in ("tree", "size")]
    grouped = leaves.groupBy("tree", "size", F.shiftright("rank", BAND).alias("bucket")).agg(F.array_sort(F.collect_list(F.struct("rank", *[c for c in rest if c != "rank"]))).alias("leaves"))
    shaped = grouped.select(
        "tree", "bucket", F.least(height(F.col("size")), F.lit(BAND)).alias("levels"),
        F.shiftright(F.col("size") + ((1 << BAND) - 1), BAND).alias("size"), "leaves",
    )

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n in range(batch.num_rows):
                hashes = batch.column("leaves").slice(n, 1).flatten().field("hash").to_pylist()
                found.append(Block.over(hashes, batch.column("levels")[n].as_py()).hashes[-1][0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "top"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in shaped.schema.fields)
    return shaped.mapInArrow(tops, f"{kinds}, top string")


def bands(leaves: DataFrame) -> list[DataFrame]:
    """Blocks of all bands, the lowest first; the last has one block per tree."""
    found = []
    while True:
        found.append(scratch_table(blocks(leaves), "blocks"))
        if found[-1].where("size > 1").isEmpty():
            return found
        leaves = found[-1].select("tree", F.col("bucket").alias("rank"), "size", F.col("top").alias("hash"))


def _above(upper: DataFrame) -> DataFrame:
    """For each leaf of the blocks ``upper`` (with ``above``): tree, its rank as ``bucket``, and all its siblings up to the root."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                own = batch.column("leaves").slice(n, 1).flatten()
                block = Block.over(own.field("hash").to_pylist(), batch.column("levels")[n].as_py())
                above = batch.column("above")[n].as_py() or ""
                texts = [_path_text(block.siblings(i)) + above for i in range(len(own))]
                trees = batch.column("tree").take(pa.array([n] * len(own)))
                yield pa.RecordBatch.from_arrays([trees, own.field("rank"), pa.array(texts, pa.string())], names=["tree", "bucket", "above"])

    kind = upper.schema["tree"].dataType.simpleString()
    return upper.select("tree", "levels", "leaves", "above").mapInArrow(paths, f"tree {kind}, bucket long, above string")


def _with_above(lower: DataFrame, above: DataFrame) -> DataFrame:
    """``lower`` joined with the path of its block's top, an ancestor of all its leaves."""
    key = lower["tree"].eqNullSafe(above["tree"]) & (lower["bucket"] == above["bucket"])
    return lower.join(above, key, "left").select(*[lower[c] for c in lower.columns], above["above"])


def manifest(docs: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """Blocks of the trees of each ``lang`` and of the tree over their roots, the lowest band first.

    Leaves of a language ascend by ``doc_id`` (NULL first), equal ids by hash; the trees of
    languages ascend bytewise, NULL first.
    """
    return _language_bands(_leaves(docs))


def _leaves(docs: DataFrame) -> DataFrame:
    number = F.crc32(docs["doc_id"].cast("string").cast("binary"))
    tampered = leaf_hash(docs, {"n_chars": docs["n_chars"] + 1})
    return docs.select(
        docs["lang"].alias("tree"), docs["doc_id"].alias("doc_id"), leaf_hash(docs).alias("hash"),
        F.when(number % 7 == 0, tampered).alias("changed"),
    )


def _language_bands(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    # Texts are read and hashed once; laying out by range samples its input first.
    per_lang = bands(ranked(scratch_table(leaves, "leaves"), "tree", ["doc_id", "hash"]))
    roots = per_lang[-1].select(F.lit(0).alias("tree"), F.col("tree").alias("lang"), F.col("top").alias("hash"))
    return per_lang, bands(ranked(roots, "tree", ["lang"]))


def prove(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``source``, ``lang``, ``n_chars``, ``text``) with its proof.

    ``leaf``, ``subroot`` (of its language) and ``root`` are those of the rows as they are;
    ``siblings`` are the hashes beside its path, level by level up to the root, '' where a
    node has none, and ``is_left`` tells on which side. ``folded_root`` is what the siblings
    give with a leaf that was tampered with (one character more, where 7 divides crc32 of
    the id), else with the leaf itself; ``verified`` tells whether that is the root.

    * A NULL field is hashed as a hyphen; NULL languages make a tree of their own, a NULL
      id is never tampered with, and adding to a NULL ``n_chars`` changes nothing.
    * Rows with equal ids are leaves each. Other columns are ignored. An empty table gives an empty result.
    """
    per_lang, over = _language_bands(_leaves(docs))
    root = over[-1].select("tree", F.col("top").alias("root"))
    # From the top down: the path of each block's top.
    above = None
    for level in reversed(over):
        level = level.withColumn("above", F.lit("")) if above is None else _with_above(level, above)
        above = _above(level)
    named = over[0].select("tree", F.explode("leaves").alias("own")).select("tree", F.col("own.rank").alias("bucket"), F.col("own.lang").alias("lang"), F.col("own.hash").alias("subroot"))
    tops = cut(named.join(above, ["tree", "bucket"]).join(root, "tree").select("lang", "subroot", F.col("above").alias("beyond"), "root"))
    above = tops.select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("bucket"), F.col("beyond").alias("above"))
    for level in reversed(per_lang[1:]):
        above = cut(_above(_with_above(level, above)))
    lowest = _with_above(per_lang[0], above)
    lowest = lowest.join(tops.drop("beyond"), lowest["tree"].eqNullSafe(tops["lang"])).select("levels", "leaves", "above", "subroot", "root")

    def proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                own = batch.column("leaves").slice(n, 1).flatten()
                hashes, changed = own.field("hash").to_pylist(), own.field("changed").to_pylist()
                block = Block.over(hashes, batch.column("levels")[n].as_py())
                beyond = _path(batch.column("above")[n].as_py())
                # Leaves of a block share the rest of the way: what its top becomes is kept.
                further: dict[str, str] = {}
                paths = [block.siblings(i) for i in range(len(hashes))]
                folded = []
                for leaf, other, path in zip(hashes, changed, paths, strict=True):
                    top = fold(other or leaf, path)
                    if top not in further:
                        further[top] = fold(top, beyond)
                    folded.append(further[top])
                for lo in range(0, len(hashes), 256):
                    part = [p + beyond for p in paths[lo : lo + 256]]
                    same = pa.array([n] * len(part))
                    root = batch.column("root")[n].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [own.field("doc_id").slice(lo, 256), own.field("hash").slice(lo, 256), batch.column("subroot").take(same), batch.column("root").take(same),
                         pa.array([[s for s, _ in p] for p in part], pa.list_(pa.string())), pa.array([[left for _, left in p] for p in part], pa.list_(pa.bool_())),
                         pa.array(folded[lo : lo + 256], pa.string()), pa.array([f == root for f in folded[lo : lo + 256]], pa.bool_())],
                        names=["doc_id", "leaf", "subroot", "root", "siblings", "is_left", "folded_root", "verified"],
                    )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return lowest.mapInArrow(
        proofs,
        f"doc_id {kind}, leaf string, subroot string, root string, siblings array<string>, is_left array<boolean>, folded_root string, verified boolean",
    )


def digest(proofs: DataFrame) -> DataFrame:
    """``prove``'s rows with the siblings hashed into one."""
    return proofs.select("doc_id", "leaf", "subroot", "root", F.sha2(F.concat_ws("", "siblings"), 256).alias("proof_sha256"), "folded_root", "verified")
