"""Exact deduplication by content-defined chunk recipes.

Every text is cut where a hash of the last bytes says so, hence equal texts are cut
alike. A chunk has a key (128-bit digest and length), and a text the ordered list of its
chunks' keys. A list that one row has settles that row: it has no copy. Only documents with
a shared list are read again; their chunks are deduplicated by content to verified
identifiers, and the ordered lists of identifiers are compared. Long texts that are unique
never move, and what moves of a text is one list, in proportion to its length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import cut, small_side
from gatewatch.llm.words import Powers, sequence, slices

#: Bytes the cutting hash looks back on, least and most bytes of a chunk, bits that must be zero at a cut.
LOOK_BACK, LEAST, MOST, CUT_BITS = 32, 256, 8192, 10

_VALUES, _POWERS = sequence(256, 41), Powers(42)


def chunk_ends(data: np.ndarray, least: int = LEAST, most: int = MOST, bits: int = CUT_BITS) -> list[int]:
    """Ends of the chunks of one text; a text without bytes has none."""
    n = len(data)
    if n == 0:
        return []
    ends, at = [], 0
    if n > least:
        up, down = _POWERS.up_to(n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_VALUES[data] * up[:n], out=sums[1:])
        rolling = (sums[LOOK_BACK:] - sums[:-LOOK_BACK]) * down[: n + 1 - LOOK_BACK]
        marks = np.flatnonzero(rolling >> np.uint64(64 - bits) == 0) + LOOK_BACK
        for mark in marks.tolist():
            while mark - at > most:
                at += most
                ends.append(at)
            if mark - at >= least:
                at = mark
                ends.append(at)
        while n - at > most:
            at += most
            ends.append(at)
    if at < n:
        ends.append(n)
    return ends


def _key(piece: bytes, digest_bytes: int) -> bytes:
    return hashlib.blake2b(piece, digest_size=16).digest()[:digest_bytes] + len(piece).to_bytes(4, "big")


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[list[bytes]]:
    for d in range(len(offsets) - 1):
        part = data[offsets[d] : offsets[d + 1]]
        raw, at, pieces = part.tobytes(), 0, []
        for stop in chunk_ends(part):
            pieces.append(raw[at:stop])
            at = stop
        yield pieces


def _recipes(batches: Iterator[pa.RecordBatch], digest_bytes: int, unsafe: frozenset[bytes] | None) -> Iterator[pa.RecordBatch]:
    """The list of chunk identifiers of each text: keys, with the content behind keys that are unsafe (None: all)."""
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            ids, bounds = [], [0]
            for pieces in _pieces(data, offsets):
                for piece in pieces:
                    key = _key(piece, digest_bytes)
                    ids.append(key + piece if unsafe is None or key in unsafe else key)
                bounds.append(len(ids))
            rest = batch.slice(lo, hi - lo)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.binary()))
            yield pa.RecordBatch.from_arrays(
                [rest.column("doc_id"), rest.column("text_sha256"), lists], names=["doc_id", "text_sha256", "recipe"]
            )


def _contents(batches: Iterator[pa.RecordBatch], digest_bytes: int) -> Iterator[pa.RecordBatch]:
    """Key and content of every chunk, once a slice."""
    for batch in batches:
        for _, _, data, offsets in slices(batch.column("text")):
            found = {(_key(piece, digest_bytes), piece) for pieces in _pieces(data, offsets) for piece in pieces}
            keys, parts = zip(*sorted(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(parts, pa.binary())], names=["key", "content"])


#: Beyond so many keys with several contents, which 128-bit digests never come near, contents stand for all keys.
MOST_UNSAFE = 10_000


def recipes(source: DataFrame, digest_bytes: int = 16, unsafe: frozenset[bytes] | None = frozenset()) -> DataFrame:
    """``doc_id``, ``text_sha256``, ``recipe`` (chunk identifiers in order) and its hash ``recipe_key``, for texts without NULLs."""
    hashed = source.select("doc_id", "text", F.sha2("text", 256).alias("text_sha256"))
    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, text_sha256 string, recipe array<binary>"
    made = hashed.mapInArrow(lambda batches: _recipes(batches, digest_bytes, unsafe), schema)
    return cut(made.withColumn("recipe_key", F.xxhash64("recipe")))


def dedup_exact(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): which row of its equal texts stays.

    Returns ``doc_id``, ``keep_id`` (largest ``doc_id`` of the equal texts), ``group_size``
    (rows), ``kept`` (``doc_id = keep_id``), ``text_sha256``.

    * A NULL text counts as empty; all empty texts are one group.
    * Rows that repeat an id and a text count each, and are kept or not together.
    * Rows without id count in ``group_size`` but stay only in groups in which no row has an
      id; there ``keep_id`` is NULL and ``kept`` true.
    * Other columns are ignored. An empty table gives an empty result.

    ``digest_bytes`` shortens digests, so that tests can force equal keys of unlike chunks.
    """
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = recipes(source, digest_bytes)
    candidates = cut(settled(rows))
    if unsafe := _unsafe_keys(source, rows, candidates, digest_bytes):
        rows = recipes(source, digest_bytes, frozenset(unsafe) if len(unsafe) <= MOST_UNSAFE else None)
        candidates = cut(settled(rows))
    right = candidates.select(F.col("recipe_key").alias("right_key"), F.col("recipe").alias("right_recipe"), "keep", "rows")
    right_bytes = F.aggregate("right_recipe", F.lit(64), lambda held, part: held + F.octet_length(part) + 16)
    joined = rows.join(
        small_side(right, right_bytes), (F.col("recipe_key") == F.col("right_key")) & (F.col("recipe") == F.col("right_recipe")), "left"
    )
    keep = F.when(F.col("rows").isNull(), F.col("doc_id")).otherwise(F.col("keep"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("rows", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def keep_first_copies(docs: DataFrame) -> DataFrame:
    """Rows of ``docs``, with all their columns, one for each different text (NULL is empty): that of the largest id.

    Rows that agree in id and text are told apart by nothing; one of them stays.
    """
    marked = docs.select(F.struct("*").alias("row"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    result = dedup_exact(docs).groupBy("doc_id", "text_sha256").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    result = result.where("not kept or n > 1").select(F.col("doc_id").alias("other_id"), F.col("text_sha256").alias("other_sha"), "kept")
    result = cut(result)
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & (F.col("sha") == F.col("other_sha"))
    stays = marked.join(small_side(result, 96), same, "left_anti").select("row.*")
    again = result.where("kept")
    if again.isEmpty():
        return stays
    repeated = marked.join(again, same, "left_semi").dropDuplicates(["doc_id", "sha"]).select("row.*")
    return stays.unionByName(repeated)


def settled(rows: DataFrame) -> DataFrame:
    """Different recipes that several rows have; with their number and the id that stays.

    All identifiers of such a recipe are shared. A row whose recipe is its own has no copy and is
    left out. A recipe moves once, whole, after rows of one map task are counted together.
    """
    return rows.groupBy("recipe_key", "recipe").agg(F.max("doc_id").alias("keep"), F.count(F.lit(1)).alias("rows")).where("rows > 1")


def _unsafe_keys(source: DataFrame, rows: DataFrame, candidates: DataFrame, digest_bytes: int) -> list[bytes]:
    """Keys that stand for more than one content among the candidates; their texts are read again for that."""
    wanted = rows.join(small_side(candidates.select("recipe_key"), 16), "recipe_key", "left_semi")
    ids = cut(wanted.groupBy(F.col("doc_id").alias("wanted_id")).agg(F.count(F.lit(1)).alias("n")).select("wanted_id"))
    texts = source.join(small_side(ids, 16), F.col("doc_id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    contents = texts.mapInArrow(lambda batches: _contents(batches, digest_bytes), "key binary, content binary")
    variants = contents.groupBy("key", "content").agg(F.count(F.lit(1)).alias("n"))
    unsafe = variants.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    return [bytes(r[0]) for r in unsafe.limit(MOST_UNSAFE + 1).collect()]
