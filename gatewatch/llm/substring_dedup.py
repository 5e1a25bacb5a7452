"""Removal of word passages that occur more than once, found by difference-cover anchors.

A difference cover of a period holds, for any two positions, an offset at which both
stand on cover positions. So two equal passages of ``window`` words share an equal
anchor: ``window - period + 1`` words that start on a cover position in both. Only
anchors are hashed and dealt out first (5 of 21 positions for 35 words). Windows around
repeated anchors are then hashed in full, 96 bits each, and compared in the same way, so
what is removed rests on whole windows.

Of texts that occur whole more than once, one stands for all when it meets others; all
of them go without being looked at.

A slice of documents sends one row per different hash. Repeats within a slice are known
there and need no partner, hence a passage in very many documents costs few rows. Equal
hashes meet by sorting partitions, not by collecting groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.common import BROADCAST_BYTES, cut
from gatewatch.llm.words import Words, mix, signed, slices, text_bytes, window_hashes

#: Perfect difference sets: every difference modulo the period occurs.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
_ROWS = "first long, second int, mark byte, key long, place int"
#: Marks of rows: nothing known, known to repeat, stands for copies (which go whole, so its places are not asked for).
OPEN, REPEATED, COPIES = 0, 1, 2


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of a third of the window; short windows are their own anchors."""
    fit = [p for p in COVERS if 3 * (window - p + 1) >= window]
    return (max(fit), COVERS[max(fit)]) if fit else (1, (0,))


def _rows(first: np.ndarray, second: np.ndarray, keys: np.ndarray, places: np.ndarray, copies: np.ndarray, salt: int) -> pa.RecordBatch:
    """One row per different hash with its place; further places of a hash get hashes of their own and are marked as repeated."""
    order = np.argsort(first, kind="stable")
    first, second, keys, places, copies = first[order], second[order], keys[order], places[order], copies[order]
    same = np.zeros(len(first), bool)
    same[1:] = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
    marks = np.zeros(len(first), np.int8)
    marks[same] = REPEATED
    marks[:-1][same[1:]] = REPEATED
    marks[copies] = COPIES
    own = np.flatnonzero(same)
    first[own] = mix(first[own] + np.arange(len(own), dtype=np.uint64) + np.uint64(salt))
    second[own] = 0
    sent = np.flatnonzero(~(same & copies))
    columns = [signed(first[sent]), second[sent], marks[sent], keys[sent], places[sent].astype(np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["first", "second", "mark", "key", "place"])


def _salt(keys: np.ndarray) -> int:
    return int(np.bitwise_xor.reduce(mix(keys.astype(np.int64).view(np.uint64)))) if len(keys) else 0


def _anchors(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    period, cover = cover_for(window)
    size = window - period + 1
    on_cover = np.isin(np.arange(period), cover)
    for batch in batches:
        all_keys = batch.column("key").to_numpy()
        for lo, hi, data, offsets in slices(batch.column("text")):
            words, keys = Words(data, offsets), all_keys[lo:hi]
            hashes = window_hashes(words.hashes(), size)
            texts = words.texts[: len(hashes)]
            places = np.arange(len(hashes)) - words.first[texts]
            fit = on_cover[places % period] & (places + size <= words.counts[texts]) & (words.counts[texts] >= window)
            at = np.flatnonzero(fit)
            none = np.zeros(len(at), np.int32)
            yield _rows(hashes[at], none, keys[texts[at]], places[at], none > 0, _salt(keys))


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows of all windows that hold a repeated anchor."""
    reach = cover_for(window)[0]
    for batch in batches:
        all_keys, all_copies = batch.column("key").to_numpy(), batch.column("copies").to_numpy(zero_copy_only=False)
        lists = batch.column("places")
        bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
        for lo, hi, data, offsets in slices(batch.column("text")):
            words, keys = Words(data, offsets), all_keys[lo:hi]
            one, two = (window_hashes(words.hashes(which=k), window, which=k) for k in (0, 1))
            starts, owners = [], []
            for d in range(hi - lo):
                last = int(words.counts[d]) - window
                if last >= 0:
                    near = np.zeros(last + 2, np.int64)
                    anchors = values[bounds[lo + d] : bounds[lo + d + 1]]
                    np.add.at(near, np.clip(anchors - reach + 1, 0, last + 1), 1)
                    np.add.at(near, np.clip(anchors + 1, 0, last + 1), -1)
                    found = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                    starts.append(found)
                    owners.append(np.full(len(found), d))
            if starts:
                places, texts = np.concatenate(starts), np.concatenate(owners)
                at = places + words.first[texts]
                second = (two[at] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield _rows(one[at], second, keys[texts], places, all_copies[lo:hi][texts], _salt(keys))


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of rows, sorted by hash, that have an equal neighbour or are marked; one row is held back between batches."""
    held = None
    for batch in batches:
        columns = [batch.column(c).to_numpy() for c in ("first", "second", "mark", "key", "place")]
        if not len(columns[0]):
            continue
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        first, second, marks, key, place = columns
        repeated = marks == REPEATED
        same = (first[1:] == first[:-1]) & (second[1:] == second[:-1])
        repeated[1:] |= same
        repeated[:-1] |= same
        repeated &= marks != COPIES
        # A held row that has met an equal one stays marked.
        held = [first[-1:], second[-1:], np.where(repeated[-1:], REPEATED, marks[-1:]).astype(np.int8), key[-1:], place[-1:]]
        found = np.flatnonzero(repeated[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(key[found]), pa.array(place[found])], names=["key", "place"])
    if held is not None and held[2][0] == REPEATED:
        yield pa.RecordBatch.from_arrays([pa.array(held[3]), pa.array(held[4])], names=["key", "place"])


def _places(rows: DataFrame) -> DataFrame:
    """``key`` and all ``places`` of each document whose hash occurs more than once."""
    dealt = rows.repartition("first", "second").sortWithinPartitions("first", "second")
    return dealt.mapInArrow(_repeated, "key long, place int").groupBy("key").agg(F.collect_list("place").alias("places"))


def _with_places(docs: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """Documents with their ``places``; where the ids of those that have any are few, no other text is shuffled."""
    ids = cut(places.select(F.col("key").alias("some_key")))
    right = places.withColumnRenamed("key", "place_key")
    if ids.count() * 16 > BROADCAST_BYTES:
        return docs.join(right, F.col("key") == F.col("place_key"), how).drop("place_key")
    same = F.col("key") == F.col("some_key")
    some = docs.join(F.broadcast(ids), same, "left_semi").join(right, F.col("key") == F.col("place_key")).drop("place_key")
    if how == "inner":
        return some
    rest = docs.join(F.broadcast(ids), same, "left_anti").withColumn("places", F.lit(None).cast("array<int>"))
    return some.unionByName(rest)


def _with_copies(keyed: DataFrame, window: int) -> DataFrame:
    """Adds ``copies`` (the text occurs whole elsewhere) and ``stands`` (first of its copies).

    Only where the ids of all copies fit a broadcast; else no row counts as a copy, and
    copies are found by their windows like anything else.
    """
    # A window takes a letter and a separator a word.
    long = keyed.where(F.octet_length("text") >= 2 * window - 1)
    prints = long.select(F.col("key").alias("copy_key"), F.xxhash64("text").alias("x"), F.xxhash64(F.lit(1), "text").alias("y"))
    classes = prints.groupBy("x", "y").agg(F.min("copy_key").alias("stands_for"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    copies = cut(prints.join(classes, ["x", "y"]).select("copy_key", "stands_for").distinct())
    if copies.count() * 16 > BROADCAST_BYTES:
        return keyed.withColumn("copies", F.lit(False)).withColumn("stands", F.lit(True))
    found = keyed.join(F.broadcast(copies), F.col("key") == F.col("copy_key"), "left")
    return found.select(
        *keyed.columns,
        F.col("copy_key").isNotNull().alias("copies"),
        (F.col("copy_key").isNull() | (F.col("key") == F.col("stands_for"))).alias("stands"),
    )


def _kept(batches: Iterator[pa.RecordBatch], window: int, texts: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        lists, copies = batch.column("places"), batch.column("copies").to_numpy(zero_copy_only=False)
        n_words, n_removed, digests, kept = [], [], [], []
        for d in range(batch.num_rows):
            words = data[offsets[d] : offsets[d + 1]].tobytes().split()
            removed = 0
            n_words.append(len(words))
            if copies[d] and len(words) >= window:
                removed, words = len(words), []
            elif lists[d].is_valid:
                cover = np.zeros(len(words) + 1, np.int64)
                starts = np.unique(np.asarray(lists[d].values))
                cover[starts] += 1
                cover[starts + window] -= 1
                stays = np.cumsum(cover[:-1]) == 0
                removed = len(words) - int(stays.sum())
                words = list(compress(words, stays.tolist()))
            n_removed.append(removed)
            whole = b" ".join(words)
            digests.append(hashlib.sha256(whole).hexdigest())
            if texts:
                kept.append(whole.decode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())]
            + [pa.array(kept, pa.string())] * texts,
            names=["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * texts,
        )


def remove_repeats(docs: DataFrame, window: int = 35, texts: bool = False) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``) without words in repeated passages.

    A word goes if a window of ``window`` words that covers it, within its document, has
    the same words as a window that starts anywhere else, the same document included.
    Returns ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words,
    joined by one space) and, with ``texts``, ``kept_text``.

    * Words are runs of other than the six ASCII separators, unchanged. A NULL text has none.
    * Texts of fewer words than a window stay whole.
    * Rows that repeat an id, or have none, are documents of their own; rows that repeat id
      and text are copies of one another, and go if they have a window.
    * Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # Ids are keys where they are all there and all different; else a hash of id and text.
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("none")).first()
    whole = docs.schema["doc_id"].dataType.simpleString() in ("bigint", "int", "smallint", "tinyint")
    plain = whole and (ids["n"] or 0) <= 1 and not ids["none"]
    key = F.col("doc_id").cast("long") if plain else F.xxhash64("doc_id", "text")
    keyed = _with_copies(rows.withColumn("key", key), window)
    standing = keyed.where("stands").select("key", "text", "copies")
    anchors = standing.select("key", "text").mapInArrow(lambda batches: _anchors(batches, window), _ROWS)
    near = cut(_places(anchors))
    around = _with_places(standing, near, "inner")
    windows = around.mapInArrow(lambda batches: _windows(batches, window), _ROWS)
    repeated = cut(_places(windows))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * texts
    columns = ["doc_id", "key", "text", "copies"]
    return _with_places(keyed.select(columns), repeated, "left").mapInArrow(lambda batches: _kept(batches, window, texts), schema)
