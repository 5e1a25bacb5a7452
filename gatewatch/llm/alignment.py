"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

The tokens of both sides cover the same bytes. Where tokens of both end at one byte, the
text can be cut. An interval of tokens is halved at the shared cut nearest to its middle,
which is found by bisecting the other side's ends from the middle outwards; both halves go
on alike, and an interval without a cut inside is a leaf group. All intervals of a slice
of texts take each step at once. Bytes between the middle and the cut found hold no cut
and are not looked at again.

Tokens of one group are linked with one another. Over the corpus, a pair of ids counts the
documents in which it is linked.

Before that, texts are encoded. Tokens of neither side reach over a word's end into the
space behind it, so words met before are not encoded again, and new ones are encoded side
by side as one text. Alignment is of whole texts.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.llm.bpe import Recent
from gatewatch.llm.common import cut, scratch_table, small_side
from gatewatch.llm.words import ranges, slices

#: Bytes of a row of the table of pairs where it is broadcast (key, count, mark, and the hash table around them).
PAIR_BYTES = 48

#: Words of a text behind a space: each ends before a space that follows no white space; white space at the end of the text stays at the last.
_WORD = re.compile(r" (\s*\S+(?:[^\S ]\s*\S*| +\Z)*|\s*)")
#: White space before a space that may belong to the same token.
_ODD_SPACE = re.compile(r"[^\S ] ")
#: Texts with this character or later ones are encoded whole: what is white space there depends on the version of the character tables.
_BEYOND_LATIN = "\u0250"


def _byte_alphabet() -> dict[str, int]:
    """Bytes as printable characters: those that print stand for themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class ByteSide:
    """A byte-level BPE file of the ``tokenizers`` library; texts are encoded with a space before them.

    ``can_cut`` tells whether the file's first step always cuts between a word and the space behind it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            first = json.load(file)
        own = first["pre_tokenizer"]
        self.can_cut = first["normalizer"] is None and own["type"] == "ByteLevel" and own["use_regex"] and not own["add_prefix_space"]
        self.can_cut &= all(t["special"] for t in first["added_tokens"])
        alphabet, special = _byte_alphabet(), {i: t.content for i, t in self.library.get_added_tokens_decoder().items()}
        self.tokens = [b""] * (max(self.library.get_vocab().values()) + 1)
        for token, i in self.library.get_vocab().items():
            self.tokens[i] = special[i].encode() if i in special else bytes(alphabet[c] for c in token)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids (int32) of texts."""
        return [np.array(e.ids, np.int32) for e in self.library.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]


class PieceSide:
    """A ``sentencepiece`` model, which puts the space before a text itself.

    ``can_cut`` tells whether characters of Latin texts stay as they are and no piece has a space behind another character.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.tokens = [self._bytes(i) for i in range(self.library.get_piece_size())]
        latin = f"  {' '.join(map(chr, range(ord(_BEYOND_LATIN))))}  "
        self.can_cut = self.library.normalize(latin) == f" {latin}".replace(" ", "▁")
        self.can_cut &= all(b" " not in t.lstrip(b" ") for t in self.tokens)

    def _bytes(self, i: int) -> bytes:
        piece = self.library.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self.library.encode(texts, num_threads=1)]


class Side:
    """Token ids of texts or words, with the bytes of each token."""

    def __init__(self, library: ByteSide | PieceSide):
        self.library, self.tokens = library, library.tokens
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.library.encode(texts)

    def covers(self, ids: np.ndarray, text: bytes) -> bool:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.tolist()]) == text

    def encode_words(self, words: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of words, none of which ends in white space, and how many each has; None if they can't be told apart.

        Words are encoded side by side; ``sizes`` are their bytes with the space before.
        """
        text = " ".join(words)
        (ids,) = self.encode([text])
        if not self.covers(ids, f" {text}".encode()):
            return None
        ends, word_ends = np.cumsum(self.lengths[ids]), np.cumsum(sizes)
        last = np.searchsorted(ends, word_ends)
        return (ids, np.diff(last, prepend=-1)) if (ends[last] == word_ends).all() else None


def words_of(text: str) -> list[str]:
    """Words of a text with what precedes them but one space; joined by spaces, they are the text."""
    if text[:1] == " " or text[-1:].isspace() or "  " in text or _ODD_SPACE.search(text):
        return _WORD.findall(f" {text}")
    return text.split(" ")


def _records(a: np.ndarray, count_a: np.ndarray, b: np.ndarray, count_b: np.ndarray) -> list[bytes]:
    """Ids of both sides (int32) of each word in one: how many A has, A's, B's."""
    sizes = 1 + count_a + count_b
    ends = np.cumsum(sizes)
    starts, held = ends - sizes, np.empty(int(sizes.sum()), np.int32)
    held[starts], held[ranges(starts + 1, count_a)], held[ranges(starts + 1 + count_a, count_b)] = count_a, a, b
    raw = held.tobytes()
    return [raw[lo:hi] for lo, hi in zip((starts * 4).tolist(), (ends * 4).tolist(), strict=True)]


class Both:
    """Encoder of Latin texts by two sides, which remembers words; other texts are encoded whole."""

    def __init__(self, one: Side, two: Side):
        self.one, self.two = one, two
        self.can_cut = one.library.can_cut and two.library.can_cut
        self.known = Recent()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts on one side after another and how many each text has, then those of the other side.

        There are none if the text is empty or one side's tokens don't spell a space and the text.
        """
        cut_up = [words_of(t) if t and self.can_cut and (t.isascii() or max(t) < _BEYOND_LATIN) else [] for t in texts]
        self.known.learn(self._learn_words(self.known.missing(chain.from_iterable(cut_up))))
        known = self.known.young
        records = [known[w] for words in cut_up for w in words]
        self.known.tidy()
        # A side's ids of words, and their number in each text.
        held = np.frombuffer(b"".join(records), np.int32)
        sizes = np.array([len(r) for r in records], np.int64) // 4
        odd, starts = sizes == 0, np.cumsum(sizes) - sizes
        count_a = np.zeros(len(sizes), np.int64)
        count_a[~odd] = held[starts[~odd]]
        count_b = sizes - count_a - ~odd
        a, b = (held[ranges(begin, count)].astype(np.int64) for begin, count in ((starts + 1, count_a), (starts + 1 + count_a, count_b)))
        text_ends = np.cumsum([len(words) for words in cut_up])
        in_texts = [np.diff(np.concatenate([[0], np.cumsum(count)])[text_ends], prepend=0) for count in (count_a, count_b)]
        whole = {n for n, words in enumerate(cut_up) if texts[n] and not words} | set(np.searchsorted(text_ends, np.flatnonzero(odd), side="right").tolist())
        if not whole:
            return a, in_texts[0], b, in_texts[1]
        own = zip(*(np.split(side, np.cumsum(count)[:-1]) for side, count in zip((a, b), in_texts, strict=True)), strict=True)
        pairs = [self._whole(texts[n]) if n in whole else pair for n, pair in enumerate(own)]
        return *_flat([a for a, _ in pairs]), *_flat([b for _, b in pairs])

    def _whole(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        (a,), (b,), spelled = self.one.encode([text]), self.two.encode([text]), f" {text}".encode()
        nothing = np.zeros(0, np.int32)
        return (a, b) if self.one.covers(a, spelled) and self.two.covers(b, spelled) else (nothing, nothing)

    def _learn_words(self, words: list[str]) -> dict[str, bytes]:
        """Records of words; empty ones for words whose texts must be encoded whole."""
        learned = dict.fromkeys(words, b"")
        single, close = [w for w in words if w[-1].isspace()], [w for w in words if not w[-1].isspace()]
        sizes = np.array([1 + len(w.encode()) for w in close], np.int64)
        a, b = (side.encode_words(close, sizes) for side in (self.one, self.two)) if close else (None, None)
        if a and b:
            learned |= zip(close, _records(*a, *b), strict=True)
        else:
            single += close
        for word in single:
            a, b = self._whole(word)
            if len(a):
                learned[word] = _records(a, np.array([len(a)]), b, np.array([len(b)]))[0]
        return learned


@cache
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """Both tokenizers, once per worker process."""
    return Side(ByteSide(path_a)), Side(PieceSide(path_b))


@cache
def both(path_a: str, path_b: str) -> Both:
    """Both tokenizers and the words they remember, once per worker process."""
    return Both(*sides(path_a, path_b))


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, last_a: np.ndarray) -> np.ndarray:
    """Places in ``ends_a`` whose value is also in ``ends_b``; both ascend strictly.

    ``last_a`` are the places of the last token of each text, where both sides end.
    """
    found = [last_a]
    low = np.concatenate([[0], last_a[:-1] + 1]) if len(last_a) else last_a
    high, radius = last_a, np.zeros(len(last_a), np.int64)
    middle = (low + high) // 2
    while True:
        open_ = low < high  # places from low to high - 1 may hold a cut
        if not open_.any():
            break
        order = np.flatnonzero(open_)
        order = order[np.argsort(middle[order], kind="stable")]  # neighbours are looked up one after another
        low, high, middle, radius = low[order], high[order], middle[order], radius[order]
        left, right = np.maximum(low, middle - radius), np.minimum(high, middle + radius + 1)
        counts = right - left
        at = ranges(left, counts)
        owner = np.repeat(np.arange(len(left)), counts)
        place = np.searchsorted(ends_b, ends_a[at])  # in range: both sides end at the same byte
        far = np.where(ends_b[place] == ends_a[at], 2 * np.abs(at - middle[owner]) + (at > middle[owner]), np.iinfo(np.int64).max)
        nearest = np.minimum.reduceat(far, np.cumsum(counts) - counts)
        hit = nearest < np.iinfo(np.int64).max
        cut_at = middle + np.where(nearest % 2 == 1, 1, -1) * (nearest // 2)
        found.append(cut_at[hit])
        # What lies between middle and cut is known; the side away from the cut starts beyond it.
        step = np.abs(cut_at - middle)
        from_right = cut_at > middle
        low_end = np.where(from_right, middle - step, cut_at)[hit]
        high_start = np.where(from_right, cut_at + 1, np.maximum(middle + step, cut_at + 1))[hit]
        whole = ~hit & ((left > low) | (right < high))
        low, high, middle, radius = (
            np.concatenate([low[hit], high_start, low[whole]]),
            np.concatenate([low_end, high[hit], high[whole]]),
            np.concatenate([(low[hit] + low_end) // 2, (high_start + high[hit]) // 2, middle[whole]]),
            np.concatenate([np.zeros(2 * int(hit.sum()), np.int64), 2 * radius[whole] + 1]),
        )
    return np.sort(np.concatenate(found))


def _lists(values: np.ndarray, counts: np.ndarray, kind=np.int32) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(kind)))


def _flat(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], np.int64)
    return np.concatenate([np.zeros(0, np.int32), *lists]).astype(np.int64), counts


def _per_text(places: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many of ``places`` fall into each of consecutive runs of ``counts``."""
    return np.diff(np.searchsorted(places, np.concatenate([[0], np.cumsum(counts)])))


def _counted(group: np.ndarray, ids: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes, times = np.unique(group * wide + ids, return_counts=True)
    return codes // wide, codes % wide, times


class Aligned:
    """Tokens and groups of some texts as flat arrays; ``ends_a`` and ``ends_b`` run on over texts."""

    def __init__(self, texts: list[str], own: Both):
        self.a, self.count_a, self.b, self.count_b = own.encode(texts)
        ends_a, ends_b = np.cumsum(own.one.lengths[self.a]), np.cumsum(own.two.lengths[self.b])
        cuts_a = shared_cuts(ends_a, ends_b, np.cumsum(self.count_a[self.count_a > 0]) - 1)
        self.groups = _per_text(cuts_a, self.count_a)
        self.ends_a, self.ends_b = cuts_a + 1, np.searchsorted(ends_b, ends_a[cuts_a]) + 1
        self.text = np.repeat(np.arange(len(texts)), self.groups)
        self.size_a, self.size_b = np.diff(self.ends_a, prepend=0), np.diff(self.ends_b, prepend=0)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, pair of ids (A's in the upper half) and number of links, for each different pair of a text.

        Equal ids of a group are counted before they are paired, so long runs of one token
        make few pairs.
        """
        number, wide = np.arange(len(self.text)), 1 << 31
        group_a, ids_a, times_a = _counted(np.repeat(number, self.size_a), self.a, wide)
        group_b, ids_b, times_b = _counted(np.repeat(number, self.size_b), self.b, wide)
        first_b = np.searchsorted(group_b, number)
        partners = np.bincount(group_b, minlength=len(number))[group_a]
        left, right = np.repeat(np.arange(len(ids_a)), partners), ranges(first_b[group_a], partners)
        text, pair, times = self.text[group_a[left]], (ids_a[left] << 32) | ids_b[right], times_a[left] * times_b[right]
        order = np.lexsort((pair, text))
        text, pair, times = text[order], pair[order], times[order]
        new = np.ones(len(pair), bool)
        new[1:] = (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(new)
        return text[starts], pair[starts], np.add.reduceat(times, starts) if len(starts) else times

    def spelled(self) -> list[str]:
        """Groups of each text as ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(self.a), len(self.b)
        # Tokens of a group side by side: A's, then B's.
        place_a = np.arange(n_a) + np.repeat(self.ends_b - self.size_b, self.size_a)
        place_b = np.arange(n_b) + np.repeat(self.ends_a, self.size_b)
        marks = np.zeros(n_a + n_b, np.int64)
        marks[place_a[self.ends_a - 1]] = 1
        marks[place_b[self.ends_b - 1]] = 2
        ids = np.empty(n_a + n_b, np.int64)
        ids[place_a], ids[place_b] = self.a, self.b
        written, out, at = _written(int(ids.max(initial=0)))[ids * 3 + marks].tolist(), [], 0
        for size in (self.count_a + self.count_b).tolist():
            out.append("".join(written[at : at + size])[:-1])
            at += size
        return out


@cache
def _numbers(size: int) -> np.ndarray:
    return np.array([f"{i}{mark}" for i in range(size) for mark in ",|;"], object)


def _written(most: int) -> np.ndarray:
    """Decimal numbers up to ``most`` at least, each with a comma, a bar and a semicolon behind it."""
    return _numbers(1 << max(most + 1, 1).bit_length())


def _each_slice(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[tuple[pa.Array, Aligned]]:
    """Ids of documents and their alignment, a slice of texts at a time."""
    own = both(path_a, path_b)
    for batch in batches:
        column = batch.column("text")
        for lo, hi, _, _ in slices(column):
            texts = [t or "" for t in column.slice(lo, hi - lo).to_pylist()]
            yield batch.column("doc_id").slice(lo, hi - lo), Aligned(texts, own)


def align(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Tokens of both sides and their groups, one row per row of ``docs`` (``doc_id``, ``text``).

    ``a`` and ``b`` are the token ids; ``ends_a`` and ``ends_b`` say, group by group, how
    many tokens of each side the text has up to the end of the group.

    * Texts that are NULL or empty, or whose tokens on either side don't spell a space and
      the text, have empty lists.
    * Rows are worked on one by one: repeated rows and ids stay, a NULL id stays NULL.
    * Texts of any length are aligned whole. Other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in _each_slice(batches, path_a, path_b):
            before_a, before_b = np.cumsum(own.count_a) - own.count_a, np.cumsum(own.count_b) - own.count_b
            yield pa.RecordBatch.from_arrays(
                [ids, _lists(own.a, own.count_a), _lists(own.b, own.count_b),
                 _lists(own.ends_a - before_a[own.text], own.groups), _lists(own.ends_b - before_b[own.text], own.groups)],
                names=["doc_id", "a", "b", "ends_a", "ends_b"],
            )

    lists = ", ".join(f"{c} array<int>" for c in ("a", "b", "ends_a", "ends_b"))
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {lists}")


def describe(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Counts, hashed groups and different linked pairs of each row of ``docs``, with the rules of ``align``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, own in _each_slice(batches, path_a, path_b):
            text, pair, times = own.links()
            per_text = np.bincount(text, minlength=len(ids))
            links = np.bincount(own.text, weights=own.size_a * own.size_b, minlength=len(ids)).astype(np.int64)
            hashed = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in own.spelled()]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(own.count_a), pa.array(own.count_b), pa.array(own.groups), pa.array(links),
                 pa.array(hashed, pa.string()), _lists(pair, per_text, np.int64), _lists(times, per_text, np.int64)],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    )


def pair_counts(described: DataFrame) -> DataFrame:
    """Each linked ``pair`` of ids: in how many rows (``documents``), and whether no partner of its A id has more (``best``)."""
    counts = described.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    counts = cut(counts)
    highest = counts.groupBy(F.shiftright("pair", 32).alias("id_a")).agg(F.max("documents").alias("most"))
    joined = counts.withColumn("id_a", F.shiftright("pair", 32)).join(highest, "id_a")
    return cut(joined.select("pair", "documents", (F.col("documents") == F.col("most")).alias("best")))


def digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per row of ``docs``: counts of tokens, groups and links, and how common its links are.

    ``n_best`` are the links whose pair is the commonest of its A id, ties included;
    ``count_sum`` sums the documents that hold its pair over all links. Each row counts as
    one document, also where ids or whole rows repeat. Rows without tokens have zeros and
    an empty ``groups_sha256``.

    The table of pairs grows with the vocabularies and the text; it is broadcast only where
    its counted rows fit, otherwise pairs are joined by shuffle.
    """
    described = scratch_table(describe(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = small_side(pair_counts(described), PAIR_BYTES)
    links = described.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    known = links.join(counts, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum")
    )
    zero = F.lit(0).cast("long")
    return described.drop("pairs", "times").join(known, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
