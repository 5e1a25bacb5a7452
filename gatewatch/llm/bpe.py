"""Byte-pair encoding and decoding with a public vocabulary, its merges done in contiguous rank arrays.

A word is held as one array of part ids and one of the ranks of adjacent parts. The least
rank is looked for by a scan, the boundary at its first place is deleted, and the ranks
left and right of it are looked up again, until no adjacent pair has a rank. Words of like
length take each step side by side, as rows of one matrix. Long words would make the scans
quadratic; their pairs wait in a heap in the same order (rank, then place), so the parts are
the same.

What precedes the merges (normalisation, cutting text into words) is the tokenizer file's
own, through the ``tokenizers`` library. White space never stands inside a word, so texts
are cut at ASCII white space first, and what is known of pieces and words is used again.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gatewatch.llm.words import slices

#: Words of up to this many bytes are merged by scanning.
SHORT = 256
#: Words side by side.
ROWS = 4096
#: Pieces and words remembered per worker, each, and the longest of them.
MOST_PIECES, LONGEST_PIECE = 500_000, 128
#: Characters of a text that are cut into pieces at a time.
STRETCH = 1 << 20
_PIECE = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE, _ODD_SPACE = re.compile(r"[\x20\x09-\x0D]"), re.compile(r"[^\S\x20\x09-\x0D]")
#: Fixed value: how files of this kind cut texts into words, and what that comes to for plain ASCII without apostrophes.
_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN, _PLAIN_WORD = re.compile(r"[!-&(-~]+"), re.compile(r"[a-z]+|[0-9]|[^a-z0-9 ]+| ")
_NEVER = 1 << 30


class Merges:
    """Parts of words by the merge ranks of one vocabulary."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str = ""):
        self.vocabulary, self.suffix = vocabulary, suffix
        self.wide = max(vocabulary.values(), default=0) + 1
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(merges):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocabulary[left] * self.wide + vocabulary[right]] = rank
            self.merged.append(vocabulary[left + right])

        keys = np.array(sorted(self.ranks), np.int64)
        self.pairs = np.append(keys, np.iinfo(np.int64).max)
        self.pair_ranks = np.array([*(self.ranks[k] for k in keys.tolist()), _NEVER], np.int64)
        self.results = np.array([*self.merged, 0], np.int64)
        # Ids of single symbols, within a word and at its end; -1 where there is none.
        letters = [ord(t[0]) for t in vocabulary if len(t.removesuffix(suffix)) == 1]
        self.inner, self.final = (np.full(max(letters, default=0) + 2, -1, np.int64) for _ in range(2))
        for code in letters:
            self.inner[code] = vocabulary.get(chr(code), -1)
            self.final[code] = vocabulary.get(chr(code) + suffix, -1)

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids (int32) of words given in the vocabulary's alphabet; symbols without an id are left out."""
        sizes = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        codes = np.minimum(codes, len(self.inner) - 1)
        symbols, ends = self.inner[codes], np.cumsum(sizes)
        last = ends[sizes > 0] - 1
        symbols[last] = self.final[codes[last]]
        starts = ends - sizes
        if (symbols < 0).any():
            known = np.concatenate([[0], np.cumsum(symbols >= 0)])
            symbols, sizes, starts = symbols[symbols >= 0], known[ends] - known[starts], known[starts]
        found: list[bytes] = [b""] * len(words)
        order = np.argsort(sizes, kind="stable")
        short = order[(sizes[order] <= SHORT) & (sizes[order] > 0)]
        for at in range(0, len(short), ROWS):
            rows = short[at : at + ROWS]
            self.scan(rows, symbols, starts[rows], sizes[rows], found)
        for row in order[sizes[order] > SHORT].tolist():
            parts = self.queue(symbols[starts[row] : starts[row] + sizes[row]].tolist())
            found[row] = np.array(parts, np.int32).tobytes()
        return found

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = np.where((left >= 0) & (right >= 0), left * self.wide + right, -1)
        at = np.searchsorted(self.pairs, key)
        return np.where(self.pairs[at] == key, self.pair_ranks[at], _NEVER)

    def scan(self, words: np.ndarray, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray, found: list[bytes]) -> None:
        """Merge words side by side; row ``i`` holds the parts of one word, then -1."""
        widest = int(sizes.max())
        column = np.arange(widest)
        inside = column < sizes[:, None]
        parts = np.full((len(words), widest + 1), -1, np.int64)
        parts[:, :widest][inside] = symbols[(starts[:, None] + column)[inside]]
        ranks = self.rank(parts[:, :-1], parts[:, 1:])
        left = sizes.copy()
        while len(words):
            at = ranks.argmin(axis=1)
            row = np.arange(len(words))
            least = ranks[row, at]
            done = least == _NEVER
            if done.any():
                for word, ids, size in zip(words[done].tolist(), parts[done].astype(np.int32), left[done].tolist(), strict=True):
                    found[word] = ids[:size].tobytes()
                words, parts, ranks, left, at, least = (x[~done] for x in (words, parts, ranks, left, at, least))
                row = np.arange(len(words))
            if not len(words):
                return
            width = ranks.shape[1]
            # Delete the boundary: the parts right of it move up, and so do the ranks.
            step = np.arange(width) + (np.arange(width) >= at[:, None])
            ranks = np.take_along_axis(np.concatenate([ranks, np.full((len(words), 1), _NEVER)], axis=1), step, axis=1)
            moved = np.arange(width + 1) + (np.arange(width + 1) > at[:, None])
            parts = np.take_along_axis(np.concatenate([parts, np.full((len(words), 1), -1)], axis=1), moved, axis=1)
            parts[row, at] = self.results[least]
            left -= 1
            ranks[row, at] = self.rank(parts[row, at], parts[row, at + 1])
            before = at > 0
            row, at = row[before], at[before]
            ranks[row, at - 1] = self.rank(parts[row, at - 1], parts[row, at])
            # Columns that no row reaches any more.
            widest = int(left.max())
            parts, ranks = parts[:, : widest + 1], ranks[:, :widest]

    def queue(self, parts: list[int]) -> list[int]:
        rank, wide, n = self.ranks.get, self.wide, len(parts)
        before, after = array("q", range(-1, n - 1)), array("q", range(1, n + 1))
        # Rank and place in one number; a number whose pair has changed since is passed over.
        waiting = [r * n + i for i in range(n - 1) if (r := rank(parts[i] * wide + parts[i + 1])) is not None]
        heapq.heapify(waiting)
        while waiting:
            least, at = divmod(heapq.heappop(waiting), n)
            right = after[at]
            if parts[at] < 0 or right == n or rank(parts[at] * wide + parts[right]) != least:
                continue
            parts[at], parts[right] = self.merged[least], -1
            after[at] = right = after[right]
            if right < n:
                before[right] = at
                if (r := rank(parts[at] * wide + parts[right])) is not None:
                    heapq.heappush(waiting, r * n + at)
            left = before[at]
            if left >= 0 and (r := rank(parts[left] * wide + parts[at])) is not None:
                heapq.heappush(waiting, r * n + left)
        return [p for p in parts if p >= 0]


class Recent:
    """Ids of texts met of late. When the younger half is full it becomes the older one, so frequent texts stay."""

    def __init__(self) -> None:
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.long: list[str] = []

    def missing(self, texts: Iterable[str]) -> list[str]:
        """Different ones of ``texts`` that are not known; those that are can be looked up in ``young`` from here on."""
        absent, new, old = set(texts).difference(self.young), [], self.old
        for text in absent:
            if text in old:
                self.young[text] = old[text]
            else:
                new.append(text)
        return new

    def learn(self, learned: dict[str, bytes]) -> None:
        self.young |= learned
        self.long += [t for t in learned if len(t) > LONGEST_PIECE]

    def tidy(self) -> None:
        """Call when a slice is done: long texts are forgotten, and from time to time the older half."""
        for text in self.long:
            self.young.pop(text, None)
        self.long = []
        if len(self.young) > MOST_PIECES // 2:
            self.old, self.young = self.young, {}


class Codec:
    """Encoder and decoder of a tokenizer file of the BPE kind, special tokens in texts included."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec["added_tokens"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [t["content"] for t in added if t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"])]
        if model["type"] != "BPE" or odd or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError(f"{path}: not supported: {[model['type'], *odd]}")
        library = Tokenizer.from_file(path)
        self.normal, self.words = library.normalizer, library.pre_tokenizer
        self.merges = Merges(model["vocab"], model["merges"], model.get("end_of_word_suffix") or "")
        self.special = {t["content"]: np.int32(t["id"]).tobytes() for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cutter = re.compile(f"({'|'.join(map(re.escape, longest_first))})") if self.special else None
        tokens = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in added}
        self.tokens = np.array([tokens.get(i) for i in range(max(tokens, default=-1) + 1)], object)
        cuts = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        self.simple = cuts[:1] == [_CUT] and len(cuts) == 2 and kinds == ["NFC", "Replace", "Lowercase"]
        self.known, self.known_words = Recent(), Recent()

    def _words(self, text: str) -> list[tuple[str, tuple[int, int]]]:
        return self.words.pre_tokenize_str(text)

    def _normal(self, text: str) -> str:
        return self.normal.normalize_str(text) if self.normal else text

    def _learn_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces, each encoded once."""
        if not pieces:
            return {}
        plain, odd = [], []
        special_within = self.cutter.search if self.cutter else lambda text: None
        for piece in pieces:
            (plain if self.simple and _PLAIN.fullmatch(piece) and not special_within(piece) else odd).append(piece)
        # Words one after another, and how many of them each piece has.
        words, counts = self._plain_words(plain) if plain else ([], [])
        if odd:
            more, number = self._library_words(odd)
            words, counts = words + more, counts + number
        new = [w for w in self.known_words.missing(words) if w not in self.special]
        self.known_words.learn(dict(zip(new, self.merges.encode(new), strict=True)))
        known, special = self.known_words.young, self.special
        ids = [special[w] if w in special else known[w] for w in words]
        ends = np.cumsum(counts).tolist()
        learned = {piece: b"".join(ids[end - n : end]) for piece, n, end in zip(plain + odd, counts, ends, strict=True)}
        self.known_words.tidy()
        return learned

    def _plain_words(self, pieces: list[str]) -> tuple[list[str], list[int]]:
        """Words of pieces of plain ASCII characters without apostrophes, by the file's own rule for them."""
        found = _PLAIN_WORD.findall(" ".join(pieces).lower())
        edges = np.flatnonzero(np.array([w == " " for w in found], bool))
        counts = np.diff(np.concatenate([[-1], edges, [len(found)]])) - 1
        return [w for w in found if w != " "], counts.tolist()

    def _library_words(self, pieces: list[str]) -> tuple[list[str], list[int]]:
        """Words of pieces as the library finds them."""
        joined = " ".join(pieces)
        if not (_ODD_SPACE.search(joined) or (self.cutter and self.cutter.search(joined))):
            # All at once: the library's steps never reach across white space.
            normal = self._normal(joined)
            spread = normal.split(" ")
            if len(spread) == len(pieces):
                ends = np.cumsum([len(p) + 1 for p in spread])
                found = self._words(normal)
                owner = np.searchsorted(ends, [place[0] for _, place in found], side="right")
                return [word for word, _ in found], np.bincount(owner, minlength=len(pieces)).tolist()
        parts = [self._parts(piece) for piece in pieces]
        return [w for own in parts for w in own], [len(own) for own in parts]

    def _parts(self, piece: str) -> list[str]:
        """Special tokens of a piece, and the words between them."""
        found = []
        for part in self.cutter.split(piece) if self.cutter else [piece]:
            if part in self.special:
                found.append(part)
            elif part:
                found += [word for word, _ in self._words(self._normal(part))]
        return found

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts; pieces that are new to the worker are learned for all texts together."""
        done: list[list[bytes]] = [[] for _ in texts]
        for group in _grouped(texts):
            cut = [(n, _PIECE.findall(stretch)) for n, stretch in group]
            self.known.learn(self._learn_pieces(self.known.missing(chain.from_iterable(pieces for _, pieces in cut))))
            known = self.known.young
            for n, pieces in cut:
                done[n].append(b"".join([known[p] for p in pieces]))
            self.known.tidy()
        return [np.frombuffer(b"".join(parts), np.int32) for parts in done]

    def decode(self, ids: np.ndarray | list[int]) -> str:
        """Tokens joined by a space, as a file without a decoder asks for; unknown ids are left out."""
        ids = np.asarray(ids, np.int64)
        found = self.tokens[ids[(ids >= 0) & (ids < len(self.tokens))]].tolist()
        return " ".join(found if None not in found else [t for t in found if t is not None])


def _grouped(texts: list[str]) -> Iterator[list[tuple[int, str]]]:
    """Stretches of texts with the number of their text, about as many characters at a time as a stretch has."""
    group, size = [], 0
    for n, text in enumerate(texts):
        for stretch in _stretches(text):
            group.append((n, stretch))
            size += len(stretch)
            if size >= STRETCH:
                yield group
                group, size = [], 0
    yield group


def _stretches(text: str) -> Iterator[str]:
    """A text in stretches that end at white space."""
    at = 0
    while at < len(text):
        space = _SPACE.search(text, min(at + STRETCH, len(text)))
        end = space.end() if space else len(text)
        yield text[at:end]
        at = end


@cache
def codec(path: str) -> Codec:
    """One codec per worker process."""
    return Codec(path)


def _list_of(rows: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *rows])))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id`` and the ``ids`` of its tokens.

    ``path`` names a tokenizer file that every worker can read.

    * NULL, empty and blank texts have no ids. Strings of special tokens in a text become
      those tokens, as the library does unless told otherwise.
    * Rows are worked on one by one: repeated rows and ids stay, a NULL id stays NULL.
    * Texts of any length are encoded whole. Other columns are ignored; an empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            texts = batch.column("text")
            for lo, hi, _, _ in slices(texts):
                rows = own.encode_all([t or "" for t in texts.slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), _list_of(rows)], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Rows of ``encoded`` (``doc_id``, ``ids``) with ``decoded``, the text of the ids; NULL ids count as none."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ends = part.column("ids").offsets.to_numpy() - part.column("ids").offsets[0].as_py()
                flat = part.column("ids").flatten().to_numpy(zero_copy_only=False)
                texts = [own.decode(flat[lo:hi]) for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("ids"), pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
