"""License scans: winnowed fingerprints pick candidates, banded alignment reports what matched.

Templates and documents are words of letters and digits. Of every few consecutive word
grams the one of least hash is a fingerprint, so any shared run of ``GRAM + WINDOW - 1``
words shares one. A short template is found by single words instead: whatever covers
enough of it holds one of any few of its places. An inverted index leads to templates and places.
Bands of diagonals lie half over one another, and each with a hit is aligned word by word
(match 2, mismatch and gap -1, local), again and again without the words used so far,
until the words of the template left in the band can't cover enough of it. A report is an
alignment that covers enough of its template.

The index of the templates goes to every task. Its size is checked; the documents are
gone through once and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gatewatch.llm.license_templates import TEMPLATES
from gatewatch.llm.words import Tokens, ranges, slices, window_hashes

GRAM, WINDOW = 3, 3
#: Templates of fewer words are found by single words.
SHORT = 20
#: Least share of a template's words in an alignment that is reported.
COVERAGE = 0.8
#: A point of an alignment's score; what is below counts matches, so that of equal scores more matches win.
_ONE = 1 << 24
#: Most bytes of all templates.
TEMPLATE_BYTES = 8 << 20


def winnow(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Positions of the fingerprints among the grams of several texts (those of text ``d`` begin at ``first[d]``).

    Of each ``WINDOW`` grams the last of the least; texts of fewer grams keep all.
    """
    counts = np.diff(first)
    starts = ranges(first[:-1], np.maximum(counts - WINDOW + 1, 0))
    near = np.stack([grams[starts + k] for k in range(WINDOW)]) if len(starts) else np.zeros((WINDOW, 0), np.uint64)
    chosen = starts + (WINDOW - 1 - near[::-1].argmin(axis=0))
    few = np.flatnonzero(counts < WINDOW)
    return np.unique(np.concatenate([chosen, ranges(first[few], counts[few])]))


def _grams(tokens: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gram hashes of the texts of a slice, without those across texts; their word positions; and bounds by text."""
    grams = window_hashes(tokens.hashes, GRAM)
    counts = np.maximum(np.diff(tokens.first) - GRAM + 1, 0)
    at = ranges(tokens.first[:-1], counts)
    return grams[at], at, np.concatenate([[0], np.cumsum(counts)])


def _anchors(tokens: Tokens, coverage: float) -> np.ndarray:
    """One place more than an alignment of that coverage can miss; longer words are rarer."""
    size = len(tokens.hashes)
    missed = sum(k / size < coverage for k in range(size + 1))
    return np.argsort(tokens.starts - tokens.ends, kind="stable")[: size + 1 - missed]


@dataclass
class Index:
    names: list[str]
    words: list[np.ndarray]
    hashes: np.ndarray
    owners: np.ndarray
    places: np.ndarray

    @classmethod
    def of(cls, templates: Mapping[str, str], coverage: float = COVERAGE) -> Index:
        if sum(len(t.encode()) for t in templates.values()) > TEMPLATE_BYTES:
            raise ValueError(f"templates of more than {TEMPLATE_BYTES} bytes; scan for them in several calls")
        names = sorted(templates)
        words, hashes, owners, places = [], [], [], []
        for n, name in enumerate(names):
            raw = np.frombuffer(templates[name].encode(), np.uint8)
            tokens = Tokens(raw, np.array([0, len(raw)]))
            words.append(tokens.hashes)
            if len(tokens.hashes) < SHORT:
                grams, at = tokens.hashes, np.arange(len(tokens.hashes))
                chosen = _anchors(tokens, coverage)
            else:
                grams, at, first = _grams(tokens)
                chosen = winnow(grams, first)
            hashes.append(grams[chosen])
            places.append(at[chosen])
            owners.append(np.full(len(chosen), n))
        every = np.concatenate([*hashes, np.zeros(0, np.uint64)])
        order = np.argsort(every, kind="stable")
        return cls(names, words, every[order], np.concatenate([*owners, np.zeros(0, int)])[order].astype(int), np.concatenate([*places, np.zeros(0, int)])[order].astype(int))


def _equal(document: np.ndarray, template: np.ndarray, diagonal: int, band: int, free: np.ndarray | None) -> np.ndarray:
    """Whether each word of the template equals the document's on each diagonal of a band."""
    j = np.arange(len(template))[:, None] + diagonal + np.arange(-band, band + 1)
    inside, at = (j >= 0) & (j < len(document)), np.clip(j, 0, len(document) - 1)
    return inside & (document[at] == template[:, None]) & (True if free is None else free[at])


def align(document: np.ndarray, template: np.ndarray, diagonal: int, band: int, free: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Matching places ``(document, template)`` of the best local alignment within ``band`` of a diagonal.

    ``free`` marks the words of the document that may match.
    """
    m, width = len(template), 2 * band + 1
    offsets = np.arange(-band, band + 1)
    scores = np.zeros((m + 1, width + 1), np.int64)
    equal = _equal(document, template, diagonal, band, free)
    for i in range(m):
        j = i + diagonal + offsets
        inside = (j >= 0) & (j < len(document))
        step = scores[i, :width] + np.where(equal[i], 2 * _ONE + 1, -_ONE)
        row = np.maximum(np.maximum(step, scores[i, 1:] - _ONE), 0)
        row[~inside] = 0
        # Gaps along the row: the best of all places before, less their distance.
        row = np.maximum(row, np.maximum.accumulate(row + _ONE * offsets) - _ONE * offsets)
        scores[i + 1, :width] = row
    i, o = np.unravel_index(int(scores.argmax()), scores.shape)
    matches = []
    while i > 0 and scores[i, o] > 0:
        here = scores[i, o]
        if here == scores[i - 1, o] + (2 * _ONE + 1 if equal[i - 1, o] else -_ONE):
            if equal[i - 1, o]:
                matches.append((int(i - 1 + diagonal + offsets[o]), int(i - 1)))
            i -= 1
        elif o + 1 <= width and here == scores[i - 1, o + 1] - _ONE:
            i, o = i - 1, o + 1
        else:
            o -= 1
    return matches[::-1]


def _candidates(index: Index, hashes: np.ndarray, places: np.ndarray, texts: np.ndarray) -> list[tuple[int, int, int]]:
    """Text, template and middle diagonal of each band that has a hit.

    A band reaches from the middle of the one before to that of the next, so diagonals
    that are a band's half apart at most have a band in common.
    """
    left = np.searchsorted(index.hashes, hashes, "left")
    hit = np.flatnonzero((left < len(index.hashes)) & (index.hashes[np.minimum(left, max(len(index.hashes) - 1, 0))] == hashes)) if len(index.hashes) else np.zeros(0, int)
    if not len(hit):
        return []
    counts = np.searchsorted(index.hashes, hashes[hit], "right") - left[hit]
    entry = ranges(left[hit], counts)
    text, owner = np.repeat(texts[hit], counts), index.owners[entry]
    diagonal = np.repeat(places[hit], counts) - index.places[entry]
    band = np.array([_band(len(w)) for w in index.words])[owner]
    found = []
    for step in (-1, 0, 1):
        middle = (diagonal // band + step) * band
        near = np.abs(diagonal - middle) <= band
        found.append(np.stack([text[near], owner[near], middle[near]]))
    return [tuple(c) for c in np.unique(np.concatenate(found, axis=1), axis=1).T.tolist()]


def _band(words: int) -> int:
    return max(4, words // 8)


def _alignments(document: np.ndarray, template: np.ndarray, diagonal: int, coverage: float) -> Iterator[list[tuple[int, int]]]:
    """Alignments in a band that cover enough of the template, best first, with no word of the document in two."""
    band, free = _band(len(template)), np.ones(len(document), bool)
    # No alignment matches more words of the template than have an equal in the band.
    while _equal(document, template, diagonal, band, free).any(axis=1).mean() >= coverage:
        matches = align(document, template, diagonal, band, free)
        if not matches:
            return
        if len(matches) / len(template) >= coverage:
            yield matches
        free[[d for d, _ in matches]] = False


def _score(matches: list[tuple[int, int]]) -> int:
    """What ``align`` counts for an alignment."""
    return 2 * len(matches) - sum(max(d1 - d0, t1 - t0) - 1 for (d0, t0), (d1, t1) in zip(matches, matches[1:], strict=False))


Place = tuple[int, int, int, list[tuple[int, int]]]  # score, text, template and matches


def _apart(places: list[Place]) -> list[Place]:
    """Of overlapping places of one template in a text the best, since bands overlap."""
    kept: dict[tuple[int, int], list[Place]] = {}
    for place in sorted(places, key=lambda p: (-p[0], p[1], p[2], p[3][0], p[3][-1])):
        others = kept.setdefault((place[1], place[2]), [])
        if not any(_overlap(place, o) for o in others):
            others.append(place)
    return sorted((p for own in kept.values() for p in own), key=lambda p: (p[1], p[3][0], p[2]))


def _dominating(places: list[Place]) -> list[int | None]:
    """For each place the template of the best place it overlaps that scores higher and is not dominated itself."""
    winners: dict[int, list[Place]] = {}
    out: list[int | None] = [None] * len(places)
    for k in sorted(range(len(places)), key=lambda k: -places[k][0]):
        place = places[k]
        over = [w for w in winners.setdefault(place[1], []) if w[0] > place[0] and _overlap(w, place)]
        if over:
            out[k] = over[0][2]
        else:
            winners[place[1]].append(place)
    return out


def _overlap(one: Place, two: Place) -> bool:
    return one[3][0][0] <= two[3][-1][0] and two[3][0][0] <= one[3][-1][0]


def _scan(batches: Iterator[pa.RecordBatch], index: Index, coverage: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column("text")):
            tokens = Tokens(data, offsets)
            grams, at, first = _grams(tokens)
            chosen = winnow(grams, first)
            texts = np.searchsorted(tokens.first, at[chosen], "right") - 1
            rows, names, shares, begins, ends, counts, dominated = [], [], [], [], [], [], []
            places = []
            # Fingerprints and single words, with the text and the place in it of each.
            owners = np.repeat(np.arange(hi - lo), np.diff(tokens.first))
            hashes, spots = np.concatenate([grams[chosen], tokens.hashes]), np.concatenate([at[chosen], np.arange(len(owners))])
            texts = np.concatenate([texts, owners])
            for text, n, diagonal in _candidates(index, hashes, spots - tokens.first[texts], texts):
                words = tokens.hashes[tokens.first[text] : tokens.first[text + 1]]
                places += [(_score(m), text, n, m) for m in _alignments(words, index.words[n], diagonal, coverage)]
            places = _apart(places)
            for (_, text, n, matches), better in zip(places, _dominating(places), strict=True):
                own = int(tokens.first[text])
                raw = data[offsets[text] : offsets[text + 1]]
                begin = int(tokens.starts[own + matches[0][0]] - offsets[text])
                end = int(tokens.ends[own + matches[-1][0]] - offsets[text])
                points = (raw[:end] & 0xC0) != 0x80
                rows.append(text + lo)
                names.append(index.names[n])
                shares.append(len(matches) / len(index.words[n]))
                begins.append(int(points[:begin].sum()))
                ends.append(int(points.sum()))
                counts.append(len(matches))
                dominated.append(None if better is None else index.names[better])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows)), pa.array(names), pa.array(shares), pa.array(counts, pa.int64()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64()), pa.array(dominated, pa.string())],
                    names=["doc_id", "license", "coverage", "matched_words", "span_start", "span_end", "dominated_by"],
                )


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """One row per place of ``docs`` (``doc_id``, ``text``) that covers a template.

    Returns ``doc_id``, ``license`` (the template's name), ``coverage`` (share of its words
    that match, in order), ``matched_words``, ``span_start`` to ``span_end`` (code
    points, end exclusive), and ``dominated_by``: the template that fits better in an
    overlapping span. The licenses of a document are those of its rows where that is NULL.

    * Case of A-Z and punctuation do not count. A template of ``SHORT`` words and more is found where
      ``GRAM + WINDOW - 1`` words in a row agree.
    * Templates that hold one another are each reported, and all but the best aligned marked;
      equally good ones are not. Several places of one template give a row each.
    * Documents without a match, empty and NULL texts give no row; repeated rows give their
      rows each; ids may be NULL. Other columns are ignored. An empty table gives an empty result.
    """
    held = docs.sparkSession.sparkContext.broadcast(Index.of(templates, coverage))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, license string, coverage double, matched_words long, span_start long, span_end long, dominated_by string"
    return docs.select("doc_id", "text").mapInArrow(lambda batches: _scan(batches, held.value, coverage), schema)
