import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from gatewatch.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def brute(rows):
    """Expected digest rows of (doc_id, text), by sets and dictionaries."""
    one, two = alignment.sides(A, B)
    library = Tokenizer.from_file(A)
    library.encode_special_tokens = True
    out, holders = [], defaultdict(set)
    for number, (doc_id, text) in enumerate(rows):
        text, spelled, groups = text or "", b"", []
        if text:
            spelled = (" " + text).encode()
            (a,), (b,) = one.encode([text]), two.encode([text])
            a, b = a.tolist(), b.tolist()
            assert a == library.encode(" " + text, add_special_tokens=False).ids
            if b"".join(one.tokens[i] for i in a) == spelled == b"".join(two.tokens[i] for i in b):
                ends = [np.cumsum([len(s.tokens[i]) for i in ids]).tolist() for s, ids in ((one, a), (two, b))]
                places = [{end: n + 1 for n, end in enumerate(e)} for e in ends]
                at = [0, 0]
                for end in sorted(set(ends[0]) & set(ends[1])):
                    to = [p[end] for p in places]
                    groups.append((a[at[0] : to[0]], b[at[1] : to[1]]))
                    at = to
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        for pair in links:
            holders[pair].add(number)
        out.append((doc_id, groups, links))
    counts = {pair: len(held) for pair, held in holders.items()}
    most = defaultdict(int)
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    rows = []
    for doc_id, groups, links in out:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        rows.append(
            (doc_id, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), sum(links.values()),
             sum(n for p, n in links.items() if counts[p] == most[p[0]]), sum(n * counts[p] for p, n in links.items()),
             hashlib.sha256(text.encode()).hexdigest() if text else "")
        )
    return sorted(rows, key=str)


def digest(df):
    return sorted(map(tuple, alignment.digest(df, A, B).collect()), key=str)


def test_shared_cuts_against_sets():
    rng = np.random.default_rng(3)
    for _ in range(400):
        ends = [[], []]
        last, base = [], 0
        for _ in range(rng.integers(0, 5)):
            size = int(rng.integers(1, 200))
            for side in ends:
                some = rng.choice(np.arange(1, size + 1), int(rng.integers(0, size + 1) * rng.choice([0.05, 0.3, 1])), replace=False)
                side.extend(base + np.union1d(some, [size]))
            last.append(len(ends[0]) - 1)
            base += size
        a, b = (np.array(e, np.int64) for e in ends)
        got = alignment.shared_cuts(a, b, np.array(last, np.int64))
        assert got.tolist() == np.flatnonzero(np.isin(a, b)).tolist()


def test_an_interval_without_cuts_is_one_group():
    a, b = np.append(np.arange(1, 100_000, 2), 100_001), np.append(np.arange(2, 100_000, 2), 100_001)
    assert alignment.shared_cuts(a, b, np.array([len(a) - 1])).tolist() == [len(a) - 1]


def test_edges(edges):
    assert digest(edges) == brute([(r["doc_id"], r["text"]) for r in edges.collect()])


def test_odd_texts(table):
    rng = random.Random(4)
    odd = ["a  b", " lead", "trail ", "\t\ttab\n\n", "<s> </s> <unk> <|endoftext|>", "\x00", "ﬁ é é", "中文字\U0001f600", "a　b", "▁x", "12345678", "-" * 300, " " * 50]
    odd += ["".join(rng.choices("ab 1é中\n\U0001f600-", k=rng.randint(1, 60))) for _ in range(80)]
    rows = list(enumerate([*odd, *odd[:20]]))
    got = digest(table(rows))
    assert got == brute(rows)
    assert any(r[5] < r[4] for r in got)


def test_pairs_joined_by_shuffle_give_the_same(table, monkeypatch):
    rows = [(i, f"some words {i % 7} and été numbers {i}") for i in range(60)]
    want = brute(rows)
    monkeypatch.setattr(alignment, "PAIR_BYTES", 1 << 40)
    assert digest(table(rows)) == want


def test_groups_spell_the_text(table):
    rows = [(1, "The quick brown fox, naïvely: 2024"), (2, "über-größe")]
    one, two = alignment.sides(A, B)
    for r in alignment.align(table(rows), A, B).collect():
        text, from_a, from_b = b"", 0, 0
        for end_a, end_b in zip(r["ends_a"], r["ends_b"], strict=True):
            spelled = [b"".join(s.tokens[i] for i in ids) for s, ids in ((one, r["a"][from_a:end_a]), (two, r["b"][from_b:end_b]))]
            assert spelled[0] == spelled[1]
            text, from_a, from_b = text + spelled[0], end_a, end_b
        assert text == (" " + dict(rows)[r["doc_id"]]).encode()


def test_nothing(nothing):
    assert digest(nothing) == []


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_query_over_the_whole_table(spark, sf_dir):
    from gatewatch.llm.queries import op11_alignment

    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op11_alignment(spark, sf_dir).collect()), key=str) == brute(rows)


def odd_texts(count):
    rng = random.Random(5)
    return [" ", "  ", "\n", "end ", "end  ", "end\n", "end \n", "end\n  ", "a \n b", "a\n b", "a   b", " a", "  a", "\na\n\n\nb", "x \xa0 y", "x\x1c y", ""] + [
        "".join(rng.choices(["word", "Été", "it's", "12", "中", ".", ",", " ", " ", " ", "\n", "\t", "\r", "\xa0", "\x85", "\x1d"], [9, 3, 3, 3, 0.3, 3, 3, 9, 9, 9, 3, 1, 2, 1, 1, 1], k=rng.randint(1, 25)))
        for _ in range(count)
    ]


def test_words_of_a_text_are_the_text():
    for text in odd_texts(3000):
        words = alignment.words_of(text)
        assert " ".join(words) == text
        assert words == alignment._WORD.findall(f" {text}")


@pytest.mark.parametrize("told_apart", [True, False])
def test_ids_by_words_are_those_of_whole_texts(told_apart, monkeypatch):
    one, two = alignment.sides(A, B)
    assert one.library.can_cut and two.library.can_cut
    if not told_apart:
        monkeypatch.setattr(alignment.Side, "encode_words", lambda self, words, sizes: None)
    texts, nothing = odd_texts(1500), np.zeros(0, np.int32)
    pairs = [(one.encode([t])[0], two.encode([t])[0]) if t else (nothing, nothing) for t in texts]
    pairs = [(a, b) if one.covers(a, f" {t}".encode()) and two.covers(b, f" {t}".encode()) else (nothing, nothing) for t, (a, b) in zip(texts, pairs, strict=True)]
    own = alignment.Both(one, two)
    for _ in range(2):  # words new, then known
        for at in range(0, len(texts), 500):
            got, want = own.encode(texts[at : at + 500]), pairs[at : at + 500]
            assert [x.tolist() for x in got] == [x.tolist() for side in zip(*want, strict=True) for x in alignment._flat(list(side))]


def test_words_met_before_are_not_encoded_again(monkeypatch):
    given = []
    for kind in (alignment.ByteSide, alignment.PieceSide):
        monkeypatch.setattr(kind, "encode", lambda self, texts, f=kind.encode: given.extend(texts) or f(self, texts))
    rng = random.Random(6)
    texts = [" ".join(rng.choices([f"met{i}before," for i in range(50)], k=40)) for _ in range(100)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(100)), "text": texts})
    ((_, own),) = alignment._each_slice(iter([batch]), A, B)
    assert own.groups.min() >= 40
    assert sum(map(len, given)) < sum(map(len, texts)) / 10
