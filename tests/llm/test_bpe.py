import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gatewatch.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["é", "é", "İ", "Σ", "ß", "中", "文", "\U0001f600", " ", "​", "　", "ﬁ", "ͅ", "힣", "\x00", "\x0b", "\x1c", "\x85", "\xa0", "<|startoftext|>", "<|endoftext|>", "'s", "'LL"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_equals_the_library_on_random_strings(library):
    rng, own = random.Random(5), bpe.Codec(PATH)
    alphabet = [*"abcdefghijklmnopqrstuvwxyzABCDE '\"0123.,!-_<|>\t\n", *ODD]
    for _ in range(3_000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 40)))
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text).tolist() == ids, repr(text)
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False), repr(text)


def queued(merges, word):
    """Ids by the heap, which long words take."""
    return np.array(merges.queue([merges.vocabulary[s] for s in [*word[:-1], word[-1:] + merges.suffix] if s != merges.suffix]), np.int32).tobytes()


def test_scan_and_queue_agree(library):
    rng, own = random.Random(6), bpe.Codec(PATH).merges
    for size in [*range(60), 255, 200]:
        words = ["".join(rng.choices("abeorst", k=n)) for n in (size, 3, size // 2)]
        assert own.encode(words) == [queued(own, w) for w in words]


def test_long_words_and_forgotten_pieces(library, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PIECES", 3)
    own = bpe.Codec(PATH)
    for text in ("x" * 30_000, "the " * 9, " ".join(f"w{i}" for i in range(50)), "ab" * 500 + "<|endoftext|>" + "q" * 700):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_a_merged_token_may_rank_below_its_parts():
    own = bpe.Merges({"a": 0, "b": 1, "ab": 2, "aba": 3, "bab": 4, "abab": 5}, ["a b", "ab a", "b ab", "ab ab"])
    words = ["abab", "bab", "aba", "ababab", "bababab", "", "b"]
    assert own.encode(words) == [queued(own, w) for w in words]


def test_edges_round_trip(edges, library):
    coded = bpe.decode(bpe.encode(edges, PATH), PATH).collect()
    texts = [r["text"] or "" for r in edges.collect()]
    want = []
    for row in edges.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        want.append((str(row["doc_id"]), tuple(ids), library.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r["doc_id"]), tuple(r["ids"]), r["decoded"]) for r in coded) == sorted(want)
    assert len(coded) == len(texts)


def test_nothing(nothing):
    assert bpe.decode(bpe.encode(nothing, PATH), PATH).collect() == []


def test_query_over_the_whole_table(spark, library):
    from gatewatch.llm.queries import op13_bpe

    sf_dir = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), _sha(" ".join(map(str, ids))), _sha(decoded)))
    assert sorted(map(tuple, op13_bpe(spark, sf_dir).collect())) == sorted(want)


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="not supported"):
        bpe.Codec(public_tokenizers.path("byte_bpe_50k.json"))
