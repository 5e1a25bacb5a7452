import hashlib
import re

import pytest

from gatewatch.llm import pii

from .conftest import prose

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c.c.c@d.e x@y..z q@w.e- and a@b.c_d@e.f",
    "1 a_b.c_d@e.f@g.h.i ü@é.com x@a.b é+49 123 456 7890",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111111111111111",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.4 1.2.3 9999999999999.1.1.1",
    "+1 (555) 000-1234. +12 x +1234567 ++12345678901234567890 +1 5",
    "\U0001f600 x.y@z.example.com,  12 4111 1111 1111 1111",
    "1 2 3 " * 3000, "12" * 3000 + " 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 ", "a@b." + ".c" * 3000 + "@x." + "d." * 3000, "@" * 50 + "." * 50,
]


def fits(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        doubled = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return {k: [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if fits(k, m.group())] for k, p in PATTERNS.items()}


def found(docs):
    return {r.doc_id: r for r in pii.digest(pii.detect(docs)).collect()}


def test_base_spans_against_plain_patterns(table):
    got = found(table(list(enumerate(TEXTS))))
    for n, text in enumerate(TEXTS):
        spans = base(text)
        listed = ",".join(s for k in PATTERNS for s in spans[k])
        assert got[n].spans == listed, text[:80]
        assert [got[n][f"n_{k}"] for k in PATTERNS] == [len(s) for s in spans.values()]
        assert got[n].base_sha256 == hashlib.sha256(listed.encode()).hexdigest()


@pytest.fixture
def corpus(table):
    """A code word near one address in five texts, and in a sixth without it; common words everywhere."""
    rows = [(n, f"{prose(n, 30)} the zorblat of bob@corp.example.com {prose(n + 50, 20)}") for n in range(5)]
    rows += [(10, f"{prose(90, 30)} a Zorblat alone {prose(91, 10)}")]
    rows += [(20 + n, f"the {prose(n + 100, 40)} the") for n in range(60)]
    rows += [(100 + n, rows[0][1]) for n in range(30)]
    return table(rows)


def test_revealing_terms_are_spans_everywhere(corpus):
    got = {r.doc_id: r for r in pii.detect(corpus).collect()}
    texts = {r.doc_id: r.text for r in corpus.collect()}
    for n, row in got.items():
        words = [texts[n][t.start : t.end].lower() for t in row.terms]
        assert words == (["zorblat"] if n < 20 or n >= 100 else [])


def test_an_entity_in_one_text_and_in_two(table):
    """The words that stand only with them are revealing; a word that is mostly elsewhere is not."""
    rows = [(1, "the zorblat and often of ann@one.example the")]
    rows += [(n, f"the quibber {n} and often of bob@two.example the") for n in (2, 3)]
    rows += [(4, "that quibbers had the zorblat"), *((10 + n, f"the {prose(n, 20)} and often {n}") for n in range(60))]
    got = {r.doc_id: r for r in pii.detect(table(rows)).collect()}
    words = {n: [(text[t.start : t.end], t.action) for t in got[n].terms] for n, text in rows}
    assert words[1] == words[4] == []
    assert words[2] == words[3] == [("quibber", "generalise")]
    got = {r.doc_id: r for r in pii.detect(table([r for r in rows if r[0] != 4])).collect()}
    assert [(rows[0][1][t.start : t.end], t.action) for t in got[1].terms] == [("zorblat", "generalise")]
    texts = {r.doc_id: r.text for r in pii.sanitise(table([r for r in rows if r[0] != 4])).collect()}
    assert texts[1] == "the [TERM] and often of [EMAIL] the"


def test_a_chance_meeting_flags_no_other_text(table):
    """Rare words that once stood near an address stay in the texts that have nothing to do with it, at every size."""
    for others in (50, 400):
        rows = [(n, f"rare{chr(97 + n)}word beside u{n}@one.example {prose(n, 12)}") for n in range(6)]
        rows += [(100 + n, f"{prose(n + 300, 20)} rare{chr(97 + n % 6)}word {prose(n + 900, 10)}") for n in range(12)]
        rows += [(1000 + n, f"{prose(n + 2000, 40)} beside") for n in range(others)]
        got = pii.detect(table(rows)).collect()
        assert [r.doc_id for r in got if r.doc_id >= 100 and r.terms] == []


def test_a_broadcast_is_measured(table):
    from pyspark.sql import functions as F

    from gatewatch.llm.common import cut, small_side

    rows = cut(table([(1, "x" * 5000), (2, None)]))
    for limit, hinted in ((4999, False), (6000, True)):
        plan = small_side(rows, F.octet_length("text"), limit)._jdf.queryExecution().logical().toString()
        assert ("broadcast" in plan.lower()) is hinted


def test_confidence_grows_with_the_texts(spark):
    rows = spark.createDataFrame([(1, 1), (2, 2), (8, 8), (1, 2), (1, 10), (0, 3)], "hits long, of long")
    got = [round(r[0], 3) for r in rows.select(pii._lower_end(rows.hits, rows.of)).collect()]
    assert got == [0.27, 0.425, 0.747, 0.121, 0.023, 0.0]


def test_sanitised_texts(corpus):
    texts = {r.doc_id: r.text for r in pii.sanitise(corpus).collect()}
    assert "bob" not in texts[3] and "[EMAIL]" in texts[3] and "orblat" not in texts[3].lower() and "orblat" not in texts[10].lower()
    assert len(texts) == corpus.count() and all("[" not in t for n, t in texts.items() if 20 <= n < 100)


def test_overlapping_spans_go_together(table):
    (row,) = pii.sanitise(table([(1, "call +4222222222222 or x")])).collect()
    assert row.text == "call [PHONE] or x"


def test_edge_cases(edges, nothing):
    rows = pii.digest(pii.detect(edges)).collect()
    assert len(rows) == edges.count() and all(r.spans == "" for r in rows)
    assert pii.digest(pii.detect(nothing)).count() == 0 and pii.sanitise(nothing).count() == 0


def test_no_python_in_the_plan(table):
    plan = pii.digest(pii.detect(table([(1, TEXTS[0])])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
