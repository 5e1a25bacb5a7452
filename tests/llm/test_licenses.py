import itertools
import random
import re

import numpy as np
import pytest

from gatewatch.llm.license_templates import TEMPLATES
from gatewatch.llm.licenses import Index, align, scan_licenses, winnow
from gatewatch.llm.words import mix

from .conftest import prose


def found(docs, **options):
    return {(r.doc_id, r.license): r for r in scan_licenses(docs, **options).collect()}


def test_each_template_is_found_where_it_stands(table):
    names = sorted(TEMPLATES)
    texts = {n: prose(n, 100) + " é " + TEMPLATES[name] + " " + prose(n + 500, 50) for n, name in enumerate(names)}
    got = found(table(list(texts.items())))
    for n, name in enumerate(names):
        hit = got[n, name]
        span = texts[n][hit.span_start : hit.span_end]
        assert hit.coverage == 1 and TEMPLATES[name].startswith(span) and len(TEMPLATES[name]) - len(span) <= 2


def test_changed_notices(table):
    rng = random.Random(4)
    words = TEMPLATES["MIT"].split()
    some = " ".join("changed" if rng.random() < 0.08 else w for w in words)
    gaps = " ".join(w for k, w in enumerate(words) if k % 12)
    half = " ".join(words[: len(words) // 2])
    got = found(table([(1, prose(1, 300) + "\n" + some.upper()), (2, gaps), (3, half), (4, prose(4, 2000))]))
    assert set(got) == {(1, "MIT"), (2, "MIT")} and 0.85 < got[1, "MIT"].coverage < 1


def test_changed_words_of_short_notices(table):
    """Any words within the coverage changed, or a word put between all of them."""
    rows, short = [], [n for n, t in TEMPLATES.items() if len(t.split()) < 15]
    for name in short:
        words = re.findall("[A-Za-z0-9]+", TEMPLATES[name])
        for places in itertools.combinations(range(len(words)), len(words) // 5):
            rows.append((name, " ".join(f"changed{k}" if k in places else w for k, w in enumerate(words))))
        rows.append((name, " ".join(f"{w} extra{k}" if k % 2 else w for k, w in enumerate(words))))
    got = found(table([(n, f"{prose(n, 30)} {text} {prose(n + 5000, 30)}") for n, (_, text) in enumerate(rows)]))
    assert len(short) > 9 and [text for n, (name, text) in enumerate(rows) if (n, name) not in got] == []


def test_near_templates_are_told_apart(table):
    families = (["GPL-2.0-line", "GPL-3.0-line"], ["CC-BY-4.0-line", "CC-BY-NC-4.0-line", "CC-BY-SA-4.0-line"], ["CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0"])
    names = [n for family in families for n in family] + ["Apache-2.0", "GPL-3.0-or-later"]
    rows = scan_licenses(table([(n, f"{prose(n, 40)} {TEMPLATES[name]} {prose(n + 90, 40)}") for n, name in enumerate(names)])).collect()
    assert sorted((r.doc_id, r.license) for r in rows if r.dominated_by is None) == list(enumerate(names))
    marked = {(names[r.doc_id], r.license) for r in rows if r.dominated_by == names[r.doc_id]}
    assert {("GPL-3.0-line", "GPL-2.0-line"), ("CC-BY-NC-4.0-line", "CC-BY-4.0-line"), ("CC-BY-SA-4.0", "CC-BY-4.0"), ("Apache-2.0", "Apache-2.0-line")} <= marked


def test_several_places(table):
    line = TEMPLATES["MIT-line"]
    rows = scan_licenses(table([(7, f"{line}\n{prose(3, 80)}\n{line}")])).collect()
    assert sorted(r.span_start for r in rows if r.license == "MIT-line") == [0, len(line) + len(prose(3, 80)) + 2]


def test_a_notice_inside_repeated_phrases(table):
    notice = TEMPLATES["GPL-3.0-or-later"]
    before, behind = ("\n".join(f"the gnu general public license {prose(k + 1000 * n, 1)}" for k in range(200)) for n in (1, 2))
    text = f"{before}\n{notice}\n{behind}"
    hit = found(table([(1, text)]))[1, "GPL-3.0-or-later"]
    assert hit.coverage == 1 and abs(hit.span_start - len(before) - 1) < 2 and abs(hit.span_end - len(before) - len(notice)) < 2


def test_places_side_by_side(table):
    for name in ("MIT-line", "GPL-3.0-line", "ISC"):
        rows = scan_licenses(table([(1, " ".join([TEMPLATES[name]] * 7))])).collect()
        assert sorted(r.span_start for r in rows if r.license == name) == [k * (len(TEMPLATES[name]) + 1) for k in range(7)]


def test_shared_runs_share_a_fingerprint():
    rng = np.random.default_rng(6)
    for _ in range(200):
        run = rng.integers(0, 50, 3, dtype=np.uint64)
        one, two = (mix(np.concatenate([rng.integers(0, 50, rng.integers(0, 6), dtype=np.uint64), run, rng.integers(0, 50, rng.integers(0, 6), dtype=np.uint64)])) for _ in range(2))
        picked = [set(x[winnow(x, np.array([0, len(x)]))].tolist()) for x in (one, two)]
        assert picked[0] & picked[1] & set(mix(run).tolist())


def full(document, template):
    """Local alignment score without a band."""
    s = np.zeros((len(template) + 1, len(document) + 1), int)
    for i, t in enumerate(template):
        for j, d in enumerate(document):
            s[i + 1, j + 1] = max(0, s[i, j] + (2 if t == d else -1), s[i, j + 1] - 1, s[i + 1, j] - 1)
    return s.max()


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(9)
    for _ in range(60):
        template = rng.integers(0, 4, rng.integers(1, 12))
        document = rng.integers(0, 4, rng.integers(1, 15))
        matches = align(document, template, 0, 30)
        gaps = 0
        for (d0, t0), (d1, t1) in zip(matches, matches[1:], strict=False):
            assert d1 > d0 and t1 > t0
            gaps += max(d1 - d0, t1 - t0) - 1
        assert all(document[d] == template[t] for d, t in matches)
        assert 2 * len(matches) - gaps == full(document, template)


def test_edge_cases(edges, nothing, table):
    assert found(edges) == {} and found(nothing) == {}
    assert found(table([(1, TEMPLATES["MIT"])]), templates={}) == {}
    line = TEMPLATES["MIT-line"]
    rows = scan_licenses(table([(None, line), (None, line)])).collect()
    assert len(rows) == 2 and all(r.doc_id is None and r.license == "MIT-line" for r in rows)
    with pytest.raises(ValueError):
        Index.of({"large": "x" * (9 << 20)})
