import re
from collections import Counter

import numpy as np
import pytest

from conftest import words
from gridcast.llm import paragraphs as pg
from gridcast.llm.common import table

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def case(make, odd):
    passage, line = words(5, 60), words(6, 90)
    near = list(line)
    near[40] = "changed"
    texts = {
        10: " ".join(words(11, 80) + passage + words(12, 80)), 11: " ".join(words(13, 30) + passage + words(14, 5)),
        12: "\n".join([" ".join(words(15, 50)), " ".join(line), " ".join(words(16, 50))]),
        13: "\n".join([" ".join(near), " ".join(words(17, 50))]),
        14: " ".join(words(18, 300)), 15: " ".join(words(19, 40) + passage[:12] + words(20, 40)),
        16: " ".join(words(21, 60) * 3), 17: None, 18: "", 19: "short", 20: " ".join(words(22, 30_000)),
        21: "\n".join(" ".join(words(23, 8)) for _ in range(5))}
    docs = make(list(texts.values()) + [texts[14], " ".join(passage)], list(texts) + [14, None])
    return texts, docs


def test_repeats_are_found_and_clean_texts_left_alone(case):
    texts, docs = case
    rows = {r.doc_id: r for r in pg.report(docs).collect()}
    assert set(rows) == {10, 11, 12, 13}
    assert [(rows[i].first_doc, rows[i].n_removed > 0) for i in (10, 11, 12, 13)] == [(10, False), (10, True), (12, False), (12, True)]
    (span,) = rows[11].removed
    assert 30 <= span.start and span.end <= 90 and span.end - span.start >= pg.RUN
    assert [(s.start, s.end) for s in rows[13].removed] == [(0, 90)]


def test_removal_cuts_only_later_occurrences(case):
    texts, docs = case
    left = pg.remove_repeats(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    kept = {r.doc_id: r.text for r in left.where("doc_id is not null").collect()}
    for i, t in texts.items():
        assert kept[i] == t or i in (11, 13)
    assert kept[13].strip() == texts[13].split("\n")[1]
    assert len(kept[11].split()) <= 95 - pg.RUN


def test_whole_passages_go_at_every_place(make):
    passage, shared = words(31, 60), words(32, 300)
    texts = {1: words(33, 90) + passage + words(34, 70), 2: passage + words(35, 80) + passage + words(36, 40) + passage,
             3: words(37, 20) + passage[:55] + words(38, 30), 4: words(39, 500) + shared, 5: shared + words(40, 400)}
    docs = make([" ".join(t) for t in texts.values()], list(texts))
    got = {r.doc_id: ([tuple(x) for x in r.repeated], [tuple(x) for x in r.removed]) for r in pg.report(docs).collect()}
    places = [(0, 60), (140, 200), (240, 300)]
    assert got == {1: ([(90, 150)], []), 2: (places, places), 3: ([(20, 75)], [(20, 75)]), 4: ([(500, 800)], []), 5: ([(0, 300)], [(0, 300)])}
    left = {r.doc_id: r.text.split() for r in pg.remove_repeats(docs).collect()}
    assert left[2] == texts[2][60:140] + texts[2][200:240] and left[1] == texts[1]


def test_every_link_of_a_document_is_listed(make):
    a, b = words(41, 30), words(42, 40)
    lines = {10: [a, words(43, 25)], 40: [words(44, 25), b], 50: [b, words(45, 25), a]}
    docs = make(["\n".join(" ".join(x) for x in t) for t in lines.values()], list(lines))
    got = {r.doc_id: (r.n_links, {tuple(u) for u in r.units}) for r in pg.report(docs).collect()}
    assert got == {10: (0, {(0, 30, 10, 0, True)}), 40: (0, {(25, 65, 40, 25, True)}),
                   50: (2, {(0, 40, 40, 25, False), (65, 95, 10, 0, False)})}


def test_short_lines_repeat_word_for_word(make):
    line, other = words(51, 9), words(52, 5)
    lines = {1: [words(53, 8), line, words(54, 50)], 2: [line, words(55, 60)], 3: [words(56, 4), other, line[:8]],
             4: [words(57, 40), other, words(56, 4)]}
    docs = make(["\n".join(" ".join(x) for x in t) for t in lines.values()], list(lines))
    got = {r.doc_id: [tuple(u) for u in r.units] for r in pg.report(docs).collect()}
    assert got == {1: [(8, 17, 1, 8, True)], 2: [(0, 9, 1, 8, False)], 3: [(4, 9, 3, 4, True)], 4: [(40, 45, 3, 4, False)]}
    assert .25 ** pg.LEAST <= pg.RECALL_MISS == 1e-6


def test_any_shared_stretch_leaves_a_common_pick():
    r = np.random.default_rng(4)
    for _ in range(200):
        shared = r.integers(0, 1 << 60, pg.WINDOW).astype(np.uint64)
        a, b = (np.concatenate([r.integers(0, 1 << 60, r.integers(0, 70)).astype(np.uint64), shared,
                                r.integers(0, 1 << 60, r.integers(0, 70)).astype(np.uint64)]) for _ in range(2))
        assert set(a[pg.picked(a)].tolist()) & set(b[pg.picked(b)].tolist())


def test_empty_table(make):
    assert pg.report(make([])).collect() == []


def test_recall_of_paragraph_pairs_against_all_pairs(spark):
    """Every pair of lines of 20 words or more, of different documents of the given table, with a Jaccard
    similarity of 0.75 or more must be in one group."""
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    lines = []
    for r in docs.collect():
        at = 0
        for line in (r.text or "").split("\n"):
            w = [x.translate(LOWER) for x in re.findall(r"[^ \t-\r]+", line)]
            if len(w) >= pg.MIN_WORDS:
                lines.append((r.doc_id, at, frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4))))
            at += len(w)
    by = {}
    for n, (_, _, s) in enumerate(lines):
        for x in s:
            by.setdefault(x, []).append(n)
    shared = Counter()
    for ns in by.values():
        for i, a in enumerate(ns):
            for b in ns[i + 1:]:
                shared[a, b] += 1
    pairs = [(a, b) for (a, b), n in shared.items() if lines[a][0] != lines[b][0]
             and 100 * n >= 75 * (len(lines[a][2]) + len(lines[b][2]) - n)]
    unlike = [(a, b) for a, b in pairs if lines[a][2] != lines[b][2]]
    group = {(r.doc, r.start): (r.first_doc, r.first_start) for r in pg.repeats(docs).where(f"kind = {pg.PARAGRAPH}").collect()}
    found = lambda some: sum(lines[a][:2] in group and group[lines[a][:2]] == group.get(lines[b][:2]) for a, b in some)
    assert len(unlike) > 20 and found(pairs) >= 0.99 * len(pairs) and found(unlike) >= 0.9 * len(unlike)
    linked = {lines[n][:2] for p in pairs for n in p}
    assert set(group) <= linked  # and nothing else is called a repeat


def test_one_line_in_very_many_documents(spark, make):
    """A line and a passage that all documents share, and an id on many rows."""
    line, passage = words(61, 7), words(62, 60)
    texts = ["\n".join([" ".join(line), " ".join(words(1000 + i, 15) + passage + words(3000 + i, 10))]) for i in range(700)]
    ids = [5 if i % 3 == 0 else i for i in range(700)]
    rows = {r.doc_id: r for r in pg.report(make(texts, ids)).collect()}
    assert set(rows) == set(ids)
    assert all([tuple(x) for x in rows[i].removed] == [(0, 7), (22, 82)] for i in rows if i not in (1, 5))
