"""Phrase search against all phrases counted one by one."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridcast.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest, limit):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = tuple(re.findall("[^\x20\x09]+", piece))
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(w[i:i + k] for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n, found = totals[lang], []
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = {p[i:i + k] for p, a in cands.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if a >= f[p[i:i + k]]}
        for p, a in cands.items():
            if p not in covered:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n, -s))
    return sorted(out)


def corpus(seed=1):
    r = random.Random(seed)
    stock = ["w%d" % i for i in range(40)] + ["Élan", "É", "naïve", "x" * 300, "\U0001f600"]
    fixed = [" ".join(r.choice(stock) for _ in range(r.randrange(2, 9))) for _ in range(12)]
    rows = []
    for d in range(150):
        parts = []
        for _ in range(r.randrange(0, 25)):
            parts.append(r.choice(fixed) if r.random() < 0.4 else r.choice(stock[:int(1 + 44 * r.random() ** 2)]))
            parts.append(r.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " : "]))
        rows.append(("".join(parts), r.choice(["a", "a", "a", "b", None, "und", ""])))
    return rows + [(None, "a"), ("", "b"), (" \n.", "b"), ("w1 " * 4000, "a"), ("lone", "c"), ("same same " * 30, "d"), ("tie one, tie two, " * 20, "e")]


def got(spark, rows, **options):
    docs = spark.createDataFrame([(t, x, 1, "p", "q") for t, x in rows], "text string, lang string, p int, name string, f string")
    return sorted(tuple(r) for r in C.collocations(docs, **options).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("least,longest,limit", [(5, 5, 2000), (3, 5, 10), (8, 3, 4)])
def test_against_all_phrases(spark, least, longest, limit):
    rows = corpus(least)
    expected = brute(rows, least, longest, limit)
    assert len(expected) > 10
    assert got(spark, rows, least=least, longest=longest, limit=limit) == expected


def test_settled_early_and_in_small_groups(spark, monkeypatch):
    """Few places, many layers: later layers are not grown, ties at the last place included."""
    rows = corpus(7)
    monkeypatch.setattr(C, "LAYERS", (0.1, 0.2, 0.3, 0.5, 0.7))
    monkeypatch.setattr(C, "GROUP", 500)
    grown = []
    monkeypatch.setattr(C.Search, "grow", lambda self, active, old=C.Search.grow: grown.append(active.count()) or old(self, active))
    assert got(spark, rows, least=3, limit=3) == brute(rows, 3, 5, 3)
    assert sum(grown) < len({w for t, _ in rows for w in (t or "").split()})


def test_words_that_share_a_name(spark, monkeypatch):
    """With names cut to a few bits many words clash; they go by digests, and the result is the same."""
    rows = [(t, "a") for t, _ in corpus(3)]
    expected = brute(rows, 4, 5, 2000)
    docs = spark.createDataFrame(rows, "text string, lang string")
    words, shared = C._vocabulary(docs, 4, [])
    assert shared == []
    some = [int(np.int64(r.name).view(np.uint64)) for r in words.limit(9).collect()]
    monkeypatch.setattr(C, "_vocabulary", lambda d, least, s, old=C._vocabulary: old(d, least, some))
    assert got(spark, rows, least=4) == expected


def test_clash_is_found(spark, monkeypatch):
    t = C.Texts(["ab cd ab".encode()], ["x"], np.array([], np.uint64))
    assert len(set(t.names.tolist())) == 2 and t.checks()[0] == t.checks()[2] != t.checks()[1]
    other = C.Texts(["AB".encode()], ["y"], np.array([], np.uint64))
    assert other.names[0] != t.names[0] and other.checks()[0] != t.checks()[0]


def test_false_hits_cost_nothing_but_time(spark, monkeypatch):
    rows = corpus(9)
    monkeypatch.setattr(C.Bitmap, "has", lambda self, hashes: np.ones(len(hashes), bool))
    assert got(spark, rows, least=5, limit=20) == brute(rows, 5, 5, 20)


def test_empty_table(spark, make):
    assert C.report(make([])).collect() == [] and C.report(make([None, ""])).collect() == []
