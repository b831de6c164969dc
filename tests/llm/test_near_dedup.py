import re
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import words
from gridcast.llm import minhash, near_dedup
from gridcast.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(texts, ids):
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i in range(len(texts)):
        if ids[i] is not None:
            least[find(i)] = min(ids[i], least.get(find(i), ids[i]))
    return [(len(s), ids[i] if not s else least.get(find(i))) for i, s in enumerate(sets)]


def edited(base, r, n):
    out = list(base)
    for _ in range(n):
        out[r.integers(len(out))] = f"w{r.integers(10 ** 9)}"
    return " ".join(out)


@pytest.fixture(scope="module")
def case(make, odd):
    r, texts = np.random.default_rng(1), list(odd)
    for seed, edits in ((50, 2), (51, 4), (52, 6)):  # chains of copies around the threshold
        base = words(seed, 130)
        texts += [edited(base, r, edits) for _ in range(40)]
    texts += [" ".join(words(70, 60)[:30] + words(200 + i, 25)) for i in range(40)]  # half in common: no links
    texts += ["a b c d", "a b c d e", "A B\tC d"]
    ids = [None if i in (4, 20) else 1000 - i for i in range(len(texts))]
    return texts, ids, make(texts, ids)


def test_components_like_brute_force(case):
    texts, ids, docs = case
    got = sorted((str(r.key), r.n, str(r.component)) for r in near_dedup.classify(docs).collect())
    want = brute(texts, ids)
    assert got == sorted((str(i), n, str(c)) for i, (n, c) in zip(ids, want))


def test_one_of_each_group_stays(case):
    texts, ids, docs = case
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = [i for i, (_, c) in zip(ids, brute(texts, ids)) if i == c]
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == sorted(map(str, want))


def test_rows_without_or_with_a_repeated_id_are_judged_one_by_one(make):
    a, b, c, d, e = (" ".join(words(80 + i, 90)) for i in range(5))
    rows = [(1, a), (None, a + " end"), (None, b), (None, c), (None, c), (5, a), (5, d), (6, e), (6, e), (6, e + " end"), (None, ""), (None, "")]
    docs = make([t for _, t in rows], [i for i, _ in rows])
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    left = sorted((str(r.doc_id), r.text) for r in kept.collect())
    assert [x for x in left if x[0] != "6"] == sorted([("1", a), ("None", b), ("None", c), ("5", d), ("None", ""), ("None", "")])
    assert [x for x in left if x[0] == "6"] in ([("6", e)], [("6", e + " end")])
    assert sorted(r.kept for r in near_dedup.report(docs).collect()) == [False] * 5 + [True] * 7


def test_nothing_linked_and_empty(make):
    assert [r.kept for r in near_dedup.report(make(["a b c", "d e f"])).collect()] == [True, True]
    assert near_dedup.report(make([])).collect() == []


def test_least_matches_follow_the_posterior():
    for k, m in minhash.least_matches(0.75, 1e-4, 128):
        tail = [sum(comb(k + 1, i) * .75 ** i * .25 ** (k + 1 - i) for i in range(x + 1)) for x in (m - 1, m)]
        assert tail[0] < 1e-4 <= tail[1]
    assert (1 - .75 ** 4) ** minhash.tune_bands(.75, 1e-6) <= 1e-6


def test_long_chain_of_links(spark):
    chain = spark.range(60).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("a"),
                                   F.lpad((F.col("id") + 1).cast("string"), 3, "0").alias("b"))
    more = spark.createDataFrame([("x1", "x2"), ("x2", "x2"), ("x3", "x1")], "a string, b string")
    got = {r.node: r.root for r in components(chain.unionByName(more)).collect()}
    assert {v for k, v in got.items() if k[0] != "x"} == {"000"} and {got[k] for k in ("x1", "x2", "x3")} == {"x1"}
