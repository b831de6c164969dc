import functools
import math
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridcast.llm import ctw

TEXTS = ["the cat sat on the mat", "The dog  sat", "", None, "the cat ate the rat\nand the dog", "a b a b a b a b",
         "unseen zebra é", "x" * 3000]
HELD = {1, 5, 6}


def steps(text, depth):
    s = b"\n" * depth + " ".join((text or "").lower().split()).encode() + b"\n"
    for p in range(depth, len(s)):
        node = 1
        for k in range(8):
            bit = s[p] >> 7 - k & 1
            yield s[p - depth:p], node, bit
            node = 2 * node + bit


def brute(depth):
    """Log10 of the probability of each text, by the recursion over context trees itself."""
    count, children = defaultdict(lambda: [0, 0]), defaultdict(set)
    for i, t in enumerate(TEXTS):
        if i not in HELD:
            for c, node, bit in steps(t, depth):
                for d in range(depth + 1):
                    count[d, c[depth - d:], node][bit] += 1
    for d, c, node in list(count):
        if d:
            children[d - 1, c[1:], node].add((d, c, node))

    def estimate(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1)

    @functools.cache
    def weighted(n):
        own = estimate(*count[n])
        if n[0] == depth:
            return own
        below = sum(map(weighted, children[n]))
        top = max(own, below)
        return math.log(.5) + top + math.log(math.exp(own - top) + math.exp(below - top))

    def predict(n, c, bit):
        a, b = count[n]
        own = ((a, b)[bit] + .5) / (a + b + 1)
        child = (n[0] + 1, c[depth - n[0] - 1:], n[2])
        if n[0] == depth or child not in count:
            return own
        share = 1 / (1 + math.exp(min(700, sum(map(weighted, children[n])) - estimate(a, b))))
        return share * own + (1 - share) * predict(child, c, bit)

    return [sum(math.log10(predict((0, b"", node), c, bit) if (0, b"", node) in count else .5) for c, node, bit in steps(t, depth))
            for t in TEXTS]


@pytest.mark.parametrize("known_rows", [1_000_000, 4])
def test_scores_like_the_recursion(make, known_rows):
    rows = ctw.score(make(TEXTS), ~F.col("doc_id").isin(*HELD), depth=3, known_strings=known_rows, known_words=known_rows).collect()
    want = brute(3)
    counts = defaultdict(int)
    for i, t in enumerate(TEXTS):
        if i not in HELD:
            for w in (t or "").lower().split() + [None]:
                counts[w] += 1
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        w = (TEXTS[r.key] or "").lower().split() + [None]
        assert abs(r.score - want[r.key]) < 1e-6
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(x in counts for x in w), n)
        assert abs(r.base_score - sum(math.log10((counts.get(x, 0) + .5) / (n + .5 * (v + 1))) for x in w)) < 1e-9


def test_no_training_rows_and_empty_table(make):
    rows = ctw.score(make(["ab", None]), F.lit(False)).collect()
    assert all(abs(r.bits_per_byte - 8) < 1e-9 and r.train_tokens == r.n_known == 0 for r in rows)
    assert ctw.score(make([]), F.lit(True)).collect() == []
