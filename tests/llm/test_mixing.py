import math

from pyspark.sql import functions as F

from conftest import words
from gridcast.llm import mixing


def corpus(make):
    texts, source = [], []
    for s, n in (("big", 60), ("mid", 20), (None, 6), ("tiny", 3)):
        for i in range(n):
            texts.append(" ".join(words(len(texts), 20 + i)))
            source.append(s)
    return make(texts + [None, ""], source=source + ["big", "none"])


def shares(docs, **options):
    rows = mixing.copies(docs, block_tokens=200, **options).collect()
    n = {}
    for r in rows:
        n.setdefault(r.source, [0, 0, r.exponent, r.weight])
        n[r.source][0] += r.n_tokens
        n[r.source][1] += r.n_tokens * r.copies
    return rows, n


def test_entropy_target_and_quota(make):
    docs = corpus(make)
    rows, n = shares(docs, entropy=0.9, budget="corpus")
    total = sum(x[0] for x in n.values())
    weights = [x[3] for x in n.values() if x[3]]
    assert abs(-sum(w * math.log(w) for w in weights) / math.log(4) - 0.9) < 1e-6 and abs(sum(weights) - 1) < 1e-8
    longest = max(r.n_tokens for r in rows)
    for have, taken, _, weight in n.values():
        assert weight * total - 1 <= taken <= weight * total + longest or not have


def test_repeat_limit_leaves_nobody_out(make):
    docs = corpus(make)
    rows, n = shares(docs, max_repeats=1.5)
    assert all(r.copies >= 1 for r in rows)
    ratios = [x[1] / x[0] for x in n.values() if x[0]]
    assert max(ratios) < 1.75 and min(ratios) == 1
    kept = mixing.mix(docs, max_repeats=1.5, block_tokens=200)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.copies for r in rows)
    assert kept.select("doc_id").distinct().count() == docs.count()


def test_limit_wins_and_ends_of_the_range(make):
    docs = corpus(make)
    assert shares(docs, entropy=1.0)[1]["big"][2] < 1e-6  # the entropy is flat there
    assert shares(docs, entropy=0.0)[1]["big"][2] == 1
    loose, tight = (shares(docs, entropy=1.0, max_repeats=x, budget="corpus")[1]["big"][2] for x in (1e9, 2.0))
    assert loose < 1e-6 < tight


def test_repeated_rows_and_empty_table(make):
    docs = corpus(make)
    twice = mixing.copies(docs.unionByName(docs), budget="corpus", entropy=0.9, block_tokens=200)
    assert twice.groupBy("key").agg(F.countDistinct("copies").alias("n")).where("n > 1").count() == 0
    assert mixing.mix(docs.limit(0), max_repeats=2.0).collect() == []


def test_a_very_small_source_neither_crashes_nor_vanishes(spark):
    """One token beside two sources of four thousand million."""
    tokens = spark.createDataFrame([("a", 4_000_000_000), ("b", 4_000_000_000), ("tiny", 1)], "src string, n long")
    for options in ({}, {"max_repeats": 1.5}, {"budget": 8_000_000_000}, {"budget": 1000, "entropy": 0.5}):
        plan = {r.src: r for r in mixing.plan(tokens, **options).collect()}
        assert plan["tiny"].passes >= 1, options
        assert all(r.passes * r.n + r.rest >= 1 for r in plan.values())


def test_a_small_source_keeps_a_document_under_any_budget(make):
    texts = [" ".join(words(i, 400)) for i in range(30)] + ["lone word"]
    docs = make(texts, source=["big"] * 30 + ["tiny"])
    rows = mixing.copies(docs, budget=20, block_tokens=200).collect()
    assert {r.copies for r in rows if r.source == "tiny"} == {1}
