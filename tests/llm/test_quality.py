import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import words
from gridcast.llm import quality
from gridcast.llm.common import table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def labelled(make, spark):
    r, texts, labels = random.Random(3), [], []
    for i in range(300):
        w = words(i, 40 + i % 50)
        bad = i % 3 == 0
        texts.append(" ".join(x.upper() + "!!" for x in w) if bad else " ".join(w) + ".")
        labels.append((i, 0 if bad else 1))
    r.shuffle(labels)
    return make(texts + [None, "", "x" * 200_000]), spark.createDataFrame(labels + [(1, None), (2, 7), (10 ** 6, 1)], "doc_id long, quality int")


def test_rejects_bad_and_keeps_columns(labelled):
    docs, labels = labelled
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").where("doc_id < 300").collect()}
    assert ids == {i for i in range(300) if i % 3}


def test_rules_are_the_trees_and_the_expression_is_the_sum(labelled, spark):
    docs, labels = labelled
    model = quality.learn(docs, labels)
    assert 0 < len(model.weights) and all(str(rule) for rule, _ in model.weights)
    stats = quality.with_statistics(docs, "s", only=["doc_id"]).withColumn("score", model.score(F.col("s"))).collect()
    for r in stats:
        z = model.intercept + sum(w for rule, w in model.weights if all(
            r.s[i] <= b if below else r.s[i] > b for i, below, b in rule.parts))
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9 and all(map(math.isfinite, r.s))


def test_without_labels_of_both_kinds(labelled):
    docs, labels = labelled
    for some, want in ((labels.limit(0), 0.5), (labels.where("quality = 1 and doc_id < 4"), None)):
        scores = {r.score for r in quality.report(docs, some).select("score").collect()}
        assert len(scores) == 1 and (want is None or abs(scores.pop() - want) < 1e-12)
    assert quality.report(docs.limit(0), labels).collect() == []


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = quality.report(docs, labels).join(labels, "doc_id").where("held_out and quality is not null").select("predicted", "quality").collect()
    bad = [r.predicted for r in rows if r.quality == 0]
    good = [r.predicted for r in rows if r.quality == 1]
    assert len(bad) > 50 and sum(bad) / len(bad) < 0.05 and sum(good) / len(good) > 0.98
