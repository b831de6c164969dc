"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees grown on the statistics of labelled texts give candidate rules: every path from a root
is a conjunction of comparisons. A lasso logistic regression over the rules' truth values keeps few
of them, and these become one Spark column expression, so scoring is a projection.

Trees and weights are fitted by Spark ML on at most about ``train_rows`` labelled rows (a documented
bound, drawn by a hash of the key; all labelled rows where there are fewer). Statistics and scores
cover every text in full.

Defined cases: a null or empty text has all statistics 0 and gets the score of these; a label other
than 0 or 1 is ignored; a key labelled several times counts each time; without labels of both kinds
the score is the share of label 1 among (labels + one of each kind). Columns of any name are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import add_columns, materialize, parts, remainder
from gridcast.llm.textscan import SPACED, as_bytes, chunks, distinct

AT_ONCE = 1 << 22  # bytes of text

STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper_share", "digit_share", "period_share",
    "comma_share", "symbol_share", "loud_share", "bar_share", "wide_share", "blank_share", "distinct_words",
    "top_word", "echo_share", "distinct_runs", "log_lines", "words_per_line", "distinct_lines", "closed_lines",
    "capital_lines")


def _class(members: bytes) -> np.ndarray:
    row = np.zeros(256)
    row[np.frombuffer(members, np.uint8)] = 1
    return row


_CLASSES = np.stack([
    _class(bytes(range(65, 91))), _class(b"0123456789"), _class(b"."), _class(b","), _class(b"#$%&*+/<=>@\\^_`{}~[]"),
    _class(b"!?"), _class(b"|\t"), _class(bytes(range(128, 256))), _class(b" \n\r\x0b\x0c")], axis=1)


def statistics(texts: list[bytes]) -> list[list[float]]:
    """The values of ``STATISTICS`` for each text, all finite."""
    out = []
    for chunk in chunks(texts, SPACED):
        sizes = (chunk.ends - chunk.starts).astype(float)
        threes, at = chunk.runs(3)
        cut = np.searchsorted(chunk.text_of[at], np.arange(chunk.count + 1))
        for i in range(chunk.count):
            text = texts[chunk.first + i]
            if not text:
                out.append([0.0] * len(STATISTICS))
                continue
            lo, hi = chunk.bounds[i], chunk.bounds[i + 1]
            n, words, size = hi - lo, chunk.words[lo:hi], sizes[lo:hi]
            shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _CLASSES / len(text)
            counts = np.unique(words, return_counts=True)[1] if n else np.zeros(1)
            runs = threes[cut[i]:cut[i + 1]]
            lines = [x for x in text.split(b"\n") if x.strip()]
            m = max(1, len(lines))
            out.append([
                math.log1p(len(text)), math.log1p(n), float(size.mean()) if n else 0.0, float(size.std()) if n else 0.0,
                *shares.tolist(), len(counts) / n if n else 0.0, float(counts.max()) / max(1, n),
                float((words[1:] == words[:-1]).mean()) if n > 1 else 0.0,
                len(distinct(runs)) / len(runs) if len(runs) else 1.0,
                math.log1p(len(lines)), n / m, len(set(lines)) / m,
                sum(x.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"') for x in lines) / m,
                sum(x.lstrip()[:1].isupper() for x in lines) / m])
    return out


def with_statistics(docs: DataFrame, name: str, text: str = "text", only: list[str] | None = None) -> DataFrame:
    """``docs`` with the statistics as one array column."""
    return add_columns(docs, text, [(name, "array<double>")], lambda texts, _: [statistics(texts)], only, at_once=AT_ONCE)


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, is it at most the bound, bound)."""

    parts: tuple[tuple[int, bool, float], ...]

    def column(self, stats: Column) -> Column:
        out = None
        for i, below, bound in self.parts:
            one = stats[i] <= bound if below else stats[i] > bound
            out = one if out is None else out & one
        return out

    def __str__(self) -> str:
        return " and ".join(f"{STATISTICS[i]} {'<=' if below else '>'} {bound:.6g}" for i, below, bound in self.parts)


@dataclass(frozen=True)
class RuleModel:
    """The rules that kept a weight, their weights and the intercept."""

    intercept: float
    weights: tuple[tuple[Rule, float], ...] = ()

    def score(self, stats: Column) -> Column:
        """The probability of label 1 as a column expression over the statistics array."""
        z = F.lit(self.intercept)
        for rule, weight in self.weights:
            z = z + F.when(rule.column(stats), F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-z))


def _paths(node, parts: tuple = ()) -> Iterator[Rule]:
    """All paths of a fitted tree below its root, later bounds on the same side replacing earlier ones."""
    if parts:
        yield Rule(tuple(sorted({(i, below): (i, below, bound) for i, below, bound in parts}.values())))
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        i, bound = split.featureIndex(), split.threshold()
        yield from _paths(node.leftChild(), (*parts, (i, True, bound)))
        yield from _paths(node.rightChild(), (*parts, (i, False, bound)))


def fit(rows: DataFrame, trees: int = 20, depth: int = 3, penalty: float = 1e-3, train_rows: int = 40_000,
        seed: int = 11) -> RuleModel:
    """Rules and weights from ``rows(key, stats array<double>, label 0 or 1)``."""
    n, ones = rows.agg(F.count("label"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < ones < n:
        share = (ones + 1) / (n + 2)
        return RuleModel(math.log(share / (1 - share)))
    parts = 1 << 30
    some = rows.where(F.pmod(F.xxhash64(F.lit(seed), "key"), F.lit(parts)) < int(parts * min(1.0, train_rows / n)))
    some = materialize(some.select(array_to_vector("stats").alias("features"), "stats", F.col("label").cast("double").alias("label")))
    if some.select("label").distinct().count() < 2:
        return RuleModel(math.log((ones + 1) / (n - ones + 1)))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, subsamplingRate=0.7, seed=seed, maxBins=64).fit(some)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in _paths(tree._java_obj.rootNode())))
    truth = [rule.column(F.col("stats")).cast("double").alias(f"r{k}") for k, rule in enumerate(rules)]
    marked = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="features").transform(
        some.select("label", *truth))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60, standardization=True).fit(
        materialize(marked.select("label", "features")))
    weights = [(rule, float(w)) for rule, w in zip(rules, lasso.coefficients.toArray()) if w]
    return RuleModel(float(lasso.intercept), tuple(weights))


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          **options) -> RuleModel:
    """A model from the texts whose key has a label."""
    known = _labelled(labels, key, label)
    # statistics are narrow, so they meet the labels by a join that no text goes through
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    return fit(materialize(with_statistics(rows, "stats", only=["key"]).join(known, "key")), **options)


def _labelled(labels: DataFrame, key: str, label: str) -> DataFrame:
    return labels.select(F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label")).where("label in (0, 1)")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", at_least: float = 0.3,
              **options) -> DataFrame:
    """``docs``, same columns, without the texts whose score is below ``at_least``."""
    model = learn(docs, labels, key, text, **options)

    @F.arrow_udf("array<double>")
    def stats(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        rows = [x for part in parts(batch, 0, AT_ONCE) for x in statistics(as_bytes(part.column(0)))]
        return pa.array(rows, pa.list_(pa.float64()))

    # only the text and its statistics go through Python, the other columns stay where they are
    return docs.where(model.score(stats(F.col(f"`{text}`").cast("string"))) >= at_least)


def report(docs: DataFrame, labels: DataFrame, at_least: float = 0.3) -> DataFrame:
    """One row per document: held out or not, score and prediction. Labels of held-out keys (crc32 of
    the key modulo 5 is 0) are not learnt from."""
    stats = materialize(with_statistics(docs.select("doc_id", "text"), "stats", only=["doc_id"]))
    known = _labelled(labels, "doc_id", "quality").where(remainder("key") != 0)
    model = fit(stats.select(F.col("doc_id").alias("key"), "stats").join(known, "key"))
    score = model.score(F.col("stats"))
    return stats.select(
        "doc_id", F.coalesce(remainder("doc_id") == 0, F.lit(False)).alias("held_out"), score.alias("score"),
        F.when(score >= at_least, 1).otherwise(0).alias("predicted"))
