"""Language of web pages from several kinds of evidence, fused by Bayes' rule.

The text likelihood comes from byte trigrams counted per language over all labelled documents. Its
weight saturates with length, since neighbouring trigrams are far from independent. The language the
markup declares and the suffix of the address are two more likelihoods, and the prior is that of the
page's host, smoothed towards its domain and that towards all pages. Likelihoods and priors are
estimated by grouped counts of the language that the text alone points to; a page's own vote is left
out of its host's counts.

What tasks hold grows with the number of languages only, which is checked against ``most_languages``.

Defined cases: a page without any trigram (null or empty markup, say) has no text evidence, a null text
language, and no vote in any count; a page without declared language or without
host gets no evidence from these; documents without language or text are not learnt from; without any
language the result is null; repeated pages vote each; extra columns are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import materialize
from gridcast.llm.textscan import CHUNK, as_bytes

CELLS = 1 << 16
SMOOTH, PULL, STRENGTH = 0.5, 5.0, 60.0  # added counts, weight of the level above, most text weight in trigrams
_MARKUP = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
_DECLARED = re.compile(rb"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{1,8})", re.I)


def cells(text: bytes) -> np.ndarray:
    """The hashed byte trigrams of a text, A-Z lower-cased and white space collapsed."""
    b = np.frombuffer(b" ".join([b"", *text.lower().split(), b""]), np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, np.uint32)
    return ((b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)) >> np.uint32(16)


def visible(markup: bytes) -> bytes:
    """The text between the tags, without scripts, styles and comments."""
    return html.unescape(_MARKUP.sub(b" ", markup).decode("utf-8", "replace")).encode("utf-8", "replace")


def declared(markup: bytes) -> str | None:
    found = _DECLARED.search(markup)
    return found.group(1).decode().lower() if found else None


def count_trigrams(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, cell, n) over all labelled documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for language, t in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                by.setdefault(language, []).append(t)
                if sum(map(len, by[language])) > CHUNK:
                    held[language] = held.get(language, 0) + np.bincount(cells(b" ".join(by.pop(language))), minlength=CELLS)
            for language, texts in by.items():
                held[language] = held.get(language, 0) + np.bincount(cells(b" ".join(texts)), minlength=CELLS)
        for language, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([language] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(n[at])],
                                             ["lang", "cell", "n"])

    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.where("lang is not null and length(text) > 0").mapInArrow(run, "lang string, cell int, n long").groupBy("lang", "cell").agg(
        F.sum("n").alias("n"))


class TextModel:
    """Log probabilities of the trigram cells in each language."""

    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table

    @classmethod
    def fit(cls, counts: DataFrame, most_languages: int = 500) -> TextModel:
        counts = materialize(counts)
        languages = sorted(r.lang for r in counts.select("lang").distinct().limit(most_languages + 1).collect())
        if len(languages) > most_languages:
            raise ValueError(f"more than {most_languages} languages")
        n = np.zeros((len(languages), CELLS))
        rows = counts.toArrow()
        where = {x: i for i, x in enumerate(languages)}
        n[np.array([where[x] for x in rows.column("lang").to_pylist()], int), rows.column("cell").to_numpy()] = rows.column("n").to_numpy()
        total = n.sum(axis=1, keepdims=True)
        return cls(languages, np.log((n + SMOOTH) / (total + SMOOTH * CELLS)).astype(np.float32))

    def evidence(self, text: bytes) -> np.ndarray | None:
        """Log likelihood of a text per language, up to a constant, its weight bounded by ``STRENGTH``;
        None where there is no trigram."""
        at, total = cells(text), np.zeros(len(self.languages))
        for lo in range(0, len(at), CHUNK):
            total += self.table[:, at[lo:lo + CHUNK]].sum(axis=1, dtype=float)
        return total * (STRENGTH / (len(at) + STRENGTH)) if len(at) else None


def _per_language(n: int, one) -> Column:
    return F.array(*[one(i) for i in range(n)])


def identify(pages: DataFrame, docs: DataFrame, key: str = "page_id", url: str = "url", markup: str = "html",
             most_languages: int = 500) -> DataFrame:
    """(key, host, declared, text_language, language, probability) for every page."""
    model = TextModel.fit(count_trigrams(docs), most_languages)
    k = len(model.languages)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    host = F.lower(F.regexp_extract(F.col(f"`{url}`").cast("string"), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    rows = pages.select(F.col(f"`{key}`").alias("key"), F.nullif(host, F.lit("")).alias("host"), F.col(f"`{markup}`").cast("string").alias("m"))
    if not k:
        return rows.select("key", "host", *[F.lit(None).cast("string").alias(c) for c in ("declared", "text_language", "language")],
                           F.lit(None).cast("double").alias("probability"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, evidence = [], []
            for m in as_bytes(batch.column(2)):
                said.append(declared(m))
                evidence.append(shared.value.evidence(visible(m)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(said, pa.string()),
                                              pa.array(evidence, pa.list_(pa.float64()))], ["key", "host", "declared", "text"])

    kind = rows.schema["key"].dataType.simpleString()
    seen = rows.mapInArrow(run, f"key {kind}, host string, declared string, text array<double>")
    seen = materialize(seen.select(
        "*", F.when(F.size(F.coalesce("text", F.array())) > 0, F.array_position("text", F.array_max("text")) - 1).cast("int").alias("vote"),
        F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("domain"), F.regexp_extract("host", r"([^.]+)$", 1).alias("suffix")))

    def votes(by: str) -> DataFrame:
        """(by, votes per language), null keys left out."""
        return seen.where(F.col(by).isNotNull() & F.col("vote").isNotNull()).groupBy(by).agg(
            *[F.sum((F.col("vote") == i).cast("double")).alias(f"v{i}") for i in range(k)]).select(
            by, _per_language(k, lambda i: F.col(f"v{i}")).alias(f"{by}_votes"))

    def likelihood(by: str) -> DataFrame:
        """(by, log P(by | language)): smoothed over the values that occur and one unseen."""
        table = votes(by)
        values, *sums = table.agg(F.count("*"), *[F.sum(F.col(f"{by}_votes")[i]) for i in range(k)]).first()
        return table.select(by, _per_language(k, lambda i: F.log(
            (F.col(f"{by}_votes")[i] + SMOOTH) / ((sums[i] or 0.0) + SMOOTH * (values + 1)))).alias(f"{by}_log"))

    everyone = seen.agg(*[F.sum((F.col("vote") == i).cast("double")) for i in range(k)]).first()
    total = sum(x or 0 for x in everyone)
    overall = [((x or 0) + SMOOTH) / (total + SMOOTH * k) for x in everyone]
    size = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    joined = seen.join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left").join(
        votes("domain"), "domain", "left").join(votes("host"), "host", "left")
    own = lambda i: F.when(F.col("vote") == i, 1.0).otherwise(0.0)
    zeros = F.array(*[F.lit(0.0)] * k)
    joined = joined.withColumns({
        "text": F.coalesce("text", zeros), "domain_votes": F.coalesce("domain_votes", zeros),
        "host_votes": F.when(F.col("host_votes").isNull(), zeros).otherwise(_per_language(k, lambda i: F.col("host_votes")[i] - own(i))),
        "declared_log": F.coalesce("declared_log", zeros), "suffix_log": F.coalesce("suffix_log", zeros)})
    joined = joined.withColumns({"domain_size": size("domain_votes"), "host_size": size("host_votes")})
    near = lambda i: (F.col("domain_votes")[i] + PULL * overall[i]) / (F.col("domain_size") + PULL)
    prior = lambda i: (F.col("host_votes")[i] + PULL * near(i)) / (F.col("host_size") + PULL)
    fused = joined.withColumn("z", _per_language(k, lambda i: F.col("text")[i] + F.col("declared_log")[i] + F.col("suffix_log")[i] + F.log(prior(i))))
    fused = fused.withColumn("top", F.array_max("z"))
    names = F.array(*[F.lit(x) for x in model.languages])
    return fused.select(
        "key", "host", "declared", F.get(names, F.col("vote")).alias("text_language"),
        names[(F.array_position("z", F.col("top")) - 1).cast("int")].alias("language"),
        (1 / F.aggregate("z", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("top")))).alias("probability"))


def report(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """The language of every page."""
    return identify(pages, docs).withColumnRenamed("key", "page_id")
