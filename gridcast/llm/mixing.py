"""Mixing sources to target weights.

Source token shares are raised to an exponent between 1 (natural shares) and 0 (all equal). The
exponent is found by bisection: the largest one whose weights reach a target entropy, or the
smallest one under which no source is repeated more than a limit; with both, the limit wins. The
weights times the budget give each source's quota of tokens. A quota is met by whole passes over the
source's blocks plus a last pass over a permutation of them that stops at the quota; only the block
in which it stops is cut, between documents.

Blocks are groups of documents dealt by a hash of their key, of about ``block_tokens`` tokens.
Running totals are taken over hash ranges first and inside a range next, so no task sees more than a
256th of a source's blocks or one block's documents.

Defined cases: the tokens of a text are its white-space separated words; a null source is a source;
a text without tokens costs nothing and is kept once; a source whose share is less than a token has
one token, and so at least a document; rows that repeat a key share its fate; an empty
table stays empty; a target out of reach gives the nearest end of the range.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import fresh, materialize

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 52  # bisection steps: the exponent is exact to double precision


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def _hash(*parts: Column | str) -> Column:
    """60 bits of an md5, which any engine can repeat."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _largest(rows: DataFrame, holds, flip: bool) -> float:
    """The end of the range of exponents for which ``holds`` is true: the largest one, or with
    ``flip`` the smallest. One job looks at 15 inner points, which is four steps of bisection."""
    lo, hi = 0.0, 1.0
    if holds(rows, [1.0])[0] and not flip:
        return 1.0
    if flip and holds(rows, [0.0])[0]:
        return 0.0
    for _ in range(STEPS // 4):
        points = [lo + (hi - lo) * k / 16 for k in range(1, 16)]
        true = holds(rows, points)
        at = sum(not t for t in true) if flip else sum(true)
        step = (hi - lo) / 16
        lo, hi = lo + step * at, lo + step * (at + 1)
    return hi if flip else lo


def _entropy_reached(share: float, k: int):
    def holds(rows: DataFrame, points: list[float]) -> list[bool]:
        sums = []
        for t in points:
            sums += [F.sum(F.exp(t * F.col("lp"))), F.sum(t * F.col("lp") * F.exp(t * F.col("lp")))]
        x = rows.agg(*sums).first()
        return [math.log(x[2 * i]) - x[2 * i + 1] / x[2 * i] >= share * math.log(k) for i in range(len(points))]
    return holds


def _repeats_within(limit: float, budget: float | None, total: float, least: float, most: float):
    def holds(rows: DataFrame, points: list[float]) -> list[bool]:
        x = rows.agg(*[F.sum(F.exp(t * F.col("lp"))) for t in points]).first()
        out = []
        for t, s in zip(points, x):
            spent = budget if budget is not None else most / (math.exp(t * math.log(most / total)) / s)
            out.append(math.exp(t * math.log(least / total)) / s * spent / least <= limit)
        return out
    return holds


def plan(tokens: DataFrame, entropy: float | None = None, max_repeats: float | None = None, budget: int | None = None,
         block_tokens: int = 1_000_000) -> DataFrame:
    """One row per source of ``tokens(src, n)``: its tokens, weight, quota, whole passes, the rest of
    the last pass, and its number of blocks. ``entropy`` is a share of the largest possible entropy;
    without a ``budget`` it is the smallest one that leaves no document out."""
    rows = materialize(tokens.groupBy("src").agg(F.sum("n").alias("n")).where("n > 0"))
    total, k, least, most = rows.agg(F.sum("n"), F.count("*"), F.min("n"), F.max("n")).first()
    if not k:
        return rows.selectExpr("src", "n", "0D weight", "0D exponent", "0L passes", "0L rest", "1L blocks")
    rows = rows.withColumn("lp", F.log(F.col("n") / float(total)))
    exponent = 1.0
    if entropy is not None:
        exponent = _largest(rows, _entropy_reached(entropy, k), flip=False)
    if max_repeats is not None:
        limit = _largest(rows, _repeats_within(max_repeats, budget, total, least, most), flip=True)
        exponent = limit if entropy is None else max(exponent, limit)
    scale = rows.agg(F.sum(F.exp(exponent * F.col("lp")))).first()[0]
    rows = rows.withColumn("w", F.exp(exponent * F.col("lp")) / scale)  # unrounded: a source may be very small
    if budget is None:
        budget = rows.agg(F.max(F.col("n") / F.col("w"))).first()[0]
    quota = F.greatest(F.floor(F.col("w") * float(budget) + 0.5), F.lit(1).cast("long"))  # every source has a share
    return rows.select(
        "src", "n", F.round("w", 9).alias("weight"), F.round(F.lit(exponent), 9).alias("exponent"),
        F.floor(quota / F.col("n")).alias("passes"), F.pmod(quota, F.col("n")).alias("rest"),
        F.ceil(F.col("n") / block_tokens).alias("blocks"))


def copies(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", seed: str = "mix",
           block_tokens: int = 1_000_000, **options) -> DataFrame:
    """(key, source, n_tokens, weight, exponent, block, copies) for every row of ``docs``: how often
    the mixture holds it. ``options`` are those of :func:`plan`; ``budget="corpus"`` is as many tokens as there are."""
    src = F.coalesce(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")), F.lit("null"))
    tokens = materialize(docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), src.alias("src"),
                                     word_count(text).alias("n")))
    if options.get("budget") == "corpus":
        options["budget"] = int(tokens.agg(F.sum("n")).first()[0] or 0)
    sources = materialize(plan(tokens, block_tokens=block_tokens, **options))
    rows = tokens.join(sources.drop("n"), "src", "left").withColumns({
        "block": F.pmod(_hash(seed, "block", F.col("key")), F.coalesce("blocks", F.lit(1).cast("long"))),
        "at": _hash(seed, "document", F.col("key"))})
    blocks = rows.where("rest > 0").groupBy("src", "block").agg(
        F.sum("n").alias("size"), F.first("rest").alias("rest"), F.first("passes").alias("passes")).withColumn(
        "place", _hash(seed, "pass", F.col("src"), F.col("passes"), F.col("block")))
    blocks = materialize(blocks.withColumn("range", F.shiftrightunsigned("place", 52)))
    rows_before = (Window.unboundedPreceding, -1)
    ranges = blocks.groupBy("src", "range").agg(F.sum("size").alias("size")).select(
        "src", "range", F.coalesce(F.sum("size").over(Window.partitionBy("src").orderBy("range").rowsBetween(*rows_before)),
                                   F.lit(0)).alias("base"))
    inner = Window.partitionBy("src", "range").orderBy("place", "block").rowsBetween(*rows_before)
    left = F.col("rest") - F.col("base") - F.coalesce(F.sum("size").over(inner), F.lit(0))
    taken = blocks.join(ranges, ["src", "range"]).select("src", "block", "size", left.alias("left")).where("`left` > 0")
    rows = rows.join(taken, ["src", "block"], "left")
    cut = rows.where("`left` < size").groupBy("src", "block", "at").agg(F.sum("n").alias("n"), F.first("left").alias("left"))
    inside = cut.select("src", "block", "at", (F.col("left") > F.coalesce(F.sum("n").over(
        Window.partitionBy("src", "block").orderBy("at").rowsBetween(*rows_before)), F.lit(0))).alias("within"))
    extra = F.when(F.col("left").isNull(), 0).when(F.col("left") >= F.col("size"), 1).otherwise(
        F.coalesce(F.col("within").cast("int"), F.lit(0)))
    rows = rows.join(inside, ["src", "block", "at"], "left")
    return rows.select(
        "key", "source", F.col("n").alias("n_tokens"), F.coalesce("weight", F.lit(0.0)).alias("weight"), "exponent", "block",
        F.when(F.col("n") == 0, F.lit(1).cast("long")).otherwise(F.col("passes") + extra).alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """``docs``, same columns, every row as often as the mixture holds it."""
    name = fresh(docs, "__mix")
    found = copies(docs, key, source, text, **options).groupBy("key", "source").agg(F.first("copies").alias("copies"))
    found = found.toDF(f"{name}k", f"{name}s", f"{name}c").where(F.col(f"{name}c") != 1)
    rows = docs.join(found, F.col(f"`{key}`").eqNullSafe(F.col(f"{name}k")) & F.col(f"`{source}`").eqNullSafe(F.col(f"{name}s")), "left")
    times = F.sequence(F.lit(1).cast("long"), F.coalesce(F.col(f"{name}c"), F.lit(1).cast("long")))
    kept = rows.where(F.coalesce(F.col(f"{name}c"), F.lit(1)) > 0).withColumn(f"{name}e", F.explode(times))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """How often each document stands in a mixture as large as the corpus, with 97 % of the largest
    entropy unless a source would have to be repeated more than four times."""
    return copies(docs, entropy=0.97, max_repeats=4.0, budget="corpus", block_tokens=100_000).withColumnRenamed("key", "doc_id")


REPORT_SQL = r"""
WITH RECURSIVE tok AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n FROM documents),
src AS (SELECT source, CAST(sum(n) AS BIGINT) AS n FROM tok GROUP BY source HAVING sum(n) > 0),
tot AS (SELECT list(CAST(n AS DOUBLE)) AS ns, CAST(sum(n) AS DOUBLE) AS total, count(*) AS k, min(n) AS least FROM src),
lps AS (SELECT *, list_transform(ns, lambda x: ln(x / total)) AS lp FROM tot),
ent(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT step + 1, CASE WHEN ok THEN mid ELSE lo END, CASE WHEN ok THEN hi ELSE mid END
  FROM (SELECT step, lo, hi, mid,
               ln(list_sum(list_transform(lp, lambda x: exp(mid * x))))
               - list_sum(list_transform(lp, lambda x: mid * x * exp(mid * x))) / list_sum(list_transform(lp, lambda x: exp(mid * x)))
               >= 0.97 * ln(k) AS ok
        FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid FROM ent WHERE step < 52), lps)),
rep(step, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT step + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END
  FROM (SELECT step, lo, hi, mid,
               exp(mid * ln(least / total)) / list_sum(list_transform(lp, lambda x: exp(mid * x))) * total / least <= 4.0 AS ok
        FROM (SELECT step, lo, hi, (lo + hi) / 2 AS mid FROM rep WHERE step < 52), lps)),
expo AS (SELECT greatest((SELECT max(lo) FROM ent WHERE step = 52), (SELECT min(hi) FROM rep WHERE step = 52)) AS t),
weighted AS (
  SELECT source, n, total, t, exp(t * ln(n / total)) / list_sum(list_transform(lp, lambda x: exp(t * x))) AS weight
  FROM src, lps, expo),
quotas AS (SELECT *, greatest(CAST(floor(weight * total + 0.5) AS BIGINT), 1) AS quota FROM weighted),
plan AS (SELECT source, round(weight, 9) AS weight, round(t, 9) AS exponent, quota // n AS passes, quota % n AS rest,
                CAST(ceil(n / 100000) AS BIGINT) AS blocks FROM quotas),
rows AS (
  SELECT doc_id, tok.source, n, weight, exponent, passes, rest,
         CAST('0x' || md5('mix:block:' || doc_id)[1:15] AS BIGINT) % coalesce(blocks, 1) AS block,
         CAST('0x' || md5('mix:document:' || doc_id)[1:15] AS BIGINT) AS spot
  FROM tok LEFT JOIN plan ON tok.source IS NOT DISTINCT FROM plan.source),
blocks AS (
  SELECT source, block, sum(n) AS size, any_value(rest) AS rest,
         CAST('0x' || md5('mix:pass:' || coalesce('=' || source, 'null') || ':' || any_value(passes) || ':' || block)[1:15] AS BIGINT) AS place
  FROM rows GROUP BY source, block),
taken AS (SELECT source, block, size, rest - coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, block
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room FROM blocks),
marked AS (
  SELECT r.*, size, room, coalesce(sum(n) OVER (PARTITION BY r.source, r.block ORDER BY spot
            RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
  FROM rows r LEFT JOIN taken t ON r.source IS NOT DISTINCT FROM t.source AND r.block = t.block)
SELECT doc_id, source, CAST(n AS BIGINT) AS n_tokens, coalesce(weight, 0) AS weight, exponent, CAST(block AS BIGINT) AS block,
       CAST(CASE WHEN n = 0 THEN 1 ELSE passes + CASE WHEN room > earlier THEN 1 ELSE 0 END END AS BIGINT) AS copies
FROM marked
"""
