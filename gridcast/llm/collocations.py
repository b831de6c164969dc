"""Phrases of two to five words that stand together more often than their parts would by chance.

A candidate is a phrase that occurs at least ``least`` times within pieces of its language's texts. A cut
behind its k-th word scores floor(1000 * a * n / (l * r)), from the counts a of the phrase, l and r of its
parts and n of all words; the lowest cut counts, ties to the smallest k. Candidates inside a longer
candidate of the same count are dropped. Each language's first ``limit`` are returned.

Method: best-first branch and bound over prefixes. A phrase is no more frequent than what remains behind
any of its prefixes, so a / r <= 1 and its score is at most floor(1000 * n / f(prefix)): rare prefixes
have the high bounds. The frontier starts as all frequent words of a language, dealt into layers of
falling bound. A round grows one layer's words, word by word, as long as prefixes stay frequent and their
bound reaches the language's score at place ``limit``; then it counts the right parts of what survived and
scores it. A language is settled, ties included, once that score is above the bound of its next layer.

Scale: a scan sends no phrase on whose prefix is not in a bitmap of at most 32 MB (false hits cost time
only, since counts are exact), and sums up a few MB of text before the shuffle. Words stand as 64-bit
hashes of language and word; hashes that two words share are found by a second hash when words are
counted, and such words go by a digest instead. Whether a longer candidate has the same count needs no second look at
phrases: it does exactly if all occurrences have the same neighbour on one side.

Defined cases: null and empty texts have no words; a null language is ``und``; rows that repeat a key are
texts each for themselves; a language without candidates is not listed; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.bitmaps import Bitmap, bitmap
from gridcast.llm.common import materialize, parts
from gridcast.llm.textscan import as_bytes, lower_ascii, mix, word_table, words_of

U64 = np.uint64
ENDS = "\n\x0b\x0c\r.,;:!?"          # end a piece
WORDS = word_table(" \t" + ENDS)
_IS_END = np.zeros(256, bool)
_IS_END[np.frombuffer(ENDS.encode(), np.uint8)] = True

GROUP = 4 << 20                       # bytes of text summed up at once
PIECE = 1 << 20                       # bytes of text whose words are hashed at once
ROWS = 1 << 16                        # phrases sent on at once
LAYERS = (1 / 4,)                     # shares of a language's frequent occurrences at which layers end
SENT = 1 << 20                        # words a task remembers having spelt
SEP = b"\n"


#: Another order of the bytes that lower-cased texts have, for a second hash of words.
_USED = np.array([x for x in range(256) if not 65 <= x <= 90], np.uint8)
_OTHER = np.arange(256, dtype=np.uint8)
_OTHER[_USED] = np.roll(_USED, 97)
_OTHER_WORDS = np.ones(256, bool)
_OTHER_WORDS[_OTHER[_USED]] = WORDS[_USED]


def _digest(*parts: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(b"\x00".join(parts), digest_size=8).digest(), "little")


class Texts:
    """The words of some texts: offsets, names (hashes of language and word), and which are joined to the next."""

    def __init__(self, texts: list[bytes], langs: list[str], shared: np.ndarray):
        self.langs, self.bytes = langs, np.frombuffer(SEP.join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        self.starts, self.ends, words = words_of(self.bytes, WORDS, PIECE)
        self.text = np.searchsorted(first, self.starts, side="right") - 1
        self.names = mix(words ^ self._of_lang(b"name"))
        for i in np.flatnonzero(np.isin(self.names, shared)).tolist() if len(shared) else ():
            self.names[i] = _digest(langs[self.text[i]].encode(), self.word(i))
        # a piece ends wherever one of the signs, or the end of a text, lies between two words
        self.joined = np.zeros(len(self.starts), bool)
        if len(self.starts):
            ends = np.cumsum(_IS_END[self.bytes], dtype=np.int32)[self.starts]
            self.joined[:-1] = ends[:-1] == ends[1:]

    def _of_lang(self, salt: bytes) -> np.ndarray:
        of = {lang: _digest(salt, lang.encode()) for lang in set(self.langs)}
        return np.array([of[x] for x in self.langs], U64)[self.text]

    def checks(self) -> np.ndarray:
        """Second hashes of language and word, independent of the names."""
        return mix(words_of(_OTHER[lower_ascii(self.bytes)], _OTHER_WORDS, PIECE)[2] ^ self._of_lang(b"check"))

    def word(self, i: int) -> bytes:
        return lower_ascii(self.bytes[self.starts[i]:self.ends[i]]).tobytes()

    def hashes(self, at: np.ndarray, k: int) -> np.ndarray:
        """A hash of the k words from each place on."""
        return _phrase_hash([self.names[at + j] for j in range(k)])


def _phrase_hash(words: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(words[0]), U64)
    for w in words:
        out = out * U64(0xD6E8FEB86659FD93) + w
    return mix(out + U64(len(words)))


def phrases_bitmap(phrases: DataFrame) -> Bitmap:
    """The bitmap of ``phrases(p)``, arrays of names."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(0)
            flat, at = lists.flatten().to_numpy(zero_copy_only=False).view(U64), np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
            size, out = np.diff(at), np.empty(batch.num_rows, U64)
            for k in np.unique(size).tolist():
                mine = np.flatnonzero(size == k)
                out[mine] = _phrase_hash([flat[at[mine] + j] for j in range(k)])
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["h"])

    return bitmap(phrases.select("p").mapInArrow(hashed, "h bigint"), phrases.count())


def _groups(batch: pa.RecordBatch, open_: Bitmap | None = None) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts and languages, some MB at a time; with ``open_`` those of its languages only."""
    if open_ is not None:
        batch = batch.filter(pa.array(open_.has(batch.column(2).to_numpy(zero_copy_only=False).view(U64))))
    for part in parts(batch, 0, GROUP):
        texts = as_bytes(part.column(0))
        if any(texts):
            yield texts, part.column(1).to_pylist()


def _word_counts(docs: DataFrame, shared: list[int]) -> DataFrame:
    """(name, check, lang, f) of all words of ``docs(text, lang)``."""
    held = np.array(shared, U64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts, langs in _groups(batch):
                t = Texts(texts, langs, held)
                checks, order = t.checks(), np.argsort(t.names)
                names, checks = t.names[order], checks[order]
                new = np.ones(len(order), bool)
                new[1:] = (names[1:] != names[:-1]) | (checks[1:] != checks[:-1])
                at = np.flatnonzero(new)
                lang = pa.array(langs, pa.string()).take(pa.array(t.text[order[at]]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(names[at].view(np.int64)), pa.array(checks[at].view(np.int64)), lang,
                    pa.array(np.diff(np.append(at, len(order))))], names=["name", "check", "lang", "f"])

    counted = docs.select("text", "lang").mapInArrow(run, "name bigint, check bigint, lang string, f bigint")
    return counted.groupBy("name", "check", "lang").agg(F.sum("f").alias("f"))


def _spelt(docs: DataFrame, shared: list[int], names: DataFrame) -> DataFrame:
    """(name, word) of ``names(p)``, each sent once by a task."""
    held = np.array(shared, U64)
    wanted = docs.sparkSession.sparkContext.broadcast(phrases_bitmap(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent = np.empty(0, U64)
        for batch in batches:
            for texts, langs in _groups(batch):
                t = Texts(texts, langs, held)
                hit = np.flatnonzero(wanted.value.has(t.hashes(np.arange(len(t.names)), 1)))
                found, first = np.unique(t.names[hit], return_index=True)
                new = ~np.isin(found, sent)
                sent = np.concatenate((sent, found[new]))[-SENT:]
                yield pa.RecordBatch.from_arrays([pa.array(found[new].view(np.int64)), pa.array(
                    [t.word(i).decode("utf-8", "replace") for i in hit[first[new]].tolist()], pa.string())], names=["name", "word"])

    return docs.select("text", "lang").mapInArrow(run, "name bigint, word string").groupBy("name").agg(F.min("word").alias("word"))


def _vocabulary(docs: DataFrame, least: int, shared: list[int]) -> tuple[DataFrame, list[int]]:
    """Counts of all words, and the names that go by a digest because two words would share them."""
    while True:
        words = materialize(_word_counts(docs, shared))
        clash = words.groupBy("name").agg(F.count("*").alias("n"), F.sum("f").alias("f")).where((F.col("n") > 1) & (F.col("f") >= least))
        found = [r.name % (1 << 64) for r in clash.select("name").collect()]  # next to none among 2^64
        if not found:
            return words, shared
        shared = shared + found


def _count(docs: DataFrame, shared: list[int], open_: Bitmap, frequent: Bitmap, starts: Bitmap, asked: list[tuple[int, int]], least: int) -> DataFrame:
    """(p, a, inside) of phrases that occur ``least`` times or more. ``asked`` lists (k, m): phrases of k
    frequent words whose first m words are in ``starts``. ``inside`` tells whether all occurrences have
    the same word before them, or all the same word behind."""
    held = np.array(shared, U64)
    all_three = docs.sparkSession.sparkContext.broadcast((open_, frequent, starts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        languages, known, wanted = all_three.value
        for batch in batches:
            for texts, langs in _groups(batch, languages):
                t = Texts(texts, langs, held)
                good = known.has(t.hashes(np.arange(len(t.names)), 1))
                for k, m in asked:
                    at = np.flatnonzero(good[:len(good) - k + 1]) if len(good) >= k else np.empty(0, np.int64)
                    for j in range(1, k):
                        at = at[t.joined[at + j - 1] & good[at + j]]
                    at = at[wanted.has(t.hashes(at, m))]
                    if len(at):
                        summed = _summed(t, at, k)
                        for lo in range(0, summed.num_rows, ROWS):
                            yield summed.slice(lo, ROWS)

    counted = docs.select("text", "lang", F.xxhash64("lang")).mapInArrow(run, "p array<bigint>, n bigint, before bigint, behind bigint")
    return counted.groupBy("p").agg(
        F.sum("n").alias("a"), *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("before", "behind")]).where(F.col("a") >= least).select(
        "p", "a", F.expr("(min_before = max_before and min_before <> 0) or (min_behind = max_behind and min_behind <> 0)").alias("inside"))


def _summed(t: Texts, at: np.ndarray, k: int) -> pa.RecordBatch:
    """The phrases of k words at the given places, each once with its number; as neighbours the word that
    all occurrences share, or 0."""
    at = at[np.argsort(t.hashes(at, k), kind="stable")]
    new = np.zeros(len(at), bool)
    new[0] = True
    for j in range(k):
        word = t.names[at + j]
        new[1:] |= word[1:] != word[:-1]
    first = np.flatnonzero(new)
    words = np.column_stack([t.names[at[first] + j] for j in range(k)])
    n = len(t.names)
    before = np.where((at > 0) & t.joined[at - 1], t.names[at - 1], U64(0))
    behind = np.where(t.joined[at + k - 1], t.names[np.minimum(at + k, n - 1)], U64(0))
    sides = [np.where((lo := np.minimum.reduceat(x, first)) == np.maximum.reduceat(x, first), lo, U64(0)) for x in (before, behind)]
    rows = len(first)
    lists = pa.ListArray.from_arrays(np.arange(rows + 1, dtype=np.int32) * k, words.reshape(-1).view(np.int64))
    return pa.RecordBatch.from_arrays([lists, pa.array(np.diff(np.append(first, len(at)))), *[pa.array(s.view(np.int64)) for s in sides]],
                                      names=["p", "n", "before", "behind"])


def _floor(a: str, n: str, by: str) -> Column:
    """floor(1000 * a * n / by), exact for counts of any size."""
    wide = lambda x: f"cast({x} as decimal(20,0))"
    return F.expr(f"({wide(a)} * {wide(n)} * 1000) div ({' * '.join(map(wide, by.split('*')))})")


def _layers(words: DataFrame) -> DataFrame:
    """``words(lang, f, ...)`` with ``layer``: 0 for the rarest words, which have the highest bounds. Layers
    end at steps of a quarter octave, so only few rows a language go through one window."""
    step = F.floor(F.log2("f") * 4).cast("int")
    steps = words.groupBy("lang", step.alias("step")).agg(F.sum("f").alias("f"))
    lang = Window.partitionBy("lang")
    before = F.sum("f").over(lang.orderBy("step")) - F.col("f")
    share = before / F.sum("f").over(lang)
    layer = sum((F.when(share >= x, 1).otherwise(0) for x in LAYERS), F.lit(0))
    return words.withColumn("step", step).join(steps.select("lang", "step", layer.alias("layer")), ["lang", "step"]).drop("step")


class Search:
    """The rounds of the search; every table between two jobs is written to the shared folder."""

    def __init__(self, docs: DataFrame, lang: str, text: str, least: int, longest: int, limit: int):
        self.docs = docs.select(F.col(f"`{text}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"))
        self.least, self.longest, self.limit = least, longest, limit
        words, self.shared = _vocabulary(self.docs, least, [])
        totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
        frequent = words.where(F.col("f") >= least)
        self.words = materialize(_layers(frequent).join(totals, "lang").select(
            F.array("name").alias("p"), "name", "lang", "f", "n", "layer"))
        self.bounds = materialize(self.words.groupBy("lang", "layer").agg(F.min("f").alias("f"), F.max("n").alias("n")))
        self.frequent = phrases_bitmap(self.words)
        self.open: Bitmap | None = None
        self.scored: DataFrame | None = None

    def count(self, starts: DataFrame, asked: list[tuple[int, int]]) -> DataFrame:
        return _count(self.docs, self.shared, self.open, self.frequent, phrases_bitmap(starts), asked, self.least)

    def worst(self) -> DataFrame:
        """(lang, worst): the score at place ``limit``, for languages that have so many."""
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score")))
        top = self.scored.select("lang", "score", place.alias("place")).where(F.col("place") <= self.limit)
        return top.groupBy("lang").agg(F.min("score").alias("worst"), F.max("place").alias("place")).where(F.col("place") == self.limit).drop("place")

    def grow(self, active: DataFrame) -> DataFrame:
        """All candidates that begin with an active word and whose prefixes' bounds reach ``worst``, with
        language, count of their first word and number of words of the language."""
        first = active.select("name", "lang", "f", "n", "worst")
        prefixes, out = active.select("p"), None
        # the last step sends longer phrases on together: what is still frequent then is little
        steps = [(k,) for k in range(2, min(4, self.longest + 1))] + ([tuple(range(4, self.longest + 1))] if self.longest > 3 else [])
        for lengths in steps:
            grown = self.count(prefixes, [(k, min(lengths) - 1) for k in lengths])
            grown = materialize(grown.join(first, F.element_at("p", 1) == first["name"]).drop("name"))
            prefixes = grown.where(F.size("p") == max(lengths)).where(_floor("a", "n", "a*a") >= F.col("worst")).select("p")
            out = grown if out is None else out.unionByName(grown)
        return out

    def score(self, candidates: DataFrame) -> DataFrame:
        """Survivors among the candidates with their lowest cut."""
        ends = self.words.select(F.col("name").alias("end"), F.col("f").alias("f_end"))
        parts = candidates.select("p", F.col("a").alias("f"))
        kept = candidates.where((F.size("p") == self.longest) | ~F.col("inside")).join(ends, F.element_at("p", -1) == F.col("end")).drop("end")
        # two cuts are known or bounded at once: behind the first and before the last word
        left = parts.select(F.col("p").alias("q"), F.col("f").alias("f_left")).unionByName(
            self.words.select(F.col("p").alias("q"), F.col("f").alias("f_left")))
        kept = kept.withColumn("q", F.expr("slice(p, 1, size(p) - 1)")).join(left, "q").drop("q")
        kept = materialize(kept.where((_floor("n", "1", "f") >= F.col("worst")) & (_floor("a", "n", "f_left*f_end") >= F.col("worst"))))
        rests = kept.where(F.size("p") > 2).select(F.explode(F.expr("transform(sequence(2, size(p) - 1), i -> slice(p, i, 5))")).alias("p")).distinct()
        rests = materialize(rests)
        right = self.words.select(F.col("p").alias("rq"), F.col("f").alias("r"))
        if self.longest > 2:
            right = right.unionByName(self.count(rests, [(k, k) for k in range(2, self.longest)]).join(rests, "p").select(
                F.col("p").alias("rq"), F.col("a").alias("r")))
        cuts = kept.select("p", "lang", "a", "n", F.explode(F.expr(
            "transform(sequence(1, size(p) - 1), i -> struct(i as k, slice(p, 1, i) as q, slice(p, i + 1, 5) as rq))")).alias("c")).select(
            "p", "lang", "a", "n", "c.*")
        cuts = cuts.join(left, "q").withColumnRenamed("f_left", "l").join(right, "rq")
        lowest = F.min(F.struct(_floor("a", "n", "l*r").alias("score"), "k", "l", "r")).alias("cut")
        # a false hit may lack a prefix whose bound was too low, and is then out of the running itself
        found = cuts.groupBy("p", "lang", "a", "n").agg(lowest, F.count("*").alias("cuts")).where("cuts = size(p) - 1")
        return found.select("p", "lang", "a", "n", "cut.l", "cut.r", "cut.score")

    def run(self) -> DataFrame:
        spark = self.docs.sparkSession
        self.scored = spark.createDataFrame([], "p array<bigint>, lang string, a bigint, n bigint, l bigint, r bigint, score bigint")
        worst = spark.createDataFrame([], "lang string, worst bigint")
        for layer in range(len(LAYERS) + 1):
            # a layer's best bound comes from its rarest word; only a score above it settles a language
            open_ = self.bounds.where(F.col("layer") == layer).join(worst, "lang", "left").where(
                F.col("worst").isNull() | (_floor("n", "1", "f") >= F.col("worst"))).select("lang", F.coalesce("worst", F.lit(0)).alias("worst"))
            active = materialize(self.words.where(F.col("layer") == layer).join(open_, "lang"))
            if active.isEmpty():
                continue
            self.open = bitmap(active.select(F.xxhash64("lang")).distinct())
            found = self.scored.unionByName(self.score(self.grow(active)))
            self.scored = materialize(found)
            worst = materialize(self.worst())
        return self.scored


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5, limit: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``limit`` phrases of each language, by score and
    count from high to low, then by the phrase's bytes."""
    if not 2 <= longest <= 5:
        raise ValueError("longest is 2 to 5")
    search = Search(docs, lang, text, least, longest, limit)
    by = [F.desc("score"), F.desc("a")]
    place = F.rank().over(Window.partitionBy("lang").orderBy(*by))
    top = search.run().withColumn("place", place).where(F.col("place") <= limit)
    words = materialize(top.select("*", F.posexplode("p").alias("i", "name")))
    spelt = words.join(_spelt(search.docs, search.shared, words.select(F.array("name").alias("p")).distinct()), "name")
    spelt = spelt.groupBy("p", "lang", "a", "l", "r", "n", "score").agg(F.array_sort(F.collect_list(F.struct("i", "word"))).alias("w"))
    spelt = spelt.withColumn("phrase", F.array_join(F.col("w.word"), " "))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*by, "phrase"))
    return spelt.withColumn("rank", rank.cast("long")).where(F.col("rank") <= limit).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def report(docs: DataFrame) -> DataFrame:
    return collocations(docs)


REPORT_SQL = r"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS d,
                      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS (SELECT lang, d, i, ps[i] AS piece FROM (
             SELECT lang, d, ps, unnest(range(1, len(ps) + 1)) AS i FROM (SELECT lang, d, string_split_regex(t, '[.,;:!?
-
]') AS ps FROM texts))),
words AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
runs AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p FROM (
           SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3), (4), (5)) AS s(k) WHERE len(w) >= k)),
counts AS (SELECT lang, k, p, count(*) AS f FROM runs GROUP BY ALL HAVING count(*) >= 100),
cands AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM counts WHERE k > 1),
inner_ AS (SELECT DISTINCT lang, p FROM (
             SELECT c.lang, c.a, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) AS p FROM cands c WHERE k > 2) x
           JOIN cands USING (lang, p) WHERE x.a >= cands.a),
cuts AS (SELECT lang, p, a, w, k, unnest(range(1, k)) AS j FROM cands WHERE (lang, p) NOT IN (SELECT (lang, p) FROM inner_)),
scored AS (SELECT c.lang, c.p AS phrase, c.a, l.f AS l, r.f AS r, n, c.j,
                  CAST((1000::HUGEINT * c.a * n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
           FROM cuts c JOIN totals USING (lang)
           JOIN counts l ON l.lang = c.lang AND l.p = array_to_string(c.w[1:c.j], ' ')
           JOIN counts r ON r.lang = c.lang AND r.p = array_to_string(c.w[c.j + 1:c.k], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, score FROM ranked WHERE rank <= 2000
"""
