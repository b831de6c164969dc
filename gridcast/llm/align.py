"""Alignment of two tokenizers over the same bytes, and how often their ids meet.

A text is encoded by a byte-level BPE (A, with a blank in front) and by a piece model with byte fallback
(B, which puts the blank there itself). Byte offsets where tokens of both end cut them into groups;
tokens of A and B whose bytes overlap are linked; a pair of ids counts the documents that hold it linked.

Both encoders start anew at a blank between a non-blank and an ASCII graph character: the split pattern
of A ends a piece there, and no piece of B has its blank sign behind another character (checked when the
files are read). So texts are cut there, and each distinct cut-out is encoded and aligned once and kept,
up to a bounded number.

Counting: a table from each A id to the B id of the same bytes is made from the vocabularies. Pairs of
this identity map, nearly all of which come from one-to-one groups, are counted in a vector as long as
the vocabulary, one per task; only irregular pairs, summed up in the task first, are shuffled. For the
documents' own figures the identity counts and each A id's highest count go to the tasks as vectors, and
with them the most frequent irregular pairs, at most ``known_pairs``; rarer pairs are joined.

Defined cases: a text that is null or empty, or whose joined token bytes of A or B differ from blank and
text (a literal U+2581, say), has no tokens; rows that repeat a key are documents each for themselves;
input columns whose name is also a new column are replaced; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import add_columns, materialize
from gridcast.llm.tokens import read_vocabulary

#: The public vocabulary files.
VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"  # how B writes a blank
SIGN = BLANK.encode()

CUT = re.compile(rb"(?<=[^ ]) (?=[!-~])")
WHOLE = re.compile(rb"(?!)")
KEPT_UNITS = 200_000      # cut-outs a worker remembers
LONGEST_KEPT = 256        # bytes of the longest cut-out it remembers
AT_ONCE = 4096            # cut-outs encoded by one call
GROUP = 2 << 20           # bytes of text whose cut-outs are looked up together
BUFFER = 1 << 22          # ids summed up at once when pairs are counted


def _byte_signs() -> dict[str, int]:
    """The sign that byte-level vocabularies write for each byte: printable bytes stand for themselves,
    the others, in order, for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Vocabularies:
    """Both encoders, the bytes of their tokens, and the identity map from A ids to B ids."""

    def __init__(self, a: bytes, b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.a = Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        signs = _byte_signs()
        entries = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            if all(c in signs for c in entry):
                self.bytes_a[i] = bytes(signs[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i)
                        else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.sizes_a = np.array(list(map(len, self.bytes_a)), np.int64)
        self.sizes_b = np.array(list(map(len, self.bytes_b)), np.int64)
        self.n_a, self.n_b = len(self.bytes_a), len(self.bytes_b)
        self.cut = WHOLE if any(BLANK in p.lstrip(BLANK) for p in pieces) else CUT
        ids_b: dict[bytes, int] = {}
        for i, x in enumerate(self.bytes_b):
            if x and (x not in ids_b or self.b.is_byte(ids_b[x])):  # a piece comes before a fallback byte
                ids_b[x] = i
        self.same = np.array([ids_b.get(x, -1) if x else -1 for x in self.bytes_a], np.int64)
        widest = len(str(max(self.n_a, self.n_b)))
        written = np.array([b"%d" % i for i in range(max(self.n_a, self.n_b))], f"S{widest}")
        self.digits, self.n_digits = written.view(np.uint8).reshape(-1, widest), np.char.str_len(written)
        self.dtype = np.dtype("<u4" if self.n_a * self.n_b < 1 << 32 else "<u8")

    def is_same(self, codes: np.ndarray) -> np.ndarray:
        """Which pairs belong to the identity map."""
        return self.same[codes // self.n_b] == codes % self.n_b


class Aligner:
    """Cut-outs with their alignment; a pair of ids is the number a * n_b + b."""

    def __init__(self, v: Vocabularies):
        self.v = v
        self._clear()

    def _clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.groups: list[bytes] = []
        self.figures = np.empty((0, 4), np.int64)  # A tokens (-1: bytes differ), B tokens, groups, links
        self.codes = np.empty(0, self.v.dtype)
        self.first = np.empty(0, np.int64)

    def learn(self, parts: list[bytes]) -> None:
        """Encode and align cut-outs that are not known yet. Those that begin and end like words are
        encoded side by side by one call; the others, and all of a call that gives other bytes, alone."""
        plain = [p for p in parts if p and 32 < p[0] < 127 and p[-1] != 32 and SIGN not in p]
        many = set(plain)
        for at in range(0, len(plain), AT_ONCE):
            some = plain[at:at + AT_ONCE]
            if not self._learn(some):
                many.difference_update(some)
        for p in parts:
            if p not in many and not self._learn([p]):
                self._add([p], np.array([[-1, 0, 0, 0]]), np.zeros(1, np.int64), np.empty(0, self.v.dtype), [b""])

    def _learn(self, parts: list[bytes]) -> bool:
        """Whether the tokens of both encoders have the bytes of the given cut-outs."""
        whole, v = b" " + b" ".join(parts), self.v
        text = whole.decode("utf-8", "replace")
        a = np.array(v.a.encode(text, add_special_tokens=False).ids, np.int64)
        b = np.array(v.b.encode(text[1:]), np.int64)
        if b"".join([v.bytes_a[i] for i in a.tolist()]) != whole or b"".join([v.bytes_b[i] for i in b.tolist()]) != whole:
            return False
        ends_a, ends_b = np.cumsum(v.sizes_a[a]), np.cumsum(v.sizes_b[b])
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        low = np.searchsorted(ends_b, ends_a - v.sizes_a[a], side="right")   # first token of B that overlaps
        high = np.searchsorted(ends_b - v.sizes_b[b], ends_a, side="left")   # behind the last one
        links = high - low
        codes = np.repeat(a, links) * v.n_b + b[np.repeat(low - (np.cumsum(links) - links), links) + np.arange(int(links.sum()))]
        # how many tokens, groups and links lie up to each cut-out's end
        to_a, to_b, to_group = (np.searchsorted(x, ends, side="right") for x in (ends_a, ends_b, common))
        to_link = np.concatenate(([0], np.cumsum(links)))[to_a]
        figures = np.column_stack([np.diff(x, prepend=0) for x in (to_a, to_b, to_group, to_link)])
        # ids in the order they are written, each with the sign behind it
        last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
        order = np.argsort(np.concatenate((group_a * 2, group_b * 2 + 1)), kind="stable")
        ids = np.concatenate((a, b))[order]
        signs = np.concatenate((np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))))[order]
        digits, size = v.digits[ids], v.n_digits[ids]
        rows = np.concatenate((digits, signs.astype(np.uint8)[:, None]), axis=1)
        keep = np.arange(rows.shape[1]) < size[:, None]
        keep[:, -1] = True
        written = rows[keep].tobytes()
        stops = np.concatenate(([0], np.cumsum(size + 1)[to_a + to_b - 1])).tolist()
        self._add(parts, figures, to_link - figures[:, 3], codes.astype(v.dtype), [written[s:e - 1] for s, e in zip(stops, stops[1:])])
        return True

    def _add(self, parts: list[bytes], figures: np.ndarray, first: np.ndarray, codes: np.ndarray, groups: list[bytes]) -> None:
        n, size = len(self.groups), len(self.codes)
        self.number.update(zip(parts, range(n, n + len(parts))))
        self.groups += groups
        self.first = np.concatenate((self.first, size + first))
        self.codes = np.concatenate((self.codes, codes))
        self.figures = np.concatenate((self.figures, figures))

    def align(self, texts: list[bytes]) -> Iterator[tuple[list[int], bytes, np.ndarray, np.ndarray]]:
        """Per text: the four figures, the groups as written, the distinct pairs and their numbers of links."""
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= GROUP):
                size += len(texts[stop])
                stop += 1
            parts = [self.v.cut.split(t) if t else [] for t in texts[at:stop]]
            new = list(dict.fromkeys(p for x in parts for p in x if p not in self.number))
            long = [p for p in new if len(p) > LONGEST_KEPT]
            self.learn([p for p in new if len(p) <= LONGEST_KEPT])
            kept, n_codes = len(self.groups), len(self.codes)
            self.learn(long)
            for x in parts:
                yield self._text([self.number[p] for p in x])
            for p in long:  # long ones are forgotten
                del self.number[p]
            if kept > KEPT_UNITS:  # those met first are mostly the frequent ones, and stay
                kept = KEPT_UNITS // 2
                n_codes = int(self.first[kept])
                self.number = {p: i for p, i in self.number.items() if i < kept}
            del self.groups[kept:]
            self.figures, self.codes, self.first = self.figures[:kept], self.codes[:n_codes], self.first[:kept]
            at = stop

    def _text(self, units: list[int]) -> tuple[list[int], bytes, np.ndarray, np.ndarray]:
        which = np.array(units, np.int64)
        figures = self.figures[which]
        if not units or figures[:, 0].min() < 0:
            return [0, 0, 0, 0], b"", np.empty(0, self.v.dtype), np.empty(0, "<u4")
        n = figures[:, 3]
        total = int(n.sum())
        codes = self.codes[np.repeat(self.first[which] - (np.cumsum(n) - n), n) + np.arange(total)]
        codes, times = np.unique(codes, return_counts=True)
        return figures.sum(axis=0).tolist(), b";".join([self.groups[i] for i in units]), codes, times.astype("<u4")


@lru_cache(maxsize=2)
def _vocabularies(a: bytes, b: bytes) -> Vocabularies:
    return Vocabularies(a, b)


@lru_cache(maxsize=1)
def _aligner(a: bytes, b: bytes) -> Aligner:
    return Aligner(_vocabularies(a, b))


FIELDS = [("n_a", "bigint"), ("n_b", "bigint"), ("n_groups", "bigint"), ("n_links", "bigint"), ("groups", "string"),
          ("pairs", "binary"), ("times", "binary")]


def _files(df: DataFrame, a: str, b: str):
    return df.sparkSession.sparkContext.broadcast((read_vocabulary(a), read_vocabulary(b)))


def align(docs: DataFrame, text: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
          digest: bool = False, only: list[str] | None = None) -> DataFrame:
    """``docs`` with the tokens of A and B, groups, links, the groups written as ``a1,a2|b1;a3|b2,b3`` (or
    with ``digest`` their SHA-256 in hex; empty without tokens), and the distinct linked pairs
    (a * size of B + b, as little-endian integers) with their numbers of links. One scan, no shuffle."""
    files = _files(docs, vocabulary_a, vocabulary_b)

    def rows(texts: list[bytes], _) -> list[list]:
        out: list[list] = [[] for _ in FIELDS]
        for figures, groups, codes, times in _aligner(*files.value).align(texts):
            for column, value in zip(out, [*figures, (hashlib.sha256(groups).hexdigest() if digest and groups else groups.decode()),
                                           codes.tobytes(), times.tobytes()]):
                column.append(value)
        return out

    return add_columns(docs, text, FIELDS, rows, only=only, at_once=GROUP)


def count_pairs(aligned: DataFrame, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """(pair, n_docs) of the ``pairs`` of aligned documents, with ``same`` for pairs of the identity map."""
    files = _files(aligned, vocabulary_a, vocabulary_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabularies(*files.value)
        fixed = np.zeros(v.n_a, np.int64)
        held, size = [], 0

        def irregular() -> pa.RecordBatch:
            codes = np.concatenate(held).astype(np.int64)
            same = v.is_same(codes)
            fixed[:] += np.bincount(codes[same] // v.n_b, minlength=v.n_a)
            codes, n = np.unique(codes[~same], return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(n.astype(np.int64)), pa.array(np.zeros(len(codes), bool))],
                                              names=["pair", "n", "same"])

        for batch in batches:
            for x in batch.column(0):
                held.append(np.frombuffer(x.as_py(), v.dtype))
                size += len(held[-1])
                if size >= BUFFER:
                    yield irregular()
                    held, size = [], 0
        if held:
            yield irregular()
        a = np.flatnonzero(fixed)
        yield pa.RecordBatch.from_arrays([pa.array(a * v.n_b + v.same[a]), pa.array(fixed[a]), pa.array(np.ones(len(a), bool))],
                                         names=["pair", "n", "same"])

    parts = aligned.select("pairs").where(F.octet_length("pairs") > 0).mapInArrow(run, "pair bigint, n bigint, same boolean")
    return parts.groupBy("pair", "same").agg(F.sum("n").alias("n_docs")).select("pair", "n_docs", "same")


def translations(docs: DataFrame, text: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B) -> DataFrame:
    """For every A id that occurs: the B ids it is most often linked with (ties included) and in how many documents."""
    v = Vocabularies(read_vocabulary(vocabulary_a), read_vocabulary(vocabulary_b))
    pairs = count_pairs(materialize(align(docs, text, vocabulary_a, vocabulary_b, digest=True, only=[])), vocabulary_a, vocabulary_b)
    ids = pairs.select(F.expr(f"pair div {v.n_b}").alias("a"), F.expr(f"pair % {v.n_b}").alias("b"), "n_docs", "same")
    top = ids.groupBy("a").agg(F.max("n_docs").alias("n_docs"))
    return ids.join(top, ["a", "n_docs"]).select("a", "b", "n_docs", "same")


def _threshold(pairs: DataFrame, known_pairs: int) -> tuple[int, bool]:
    """The smallest count such that no more than ``known_pairs`` irregular pairs have it or more, up to
    steps of an eighth of an octave, and whether that leaves any pair out."""
    step = F.floor(F.log2("n_docs") * 8).cast("int")
    classes = pairs.where("not same").groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("n_docs").alias("least")).collect()
    total, least = 0, 1 << 62
    for c in sorted(classes, key=lambda c: -c.step):
        if total + c.n > known_pairs:
            return least, True
        total, least = total + c.n, c.least
    return least, False


def _column(df: DataFrame, *names: str) -> list[np.ndarray]:
    rows = df.select(*names).toArrow()
    return [rows.column(n).to_numpy() for n in names]


def scores(docs: DataFrame, text: str = "text", vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
           known_pairs: int = 1 << 21, only: list[str] | None = None) -> DataFrame:
    """``docs`` with tokens, groups and links (see ``align``, the groups as digest ``groups_sha256``), ``n_best``
    (links whose pair is one of its A id's most frequent) and ``count_sum`` (the pairs' counts over all links)."""
    spark = docs.sparkSession
    carried = [c for c in (docs.columns if only is None else only)
               if c.lower() not in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")]
    safe = docs.select(*[F.col(f"`{c}`").alias(f"in_{i}_") for i, c in enumerate(carried)],
                       F.col(f"`{text}`").cast("string").alias("text_"), F.monotonically_increasing_id().alias("row_"))
    mine = [f"in_{i}_" for i in range(len(carried))]
    aligned = materialize(align(safe, "text_", vocabulary_a, vocabulary_b, digest=True, only=[*mine, "row_"]))
    pairs = materialize(count_pairs(aligned, vocabulary_a, vocabulary_b))
    v = Vocabularies(read_vocabulary(vocabulary_a), read_vocabulary(vocabulary_b))
    n_b, dtype = v.n_b, v.dtype
    # two vectors as long as the vocabulary of A
    fixed, best = np.zeros(v.n_a, np.int64), np.zeros(v.n_a, np.int64)
    code, n = _column(pairs.where("same"), "pair", "n_docs")
    fixed[code // n_b] = n
    a, n = _column(pairs.groupBy(F.expr(f"pair div {n_b}").alias("a")).agg(F.max("n_docs").alias("n")), "a", "n")
    best[a] = n
    least, rare = _threshold(pairs, known_pairs)
    known, n = _column(pairs.where(~F.col("same") & (F.col("n_docs") >= least)), "pair", "n_docs")
    order = np.argsort(known)
    shared = spark.sparkContext.broadcast((fixed, best, v.same, known[order], n[order]))
    names = [*mine, "row_", "n_a", "n_b", "n_groups", "n_links", "groups"]
    new = "n_best bigint, count_sum bigint, rest array<struct<pair:bigint,times:bigint,best:bigint>>"
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in aligned.select(names).schema.fields) + ", " + new

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fixed, best, same, known, n_known = shared.value
        for batch in batches:
            k = batch.num_columns - 2
            out: list[list] = [[], [], []]
            for x, t in zip(batch.column(k).to_pylist(), batch.column(k + 1).to_pylist()):
                codes, times = np.frombuffer(x, dtype).astype(np.int64), np.frombuffer(t, "<u4").astype(np.int64)
                a = codes // n_b
                count = np.where(same[a] == codes % n_b, fixed[a], 0)
                if len(known):
                    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
                    count = np.where((count == 0) & (known[at] == codes), n_known[at], count)
                out[0].append(int(times[(count == best[a]) & (count > 0)].sum()))
                out[1].append(int((times * count).sum()))
                out[2].append([{"pair": p, "times": q, "best": r} for p, q, r in zip(
                    codes[count == 0].tolist(), times[count == 0].tolist(), best[a[count == 0]].tolist())])
            arrays = [batch.column(i) for i in range(k)] + [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(
                out[2], pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64()), ("best", pa.int64())])))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:k], "n_best", "count_sum", "rest"])

    found = aligned.select(*names, "pairs", "times").mapInArrow(run, schema)
    if rare:
        found = materialize(found)
        late = found.select("row_", F.explode("rest").alias("r")).select("row_", "r.*")
        late = late.join(pairs.select("pair", "n_docs"), "pair").groupBy("row_").agg(
            F.sum(F.when(F.col("n_docs") == F.col("best"), F.col("times")).otherwise(0)).alias("late_best_"),
            F.sum(F.col("times") * F.col("n_docs")).alias("late_sum_"))
        found = found.join(late, "row_", "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("late_best_", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("late_sum_", F.lit(0))})
    return found.select(*[F.col(m).alias(c) for m, c in zip(mine, carried)], "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                        F.col("groups").alias("groups_sha256"))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: tokens, groups, links, and how its pairs stand in the whole corpus."""
    return scores(docs, only=["doc_id"])
