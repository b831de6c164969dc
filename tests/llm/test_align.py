"""Tokenizer alignment against whole texts encoded and compared byte by byte."""

from collections import Counter, defaultdict
from hashlib import sha256

import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import words
from gridcast.llm import align as A
from gridcast.llm.common import table


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(A.VOCABULARY_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=A.VOCABULARY_B)


@pytest.fixture(scope="module")
def texts(odd):
    long = " ".join(words(3, 3000)) + "  " + " , ".join(words(4, 500))
    return odd + [long, "a ▁ b", " leading", "two  blanks", "trailing  ", "\t tab \n a", "don't we'll", "<|endoftext|> <s> <0x41>", "日本 語 text",
                  "\U0001f600 smile", "é <unk> x", "12 34,56 .. !?", "x" * 5000] + [" ".join(words(i, 10 + 37 * i % 300)) for i in range(30)]


def byte_table():
    plain = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def brute(encoders, text):
    """(a ids, b ids, groups, links) of one text, or None."""
    a, b = encoders
    if not text:
        return None
    signs = byte_table()
    ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ba = [bytes(signs[c] for c in a.id_to_token(i)) for i in ia]
    bb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
    whole = (" " + text).encode()
    if b"".join(ba) != whole or b"".join(bb) != whole:
        return None
    spans = lambda parts: [(sum_ - len(p), sum_) for p, sum_ in zip(parts, running(parts))]
    sa, sb = spans(ba), spans(bb)
    links, j = [], 0
    for i, (s, e) in enumerate(sa):
        while sb[j][1] <= s:
            j += 1
        k = j
        while k < len(sb) and sb[k][0] < e:
            links.append((ia[i], ib[k]))
            k += 1
    common = sorted({e for _, e in sa} & {e for _, e in sb})
    ga, gb, g = defaultdict(list), defaultdict(list), 0
    for out, ids, spans_ in ((ga, ia, sa), (gb, ib, sb)):
        g = 0
        for x, (_, e) in zip(ids, spans_):
            while common[g] < e:
                g += 1
            out[g].append(str(x))
    return ia, ib, ";".join(",".join(ga[g]) + "|" + ",".join(gb[g]) for g in range(len(common))), links, len(common)


def running(parts):
    total = 0
    for p in parts:
        total += len(p)
        yield total


def expected(encoders, ids, texts):
    found = [brute(encoders, t) for t in texts]
    counts = Counter(p for f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = [(str(i), len(f[0]), len(f[1]), f[4], len(f[3]), sum(counts[p] == best[p[0]] for p in f[3]), sum(counts[p] for p in f[3]),
             sha256(f[2].encode()).hexdigest()) if f else (str(i), 0, 0, 0, 0, 0, 0, "") for i, f in zip(ids, found)]
    return sorted(rows), counts


def got(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


@pytest.mark.parametrize("known", [1 << 21, 40, 0])
def test_scores_against_whole_texts(spark, make, encoders, texts, known):
    ids = [None if i == 3 else i % 50 for i in range(len(texts))]
    rows, _ = expected(encoders, ids, texts)
    assert got(A.scores(make(texts, ids), known_pairs=known)) == rows
    assert sum(r[1] == 0 for r in rows) == 3


def test_given_documents(spark, encoders):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.select("doc_id", "text").collect()
    assert got(A.report(docs)) == expected(encoders, [r.doc_id for r in rows], [r.text for r in rows])[0]


def test_groups_pairs_and_translations(spark, make, encoders, texts):
    docs = make(texts)
    _, counts = expected(encoders, range(len(texts)), texts)
    aligned = A.align(docs.withColumn("N_A", docs.n))
    assert aligned.columns == docs.columns + [n for n, _ in A.FIELDS]
    found = [brute(encoders, t) for t in texts]
    assert [r.groups for r in aligned.orderBy("doc_id").collect()] == [f[2] if f else "" for f in found]
    n_b = encoders[1].get_piece_size()
    assert {(r.pair // n_b, r.pair % n_b): r.n_docs for r in A.count_pairs(aligned).collect()} == dict(counts)
    top = defaultdict(int)
    for (a, _), n in counts.items():
        top[a] = max(top[a], n)
    assert {(r.a, r.b, r.n_docs) for r in A.translations(docs).collect()} == {(a, b, n) for (a, b), n in counts.items() if n == top[a]}


def test_small_groups_buffers_and_memory(spark, make, encoders, texts, monkeypatch):
    v = A.Vocabularies(A.read_vocabulary(A.VOCABULARY_A), A.read_vocabulary(A.VOCABULARY_B))
    raw = [(t or "").encode() for t in texts if t is None or len(t) < 50_000]
    whole = [(f, g, c.tolist(), t.tolist()) for f, g, c, t in A.Aligner(v).align(raw)]
    monkeypatch.setattr(A, "GROUP", 300)
    monkeypatch.setattr(A, "KEPT_UNITS", 20)
    assert [(f, g, c.tolist(), t.tolist()) for f, g, c, t in A.Aligner(v).align(raw)] == whole


def test_empty_table(spark, make):
    assert A.report(make([])).collect() == [] and A.report(make([None, ""])).count() == 2
