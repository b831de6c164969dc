"""The word scanner and its hashes against plain Python."""

import random
import re

import numpy as np

from gridcast.llm import textscan as ts

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def texts():
    r = random.Random(5)
    stock = "abcXYZ019 \n\t.,-'é ßİ!"
    return ["".join(r.choice(stock) for _ in range(r.randrange(80))) for _ in range(300)] + ["", "a" * 5000, " " * 5000]


def test_words_are_those_of_the_patterns():
    raw = [t.encode() for t in texts()]
    for table, pattern in ((ts.ALNUM, ALNUM), (ts.SPACED, SPACED)):
        for chunk in ts.chunks(raw, table, 700):
            for i in range(chunk.count):
                got = [chunk.raw[s:e].lower() for s, e in zip(chunk.starts[chunk.bounds[i]:chunk.bounds[i + 1]],
                                                              chunk.ends[chunk.bounds[i]:chunk.bounds[i + 1]])]
                assert got == [w.encode() for w in pattern.findall(lower(texts()[chunk.first + i]))]


def test_equal_words_have_equal_hashes_and_others_do_not():
    seen, back = {}, {}
    for chunk in ts.chunks([t.encode() for t in texts()], ts.SPACED, 500):
        for s, e, h in zip(chunk.starts, chunk.ends, chunk.words.tolist()):
            w = chunk.raw[s:e].lower()
            assert seen.setdefault(w, h) == h and back.setdefault(h, w) == w


def test_long_buffers_are_cut_between_words():
    b = np.frombuffer(" ".join(texts()).encode() * 3, np.uint8)
    whole, parts = ts.words_of(b, ts.SPACED, len(b)), ts.words_of(b, ts.SPACED, 64)
    for x, y in zip(whole, parts):
        assert (x == y).all()


def test_runs_stay_inside_a_text():
    chunk = next(ts.chunks([b"a b c", b"b c", b"a b c d"], ts.SPACED))
    hashes, at = chunk.runs(3)
    assert at.tolist() == [0, 5, 6] and hashes[0] == hashes[1] != hashes[2]


def test_a_word_of_many_pieces():
    b = np.frombuffer(b"ab " + b"X" * 4000 + b" ab " + b"x" * 4000 + b" cd", np.uint8)
    whole, parts = ts.words_of(b, ts.SPACED, len(b)), ts.words_of(b, ts.SPACED, 100)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    for w in (whole[2], parts[2]):
        assert w[0] == w[2] and w[1] == w[3] and len(set(w.tolist())) == 3
