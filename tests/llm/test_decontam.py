import hashlib
import pickle
import re

import pytest

from conftest import words
from gridcast.llm import decontam
from gridcast.llm.textscan import ALNUM, chunks

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(texts, items, width=10):
    out = []
    for t in texts:
        w, hit, found = split(t), set(), set()
        for item, text in items:
            b = split(text)
            k = min(width, len(b))
            for i in range(len(b) - k + 1 if k else 0):
                for j in range(len(w) - k + 1):
                    if w[j:j + k] == b[i:i + k]:
                        hit |= set(range(j, j + k))
                        found.add("" if item is None else str(item))
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.fixture(scope="module")
def case(spark, make, odd):
    item = words(9, 30)
    texts = odd[:10] + ["Start " + " ".join(item[:15]).upper() + " stop", " ".join(words(3, 40) + item + words(4, 40)),
                        " ".join(item[:9]), "so it goes", "so, it-goes " + " ".join(item[5:17]) + " ".join(item[5:17])]
    items = [(1, " ".join(item)), (20, " ".join(item[8:28])), (3, "So it goes!"), (4, None), (5, ""), (None, "a b c d"),
             (1, " ".join(item)), (7, "one")]
    return texts, items, make(texts), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("max_chars", [8_000_000, 150])
def test_marks_like_brute_force(case, max_chars):
    texts, items, docs, bench = case
    got = {r.doc_id: r for r in decontam.scan(docs, bench, only=["doc_id"], max_chars=max_chars).collect()} if max_chars > 1000 else {
        r.doc_id: r for r in decontam.scan(docs, bench, only=["doc_id", "text"], max_chars=max_chars).collect()}
    for i, (n, hits, found) in enumerate(brute(texts, items)):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (n, hits, found), i


def test_report_digest(case):
    texts, items, docs, bench = case
    for r in decontam.report(docs, bench).collect():
        n, hits, found = brute([texts[r.doc_id]], items)[0]
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest() and r.contaminated == (hits > 0)


def test_removal_keeps_columns_and_clean_rows(case):
    texts, items, docs, bench = case
    hit = {i for i, (_, h, _) in enumerate(brute(texts, items)) if h}
    whole = decontam.decontaminate(docs, bench)
    assert whole.columns == docs.columns and {r.doc_id for r in whole.collect()} == set(range(len(texts))) - hit
    cut = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench, remove="spans").collect()}
    for i, t in enumerate(texts):
        assert cut[i] == t if i not in hit else brute([cut[i]], items)[0][1] == 0
    assert cut[13] == ""


def test_empty_tables(case, spark):
    _, _, docs, bench = case
    assert decontam.scan(docs.limit(0), bench).collect() == []
    assert all(r.n_hit == 0 for r in decontam.scan(docs, bench.limit(0)).collect())


def test_a_task_holds_little():
    """Windows of ten lengths in a few MB, and texts half a MB at a time."""
    items = [(str(n), " ".join(f"w{n}x{i}" for i in range(n)).encode()) for n in range(1, 12)]
    assert len(pickle.dumps(decontam.Windows(items, 10))) < 8_000_000
    texts = [b"one two three " * 3000] * 70  # 3 MB
    found = list(chunks(texts, ALNUM))
    assert max(len(c.bytes) for c in found) <= 1 << 19 and sum(c.count for c in found) == 70
