"""Secret scan against Python's regular expressions and windows counted one by one."""

import math
import random
import re
from collections import Counter
from hashlib import sha256

import pytest

from gridcast.llm import secret_scan as S

BASE = [("assign", r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
        ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16)]


def base_spans(text):
    out = []
    for k, (name, pattern, group, least) in enumerate(BASE):
        out += [(m.start(), k, m.end(), name) for m in re.finditer(pattern, text) if len(m.group(group)) >= least]
    return sorted(out)


def entropy_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        c = m.group()
        if re.search("^(?:" + "|".join(f"(?:{a})" for a in S.ALLOWED) + ")$", c):
            continue
        name, _, bits = next(x for x in S.CLASSES if re.search(x[1], c))
        spans = []
        for i in range(len(c) - S.WINDOW + 1):
            n = Counter(c[i:i + S.WINDOW])
            if math.log2(S.WINDOW) - sum(v * math.log2(v) for v in n.values()) / S.WINDOW >= bits:
                s = m.start() + i
                if spans and spans[-1][1] >= s:
                    spans[-1][1] = s + S.WINDOW
                else:
                    spans.append([s, s + S.WINDOW])
        k = len(S.PATTERNS) + [x[0] for x in S.CLASSES].index(name)
        out += [(s, k, e, name) for s, e in spans]
    return out


def expected(text):
    text = text or ""
    base = base_spans(text)
    write = lambda spans: ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(spans))
    n = Counter(x[3] for x in base)
    return n["assign"], n["access"], n["hex"], sha256(write(base).encode()).hexdigest(), write(base + entropy_spans(text))


def sample(r, alphabet, n):
    return "".join(r.choice(alphabet) for _ in range(n))


B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


@pytest.fixture(scope="module")
def texts(odd):
    r = random.Random(5)
    mixed = [" ".join(r.choice([sample(r, B64, 30), sample(r, "0123456789abcdef", r.randrange(10, 50)), "token", "Passwd", "=", ":",
                                "é\U0001f600", "AKIA" + sample(r, "AZ09", r.randrange(10, 20)), sample(r, "ab", 60), "word"])
                      for _ in range(r.randrange(1, 60))) for _ in range(40)]
    return odd + mixed + [
        "secret=my_token = abcdefghijklmnop", "x passwd:'hunter2' token=\"" + sample(r, B64, 12), "API_KEY = = x", "AKIAAKIA" + "Z" * 20,
        "AKIA", "id 123e4567-e89b-12d3-a456-426614174000", "some-long-hyphenated-words-in-a-row", "xxEXAMPLE" + sample(r, B64, 30),
        "é" * 50 + " token: " + sample(r, B64, 40), sample(r, B64, 30) + "=" * 40 + sample(r, B64, 30),
        sample(r, B64, 3 * S.STRETCH + 7), ("a" * 25 + sample(r, B64, 30)) * 200, "token=x " * 3000 + "token=" + "k" * 12]


def test_against_brute_force(spark, make, texts):
    ids = [None if i == 2 else i % 60 for i in range(len(texts))]
    rows = S.report(make(texts, ids)).collect()
    got = sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in rows)
    assert got == sorted((str(i), *expected(t)) for i, t in zip(ids, texts))
    assert sum(r.n_assign for r in rows) > 3 and any("entropy_mixed" in r.spans for r in rows)
    assert S.report(make([])).collect() == []


def test_steps_and_blocks_do_not_matter(spark, make, texts, monkeypatch):
    docs = make([t for t in texts if t is None or len(t) < 20_000])
    whole = S.report(docs).collect()
    monkeypatch.setattr(S, "STRETCH", 7)
    monkeypatch.setattr(S, "BLOCK", 3)
    assert S.report(docs).collect() == whole


def test_native_plan_and_other_columns(spark, make, texts):
    docs = make(texts)
    plan = S.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and not re.search("Python|Arrow|Pandas", plan)
    out = S.scan(docs.withColumn("Pattern_Spans", docs.n))
    assert out.columns == docs.columns + ["pattern_spans", "entropy_spans"]


def test_redacted_texts_have_the_length_and_no_span(spark, make, texts):
    docs = make(texts)
    out = S.redact(docs)
    assert out.columns == docs.columns
    for r, t in zip(out.collect(), texts):
        if t is None:
            assert r.text is None
            continue
        gone = {p for s, _, e, _ in base_spans(t) + entropy_spans(t) for p in range(s, e)}
        assert r.text == "".join("*" if i in gone else c for i, c in enumerate(t))
