import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridcast.llm import langid

EN, DE = "the cat and the dog that was there with this ", "der hund und die katze das ist nicht auch ein "


@pytest.fixture(scope="module")
def case(spark):
    docs = [(0, EN * 20, "en"), (1, DE * 20, "de"), (2, None, "en"), (3, "", "fr"), (4, "text", None)]
    page = "<html lang='{}'><script>{}</script><body><p>{}</p><!-- {} --></body></html>"
    pages = [(i, f"https://www.a.example/{i}", page.format("EN-us", DE, EN * 2, DE)) for i in range(6)]
    pages += [(10 + i, f"http://b.example:80/{i}", page.format("de", EN, DE * 2, EN)) for i in range(4)]
    pages += [(20, "http://b.example/", "<p>a</p>"), (21, "http://www.a.example/x", page.format("en", "", "", "")),
              (22, None, None), (23, "nonsense", ""), (24, "http://user@c.other/", "<html><p>" + EN), (None, "http://c.other", DE),
              (3, "https://www.a.example/3", "x" * 100_000)]
    return (spark.createDataFrame(docs, "doc_id long, text string, lang string"),
            spark.createDataFrame([(*p, "k", "v") for p in pages], "page_id long, url string, html string, key string, vote string"), docs, pages)


def brute(docs, pages):
    langs = sorted({x for _, t, x in docs if t and x})
    table = {}
    for x in langs:
        n = Counter(c for _, t, y in docs if y == x and t for c in langid.cells(t.encode()).tolist())
        total = sum(n.values()) + langid.SMOOTH * langid.CELLS
        table[x] = (n, total)
    rows = []
    for key, url, m in pages:
        m = (m or "").encode()
        at = langid.cells(langid.visible(m)).tolist()
        weight = langid.STRENGTH / (len(at) + langid.STRENGTH)
        text = [weight * sum(math.log((table[x][0][c] + langid.SMOOTH) / table[x][1]) for c in at) for x in langs]
        host = url.split("://")[1].split("/")[0].split("@")[-1].split(":")[0] if url and "://" in url else None
        domain = ".".join(host.split(".")[-2:]) if host else None
        rows.append((key, host, domain, host.split(".")[-1] if host else None, langid.declared(m), text, int(np.argmax(text)) if at else None))
    votes = {c: defaultdict(Counter) for c in (1, 2, 3, 4)}
    for r in rows:
        for c in votes:
            if r[c] is not None and r[6] is not None:
                votes[c][r[c]][r[6]] += 1
    every = Counter(r[6] for r in rows if r[6] is not None)
    out = []
    for r in rows:
        z = []
        for i in range(len(langs)):
            overall = (every[i] + langid.SMOOTH) / (sum(every.values()) + langid.SMOOTH * len(langs))
            v = votes[2].get(r[2], Counter())
            near = (v[i] + langid.PULL * overall) / (sum(v.values()) + langid.PULL)
            v = Counter(votes[1].get(r[1], Counter()))
            if r[1] is not None and r[6] is not None:
                v[r[6]] -= 1
            prior = (v[i] + langid.PULL * near) / (sum(v.values()) + langid.PULL)
            score = r[5][i] + math.log(prior)
            for c in (3, 4):
                if r[c] in votes[c]:
                    score += math.log((votes[c][r[c]][i] + langid.SMOOTH) / (sum(x[i] for x in votes[c].values())
                                                                           + langid.SMOOTH * (len(votes[c]) + 1)))
            z.append(score)
        p = np.exp(np.array(z) - max(z))
        out.append((str(r[0]), str(r[1]), str(r[4]), langs[int(np.argmax(z))], round(float(1 / p.sum()), 4)))
    return sorted(out)


def test_fuses_like_the_formula(case):
    docs, pages, d, p = case
    got = langid.report(pages, docs).collect()
    assert sorted((str(r.page_id), str(r.host), str(r.declared), r.language, round(r.probability, 4)) for r in got) == brute(d, p)
    by = {r.page_id: r.language for r in got if r.page_id is not None}
    assert by[0] == by[21] == "en" and by[10] == by[20] == "de"


def test_no_languages_and_no_pages(case):
    docs, pages, *_ = case
    assert {r.language for r in langid.report(pages, docs.limit(0)).collect()} == {None}
    assert langid.report(pages.limit(0), docs).collect() == []


def test_too_many_languages_are_refused(case):
    docs, pages, *_ = case
    with pytest.raises(ValueError):
        langid.identify(pages, docs, most_languages=1)


def test_empty_pages_change_no_other_page(spark, case):
    docs, pages, *_ = case
    empty = spark.createDataFrame([(100 + i, "http://b.example/", "<html lang='zz'><p></p>", "k", "v") for i in range(50)], pages.schema)
    before = {(r.page_id, r.host): (r.language, r.probability) for r in langid.report(pages, docs).collect()}
    after = langid.report(pages.unionByName(empty), docs).collect()
    assert {(r.page_id, r.host): (r.language, r.probability) for r in after if (r.page_id or 0) < 100} == before
    assert {r.text_language for r in after if (r.page_id or 0) >= 100} == {None} and {r.language for r in after if (r.page_id or 0) >= 100} == {"de"}
