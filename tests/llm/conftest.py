import random

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, n_words long, items string, "
        "node string, key string, n string, stats string, found_n_hit long")


def words(seed: int, n: int, stock: int = 4000) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéü") for _ in range(3 + r.randrange(stock) % 6)) for _ in range(n)]


@pytest.fixture(scope="session")
def make(spark):
    """A documents table from texts, with null ids, null texts and columns whose names clash."""

    def build(texts, ids=None, source="s"):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", source if isinstance(source, str) or source is None else source[k], len(t or ""), 7, "x", "y", "z",
                 "w", "v", 3) for k, (i, t) in enumerate(zip(ids, texts))]
        return spark.createDataFrame(rows, DOCS)

    return build


@pytest.fixture(scope="session")
def odd():
    """Texts that break careless code: null, empty, blank, one word, repeats, a very long one."""
    base = " ".join(words(1, 120))
    return [None, "", " \n\t ", "one", base, base, base.upper(), base + " end", "a b c d", "é " * 30, " ".join(words(2, 60_000)),
            "x" * 300_000, "\x00 \x85 odd blank", base.replace(" ", "\n", 40)]
