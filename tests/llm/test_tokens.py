"""Encoding, packing and the separator scan: exact round trips."""

from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import words
from gridcast.llm import packing, separators, tokens

HARD = ["don't  stop", "  two blanks", "tab\t x \n y", "a b 　c", "x " * 50, "12 34,56 .. !?", "日本 語 text", "é è ", " ", "trailing  "]


@pytest.fixture(scope="module")
def bpe():
    return tokens.Encoder(tokens.read_vocabulary(), "<u2")


@pytest.fixture(scope="module")
def case(make, odd):
    texts = odd + HARD + [" ".join(words(i, 10 + 37 * i % 900)) for i in range(60)]
    return texts, make(texts, [None if i == 3 else i for i in range(len(texts))])


def test_same_ids_as_text_by_text(bpe, case):
    texts = [(t or "").encode() for t in case[0]]
    ids, counts = bpe.encode(texts)
    at = 0
    for t, n in zip(texts, counts.tolist()):
        assert ids[at:at + n].tolist() == bpe.bpe.encode_ordinary(t.decode())
        at += n
    long = " ".join(words(3, 2000)) + "  " + " , ".join(words(4, 2000))
    old = tokens.CHUNK, tokens.GROUP
    tokens.CHUNK, tokens.GROUP = 500, 2000
    try:
        assert bpe.encode([long.encode()])[0].tolist() == bpe.bpe.encode_ordinary(long)
    finally:
        tokens.CHUNK, tokens.GROUP = old


@pytest.mark.parametrize("window", [1 << 21, 3000])
def test_packed_rows_give_every_document_back(bpe, case, window):
    texts, docs = case
    got = defaultdict(dict)
    rows = packing.pack(docs.coalesce(3), length=256, window=window).collect()
    assert len({r.pack_id for r in rows}) == len(rows)
    for r in rows:
        ids = packing.id_matrix([r.ids])[0]
        assert len(ids) == 256 and r.cu_seqlens == r.position_resets + [r.n_tokens] and set(ids[r.n_tokens:]) <= {tokens.END_OF_TEXT}
        p = packing.positions(r.cu_seqlens, 256)
        for d, o, s, e in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert p[s:e].tolist() == list(range(e - s)) and o not in got[d]
            got[d][o] = ids[s:e].tolist()
    for i, t in enumerate(texts):
        pieces = got[None if i == 3 else i]
        whole = [x for o in sorted(pieces) for x in pieces[o]]
        assert whole == bpe.bpe.encode_ordinary(t or "") + [tokens.END_OF_TEXT]
    assert packing.pack(docs.limit(0)).collect() == []


def test_best_fit_decreasing_against_a_plain_search():
    r = np.random.default_rng(0)
    for capacity in (7, 64, 100):
        sizes = r.integers(1, capacity + 1, 300)
        room, want = [], []
        for piece in np.argsort(-sizes, kind="stable"):
            fits = [x for x in room if x >= sizes[piece]]
            if fits:
                room.remove(min(fits))
                room.append(min(fits) - sizes[piece])
            else:
                room.append(capacity - sizes[piece])
        got = packing.best_fit(sizes, capacity)
        assert sorted(capacity - sizes[row].sum() for row in got) == sorted(room)
        assert sorted(p for row in got for p in row) == list(range(300))


@pytest.mark.parametrize("block_bytes", [1 << 20, 64, 2])
def test_separators_across_blocks(spark, tmp_path, block_bytes):
    r = np.random.default_rng(6)
    want = {}
    for k, n in enumerate((1, 40, 500)):
        ids = r.integers(1, 5, n).astype(">u2")
        ids.tofile(tmp_path / f"f {k}.bin")
        at = np.flatnonzero(ids == 4)
        starts = [0, *(at + 1).tolist()]
        want[k] = [(i, s, (at[i] if i < len(at) else n) - s, i < len(at)) for i, s in enumerate(starts) if i < len(at) or s < n]
    (tmp_path / "empty.bin").touch()
    got = defaultdict(list)
    for x in separators.count_tokens(spark, str(tmp_path), separator=4, block_bytes=block_bytes).collect():
        got[int(x.path[-5])].append((x.ordinal, x.start, x.n_tokens, x.closed))
    assert {k: sorted(v) for k, v in got.items()} == {k: v for k, v in want.items() if v}


def test_written_files_hold_all_documents(spark, bpe, case):
    texts, docs = case
    rows = separators.report(docs.coalesce(2)).collect()
    assert Counter(r.n_tokens for r in rows) == Counter(len(bpe.bpe.encode_ordinary(t or "")) for t in texts)
    by = defaultdict(list)
    for r in rows:
        by[r.part].append(r)
    for part in by.values():
        part.sort(key=lambda r: r.ordinal)
        assert [r.start for r in part] == np.cumsum([0] + [r.n_tokens + 1 for r in part])[:-1].tolist() and all(r.closed for r in part)


def test_files_must_hold_whole_ids(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole number of ids"):
        separators.count_tokens(spark, str(tmp_path)).collect()


def test_empty_documents_table(spark, make):
    assert separators.report(make([])).collect() == []
