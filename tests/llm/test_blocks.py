"""Steps of the repeated paragraphs that look at many rows at once, against plain loops."""

from collections import Counter

import numpy as np
import pyarrow as pa

from gridcast.llm import minhash, paragraphs


def test_stretches_are_those_of_a_plain_loop(monkeypatch):
    monkeypatch.setattr(paragraphs, "PLACES", 300)  # several rounds
    r = np.random.default_rng(3)
    most = 0
    for trial in range(150):
        first = r.integers(0, 1 << 60, 240).astype(np.uint64)
        words = np.concatenate([r.integers(0, 9, r.integers(0, 30)).astype(np.uint64), first[r.integers(0, 90):], first[50:r.integers(80, 240)]])
        words[r.integers(0, len(words), 4)] = 7
        lo, same = int(r.integers(0, 60)), trial % 3 == 0
        other = (words if same else first)[lo:]
        start, at = r.integers(0, len(words), 80), r.integers(0, 200, 80)
        for i in range(50):  # most places hold the same word in both texts
            hit = np.flatnonzero((words if same else first) == words[start[i]])
            at[i] = hit[0] if len(hit) else at[i]
        want, done = [], {}
        for p, q in sorted(zip(start.tolist(), at.tolist())):
            d = p - q
            begin, end = max(0, lo + d), min(len(words), lo + d + len(other))
            if p < max(begin, done.get(d, 0)) or p >= end or same and d < paragraphs.RUN:
                continue
            s = e = p
            while e < end and words[e] == other[e - d - lo]:
                e += 1
            if e - p < paragraphs.RUN:
                continue
            while s > begin and words[s - 1] == other[s - 1 - d - lo]:
                s -= 1
            done[d] = e
            s = max(s, q + paragraphs.RUN) if same else s
            want.append((s, e - s, s - d, q))
        got = paragraphs.stretches(words, other, lo, start, at, same).tolist()
        assert sorted(map(tuple, got)) == sorted(want)
        most = max(most, len(want))
    none = np.empty(0, np.int64)
    assert most > 3 and paragraphs.stretches(words, other, 0, none, none, False).shape == (0, 4)


def test_sorted_keys_met_twice_are_told_once():
    r = np.random.default_rng(4)
    keys = np.sort(r.integers(0, 60, 100))
    for size in (1, 2, 3, 100):
        held, got = keys[:0], []
        for at in range(0, 100, size):
            got += paragraphs.second(held, keys[at:at + size]).tolist()
            held = np.concatenate((held, keys[at:at + size]))[-2:]
        assert got == sorted(k for k, n in Counter(keys.tolist()).items() if n > 1)


def test_blocks_are_whole_and_pairs_stay_within_them():
    r = np.random.default_rng(5)
    key = np.sort(r.integers(0, 40, 300))
    small = np.concatenate([np.sort(r.random(n) < .4) for n in np.unique(key, return_counts=True)[1]])
    sig = r.integers(0, 2, (300, 32)).astype(np.uint8)
    rows = pa.RecordBatch.from_arrays(
        [pa.array(key), pa.array(key * 0), pa.array(key * 0), pa.array(small), pa.array(np.arange(300)), pa.array(np.arange(300) % 5),
         pa.array(r.integers(60, 100, 300)), pa.array([x.tobytes() for x in sig], pa.binary())], ["key", "i", "j", "small", "node", "root", "n", "sig"])
    n, root = rows.column("n").to_numpy(), rows.column("root").to_numpy()
    want = {(a, b) for a in np.flatnonzero(small).tolist() for b in np.flatnonzero(~small & (key == key[a])).tolist()
            if root[a] != root[b] and min(n[a], n[b]) >= .75 * max(n[a], n[b]) and (sig[a] == sig[b]).sum() >= 18}
    got, seen = [], 0
    for part, block in minhash.blocks(iter([rows.slice(i, 7) for i in range(0, 300, 7)])):
        seen += part.num_rows
        node = part.column("node").to_numpy()
        for a, b in minhash._possible(part, block, .75, [(32, 18)]):
            got += zip(node[a].tolist(), node[b].tolist())
    assert seen == 300 and sorted(got) == sorted(want) and len(want) > 50
    assert list(minhash.blocks(iter([]))) == []

