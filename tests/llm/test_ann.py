import numpy as np
import pytest
from pyspark.sql import functions as F

from gridcast.llm import ann
from gridcast.llm.common import table

SF = "/root/testdata/sf0.1"


def brute(rows, queries, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for q, v in queries:
        s = (x * np.array(v, float)).sum(axis=1)
        own = min(i for i in range(len(rows)) if rows[i][0] == q and rows[i][1] == v)
        order = [i for i in np.lexsort((ids, -s)) if i != own][:k]
        out[q] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_recall_on_the_table(spark):
    df = table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = found(ann.report(df)), brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert sum(hits) / len(hits) >= 0.93
    scores = {(q, i): s for q, v in got.items() for i, s in v}
    x = dict(rows)
    for (q, i), s in scores.items():
        assert abs(s - float(np.dot(np.array(x[q], float), np.array(x[i], float)))) < 1e-12


@pytest.fixture(scope="module")
def odd(spark):
    r = np.random.default_rng(2)
    rows = [(i, r.standard_normal(8).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(50)] + [(7, rows[7][1])]  # ties and a repeated id
    rows = [(i, [c * (1 + i % 5) for c in v]) if i < 60 else (i, v) for i, v in rows]
    bad = [(300, None), (301, []), (302, [0.0] * 8), (303, [None] + [1.0] * 7), (304, [float("nan")] * 8),
           (305, [float("inf")] + [0.0] * 7), (306, [1.0] * 7), (None, [1.0] * 8)]
    return rows, spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("id", F.lit(1)).withColumn("list", F.lit("l"))


def test_all_lists_is_exact_with_ties_and_bad_vectors(odd):
    rows, df = odd
    valid = ann.valid(df, "vec_id", "embedding")
    assert valid.count() == len(rows)
    index = ann.fit(valid, lists=6)
    index.probes = 6
    got = found(ann.search(valid, F.col("id") % 20 == 0, 20, index))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {
        q: [i for i, _ in v] for q, v in brute(rows, [r for r in rows if r[0] % 20 == 0], 20).items()}


def test_fewer_candidates_than_asked_and_empty(spark, odd):
    _, df = odd
    few = df.where("vec_id < 6")
    assert [len(v) for v in found(ann.report(few)).values()] == [5]
    assert ann.report(df.limit(0)).collect() == []
    assert ann.report(df.where("vec_id = 20")).collect() == []


def test_scan_never_loses_the_best_when_it_looks_at_all_dimensions():
    r = np.random.default_rng(1)
    for _ in range(20):
        block, q = r.standard_normal((8, 700)), r.standard_normal(8)
        near = ann.scan(block, q, 5, np.zeros(700, bool), 1e-9)
        d = ((block - q[:, None]) ** 2).sum(axis=0)
        assert set(np.argsort(d)[:5]) <= set(near)


def test_repeated_ids_give_distinct_rows(spark):
    """An id on rows with equal vectors asks once, on unlike ones once each; its other rows are candidates,
    and an id that a third of the rows have does not change that."""
    r = np.random.default_rng(8)
    rows = [(i, r.standard_normal(6).tolist()) for i in range(1, 200)]
    rows += [(20, rows[19][1])] * 2 + [(40, r.standard_normal(6).tolist())] + [(60, rows[3][1])] * 80
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = ann.report(df).collect()
    by = {}
    for x in got:
        by.setdefault((x.query_id, x.query_hash), []).append((x.rank, x.vec_id, x.score))
    assert sorted(k[0] for k in by if k[0] in (20, 40, 60)) == [20, 40, 40, 60, 60]
    (twenty,) = (k for k in by if k[0] == 20)
    assert all([y[0] for y in sorted(v)] == list(range(1, 21)) for v in by.values())
    assert sum(v == 20 for _, v, _ in by[twenty]) == 2          # the two other rows of its id, each once
    assert len({v for _, v, _ in by[twenty]}) == 19
    asked = [v for k, v in by.items() if k[0] == 60]      # the eighty equal rows of id 60 asked once
    assert len(asked) == 2 and all(len(v) == 20 for v in asked)


def test_asked_blocks_are_not_broadcast(spark):
    """Spark sizes them by the queries before each is repeated for every list it asks."""
    r = np.random.default_rng(5)
    df = spark.createDataFrame([(i, r.standard_normal(6).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    plan = ann.report(df)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    sent = []
    for i, line in enumerate(plan):
        if "BroadcastExchange" in line:
            below = next((j for j in range(i + 1, len(plan)) if depth(plan[j]) <= depth(line)), len(plan))
            sent.append(" ".join(plan[i:below]))
    assert any("MapInArrow" in x for x in sent)  # rows per list
    assert not any("FlatMapGroupsInArrow" in x for x in sent)
