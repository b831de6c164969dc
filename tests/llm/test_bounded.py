"""What tasks hold and leave behind."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from gridcast.llm import ann, collocations, paragraphs, quality
from gridcast.llm.bitmaps import bitmap, where
from gridcast.llm.common import materialize, parts
from gridcast.llm.textscan import SPACED, chunks


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_hashes_go_through_python_where_a_bitmap_is_asked(spark):
    df = spark.createDataFrame([(i, f"t{i}", None) for i in range(50)] + [(None, "n", 1)], "id long, text string, x int")
    held = bitmap(df.where("id < 20").select(F.xxhash64("id")))
    yes, no = (where(df, F.xxhash64("id"), held, hit) for hit in (True, False))
    assert "MapInArrow" not in plan(yes) and yes.columns == df.columns
    assert {r.id for r in yes.collect()} >= set(range(20))
    assert sorted(map(str, yes.union(no).collect())) == sorted(map(str, df.collect()))


def test_good_texts_are_kept_without_sending_other_columns_to_python(make, spark):
    docs = make(["good words. " * 30, None, "", "|||| $$$$ " * 30] * 5)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(20)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    kept = quality.keep_good(docs, labels)
    assert "MapInArrow" not in plan(kept)
    want = quality.with_statistics(docs, "st").where(model.score(F.col("st")) >= 0.3).drop("st")
    assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))


def test_a_batch_is_cut_into_parts_of_bounded_text():
    batch = pa.RecordBatch.from_arrays([pa.array(["ab" * 10] * 7 + [None, "x" * 100])], ["t"])
    cut = list(parts(batch, 0, 45))
    assert [p.num_rows for p in cut] == [2, 2, 2, 2, 1] and pa.Table.from_batches(cut).equals(pa.Table.from_batches([batch]).combine_chunks())


def test_a_written_table_leaves_no_shuffle_files(spark):
    count = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    before = count()
    for _ in range(3):
        out = materialize(spark.range(10_000).groupBy((F.col("id") % 97).alias("k")).agg(F.count("*").alias("n")))
        assert out.count() == 97
    materialize(out.repartition(5, "k"))
    assert count() <= before + 8  # those of the counts above
    assert np.isclose(out.agg(F.sum("n")).first()[0], 10_000)


def test_queries_meet_a_block_together_as_one_by_one():
    r = np.random.default_rng(5)
    block, queries = r.standard_normal((24, 1500)), r.standard_normal((40, 24))
    skip = r.random((40, 1500)) < 0.01
    q, v = ann.scan_all(block, queries, 7, skip, 1e-9)
    hits = 0
    for i in range(40):
        mine = v[q == i]
        assert not skip[i, mine].any() and (np.diff(mine) > 0).all()
        assert mine.tolist() == ann.scan(block, queries[i], 7, skip[i], 1e-9).tolist()
        far = ((block.T - queries[i]) ** 2).sum(axis=1) + np.where(skip[i], np.inf, 0)
        hits += len(set(np.argsort(far)[:7].tolist()) & set(mine.tolist()))
        assert len(mine) == 7  # no more are scored than stay
    assert hits >= 0.9 * 7 * 40
    # equal vectors are all kept, fewer than k too
    same = np.repeat(block[:, :1], 900, axis=1)
    q, v = ann.scan_all(same, queries[:2], 7, np.zeros((2, 900), bool), 1e-9)
    assert len(q) == 1800
    assert len(ann.scan_all(block[:, :4], queries[:1], 7, np.zeros((1, 4), bool), 1e-9)[0]) == 4


def test_phrases_are_sent_on_in_parts_of_bounded_size(monkeypatch, spark):
    words = [f"w{i}" for i in range(30)]
    r = np.random.default_rng(1)
    docs = spark.createDataFrame([(int(i), " ".join(r.choice(words, 40)), "en") for i in range(200)], "doc_id long, text string, lang string")
    want = sorted(map(str, collocations.collocations(docs, least=5).collect()))
    monkeypatch.setattr(collocations, "GROUP", 900)
    monkeypatch.setattr(collocations, "ROWS", 3)
    assert want and sorted(map(str, collocations.collocations(docs, least=5).collect())) == want


def test_paragraphs_that_share_single_shingles_are_no_candidates():
    assert paragraphs.keys_of(0.75) == paragraphs.LEAST == 20 and paragraphs.keys_of(0.5) > 20
    hit = np.zeros(60, bool)
    lines = np.repeat([3, 9, 40], 20)
    hit[[0, 20, 21, 22, 23, 40, 41, 42, 43, 44]] = True
    assert paragraphs.likely(lines, hit, 75).tolist() == [40]
    # of a line with few distinct shingles, three quarters are asked for
    assert paragraphs.likely(np.array([1, 1, 2, 2, 2, 5]), np.array([1, 0, 1, 1, 1, 1], bool), 75).tolist() == [2, 5]
    assert paragraphs.likely(np.empty(0, np.int64), np.empty(0, bool), 75).tolist() == []


def test_similar_paragraphs_pass_the_keys():
    r = np.random.default_rng(3)
    for n in (20, 24, 60, 150):
        lost = 0
        for _ in range(60):
            one = [f"w{x}" for x in r.integers(0, 4000, n)]
            other = list(one)
            while True:  # as long as the pair is at the threshold
                changed = list(other)
                changed[r.integers(0, n)] = f"z{r.integers(0, 4000)}"
                sets = [{tuple(t[i:i + 5]) for i in range(n - 4)} for t in (one, changed)]
                if len(sets[0] & sets[1]) < 0.75 * len(sets[0] | sets[1]):
                    break
                other = changed
            keys = []
            for t in (one, other):
                (chunk,) = chunks([" ".join(t).encode()], SPACED)
                kind, _, at, key = paragraphs.Units(chunk).keys(paragraphs.LEAST)
                keys.append((at[kind == paragraphs.PARAGRAPH], key[kind == paragraphs.PARAGRAPH]))
            lost += not all(len(paragraphs.likely(at, np.isin(key, keys[1 - i][1]), 75)) for i, (at, key) in enumerate(keys))
        assert not lost


def test_paragraph_scans_look_at_half_a_megabyte_at_once():
    texts = [f"word{i} " * 400 for i in range(2500)] + [None, "", "long " * 200_000]
    batches = [pa.RecordBatch.from_arrays([pa.array(part)], ["text"]) for part in (texts, texts[:0], texts[:3])]
    seen, sizes = [], []
    for part, chunk in paragraphs.pieces(batches, 0):
        sizes.append((len(chunk.bytes), chunk.count))
        seen += part.column(0)[chunk.first:chunk.first + chunk.count].to_pylist()
    assert seen == texts + texts[:3]
    assert all(size <= 1 << 19 or count == 1 for size, count in sizes)
