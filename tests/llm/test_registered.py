"""The registered corpus queries against their SQL, and the pipeline stage by stage."""

import os

import numpy as np
import pytest

import corpus_pipeline as cp
from compare import connect, difference
from gridcast.llm import decontam, near_dedup, packing
from gridcast.llm.common import shared_dir, table
from gridcast.llm.registry import QUERIES, SQL

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), SQL[name]) is None


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in cp.STAGES] == ["quality", "near_dedup", "decontaminate", "mix", "pack"]


def test_pipeline_stage_by_stage(spark):
    """Each stage against what its operator finds in the stage's own input."""
    docs, counts = table(spark, SF, "documents"), []
    for name, stage in cp.STAGES:
        path = shared_dir(spark)
        stage(spark, docs, SF).write.parquet(path)
        out = spark.read.parquet(path)
        before, after = docs.collect(), out.collect()
        if name != "pack":
            assert out.columns == docs.columns
            kept, ids = {r.doc_id for r in after}, {r.doc_id for r in before}
        if name in ("quality", "near_dedup", "decontaminate"):
            assert len(after) == len(kept) and set(after) <= set(before)
        if name == "quality":
            labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
            assert all(labels.get(i, 1) == 0 for i in ids - kept if i in labels)
        if name == "near_dedup":
            assert kept == {r.doc_id for r in near_dedup.report(docs).where("kept").collect()} and kept < ids
        if name == "decontaminate":
            assert kept == {r.doc_id for r in decontam.report(docs, table(spark, SF, "benchmark")).where("not contaminated").collect()}
        if name == "mix":
            assert kept == ids and set(after) == set(before)
        if name == "pack":
            pieces = {}
            for r in after:
                ids = packing.id_matrix([r.ids])[0]
                for d, o, s, e in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
                    pieces.setdefault((d, o), []).append(np.array(ids[s:e]).tobytes())
            assert {d for d, _ in pieces} == {r.doc_id for r in before}
        counts.append(len(after))
        docs = out
    assert counts[3] >= counts[2] > 0


def test_pipeline_of_an_empty_table(spark, make):
    docs = make([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.collect() == []
