"""The pipeline's stages against brute force."""

from __future__ import annotations

import re

import corpus_pipeline as cp
from tests.llm.test_near_dedup import classes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows(text: str) -> set[tuple[str, ...]]:
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} if w else set()


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_000, "漢字 仮名 交じり 文 が 並ぶ 文章 です", None, "x", 1), (10_001, None, None, "x", 0), (10_002, "12 34", "en", "x", 5)], docs.schema)
    docs = docs.unionByName(extra).unionByName(docs.limit(3))
    out = docs
    for name, stage in cp.STAGES[:-1]:
        given = {r.doc_id: r.text for r in out.collect()}
        out = stage(spark, out, SF)
        assert out.schema == docs.schema
        rows = out.collect()
        got = sorted(r.doc_id for r in rows)
        assert all(given[r.doc_id] == r.text for r in rows)
        if name == "language_id":
            assert set(given) - set(got) == {10_000, 10_001, 10_002}
        elif name == "exact_dedup":
            first: dict[str, int] = {}
            for d in sorted(given):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", given[d] or ""), d)
            assert got == sorted(first.values())
        elif name == "near_dedup":
            assert got == sorted(set(classes(given, 5, 80, 100).values()))
        else:
            marked = set().union(*(windows(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()))
            sizes = {len(m) for m in marked}
            short = [m for m in marked if len(m) < 10]
            assert not short and sizes == {10}
            assert got == sorted(d for d in given if not windows(given[d]) & marked)
        out = spark.createDataFrame(rows, docs.schema)
    pieces = cp.STAGES[-1][1](spark, out, SF).collect()
    assert {r.doc_id for r in pieces} == set(got)


def test_run(spark):
    assert cp.run(spark, SF).count() > 100


def test_stages_begin_with_a_small_heap(spark):
    """Each stage has the executors' JVMs collect garbage first (here one JVM, the driver's)."""

    def collected():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for _, stage in cp.STAGES:
        before = collected()
        stage(spark, docs, SF)
        assert collected() > before
