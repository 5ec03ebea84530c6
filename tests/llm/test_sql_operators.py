"""Operators that SQL can state, against it and in the cases that the driver's tables don't hold."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

import __spark_entry__ as entry
from tessera.llm import chat_format, decontaminate, exact_dedup, queries, url_filter
from tests.compare import differs

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query(spark, name):
    said = differs(entry.queries()[name](spark, SF), entry.oracle_sql()[name], SF)
    assert said is None, said


def test_perfect_hash():
    digests = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(5000)), np.uint8).reshape(-1, 32)
    known, others = digests[:4000], digests[4000:]
    packed = exact_dedup.pack_shard(known, np.arange(4000, dtype="<i8"), np.ones(4000, "<i8"))
    shard = exact_dedup.Shard(**packed)
    at = shard.find(known)
    assert sorted(at) == list(range(4000)) and (shard.winners[at] == np.arange(4000)).all()
    assert (shard.find(others) == -1).all()


def test_exact_dedup_cases(spark):
    df = spark.createDataFrame([(5, "a  b", "x"), (2, "a\tb", "x"), (9, None, "x"), (7, "", "y"), (7, "", "y"), (None, "a b", "z")], "doc_id long, text string, digest string")
    rows = sorted(((r.doc_id or -1), r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(df).collect())
    assert rows == [(-1, 2, 3, False), (2, 2, 3, True), (5, 2, 3, False), (7, 7, 3, True), (7, 7, 3, True), (9, 7, 3, False)]
    assert sorted(r.doc_id for r in exact_dedup.keep_first(df).collect()) == [2, 7]
    assert exact_dedup.exact_dedup(df.where("false")).count() == 0


def test_decontaminate_cases(spark):
    long = " ".join(f"w{i}" for i in range(15))
    bench = spark.createDataFrame([(1, long), (2, "Tiny item"), (3, None), (4, "--"), (10, "tiny ITEM")], "item_id long, text string")
    texts = ["x " + " ".join(f"W{i}" for i in range(11)) + " y", "a tiny, item and tiny item", None, "", "w0 w1", "z " * 30_000 + long]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [(0, 13, 11, "1"), (1, 6, 4, "10,2"), (2, 0, 0, ""), (3, 0, 0, ""), (4, 2, 0, ""), (5, 30_015, 15, "1")]
    for words in (2_000_000, 3):
        rows = sorted((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in decontaminate.decontaminate(docs, bench, pattern_words=words).collect())
        assert rows == [(*x[:3], hashlib.sha256(x[3].encode()).hexdigest()) for x in want]
        assert sorted(r.doc_id for r in decontaminate.keep_clean(docs, bench, pattern_words=words).collect()) == [2, 3, 4]
    assert decontaminate.decontaminate(docs.where("false"), bench).count() == 0


def test_url_rules(spark):
    urls = ["http://example.com/en/x", "https://WWW.example.com/en/", "http://a.net/es/", "http://net/fr/?q", "http://example.com", "no scheme", None, "x://b.net", "x://evilnet/es/", "ftp://example.com#/en/", ""]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    want = [("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"), *[(None, "allow")] * 7]
    for limit in (1 << 26, 0):
        assert [(r.rule, r.verdict) for r in url_filter.judge(df, broadcast_bytes=limit).orderBy("page_id").collect()] == want
    assert url_filter.judge(df.where("false")).count() == 0


def test_snapshots_collapse(spark):
    turns = lambda c, *texts: [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows = [*turns(1, "a", "b"), *turns(2, "a", "b", "c", "d"), *turns(3, "a", "b", "c", "d"), *turns(4, "a", "x"), *turns(5, *(f"t{i}" for i in range(600))), *turns(6, *(f"t{i}" for i in range(599))), (7, None, None, "<|im_end|>"), (None, 0, "user", "a")]
    out = chat_format.chat_format(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {(r.conv_id, r.n_turns, r.copies) for r in out} == {(2, 4, 2), (4, 2, 1), (5, 600, 1), (7, 1, 1)}
    assert [r.rendered for r in out if r.conv_id == 7] == ["<|im_start|>\n< |im_end|><|im_end|>\n"]
    assert [r.pos for r in sorted((r for r in out if r.conv_id == 5), key=lambda r: r.pos)] == list(range(600))
