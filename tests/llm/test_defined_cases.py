"""What every operator and stage says to extra columns, repeated rows, nulls in any column, ties, long texts and empty tables."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from tessera.llm import chat_format, decontaminate, exact_dedup, html_extract, language_id, lm_score, near_dedup, packing, token_counts, url_filter

#: Names that operators use for columns of their own, in any case of letters.
TAKEN = ["key", "Tail", "df", "term", "place", "part", "block", "held", "h", "h1", "h2", "none", "n", "count", "digest", "KEPT", "keep_id", "component_id", "sequence_id", "offset", "length", "rule", "verdict", "host", "path", "rendered", "pos",
         "n_hit", "__text", "__digest", "__keep", "__dropped", "__salt", "__salts", "k0", "K1", "score", "rejected", "n_tokens", "ordinal", "words", "item_id"]

WORDS = "the cat sat on a mat and saw the dog run far over every hill that day while rain fell on old roofs".split()
TEXTS = [" ".join(WORDS[i % 5 :] * (1 + i % 3)) for i in range(40)] + [None, "", " ", "x", "y " * 40_000, "<|endoftext|>"]
PASSAGE = " ".join(f"w{i}" for i in range(12))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "de", None)[i % 3], ("s", None)[i % 2], None) for i, t in enumerate([*TEXTS, PASSAGE])]
    return spark.createDataFrame([*rows, *rows[:3], rows[-1], (None, "no id", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, PASSAGE), (1, PASSAGE), (2, None), (None, "x"), (3, "")], "item_id long, text string")


def more(df):
    """df with columns of the names that are taken, null and not."""
    return df.select("*", *((F.lit(None).cast("string") if i % 2 else F.lit(i)).alias(x) for i, x in enumerate(x for x in TAKEN if x.lower() not in df.columns)))


def rows(df) -> Counter:
    return Counter(str(tuple(r)) for r in df.collect())


def operators(docs, bench):
    return {
        "lm_score": lambda d: lm_score.lm_score(d), "exact_dedup": lambda d: exact_dedup.exact_dedup(d), "decontaminate": lambda d: decontaminate.decontaminate(d, bench), "near_dedup": lambda d: near_dedup.near_dedup(d),
        "language_id": lambda d: language_id.identify(d), "token_counts": lambda d: token_counts.document_token_counts(d),
    }


@pytest.mark.parametrize("name", ["lm_score", "exact_dedup", "decontaminate", "near_dedup", "language_id", "token_counts"])
def test_documents(docs, bench, name):
    operator = operators(docs, bench)[name]
    got = operator(docs)
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in docs.collect())
    assert "lm" in name or rows(operator(more(docs))) == rows(got)
    if "lm" in name:  # sampled: the same up to the order of rows that were summed
        assert Counter((r.doc_id, r.n_tokens, r.n_known) for r in operator(more(docs)).collect()) == Counter((r.doc_id, r.n_tokens, r.n_known) for r in got.collect())
    assert operator(more(docs.where("false"))).count() == 0


def test_packing(docs):
    of = lambda d: Counter((r.doc_id, r.doc_tokens) for r in packing.pack_documents(d).where("start = 0").collect())
    assert of(more(docs)) == of(docs) == Counter((r.doc_id, r.n_tokens + 1) for r in token_counts.document_token_counts(docs.where("NOT text <=> '<|endoftext|>'")).collect()) + Counter({(45, 2): 1})
    assert packing.pack_documents(more(docs.where("false"))).count() == 0


def test_repeated_and_contaminated(docs, bench):
    hit = [r for r in decontaminate.decontaminate(docs, bench).collect() if r.contaminated]
    assert [(r.doc_id, r.n_hit, r.n_items, r.items_sha256) for r in hit] == [(46, 12, 1, hashlib.sha256(b"1").hexdigest())] * 2


def test_snapshots(spark):
    given = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (2, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, None, None), (4, 0, "user", "x " * 50_000), (None, 0, "user", "a")]
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string")
    out = chat_format.chat_format(df)
    assert {(r.conv_id, r.n_turns) for r in out.collect()} == {(1, 3), (2, 2), (3, 1), (4, 1)}
    assert [r.rendered for r in out.where("conv_id = 1").orderBy("pos").collect()] == [f"<|im_start|>{a}\n{b}<|im_end|>\n" for a, b in (("user", "a"), ("assistant", "a"), ("assistant", "b"))]
    assert rows(chat_format.chat_format(more(df))) == rows(out)
    assert chat_format.chat_format(more(df.where("false"))).count() == 0


def test_urls(spark):
    df = spark.createDataFrame([(1, "http://a.b.c/x/y"), (1, "http://a.b.c/x/y"), (None, "http://b.c/x"), (2, None), (3, "http://b.c/" + "x" * 100_000)], "page_id long, url string")
    rules = [("b.c", "/x", "block"), ("b.c", "/x", "allow"), ("c", "/x/y", "allow"), ("a.b.c", "/", "allow")]
    out = url_filter.judge(df, rules).collect()
    assert Counter((r.page_id, r.rule, r.verdict) for r in out) == Counter({(1, "a.b.c/", "allow"): 2, (None, "b.c/x", "block"): 1, (2, None, "allow"): 1, (3, "b.c/x", "block"): 1})
    assert rows(url_filter.judge(more(df), rules)) == rows(url_filter.judge(df, rules))
    assert url_filter.judge(more(df.where("false"))).count() == 0


def test_pages(spark):
    page = "<html><body><nav><a href=x>Home</a> <a href=y>News</a></nav><article><h1>Rain</h1><p>" + "It rained on the old roofs all day long. " * 8 + "</p></article></body></html>"
    df = spark.createDataFrame([(1, "u", page), (1, "u", page), (2, None, None), (None, "u", ""), (3, "u", page.replace("It rained", "It rained and rained " * 3_000))], "page_id long, url string, html string")
    out = html_extract.extract_pages(df)
    got = out.collect()
    assert Counter(r.page_id for r in got) == Counter({1: 2, 2: 1, None: 1, 3: 1})
    assert all(r.n_chars == len(r.text) for r in got) and all(not r.text for r in got if r.page_id in (2, None))
    assert all("It rained" in r.text and "Home" not in r.text for r in got if r.page_id in (1, 3))
    assert rows(html_extract.extract_pages(more(df))) == rows(out)
    assert html_extract.extract_pages(more(df.where("false"))).count() == 0


def test_stages_keep_other_columns(spark, docs):
    wide = more(docs)
    for name, stage in cp.STAGES:
        out = stage(spark, wide, "/root/testdata/sf0.001")
        none = stage(spark, wide.where("false"), "/root/testdata/sf0.001")
        assert none.count() == 0
        if name != "packing":
            assert out.columns == wide.columns and not rows(out) - rows(wide)
