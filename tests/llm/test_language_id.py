"""Held-out accuracy and defined cases of language identification."""

from __future__ import annotations

import numpy as np

from tessera.llm.language_id import HELD_OUT, Centroids, _fold, counts, identify, train

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 5


def test_defined_cases(spark):
    docs = spark.createDataFrame([(1, "the cat sat there", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (4, "12 !!", None), (5, "", "de"), (None, "the hat", None), (1, "the cat sat there", "en")], "doc_id long, text string, lang string")
    rows = identify(docs, train(docs, folds=False)).collect()
    got = sorted((r.doc_id or 0, r.lang_pred, r.rejected) for r in rows)
    assert got == [(0, "en", got[0][2]), (1, "en", False), (1, "en", False), (2, "de", False), (3, "und", True), (4, "und", True), (5, "und", True)]
    assert identify(docs.where("false")).count() == 0
    assert {r.lang_pred for r in identify(docs, Centroids([], [])).collect()} == {"und"}


def test_long_text_is_counted_whole():
    assert counts("ab " * 700_000).sum() > 3 * 2_000_000


def test_foreign_and_random_texts_are_rejected(spark):
    """Of every length, with limits learned on sf0.1; hardly any held-out text or beginning of one is."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = train(docs)
    rng, alphabets = np.random.default_rng(0), ([*map(chr, range(0x430, 0x450)), *" " * 5], [*map(chr, range(97, 123)), *" " * 4])
    assert model.limits.max() < 1
    for letters in alphabets:
        for n in (20, 80, 160, 250, 400):
            assert model.predict(["".join(rng.choice(letters, n)) for _ in range(40)])[2].sum() >= 36, (letters[0], n)
    held = [r.text for r in docs.where(_fold() == HELD_OUT).where("lang IS NOT NULL AND text IS NOT NULL").orderBy("doc_id").limit(400).collect()]
    assert model.predict(held)[2].sum() <= 8 and model.predict([t[:80] for t in held])[2].sum() <= 8


def test_the_bound_of_the_sample_holds_for_any_number_of_languages(spark):
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i % 7)} word {'xyz'[i % 3] * (i % 5 + 1)}", f"l{i % 60}", i) for i in range(600)]
    docs = spark.createDataFrame([*rows, *rows[:120]], "doc_id long, text string, lang string, place long")
    fitted = train(docs, total=10, folds=False)
    assert fitted.names == [f"l{i}" for i in sorted(range(60), key=str)][:10] and fitted.trained == 10
    assert train(docs, total=10_000, folds=False).trained == len(rows) + 120 and train(docs, per_language=2, folds=False).trained == 120


def test_other_columns_and_ties(spark):
    docs = spark.createDataFrame([(1, "aa bb", "x", 1, "s"), (2, "aa bb", "y", 2, "s")], "doc_id long, text string, lang string, score int, held_out string")
    got = identify(docs, train(docs, folds=False)).collect()
    assert [(r.lang_pred, r.rejected) for r in got] == [("x", False)] * 2 and all(0.99 < r.score <= 1 for r in got)
