"""Near-duplicate classes against brute force, and the defined cases."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tessera.llm import near_dedup as nd
from tessera.llm.components import components


def classes(texts: dict[int, str | None], shingle: int, num: int, den: int) -> dict[int, int]:
    sets = {}
    for d, t in texts.items():
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets[d] = {tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set()
    up = {d: d for d in texts}

    def root(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            c = len(sets[a] & sets[b])
            if sets[a] and sets[b] and c * den >= len(sets[a] | sets[b]) * num and root(a) != root(b):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    return {d: root(d) for d in ids}


def family(rng, base: list[str], edits: int) -> str:
    w = list(base)
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("shingle,num,den", [(3, 85, 100), (5, 80, 100)])
def test_borderline_families(spark, monkeypatch, shingle, num, den):
    monkeypatch.setattr(nd, "MEMBERS", 16)
    monkeypatch.setattr(nd, "STRAYS", 8)
    rng = random.Random(5)
    texts: dict[int, str | None] = {0: None, 1: "", 2: "  \\t ", 3: "one", 4: "One", 5: "one two", 6: "one two", 7: "ONE TWO three"}
    for k in range(3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(70):
            texts[len(texts)] = family(rng, base, rng.randrange(0, 9))
    chain = [f"c{i}" for i in range(100)]
    for i in range(12):  # each links with the next only
        texts[len(texts)] = " ".join(chain[i * 5 :] + [f"t{j}" for j in range(i * 5)])
    rows = nd.near_dedup(spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4), shingle, num, den).collect()
    want = classes(texts, shingle, num, den)
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len(set(want.values())) < len(want) - 40


def test_defined_cases(spark):
    rows = nd.near_dedup(spark.createDataFrame([(1, "a b c d", 5), (1, "a b c d", 5), (None, "a b c d", 6), (None, None, 7), (2, "a b c d", 8), (9, "x " * 50_000, 1)], "doc_id long, text string, n long")).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in rows) == [(-1, 0, -1, True), (-1, 2, 1, False), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (9, 1, 9, True)]
    assert nd.near_dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000 + i, 1000) for i in range(1, 200)] + [(7, 7)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def test_estimates_are_unbiased():
    rng = np.random.default_rng(3)
    both, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (800, 100, 100))
    x, y = np.sort(np.r_[both, a]), np.sort(np.r_[both, b])
    keys = nd.band_keys(np.r_[x, y], np.array([0, len(x), len(x) + len(y)]))
    assert 0.2 < (keys[0] == keys[1]).mean() < 0.55  # 0.8 ** 5 = 0.33
