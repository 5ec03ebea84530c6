"""Packing and token counts against the public tokenizer and exact round trips."""

from __future__ import annotations

import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tessera.llm import tokens, words
from tessera.llm.packing import Queries, Shard, _shown, neighbours, pack_documents
from tessera.llm.token_counts import document_token_counts, token_counts
from tessera.llm.tokens import END, VOCABULARY, Encoder

ODD = ["", " ", "a", " a", "a ", "a  b", "don't you're 'tis\n's it's", "a \n b", "x\n\n y", "é ü   z", "a\tb c", "  lead", "\n a b", "12 34,5 !!\n?? a<|endoftext|> b",
       "a\x1c b \x1cc", "\x00a b\x00 c", "日本 語 テキスト", "a  b  c  d", "x" * 5000, "we'll 'll ' s I'd'd ''s", "a\n\n\n b\r\n c"]


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ordinary():
    """Where the name of the control id is ordinary text."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    texts = [*ODD, None, *ODD[:3], *("word%d and more of it " % (i % 7) * (i * 3 % 900 + 1) for i in range(80))]
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3), texts


def test_encoder_is_the_tokenizer(plain):
    for texts in (ODD, [t + " " + u for t in ODD for u in ODD]):
        assert [x.tolist() for x in Encoder().encode([t.encode() for t in texts], special=True)] == [plain(t) for t in texts]


@pytest.mark.parametrize("neighbourhood", [None, 1, 7, 1000])
def test_each_id_in_one_piece(docs, plain, neighbourhood):
    df, texts = docs
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in pack_documents(df, shard_docs=16, neighbourhood=neighbourhood).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert sorted(pieces) == list(range(len(texts)))
    for i, t in enumerate(texts):
        ids, at = np.array([*plain(t), 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0


def test_neighbours_are_lexical(spark):
    words = ["alpha beta gamma delta", "kilo lima mike november"]
    df = spark.createDataFrame([(i, f"{words[i % 2]} " * 200) for i in range(8)], "doc_id long, text string")
    first = [r for r in pack_documents(df, window=4096, shard_docs=100).collect() if r.offset < 3000]
    by = defaultdict(set)
    for r in first:
        by[r.sequence_id].add(r.doc_id % 2)
    assert any(len(x) == 1 for x in by.values())


def test_neighbours_are_those_of_all_shards(spark):
    """Two documents fill a window, and each has one other of its own words: both are packed together, wherever they are."""
    rng, letters = np.random.default_rng(3), [chr(c) for c in (*range(65, 91), *range(97, 123))]
    sets = [rng.choice(letters, 8, replace=False).tolist() for _ in range(150)]
    df = spark.createDataFrame([(i, " ".join(sets[i % 150] * 8)) for i in range(300)], "doc_id long, text string").repartition(4)
    by = defaultdict(set)
    for r in pack_documents(df, window=130, shard_docs=32).collect():
        by[r.doc_id].add(r.sequence_id)
    met = sum(bool(by[i] & by[i + 150]) for i in range(150))
    assert met >= 140, met


def test_copies_are_dealt_together(spark):
    """Pairs of near copies among 300 texts, 16 at a time: most pairs are packed together."""
    rng = np.random.default_rng(4)
    words = ["".join(map(chr, rng.integers(97, 123, 6))) for _ in range(3000)]
    sets = [rng.choice(words, 40, replace=False).tolist() for _ in range(150)]
    df = spark.createDataFrame([(i, " ".join(sets[i % 150][: 40 - i // 150])) for i in range(300)], "doc_id long, text string").repartition(4)
    by = defaultdict(set)
    for r in pack_documents(df, window=260, neighbourhood=16).collect():
        by[r.doc_id].add(r.sequence_id)
    met = sum(bool(by[i] & by[i + 150]) for i in range(150))
    assert met >= 110, met


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = [rng.integers(0, 300, rng.integers(1, 60)).astype(np.uint16) for _ in range(200)]
    tails = spark.createDataFrame([(i, x.tobytes()) for i, x in enumerate(texts)], "key long, tail binary").repartition(5)
    idf, unused = rng.random(VOCABULARY).astype(np.float32), rng.random(200) < 0.8
    got = neighbours(tails, idf, 30.0, unused, [(i, texts[i], 150) for i in range(40)], shard_docs=16)
    index = Shard(texts, idf, 30.0)
    for i in range(40):
        score, want, held = index.scores(texts[i]), [], 0
        for k in sorted((k for k in range(200) if unused[k] and k != i), key=lambda k: (-score[k], k)):
            if held < 150:
                want.append((k, len(texts[k])))
                held += len(texts[k])
        assert got[i] == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(none).count() == document_token_counts(none).count() == 0


@pytest.mark.parametrize("block", [1, 7, 1 << 18])
def test_token_counts(docs, ordinary, block):
    df, texts = docs
    few = df.where("doc_id < 24")
    rows = document_token_counts(few, block_tokens=block).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {i: len(ordinary(t)) for i, t in enumerate(texts[:24])} and len(rows) == 24


def test_unterminated_file(spark):
    flat = np.array([5, END, END, 6, 7, 8, END, 9, 9], "<u2")
    for size in (1, 2, 4, 9):
        blocks = spark.createDataFrame([(0, k, flat[i : i + size].tobytes()) for k, i in enumerate(range(0, 9, size))], "file long, block long, payload binary")
        rows = sorted((r.ordinal, r.start, r.n_tokens, r.terminated) for r in token_counts(blocks).collect())
        assert rows == [(0, 0, 1, True), (1, 2, 0, True), (2, 3, 3, True), (3, 7, 2, False)]


@pytest.mark.parametrize("every", [1, 3, 50])
def test_asking_documents_are_packed_with_all(docs, plain, every):
    """Whatever asks, each id is in one piece and nothing is padded."""
    df, texts = docs
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in pack_documents(df, shard_docs=16, every=every).collect():
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert sorted(pieces) == list(range(len(texts)))
    for i, t in enumerate(texts):
        ids, at = np.array([*plain(t), 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0


def test_asking_documents_meet_all_others(spark):
    """Two documents fill a window; each that asks is packed with the other one of its own words, in whatever shard that is."""
    rng, letters = np.random.default_rng(3), [chr(c) for c in (*range(65, 91), *range(97, 123))]
    sets = [rng.choice(letters, 8, replace=False).tolist() for _ in range(150)]
    df = spark.createDataFrame([(i, " ".join(sets[i % 150] * 8)) for i in range(300)], "doc_id long, text string").repartition(4)
    by = defaultdict(set)
    for r in pack_documents(df, window=130, shard_docs=32, every=10).collect():
        by[r.doc_id].add(r.sequence_id)
    asking = range(0, 150, 10)
    assert sum(bool(by[i] & by[i + 150]) for i in asking) >= len(asking) - 1


def test_a_search_is_a_few_products(spark):
    """Scores by matrix are those of one query at a time, also for terms that have no column."""
    rng = np.random.default_rng(6)
    texts = [rng.zipf(1.2, 200).clip(0, 4000).astype(np.uint16) for _ in range(300)]
    idf = np.r_[0, rng.random(VOCABULARY - 1)].astype(np.float32)
    index, queries = Shard(texts, idf, 200.0), Queries([(i, x, 1) for i, x in enumerate(texts)], idf > 0)
    index.matrix()
    for i, j, query, terms in queries.blocks():
        assert (index.scores_of(j - i, query, terms) == [index.scores(x) for x in texts[i:j]]).all()


def test_an_index_is_built_and_asked_in_little_memory():
    """Bytes in use at most while an index is built, its matrix is filled (beside the matrix) and a block of queries is scored."""
    rng = np.random.default_rng(1)
    texts = [rng.zipf(1.15, 725).clip(0, VOCABULARY - 1).astype(np.uint16) for _ in range(4096)]
    idf = rng.random(VOCABULARY).astype(np.float32)
    queries, ids = Queries([(i, x, 24_000) for i, x in enumerate(texts[:256])], idf > 0), 4096 * 725
    i, j, query, terms = next(queries.blocks())

    def most(call):
        tracemalloc.reset_peak()
        before, out = tracemalloc.get_traced_memory()[0], call()
        return tracemalloc.get_traced_memory()[1] - before, out

    tracemalloc.start()
    try:
        built, index = most(lambda: Shard(texts, idf, 700.0))
        filled = most(index.matrix)[0] - index.dense.nbytes
        scored, score = most(lambda: index.scores_of(j - i, query, terms))
    finally:
        tracemalloc.stop()
    assert (score[::16] == [index.scores(x) for x in texts[i:j:16]]).all()
    assert built < 14 * ids and filled < 2 * ids and scored < 12 << 20, (built, filled, scored)


def test_hashes_of_long_texts_need_short_powers():
    """Texts hashed together or cut between words have the same hashes; what a worker keeps for it doesn't grow with them."""
    rng = np.random.default_rng(2)
    said = [bytes(rng.integers(97, 123, rng.integers(1, 12)).astype(np.uint8)) for _ in range(300_000)]
    said[1000] = b"x" * 1000
    words._POWERS.clear()
    got = words._scan(b" ".join(said))[0]
    assert len(words._POWERS[0]) <= words.CHUNK_BYTES + 65536
    some = [*range(0, 300_000, 997), 1000]
    assert got[some].tolist() == [int(words._scan(said[k])[0][0]) for k in some]


def test_a_search_keeps_no_encoder():
    """A worker that searches has no tokenizer and no pieces of texts any more."""
    tokens.encoder()
    idf = np.ones(VOCABULARY, np.float32)
    held = type("Held", (), {"value": (idf, 3.0, np.packbits(np.ones(2, bool)), Queries([(0, np.array([5, 6], np.uint16), 2)], idf > 0))})
    batch = pa.record_batch([pa.array([0, 1]), pa.array([np.array(x, np.uint16).tobytes() for x in ([5, 6], [6, 7])])], names=["key", "tail"])
    (out,) = _shown(16, held)(iter([batch]))
    assert np.frombuffer(out.column("key")[0].as_py(), "<i8").tolist() == [1] and not tokens._encoders
