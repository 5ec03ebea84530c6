"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of 10 consecutive words of benchmark items (an item of fewer words is one
window). Patterns of one length m form a group with a shift table over blocks of two words: how far the
window's end may move without passing a place where some pattern could end. Where the shift is 0, the
exact hash of the last block selects a bucket of patterns, their first block prefilters, and the words
themselves are compared, byte by byte. Many stretches of text are searched in step, each with its own
shifts, so the search is vectorised and still skips most positions.

Patterns are broadcast in slices of at most PATTERN_WORDS words; a larger benchmark takes one pass over
the documents per slice, and only what documents hit is merged. No pair of document and item that
doesn't occur is ever formed, and a passage shared by all documents costs each of them only its hits.

Defined cases: null or wordless texts have n_words 0 and no hits; items without words or id are no
pattern; items with equal windows all count; repeated rows are judged one by one; an empty benchmark
leaves every document clean; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise, text_key, texts_of, tidy, without
from tessera.llm.words import ALPHANUMERIC, chunks, mix

WINDOW = 10
PATTERN_WORDS = 2_000_000
#: Bytes of texts that a worker of a filtering stage is sent at once.
BATCH_BYTES = 8 << 20
_BITS, _STRETCH = 18, 128
_FACTOR = np.uint64(0xC2B2AE3D27D4EB4F)


def _block(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * _FACTOR + right)


class Group:
    """All patterns of m words."""

    def __init__(self, m: int, spelled: list[list[bytes]], items: list[list[int]]):
        self.m, self.spelled, self.items = m, spelled, items
        words = next(chunks([b" ".join(w for p in spelled for w in p)], ALPHANUMERIC))[2].hashes.reshape(-1, m)
        ends = self.blocks(words.reshape(-1), np.arange(words.size)).reshape(-1, m)
        b = 2 if m > 1 else 1
        self.shift = np.full(1 << _BITS, m - b + 1, np.int64)
        for j in range(b - 1, m):
            np.minimum.at(self.shift, ends[:, j] >> np.uint64(64 - _BITS), m - 1 - j)
        order = np.argsort(ends[:, -1], kind="stable")
        self.words, self.order, self.suffixes = words[order], order, ends[order, -1]

    def blocks(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the block that ends at each place."""
        return _block(h[at - 1], h[at]) if self.m > 1 else mix(h[at] ^ _FACTOR)

    def search(self, h: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where patterns may end, and which; equal in all words' hashes."""
        sizes = np.diff(offsets)
        runs = np.maximum(0, -((self.m - 1 - sizes) // _STRETCH))  # stretches that cover the window ends of each text
        text = np.repeat(np.arange(len(sizes)), runs)
        k = np.arange(len(text)) - np.repeat(np.cumsum(runs) - runs, runs)
        at = offsets[text] + self.m - 1 + k * _STRETCH
        stop = np.minimum(at + _STRETCH, offsets[text + 1])
        at, stop = at[at < stop], stop[at < stop]
        ends, hashes = [], []
        while len(at):
            b = self.blocks(h, at)
            step = self.shift[b >> np.uint64(64 - _BITS)]
            stay = step == 0
            ends.append(at[stay])
            hashes.append(b[stay])
            at = at + np.maximum(step, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        if not ends:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ends, hashes = np.concatenate(ends), np.concatenate(hashes)
        low, high = np.searchsorted(self.suffixes, hashes, "left"), np.searchsorted(self.suffixes, hashes, "right")
        n = high - low
        end = np.repeat(ends, n)
        which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        for j in (0, min(1, self.m - 1), *range(self.m)):  # the first block before the rest
            same = h[end - self.m + 1 + j] == self.words[which, j]
            end, which = end[same], which[same]
        return end, self.order[which]


class Patterns:
    def __init__(self, benchmark: Iterable[tuple[int, str]], window: int = WINDOW):
        found: dict[tuple[bytes, ...], set[int]] = defaultdict(set)
        for item, text in benchmark:
            words = (text or "").encode().translate(ALPHANUMERIC).split()
            for i in range(max(1, len(words) - window + 1) if words else 0):
                found[tuple(words[i : i + window])].add(item)
        by_size: dict[int, list] = defaultdict(list)
        for words, items in found.items():
            by_size[len(words)].append((list(words), sorted(items)))
        self.groups = [Group(m, [x[0] for x in ps], [x[1] for x in ps]) for m, ps in sorted(by_size.items())]

    def occurrences(self, texts: list[bytes]):
        """(n_words, n_hit, items) of each text."""
        for first, end, w in chunks(texts, ALPHANUMERIC):
            edge = np.zeros(len(w.hashes) + 1, np.int64)
            items: list[set[int]] = [set() for _ in range(end - first)]
            for g in self.groups:
                for e, p in zip(*(x.tolist() for x in g.search(w.hashes, w.offsets)), strict=True):
                    if w.spelled(e - g.m + 1, e) == g.spelled[p]:
                        edge[e - g.m + 1] += 1
                        edge[e + 1] -= 1
                        items[int(np.searchsorted(w.offsets, e, "right")) - 1].update(g.items[p])
            hit = np.r_[0, np.cumsum(np.cumsum(edge[:-1]) > 0)]
            n, n_hit = np.diff(w.offsets), np.diff(hit[w.offsets])
            yield from zip(n.tolist(), n_hit.tolist(), items, strict=True)


def _digest(items: Iterable[int]) -> str:
    return hashlib.sha256(",".join(sorted(map(str, items))).encode()).hexdigest()


def _slices(benchmark: DataFrame, pattern_words: int) -> list[list]:
    """The benchmark's rows in slices of a bounded number of words, read slice by slice."""
    rows = benchmark.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select("item_id", "text")
    size = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = int(size // (6 * pattern_words)) + 1  # a word takes six characters
    return [rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k) for k in range(n)]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pattern_words: int = PATTERN_WORDS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    slices = _slices(benchmark, pattern_words)
    if len(slices) == 1:
        held = spark.sparkContext.broadcast(Patterns(((r[0], r[1]) for r in slices[0].toLocalIterator()), window))

        def apply(batches):
            for b in batches:
                n, hit, items = zip(*held.value.occurrences(texts_of(b)), strict=True) if b.num_rows else ((), (), ())
                yield pa.record_batch({"doc_id": b.column("doc_id"), "n_words": pa.array(n, pa.int64()), "n_hit": pa.array(hit, pa.int64()), "n_items": pa.array([len(x) for x in items], pa.int64()), "items_sha256": pa.array([_digest(x) for x in items], pa.string()), "contaminated": pa.array([x > 0 for x in hit], pa.bool_())})

        return docs.select("doc_id", "text").mapInArrow(tidy(apply), f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")
    return _by_slices(docs, slices, window, kind)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, pattern_words: int = PATTERN_WORDS) -> DataFrame:
    """The rows of docs, whole, in which no benchmark window occurs; one pass over the texts for each slice of the benchmark.

    Null text has no words and stays; an empty benchmark leaves every row; rows with equal texts share their fate; an
    empty table gives no rows; any other columns are carried along, whatever their names.
    """
    key, hit = list(text_key()), None
    asked = docs.select("text", *(e.alias(k) for k, e in text_key().items()))
    for part in _slices(benchmark, pattern_words):
        held = docs.sparkSession.sparkContext.broadcast(Patterns(((r[0], r[1]) for r in part.toLocalIterator()), window))

        def apply(batches, held=held):
            for b in batches:
                yield b.filter(pa.array([n > 0 for _, n, _ in held.value.occurrences(texts_of(b))], pa.bool_())).select(key)

        found = asked.mapInArrow(tidy(apply), "h1 long, h2 long, none boolean")
        hit = found if hit is None else hit.union(found)
    return without(docs, materialise(hit.distinct(), "contaminated", batch_bytes=BATCH_BYTES), text_key())


def _by_slices(docs: DataFrame, slices: list, window: int, kind: str) -> DataFrame:
    """One pass per slice; the hit stretches and items of each row are merged by row."""
    spark = docs.sparkSession
    rows = materialise(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "decontaminate")
    passes = []
    for part in slices:
        held = spark.sparkContext.broadcast(Patterns(((r[0], r[1]) for r in part.toLocalIterator()), window))

        def apply(batches, held=held):
            for b in batches:
                texts, row, out = texts_of(b), b.column("row").to_pylist(), []
                for first, end, w in chunks(texts, ALPHANUMERIC):
                    spans = defaultdict(list)
                    for g in held.value.groups:
                        for e, p in zip(*(x.tolist() for x in g.search(w.hashes, w.offsets)), strict=True):
                            if w.spelled(e - g.m + 1, e) == g.spelled[p]:
                                d = int(np.searchsorted(w.offsets, e, "right")) - 1
                                spans[d].append((e - g.m + 1 - int(w.offsets[d]), g.m, g.items[p]))
                    out += [(row[first + d], [(s, m) for s, m, _ in x], sorted({i for *_, y in x for i in y})) for d, x in spans.items()]
                spans_type = pa.list_(pa.struct({"at": pa.int64(), "m": pa.int64()}))
                yield pa.record_batch({"row": pa.array([x[0] for x in out], pa.int64()), "spans": pa.array([[{"at": s, "m": m} for s, m in x[1]] for x in out], spans_type), "items": pa.array([x[2] for x in out], pa.list_(pa.int64()))})

        passes.append(rows.select("row", "text").mapInArrow(apply, "row long, spans array<struct<at: long, m: long>>, items array<long>"))
    all_hits = passes[0]
    for p in passes[1:]:
        all_hits = all_hits.unionByName(p)
    merged = all_hits.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    # A word is hit if a span covers it: spans sorted by start, each adds what reaches past the ones before.
    covered = F.aggregate(F.array_sort("spans"), F.struct(F.lit(0).cast("long").alias("to"), F.lit(0).cast("long").alias("n")), lambda s, x: F.struct(F.greatest(s["to"], x["at"] + x["m"]).alias("to"), (s["n"] + F.greatest(F.lit(0).cast("long"), x["at"] + x["m"] - F.greatest(s["to"], x["at"]))).alias("n")))["n"]
    digest = F.sha2(F.array_join(F.array_sort(F.transform(F.coalesce("items", F.array().cast("array<long>")), lambda x: x.cast("string"))), ","), 256)

    def count(batches):
        for b in batches:
            n = [int(x) for *_, w in chunks(texts_of(b), ALPHANUMERIC) for x in np.diff(w.offsets)]
            yield pa.record_batch({"doc_id": b.column("doc_id"), "row": b.column("row"), "n_words": pa.array(n, pa.int64())})

    counted = rows.mapInArrow(count, f"doc_id {kind}, row long, n_words long")
    n_hit = F.coalesce(covered, F.lit(0).cast("long"))
    return counted.join(merged, "row", "left").select("doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"), digest.alias("items_sha256"), (n_hit > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH low AS (SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
pats AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)),
grams AS (SELECT row, i, m, array_to_string(w[i:i + m - 1], ' ') AS p FROM (SELECT row, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM low, (SELECT DISTINCT m FROM pats) WHERE len(w) >= m)),
hits AS (SELECT row, i, g.m, item_id FROM grams g JOIN pats USING (m, p)),
words AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + m)) AS k FROM hits) GROUP BY 1),
its AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM low LEFT JOIN words USING (row) LEFT JOIN its USING (row)
"""
