"""Near-duplicate documents by min-max hashing, banding and confirmation on full sets.

Signature: under each permutation of 32-bit shingle hashes both the minimum and the maximum are kept.
Either agrees between two sets with the probability of their Jaccard similarity, so one evaluation gives
two unbiased samples, and as they are negatively correlated the estimate varies less. Minima and maxima
are banded apart. With 75 permutations, 30 bands of 5, a link at similarity 0.85 escapes all bands with
a probability of 2e-8, at 0.8 of 7e-6.

Documents with equal sets are one representative. A band's bucket may hold any share of them, so it is
never expanded into pairs nor gathered. First all its members are compared with one anchor, the smallest
id, which connects most of what belongs together. Where members are then in several components, the
strays outside the bucket's largest one are held against all others, in blocks of about MEMBERS members
and STRAYS strays that are compared inside a task: a pair only in its first common bucket, only if sizes
allow a link and the distances to the anchor do (Jaccard distance is a metric), and only until the stray
is connected to the other's component, likeliest first. A block returns the links it found, at most one
for each stray and component. Any two members of a bucket not connected so far do meet, so no link that
joins two components is lost. All links are confirmed by the number of common 64-bit shingle hashes of
the full sets.

Defined cases: a text of fewer words than a shingle is one shingle; without words or text the set is
empty and links with nothing; rows that repeat a doc_id count as copies; a null doc_id is never the
smallest; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import join_hot, join_salted, materialise, texts_of, tidy, without
from tessera.llm.components import components
from tessera.llm.words import WHITE_SPACE, chunks, mix

SHINGLE, NUMERATOR, DENOMINATOR = 3, 85, 100
PERMUTATIONS, ROWS = 75, 5
MEMBERS, STRAYS = 512, 128
#: Ids of documents that share a bucket are broadcast up to this number, else joined by a shuffle.
BROADCAST_IDS = 2_000_000

_rng = np.random.Generator(np.random.PCG64(20))
_A = _rng.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint32)
_BAND = (_rng.integers(0, 1 << 62, (2 * PERMUTATIONS // ROWS, ROWS), dtype=np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)


def shingle_sets(texts: list[bytes], shingle: int):
    """(first, end, hashes, offsets): distinct 64-bit shingle hashes of texts first..end-1, sorted within each."""
    for first, end, w in chunks(texts, WHITE_SPACE):
        h, sizes = w.hashes, np.diff(w.offsets)
        full = np.repeat(sizes >= shingle, sizes)
        # The hash of the words from a place on; the last places of a text start no shingle.
        s = np.zeros(len(h), np.uint64)
        left = np.repeat(w.offsets[1:], sizes) - np.arange(len(h))
        for j in range(shingle):
            there = np.minimum(np.arange(j, j + len(h)), len(h) - 1)
            s = np.where(left > j, mix(s * np.uint64(0x9FB21C651E98DF25) + h[there] + np.uint64(j)), s)
        keep = np.where(full, left >= shingle, left == np.repeat(sizes, sizes))
        text, s = np.repeat(np.arange(end - first), sizes)[keep], s[keep]
        order = np.lexsort((s, text)) if end - first > 1 else np.argsort(s)
        text, s = text[order], s[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (text[1:] != text[:-1])
        yield first, end, s[new], np.searchsorted(text[new], np.arange(end - first + 1))


def band_keys(s: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, bands) keys of the non-empty sets; offsets: of each set's first hash, and the end."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    starts, n = offsets[:-1], len(offsets) - 1
    low, high, y = np.empty((PERMUTATIONS, n), np.uint32), np.empty((PERMUTATIONS, n), np.uint32), np.empty_like(x)
    for p in range(PERMUTATIONS):
        np.multiply(x, _A[p], out=y)
        y += _B[p]
        y ^= y >> np.uint32(16)
        y *= np.uint32(0x85EBCA6B)
        low[p], high[p] = np.minimum.reduceat(y, starts), np.maximum.reduceat(y, starts)
    values = np.concatenate([low, high]).reshape(-1, ROWS, n)
    return mix((values.astype(np.uint64) * _BAND[:, :, None]).sum(axis=1, dtype=np.uint64) + np.arange(len(_BAND), dtype=np.uint64)[:, None]).view(np.int64).T


def _signed(shingle: int):
    def apply(batches):
        for b in batches:
            sizes, digests, bands = [], [], []
            for _, _, s, offsets in shingle_sets(texts_of(b), shingle):
                n = np.diff(offsets)
                keys = iter(band_keys(s, np.r_[offsets[:-1][n > 0], len(s)]).tolist() if n.any() else ())
                for i, size in enumerate(n.tolist()):
                    sizes.append(size)
                    digests.append(xxhash.xxh3_128_digest(s[offsets[i] : offsets[i + 1]]) if size else None)
                    bands.append(next(keys) if size else None)
            yield pa.record_batch({"doc_id": b.column("doc_id"), "n_shingles": pa.array(sizes, pa.int64()), "digest": pa.array(digests, pa.binary()), "bands": pa.array(bands, pa.list_(pa.int64()))})

    return apply


def _sets(shingle: int):
    def apply(batches):
        for b in batches:
            out = [s[offsets[i] : offsets[i + 1]].tobytes() for _, _, s, offsets in shingle_sets(texts_of(b), shingle) for i in range(len(offsets) - 1)]
            yield pa.record_batch({"doc": b.column("doc_id"), "hashes": pa.array(out, pa.binary())})

    return apply


def common(p: np.ndarray, q: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    x = np.concatenate([p, q])
    x.sort(kind="stable")
    return int((x[1:] == x[:-1]).sum())


def _common(batches):
    for b in batches:
        n = [common(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(b.column("hx").to_pylist(), b.column("hy").to_pylist(), strict=True)]
        yield pa.record_batch({"x": b.column("x"), "y": b.column("y"), "common": pa.array(n, pa.int64())})


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """pairs (x, y, nx, ny) with the size of their intersection."""
    hx, hy = (sets.select(F.col("doc").alias(c), F.col("hashes").alias(f"h{c}")) for c in ("x", "y"))
    met = join_salted(pairs.select("x", "y"), hy, "y", "x").join(hx, "x").mapInArrow(tidy(_common), "x long, y long, common long")
    return materialise(met, "common")


def near_dedup(docs: DataFrame, shingle: int = SHINGLE, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of docs."""
    kind = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", "text")
    signed = materialise(texts.mapInArrow(tidy(_signed(shingle)), f"doc_id {kind}, n_shingles long, digest binary, bands array<long>"), "signatures")
    same = signed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").cast("long").alias("doc"), F.first("n_shingles").alias("n"), F.count(F.lit(1)).alias("count"))
    # Equal sets have equal bands: the representative's own row has them.
    same = materialise(same, "sets")
    reps = same.where("doc IS NOT NULL")
    links = _links(texts, signed, reps, shingle, numerator, denominator)
    comps = components(links)
    of_set = same.join(comps, same["doc"] == comps["node"], "left").select("digest", F.coalesce("comp", "doc").alias("comp"))
    rows = signed.select("doc_id", "n_shingles", "digest")
    out = join_hot(rows.where("digest IS NOT NULL"), of_set, "digest", counts=same).select("doc_id", "n_shingles", F.col("comp").cast(kind).alias("component_id"))
    out = out.unionByName(rows.where("digest IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _links(texts, signed, reps, shingle, numerator, denominator) -> DataFrame:
    """Confirmed edges (a, b) that connect all representatives with linked sets."""
    distinct_bands = signed.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc"), "bands").join(reps.select("doc", "n"), "doc").dropDuplicates(["doc"])
    members = materialise(distinct_bands, "distinct-bands").select("doc", "n", F.explode("bands").alias("bucket"))
    anchors = materialise(members.groupBy("bucket").agg(F.min(F.struct("doc", "n")).alias("a"), F.count(F.lit(1)).alias("count")).where("count > 1"), "anchors")
    # Members of shared buckets; far: the distance to the first anchor, once known. Spark splits the rows of a hot bucket,
    # as nothing after the join needs them together.
    members = materialise(members.join(anchors.drop("count"), "bucket").select("bucket", "doc", "n", F.col("a.doc").alias("anchor"), F.col("a.n").alias("an")), "bucket-members")
    ids = materialise(members.select("doc").distinct(), "candidate-docs")
    few = ids.count() <= BROADCAST_IDS
    wanted = texts.where("doc_id IS NOT NULL").join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("doc"), "left_semi")
    sets = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(_sets(shingle)), "doc long, hashes binary")
    sets = materialise(sets, "sets")

    alike = lambda p, q: F.least(p, q) * denominator >= F.greatest(p, q) * numerator
    linked = lambda c, p, q: c * denominator >= (p + q - c) * numerator
    pairs = members.where("doc <> anchor").where(alike(F.col("n"), F.col("an"))).select(F.col("doc").alias("x"), F.col("anchor").alias("y"), F.col("n").alias("nx"), F.col("an").alias("ny")).distinct()
    pairs = materialise(pairs, "pairs")
    common = _confirmed(pairs, sets)
    met = pairs.join(common, ["x", "y"]).withColumn("linked", linked(F.col("common"), F.col("nx"), F.col("ny")))
    edges = materialise(met.where("linked").select(F.col("y").alias("a"), F.col("x").alias("b")), "links")
    # Distance to the bucket's first anchor, where it was measured.
    distance = met.select(F.col("x").alias("doc"), F.col("y").alias("anchor"), (1 - F.col("common") / (F.col("nx") + F.col("ny") - F.col("common"))).alias("far"))
    comps = components(edges)
    open_ = members.join(distance, ["doc", "anchor"], "left").join(comps.select(F.col("node").alias("doc"), "comp"), "doc", "left").where("doc <> anchor")
    open_ = materialise(open_.select("bucket", "doc", "n", "far", F.coalesce("comp", "doc").alias("comp")), "bucket-components")
    by_comp = open_.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("k"))
    sizes = by_comp.groupBy("bucket").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("all")).where("all > top.k")
    several = materialise(sizes.select("bucket", F.col("top.comp").alias("largest"), F.ceil(F.col("all") / MEMBERS).alias("chunks"), F.ceil((F.col("all") - F.col("top.k")) / STRAYS).alias("groups")), "open-buckets")
    if several.isEmpty():
        return edges
    open_ = open_.join(several, "bucket")
    place = lambda seed, n: F.pmod(F.xxhash64("doc", F.lit(seed)), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    kept = ["bucket", "doc", "n", "far", "comp"]
    met = open_.select(*kept, place(0, F.col("chunks")).alias("chunk"), every(F.col("groups")).alias("group"), F.lit(False).alias("stray"))
    met = met.unionByName(open_.where("comp <> largest").select(*kept, place(1, F.col("groups")).alias("group"), every(F.col("chunks")).alias("chunk"), F.lit(True).alias("stray")))
    wanted = met.select("doc").distinct()
    known = materialise(sets.join(distinct_bands.select("doc", "bands").join(wanted, "doc", "left_semi"), "doc"), "open-sets")
    found = met.join(known, "doc").groupBy("bucket", "chunk", "group").applyInPandas(_compare(numerator, denominator), "a long, b long")
    return edges.unionByName(found)


def _compare(numerator: int, denominator: int):
    spread = 1 - numerator / denominator + 1e-9

    def apply(pdf: pd.DataFrame) -> pd.DataFrame:
        bucket = int(pdf["bucket"].iloc[0])
        rows = {stray: part.sort_values("doc") for stray, part in pdf.groupby("stray")}
        out = []
        if True in rows and False in rows:
            ours, others = rows[True], rows[False]
            bands = np.array(others["bands"].tolist(), np.int64)
            n, far, comp, doc = others["n"].to_numpy(), others["far"].to_numpy(float), others["comp"].to_numpy(), others["doc"].to_numpy()
            sets = [np.frombuffer(x, np.uint64) for x in others["hashes"]]
            for u in ours.itertuples(index=False):
                same = bands == np.asarray(u.bands)
                near = np.isnan(far) | np.isnan(u.far) | (np.abs(far - u.far) <= spread)
                first = np.asarray(u.bands)[same.argmax(axis=1)] == bucket
                fits = near & first & (comp != u.comp) & (np.minimum(n, u.n) * denominator >= np.maximum(n, u.n) * numerator)
                mine, joined = np.frombuffer(u.hashes, np.uint64), set()
                at = np.flatnonzero(fits)
                for i in at[np.argsort(-same[at].sum(axis=1), kind="stable")]:
                    if comp[i] not in joined:
                        c = common(mine, sets[i])
                        if c * denominator >= (len(mine) + len(sets[i]) - c) * numerator:
                            joined.add(comp[i])
                            out.append((min(u.doc, doc[i]), max(u.doc, doc[i])))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return apply


def keep_one(docs: DataFrame, shingle: int, numerator: int, denominator: int) -> DataFrame:
    """The rows of docs, whole, without those whose class has a smaller doc_id.

    Rows that share a doc_id go or stay together; a null doc_id stays; documents with null text, without words or in
    no class stay; an empty table gives no rows; any other columns are carried along, whatever their names.
    """
    dropped = near_dedup(docs, shingle, numerator, denominator).where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return without(docs, materialise(dropped, "near-copies"), {"doc_id": F.col("doc_id")})


ORACLE_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
b AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach(node, r) AS (SELECT doc_id, doc_id FROM t UNION SELECT b.y, reach.r FROM reach JOIN b ON b.x = reach.node)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, m.r AS component_id, t.doc_id = m.r AS kept
FROM t LEFT JOIN n USING (doc_id) JOIN (SELECT node, min(r) AS r FROM reach GROUP BY 1) m ON m.node = t.doc_id
"""
