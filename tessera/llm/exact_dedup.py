"""Exact dedup through a minimal perfect hash over historical distinct digests.

The history (documents seen before) is reduced to its distinct digests. They are dealt to shards by
digest, and each shard holds a minimal perfect hash: a key's slot is its rank among the set bits of a
few bit levels. Slots hold the full digest and the winner's locator (its doc_id) with the number of
copies. A new digest is looked up in its shard's slot and counts as a member only if all its bytes
equal those in the slot; members are repeats of the stored winner, nonmembers group among themselves.

Work is on distinct digests (aggregated map-side), so a text that makes up a third of all rows is one
key. The only join on rows is digest -> group, whose right side is unique per key; the groups of hot
digests are broadcast (see common.join_hot).

Defined cases: null text is the empty text; rows that repeat a doc_id are counted one by one and share
their decision; a null doc_id never wins against a number; an empty table gives no rows; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import join_hot, materialise, text_key, unused_names, without

SPACE = r"[\x20\x09-\x0D]+"
#: Digests of one shard: its index and what is probed against it fit in a task many times over.
SHARD_KEYS = 32_768
LEVELS, GAMMA = 48, 2.0
DIGEST = 32
GROUPS = "digest binary, keep_id long, group_size long"


def _keys(digests: np.ndarray) -> np.ndarray:
    """Two 64-bit words of each digest; digests: (n, 32) bytes."""
    return np.ascontiguousarray(digests[:, 8:24]).view("<u8")


def _spread(keys: np.ndarray, level: int, m: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys[:, 0] + keys[:, 1] * np.uint64(2 * level + 1) + np.uint64(0x9E3779B97F4A7C15 * (level + 1) & (1 << 64) - 1)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(29)
    return (x % np.uint64(m)).astype(np.int64)


class PerfectHash:
    """Levels of bits. A key's place on a level is taken if no other key still without a place falls there."""

    def __init__(self, digests: np.ndarray):
        keys, left, self.levels = _keys(digests), np.arange(len(digests)), []
        while len(left) and len(self.levels) < LEVELS:
            m = int(GAMMA * len(left)) + 1
            at = _spread(keys[left], len(self.levels), m)
            alone = np.bincount(at, minlength=m) == 1
            self.levels.append(alone)
            left = left[~alone[at]]
        self.rest = {digests[i].tobytes(): k for k, i in enumerate(left)}
        self.before = np.cumsum([0, *(x.sum() for x in self.levels)])
        self.ranks = [np.cumsum(x) - 1 for x in self.levels]

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """A slot for any key; only for members is it their own. -1: surely no member."""
        keys, out = _keys(digests), np.full(len(digests), -1, np.int64)
        left = np.arange(len(digests))
        for k, bits in enumerate(self.levels):
            at = _spread(keys[left], k, len(bits))
            hit = bits[at]
            out[left[hit]] = self.before[k] + self.ranks[k][at[hit]]
            left = left[~hit]
        for i in left if self.rest else ():
            out[i] = self.before[-1] + self.rest[digests[i].tobytes()] if digests[i].tobytes() in self.rest else -1
        return out


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, column)), np.uint8).reshape(-1, DIGEST)


def pack_shard(digests: np.ndarray, winners: np.ndarray, sizes: np.ndarray) -> dict:
    """The shard's slots in slot order; the bit levels follow from the digests, packed beside them."""
    mph = PerfectHash(digests)
    slot = mph.slots(digests)
    by_slot = np.argsort(slot)
    return {"levels": [np.packbits(x).tobytes() for x in mph.levels], "lengths": [len(x) for x in mph.levels], "digests": digests[by_slot].tobytes(), "winners": winners[by_slot].tobytes(), "sizes": sizes[by_slot].tobytes()}


class Shard:
    """A packed shard, ready for lookups."""

    def __init__(self, levels, lengths, digests, winners, sizes):
        mph = PerfectHash.__new__(PerfectHash)
        mph.levels = [np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(levels, lengths, strict=True)]
        mph.before = np.cumsum([0, *(x.sum() for x in mph.levels)])
        mph.ranks = [np.cumsum(x) - 1 for x in mph.levels]
        self.digests = np.frombuffer(digests, np.uint8).reshape(-1, DIGEST)
        self.winners, self.sizes = np.frombuffer(winners, "<i8"), np.frombuffer(sizes, "<i8")
        mph.rest = {self.digests[i].tobytes(): i - mph.before[-1] for i in range(int(mph.before[-1]), len(self.digests))}
        self.mph = mph

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Slots of members after comparing all bytes; -1 for nonmembers."""
        slot = self.mph.slots(digests)
        ok = (slot >= 0) & (slot < len(self.digests))
        ok[ok] = (self.digests[slot[ok]] == digests[ok]).all(axis=1)
        return np.where(ok, slot, -1)


INDEX = "shard long, levels array<binary>, lengths array<long>, digests binary, winners binary, sizes binary"
NO_ID = -(1 << 63)


def _ids(column) -> np.ndarray:
    return np.array([NO_ID if x is None or x != x else int(x) for x in column], "<i8") if column.dtype == object or column.isna().any() else column.to_numpy("<i8")


def _pack(pdf: pd.DataFrame) -> pd.DataFrame:
    one = pack_shard(_matrix(pdf["digest"]), _ids(pdf["keep_id"]), pdf["group_size"].to_numpy("<i8"))
    return pd.DataFrame([{"shard": pdf["shard"].iloc[0], **one}])


def _merge(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """History's groups with the new copies added, then the nonmembers' own groups."""
    if not len(index):
        return new[["digest", "keep_id", "group_size"]]
    shard = Shard(*(index[c].iloc[0] for c in ("levels", "lengths", "digests", "winners", "sizes")))
    sizes, out = shard.sizes.copy(), []
    if len(new):
        slot = shard.find(_matrix(new["digest"]))
        np.add.at(sizes, slot[slot >= 0], new["group_size"].to_numpy("<i8")[slot >= 0])
        out.append(new.loc[slot < 0, ["digest", "keep_id", "group_size"]])
    ids = pd.Series(shard.winners).astype("Int64").mask(shard.winners == NO_ID)
    out.insert(0, pd.DataFrame({"digest": [x.tobytes() for x in shard.digests], "keep_id": ids, "group_size": sizes}))
    return pd.concat([x.astype({"keep_id": "Int64"}) for x in out])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id and the SHA-256 of the text with every run of white space as one space."""
    return docs.select("doc_id", _digest(F.col("text")).alias("digest"))


def _digest(text):
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ").cast("binary"), 256))


def _shard(n: int):
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long"), F.lit(n)).alias("shard")


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """groups: digest (distinct), keep_id, group_size. One row a shard."""
    return groups.select("*", _shard(shards)).groupBy("shard").applyInPandas(_pack, INDEX)


def probe(new_groups: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """All groups after new_groups has met the index: digest, keep_id, group_size."""
    return new_groups.select("*", _shard(shards)).groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_merge, GROUPS)


def _groups(rows: DataFrame, history_until: int | None) -> tuple[DataFrame, DataFrame]:
    """rows (doc_id, digest) as a table, and groups (digest, keep_id, group_size)."""
    rows = materialise(rows, "digests")
    grouped = lambda part: part.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    n, low, high = rows.agg(F.count(F.lit(1)), F.min("doc_id"), F.max("doc_id")).first()
    if history_until is None:
        history_until = ((low or 0) + (high or 0)) // 2
    shards = n // SHARD_KEYS + 1
    old = F.coalesce(F.col("doc_id") <= history_until, F.lit(False))
    index = materialise(build_index(grouped(rows.where(old)), shards), "perfect-hash")
    return rows, probe(grouped(rows.where(~old)), index, shards)


def _met(rows: DataFrame, groups: DataFrame) -> DataFrame:
    groups = materialise(groups, "digest-groups")
    return join_hot(rows, groups, "digest", counts=groups.select("digest", F.col("group_size").alias("count")))


def exact_dedup(docs: DataFrame, history_until: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of docs.

    Rows with doc_id <= history_until are the history (by default the lower half of the id range, as
    documents arrive in id order), so a historical winner is always the smallest doc_id of its group.
    """
    rows, groups = _groups(digests(docs), history_until)
    return _met(rows, groups).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def keep_first(docs: DataFrame, history_until: int | None = None) -> DataFrame:
    """The rows of docs, whole, that stay: one for each text.

    What goes is decided on digests; docs itself is read once, against the keys of the rows that go. Of rows that
    repeat both doc_id and text one stays, any of them; of a text whose doc_ids are all null one row stays; null text
    is the empty text; an empty table gives no rows; any other columns are carried along, whatever their names.
    """
    keyed = docs.select("doc_id", *(e.alias(k) for k, e in text_key().items()), _digest(F.col("text")).alias("digest"))
    rows, groups = _groups(keyed, history_until)
    met = materialise(_met(rows, groups).select("doc_id", *text_key(), "digest", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept")), "digest-rows")
    on = {"doc_id": F.col("doc_id"), **text_key()}
    losers = met.where("NOT kept").select(*on).distinct()
    # Texts whose winner's doc_id has several rows: all rows go but one, which is picked by a shuffle of these alone.
    again = materialise(met.where("kept").groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest"), "repeated")
    if again.isEmpty():
        return without(docs, materialise(losers, "copies"), on)
    repeated = materialise(met.where("kept").join(again, "digest", "left_semi").select(*on).distinct(), "repeated-rows")
    out = without(docs, materialise(losers.union(repeated).distinct(), "copies"), on)
    n, *names = unused_names(docs.columns, 1 + len(on))
    wanted = repeated.select(*(F.col(k).alias(x) for k, x in zip(on, names, strict=True)))
    equal = [e.eqNullSafe(F.col(x)) for (_, e), x in zip(on.items(), names, strict=True)]
    some = docs.join(wanted, equal, "left_semi").withColumn(n, _digest(F.col("text")))
    return out.unionByName(some.dropDuplicates([n]).drop(n))


ORACLE_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM t JOIN g USING (text_sha256)
"""
