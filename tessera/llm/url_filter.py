"""URL rules by a sorted digest array.

Each rule is a host and a path prefix. Its text `host + path` is hashed to a 64-bit xxHash key; the keys
are sorted in one memory-mapped array beside the full strings and verdicts. A URL asks for each of its
host suffixes joined with each path prefix whose length occurs among the rules; all keys of a batch are
found in one vectorised binary search, and a hit counts only if the stored string equals the one asked for.

The array is broadcast only up to BROADCAST_BYTES; beyond it, it is cut into key ranges that stay in the
shared folder, the questions are dealt to the same ranges, and the best answer per page is aggregated.

Defined cases: a null url or one without `://` has empty host and path and no rule; a url without path
has an empty path, which fits no rule whose path is `/`; the longest rule string wins, on equal length
the longer host; two verdicts for one string: block wins; without a rule the verdict is allow, as the
array holds nothing against it. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii, materialise

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict) of the production list.
RULES = (("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW), ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK))
BROADCAST_BYTES = 64 << 20
RANGE_RULES = 200_000
_FILES = ("keys", "offsets", "bytes", "verdicts", "hosts")


def pack_rules(rules: Iterable[tuple[str, str, str]]) -> dict[str, bytes]:
    """The arrays, sorted by key and string. lengths: the path lengths that occur."""
    best: dict[tuple[str, int], str] = {}
    for host, path, verdict in rules:
        if host and verdict != best.get((host + path, len(host)), ""):
            best[host + path, len(host)] = BLOCK if (host + path, len(host)) in best else verdict
    rows = sorted((xxhash.xxh64_intdigest(text.encode()), text.encode(), host, verdict) for (text, host), verdict in best.items())
    return {
        "keys": np.array([x[0] for x in rows], "<u8").tobytes(),
        "offsets": np.cumsum([0, *(len(x[1]) for x in rows)]).astype("<i8").tobytes(),
        "bytes": b"".join(x[1] for x in rows),
        "verdicts": np.array([x[3] == BLOCK for x in rows], np.uint8).tobytes(),
        "hosts": np.array([x[2] for x in rows], "<i4").tobytes(),
        "lengths": np.unique([len(text) - host for text, host in best] or [0]).astype("<i4").tobytes(),
    }


class DigestArray:
    """The packed arrays, memory-mapped from this machine's temporary folder."""

    def __init__(self, packed: dict[str, bytes]):
        tag = hashlib.sha256(b"".join(packed[x] for x in _FILES)).hexdigest()[:24]
        folder = os.path.join(tempfile.gettempdir(), f"rules-{tag}")
        os.makedirs(folder, exist_ok=True)
        arrays = []
        for name, kind in zip(_FILES, ("<u8", "<i8", np.uint8, np.uint8, "<i4"), strict=True):
            at = os.path.join(folder, name)
            if not os.path.exists(at):
                with open(part := f"{at}.{os.getpid()}", "wb") as f:
                    f.write(packed[name])
                os.replace(part, at)
            arrays.append(np.memmap(at, kind, "r") if packed[name] else np.empty(0, kind))
        self.keys, self.offsets, self.bytes, self.verdicts, self.hosts = arrays
        self.lengths = np.frombuffer(packed["lengths"], "<i4")

    def find(self, texts: list[bytes], hosts: np.ndarray) -> np.ndarray:
        """For each text with its host's length the rule's place, or -1."""
        asked = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
        at = np.searchsorted(self.keys, asked)
        out = np.full(len(texts), -1, np.int64)
        live = np.flatnonzero((at < len(self.keys)) & (self.keys[np.minimum(at, len(self.keys) - 1)] == asked)) if len(self.keys) else ()
        for i in live:
            k = int(at[i])
            while k < len(self.keys) and self.keys[k] == asked[i]:
                if self.hosts[k] == hosts[i] and self.bytes[self.offsets[k] : self.offsets[k + 1]].tobytes() == texts[i]:
                    out[i] = k
                    break
                k += 1
        return out

    def rule(self, k: int) -> str:
        return self.bytes[self.offsets[k] : self.offsets[k + 1]].tobytes().decode()


def questions(host: str, path: str, lengths: Iterable[int]) -> Iterator[tuple[bytes, int]]:
    """Longest first: every host suffix with every path prefix of a length that rules have."""
    while host:
        for n in lengths:
            if n <= len(path):
                yield (host + path[:n]).encode(), len(host)
        cut = host.find(".")
        host = host[cut + 1 :] if cut >= 0 else ""


def _ask(hosts, paths, lengths) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    texts, sizes, rows = [], [], []
    for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
        for text, n in questions(host, path, lengths):
            texts.append(text)
            sizes.append(n)
            rows.append(i)
    return texts, np.array(sizes, np.int64), np.array(rows, np.int64)


def _best(array: DigestArray, texts, sizes, rows, n: int) -> np.ndarray:
    found = array.find(texts, sizes)
    best = np.full(n, -1, np.int64)
    rank: dict[int, tuple[int, int]] = {}
    for i in np.flatnonzero(found >= 0):
        r, k = int(rows[i]), int(found[i])
        mine = (len(array.rule(k)), int(sizes[i]))
        if mine > rank.get(r, (-1, -1)):
            rank[r], best[r] = mine, k
    return best


def host_path(url) -> tuple:
    """Columns host and path of a url."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.coalesce(lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.lit(""))
    return host, F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages."""
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    packed = pack_rules(rules)
    if sum(map(len, packed.values())) > broadcast_bytes:
        return _judge_by_ranges(rows, packed)
    held = rows.sparkSession.sparkContext.broadcast(packed)

    def apply(batches):
        array = DigestArray(held.value)
        for pdf in batches:
            best = _best(array, *_ask(pdf["host"], pdf["path"], array.lengths), len(pdf))
            yield pdf.assign(rule=[array.rule(k) if k >= 0 else None for k in best], verdict=[BLOCK if k >= 0 and array.verdicts[k] else ALLOW for k in best])

    return rows.mapInPandas(apply, f"{_kind(rows)}, host string, path string, rule string, verdict string")


def _kind(rows: DataFrame) -> str:
    return f"page_id {dict(rows.dtypes)['page_id']}"


def _judge_by_ranges(rows: DataFrame, packed: dict[str, bytes], range_rules: int = RANGE_RULES) -> DataFrame:
    """The same for an array too large to broadcast: a range of keys a group, questions dealt to them."""
    spark: SparkSession = rows.sparkSession
    keys, offsets = np.frombuffer(packed["keys"], "<u8"), np.frombuffer(packed["offsets"], "<i8")
    lengths = np.frombuffer(packed["lengths"], "<i4").tolist()
    verdicts, hosts = np.frombuffer(packed["verdicts"], np.uint8), np.frombuffer(packed["hosts"], "<i4")
    starts = list(range(0, len(keys), range_rules))
    edges = np.array([int(keys[i]) for i in starts[1:]], np.uint64)
    table = [
        (int(np.searchsorted(edges, keys[i], "right")), keys[i : i + 1].tobytes(), packed["bytes"][offsets[i] : offsets[i + 1]], int(verdicts[i]), int(hosts[i]))
        for i in range(len(keys))
    ]
    index = materialise(spark.createDataFrame(table, "part int, k binary, rule binary, block int, hostlen int"), "url-rules")
    rows = materialise(rows.select("*", F.monotonically_increasing_id().alias("row")), "urls")

    def ask(batches):
        for pdf in batches:
            texts, sizes, at = _ask(pdf["host"], pdf["path"], lengths)
            asked = np.fromiter(map(xxhash.xxh64_intdigest, texts), np.uint64, len(texts))
            yield pd.DataFrame({"row": pdf["row"].to_numpy()[at] if len(at) else [], "part": np.searchsorted(edges, asked, "right"), "text": texts, "hostlen": sizes})

    asked = rows.mapInPandas(ask, "row long, part int, text binary, hostlen int")
    # A question is asked once, however many pages ask it.
    distinct = asked.groupBy("part", "text", "hostlen").agg(F.count(F.lit(1)).alias("n"))

    def answer(mine: pd.DataFrame, rules: pd.DataFrame) -> pd.DataFrame:
        if not len(rules):
            return pd.DataFrame({"text": [], "hostlen": [], "verdict": []})
        array = DigestArray(pack_rules((bytes(t).decode()[:n], bytes(t).decode()[n:], BLOCK if b else ALLOW) for t, b, n in zip(rules["rule"], rules["block"], rules["hostlen"], strict=True)))
        found = array.find([bytes(x) for x in mine["text"]], mine["hostlen"].to_numpy(np.int64)) if len(mine) else np.empty(0, np.int64)
        hit = found >= 0
        return mine.loc[hit, ["text", "hostlen"]].assign(verdict=[BLOCK if array.verdicts[k] else ALLOW for k in found[hit]])

    answers = distinct.groupBy("part").cogroup(index.groupBy("part")).applyInPandas(answer, "text binary, hostlen int, verdict string")
    best = asked.join(answers, ["text", "hostlen"]).groupBy("row").agg(F.max(F.struct(F.length(F.col("text").cast("string")).alias("n"), "hostlen", F.col("text").cast("string").alias("rule"), "verdict")).alias("best"))
    return rows.join(best, "row", "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(ALLOW)).alias("verdict"))


ORACLE_SQL = r"""
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
r(rhost, rpath, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
m AS (SELECT page_id, host, path, max({'n': length(rhost || rpath), 'h': length(rhost), 'rule': rhost || rpath, 'v': rv}) AS best
      FROM u JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY ALL)
SELECT u.page_id, u.host, u.path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict FROM u LEFT JOIN m ON u.page_id IS NOT DISTINCT FROM m.page_id AND u.host = m.host AND u.path = m.path
"""
