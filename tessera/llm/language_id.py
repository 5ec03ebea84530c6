"""Language identification by nearest centroid over TF-IDF vectors of character n-grams.

Letters are lower-cased, anything else is one space; runs of 1 to 3 such characters are hashed to DIMS
features. A text's vector holds (1 + log count) * idf, normalised. Each language's training vectors are
clustered by spherical k-means into CLUSTERS centroids, and a text takes the language of the centroid
with the largest cosine. It is rejected if its distance (1 - cosine) exceeds the quantile QUANTILE of the
distances of that language's own training texts of its length class, each measured from centroids learned
without it; short texts are farther from any centroid, so the training texts' beginnings of SNIPPETS
characters calibrate those limits too. A limit is at most CEILING, below the distance of a text that shares
nothing. The prediction stays, the flag says so.

Training takes at most SAMPLE_PER_LANGUAGE labelled texts a language and SAMPLE_TOTAL in all, those with
the smallest hash of the doc_id among the training folds; of more than SAMPLE_TOTAL languages those with the
most texts are learned. The bound is for fitting alone, every text is predicted whole. Features of the
sample, not its texts, come to the driver.

Defined cases: null text or one without letters is `und` with score 0, and rejected; so is every text
if nothing could be learned; a null lang is never learned; a null doc_id is hashed as the empty text;
ties go to the language that sorts first; repeated rows are predicted one by one; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import give_back, materialise, text_key, tidy, without

DIMS, CLUSTERS = 1 << 13, 4
SAMPLE_PER_LANGUAGE, SAMPLE_TOTAL = 400, 4000
QUANTILE, CEILING = 0.995, 0.99
#: Neighbouring length classes share a limit so that so many training texts stand behind each: one lies above the quantile.
ENOUGH = 200
SNIPPETS = (4, 8, 16, 32, 64, 128, 256, 512)
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
_PIECE, _ROWS = 1 << 20, 128
#: Bytes of texts that a worker of a filtering stage is sent at once.
BATCH_BYTES = 8 << 20


@cache
def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or 0."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x33500):
        x = chr(c)
        if x.isalpha():
            table[c] = ord(low) if len(low := x.lower()) == 1 else c
    return table


def counts(text: str) -> np.ndarray | None:
    """How often each feature occurs; None without letters."""
    out, any_letter = np.zeros(DIMS, np.int64), False
    for at in range(0, len(text), _PIECE):
        x = _letters()[np.frombuffer(text[max(0, at - 2) : at + _PIECE].encode("utf-32-le"), np.uint32)]
        any_letter = any_letter or bool(x.any())
        keep = x != 0
        keep[1:] |= keep[:-1]
        x = np.concatenate([[0], x[keep], [0]]).astype(np.uint64)
        a = x * np.uint64(0x9E3779B97F4A7C15)
        b = a[:-1] * np.uint64(31) + x[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        c = b[:-1] * np.uint64(37) + x[2:] * np.uint64(0x165667B19E3779F9)
        for h in (a, b, c):
            h = h ^ (h >> np.uint64(32))
            out += np.bincount(((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(51)).astype(np.int64), minlength=DIMS)
    return out if any_letter else None


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def _dense(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.zeros(DIMS, np.int32)
    out[at] = n
    return out


def _weighted(rows: np.ndarray) -> np.ndarray:
    return np.where(rows > 0, 1 + np.log(np.maximum(rows, 1)), 0).astype(np.float32)


def _length(rows: np.ndarray) -> np.ndarray:
    """The length class of each row of counts."""
    return np.log2(np.maximum(rows.sum(axis=-1), 1)).astype(np.int64)


class Centroids:
    def __init__(self, langs: list[str], rows: list, snippets: dict | None = None, k: int = CLUSTERS, quantile: float = QUANTILE):
        """rows: (places, counts) of the training texts, langs: theirs; snippets: by lang, those of shorter texts."""
        self.names, self.trained = sorted(set(langs)), len(langs)
        seen = np.bincount(np.concatenate([at for at, _ in rows]), minlength=DIMS) if rows else np.zeros(DIMS)
        self.idf = np.log((1 + len(rows)) / (1 + seen)).astype(np.float32) + 1
        vectors, lengths = np.zeros((len(rows), DIMS), np.float32), np.zeros(len(rows), np.int64)
        for i in range(0, len(rows), _ROWS):
            vectors[i : i + _ROWS], lengths[i : i + _ROWS] = self._vectors(rows[i : i + _ROWS])
        of, centres = np.array(langs), []
        self.name_of: list[int] = []
        self.limits = np.full((len(self.names), 64), CEILING)
        for i, name in enumerate(self.names):
            mine = vectors[of == name]
            c = self._cluster(mine, min(k, len(mine)))
            self.name_of += [i] * len(c)
            centres.append(c)
            far, classes = [self._apart(mine, k)], [lengths[of == name]]
            short = snippets.get(name, []) if snippets else []
            for first in range(0, len(short), _ROWS):
                x, sizes = self._vectors(short[first : first + _ROWS])
                far.append((1 - x @ c.T).min(axis=1))
                classes.append(sizes)
            away, at = np.concatenate(far), np.concatenate(classes)
            for size in range(64):
                near = np.abs(at - size)
                near = near <= np.sort(near)[min(ENOUGH, len(near)) - 1]
                self.limits[i, size] = min(CEILING, np.quantile(away[near], quantile) + 1e-6)
        self.centres = np.concatenate(centres).astype(np.float32) if centres else np.zeros((0, DIMS), np.float32)

    def _vectors(self, rows: list) -> tuple[np.ndarray, np.ndarray]:
        """Vectors and length classes."""
        x = np.array([_dense(*r) for r in rows])
        return _normal(_weighted(x) * self.idf), _length(x)

    @staticmethod
    def _cluster(x: np.ndarray, k: int) -> np.ndarray:
        c = [_normal(x.mean(axis=0))]
        while len(c) < k:  # the text farthest from those chosen
            c.append(x[int((x @ np.array(c).T).max(axis=1).argmin())])
        c = np.array(c)
        for _ in range(10):
            at = (x @ c.T).argmax(axis=1)
            c = np.array([_normal(x[at == j].mean(axis=0)) if (at == j).any() else c[j] for j in range(k)])
        return c

    @classmethod
    def _apart(cls, x: np.ndarray, k: int) -> np.ndarray:
        """Each text's distance to centroids that were learned without it, as those of new texts are."""
        out = np.zeros(len(x))
        for fold in range(FOLDS):
            out_of = np.arange(len(x)) % FOLDS == fold
            rest = x[~out_of] if len(x) > 1 else x
            if out_of.any():
                out[out_of] = (1 - x[out_of] @ cls._cluster(rest, min(k, len(rest))).T).min(axis=1)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        names, scores, rejected = [], np.zeros(len(texts)), np.ones(len(texts), bool)
        for at in range(0, len(texts), _ROWS):
            some = [counts(t) if t and self.names else None for t in texts[at : at + _ROWS]]
            there = [i for i, c in enumerate(some) if c is not None]
            said = [UNKNOWN] * len(some)
            if there:
                x = np.array([some[i] for i in there])
                cos, length = _normal(_weighted(x) * self.idf) @ self.centres.T, _length(x)
                best = cos.argmax(axis=1)
                for j, i in enumerate(there):
                    lang = self.name_of[best[j]]
                    said[i] = self.names[lang]
                    scores[at + i] = min(1.0, max(0.0, float(cos[j, best[j]])))
                    rejected[at + i] = 1 - cos[j, best[j]] > self.limits[lang, length[j]]
            names += said
        return names, scores, rejected


def _fold():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


def train(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, total: int = SAMPLE_TOTAL, folds: bool = True) -> Centroids:
    """From text and lang of the training folds (folds=False: of all rows)."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if folds:
        labelled = labelled.where(_fold() != HELD_OUT)
    # At most `total` languages come to the driver, those with the most texts.
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(total).collect()
    if not sizes:
        return Centroids([], [])
    n = max(1, min(per_language, total // len(sizes)))
    # A share of each language that holds n texts and a few more; the sample is cut to n below.
    spread = 1 << 40
    shares = [(lang, int(min(1.0, (n + 6 * n**0.5 + 10) / size) * spread)) for lang, size in sizes]
    shares = docs.sparkSession.createDataFrame(shares, "lang string, share long")
    rows = labelled.select("lang", F.pmod(F.xxhash64("doc_id"), F.lit(spread)).alias("place"), "text")
    sample = rows.join(F.broadcast(shares), "lang").where("place < share").select("lang", "place", "text")

    def features(batches):
        for b in batches:
            for lang, place, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                said = [counts(text[:size]) for size in (None, *(x for x in SNIPPETS if x < len(text)))]
                at = [np.flatnonzero(c) for c in said if c is not None]
                if at:
                    packed = [x.astype("<u2").tobytes() for x in at], [c[x].astype("<u4").tobytes() for c, x in zip((c for c in said if c is not None), at, strict=True)]
                    yield pa.record_batch([pa.array([lang]), pa.array([place]), *(pa.array([x], pa.list_(pa.binary())) for x in packed)], names=["lang", "place", "at", "n"])

    found: dict[str, list] = {}
    for r in sample.mapInArrow(features, "lang string, place long, at array<binary>, n array<binary>").toArrow().to_pylist():
        found.setdefault(r["lang"], []).append((r["place"], r["n"], r["at"]))
    langs, whole, parts = [], [], {}
    for lang in sorted(found):
        for _, counted, at in sorted(found[lang])[:n]:
            first, *rest = ((np.frombuffer(a, "<u2"), np.frombuffer(c, "<u4")) for a, c in zip(at, counted, strict=True))
            langs.append(lang)
            whole.append(first)
            parts.setdefault(lang, []).extend(rest)
    found.clear()
    out = Centroids(langs, whole, parts)
    give_back()
    return out


def identify(docs: DataFrame, model: Centroids | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected for every row of docs."""
    held = docs.sparkSession.sparkContext.broadcast(model or train(docs))
    kind = dict(docs.dtypes)["doc_id"]

    def apply(batches):
        for b in batches:
            names, scores, rejected = held.value.predict(b.column("text").to_pylist())
            yield pa.record_batch({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(scores, pa.float64()), "rejected": pa.array(rejected, pa.bool_())})

    return docs.select("doc_id", (_fold() == HELD_OUT).alias("held_out"), "text").mapInArrow(tidy(apply), f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Centroids | None = None) -> DataFrame:
    """The rows of docs, whole, whose text is not rejected; learns from all labelled rows of docs.

    Null text, text without letters and, if nothing could be learned, any text is rejected; rows with equal texts share
    their fate; an empty table gives no rows; any other columns are carried along, whatever their names.
    """
    held, key = docs.sparkSession.sparkContext.broadcast(model or train(docs, folds=False)), list(text_key())

    def apply(batches):
        for b in batches:
            yield b.filter(pa.array(held.value.predict(b.column("text").to_pylist())[2], pa.bool_())).select(key)

    asked = docs.select("text", *(e.alias(k) for k, e in text_key().items()))
    rejected = asked.mapInArrow(tidy(apply), "h1 long, h2 long, none boolean").distinct()
    return without(docs, materialise(rejected, "rejected", batch_bytes=BATCH_BYTES), text_key())
