"""Token counts by a separator scan of flat, unindexed token files.

A token file is one stream of ids in which each document ends with the end-of-document id; nothing tells
where documents begin. Files are read in blocks that ignore documents. A block is searched for the id by
one vectorised comparison; a prefix scan over one short row a block gives each block its position in the
stream, the number of documents before it and the last separator before it, and so stitches documents
that cross blocks, however many.

write_token_files() makes such files from texts: a task's documents in reading order are one file, kept
as rows of blocks in the shared folder, with a manifest of the doc_ids in order.

Defined cases: null or empty text has no tokens; ids after a file's last separator count as a document
that isn't terminated; texts that spell the separator are ordinary text; rows that repeat a doc_id count
one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialise, texts_of
from tessera.llm.tokens import END, RANKS, encoder

BLOCK_TOKENS = 1 << 18
_SCHEMA = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("payload", pa.binary()), ("first", pa.int64()), ("ids", pa.list_(pa.int64()))])


def _write(block_tokens: int, ranks: str):
    def apply(batches):
        enc, file = encoder(ranks), TaskContext.get().partitionId()
        held, size, block, first = [], 0, 0, 0
        row = lambda **x: pa.record_batch([pa.array([x.get(n)], t) for n, t in zip(_SCHEMA.names, _SCHEMA.types, strict=True)], schema=_SCHEMA)
        for b in batches:
            if b.num_rows:
                yield row(file=file, first=first, ids=b.column("doc_id").to_pylist())
                first += b.num_rows
            for ids in enc.encode(texts_of(b)):
                held += [ids, np.array([END], np.uint16)]
                size += len(ids) + 1
                if size >= block_tokens:
                    flat = np.concatenate(held)
                    while len(flat) >= block_tokens:
                        yield row(file=file, block=block, payload=flat[:block_tokens].tobytes())
                        flat, block = flat[block_tokens:], block + 1
                    held, size = [flat], len(flat)
        if size:
            yield row(file=file, block=block, payload=np.concatenate(held).tobytes())

    return apply


def write_token_files(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, ranks: str = RANKS) -> tuple[DataFrame, DataFrame]:
    """Blocks (file, block, payload: little-endian uint16) and manifest (file, first, ids)."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    written = materialise(texts.mapInArrow(_write(block_tokens, ranks), "file long, block long, payload binary, first long, ids array<long>"), "token-files")
    return written.where("payload IS NOT NULL").select("file", "block", "payload"), written.where("ids IS NOT NULL").select("file", "first", "ids")


def _separators(batches):
    for b in batches:
        n, found = [], []
        for payload in b.column("payload").to_pylist():
            ids = np.frombuffer(payload, "<u2")
            n.append(len(ids))
            found.append(np.flatnonzero(ids == END))
        offsets = np.cumsum([0, *map(len, found)])
        yield pa.record_batch({"file": b.column("file"), "block": b.column("block"), "n": pa.array(n, pa.int64()), "ends": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *found]), pa.int64()))})


def token_counts(blocks: DataFrame) -> DataFrame:
    """file, ordinal, start, n_tokens, terminated for each document of the files; separators aren't counted."""
    found = blocks.mapInArrow(_separators, "file long, block long, n long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    placed = found.withColumn("base", F.coalesce(F.sum("n").over(before), zero)).withColumn("docs", F.coalesce(F.sum(F.size("ends")).over(before), zero))
    placed = placed.withColumn("ends", F.transform("ends", lambda e: e + F.col("base")))
    placed = placed.withColumn("last", F.coalesce(F.max(F.try_element_at("ends", F.lit(-1))).over(before), F.lit(-1).cast("long")))
    each = placed.select("file", "docs", "last", "ends", F.posexplode("ends").alias("k", "end"))
    previous = F.when(F.col("k") == 0, F.col("last")).otherwise(F.try_element_at("ends", F.col("k")))
    done = each.select("file", (F.col("docs") + F.col("k")).alias("ordinal"), (previous + 1).alias("start"), (F.col("end") - previous - 1).alias("n_tokens"), F.lit(True).alias("terminated"))
    tail = placed.groupBy("file").agg(F.max(F.col("base") + F.col("n")).alias("all"), F.max(F.greatest("last", F.coalesce(F.try_element_at("ends", F.lit(-1)), F.lit(-1)))).alias("last"), F.max(F.col("docs") + F.size("ends")).alias("docs"))
    rest = tail.select("file", F.col("docs").alias("ordinal"), (F.col("last") + 1).alias("start"), (F.col("all") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("terminated")).where("n_tokens > 0")
    return done.unionByName(rest)


def document_token_counts(docs: DataFrame, block_tokens: int = BLOCK_TOKENS, ranks: str = RANKS) -> DataFrame:
    """doc_id, file, ordinal, start, n_tokens for every row of docs, by way of token files."""
    blocks, manifest = write_token_files(docs, block_tokens, ranks)
    names = manifest.select("file", "first", F.posexplode("ids").alias("k", "doc_id")).select("file", (F.col("first") + F.col("k")).alias("ordinal"), "doc_id")
    return names.join(token_counts(blocks), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens")
