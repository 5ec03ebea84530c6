"""What the operators share: tables in the shared folder, row numbering of text, batches."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import re
import shutil
import tempfile
import time
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Written by lower_ascii(): only A-Z are lower-cased, whatever the locale or script.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local one is made only where none is set and all run on this machine."""
    if (path := spark.conf.get("spark.checkpoint.dir", None)) is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, path, True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialise(df: DataFrame, name: str, file_rows: int = 0, batch_bytes: int | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder. This cuts lineage; lost executors don't lose it.

    For long rows: file_rows in a file at most, and batch_bytes at most for a batch that goes to Python; that is a
    setting of the session, which queries planned by other threads during the write see too.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH_BYTES)
    if batch_bytes:
        spark.conf.set(_BATCH_BYTES, batch_bytes)
    try:
        df.write.option("maxRecordsPerFile", file_rows).parquet(path)
    finally:
        spark.conf.set(_BATCH_BYTES, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes a table that materialise() wrote and that no plan still to run reads."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of plans that have run: it does when the driver's garbage is collected."""
    for _ in range(2):  # Python's references to the driver's objects are given up by a thread of its own
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)


def shrink(spark: SparkSession) -> None:
    """Executors' JVMs collect their garbage and give back the heap they then don't use; else it stays at its largest, beside their Python workers.

    A task a core; a busy executor may be left out. Results don't depend on it.
    """
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.java_method(F.lit("java.lang.System"), F.lit("gc"))).collect()


#: A key is hot if it has more than this share of the rows; so there are at most as many hot keys as this says.
HOT_KEYS = 1000


def join_hot(left: DataFrame, right: DataFrame, key: str, how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """left joined with right, which has one short row a key at most; left is read several times.

    Hot keys' rows of right, HOT_KEYS at most, are broadcast; so no key's rows of left meet in one task.
    counts: key and count of left's rows, where they are known.
    """
    least = left.count() // HOT_KEYS
    hot = (counts or left.groupBy(key).count()).where(F.col("count") > least).select(key)
    few = F.broadcast(right.join(F.broadcast(hot), key, "left_semi"))
    return left.join(F.broadcast(hot), key, "left_semi").join(few, key, how).unionByName(left.join(F.broadcast(hot), key, "left_anti").join(right, key, how))


def join_salted(left: DataFrame, right: DataFrame, key: str, salt: str) -> DataFrame:
    """As join_hot, for long rows of right: a hot key's row is repeated, once for so many rows of left, which are dealt by the column salt."""
    least = left.count() // HOT_KEYS + 1
    hot = F.broadcast(left.groupBy(key).count().where(F.col("count") > least).select(key, F.ceil(F.col("count") / least).alias("__salts")))
    dealt = left.join(hot, key, "left").withColumn("__salt", F.coalesce(F.pmod(F.xxhash64(salt), F.col("__salts")), F.lit(0).cast("long"))).drop("__salts")
    last = F.coalesce("__salts", F.lit(1).cast("long")) - 1
    return dealt.join(right.join(hot, key, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("__salts"), [key, "__salt"]).drop("__salt")


#: Keys of rows to leave out are broadcast up to this number, else joined by a shuffle.
BROADCAST_KEYS = 500_000


def without(docs: DataFrame, keys: DataFrame, on: dict[str, Column]) -> DataFrame:
    """The rows of docs, whole, whose values of `on` (column of keys -> expression over docs) are not in the written table keys."""
    names = dict(zip(on, unused_names(docs.columns, len(on)), strict=True))
    keys = keys.select(*(F.col(k).alias(n) for k, n in names.items()))
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    equal = functools.reduce(lambda a, b: a & b, (e.eqNullSafe(F.col(names[k])) for k, e in on.items()))
    return docs.join(F.broadcast(keys) if few else keys, equal, "left_anti")


def unused_names(taken: list[str], n: int) -> list[str]:
    """n names that clash with none of those taken, in any case of letters."""
    prefix = "k"
    while any(x.lower().startswith(prefix) for x in taken):
        prefix += "_"
    return [f"{prefix}{i}" for i in range(n)]


def text_key() -> dict[str, Column]:
    """128 bits of the column text, and whether it is null."""
    return {"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), F.col("text")), "none": F.col("text").isNull()}


def give_back() -> None:
    """Frees this process' unused memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    ctypes.CDLL(None).malloc_trim(0)


def tidy(apply):
    """A map over batches that gives memory back to the system when its task ends, so that idle workers are small."""

    @functools.wraps(apply)
    def tidied(batches):
        try:
            yield from apply(batches)
        finally:
            give_back()

    return tidied


def lower_ascii(column):
    return F.translate(column, UPPER, LOWER)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def arrow_schema(**types: pa.DataType) -> pa.Schema:
    return pa.schema(list(types.items()))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]
