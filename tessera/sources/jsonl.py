"""JSON Lines sources and sinks: tolerant, strict, prefix and head scans; append, overwrite and split writers."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.core import not_blank, strict_json, strip
from tessera.operators.validate import with_structure
from tessera.schema import CONVERSATION, METADATA, SNIPPET


class MalformedLine(ValueError):
    """A line that a strict scan does not accept."""


def lines(spark: SparkSession, path: str) -> DataFrame:
    """ord, line: in file order, across files by name; a missing path fails."""
    raw = spark.read.text(path).select(F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("n")).alias("ord"), F.col("value").alias("line"))
    return raw


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def checked(df: DataFrame, line: str = "line") -> DataFrame:
    """Non-blank lines with is_json and valid (the structure of a conversation)."""
    rows = with_structure(df.where(not_blank(line)).withColumn("is_json", strict_json(line)), line, "valid")
    return rows.withColumn("valid", F.col("is_json") & (F.size("valid") == 0))


def parsed(df: DataFrame, line: str = "line") -> DataFrame:
    """The typed record of each line: texts stripped, absent lists empty, the number of turns filled in."""
    r = F.col("record")
    messages = F.transform(r["messages"], lambda m: m.withField("role", strip(m["role"])).withField("content", strip(m["content"])).withField("code_snippets", _snippets(m["code_snippets"])))
    meta = F.coalesce(r["metadata"], F.from_json(F.lit("{}"), METADATA))
    meta = meta.withField("source", F.coalesce(meta["source"], F.lit("synthetic"))).withField("turn_count", F.coalesce(meta["turn_count"], F.size(r["messages"]).cast("long"))).withField("tags", F.coalesce(meta["tags"], F.array().cast("array<string>")))
    full = r.withField("messages", messages).withField("code_snippets", _snippets(r["code_snippets"])).withField("tools", F.coalesce(r["tools"], F.array().cast("array<string>"))).withField("metadata", meta)
    return df.withColumn("record", F.from_json(line, CONVERSATION)).withColumn("record", full)


def _snippets(c):
    return F.transform(F.coalesce(c, F.array().cast(f"array<{SNIPPET}>")), lambda s: s.withField("language", strip(s["language"])).withField("code", strip(s["code"])))


def tolerant(df: DataFrame, line: str = "line") -> DataFrame:
    """Valid lines; blank ones are ignored, others skipped."""
    return checked(df, line).where("valid").drop("is_json", "valid")


def skipped(df: DataFrame, line: str = "line") -> DataFrame:
    """One row: loaded, skipped."""
    return checked(df, line).agg(F.count_if("valid").alias("loaded"), F.count_if(~F.col("valid")).alias("skipped"))


def strict(df: DataFrame, line: str = "line") -> DataFrame:
    """The lines if each is JSON; otherwise the query fails."""
    bad = F.raise_error(F.concat(F.lit("malformed line: "), F.substring(line, 1, 80)))
    return df.where(not_blank(line)).withColumn(line, F.when(strict_json(line), F.col(line)).otherwise(bad.cast("string")))


def valid_prefix(df: DataFrame, order: str = "ord", line: str = "line", structural: bool = True) -> DataFrame:
    """Lines before the first bad one. The first bad place is one aggregate, so no task sees all lines."""
    rows = checked(df, line)
    stop = rows.where(~F.col("valid" if structural else "is_json")).agg(F.min(order).alias("stop"))
    return rows.join(F.broadcast(stop)).where(F.col("stop").isNull() | (F.col(order) < F.col("stop"))).drop("is_json", "valid", "stop")


def prefix_limit(df: DataFrame, limit: int, order: str = "ord", line: str = "line") -> DataFrame:
    return valid_prefix(df, order, line).orderBy(order).limit(limit)


def examples(df: DataFrame, limit: int = 20, order: str = "ord", line: str = "line") -> DataFrame:
    """The first valid lines; bad ones in between don't end the scan."""
    return tolerant(df, line).orderBy(order).limit(limit)


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One JSON object a line; mode append adds files."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_splits(df: DataFrame, path: str, order: Column | None = None) -> None:
    """One folder for each value of the column split, its rows in the given order across files."""
    rows = df if order is None else df.orderBy("split", order)
    rows.write.mode("overwrite").partitionBy("split").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """With a header in each file; quotes are doubled, as other readers expect."""
    df.write.mode("overwrite").options(header=True, escape='"').csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; an empty cell is null, quoted or not. Cells may hold line feeds."""
    return spark.read.options(header=True, escape='"', multiLine=True).csv(path)


def write_info(row: dict, path: str) -> None:
    """Statistics or dataset info: one row as JSON, put in place at once."""
    with open(part := f"{path}.{uuid.uuid4().hex}", "w", encoding="utf-8") as f:
        json.dump(row, f, indent=2, default=str)
    os.replace(part, path)


def text_resource(root: str, name: str) -> str:
    """A file below root; names that lead out of it are refused."""
    top, path = os.path.realpath(root), os.path.realpath(os.path.join(root, name))
    if path != top and not path.startswith(top + os.sep):
        raise ValueError(f"path escapes its root: {name}")
    with open(path, encoding="utf-8") as f:
        return f.read()
