"""Tables in the shared folder, and the driver's tables as conversations."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.core import choice
from tessera.schema import SPEC_FIELDS, TAXONOMY


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. A local one is made only where none is set and all run on this machine."""
    if (path := spark.conf.get("spark.checkpoint.dir", None)) is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tessera-")
        atexit.register(shutil.rmtree, path, True)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, with its lineage cut."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record a conv_id, with coordinates derived from it: balanced as the coverage matrix is, with some gaps and mistakes."""
    i, no = F.col("conv_id"), F.array().cast("array<struct<language: string, code: string, filename: string, purpose: string>>")
    message = F.struct("role", F.col("text").alias("content"), F.when(F.col("turn") == 1, F.array(F.struct(choice((*TAXONOMY.languages, "brainfuck"), F.col("conv_id")).alias("language"), F.lit("pass").alias("code"), F.lit(None).cast("string").alias("filename"), F.lit(None).cast("string").alias("purpose")))).otherwise(no).alias("code_snippets"))
    matrix = F.create_map(*(x for f in SPEC_FIELDS[:4] for x in (F.lit(f), F.when((i % 14 == 6) & F.lit(f == "difficulty"), F.lit("other")).otherwise(choice(TAXONOMY.of(f), i + SPEC_FIELDS.index(f))))))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", message.alias("m")))).alias("all"))
    spec = {f: choice(TAXONOMY.of(f), i + d) for d, f in enumerate(SPEC_FIELDS)}
    coverage = F.create_map(*(x for f in SPEC_FIELDS[:4] for x in (F.lit(f), F.when((i % 10 == 3) & F.lit(f == "intent"), F.lit("other")).otherwise(spec[f]))))
    return rows.select(
        "conv_id", F.concat(F.lit("conv-"), i.cast("string")).alias("id"), F.when(i % 17 == 5, "chat").otherwise(spec["category"]).alias("task_type"),
        F.when(i % 11 == 0, None).when(i % 13 == 0, "").otherwise(spec["category"]).alias("category"), *(spec[f].alias(f) for f in SPEC_FIELDS[1:]),
        choice(TAXONOMY.languages, i).alias("language"), F.transform("all", lambda x: x["m"]).alias("messages"), no.alias("code_snippets"),
        F.filter(F.array(*(F.when(F.shiftright(i, k).bitwiseAND(F.lit(1)) == 1, F.lit(t)) for k, t in enumerate(("shell", "git", "hammer", "editor")))), lambda x: x.isNotNull()).alias("tools"),
        F.when(i % 4 == 0, None).otherwise(choice((*TAXONOMY.interaction_patterns, "monologue"), i)).alias("interaction_pattern"),
        F.struct(F.lit("synthetic").alias("source"), F.when(i % 3 == 0, None).when(i % 7 == 1, 99).otherwise(F.size("all")).cast("long").alias("turn_count"), coverage.alias("coverage")).alias("metadata"),
        F.struct(F.lit("tables").alias("name"), F.lit("1").alias("version"), F.struct(matrix.alias("coverage_matrix")).alias("parameters")).alias("generator"),
    )


_LIST = lambda values: "[" + ", ".join(f"'{v}'" for v in values) + "]"
_PICK = lambda field, d: f"({_LIST(TAXONOMY.of(field))})[1 + (conv_id + {d}) % {len(TAXONOMY.of(field))}]"
#: The same records for DuckDB, as the relation conv.
CONVERSATIONS_SQL = (
    "conv AS (SELECT conv_id, 'conv-' || conv_id AS id, CASE WHEN conv_id % 17 = 5 THEN 'chat' ELSE " + _PICK("category", 0) + " END AS task_type, "
    "CASE WHEN conv_id % 11 = 0 THEN NULL WHEN conv_id % 13 = 0 THEN '' ELSE " + _PICK("category", 0) + " END AS category, "
    + ", ".join(f"{_PICK(f, d)} AS {f}" for d, f in enumerate(SPEC_FIELDS) if d)
    + f", {_PICK('language', 0)} AS language, list({{'role': role, 'content': text, 'turn': turn}} ORDER BY turn) AS messages, "
    "list_filter([CASE WHEN conv_id & 1 = 1 THEN 'shell' END, CASE WHEN conv_id & 2 = 2 THEN 'git' END, CASE WHEN conv_id & 4 = 4 THEN 'hammer' END, CASE WHEN conv_id & 8 = 8 THEN 'editor' END], lambda x: x IS NOT NULL) AS tools, "
    f"CASE WHEN conv_id % 4 = 0 THEN NULL ELSE ({_LIST((*TAXONOMY.interaction_patterns, 'monologue'))})[1 + conv_id % 6] END AS interaction_pattern, "
    "CASE WHEN conv_id % 3 = 0 THEN NULL WHEN conv_id % 7 = 1 THEN 99 ELSE count(*) END AS turn_count, count(*) AS n FROM conversations GROUP BY conv_id)"
)
