"""Distributions and scalar statistics. Every aggregate is partial before its shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.core import col, percent

FIELDS = ("category", "subcategory", "intent", "difficulty", "learning_stage", "language")
_UNKNOWN = ("category", "subcategory", "intent", "learning_stage")


def known(c) -> Column:
    """Null and empty as "unknown"."""
    return F.coalesce(F.nullif(col(c), F.lit("")), F.lit("unknown"))


def distributions(df: DataFrame, fields=FIELDS, order="conv_id", tools: str | None = "tools") -> DataFrame:
    """field, value, count, percentage, rank for all fields in one pass.

    Values are ranked by count, ties by first appearance. The share is of conversations, so shares of
    tools may add up to more than 100, and a tool named twice counts twice.
    """
    pair = lambda f: F.array(F.struct(F.lit(f).alias("field"), (known(f) if f in _UNKNOWN else F.col(f)).alias("value")))
    arrays = [pair(f) for f in fields]
    if tools:
        named = F.transform(tools, lambda t: F.struct(F.lit("tools").alias("field"), t.alias("value")))
        arrays.append(F.coalesce(named, F.array().cast("array<struct<field: string, value: string>>")))
    counts = df.select(F.col(order).alias("ord"), F.explode(F.concat(*arrays)).alias("x")).groupBy("x.field", "x.value").agg(F.count(F.lit(1)).alias("count"), F.min("ord").alias("first"))
    total = df.agg(F.count(F.lit(1)).alias("total"))  # one row
    rank = F.row_number().over(Window.partitionBy("field").orderBy(F.desc("count"), "first", "value"))
    return counts.join(F.broadcast(total)).select("field", "value", "count", percent("count", "total").alias("percentage"), rank.alias("rank"))


def distribution(df: DataFrame, field: str, order="conv_id") -> DataFrame:
    return distributions(df, (field,), order, None).drop("field")


def scalars(df: DataFrame) -> DataFrame:
    """One row of totals and means, each to two places; zeros without input."""
    has = (F.size("code_snippets") > 0) | F.exists("messages", lambda m: F.size(m["code_snippets"]) > 0)
    chars = F.aggregate("messages", F.lit(0).cast("long"), lambda s, m: s + F.length(m["content"]))
    mean = lambda c: F.coalesce(F.bround(F.sum(c).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)), 2), F.lit(0.0))
    return df.agg(
        F.count(F.lit(1)).alias("total_conversations"), mean(F.size("messages")).alias("average_turns"), F.coalesce(F.bround(F.sum(has.cast("int")).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0)) * 100, 2), F.lit(0.0)).alias("code_snippet_coverage"),
        mean(chars).alias("average_characters"),
    )


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def total(splits, fallback=None) -> Column:
    """A given total, else the sum of a map of split sizes."""
    added = F.aggregate(F.map_values(col(splits)), F.lit(0).cast("long"), lambda s, x: s + x)
    return F.coalesce(col(fallback), added) if fallback is not None else added


def prevalence(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.bround(F.avg(label) * 100, 2).alias("prevalence"))


def csv_report(df: DataFrame) -> DataFrame:
    """n_rows, n_columns, empty_cells of a table of any types."""
    empty = sum((F.coalesce(F.col(c).cast("string") == "", F.lit(True)).cast("long") for c in df.columns), F.lit(0).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), F.sum(empty).alias("empty_cells"))
