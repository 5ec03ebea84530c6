"""Generation as facts: attempts, their outcomes, run metrics, and what a resumed run still has to do."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.validate import fatal
from tessera.sources.tables import materialise

REASONS = ("generation_error", "api_error", "unexpected_error", "validation_failed", "duplicate", "quality_failed")


def missing(wanted: DataFrame, produced: DataFrame, key: str = "sample_index") -> DataFrame:
    """The samples still to be made: by index, so a sample skipped earlier keeps its spec."""
    return wanted.join(produced.select(key).distinct(), key, "left_anti")


def reasons(attempts: DataFrame) -> DataFrame:
    """reason, n of rejected attempts, most frequent first."""
    return attempts.where("reason IS NOT NULL").groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


def run_metrics(attempts: DataFrame) -> DataFrame:
    """One row. attempts: sample_index, attempt (from 1), reason (null: success), seconds.

    retries counts those of samples that succeeded; rejected attempts count every reason, API errors too.
    """
    each = attempts.groupBy("sample_index").agg(F.max(F.when(F.col("reason").isNull(), F.col("attempt"))).alias("won"), F.sum(F.when(F.col("reason").isNull(), F.col("seconds"))).alias("seconds"), F.count("reason").alias("rejected"), F.count_if(F.col("reason") == "api_error").alias("api"))
    return each.agg(
        F.count(F.lit(1)).alias("requested"), F.count("won").alias("generated"), F.count_if(F.col("won").isNull()).alias("skipped"), F.coalesce(F.sum(F.col("won") - 1), F.lit(0)).alias("retries"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected_attempts"), F.coalesce(F.sum("api"), F.lit(0)).alias("api_errors"), F.coalesce(F.bround(F.sum("seconds") / F.nullif(F.count("won"), F.lit(0)), 2), F.lit(0.0)).alias("average_seconds"),
    )


def token_usage(requests: DataFrame) -> DataFrame:
    """Sums of the usage of each request; one without usage still counts."""
    return requests.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens", "total_tokens")), F.count(F.lit(1)).alias("requests"))


def summary(metrics: dict, failed: list[tuple[str, int]]) -> str:
    """Run metrics and the reasons of failures, as text."""
    names = {"requested": "requested", "generated": "generated", "skipped": "skipped", "retries": "retries", "rejected_attempts": "rejected attempts", "api_errors": "API errors", "average_seconds": "seconds a sample"}
    lines = [f"{label:>18}: {metrics[key]}" for key, label in names.items()]
    return "\n".join(["Generation run", *lines, *(f"{reason:>18}: {n}" for reason, n in failed)])


class FatalApiError(RuntimeError):
    """An error that no retry will mend."""


def waves(wanted: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], max_attempts: int = 5, key: str = "sample_index", each: Callable[[DataFrame, DataFrame], None] = lambda good, bad: None) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected attempts). Each wave makes one attempt at every sample without success.

    attempt(specs, number) returns the specs' rows with reason (null: accepted) and detail. A wave is
    written before it is read twice, so that nothing is generated again; each(accepted, rejected) is
    called when a wave ends, unless an error that no retry mends stops the run.
    """
    accepted = rejected = None
    open_ = wanted
    for number in range(1, max_attempts + 1):
        wave = materialise(attempt(open_, number).withColumn("attempt", F.lit(number)), "wave")
        good, bad = wave.where("reason IS NULL"), wave.where("reason IS NOT NULL")
        stop = bad.where((F.col("reason") == "api_error") & fatal("detail")).select("detail").limit(1).collect()
        if stop:
            raise FatalApiError(stop[0][0])
        accepted, rejected = (good, bad) if accepted is None else (accepted.unionByName(good), rejected.unionByName(bad))
        each(good, bad)
        open_ = missing(open_, good, key)
        if bad.isEmpty():
            break
    return accepted, rejected
