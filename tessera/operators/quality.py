"""Quality scores: payload checks, the weighted mean and the gate."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.core import col, not_blank
from tessera.schema import QUALITY_WEIGHTS


@dataclass(frozen=True)
class QualityConfig:
    threshold: float = 0.7
    weights: dict = field(default_factory=lambda: dict(QUALITY_WEIGHTS))

    def __post_init__(self):
        if set(self.weights) != set(QUALITY_WEIGHTS) or abs(sum(self.weights.values()) - 1) > 1e-6:
            raise ValueError("weights must cover all dimensions and add up to 1")
        if not 0 <= self.threshold <= 1:
            raise ValueError("threshold must be in [0, 1]")


def overall(dimensions, config: QualityConfig = QualityConfig()) -> Column:
    """Sum of weight * (score - 1) / 9, added in the order of the dimensions and not rounded."""
    weight = F.create_map(*(x for k, w in config.weights.items() for x in (F.lit(k), F.lit(w))))
    return F.aggregate(col(dimensions), F.lit(0.0), lambda s, d: s + F.try_element_at(weight, d["name"]) * ((d["score"] - 1) / F.lit(9.0)))


def judged(df: DataFrame, dimensions="dimensions", config: QualityConfig = QualityConfig()) -> DataFrame:
    """overall_score (four places) and passed, which is decided before rounding and includes the threshold."""
    raw = overall(dimensions, config)
    return df.withColumn("overall_score", F.bround(raw, 4)).withColumn("passed", raw >= config.threshold)


def tally(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))


def payload_problem(json_text) -> Column:
    """The first thing wrong with a judge's payload, or null."""
    v = F.try_parse_json(col(json_text))
    dims = F.try_variant_get(v, "$.dimensions", "array<variant>")
    name = lambda d: F.try_variant_get(d, "$.name", "string")
    score = lambda d: F.try_variant_get(d, "$.score", "double")
    kind = lambda d, k: F.schema_of_variant(F.try_variant_get(d, f"$.{k}", "variant"))
    names, all_names = F.transform(dims, name), F.array(*(F.lit(k) for k in QUALITY_WEIGHTS))
    number = lambda d: ~kind(d, "score").isin("STRING", "VOID") & ~kind(d, "score").rlike("^(OBJECT|ARRAY)")
    bad = lambda check: F.exists(dims, lambda d: ~F.coalesce(check(d), F.lit(False)))
    missing = F.array_sort(F.array_except(all_names, names))
    return (
        F.when(F.coalesce(~F.schema_of_variant(v).startswith("OBJECT"), F.lit(True)), "not an object").when(dims.isNull(), "dimensions is not a list")
        .when(bad(lambda d: F.schema_of_variant(d).startswith("OBJECT")), "a dimension is not an object").when(bad(lambda d: F.array_contains(all_names, name(d))), "unknown dimension")
        .when(F.size(F.array_distinct(names)) < F.size(names), "duplicate dimension").when(bad(lambda d: number(d) & F.floor(score(d)).between(1, 10)), "score out of range")
        .when(bad(lambda d: (kind(d, "reasoning") == "STRING") & not_blank(F.try_variant_get(d, "$.reasoning", "string"))), "blank reasoning")
        .when(F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ", ")))
    )


def payload_scores(json_text) -> Column:
    """The dimensions of a good payload; scores are cut to whole numbers."""
    return F.transform(
        F.try_variant_get(F.try_parse_json(col(json_text)), "$.dimensions", "array<variant>"),
        lambda d: F.struct(F.try_variant_get(d, "$.name", "string").alias("name"), F.floor(F.try_variant_get(d, "$.score", "double")).cast("int").alias("score"), F.try_variant_get(d, "$.reasoning", "string").alias("reasoning")),
    )
