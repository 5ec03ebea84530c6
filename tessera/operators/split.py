"""Stratified splits without leakage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.core import seeded, uniform

SPLITS = ("train", "validation", "test")
SALTS = 64


@dataclass(frozen=True)
class SplitConfig:
    train: float = 0.8
    validation: float = 0.1
    test: float = 0.1
    seed: int = 42

    def __post_init__(self):
        ratios = (self.train, self.validation, self.test)
        if not all(0 <= r <= 1 for r in ratios) or abs(sum(ratios) - 1) > 1e-6:
            raise ValueError("ratios must be in [0, 1] and add up to 1")


def stratified(df: DataFrame, strata, key: str, config: SplitConfig = SplitConfig()) -> DataFrame:
    """df with the column split.

    In a stratum of n >= 3 rows, ordered by seed and key, the first max(1, round(n * train)) rows are for
    training, the next max(1, round(n * validation)) for validation, the rest for testing; testing gets one
    row if its ratio asks for any. Smaller strata draw each row by the ratios. Null is a stratum value.

    A row's rank is found without bringing a stratum together: rows are dealt by the first digits of their
    shuffle key, ranked inside those, and the counts of the digits before are added.
    """
    if not df.columns or df.isEmpty():
        raise ValueError("no rows to split")
    strata = list(strata)
    keyed = df.withColumn("__h", seeded(config.seed, key)).withColumn("__salt", F.conv(F.substring("__h", 1, 4), 16, 10).cast("int") % F.lit(65536) / F.lit(65536 // SALTS))
    keyed = keyed.withColumn("__salt", F.floor("__salt")).withColumns({f"__s{i}": F.coalesce(F.concat(F.lit("="), F.col(s).cast("string")), F.lit("null")) for i, s in enumerate(strata)})
    names = [f"__s{i}" for i in range(len(strata))]
    part = keyed.groupBy(*names, "__salt").agg(F.count(F.lit(1)).alias("__k"))
    of = Window.partitionBy(*names)
    part = part.select(*names, "__salt", F.coalesce(F.sum("__k").over(of.orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__below"), F.sum("__k").over(of).alias("__n"))
    ranked = keyed.withColumn("__r", F.row_number().over(Window.partitionBy(*names, "__salt").orderBy("__h", key))).join(part, [*names, "__salt"])
    n, r = F.col("__n"), F.col("__below") + F.col("__r")
    size = lambda ratio: F.greatest(F.lit(1).cast("long"), F.bround(n * F.lit(float(ratio)), 0).cast("long"))
    nt, nv, want = size(config.train), size(config.validation), F.lit(config.test > 0)
    short = want & (n - nt - nv < 1)
    # A stratum that validation would use up keeps one row for testing, the others for training.
    nt, nv = F.when(short, F.when(n - nv - 1 < 0, n - 1).otherwise(n - nv - 1)).otherwise(nt), F.when(short & (n - nv - 1 < 0), 0).otherwise(nv)
    u = uniform(f"{config.seed}:small", key)
    small = F.when(u < config.train, "train").when(u < config.train + config.validation, "validation").otherwise("test")
    large = F.when(r <= nt, "train").when(r <= nt + nv, "validation").otherwise("test")
    return ranked.withColumn("split", F.when(n < 3, small).otherwise(large)).select(*df.columns, "split")


def leaked(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur in more than one split, with their splits; empty if the split is sound."""
    return df.groupBy(key).agg(F.array_sort(F.collect_set("split")).alias("splits")).where(F.size("splits") > 1)


def assert_sound(df: DataFrame, key: str) -> DataFrame:
    bad = [r[0] for r in leaked(df, key).orderBy(key).limit(3).collect()]
    if bad:
        raise ValueError(f"in several splits: {bad}")
    return df
